"""SentencePiece vocabularies, and encoding by a streaming Viterbi search.

The best segmentation of a text is the one whose pieces have the largest sum of the scores in the
model file; of equal sums the one found with the longer last piece. The search goes through the text
once; new scores depend on a window bounded by the longest piece. Where all paths that can still be
extended meet at one boundary, the ids up to it are committed and their back pointers dropped. The paths of
a run of one character may not meet before its end; the search for a boundary waits until the open part has
doubled, so time is linear for any text, and what is kept for an open part is one number a character. Characters outside the vocabulary
become their UTF-8 byte pieces, and so does a literal U+2581, the character that stands for a space
inside pieces; decoding therefore gives every text back exactly.

No piece goes on from a non-space to a space, from a word to a mark, or over a line feed, so all paths
meet there; the text is searched unit by unit, and frequent short units are looked up.

Null text counts as empty and has no ids; a very long text is one row like any other. Rows are encoded one by
one, so repeated rows and ties of doc_id give repeated results; an empty table gives none. All columns but
doc_id and text, also those with clashing names, are left out.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from risklens.llm.shared import pick
from risklens.llm.words import text_column

SPACE = "▁"
#: Units in each of two generations that are looked up.
CACHE, LEAN = 300_000, 200_000
CACHED_LENGTH = 48
#: Characters after which the paths are first searched for a common boundary.
CHECK = 256
#: Windows of a long text whose pieces are kept.
WINDOWS = 4096
NEVER = float("-inf")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces with their ids and scores. Inside pieces a space is written as a space here."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [-1] * 256
        self.raw: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.raw.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                piece = piece.replace(SPACE, " ")
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.raw.append(piece.encode())
        self.longest = max(map(len, self.ids))
        self.unknown = min(self.scores.values()) - 10
        if min(self.byte_ids) < 0 or any("\n" in p and len(p) > 1 or " " in p.lstrip(" ") for p in self.ids):
            raise ValueError("the model needs byte pieces, and no piece that goes over a space or line feed")
        self.unit = self._units()
        # The score of every piece, None for what only begins one.
        self._prefix = {p[:n]: None for p in self.ids for n in range(1, len(p))} | self.scores

    def _units(self) -> re.Pattern:
        """Pattern of units, over whose ends no piece goes.

        A unit is a word or marks and the word after them, with the spaces before. Marks are the
        characters that pieces have only at the beginning, after a space or after other marks.
        """
        before: dict[str, set[str]] = {}
        for piece in self.ids:
            for a, b in zip(piece, piece[1:]):
                before.setdefault(b, set()).add(a)
        marks = {c for p in self.ids for c in p if not (c.isalpha() or c.isspace())}
        while bad := {c for c in marks if before.get(c, set()) - marks - {" "}}:
            marks -= bad
        m = "".join(map(re.escape, sorted(marks)))
        mark, word = (f"[{m}]", rf"[^ \n{m}]") if m else ("(?!)", r"[^ \n]")
        return re.compile(rf" *{word}+| *{mark}+{word}*| +|\n+")

    def bytes_of(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()]

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best segmentation of ``text``."""
        prefix, ids, longest, out = self._prefix.get, self.ids, self.longest, []
        # best[k], back[k]: best path to position base + k, and where its last piece begins (0 = base).
        base, reach, look, n = 0, 0, CHECK, len(text)
        room = [NEVER] * (min(n, CHECK) + longest)
        best, back = [0.0, *room], [0] * (len(room) + 1)
        known: dict[str, list[tuple[int, float]]] = {}  # in long texts windows repeat

        def commit(to: int) -> None:
            """Emit the pieces up to position base + to."""
            cuts = [to]
            while cuts[-1]:
                cuts.append(back[cuts[-1]])
            for a, b in zip(cuts[::-1], cuts[-2::-1]):
                piece = text[base + a:base + b]
                if piece in ids:
                    out.append(ids[piece])
                else:
                    out.extend(self.bytes_of(piece))

        for i in range(n):
            k = i - base
            if k >= look:
                joint = k if i == reach else self._joint(back, [p for p in range(k, reach - base + 1) if best[p] > NEVER], k)
                if joint:
                    commit(joint)
                    base, k = base + joint, k - joint
                    best = best[joint:]
                    back = [max(0, x - joint) for x in back[joint:]]
                # Each look goes back over what is open, so the next one waits until that has doubled.
                look = max(CHECK, 2 * k)
            if len(best) <= k + longest:
                best += room
                back += [0] * len(room)
            here, at = best[k], k
            if prefix(text[i]) is None:  # not a piece of its own
                total = here + self.unknown
                if total > best[k + 1]:
                    best[k + 1], back[k + 1] = total, k
                if i >= reach:
                    reach = i + 1
            if n >= CHECK:
                window = text[i:i + longest]
                if (found := known.get(window)) is None:
                    found = self._begun(window)
                    if len(known) < WINDOWS:
                        known[window] = found
                for size, score in found:
                    if here + score > best[k + size]:
                        best[k + size], back[k + size] = here + score, k
                if found and i + found[-1][0] > reach:
                    reach = i + found[-1][0]
                continue
            for j in range(i + 1, n + 1):
                score = prefix(text[i:j], False)
                if score is False:
                    break
                at += 1
                if score is not None:
                    total = here + score
                    if total > best[at]:
                        best[at], back[at] = total, k
                    if j > reach:
                        reach = j
        if n:
            commit(n - base)
        return out

    def _begun(self, window: str) -> list[tuple[int, float]]:
        """Lengths and scores of the pieces that a window begins with, by length."""
        found = []
        for size in range(1, len(window) + 1):
            score = self._prefix.get(window[:size], False)
            if score is False:
                break
            if score is not None:
                found.append((size, score))
        return found

    @staticmethod
    def _joint(back: list[int], ends: list[int], k: int) -> int:
        """The last position, k at most, that all paths to ``ends`` go through."""
        alive = sorted(set(ends))
        while len(alive) > 1:
            before = back[alive.pop()]
            at = bisect_left(alive, before)
            if at == len(alive) or alive[at] != before:
                alive.insert(at, before)
        return min(alive.pop(), k)

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")[1:]


class _Units(dict):
    """Ids of units as packed int32; the recently used short ones are kept, in two generations."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older, self.limit = vocabulary, {}, CACHE

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit) or array("i", self.vocabulary.viterbi(unit)).tobytes()
        if len(unit) <= CACHED_LENGTH:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[unit] = found
        return found


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Vocabulary, _Units]:
    vocabulary = Vocabulary(path)
    return vocabulary, _Units(vocabulary)


def encode_text(text: str, path: str) -> np.ndarray:
    vocabulary, units = _loaded(path)
    return np.frombuffer(b"".join(map(units.__getitem__, vocabulary.unit.findall(" " + text if text else ""))), dtype=np.int32)


def encode(docs: DataFrame, path: str, lean: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, exact): ids of every whole text; ``exact`` if they decode to it.

    ``lean`` keeps ``LEAN`` units in a generation, and one generation between tasks: for workers that other work shares.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, units = _loaded(path)
        units.limit = LEAN if lean else CACHE
        for b in batches:
            texts = text_column(b.column(1))
            for at in range(0, len(texts), 256):
                part = texts.slice(at, 256)
                ids, exact = [], []
                for text in part.to_pylist():
                    found = encode_text(text, path)
                    ids.append(found)
                    exact.append(vocabulary.decode(found.tolist()) == text)
                sizes = np.array([len(x) for x in ids], dtype=np.int32)
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum(sizes, out=offsets[1:])
                flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 256), pa.array(sizes.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(exact, pa.bool_())],
                    ["doc_id", "n_tokens", "ids", "exact"])
        if lean:
            units.older = {}  # the worker outlives its task
    plain = pick(docs, "doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, exact boolean")
