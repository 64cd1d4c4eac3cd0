"""Byte-level byte-pair encoding and decoding by a two-tier look-up.

A pattern splits texts into pre-tokens. The first tier answers those that are in the vocabulary as a whole:
a minimal perfect hash (hash and displace) sends each of the n keys to a slot of its own among n; a
pre-token whose bytes equal the key in its slot is one token, and all pre-tokens of a block are looked up at
once. The second tier encodes the others: their bytes are a linked list, and a heap holds the adjacent
pairs that are tokens, lowest rank first, leftmost among equals; the best is merged until none is left.
Pairs of bytes that are no token end as single bytes. Ids are those of the library for the same ranks
and pattern, special strings being ordinary text.

Null text counts as empty and has no ids; decoding gives the text's bytes back, whatever the ids. Texts past
``LONG`` characters are split into pre-tokens part by part, cut before single spaces between two words, where
a pre-token begins anyhow. Rows are encoded one by one, so repeated rows and ties of doc_id give repeated
results; an empty table gives none, and all columns but doc_id and text, also those with clashing names, are
left out.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from risklens.llm.quality import in_blocks
from risklens.llm.shared import pick
from risklens.llm.words import Spans, mix

#: Keys for each bucket of the hash, displacements tried at once.
BUCKET, TRIES = 4, 512
_STEP = np.uint64(0x9E3779B97F4A7C15)
LONG = 1 << 20
#: Bytes of texts that are encoded together.
BLOCK = 2 << 20
#: Pieces in each of two generations that are kept, and their length at most.
CACHE, CACHED_LENGTH = 300_000, 48
#: Ids that are decoded together.
TOGETHER = 1 << 20


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit numbers: slots 0 to n - 1, one for each."""

    def __init__(self, keys: np.ndarray, shift: np.ndarray | None = None):
        self.size = n = len(keys)
        self.buckets = max(1, -(-n // BUCKET))
        if shift is not None:  # found before for the same keys
            self.shift = shift
            return
        bucket = (keys % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        first = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        #: Displacement of a bucket, or -1 - slot of its only key.
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        taken = np.zeros(n, dtype=bool)
        alone = []
        for b in np.argsort(-np.diff(first), kind="stable"):
            own = keys[order[first[b]:first[b + 1]]]
            if len(own) == 1:
                alone.append(b)
            elif len(own):
                start = 0
                while True:
                    slots = self._slots(own[None, :], np.arange(start, start + TRIES)[:, None])
                    slots.sort(axis=1)
                    fits = ~taken[slots].any(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1)
                    if fits.any():
                        self.shift[b] = start + fits.argmax()
                        taken[slots[fits.argmax()]] = True
                        break
                    start += TRIES
        self.shift[alone] = -1 - np.flatnonzero(~taken)[:len(alone)]

    def _slots(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys + (shift.astype(np.uint64) + np.uint64(1)) * _STEP) % np.uint64(self.size)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Slots of known keys; some slot for any other number."""
        shift = self.shift[(keys % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, self._slots(keys, np.maximum(shift, 0)))


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What all spans hold, one after the other."""
    base = np.zeros(len(size), dtype=np.int64)
    np.cumsum(size[:-1], out=base[1:])
    return data[np.arange(int(size.sum())) + np.repeat(start - base, size)]


class Ranks:
    """Tokens by rank, with the perfect hash of them all."""

    def __init__(self, tokens: dict[bytes, int], shift: np.ndarray | None = None):
        if any(bytes([b]) not in tokens for b in range(256)) or b"" in tokens:
            raise ValueError("the ranks need all single bytes, and no empty token")
        keys = sorted(tokens, key=tokens.__getitem__)
        data = np.frombuffer(b"".join(keys), dtype=np.uint8)
        size = np.array([len(k) for k in keys], dtype=np.int64)
        start = np.cumsum(size) - size
        hashes = Spans(data, start, start + size).hash
        if len(np.unique(hashes)) < len(keys):
            raise ValueError("two tokens have the same 64-bit hash")
        self.find = PerfectHash(hashes, shift)
        slot = self.find(hashes)
        self.data, self.start, self.size = data, np.empty_like(start), np.empty_like(size)
        self.rank = np.empty(len(keys), dtype=np.int32)
        self.start[slot], self.size[slot] = start, size
        self.rank[slot] = [tokens[k] for k in keys]
        #: Slot of every id, -1 for numbers that are no id.
        self.slot = np.full(int(self.rank.max()) + 1, -1, dtype=np.int64)
        self.slot[self.rank] = np.arange(len(keys))
        self.tokens, self.missed = tokens, _Missed(self)

    def whole(self, pieces: pa.Array) -> np.ndarray:
        """Rank of each piece (a large_binary array) that is a token as a whole, -1 for the others."""
        offsets = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2], dtype=np.uint8)
        start, size = offsets[:-1], np.diff(offsets)
        slot = self.find(Spans(data, start, offsets[1:]).hash)
        at = np.flatnonzero(self.size[slot] == size)
        if len(at):
            same = _gather(data, start[at], size[at]) == _gather(self.data, self.start[slot[at]], size[at])
            bounds = np.cumsum(size[at]) - size[at]
            at = at[np.logical_and.reduceat(same, bounds)]
        out = np.full(len(pieces), -1, dtype=np.int32)
        out[at] = self.rank[slot[at]]
        return out

    def merged(self, piece: bytes) -> list[int]:
        """Ranks of a piece by merging pairs of its bytes, each token being known by where it begins."""
        tokens, get, n = self.tokens, self.tokens.get, len(piece)
        shift = n.bit_length()
        place = (1 << shift) - 1
        right, left = list(range(1, n + 1)), list(range(-1, n))
        # Rank of the pair that begins at each place; heap entries that differ from it are out of date.
        pair = [get(piece[i:i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        heap = [r << shift | i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i = entry & place
            if pair[i] != entry >> shift:
                continue
            middle = right[i]
            after = right[i] = right[middle]
            pair[middle] = -1
            if after < n:
                left[after] = i
                pair[i] = r = get(piece[i:right[after]], -1)
                if r >= 0:
                    heappush(heap, r << shift | i)
            else:
                pair[i] = -1
            before = left[i]
            if before >= 0:
                pair[before] = r = get(piece[before:after], -1)
                if r >= 0:
                    heappush(heap, r << shift | before)
        out, i = [], 0
        while i < n:
            out.append(tokens[piece[i:right[i]]])
            i = right[i]
        return out

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and where those of each piece begin."""
        if not pieces:
            return np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        rank = self.whole(pa.array(pieces, pa.large_string()).view(pa.large_binary()))
        hit = rank >= 0
        found = [self.missed[pieces[i]] for i in np.flatnonzero(~hit).tolist()]
        size = np.ones(len(pieces), dtype=np.int64)
        size[~hit] = np.array(list(map(len, found)), dtype=np.int64) // 4
        bounds = np.zeros(len(pieces) + 1, dtype=np.int64)
        np.cumsum(size, out=bounds[1:])
        flat = np.empty(int(bounds[-1]), dtype=np.int32)
        rest = np.ones(len(flat), dtype=bool)
        rest[bounds[:-1][hit]] = False
        flat[~rest] = rank[hit]
        flat[rest] = np.frombuffer(b"".join(found), dtype=np.int32)
        return flat, bounds

    def text(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.slot) or self.slot[ids].min() < 0):
            raise ValueError("an id that is no token")
        slot = self.slot[ids]
        return _gather(self.data, self.start[slot], self.size[slot])


class _Missed(dict):
    """Packed ranks of pieces that are no tokens; those of short pieces are kept, in two generations."""

    def __init__(self, ranks: Ranks):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece) or array("i", self.ranks.merged(piece.encode())).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


@lru_cache(maxsize=2)
def load(path: str, shift: bytes | None = None) -> Ranks:
    """The ranks of a file. ``shift`` spares the search for the perfect hash where it is known."""
    with open(path, "rb") as lines:
        tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, lines)))}
    return Ranks(tokens, None if shift is None else np.frombuffer(shift, dtype=np.int64))


def split(text: str, pattern, cut) -> Iterator[list[str]]:
    """Pre-tokens of a text, part by part."""
    at = 0
    while len(text) - at > LONG and (m := cut.search(text, at + LONG)):
        yield pattern.findall(text, at, m.start() + 1)
        at = m.start() + 1
    yield pattern.findall(text, at)


def encode_texts(texts: list[str], ranks: Ranks, pattern, cut) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and their numbers."""
    flats, counts = [], np.zeros(len(texts), dtype=np.int64)
    held, owners = [], []

    def look_up() -> None:
        flat, bounds = ranks.ids(held)
        ends = bounds[np.cumsum([n for _, n in owners])]
        np.add.at(counts, [doc for doc, _ in owners], np.diff(ends, prepend=0))
        flats.append(flat)
        held.clear()
        owners.clear()

    for doc, text in enumerate(texts):
        for pieces in split(text, pattern, cut):
            held += pieces
            owners.append((doc, len(pieces)))
            if len(held) > LONG:
                look_up()
    if owners:
        look_up()
    return np.concatenate(flats) if flats else np.zeros(0, dtype=np.int32), counts


def decode_ids(flat: np.ndarray, ranks: Ranks) -> np.ndarray:
    """The bytes of all ids."""
    return np.concatenate([np.zeros(0, np.uint8), *(ranks.text(flat[i:i + TOGETHER]) for i in range(0, len(flat), TOGETHER))])


def _bounds(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=out[1:])
    return out


def _decoded(flat: np.ndarray, counts: np.ndarray, ranks: Ranks) -> pa.Array:
    """One binary value for each text, whose ids lie one after the other."""
    size = np.append(0, np.cumsum(ranks.size[ranks.slot[flat]]))
    ends = size[np.cumsum(counts)].astype(np.int32) if len(counts) else np.zeros(0, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(np.append(np.int32(0), ends)),
                                                            pa.py_buffer(decode_ids(flat, ranks))])


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of every whole text; with ``decoded`` also the bytes that the ids stand for."""
    shift = load(path).find.shift.tobytes()
    names = ["doc_id", "n_tokens", "ids", *["decoded"] * decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        ranks, compiled, cut = load(path, shift), regex.compile(pattern), regex.compile(r"\S (?=\S)")
        for b in batches:
            at = 0
            for block in in_blocks(b.column(1), BLOCK):
                flat, counts = encode_texts(block.to_pylist(), ranks, compiled, cut)
                ids = pa.ListArray.from_arrays(pa.array(_bounds(counts)), pa.array(flat))
                back = [_decoded(flat, counts, ranks)] if decoded else []
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(block)), pa.array(counts), ids, *back], names)
                at += len(block)
    plain = pick(docs, "doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that ids, none of them null, stand for; null for null."""
    shift = load(path).find.shift.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load(path, shift)
        for b in batches:
            column = b.column(1)
            texts = [decode_ids(ids.values.to_numpy(), ranks).tobytes() if ids.is_valid else None for ids in column]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])
    plain = pick(encoded, "doc_id", "ids")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
