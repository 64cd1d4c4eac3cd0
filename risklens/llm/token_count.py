"""Token counts by byte-pair merging, without making ids.

A text's symbols are its characters; one outside the vocabulary counts as its UTF-8 bytes. They form
a linked list, and a heap holds the adjacent pairs whose concatenation is a piece, best score first
and leftmost first among equals. The lowest-rank pair is merged until none is left; the count is the
initial number of symbols less the number of merges. Merges stay within the vocabulary's units, over
whose ends no piece goes; the counts of frequent short units are kept.

Null text counts as empty and has no tokens; very long texts are counted whole. Rows are counted one by one, so repeated
rows and ties of doc_id give repeated results; an empty table gives none, and all columns but doc_id and text, also
those with clashing names, are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from risklens.llm.pieces import CACHED_LENGTH, SPACE, Vocabulary
from risklens.llm.shared import pick
from risklens.llm.words import text_column

CACHE = 800_000


def merged_count(text: str, vocabulary: Vocabulary) -> int:
    """Tokens of a text in which spaces stand for themselves."""
    scores, n = vocabulary.scores, len(text)
    count = sum(1 if c in scores else len((SPACE if c == " " else c).encode()) for c in text)
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(-scores[text[i:i + 2]], i, i + 2) for i in range(n - 1) if text[i:i + 2] in scores]
    heapq.heapify(heap)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = right[i]
        if end[i] == 0 or j >= n or end[j] != to:
            continue  # one of the two has been merged since
        count -= 1
        end[i], end[j], right[i] = to, 0, right[j]
        if right[i] < n:
            left[right[i]] = i
            after = end[right[i]]
            if text[i:after] in scores:
                heapq.heappush(heap, (-scores[text[i:after]], i, after))
        if left[i] >= 0 and text[left[i]:to] in scores:
            heapq.heappush(heap, (-scores[text[left[i]:to]], left[i], to))
    return count


class _Counts(dict):
    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, unit: str) -> int:
        found = merged_count(unit, self.vocabulary)
        if len(unit) <= CACHED_LENGTH:
            if len(self) >= CACHE:
                self.clear()
            self[unit] = found
        return found


@lru_cache(maxsize=2)
def _loaded(path: str) -> _Counts:
    return _Counts(Vocabulary(path))


def count_tokens(text: str, path: str) -> int:
    # The library's own reading: a literal U+2581 is the same as a space.
    plain = (" " + text).replace(SPACE, " ") if text else ""
    counts = _loaded(path)
    return sum(map(counts.__getitem__, counts.vocabulary.unit.findall(plain)))


def counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = text_column(b.column(1))
            tokens = [count_tokens(t.as_py(), path) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.compute.binary_length(texts).cast(pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([t > limit for t in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    plain = pick(docs, "doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
