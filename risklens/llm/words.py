"""Words of Arrow text columns as 64-bit hashes, computed on the column's bytes.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form feed and
carriage return. Its hash is the sum, modulo 2^64, of one pseudo-random number for each (position in
the word, byte), so equal words have equal hashes and different ones collide as random numbers do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Word positions whose numbers come from a table; later ones are computed.
TABLE = 48
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit numbers (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive combination of two hashes."""
    return mix(a * _U(0x9E3779B97F4A7C15) + (b ^ (b >> _U(29))))


_TABLE = mix(np.arange(1, TABLE * 256 + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


def text_column(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One large_string array without nulls; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


class Words:
    """Hashes, document numbers and byte spans of all words of a batch of texts."""

    def __init__(self, column, lower: bool = False):
        texts = text_column(column)
        self.rows = len(texts)
        if self.rows:
            raw = np.frombuffer(texts.buffers()[1], dtype=np.int64,
                                count=self.rows + 1 + texts.offset)[texts.offset:]
            data = texts.buffers()[2]
            at, to = int(raw[0]), int(raw[-1])
            data = np.frombuffer(data, dtype=np.uint8, count=to)[at:] if to > at else np.zeros(0, np.uint8)
            offsets = raw - at
        else:
            data, offsets = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.data, self.offsets = data, offsets
        inside = ~_SEPARATOR[data]
        # A text's first byte starts a word even where the text before it ends in one.
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: Index of the first word of each text, and one past the last word.
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        self.hash = self._hash(_LOWER[data] if lower else data)

    def _hash(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.start), dtype=np.uint64)
        step = 1 << 18
        for i in range(0, len(out), step):
            s, e = self.start[i:i + step], self.end[i:i + step]
            n = e - s
            base = np.zeros(len(n), dtype=np.int64)
            np.cumsum(n[:-1], out=base[1:])
            place = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(base, n)
            code = data[np.repeat(s, n) + place].astype(np.int64)
            index = place * 256 + code
            if len(n) and n.max() > TABLE:
                far = place >= TABLE
                number = _TABLE[np.where(far, 0, index)]
                number[far] = mix((index[far] + 1).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
            else:
                number = _TABLE[index]
            out[i:i + step] = np.add.reduceat(number, base) if len(n) else 0
        return mix(out)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position; the caller drops runs that cross texts."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    done, acc, width, power = 0, None, 1, hashes
    while True:
        if n & width:
            part = power[done:]
            if acc is None:
                acc = part
            else:
                size = min(len(acc), len(part))
                acc = pair(acc[:size], part[:size] + _U(width))
            done += width
        if width * 2 > n:
            return acc[:len(hashes) - n + 1]
        power = pair(power[:len(power) - width], power[width:])
        width *= 2


def runs(counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index and document number of every n-word run inside one text."""
    size = np.maximum(counts - n + 1, 0)
    first = np.zeros(len(counts), dtype=np.int64)
    np.cumsum(counts[:-1], out=first[1:])
    doc = np.repeat(np.arange(len(counts)), size)
    base = np.zeros(len(counts), dtype=np.int64)
    np.cumsum(size[:-1], out=base[1:])
    return np.arange(int(size.sum())) - base[doc] + first[doc], doc


class Spans(Words):
    """Hashes of given byte spans, none of them empty; the same as those of words with these bytes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.start, self.end = data, start, end
        self.hash = self._hash(data)
