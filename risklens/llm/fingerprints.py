"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A text's paragraphs are its lines; a line is cut further after words whose hash is a multiple of
``CUT``, so that an edit changes only the paragraphs around it. A paragraph's digest covers its words
and how often it came before in the text; its lowest 8 bits hold its number of words (255 and more as 255).
Every digest is added to three cells of a table. Subtracting two tables leaves the differing
digests, and peeling cells that hold a single one recovers them. Where ``CELLS`` cells are too few, both
texts are entered anew into tables four times as large, until peeling ends. The likeness of two
texts is the words of common paragraphs over the words of all paragraphs.

For the comparison with the following document the texts are dealt out by ranges of doc_id and go
through each range in order; only the first and last text of each range are joined across ranges.

Null text counts as empty; two empty texts have likeness 1, an empty and another one 0. Documents are
ordered by doc_id, null last, then by a hash of the text, so rows that repeat a doc_id follow each other;
a table of one row is followed by that row. A very long text has the same number of cells as any other. An empty
table gives no rows; columns other than doc_id and text, also ones with clashing names, are left out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from risklens.llm.shared import pick, spread, written
from risklens.llm.words import Words, mix

CUT = 4
CELLS = 24
GROW = 4
HASHED = 3
#: Texts that are looked at together, and their bytes.
BLOCK_ROWS, BLOCK_BYTES = 512, 3 << 20
_U = np.uint64
_FIELDS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
           "n_paragraphs", "n_differing")
_SCHEMA = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, n_paragraphs long, n_differing long")


class Paragraphs:
    """Digests of all paragraphs of a block of texts, and the text each belongs to."""

    def __init__(self, texts: list[str]):
        w = Words(pa.array(texts, pa.large_string()))
        self.rows = w.rows
        doc = w.doc_of()
        if not len(doc):
            self.key, self.doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        line = np.concatenate([[0], np.cumsum(w.data == 10)])[w.start]
        last = np.ones(len(doc), dtype=bool)
        last[:-1] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1]) | (w.hash[:-1] % _U(CUT) == 0)
        first = np.append(0, np.flatnonzero(last)[:-1] + 1)
        size = np.diff(np.append(first, len(doc)))
        place = np.arange(len(doc)) - np.repeat(first, size)
        digest = np.add.reduceat(mix(w.hash + place.astype(np.uint64) * _U(0x9E3779B97F4A7C15)), first)
        doc = doc[first]
        # How often the same paragraph came before in its text.
        order = np.lexsort((digest, doc))
        d, g = doc[order], digest[order]
        fresh = np.ones(len(d), dtype=bool)
        fresh[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
        start = np.flatnonzero(fresh)
        before = np.empty(len(d), dtype=np.uint64)
        before[order] = np.arange(len(d)) - np.repeat(start, np.diff(np.append(start, len(d))))
        self.key = (mix(digest + before * _U(0xD1B54A32D192ED03)) & ~_U(255)) | np.minimum(size, 255).astype(np.uint64)
        self.doc = doc

    def part(self, a: int, b: int) -> Paragraphs:
        """The texts from a to b."""
        out = object.__new__(Paragraphs)
        i, j = np.searchsorted(self.doc, [a, b])
        out.rows, out.key, out.doc = b - a, self.key[i:j], self.doc[i:j] - a
        return out

    def only(self, rows: np.ndarray) -> Paragraphs:
        out = object.__new__(Paragraphs)
        new = np.full(self.rows, -1)
        new[rows] = np.arange(len(rows))
        keep = new[self.doc] >= 0
        out.rows, out.key, out.doc = len(rows), self.key[keep], new[self.doc[keep]]
        return out

    def words(self) -> np.ndarray:
        return np.bincount(self.doc, weights=(self.key & _U(255)).astype(float), minlength=self.rows)


class Tables:
    """One table of ``cells`` cells for each text: counts, digest sums and check sums."""

    def __init__(self, p: Paragraphs, cells: int):
        self.rows, self.cells = p.rows, cells
        self.count = np.zeros(p.rows * cells, dtype=np.int64)
        self.sums = np.zeros(p.rows * cells, dtype=np.uint64)
        self.checks = np.zeros(p.rows * cells, dtype=np.uint64)
        self.add(p.doc, p.key, np.ones(len(p.key), dtype=np.int64))

    def places(self, doc: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
        third = self.cells // HASHED
        return [doc * self.cells + k * third + (mix(key + _U(977 * k + 1)) % _U(third)).astype(np.int64)
                for k in range(HASHED)]

    @staticmethod
    def check(key: np.ndarray) -> np.ndarray:
        return mix(key ^ _U(0xA0761D6478BD642F)) & _U(0xFFFFFFFF)

    def add(self, doc: np.ndarray, key: np.ndarray, sign: np.ndarray) -> None:
        signed, check = key * sign.astype(np.uint64), self.check(key) * sign.astype(np.uint64)
        for at in self.places(doc, key):
            np.add.at(self.count, at, sign)
            np.add.at(self.sums, at, signed)
            np.add.at(self.checks, at, check)

    def minus(self, other: Tables) -> Tables:
        self.count -= other.count
        self.sums -= other.sums
        self.checks -= other.checks
        return self

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, digest and sign of what could be recovered, and which texts were recovered in full."""
        found: list[tuple[np.ndarray, ...]] = []
        while True:
            at = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[at]
            key, check = self.sums[at] * sign.astype(np.uint64), self.checks[at] * sign.astype(np.uint64)
            doc = at // self.cells
            pure = check == self.check(key)
            pure &= np.any([p == at for p in self.places(doc, key)], axis=0) if len(at) else pure
            doc, key, sign = doc[pure], key[pure], sign[pure]
            if not len(doc):
                break
            order = np.lexsort((key, doc))
            doc, key, sign = doc[order], key[order], sign[order]
            fresh = np.ones(len(doc), dtype=bool)
            fresh[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
            doc, key, sign = doc[fresh], key[fresh], sign[fresh]
            found.append((doc, key, sign))
            self.add(doc, key, -sign)
        rest = (self.count != 0) | (self.sums != 0) | (self.checks != 0)
        whole = ~rest.reshape(self.rows, self.cells).any(axis=1)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), whole
        return (*(np.concatenate(x) for x in zip(*found)), whole)

    def strings(self, p: Paragraphs) -> list[str]:
        """Tables as text: number of paragraphs, digest sums, lower 16 bits of counts and of check sums."""
        head = np.bincount(p.doc, minlength=p.rows).astype("<u8")
        sums = self.sums.astype("<u8").reshape(self.rows, -1)
        rest = np.column_stack([self.count.astype("<u2"), self.checks.astype("<u2")]).reshape(self.rows, -1)
        return [base64.b64encode(h.tobytes() + s.tobytes() + r.tobytes()).decode() for h, s, r in zip(head, sums, rest)]


def likeness(a: Paragraphs, b: Paragraphs) -> tuple[np.ndarray, np.ndarray]:
    """Likeness of each text of ``a`` to that of ``b``, and the number of differing digests."""
    left, differing = np.zeros(a.rows), np.zeros(a.rows, dtype=np.int64)
    total_a, total_b = a.words(), b.words()
    rows, cells = np.arange(a.rows), CELLS
    while len(rows):
        x, y = a.only(rows), b.only(rows)
        doc, key, sign, whole = Tables(x, cells).minus(Tables(y, cells)).peel()
        most = np.bincount(x.doc, minlength=len(rows)) + np.bincount(y.doc, minlength=len(rows))
        stuck = ~whole & (cells > 64 * most + 64 * CELLS)
        for r in np.flatnonzero(stuck):  # two digests that share all cells: compare directly
            own, other = x.key[x.doc == r], y.key[y.doc == r]
            keep = doc != r
            one, two = np.setdiff1d(own, other), np.setdiff1d(other, own)
            doc = np.concatenate([doc[keep], np.full(len(one) + len(two), r)])
            key = np.concatenate([key[keep], one, two])
            sign = np.concatenate([sign[keep], np.ones(len(one), np.int64), -np.ones(len(two), np.int64)])
        done = whole | stuck
        mine = sign > 0
        lost = np.bincount(doc[mine], weights=(key[mine] & _U(255)).astype(float), minlength=len(rows))
        differing[rows[done]] = np.bincount(doc, minlength=len(rows))[done]
        left[rows[done]] = total_a[rows[done]] - lost[done]
        rows, cells = rows[~done], cells * GROW
    union = total_a + total_b - left
    return np.where(union > 0, left / np.maximum(union, 1), 1.0), differing


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first characters of the following document."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def compare(texts: list[str], following: str) -> list[pa.Array]:
    """Result columns of consecutive texts, the last of which is followed by ``following``."""
    n = len(texts)
    after = [*texts[1:], following]
    changed = [edited(t, f) for t, f in zip(texts, after)]
    both = Paragraphs([*texts, following])
    own, nexts, new = both.part(0, n), both.part(1, n + 1), Paragraphs(changed)
    near_edited, differing = likeness(own, new)
    near_next, _ = likeness(own, nexts)
    return [pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(Tables(own, CELLS).strings(own), pa.string()), pa.array(Tables(new, CELLS).strings(new), pa.string()),
            pa.array(near_edited), pa.array(near_next),
            pa.array(np.bincount(own.doc, minlength=n).astype(np.int64)), pa.array(differing)]


def _batch(ids: list, columns: list[pa.Array], part: int, kind: str, texts: list, id_type: pa.DataType) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, id_type), *columns, pa.array([part] * n, pa.int64()), pa.array([kind] * n, pa.string()), pa.array(texts, pa.string())],
        ["doc_id", *_FIELDS, "part", "kind", "text"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, ... of every row."""
    spark = docs.sparkSession
    plain = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    kind = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, ids, texts, size, seen = TaskContext.get().partitionId(), [], [], 0, False
        for b in batches:
            id_type = b.column(0).type
            for id_, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if not seen:
                    yield _batch([id_], [pa.nulls(1, f) for f in _TYPES], part, "head", [text], id_type)
                    seen = True
                if len(ids) >= BLOCK_ROWS or size > BLOCK_BYTES:
                    yield _batch(ids, compare(texts, text), part, "row", [None] * len(ids), id_type)
                    ids, texts, size = [], [], 0
                ids.append(id_)
                texts.append(text)
                size += len(text)
        if len(ids) > 1:
            yield _batch(ids[:-1], compare(texts[:-1], texts[-1]), part, "row", [None] * (len(ids) - 1), id_type)
        if ids:
            yield _batch(ids[-1:], [pa.nulls(1, f) for f in _TYPES], part, "tail", texts[-1:], id_type)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                text, following = b.column(1)[i].as_py(), b.column(2)[i].as_py()
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), *compare([text], following)], ["doc_id", *_FIELDS])

    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    ranged = plain.repartitionByRange(max(2, spread(spark)), *order).sortWithinPartitions(*order)
    table = written(ranged.mapInArrow(run, f"doc_id {kind}, {_SCHEMA}, part long, kind string, text string"))
    parts = sorted(r["part"] for r in table.where("kind = 'head'").select("part").collect())  # one number for each range
    before = spark.createDataFrame([(p, parts[i - 1]) for i, p in enumerate(parts)], "part long, before long")
    heads = table.where("kind = 'head'").join(F.broadcast(before), "part").select(
        F.col("before").alias("part"), F.col("text").alias("following"))
    edges = table.where("kind = 'tail'").select("doc_id", "part", "text").join(heads, "part").select("doc_id", "text", "following")
    return table.where("kind = 'row'").select("doc_id", *_FIELDS).unionByName(
        edges.mapInArrow(across, f"doc_id {kind}, {_SCHEMA}"))


_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
