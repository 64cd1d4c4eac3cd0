"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Every text is turned into the statistics of ``STATS``. They are standardised over all documents and
mapped to ``FEATURES`` random cosines, whose inner products approximate a Gaussian kernel. Partitions
sum the normal equations of each fold, a reduction tree adds them up, and the driver solves systems of
``FEATURES`` + 1 unknowns. Scores of left-out folds, counted in ``BINS`` bins of equal width, give the
isotonic calibration. Nothing but the text enters a score.

Null text counts as empty and is scored like any text. Labels that are null are left out; labels that
repeat a doc_id count by their mean. Without any label, or with one class only, every score is the
mean label (0.5 without labels). Rows that repeat a doc_id are scored one by one, so ties don't matter. Statistics are
those of whole texts, however long. An empty table gives no rows. ``keep`` returns all columns, whatever their
names; the others read doc_id and text only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from risklens.llm.shared import own_names, pick, written
from risklens.llm.words import Words, mix, ngrams, runs, text_column

STATS = ("log_bytes", "log_words", "word_bytes", "word_bytes_sd", "log_longest_word", "upper", "digits",
         "stops", "symbols", "symbol_runs", "non_ascii", "lines", "distinct_words", "distinct_pairs",
         "top_word", "repeated_lines", "words_with_symbol", "words_all_upper", "log_longest_line")
FEATURES = 160
WIDTH = 3.0
RIDGE = 1e-4
FOLDS = 4
BINS = 4096
FAN_IN = 32
#: Rows of texts that are looked at together, in bytes.
BLOCK = 4 << 20


def _classes() -> np.ndarray:
    """Bit set of character classes for each byte."""
    c = np.zeros(256, dtype=np.uint8)
    c[65:91] |= 1
    c[48:58] |= 2
    c[[ord(x) for x in ".,;:?'\"()-"]] |= 4
    c[[b for b in range(33, 127) if not chr(b).isalnum() and not c[b] & 4]] |= 8
    c[128:] |= 16
    c[10] |= 32
    return c


_CLASS = _classes()


def _groups(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and size of each group of equal (doc, key)."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    fresh = np.ones(len(d), dtype=bool)
    fresh[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(fresh)
    return d[at], np.diff(np.append(at, len(d)))


def statistics(column) -> np.ndarray:
    """(texts, len(STATS)) statistics of whole texts."""
    w = Words(column)
    n = w.rows
    if not n:
        return np.zeros((0, len(STATS)))
    size = np.diff(w.offsets).astype(float)
    doc_of_byte = np.repeat(np.arange(n), np.diff(w.offsets))
    kind = _CLASS[w.data]
    share = lambda mask: np.bincount(doc_of_byte[mask], minlength=n) / np.maximum(size, 1)
    symbol = (kind & 8) > 0
    run = symbol.copy()
    run[1:] &= w.data[1:] == w.data[:-1]
    run[w.offsets[:-1][size > 0]] = False
    doc = w.doc_of()
    length = (w.end - w.start).astype(float)
    words = w.counts.astype(float)
    many = np.maximum(words, 1)
    mean = np.bincount(doc, weights=length, minlength=n) / many
    sd = np.sqrt(np.maximum(np.bincount(doc, weights=length ** 2, minlength=n) / many - mean ** 2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    gd, gn = _groups(doc, w.hash)
    top = np.zeros(n)
    np.maximum.at(top, gd, gn)
    at, pair_doc = runs(w.counts, 2)
    pd_, _ = _groups(pair_doc, ngrams(w.hash, 2)[at])
    pairs = np.maximum(words - 1, 1)
    in_word = lambda bit: np.add.reduceat(((kind & bit) > 0).astype(np.int64), w.start) if len(w.start) else np.zeros(0)
    last_symbol = symbol[w.end - 1] if len(w.start) else np.zeros(0, bool)
    upper = in_word(1) if len(w.start) else np.zeros(0)
    # Lines: hash of the words between line feeds.
    breaks = np.concatenate([[0], np.cumsum((kind & 32) > 0)])
    line = breaks[w.start] + doc if len(w.start) else np.zeros(0, np.int64)
    if len(line):
        fresh = np.ones(len(line), dtype=bool)
        fresh[1:] = line[1:] != line[:-1]
        first = np.flatnonzero(fresh)
        count = np.diff(np.append(first, len(line)))
        place = np.arange(len(line)) - np.repeat(first, count)
        line_hash = np.add.reduceat(mix(w.hash + place.astype(np.uint64)), first)
        line_doc = doc[first]
        ld, ln = _groups(line_doc, line_hash)
        n_lines = np.maximum(np.bincount(line_doc, minlength=n), 1)
        repeated = np.bincount(ld, weights=ln - 1, minlength=n) / n_lines
        longest_line = np.zeros(n)
        np.maximum.at(longest_line, line_doc, count)
    else:
        repeated, longest_line, n_lines = np.zeros(n), np.zeros(n), np.ones(n)
    return np.column_stack([
        np.log1p(size), np.log1p(words), mean, sd, np.log1p(longest), share((kind & 1) > 0),
        share((kind & 2) > 0), share((kind & 4) > 0), share(symbol), share(run), share((kind & 16) > 0),
        n_lines / many, np.log1p(np.bincount(gd, minlength=n)) / np.log1p(many), np.bincount(pd_, minlength=n) / pairs,
        top / many, repeated, np.bincount(doc, weights=last_symbol, minlength=n) / many,
        np.bincount(doc, weights=(upper >= np.maximum(length - 4, 2)) if len(doc) else None, minlength=n) / many,
        np.log1p(longest_line)])


def in_blocks(column, limit: int = BLOCK) -> Iterator[pa.Array]:
    """Slices of a text column of about ``limit`` bytes, never less than one text."""
    texts = text_column(column)
    size = np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield texts.slice(at, to - at)
        at = to


def stats_table(docs: DataFrame) -> DataFrame:
    """(doc_id, one column for each of STATS)."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [statistics(x) for x in in_blocks(b.column(1))] or [statistics(b.column(1))]
            table = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, table.T)], ["doc_id", *STATS])
    plain = pick(docs, "doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(compute, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATS))


@dataclass(frozen=True)
class Model:
    """A fitted classifier; a few hundred numbers."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = fourier(stats, self.mean, self.scale) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.levels), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A one and the random Fourier features of standardised statistics."""
    draw = np.random.default_rng(20)
    omega = draw.normal(0, 1 / WIDTH, (len(STATS), FEATURES))
    phase = draw.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip((stats - mean) / scale, -5, 5)
    return np.column_stack([np.ones(len(x)), np.sqrt(2 / FEATURES) * np.cos(x @ omega + phase)])


def _columns(batch) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.names.index(s)).to_numpy(zero_copy_only=False)
                            for s in STATS])


def _normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Sum over rows of [z, y][z, y]' by fold: partition sums, then a tree of additions."""
    side = FEATURES + 2

    def start(batches):
        from pyspark import TaskContext
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            names = b.schema.names
            y = b.column(names.index("y")).to_numpy(zero_copy_only=False)
            fold = b.column(names.index("fold")).to_numpy(zero_copy_only=False)
            z = np.column_stack([fourier(_columns(b), mean, scale), y])
            for k in np.unique(fold):
                part = z[fold == k]
                sums[k] = sums.get(k, 0) + part.T @ part
        yield record([(TaskContext.get().partitionId() // FAN_IN, k, s) for k, s in sums.items()])

    def record(items):
        return pa.RecordBatch.from_arrays(
            [pa.array([int(p) for p, _, _ in items], pa.int64()), pa.array([int(k) for _, k, _ in items], pa.int32()),
             pa.array([s.tobytes() for _, _, s in items], pa.binary())], ["part", "fold", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()).reshape(side, side) for x in table["sums"])
        return pa.Table.from_batches([record([(table["part"][0].as_py() // FAN_IN, table["fold"][0].as_py(), total)])])

    schema = "part long, fold int, sums binary"
    parts, sums = rows.rdd.getNumPartitions(), rows.mapInArrow(start, schema)
    while parts > 1:
        sums = sums.groupBy("part", "fold").applyInArrow(add, schema)
        parts = -(-parts // FAN_IN)
    found: dict[int, np.ndarray] = {}
    for r in sums.collect():  # FOLDS rows
        found[r["fold"]] = found.get(r["fold"], 0) + np.frombuffer(r["sums"]).reshape(side, side)
    return found


def _solve(sums: np.ndarray) -> np.ndarray:
    a, b = sums[:-1, :-1], sums[:-1, -1]
    return np.linalg.solve(a + RIDGE * max(a[0, 0], 1) * np.eye(len(a)), b)


def isotonic(n: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Non-decreasing fit to ``mean`` with weights ``n`` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for w, m in zip(n, mean):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, c2 = blocks.pop()
            w1, m1, c1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), c1 + c2]
    return np.concatenate([np.full(int(c), m) for _, m, c in blocks]) if blocks else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame, train: Column | None = None) -> Model:
    """Fit on the labelled rows of ``stats`` for which ``train`` holds.

    ``labels`` has doc_id and quality; ``train`` is a condition on doc_id.
    """
    known = pick(labels, "doc_id", "quality").where("quality is not null and doc_id is not null")
    if train is not None:
        known = known.where(train)
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("y"))
    whole = stats.agg(*[F.avg(s).alias(f"m_{s}") for s in STATS], *[F.stddev_pop(s).alias(f"d_{s}") for s in STATS]).first()
    mean = np.array([whole[f"m_{s}"] or 0.0 for s in STATS])
    scale = np.array([max(whole[f"d_{s}"] or 0.0, 1e-6) for s in STATS])
    rows = written(stats.join(known, "doc_id").withColumn(
        "fold", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(FOLDS)).cast("int")))
    sums = _normal_equations(rows, mean, scale)
    total = sum(sums.values()) if sums else np.zeros((FEATURES + 2, FEATURES + 2))
    n = total[0, 0]
    positives = total[0, -1]
    if n == 0 or positives <= 0 or positives >= n:
        level = positives / n if n else 0.5
        return Model(mean, scale, np.zeros(FEATURES + 1), np.array([0.0]), np.array([level]))
    left_out = {k: _solve(total - s) for k, s in sums.items()}

    def binned(batches):
        for b in batches:
            names = b.schema.names
            y = b.column(names.index("y")).to_numpy(zero_copy_only=False)
            fold = b.column(names.index("fold")).to_numpy(zero_copy_only=False)
            z, raw = fourier(_columns(b), mean, scale), np.zeros(len(fold))
            for k, w in left_out.items():
                raw[fold == k] = z[fold == k] @ w
            bin_ = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)
            count = np.bincount(bin_, minlength=BINS)
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(count[at]), pa.array(np.bincount(bin_, weights=y, minlength=BINS)[at])],
                ["bin", "n", "y"])

    bins = (rows.mapInArrow(binned, "bin long, n long, y double").groupBy("bin")
            .agg(F.sum("n").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect())  # BINS rows at most
    count = np.array([r["n"] for r in bins], dtype=float)
    level = isotonic(count, np.array([r["y"] for r in bins]) / count)
    centre = (np.array([r["bin"] for r in bins]) + 0.5) / BINS * 2 - 0.5
    # One knot at the weighted centre of each level; scores are interpolated between levels.
    values, at = np.unique(level, return_inverse=True)
    knots = np.bincount(at, weights=centre * count) / np.bincount(at, weights=count)
    return Model(mean, scale, _solve(total), knots, values)


def scores(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``stats``."""
    def apply(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_columns(b)))], ["doc_id", "score"])
    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(apply, f"doc_id {kind}, score double")


def score_column(text: Column, model: Model) -> Column:
    """The score of a text column, computed on Arrow batches; other columns stay in the JVM."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([model.score(statistics(x)) for x in in_blocks(texts)] or [np.zeros(0)]))
    return score(text)


@own_names("doc_id", "text")
def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches ``threshold``, with all their columns."""
    model = fit(written(stats_table(docs)), labels)
    return docs.where(score_column(F.col("text"), model) >= threshold)
