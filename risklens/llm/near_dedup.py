"""Near duplicates by MinHash with banding, verification and connected components.

A document's set holds its distinct ``words``-word shingles (A-Z lower-cased; with fewer words, the whole
sequence). Documents with equal sets form one class. Each class has ``HASHES`` minima of universal
hashes; ``BANDS`` bands of ``ROWS`` minima put classes into buckets. At similarity 0.8 a pair shares no
bucket with probability 2e-8.

Pairs of a bucket are not listed. First every class is compared with one hub of each of its buckets.
Comparisons look at the signatures and, if these allow it, at the full sets, so every link is exact.
Then buckets that still hold several components are gone through in blocks of ``BLOCK`` classes: classes
of different components whose signatures allow it are compared on their full sets within the task,
which only gives the links it finds. Components of the confirmed links come from alternating large-star
and small-star, after the hubs and at the end.

Null text counts as empty; documents without words are linked with nothing. component_id is the
smallest doc_id of the component, null only if all its doc_ids are null. Rows that repeat a doc_id
are documents of their own; of equal best ones the first row counts. A very long text is one set like any other. An
empty table gives no rows. ``keep`` returns all columns, whatever their names; ``groups`` reads doc_id and text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from risklens.llm.components import components
from risklens.llm.quality import in_blocks
from risklens.llm.shared import own_names, pick, unused, written
from risklens.llm.words import Words, mix, ngrams, pair, runs

HASHES, BANDS, ROWS = 256, 40, 5
#: Standard deviations of the signature estimate below the threshold at which a pair is given up.
SLACK = 6.0
SLACK_SEARCH = 4.0
BLOCK = 1024


def shingles(column, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a block of texts, sorted within each text, and their bounds."""
    w = Words(column, lower=True)
    at, doc = runs(w.counts, words)
    hashes = ngrams(w.hash, words)[at]
    for few in range(1, words):
        rows = np.flatnonzero(w.counts == few)
        if len(rows):
            whole = w.hash[w.first[rows]]
            for k in range(1, few):
                whole = pair(whole, w.hash[w.first[rows] + k])
            hashes, doc = np.append(hashes, mix(whole + np.uint64(few))), np.append(doc, rows)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, doc = hashes[fresh], doc[fresh]
    return hashes, np.searchsorted(doc, np.arange(w.rows + 1))


def _universal() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11)
    return (draw.integers(0, 2 ** 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            draw.integers(0, 2 ** 63, HASHES, dtype=np.uint64))


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, HASHES) 16-bit fingerprints of the minima; rows of empty sets are zero."""
    out = np.zeros((len(bounds) - 1, HASHES), dtype=np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    a, b = _universal()
    step = 1 << 16  # elements that stay in cache
    i = 0
    while i < len(full):
        j = max(i + 1, int(np.searchsorted(bounds[full], bounds[full[i]] + step)))
        part = hashes[bounds[full[i]]:bounds[full[j - 1] + 1]]
        first = bounds[full[i:j]] - bounds[full[i]]
        for k in range(HASHES):
            out[full[i:j], k] = mix(np.minimum.reduceat(part * a[k] + b[k], first)).astype(np.uint16)
        i = j
    return out


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, h, n, d1, d2, sig): h hashes the text, (d1, d2) the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for block in in_blocks(b.column(2)):
                hashes, bounds = shingles(block, words)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(s)))]) for s in (1, 2)]
                d1, d2 = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
                sig = signatures(hashes, bounds)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(block)), b.column(1).slice(at, len(block)),
                     pa.array(np.diff(bounds).astype(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.array([x.tobytes() for x in sig], pa.binary())], ["doc_id", "h", "n", "d1", "d2", "sig"])
                at += len(block)
    plain = _keyed(docs)
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, h long, n long, d1 long, d2 long, sig binary")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return pick(docs, "doc_id", "text").select("doc_id", F.xxhash64(text).alias("h"), text.alias("text"))


def _key(sig: np.ndarray, band: int) -> np.ndarray:
    """Bucket of each signature in a band."""
    key = np.full(len(sig), band, dtype=np.uint64)
    for r in range(ROWS):
        key = pair(key, sig[:, band * ROWS + r].astype(np.uint64))
    return key


def _band_keys(sketches: DataFrame) -> DataFrame:
    """(key, node, doc_id): one row for each class and band."""
    def run(batches):
        for b in batches:
            if not len(b):
                continue
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), dtype=np.uint16).reshape(-1, HASHES)
            keys = [_key(sig, band) for band in range(BANDS)]
            rows = np.tile(np.arange(len(sig)), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), b.column(0).take(pa.array(rows)),
                                              b.column(1).take(pa.array(rows))], ["key", "node", "doc_id"])
    kind = sketches.schema["doc_id"].dataType.simpleString()
    return sketches.select("node", "doc_id", "sig").mapInArrow(run, f"key long, node long, doc_id {kind}")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, sig, grams): signature and full set of the wanted classes, from their texts."""
    def run(batches):
        for b in batches:
            at = 0
            for block in in_blocks(b.column(2)):
                hashes, bounds = shingles(block, words)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(block)), b.column(1).slice(at, len(block)),
                     pa.array([hashes[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    ["node", "sig", "grams"])
                at += len(block)
    docs = _keyed(docs).withColumnRenamed("doc_id", "id")
    found = docs.join(wanted.withColumnRenamed("h", "h_"), (F.col("h") == F.col("h_")) & F.col("id").eqNullSafe(F.col("doc_id")))
    found = found.select("node", "sig", "text", "m")
    if wanted.where("m > 1").limit(1).count():
        found = found.where("m = 1").unionByName(found.where("m > 1").dropDuplicates(["node"]))
    return found.select("node", "sig", "text").mapInArrow(run, "node long, sig binary, grams binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are at least ``similarity`` alike."""
    percent = round(similarity * 100)
    floor = similarity - SLACK * np.sqrt(similarity * (1 - similarity) / HASHES)

    def run(batches):
        for b in batches:
            keep = []
            x_sig, y_sig, x_set, y_set = (b.column(i) for i in range(2, 6))
            for i in range(len(b)):
                sx, sy = (np.frombuffer(c[i].as_buffer(), dtype=np.uint16) for c in (x_sig, y_sig))
                ok = (sx == sy).mean() >= floor
                if ok:
                    x, y = (np.frombuffer(c[i].as_buffer(), dtype=np.uint64) for c in (x_set, y_set))
                    ok = _alike(x, y, percent)
                keep.append(ok)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("sig").alias("a_sig"), F.col("grams").alias("a_set"))
    two = sets.select(F.col("node").alias("b"), F.col("sig").alias("b_sig"), F.col("grams").alias("b_set"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "a_sig", "b_sig", "a_set", "b_set")
    return both.mapInArrow(run, "a long, b long")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are at least ``percent`` per cent alike."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _searched(members: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between classes that share a bucket but not yet a component.

    Every such pair whose signatures allow it is confirmed on the full sets, in the first bucket that
    it shares, unless a link between the same two components was found there before.
    """
    percent = round(similarity * 100)
    floor = similarity - SLACK_SEARCH * np.sqrt(similarity * (1 - similarity) / HASHES)
    labelled = (members.select("key", "node").join(labels, "node", "left")
                .withColumn("label", F.coalesce("label", "node")))
    mixed = (labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"))
             .where("lo != hi").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rows = labelled.join(mixed, "key").join(sets, "node")
    own = F.pmod(F.hash("node"), "blocks")
    rows = (rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other"))
            .select("key", "one", "two", "own", "node", "label", "sig", "grams"))

    def search(group: pa.Table) -> pa.Table:
        group = group.take(pa.compute.sort_indices(group["node"]))
        node, label, own = (group[c].to_numpy() for c in ("node", "label", "own"))
        sig = np.frombuffer(b"".join(group["sig"].to_pylist()), dtype=np.uint16).reshape(-1, HASHES)
        banded = sig[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS)
        grams = group["grams"]
        band = next(k for k in range(BANDS) if _key(sig[:1], k).view(np.int64)[0] == group["key"][0].as_py())
        across = group["one"][0].as_py() != group["two"][0].as_py()
        _, inverse, count = np.unique(label, return_inverse=True, return_counts=True)
        largest = inverse == count.argmax()
        linked: set[tuple[int, int]] = set()
        a, b = [], []
        # Pairs within the largest component need no look; all others have a row outside it.
        for i in np.flatnonzero(~largest):
            other = (inverse != inverse[i]) & (largest | (node > node[i]))
            if across:
                other &= own != own[i]
            other = np.flatnonzero(other)
            other = other[(sig[other] == sig[i]).mean(axis=1) >= floor]
            for j in other[(banded[other, :band] != banded[i, :band]).any(axis=2).all(axis=1)]:
                ends = (min(inverse[i], inverse[j]), max(inverse[i], inverse[j]))
                if ends in linked:
                    continue
                x, y = (np.frombuffer(grams[int(k)].as_buffer(), dtype=np.uint64) for k in (i, j))
                if _alike(x, y, percent):
                    linked.add(ends)
                    a.append(node[i])
                    b.append(node[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("key", "one", "two").applyInArrow(search, "a long, b long")


def groups(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, h, row, n_shingles, component_id, component, best_row) of every document.

    ``h`` is the hash of the text, ``row`` a number of the row, ``component`` a number of the
    component (null without words) and ``best_row`` the row that stands for it.
    """
    sketches = written(_sketches(docs, words).withColumn("row", F.monotonically_increasing_id()))
    same = ["d1", "d2", "n"]
    classes = (sketches.where("n > 0").groupBy(*same, "doc_id", "h").agg(F.min("row").alias("row"), F.count("*").alias("m"))
               .groupBy(*same).agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "h", "m")).alias("r"))
               .select(*same, F.col("r.row").alias("node"), F.col("r.doc_id").alias("doc_id"), F.col("r.h").alias("h"), F.col("r.m").alias("m")))
    classes = written(classes)
    signed = sketches.select(F.col("row").alias("node"), "sig").join(classes, "node")
    members = _band_keys(signed)
    hub = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node"))
    hubs = (members.groupBy("key").agg(hub.alias("hub"), F.count("*").alias("size")).where("size > 1")
            .select("key", F.col("hub.node").alias("hub")))
    members = written(members.select("key", "node").join(hubs, "key"))
    wanted = written(signed.join(members.select("node").distinct(), "node").select("node", "doc_id", "h", "m", "sig"))
    sets = written(_sets(docs, wanted, words))
    pairs = members.where("node != hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = written(_confirmed(pairs, sets, similarity))
    labels = components(links)
    more = _searched(members, labels, sets, similarity)
    labels = components(more.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
    labelled = (classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
                .select(*same, "label", "doc_id", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node").alias("best")))
    best = labelled.groupBy("label").agg(F.min("best").alias("best"))
    named = labelled.select(*same, "label").join(best, "label").select(
        *same, F.col("label").alias("component"), F.col("best.doc_id").alias("component_id"), F.col("best.node").alias("best_row"))
    rows = sketches.select("doc_id", "h", "row", *same)
    return (rows.join(named, same, "left")
            .select("doc_id", "h", "row", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "component", F.when(F.col("n") > 0, F.col("best_row")).otherwise(F.col("row")).alias("best_row")))


@own_names("doc_id", "text")
def keep(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each component, and every document without words, with all columns."""
    id_, h = unused(docs, "kept_id"), unused(docs, "kept_hash")
    kept = written(groups(docs, words, similarity).groupBy(F.col("doc_id").alias(id_), F.col("h").alias(h))
                   .agg(F.count("*").alias("rows"), F.max(F.col("row") == F.col("best_row")).alias("stays"),
                        F.max("n_shingles").alias("n"))
                   .where("stays").select(id_, h, (F.col("n") > 0).alias("has_words"), "rows"))
    repeated = not kept.where("has_words and rows > 1").isEmpty()
    # Rows equal in doc_id and text: one stays, unless they have no words.
    once_, once = unused(docs, "kept_once"), F.col("has_words") & (F.col("rows") > 1)
    found = docs.join(
        kept.select(id_, h, once.alias(once_)),
        (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(h)) & F.col("doc_id").eqNullSafe(F.col(id_)))
    if not repeated:
        return found.select(*docs.columns)
    once = F.col(once_)
    return found.where(~once).select(*docs.columns).unionByName(
        found.where(once).dropDuplicates([id_, h]).select(*docs.columns))
