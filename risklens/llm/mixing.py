"""Mixing sources to target weights by pivotal dependent rounding.

Sources, in code point order with null last, weigh ``weights``, repeating. They share ``budget`` times
all words by weight; a target stops at ``limit`` times its source's words and the excess is shared
again until none is above. A document's expected copies are its source's target over its source's
words. The whole part is fixed; fractional parts are paired: words are moved at random from one to the
other until one is a whole number, the other goes on to the next pair. Expected copies stay as they
are, and so does the sum of words of each pair.

Pairs are formed within groups of about ``GROUP`` documents, what each group leaves open is combined
in groups of groups, up to one last group for each source. There a document's partner is all smaller open ones
together, so that a source misses its target by the words of a small document where it has enough of them.
Draws are hashes of the row, so reruns agree. Rows that agree in all key columns are one unit of the sum of
their copies, which are then dealt evenly among them.

Null text counts as empty, and documents of no words take part with one word's weight. A null source
is a source. Without words all targets are 0. A very long text is a document of many words like any other. Ties of
size are taken in the order of the draws. An empty table gives no rows. ``expand`` keeps all columns, whatever
their names; ``taken`` reads doc_id, source and text only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from risklens.llm.shared import written
from risklens.llm.words import mix

WEIGHTS = (5, 2, 1)
LIMIT = 3
BUDGET = 1.0
GROUP = 2048
#: Sources whose targets may be broadcast.
BROADCAST_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(units: DataFrame, weights=WEIGHTS, limit: int = LIMIT, budget: float = BUDGET) -> DataFrame:
    """(source, source_size, n_units, target) of units (source, size, m)."""
    spark = units.sparkSession
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                          F.count("*").alias("n_units"))
    ordered = written(sources).orderBy(F.col("source").asc_nulls_last())
    ranked = ordered.rdd.zipWithIndex().map(lambda x: (*x[0], weights[x[1] % len(weights)]))
    schema = T.StructType([*ordered.schema.fields, T.StructField("weight", T.LongType())])
    table = written(spark.createDataFrame(ranked, schema))
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * budget
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > F.col("source_size") * limit
        x = table.agg(F.count(F.when(full, 1)).alias("n"), F.sum(F.when(full, F.col("source_size") * limit)).alias("held"),
                      F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if x["n"] == capped:
            break
        capped = x["n"]
        level = (total - (x["held"] or 0)) / x["open"] if x["open"] else float("inf")
    target = F.least(F.col("weight") * F.lit(level), (F.col("source_size") * limit).cast("double"))
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(target) if total else F.lit(0.0)
    return table.select("source", "source_size", "n_units", target.alias("target"))


def _pivot(size: np.ndarray, part: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Round ``part`` to 0 and 1 one pair after another; the place of the open one, or -1."""
    part, held = part.copy(), -1
    for i in np.argsort(-size, kind="stable"):
        if part[i] <= 0.0 or part[i] >= 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        to_a = min(size[a] * (1 - part[a]), size[b] * part[b])
        to_b = min(size[a] * part[a], size[b] * (1 - part[b]))
        if draw[i] * (to_a + to_b) < to_b:
            fills, empties = size[a] * (1 - part[a]) <= to_a, size[b] * part[b] <= to_a
            part[a], part[b] = (1.0 if fills else part[a] + to_a / size[a]), (0.0 if empties else part[b] - to_a / size[b])
        else:
            empties, fills = size[a] * part[a] <= to_b, size[b] * (1 - part[b]) <= to_b
            part[a], part[b] = (0.0 if empties else part[a] - to_b / size[a]), (1.0 if fills else part[b] + to_b / size[b])
        open_ = [x for x in (a, b) if 0.0 < part[x] < 1.0]
        held = open_[0] if open_ else -1
    return part, held


def _uniform(raw: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit hashes."""
    return (raw >> np.uint64(11)).astype(float) / 2.0 ** 53


def _settled(size: np.ndarray, part: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Round all of the last group's parts.

    From the largest on, each document is paired with all smaller open ones together. These give or take
    words in proportion to how far their parts are from 0 and 1, the same for either outcome, until the
    document or one of them is a whole number. So many small documents make up for a large one, and
    expected copies stay; only the last open document is drawn without a partner.
    """
    part, order = part.copy(), np.argsort(-size, kind="stable")
    for at, i in enumerate(order):
        step = 0
        while 0.0 < part[i] < 1.0:
            step += 1
            draw = float(_uniform(mix(raw[i:i + 1] + np.uint64(step)))[0])
            rest = order[at + 1:]
            rest = rest[(part[rest] > 0.0) & (part[rest] < 1.0)]
            if not len(rest):
                part[i] = float(draw < part[i])
                break
            slack = np.minimum(part[rest], 1.0 - part[rest])
            words = float((size[rest] * slack).sum())
            fill, empty = size[i] * (1 - part[i]), size[i] * part[i]
            up, down = min(fill, words), min(empty, words)
            if draw * (up + down) < down:
                part[i] = 1.0 if up == fill else part[i] + up / size[i]
                part[rest] = np.where((up == words) & (part[rest] <= 0.5), 0.0, part[rest] - slack * (up / words))
            else:
                part[i] = 0.0 if down == empty else part[i] - down / size[i]
                part[rest] = np.where((down == words) & (part[rest] >= 0.5), 1.0, part[rest] + slack * (down / words))
    return part


def copies(units: DataFrame, keys: list[str], seed: int = 7, **options) -> DataFrame:
    """``units`` (keys, source, size, m; keys are unique with source and size) and how often they are taken.

    Adds source_size, target and copies, the copies of all m rows together.
    """
    table = targets(units, **options)
    few = table.count()
    units = units.withColumnsRenamed({"source": "_source"}).join(
        F.broadcast(table) if few <= BROADCAST_ROWS else table, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * F.col("m")).otherwise(0.0)
    row = F.xxhash64(*[F.col(k) for k in keys], "source", "size", F.lit(seed))
    units = (units.withColumn("_expected", expected).withColumn("copies", F.floor("_expected").cast("long"))
             .withColumn("_part", F.col("_expected") - F.col("copies")).withColumn("_draw", row)
             .withColumn("_group", F.pmod(F.hash("_draw"), F.ceil(F.col("n_units") / GROUP)))
             .withColumn("_open", F.lit(True)).drop("_expected"))
    depth = int(table.agg(F.max(F.ceil(F.col("n_units") / GROUP))).first()[0] or 1)
    schema, names, level, done = units.schema, units.columns, 0, None

    def round_group(level: int, last: bool):
        def run(group: pa.Table) -> pa.Table:
            col = lambda n: group[n].to_numpy()
            order = np.argsort(col("_draw"), kind="stable")  # rows come in any order
            group = group.take(pa.array(order))
            size = np.maximum(col("size"), 1).astype(float)
            raw = mix(col("_draw").view(np.uint64) + np.uint64(level * 7919 + 1))
            part, held = (_settled(size, col("_part"), raw), -1) if last else _pivot(size, col("_part"), _uniform(raw))
            open_ = np.zeros(len(part), dtype=bool)
            if held >= 0:
                open_[held] = True
            taken = col("copies") + (part >= 1.0)
            new = {"copies": pa.array(taken), "_part": pa.array(np.where(open_, part, 0.0)), "_open": pa.array(open_),
                   "_group": pa.array(col("_group") // GROUP)}
            return pa.table([new.get(n, group[n]) for n in names], names=names).cast(group.schema)
        return run

    while True:
        last = depth <= 1
        units = units.groupBy("source", "_group").applyInArrow(round_group(level, last), schema)
        if last:
            settled = units
        else:
            units = written(units)
            settled, units = units.where("not _open"), units.where("_open")
        done = settled if done is None else done.unionByName(settled)
        if last:
            return done.drop("_part", "_draw", "_group", "_open", "n_units")
        depth, level = -(-depth // GROUP), level + 1


def taken(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row of ``docs``."""
    from risklens.llm.shared import pick
    units = (pick(docs, "doc_id", "source", "text").select("doc_id", "source", word_count(F.col("text")).alias("size"))
             .groupBy("doc_id", "source", "size").agg(F.count("*").alias("m")))
    found = copies(written(units), ["doc_id"], **options)
    each = F.floor(F.col("copies") / F.col("m")) + F.when(F.col("_nth") <= F.col("copies") % F.col("m"), 1).otherwise(0)
    return (found.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), "m"))).withColumn("copies", each.cast("long"))
            .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def expand(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as the mix takes it, with all its columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: n for c, n in reversed(list(zip(docs.columns, names)))}
    plain = docs.toDF(*names)
    nulls = F.array(*[F.col(n).isNull() for n in names])
    keyed = plain.withColumn("k1", F.xxhash64(nulls, *names)).withColumn("k2", F.xxhash64(F.lit(1), nulls, *names))
    units = (keyed.select("k1", "k2", F.col(at["source"]).alias("source"), word_count(F.col(at["text"])).alias("size"))
             .groupBy("k1", "k2", "source", "size").agg(F.count("*").alias("m")))
    found = copies(written(units), ["k1", "k2"], **options).where("copies > 0").select("k1", "k2", "copies")
    return (keyed.dropDuplicates(["k1", "k2"]).join(found, ["k1", "k2"])
            .withColumn("k1", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)]))
