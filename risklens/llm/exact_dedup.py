"""Exact duplicates with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z; their SHA-256 stands for them. A
Misra-Gries summary of ``counters`` digests is made per partition and merged in a tree, so every
digest that holds more than 1/(counters + 1) of the rows is among the final candidates. An exact
count verifies them, and the verified winners (at most ``counters`` rows) are broadcast: rows of
frequent digests are settled where they lie. Only the remaining digests are shuffled, and none of
their groups exceeds that share.

Null text counts as empty. A null doc_id is smaller than any other. Of rows that also share the
doc_id, one stays, whichever: they are equal in both. Very long texts count by their digest like any other.
An empty table gives an empty result. ``keep`` returns all columns, whatever their names; ``groups`` reads doc_id and
text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from risklens.llm.shared import lower_ascii, own_names, pick, unused, written

COUNTERS = 4096
FAN_IN = 32


def _summary(table: pa.Table, counters: int) -> pa.Table:
    """Misra-Gries: add up equal digests, then subtract the (counters + 1)-th largest count."""
    table = table.group_by("digest").aggregate([("n", "sum")])
    n = table["n_sum"].to_numpy()
    if len(n) > counters:
        n = n - np.partition(n, len(n) - counters - 1)[len(n) - counters - 1]
    table = pa.table({"digest": table["digest"], "n": pa.array(n)})
    return table.filter(pa.array(n > 0))


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Candidates (digest) of a table of digests, at most ``counters`` of them."""
    def of(part: int, table: pa.Table) -> pa.Table:
        return pa.table({"part": pa.array(np.full(len(table), part, dtype=np.int64)),
                         "digest": table["digest"], "n": table["n"]})

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, known = TaskContext.get().partitionId() // FAN_IN, None
        for b in batches:
            new = pa.table({"digest": b.column(0), "n": pa.array(np.ones(len(b), dtype=np.int64))})
            known = _summary(new if known is None else pa.concat_tables([known, new]), counters)
        if known is not None:
            yield from of(part, known).combine_chunks().to_batches()

    def join(table: pa.Table) -> pa.Table:
        return of(table["part"][0].as_py() // FAN_IN, _summary(table.select(["digest", "n"]), counters))

    schema = "part long, digest binary, n long"
    summary = digests.select("digest").mapInArrow(start, schema)
    parts = -(-digests.rdd.getNumPartitions() // FAN_IN)
    while True:
        summary = summary.groupBy("part").applyInArrow(join, schema)
        if parts <= 1:
            return summary.select("digest")
        parts = -(-parts // FAN_IN)


def groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest (32 bytes)."""
    base = pick(docs, "doc_id", "text").select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)).alias("digest"))
    base = written(base)
    candidates = written(frequent(base, counters))
    # The row that stays: largest doc_id; of rows that share it, the first written.
    best = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", (-F.col("row")).alias("row")))
    counted = (base.join(F.broadcast(candidates), "digest").groupBy("digest")
               .agg(best.alias("best"), F.count("*").alias("group_size")))
    winners = written(counted.where("group_size > 1").select(
        "digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.row")).alias("keep_row"), "group_size"))
    marked = base.join(F.broadcast(winners), "digest", "left")
    heavy = marked.where("group_size is not null").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")
    same = Window.partitionBy("digest")
    light = (marked.where("group_size is null").select("doc_id", "row", "digest")
             .withColumn("best", best.over(same)).withColumn("group_size", F.count("*").over(same))
             .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                     (F.col("row") == -F.col("best.row")).alias("kept"), "digest"))
    return heavy.unionByName(light)


@own_names("doc_id", "text")
def keep(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns.

    Losers of frequent digests are dropped before the shuffle by the broadcast winners; the rest,
    ties included, is settled by one shuffle of whole rows.
    """
    digest, best, rank = unused(docs, "digest"), unused(docs, "best"), unused(docs, "rank")
    hashed = docs.withColumn(digest, F.unhex(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)))
    base = written(hashed.select("doc_id", F.col(digest).alias("digest")))
    winners = written(base.join(F.broadcast(written(frequent(base, counters))), "digest").groupBy("digest")
                      .agg(F.max("doc_id").alias(best), F.count("*").alias("n")).where("n > 1")
                      .select(F.col("digest").alias(digest), best, F.lit(True).alias(rank)))
    first = Window.partitionBy(digest).orderBy(F.col("doc_id").desc_nulls_last())
    return (hashed.join(F.broadcast(winners), digest, "left")
            .where(F.col(rank).isNull() | F.col("doc_id").eqNullSafe(F.col(best)))
            .withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
            .select(*docs.columns))
