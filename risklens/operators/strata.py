"""Exact stratified folds and hold-outs without sorting whole strata.

Rows of a stratum (a segment and a class, say) are ordered by a hash of their key; fold i holds the ranks from
floor(i n / folds) on, so fold sizes differ by one at most. Only the hashes at which folds begin are needed.
They are found by radix selection: an aggregation with map-side combine counts a stratum's rows by the leading
bits of the hash, running sums over these few counts say in which cell each wanted rank lies, and the rows of
such cells alone are counted by further bits, until a cell is small enough to be ranked. A stratum that holds
nearly all rows costs no more than any other, and nothing but cuts leaves the executors.

Rows with equal keys have equal hashes and stay together; a null key is a key. A stratum with fewer rows than
folds has empty folds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from risklens.operators.small import attach, pin

#: Bits of the hash, and how many of them each round looks at.
BITS, ROUND = 60, 10
#: Rows of a cell that one task may rank.
CELL_ROWS = 50_000
#: Beyond every hash: the cut of a rank that a stratum doesn't have.
NEVER = 1 << BITS


def key_hash(key: Column, salt: str) -> Column:
    """Integer in [0, 2^60) from the key and a salt."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{salt}"))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def fold_starts(folds: int) -> str:
    """SQL of the ranks, from 0, at which the folds after the first begin in a stratum of ``n`` rows."""
    return f"transform(sequence(1, {folds - 1}), i -> i * n div {folds})"


def share_start(share: float) -> str:
    """SQL of the rank that ends the first ``share`` of a stratum's ``n`` rows, rounded half up."""
    return f"array(CAST(floor(n * {share!r}D + 0.5D) AS BIGINT))"


def _located(counts: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """(keys, i, rank, cell, size): the cell of each wanted rank and its rank in it.

    ``counts`` has (keys, cell, size), ``wanted`` (keys, i, rank).
    """
    before = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.withColumn("_o", F.coalesce(F.sum("size").over(before), F.lit(0)))
    inside = (F.col("rank") >= F.col("_o")) & (F.col("rank") < F.col("_o") + F.col("size"))
    return cells.join(wanted, keys).where(inside).select(*keys, "i", (F.col("rank") - F.col("_o")).alias("rank"), "cell", "size")


def cuts(rows: DataFrame, keys: list[str], hash_: str, ranks: str) -> DataFrame:
    """Pinned (keys, n, cuts): the hashes at the wanted ranks of every stratum.

    ``ranks`` is SQL of an array of ranks that may use the number of rows ``n``; a rank of n or more has the cut
    ``NEVER``. Keys must not be null.
    """
    rows = rows.select(*keys, F.col(hash_).alias("h"))
    shift = BITS - ROUND
    # A stratum of some size has rows in nearly each of the 2^ROUND cells.
    counts = pin(rows.groupBy(*keys, F.shiftright("h", shift).alias("cell")).agg(F.count("*").alias("size")), many=True)
    sizes = pin(counts.groupBy(*keys).agg(F.sum("size").alias("n")))
    asked = sizes.select(*keys, "n", F.posexplode(F.expr(ranks)).alias("i", "rank"))
    wanted = pin(_located(counts, keys, asked.select(*keys, "i", F.col("rank").cast("bigint").alias("rank"))))
    # ``cell`` is the leading bits of the hash so far, so it stays part of the key.
    while shift > 0 and (wanted.agg(F.max("size")).first()[0] or 0) > CELL_ROWS:
        cell = F.shiftright("h", shift).alias("_c")
        own = pin(wanted.select(*keys, F.col("cell").alias("_c")).distinct())
        shift -= ROUND
        inner = attach(rows.select(*keys, "h", cell), own, [*keys, "_c"])
        counts = pin(inner.groupBy(*keys, "_c", F.shiftright("h", shift).alias("cell")).agg(F.count("*").alias("size")))
        wanted = pin(_located(counts, [*keys, "_c"], wanted.select(*keys, F.col("cell").alias("_c"), "i", "rank")).drop("_c"))
    own = pin(wanted.select(*keys, F.col("cell").alias("_c")).distinct())
    inner = attach(rows.select(*keys, "h", F.shiftright("h", shift).alias("_c")), own, [*keys, "_c"])
    place = Window.partitionBy(*keys, "_c").orderBy("h")
    ranked = inner.withColumn("rank", (F.row_number().over(place) - 1).cast("bigint"))
    found = (ranked.join(wanted.select(*keys, F.col("cell").alias("_c"), "i", "rank"), [*keys, "_c", "rank"])
             .select(*keys, "i", "h"))
    all_cuts = asked.select(*keys, "n", "i").join(found, [*keys, "i"], "left")
    return pin(all_cuts.groupBy(*keys, "n").agg(F.array_sort(F.collect_list(F.coalesce("h", F.lit(NEVER).cast("bigint")))).alias("cuts")))


def fold_of(hash_: str, cuts_: str) -> Column:
    """Fold of a row from its hash and the cuts of its stratum."""
    return F.expr(f"size(filter({cuts_}, c -> {hash_} >= c))")
