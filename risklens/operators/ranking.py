"""Order-based measures over scores: value buckets and the exact AUC."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from risklens.operators.quantiles import below, running_total
from risklens.operators.small import attach, pin

GRID = 31


def bucketed(df: DataFrame, x: str, out: str) -> DataFrame:
    """``df`` with the number of edges in ``_grid`` below ``x`` as ``out``, in place of ``_grid``.

    Steps of edges first, then those of one step: a comparison of each edge would make a method that the JVM no
    longer compiles.
    """
    steps, rest = below("_grid", "<", GRID, x)
    cols = [f"`{c}`" for c in df.columns]
    return (df.selectExpr(*cols, f"{steps} AS __grid")
            .selectExpr(*[c for c in cols if c != "`_grid`"], f"IF(_grid IS NULL, {GRID}, {rest}) AS {out}"))


def grid_edges(df: DataFrame, keys: list[str], x: str, accuracy: int = 2_000) -> DataFrame:
    """Pinned approximate quantile grid per key; it only balances buckets, never decides results."""
    probs = [(i + 1) / (GRID + 1) for i in range(GRID)]
    return pin(df.groupBy(*keys).agg(
        F.percentile_approx(x, probs, accuracy).alias("_grid")), max_rows=200_000)


def auc(scores: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    """Tie-aware area under the ROC curve per key.

    Rows collapse to distinct scores first, which are scored once and kept until the result, a row per key, is
    pinned; ranks come from a two-level running total, so a key that holds most of the rows is spread over its
    score buckets.
    """
    d = (scores.where(F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("_s"))
         .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))).persist()
    rows = attach(d, grid_edges(d, keys, "_s"), keys)
    rows = bucketed(rows.select(*keys, "_s", "_pos", "_neg", "_grid"), "_s", "_b")
    cum = running_total(rows, keys, "_b", [F.col("_s")], ["_neg"])
    below = (F.col("cum__neg") - F.col("_neg")).cast("double") + F.col("_neg") / 2
    out = (cum.groupBy(*keys)
            .agg(F.sum(F.col("_pos") * below).alias("_u"), F.sum("_pos").alias("n_pos"),
                 F.sum("_neg").alias("n_neg"))
            .select(*keys, "n_pos", "n_neg", F.try_divide(
                F.col("_u"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc")))
    out = pin(out)
    d.unpersist()
    return out
