"""Stratified folds and hold-outs against sorting each stratum."""

import pytest
from pyspark.sql import functions as F

from risklens.config import Roles
from risklens.operators import logistic as L, rules as RU, strata as ST


def by_sorting(values, n_folds):
    order = sorted(values)
    return [order[i * len(order) // n_folds] if i * len(order) // n_folds < len(order) else ST.NEVER for i in range(1, n_folds)]


@pytest.mark.parametrize("cell_rows", [50_000, 40, 1])
def test_cuts_are_exact_ranks(spark, monkeypatch, cell_rows):
    """One stratum holds most rows; more rounds of selection give the same cuts."""
    monkeypatch.setattr(ST, "CELL_ROWS", cell_rows)
    rows = spark.range(4000).select(
        F.when(F.col("id") < 7, F.concat(F.lit("s"), (F.col("id") % 3).cast("string"))).otherwise("hot").alias("g"),
        (F.col("id") % 2).cast("int").alias("y"), ST.key_hash(F.col("id"), "x").alias("h"))
    got = {(r.g, r.y): (r.n, r.cuts) for r in ST.cuts(rows, ["g", "y"], "h", ST.fold_starts(5)).collect()}
    held = {}
    for r in rows.collect():
        held.setdefault((r.g, r.y), []).append(r.h)
    assert got == {k: (len(v), by_sorting(v, 5)) for k, v in held.items()}
    folded = rows.join(ST.cuts(rows, ["g", "y"], "h", ST.fold_starts(5)), ["g", "y"])
    sizes = folded.groupBy("g", "y", ST.fold_of("h", "cuts").alias("fold")).count().collect()
    for k, v in held.items():
        n = sorted(r["count"] for r in sizes if (r.g, r.y) == k)
        assert sum(n) == len(v) and n[-1] - (n[0] if len(n) == 5 else 0) <= 1


def test_equal_and_null_keys_stay_together(spark):
    rows = spark.createDataFrame([(k, 0) for k in ["a"] * 30 + [None] * 20 + ["b"]], "id string, y int")
    rows = rows.select("y", "id", ST.key_hash(F.col("id"), "x").alias("h"))
    folded = rows.join(ST.cuts(rows, ["y"], "h", ST.fold_starts(5)), "y").select("id", ST.fold_of("h", "cuts").alias("fold"))
    assert folded.distinct().count() == 3


def test_no_rows_have_no_cuts(spark):
    rows = spark.createDataFrame([], "y int, h long")
    assert ST.cuts(rows, ["y"], "h", ST.fold_starts(5)).collect() == []


def test_models_use_stratified_folds(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"),
                                  F.when(F.col("id") % 4 == 0, "p").otherwise("q").alias("seg"))
    segs = spark.createDataFrame([("__all__", "__all__"), ("seg", "q")], "segment_dim string, segment_name string")
    begins = L.fold_cuts(df, Roles("id", "y", (), ("seg",)), segs)
    assert {(r.segment_dim, r.y): r.n for r in begins.collect()} == {("__all__", 0): 900, ("__all__", 1): 100, ("seg", 0): 700, ("seg", 1): 50}
    codes, n = L._with_codes(df, Roles("id", "y", (), ("seg",)), {("__all__", "__all__"): 0, ("seg", "q"): 1, ("seg", "p"): 2}, begins, True, True, False)
    assert n == 2
    sizes = {(r.y, r.fold_0): r["count"] for r in codes.groupBy("y", "fold_0").count().collect()}
    assert sizes == {(y, f): s for y, s in ((0, 180), (1, 20)) for f in range(5)}
    inner = {(r.y, r.fold_1): r["count"] for r in codes.where("s_1 = 1").groupBy("y", "fold_1").count().collect()}
    assert inner == {(y, f): s for y, s in ((0, 140), (1, 10)) for f in range(5)}
    assert {r.fold_1 for r in codes.where("s_1 = 2").collect()} == {0}  # a segment without folds


def test_holdout_keeps_the_share_of_each_class(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 9 == 0, 1).otherwise(0).alias("y"), (F.col("id") * 1.0).alias("a"),
                                  F.when(F.col("id") < 60, "few").otherwise("many").alias("seg"))
    roles = Roles("id", "y", ("a",), ("seg",))
    segs = RU.split_segments(df, roles, dims=("seg",))
    rows = RU.split_rows(df, roles, segs, dims=("seg",), holdout=0.3)
    got = {(r.segment_name, r.y): (r.n, r.test, r.both) for r in rows.groupBy("segment_name", "y").agg(
        F.count("*").alias("n"), F.count_if("test").alias("test"), F.count_if(F.col("test") & F.col("train")).alias("both")).collect()}
    for (name, _), (n, test, both) in got.items():
        assert (test, both) == ((n, n) if name == "few" else (int(n * 0.3 + 0.5), 0))
