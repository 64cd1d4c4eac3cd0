"""How often the operators read their input, and that their generated code stays small enough to be compiled."""

import re

import numpy as np
import pandas as pd

from risklens.config import Roles
from risklens.operators import logistic as L, quantiles as Q, ranking as R, registry as RG, rules as RU


def counted(spark, pdf):
    """The rows, and how many of them have been read so far."""
    read, df = spark.sparkContext.accumulator(0), spark.createDataFrame(pdf)

    def run(batches):
        for b in batches:
            read.add(len(b))
            yield b

    return df.mapInPandas(run, df.schema), read


def entities(n=1200):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=n).round(2), rng.integers(0, 9, n).astype(float)
    return pd.DataFrame({"id": range(n), "a": a, "b": b, "y": (a + b / 4 + rng.normal(size=n) > 2).astype(int)})


def test_median_and_quantiles_read_rows_twice(spark):
    pdf = pd.DataFrame({"g": np.arange(300) % 3, "x": np.arange(300.0), "y": np.arange(300) % 2})
    for run in (lambda d: Q.group_median(d, ["g"]), lambda d: Q.group_quantiles(d, ["g"], [0.1, 0.5])):
        df, read = counted(spark, pdf)
        assert run(df).count() == 3
        assert read.value <= 600


def test_median_with_more_aggregates(spark):
    from pyspark.sql import functions as F
    pdf = pd.DataFrame({"g": [1, 1, 1, 2], "x": [1.0, 2.0, 6.0, 5.0], "y": [0, 1, 0, 1]})
    got = {r.g: (r.median, r.m) for r in Q.group_median(spark.createDataFrame(pdf), ["g"], {"m": F.avg("x")}).collect()}
    assert got == {1: (2.0, 3.0), 2: (5.0, 5.0)}


def test_auc_scores_rows_once(spark):
    pdf = pd.DataFrame({"g": np.arange(200) % 2, "s": np.arange(200.0), "y": np.arange(200) // 4 % 2})
    df, read = counted(spark, pdf)
    assert R.auc(df, ["g"], "s", "y").count() == 2
    assert read.value <= 200


def test_newton_steps_and_tree_levels_keep_rows(spark):
    pdf, roles = entities(), Roles("id", "y", ("a", "b"))
    df, read = counted(spark, pdf)
    assert L.fit_segments(df, roles).coefs.count() == 2
    assert read.value <= 7 * len(pdf)
    df, read = counted(spark, pdf)
    RU.mine(df, roles).count()
    assert read.value <= 6 * len(pdf)


def test_steps_of_edges_count_as_all_edges_do(spark):
    edges = [float("-inf"), *[float(i // 2) for i in range(17)], float("inf")]
    df = spark.createDataFrame([(float(i) / 2, edges) for i in range(-2, 20)], "x double, hi array<double>")
    for op in ("<", "<="):
        steps, rest = Q.below("hi", op, 19)
        for r in df.selectExpr("*", f"{steps} AS _hi").selectExpr("x", f"{rest} AS k").collect():
            assert r.k == sum(e < r.x or (op == "<=" and e == r.x) for e in edges)


def test_histogram_of_twenty_bins_is_compiled(spark):
    """The JVM interprets methods beyond 8,000 bytes."""
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        long = spark.createDataFrame([("s", "f", 1.0, 0)], "a string, b string, x double, y int")
        sk = spark.createDataFrame([("s", "f", [0.0] * 19, [1.0] * 19)], "a string, b string, lo array<double>, hi array<double>")
        plans = Q.histogram(long, ["a", "b"], sk, 19)._jdf.queryExecution().debug().codegenToSeq()
        assert max(plans.apply(i)._3().maxMethodCodeSize() for i in range(plans.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)


def test_top_similar_picks_once_per_word_set(spark, capsys):
    a = spark.createDataFrame([("a1", "cash flow"), ("a2", "flow cash"), ("a1", "net debt"), (None, "cash flow")], "ind_code string, ind_name string")
    b = spark.createDataFrame([(f"b{i}", n) for i, n in enumerate(["cash flow", "net debt", "cash flow", "flow cash net", "debt"])],
                              "ind_code string, ind_name string")
    out = RG.top_similar(a, b, k=2)
    got = sorted((r.a_code or "", r.b_code, r["rank"]) for r in out.collect())
    assert got == [("", "b0", 1), ("", "b2", 2), ("a1", "b0", 1), ("a1", "b1", 2), ("a2", "b0", 1), ("a2", "b2", 2)]
    out.explain()
    assert re.search(r"windowspecdefinition\(a#\d+", capsys.readouterr().out)
