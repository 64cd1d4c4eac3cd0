"""Steps whose plans must not sort or gather more when the input or the number of groups grows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from risklens.config import Roles
from risklens.operators import iv as IV, quantiles as Q, univariate as U
from risklens.operators.segments import KEY, SEG, eligible, long_form

ROLES = Roles("id", "y", ("a", "b", "c", "d"), ("g",))


def entities(spark, n=4000):
    rng = np.random.default_rng(11)
    a = np.where(rng.random(n) < 0.05, np.nan, rng.normal(size=n))
    b = np.where(rng.random(n) < 0.93, 0.0, rng.exponential(3, n))
    pdf = pd.DataFrame({"id": range(n), "a": a, "b": b, "c": rng.integers(0, 7, n).astype(float), "d": np.nan,
                        "g": rng.choice(["u", "v", "w"], n, p=[0.9, 0.08, 0.02]), "y": (np.nan_to_num(a) + b / 4 + rng.normal(size=n) > 1).astype(int)})
    # A segment whose values lie in a single cell of the whole table.
    pdf.loc[pdf.g == "v", "a"] = 1 + pdf.a / 1000
    pdf["c"] = pdf.c.where(pdf.g != "w", np.inf)
    return spark.createDataFrame(pdf).withColumn("a", F.nanvl("a", F.lit(None).cast("double"))).withColumn("d", F.lit(None).cast("double"))


def celled(spark):
    df, shape = entities(spark), dict(full=True, dims=True, tags=False)
    segs = eligible(df, ROLES, 50, 5, **shape)
    return df, long_form(df, ROLES, segs, small_n=100, **shape), long_form(df, ROLES, segs, **shape)


def test_large_groups_are_bracketed_without_sketches_of_groups(spark, monkeypatch):
    monkeypatch.setattr(Q, "_sketch_big", lambda *a: pytest.fail("a sketch of each group"))
    _, long, _ = celled(spark)
    sk = Q.sketch(long, KEY, F.lit(10), small_n=100).collect()
    assert {r.feature for r in sk if not r.whole} == {"a", "b"}
    assert all(len(r.lo) == len(r.hi) == 9 and list(r.lo) == sorted(r.lo) for r in sk)


def test_medians_and_iv_of_cells_equal_those_of_whole_groups(spark):
    df, long, plain = celled(spark)
    by = lambda d: {tuple(r[k] for k in KEY): str(r["median"]) for r in d.collect()}
    got = by(Q.group_median(long, KEY, small_n=100))
    assert got == by(Q.group_median(plain, KEY, small_n=10**6)) and len(got) == 16
    iv = [IV.iv_segments(df, ROLES, full=True, min_bad=5, small_n=n).orderBy(*KEY).toPandas() for n in (100, 10**6)]
    pd.testing.assert_frame_equal(*iv, check_exact=False, rtol=1e-12)
    woe = [IV.woe_table(df, ROLES, small_n=n).orderBy(*KEY, "bin_no").toPandas() for n in (100, 10**6)]
    pd.testing.assert_frame_equal(*woe, check_exact=False, rtol=1e-12)


def test_brackets_hold_few_values(spark):
    _, long, _ = celled(spark)
    sk = Q.sketch(long, KEY, F.lit(10), small_n=1000)
    kept = Q.histogram(long, KEY, sk).where("v IS NOT NULL").groupBy(*SEG, "feature").count().collect()
    assert {r.feature: r["count"] for r in kept if r.segment_name == "u"}["a"] < 3600 * 0.06


def test_moments_come_from_one_row_per_class(spark):
    rng = np.random.default_rng(2)
    n = 900
    k = np.repeat(["mixed", "far", "flat", "one class", "single", "none"], n // 6)
    pdf = pd.DataFrame({"k": k, "x": rng.normal(size=n), "y": rng.integers(0, 2, n)})
    pdf.loc[pdf.k == "far", "x"] += 1e8
    pdf.loc[pdf.k == "flat", "x"] = 0.1
    pdf.loc[pdf.k == "one class", "y"] = 1
    pdf.loc[(pdf.k == "none") | ((pdf.k == "single") & (pdf.index != pdf[pdf.k == "single"].index[3])), "x"] = np.nan
    long = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None).cast("double")))
    x, y = F.col("x"), F.when(F.col("x").isNotNull(), F.col("y"))
    bad, good = F.when(y == 1, x), F.when(y == 0, x)
    want = long.groupBy("k").agg(
        F.count("x").alias("n"), F.count(bad).alias("n_bad"), F.count(good).alias("n_good"), F.avg(bad).alias("mean_bad"),
        F.avg(good).alias("mean_good"), F.var_samp(bad).alias("_vb"), F.var_samp(good).alias("_vg"), F.stddev_samp(x).alias("_sx"),
        F.stddev_samp(y).alias("_sy"), F.covar_samp(x, y.cast("double")).alias("_cov"))
    got = U.moments(long, ["k"])
    both = [d.select(*want.columns).orderBy("k").toPandas() for d in (got, want)]
    pd.testing.assert_frame_equal(*both, check_exact=False, rtol=1e-7, atol=1e-12)
    sd = both[0].set_index("k")["_sx"]
    assert sd["flat"] == 0 and np.isnan(sd["single"]) and np.isnan(sd["none"])
    # Of the raw rows only five aggregates, those of a class, are taken.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "stddev_samp" not in plan and "covar_samp" not in plan and plan.count("var_pop") == 1
