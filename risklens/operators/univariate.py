"""Correlation with the target and bad-good mean difference, per (segment, feature)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from risklens.config import GATES, Roles
from risklens.functions.stats import t_p_value
from risklens.operators.segments import KEY, eligible, long_form


def moments(long: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """One row per key with the pairwise-complete moments the tests need.

    Rows collapse to one row per value of the target, from which all moments follow without cancellation.
    """
    per = long.groupBy(*keys, "y").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"),
                                       F.min("x").alias("lo"), F.max("x").alias("hi"))
    y, held = F.col("y"), F.col("n") > 0
    m = per.groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(y == v, F.col("n"))), F.lit(0)).alias(n) for v, n in ((1, "n_bad"), (0, "n_good"))],
        F.max(F.when(y == 1, F.col("m"))).alias("mean_bad"), F.max(F.when(y == 0, F.col("m"))).alias("mean_good"),
        *[F.max(F.when((y == v) & (F.col("n") > 1), F.col("v") * F.col("n") / (F.col("n") - 1))).alias(n) for v, n in ((1, "_vb"), (0, "_vg"))],
        F.min("lo").alias("_lo"), F.max("hi").alias("_hi"),
        F.array_sort(F.collect_list(F.when(held, F.struct(y.cast("double").alias("y"), F.col("n").alias("n"), "m", "v")))).alias("_c"))
    total = lambda of: f"aggregate(_c, 0D, (a, c) -> a + c.n * ({of}))"
    mean = lambda of: f"get(_c, 0).{of} + {total(f'c.{of} - get(_c, 0).{of}')} / n"
    samples = lambda of: f"IF(n > 1, {total(of)} / (n - 1), NULL)"
    m = m.selectExpr("*", f"{mean('m')} AS _x", f"{mean('y')} AS _y")
    # Class means of equal values may differ in their last digit, hence the look at the ends.
    flat = "_lo = _hi AND abs(_lo) < double('inf')"
    return m.selectExpr(
        *keys, "n", "n_bad", "n_good", "mean_bad", "mean_good", "_vb", "_vg",
        f"IF({flat} AND n > 1, 0D, sqrt({samples('c.v + (c.m - _x) * (c.m - _x)')})) AS _sx",
        f"sqrt({samples('(c.y - _y) * (c.y - _y)')}) AS _sy",
        f"IF({flat} AND n > 1, 0D, {samples('(c.m - _x) * (c.y - _y)')}) AS _cov")


def _pearson() -> Column:
    return F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sy"))


def _welch() -> tuple[Column, Column]:
    b, g = F.col("_vb") / F.col("n_bad"), F.col("_vg") / F.col("n_good")
    t = F.try_divide(F.col("mean_bad") - F.col("mean_good"), F.sqrt(b + g))
    dof = F.try_divide((b + g) * (b + g),
                       b * b / (F.col("n_bad") - 1) + g * g / (F.col("n_good") - 1))
    return t, dof


def _tests(m: DataFrame, missing: str) -> DataFrame:
    t, dof = _welch()
    both = (F.col("n_bad") > 1) & (F.col("n_good") > 1)
    varies = F.col("_sx") > 0
    diff = F.col("mean_bad") - F.col("mean_good")
    if missing == "pairwise":
        corr = F.when((F.col("n") > 2) & varies, _pearson()).otherwise(0.0)
        diff = F.coalesce(diff, F.lit(0.0))
        tested = both
    else:
        corr = F.when((F.col("n") >= GATES.min_n) & varies, F.coalesce(_pearson(), F.lit(0.0))
                      ).otherwise(0.0)
        tested = ((F.col("n_good") >= GATES.min_good_corr)
                  & (F.col("n_bad") >= GATES.min_bad_corr))
        diff = F.when(tested, diff).otherwise(0.0)
    return (m.withColumn("corr", corr).withColumn("mean_diff", diff)
            .withColumn("t_stat", F.when(tested, t)).withColumn("t_dof", F.when(tested, dof))
            .withColumn("_tested", tested))


def univariate(df: DataFrame, roles: Roles, *, missing: str = "pairwise", dims: bool = True,
               tags: bool = True, full: bool = False, p_values: bool = True) -> DataFrame:
    """Long table of r, mean difference, Welch t, dof and p of every eligible segment.

    ``missing`` is 'pairwise' (deletion) or 'zero' (fill with 0 before testing). Category groups
    need all three gates, tag groups only the class minima.
    """
    shape = dict(full=full, dims=dims, tags=tags)
    segs = eligible(df, roles, GATES.min_n, GATES.min_bad_corr, GATES.min_good_corr,
                    n_gate_on_tags=False, full_gated=True, **shape)
    long = long_form(df, roles, segs, **shape)
    if missing == "zero":
        long = long.withColumn("x", F.coalesce("x", F.lit(0.0)))
    out = _tests(moments(long), missing)
    cols = [*KEY, "n", "n_bad", "n_good", "corr", "mean_bad", "mean_good", "mean_diff", "t_stat",
            "t_dof"]
    if not p_values:
        return out.select(*cols)
    p = F.when(F.col("_tested"), t_p_value(F.col("t_stat"), F.col("t_dof"))).otherwise(1.0)
    return out.select(*cols, p.alias("p_value"))


def point_biserial(df: DataFrame, roles: Roles, p_values: bool = True) -> DataFrame:
    """Full-sample table: r and its p, class means, difference, Welch t and its p.

    r needs the sample minimum and variation on both sides, t needs the class minima; otherwise
    the cells stay null.
    """
    shape = dict(full=True, dims=False, tags=False)
    segs = eligible(df, roles, 0, 0, **shape)
    m = moments(long_form(df, roles, segs, **shape))
    t, dof = _welch()
    usable = (F.col("n") >= GATES.min_n) & (F.col("_sx") > 0) & (F.col("_sy") > 0)
    tested = (F.col("n_good") >= GATES.min_good_corr) & (F.col("n_bad") >= GATES.min_bad_corr)
    out = (m.withColumn("corr", F.when(usable, _pearson()))
           .withColumn("corr_t", F.col("corr") * F.sqrt(F.try_divide(
               (F.col("n") - 2).cast("double"), 1 - F.col("corr") * F.col("corr"))))
           .withColumn("mean_good", F.when(tested, F.col("mean_good")))
           .withColumn("mean_bad", F.when(tested, F.col("mean_bad")))
           .withColumn("mean_diff", F.col("mean_bad") - F.col("mean_good"))
           .withColumn("t_stat", F.when(tested, t)).withColumn("t_dof", F.when(tested, dof)))
    cols = ["feature", "n", "corr", "corr_t", "mean_good", "mean_bad", "mean_diff", "t_stat",
            "t_dof"]
    if not p_values:
        return out.select(*cols)
    return out.select(*cols, t_p_value("corr_t", (F.col("n") - 2).cast("double")).alias("corr_p"),
                      t_p_value("t_stat", "t_dof").alias("t_p"))


def dispersion(corr: DataFrame) -> DataFrame:
    """Spread of r across the groups of each dim (at least two groups)."""
    return (corr.where(F.col("corr").isNotNull()).groupBy("segment_dim", "feature")
            .agg(F.avg("corr").alias("corr_mean"), F.stddev_samp("corr").alias("corr_std"),
                 (F.max("corr") - F.min("corr")).alias("corr_range"),
                 F.count("*").alias("n_groups"))
            .where(F.col("n_groups") > 1))


def dispersion_summary(corr: DataFrame) -> DataFrame:
    """Dispersion averaged over the dims."""
    return (dispersion(corr).groupBy("feature")
            .agg(F.round(F.avg("corr_mean"), 4).alias("avg_corr"),
                 F.round(F.avg("corr_std"), 4).alias("avg_std"),
                 F.round(F.avg("corr_range"), 4).alias("avg_range"))
            .orderBy(F.desc("avg_range"), "feature"))


def to_matrix(long: DataFrame, features: list[str], value: str) -> DataFrame:
    """Segment rows x feature columns."""
    return (long.groupBy("segment_dim", "segment_name").pivot("feature", list(features))
            .agg(F.first(value)))


def to_long(matrix: DataFrame, features: list[str], value: str) -> DataFrame:
    """Matrix back to rows: empty cells dropped, absolute value added."""
    out = matrix.unpivot(["segment_dim", "segment_name"], list(features), "feature", value)
    return out.where(F.col(value).isNotNull()).withColumn(f"abs_{value}", F.abs(value))


def top_by(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key of a result table."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
