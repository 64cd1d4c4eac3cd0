"""Single-feature threshold candidates per (segment, feature) pair, all pairs in shared passes."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from risklens.config import THRESHOLDS as T, Roles
from risklens.functions.labels import stars
from risklens.functions.stats import chi2_1_p_value
from risklens.operators.quantiles import group_median, group_quantiles
from risklens.operators.segments import KEY, SEG, long_form, segment_sizes
from risklens.operators.small import attach, derived, pin


def read_pairs(df: DataFrame) -> DataFrame:
    """Pair list: the three key columns are required, incomplete rows are dropped."""
    missing = [c for c in KEY if c not in df.columns]
    if missing:
        raise ValueError(f"pair list lacks {missing}")
    return df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in KEY]).dropna().distinct()


def pair_rows(df: DataFrame, roles: Roles, pairs: DataFrame, **shape) -> DataFrame:
    """Long rows of the listed pairs only."""
    segs = pin(pairs.select(*SEG).distinct())
    long = long_form(df, roles, segs, **shape)
    return attach(long, derived(pairs, pairs.select(*KEY)), KEY)


def pair_ledger(df: DataFrame, roles: Roles, pairs: DataFrame, **shape) -> DataFrame:
    """Every pair with its counts and the first reason to skip it (null: analysed)."""
    dims = [*roles.dims, "__all__", *(["__tag__"] if roles.tags else [])]
    sizes = segment_sizes(df, roles, **shape).select(*SEG, "n", "n_bad")
    stats = pair_rows(df, roles, pairs, **shape).groupBy(*KEY).agg(
        F.count("x").alias("n_valid"), F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    out = pairs.join(sizes, SEG, "left").join(stats, KEY, "left")
    n, bad = F.col("n"), F.col("n_bad")
    reason = (F.when(~F.col("segment_dim").isin(dims), "dim_missing")
              .when(~F.col("feature").isin(list(roles.features)), "feature_missing")
              .when(n.isNull(), "no_rows").when(n < T.min_n, "n").when(bad < T.min_bad, "bad")
              .when((bad == n) | (bad == 0), "single_class")
              .when((F.coalesce("n_valid", F.lit(0)) == 0) | (F.col("_lo") == F.col("_hi")),
                    "no_variation"))
    return out.select(*KEY, "n", "n_bad", "n_valid", reason.alias("skip_reason"))


def filled(long: DataFrame, medians: DataFrame) -> DataFrame:
    """Missing values replaced by the pair's median; the raw value stays in ``raw``."""
    rows = attach(long, derived(medians, medians.select(*KEY, "median")), KEY)
    return rows.withColumn("raw", F.col("x")).withColumn("x", F.coalesce("x", "median"))


def pre_bins(rows: DataFrame, n_bins: int = T.pre_bins) -> DataFrame:
    """Quantile pre-bins of the filled values: counts and upper edge of each bin."""
    q = group_quantiles(rows.select(*KEY, "x", "y"), KEY, [i / n_bins for i in range(1, n_bins)])
    edges = derived(q, q.select(*KEY, F.array_distinct("q").alias("edges")))
    hit = "size(filter(edges, e -> e < x))"
    binned = attach(rows, edges, KEY).select(*KEY, "x", "y", "edges", F.expr(hit).alias("bin"))
    return (binned.groupBy(*KEY, "bin")
            .agg(F.count("*").alias("n"), F.count_if(F.col("y") == 1).alias("n_bad"),
                 F.min("x").alias("x_min"), F.max("x").alias("x_max"),
                 F.first(F.get("edges", F.col("bin"))).alias("hi")))


_MERGED = ("segment_dim string, segment_name string, feature string, bin int, lo double, hi double, "
           "n bigint, n_bad bigint")
_MIN_SHARE, _MAX_BINS = T.min_bin_share, T.max_bins


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """Best monotone grouping of at most twenty pre-bins: dynamic programme over the bin borders."""
    pdf = pdf.sort_values("bin")
    n, bad = pdf["n"].to_numpy(float), pdf["n_bad"].to_numpy(float)
    cn, cb = np.r_[0, n.cumsum()], np.r_[0, bad.cumsum()]
    total, tb = cn[-1], cb[-1]
    tg, m = total - tb, len(n)
    floor = _MIN_SHARE * total

    def value(i: int, j: int) -> float:
        b = max(cb[j] - cb[i], 0.5)
        g = max(cn[j] - cn[i] - (cb[j] - cb[i]), 0.5)
        return (g / tg - b / tb) * math.log((g / tg) / (b / tb))

    best = (0.0, [0, m])
    for sign in (1, -1):
        # state: (start, end) of the last bin at each bin count
        layer = {(0, j): (value(0, j), [0, j]) for j in range(1, m + 1) if cn[j] >= floor}
        for _ in range(_MAX_BINS - 1):
            for (i, j), (iv, cuts) in layer.items():
                if j == m and iv > best[0] + 1e-12 and len(cuts) > 2:
                    best = (iv, cuts)
            nxt: dict = {}
            for (i, j), (iv, cuts) in layer.items():
                rate = (cb[j] - cb[i]) / (cn[j] - cn[i])
                for k in range(j + 1, m + 1):
                    if cn[k] - cn[j] < floor:
                        continue
                    if sign * ((cb[k] - cb[j]) / (cn[k] - cn[j]) - rate) <= 0:
                        continue
                    cand = iv + value(j, k)
                    if (j, k) not in nxt or cand > nxt[j, k][0]:
                        nxt[j, k] = (cand, [*cuts, k])
            layer = nxt
        for (i, j), (iv, cuts) in layer.items():
            if j == m and iv > best[0] + 1e-12:
                best = (iv, cuts)
    cuts = best[1]
    hi = pdf["hi"].to_numpy(float)
    ends = [math.nan if e == m else hi[e - 1] for e in cuts[1:]]
    out = pd.DataFrame({"bin": range(len(ends)), "lo": [math.nan, *ends[:-1]], "hi": ends,
                        "n": np.diff(cn[cuts]).astype("int64"),
                        "n_bad": np.diff(cb[cuts]).astype("int64")})
    for c in ("segment_dim", "segment_name", "feature"):
        out[c] = pdf[c].iloc[0]
    return out[["segment_dim", "segment_name", "feature", "bin", "lo", "hi", "n", "n_bad"]]


def merged_bins(bins: DataFrame) -> DataFrame:
    """Supervised monotone bins (a group holds at most ``pre_bins`` rows)."""
    out = bins.select(*KEY, "bin", "n", "n_bad", "hi").groupBy(*KEY).applyInPandas(_merge, _MERGED)
    nan = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return out.select(*KEY, "bin", nan("lo"), nan("hi"), "n", "n_bad")


def zero_inflated(rows: DataFrame, medians: DataFrame, share: float = T.zero_inflated) -> DataFrame:
    """Pairs where one value covers most rows. Such a value is the median, so no histogram is
    needed: one comparison per row decides."""
    long = attach(rows, derived(medians, medians.select(*KEY, F.col("median").alias("_med"))), KEY)
    return (long.groupBy(*KEY, F.col("_med").alias("mode_x"))
            .agg(F.count("x").alias("n_valid"), F.count_if(F.col("x") == F.col("_med")).alias("n_mode"))
            .withColumn("mode_share", F.try_divide(F.col("n_mode").cast("double"),
                                                   F.col("n_valid").cast("double")))
            .where(F.col("mode_share") >= share))


def manual_bins(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Two-bin detail (at most / above the cut) over the non-missing values."""
    long = attach(rows.where(F.col("x").isNotNull()), derived(cuts, cuts.select(*KEY, "cutoff")), KEY)
    cells = long.groupBy(*KEY, "cutoff", (F.col("x") > F.col("cutoff")).cast("int").alias("bin")).agg(
        F.count("*").alias("n"), F.count_if(F.col("y") == 1).alias("n_bad"))
    w = Window.partitionBy(*KEY)
    tot, tb = F.sum("n").over(w), F.sum("n_bad").over(w)
    good = F.col("n") - F.col("n_bad")
    pg = good / F.greatest(tot - tb, F.lit(1))
    pb = F.col("n_bad") / F.greatest(tb, F.lit(1))
    ok = (pg > 0) & (pb > 0)
    woe = F.when(ok, F.ln(F.when(ok, pg / pb))).otherwise(0.0)
    return (cells.withColumn("n_good", good).withColumn("share", F.col("n") / tot)
            .withColumn("bad_rate", F.col("n_bad") / F.col("n"))
            .withColumn("woe", woe).withColumn("iv", F.when(ok, (pg - pb) * woe).otherwise(0.0)))


def direction(pairs: DataFrame, lr: DataFrame | None, corr: DataFrame | None,
              bins: DataFrame | None) -> DataFrame:
    """Risk direction of each pair: LR coefficient, else correlation, else largest rate jump."""
    out = pairs
    none = F.lit(None).cast("double")
    for name, src, col in (("_lr", lr, "lr_coef"), ("_corr", corr, "corr")):
        if src is None:
            out = out.withColumn(name, none)
        else:
            out = out.join(src.groupBy(*KEY).agg(F.first(col, True).alias(name)), KEY, "left")
    if bins is None:
        out = out.withColumn("_jump", none)
    else:
        w = Window.partitionBy(*KEY).orderBy("bin")
        rate = F.col("n_bad") / F.col("n")
        jump = (bins.withColumn("_d", rate - F.lag(rate).over(w)).where(F.col("_d").isNotNull())
                .groupBy(*KEY).agg(F.max_by("_d", F.struct(F.abs("_d"), -F.col("bin"))).alias("_jump")))
        out = out.join(jump, KEY, "left")
    lr_ok, corr_ok = F.abs("_lr") > 1e-6, F.abs("_corr") > 1e-6
    jump_ok = F.coalesce(F.col("_jump") != 0, F.lit(False))
    v = (F.when(lr_ok, F.col("_lr")).when(corr_ok, F.col("_corr"))
         .when(jump_ok, F.col("_jump")))
    source = F.when(lr_ok, "lr").when(corr_ok, "corr").when(jump_ok, "bin_jump")
    return (out.withColumn("direction", F.when(v > 0, "positive").when(v < 0, "negative"))
            .withColumn("direction_source", source).drop("_lr", "_corr", "_jump"))


def side_metrics(df: DataFrame) -> DataFrame:
    """Rates, capped risk ratio, Yates chi-square and alert rate from low / high side counts."""
    d = lambda c: F.col(c).cast("double")
    rate = lambda b, n: F.coalesce(F.try_divide(d(b), d(n)), F.lit(0.0))
    out = (df.withColumn("high_rate", rate("high_bad", "high_n"))
           .withColumn("low_rate", rate("low_bad", "low_n")))
    ratio = F.when(F.col("low_rate") <= 0, F.lit(T.ratio_cap)).otherwise(
        F.least(F.try_divide(F.col("high_rate"), F.col("low_rate")), F.lit(T.ratio_cap)))
    total = d("high_n") + d("low_n")
    bads = d("high_bad") + d("low_bad")
    stat = None
    for n, b in (("high_n", "high_bad"), ("low_n", "low_bad")):
        for seen, want in ((d(b), d(n) * bads / total), (d(n) - d(b), d(n) * (total - bads) / total)):
            gap = F.abs(seen - want)
            gap = gap - F.least(F.lit(0.5), gap)
            term = F.try_divide(gap * gap, want)
            stat = term if stat is None else stat + term
    full = (F.col("high_n") > 0) & (F.col("low_n") > 0) & (bads > 0) & (bads < total)
    return (out.withColumn("risk_ratio", ratio).withColumn("chi2", F.when(full, stat))
            .withColumn("alert_rate", F.try_divide(d("high_n"), total)))


def cut_metrics(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Metrics of given (cutoff, direction) per pair on the filled values, one pass."""
    long = attach(rows, derived(cuts, cuts.select(*KEY, "cutoff", "direction")), KEY)
    above = F.col("x") > F.col("cutoff")
    high = F.when(F.col("direction") == "positive", above).otherwise(~above)
    bad = F.col("y") == 1
    return side_metrics(long.groupBy(*KEY, "cutoff", "direction").agg(
        F.count_if(high).alias("high_n"), F.count_if(~high).alias("low_n"),
        F.count_if(high & bad).alias("high_bad"), F.count_if(~high & bad).alias("low_bad")))


def best_cut(bins: DataFrame, directions: DataFrame) -> DataFrame:
    """The bin border with the highest risk ratio in the fixed direction (first on ties)."""
    w = Window.partitionBy(*KEY).orderBy("bin")
    upto, every = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*KEY)
    cum = bins.select(
        *KEY, "bin", F.col("hi").alias("cutoff"), F.sum("n").over(upto).alias("_n"),
        F.sum("n_bad").over(upto).alias("_b"), F.sum("n").over(every).alias("_tn"),
        F.sum("n_bad").over(every).alias("_tb")).where(F.col("cutoff").isNotNull())
    both = cum.join(directions.where(F.col("direction").isNotNull())
                    .select(*KEY, "direction", "direction_source"), KEY)
    up = F.col("direction") == "positive"
    pick = lambda a, b: F.when(up, a).otherwise(b)
    rest_n, rest_b = F.col("_tn") - F.col("_n"), F.col("_tb") - F.col("_b")
    sided = side_metrics(both.withColumns({
        "high_n": pick(rest_n, F.col("_n")), "low_n": pick(F.col("_n"), rest_n),
        "high_bad": pick(rest_b, F.col("_b")), "low_bad": pick(F.col("_b"), rest_b)}))
    order = Window.partitionBy(*KEY).orderBy(F.desc("risk_ratio"), F.asc("bin"))
    return (sided.withColumn("_r", F.row_number().over(order)).where("_r = 1")
            .drop("_r", "_n", "_b", "_tn", "_tb", "bin"))


def reference_iv(pairs: DataFrame, iv_group: DataFrame, iv_full: DataFrame) -> DataFrame:
    """Segment IV first, full-sample IV otherwise, with the source."""
    g = iv_group.select(*KEY, F.col("iv").alias("_g"))
    f = iv_full.select("feature", F.col("iv").alias("_f"))
    out = pairs.join(g, KEY, "left").join(f, "feature", "left")
    return (out.withColumn("ref_iv", F.coalesce("_g", "_f"))
            .withColumn("iv_source", F.when(F.col("_g").isNotNull(), "group")
                        .when(F.col("_f").isNotNull(), "full").otherwise("missing"))
            .drop("_g", "_f"))


def validity(p: Column) -> Column:
    """First failing gate of a candidate; '-' when all hold."""
    return (F.when(F.col("risk_ratio") < T.min_ratio, "risk_ratio").when(p > T.max_p, "p_value")
            .when(F.col("high_bad") < T.min_bad_high, "high_bad")
            .when(F.col("alert_rate") < T.alert_min, "alert_low")
            .when(F.col("alert_rate") > T.alert_max, "alert_high")
            .when(F.col("ref_iv").isNull(), "iv_missing").when(F.col("ref_iv") < T.min_iv, "iv")
            .otherwise("-"))


def mark_cutoff(bins: DataFrame, cuts: DataFrame) -> DataFrame:
    """Flag the bin whose upper border is the chosen cut."""
    out = bins.join(cuts.select(*KEY, "cutoff"), KEY)
    near = F.coalesce(F.abs(F.col("hi") - F.col("cutoff")) < 1e-9, F.lit(False))
    return out.withColumn("is_cutoff", near.cast("int")).drop("cutoff")


def explore(df: DataFrame, roles: Roles, pairs: DataFrame, *, iv_full: DataFrame,
            iv_group: DataFrame, lr: DataFrame | None = None, corr: DataFrame | None = None,
            **shape) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidate thresholds of all pairs: (summary, bin detail, skipped)."""
    ledger = pin(pair_ledger(df, roles, read_pairs(pairs), **shape))
    todo = pin(ledger.where(F.col("skip_reason").isNull()).select(*KEY, "n", "n_bad"))
    raw = pair_rows(df, roles, todo, **shape)
    med = group_median(raw, KEY)
    rows = filled(raw, med)
    bins = pin(merged_bins(pre_bins(rows)))
    w = Window.partitionBy(*KEY)
    split = bins.withColumn("_k", F.count("*").over(w)).where("_k > 1").drop("_k")
    dirs = direction(split.select(*KEY).distinct(), lr, corr, split)
    main = best_cut(split, dirs).withColumn("cutoff_source", F.lit("bins"))
    flat = todo.select(*KEY).join(split.select(*KEY).distinct(), KEY, "left_anti")
    modes = zero_inflated(raw, med).join(flat, KEY, "left_semi")
    alt = pin(direction(modes.select(*KEY, F.col("mode_x").alias("cutoff")), lr, corr, None)
              .where(F.col("direction").isNotNull()))
    by_mode = (cut_metrics(rows, alt).join(alt.select(*KEY, "direction_source"), KEY)
               .withColumn("cutoff_source", F.lit("zero_inflated")))
    found = reference_iv(pin(main.unionByName(by_mode)), iv_group, iv_full)
    p = F.coalesce(F.col("p_value"), F.lit(1.0))
    rule = F.concat_ws(" ", "feature", F.when(F.col("direction") == "positive", ">").otherwise("<="),
                       F.format_string("%.4f", "cutoff"))
    summary = (todo.withColumnRenamed("n", "segment_n").withColumnRenamed("n_bad", "segment_bad")
               .join(found, KEY)
               .withColumn("p_value", chi2_1_p_value("chi2")).withColumn("p_value", p)
               .withColumn("segment_bad_rate", F.col("segment_bad") / F.col("segment_n"))
               .withColumn("significance", stars(F.col("p_value")))
               .withColumn("fail_reason", validity(F.col("p_value")))
               .withColumn("is_valid", F.col("fail_reason") == "-").withColumn("rule", rule))
    summary = pin(summary.select(
        *KEY, "direction", "direction_source", "segment_n", "segment_bad", "segment_bad_rate",
        "cutoff", "cutoff_source", "high_n", "high_bad", "high_rate", "low_n", "low_bad", "low_rate",
        "risk_ratio", "p_value", "significance", "alert_rate", "ref_iv", "iv_source", "is_valid",
        "fail_reason", "rule"))
    two = manual_bins(raw, alt).select(
        *KEY, "bin", F.when(F.col("bin") == 1, F.col("cutoff")).alias("lo"),
        F.when(F.col("bin") == 0, F.col("cutoff")).alias("hi"), "n", "n_bad")
    detail = mark_cutoff(split.unionByName(two), summary)
    lost = todo.select(*KEY).join(summary, KEY, "left_anti")
    why = (lost.join(split.select(*KEY).distinct().withColumn("_s", F.lit(1)), KEY, "left")
           .join(modes.select(*KEY, F.lit(1).alias("_m")), KEY, "left")
           .select(*KEY, F.when(F.col("_s") == 1, "no_direction").when(
               F.col("_m") == 1, "zero_inflated_no_direction").otherwise("no_bins").alias("skip_reason")))
    skipped = (ledger.where(F.col("skip_reason").isNotNull()).select(*KEY, "skip_reason")
               .unionByName(why))
    return summary, detail, skipped


cloudpickle.register_pickle_by_value(sys.modules[__name__])
