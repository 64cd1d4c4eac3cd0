"""Information value and weight of evidence for every (segment, feature) pair at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from risklens.config import ALL, GATES, IV, Roles
from risklens.functions import labels
from risklens.operators import quantiles as Q
from risklens.operators.segments import KEY, SEG, eligible, long_form
from risklens.operators.small import attach, derived, is_empty, pin


@dataclass
class Binned:
    """Bins of every computable pair plus one counting row per requested pair."""

    bins: DataFrame    # KEY, kind, n, n_bad, x_min, x_max
    totals: DataFrame  # KEY, n_rows, bad_rows, n, n_bad, k, n_edges, computable


def adaptive_binning(long: DataFrame, keys: list[str] = KEY, bins: int = IV.bins,
                     min_n: int = GATES.min_n, **sketch_args) -> Binned:
    """Value bins, quantile bins, or mode bin + quantile bins of the rest (first that splits)."""
    most = max(bins, Q.MAX_K)
    n, bad = F.col("n"), F.col("n_bad")
    sk = Q.sketch(long, keys, labels.adaptive_bins(n, bad, bins), max_k=most, **sketch_args)
    total_good = F.col("n_rows") - F.col("bad_rows")
    usable = ((total_good > 0) & (F.col("bad_rows") > 0) & (n >= min_n) & (bad > 0)
              & (n - bad > 0))
    good_sk = derived(sk, sk.where(usable))
    hist = Q.histogram(long, keys, good_sk, most - 1).persist()
    ed = pin(Q.edges(hist, keys, good_sk), max_rows=200_000)
    flat = (~F.col("by_value")) & (F.size("edges") <= 2)

    meta = derived(ed, ed.select(*keys, "edges", "by_value", flat.alias("_flat")))
    rows = attach(hist, meta, keys)
    index = F.greatest(F.lit(1), F.size(F.filter("edges", lambda e: e < F.col("x_min"))))
    first = (rows.where(~F.col("_flat"))
             .withColumn("kind", F.when(F.col("by_value"), "value").otherwise("quantile"))
             .withColumn("_bin", F.when(F.col("by_value"), F.col("v"))
                         .otherwise(index.cast("double"))))
    out = _collapse(first, keys)

    heavy_keys = derived(ed, ed.where(flat).select(*keys, F.col("k").alias("_k")))
    zero_heavy = pin(attach(hist.where(F.col("v").isNotNull()), heavy_keys, keys).groupBy(*keys, "_k").agg(
        F.max_by("v", F.struct(F.col("n"), -F.col("v"))).alias("mode_x")))
    if not is_empty(zero_heavy):
        modes = (attach(hist, zero_heavy, keys).where(F.col("v") == F.col("mode_x"))
                 .withColumn("kind", F.lit("mode")).withColumn("_bin", F.lit(0.0)))
        rest = attach(long, zero_heavy, keys).where(F.col("x") != F.col("mode_x"))
        rest_k = F.greatest(F.lit(2), F.col("_k") - 1)
        sk2 = Q.sketch(rest, [*keys, "_k"], rest_k, max_k=most, **sketch_args)
        sk2 = derived(sk2, sk2.drop("_k"))
        hist2 = Q.histogram(rest, keys, sk2, most - 1).persist()
        ed2 = pin(Q.edges(hist2, keys, sk2), max_rows=200_000)
        tail = (attach(hist2, derived(ed2, ed2.select(*keys, "edges", "by_value")), keys)
                .withColumn("kind", F.lit("tail"))
                .withColumn("_bin", F.when(F.col("by_value"), F.col("v"))
                            .otherwise(index.cast("double"))))
        out = out.unionByName(_collapse(modes, keys)).unionByName(_collapse(tail, keys))

    totals = (sk.select(*keys, "n_rows", "bad_rows", "n", "n_bad", "k", usable.alias("computable"))
              .join(ed.select(*keys, F.when(~F.col("by_value") & ~flat, F.size("edges") - 1)
                              .alias("n_edges"), "n_distinct"), keys, "left"))
    return Binned(out, totals)


def _collapse(rows: DataFrame, keys: list[str]) -> DataFrame:
    return (rows.groupBy(*keys, "kind", "_bin")
            .agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"),
                 F.min("x_min").alias("x_min"), F.max("x_max").alias("x_max"))
            .drop("_bin"))


def _with_shares(bins: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    tg = (F.col("n_rows") - F.col("bad_rows")).alias("_tg")
    rows = bins.join(totals.select(*keys, tg, F.col("bad_rows").alias("_tb")), keys)
    good = F.col("n") - F.col("n_bad")
    return (rows.withColumn("woe", labels.woe(good, F.col("n_bad"), F.col("_tg"), F.col("_tb")))
            .withColumn("iv", labels.iv_part(good, F.col("n_bad"), F.col("_tg"), F.col("_tb"))))


def iv_table(long: DataFrame, keys: list[str] = KEY, bins: int = IV.bins,
             **sketch_args) -> DataFrame:
    """IV with its missing / non-missing parts, sizes, bin count, reliability and power."""
    b = adaptive_binning(long, keys, bins, **sketch_args)
    parts = (_with_shares(b.bins, b.totals, keys).groupBy(*keys)
             .agg(F.sum("iv").alias("_iv"), F.count("*").alias("n_bins")))
    t = b.totals.join(parts, keys, "left")
    tb, tg = F.col("bad_rows"), F.col("n_rows") - F.col("bad_rows")
    # A quantile interval without rows still counts as a cell with half a good and half a bad.
    hollow = F.coalesce(F.col("n_edges") - F.col("n_bins"), F.lit(0))
    hollow_iv = F.when(hollow > 0, hollow * labels.iv_part(F.lit(0), F.lit(0), tg, tb)).otherwise(0.0)
    miss_n = F.col("n_rows") - F.col("n")
    miss_bad = F.col("bad_rows") - F.col("n_bad")
    miss = (F.when(~F.col("computable"), F.lit(None).cast("double"))
            .when(miss_n == 0, 0.0)
            .otherwise(labels.iv_part(miss_n - miss_bad, miss_bad, tg, tb)))
    nonmiss = F.when(F.col("computable"), F.col("_iv") + hollow_iv)
    iv = F.col("iv_missing") + F.col("iv_nonmissing")
    return (t.withColumn("iv_missing", miss).withColumn("iv_nonmissing", nonmiss)
            .withColumn("iv", iv)
            .select(*keys, "iv", "iv_missing", "iv_nonmissing", miss_n.alias("n_missing"),
                    F.col("n_rows").alias("segment_n"), F.col("bad_rows").alias("segment_bad"),
                    (F.col("bad_rows") / F.col("n_rows")).alias("segment_bad_rate"),
                    F.col("n").alias("n"), F.col("n_bad").alias("n_bad"),
                    F.coalesce("n_bins", F.lit(0)).alias("n_bins"),
                    labels.iv_reliability(F.col("iv"), F.col("n"), F.col("n_bad"))
                    .alias("iv_reliability"),
                    labels.iv_power(F.col("iv")).alias("iv_power")))


def _long(df: DataFrame, roles: Roles, segs: DataFrame, sketch_args: dict, **shape) -> DataFrame:
    return long_form(df, roles, segs, small_n=sketch_args.get("small_n", Q.SMALL_N), **shape)


def iv_full(df: DataFrame, roles: Roles, **kw) -> DataFrame:
    """Full-sample IV with the six-way label and the raw / derived mark."""
    segs = eligible(df, roles, 0, 0, full=True, dims=False, tags=False)
    out = iv_table(_long(df, roles, segs, kw, full=True, dims=False, tags=False), **kw)
    kind = F.when(F.col("feature").isin(list(roles.derived)), "derived").otherwise("raw")
    return (out.withColumn("iv_level", labels.iv_level(F.col("iv")))
            .withColumn("feature_type", kind))


def iv_segments(df: DataFrame, roles: Roles, *, full: bool = False, dims: bool = True,
                tags: bool = True, caps: dict | None = None, min_n: int = GATES.min_n,
                min_bad: int = GATES.min_bad_iv, n_gate_on_tags: bool = True,
                **kw) -> DataFrame:
    """IV in every eligible segment; ``caps`` limits the groups of a dim (largest first)."""
    shape = dict(full=full, dims=dims, tags=tags)
    segs = eligible(df, roles, min_n, min_bad, caps=caps, n_gate_on_tags=n_gate_on_tags, **shape)
    return iv_table(_long(df, roles, segs, kw, **shape), **kw)


def woe_table(df: DataFrame, roles: Roles, *, full: bool = True, dims: bool = False,
              tags: bool = False, min_n: int = GATES.min_n, min_bad: int = GATES.min_bad_iv,
              **kw) -> DataFrame:
    """Bins with size, rate, WOE and IV part; the missing bin comes last."""
    shape = dict(full=full, dims=dims, tags=tags)
    segs = eligible(df, roles, min_n, min_bad, **shape)
    b = adaptive_binning(_long(df, roles, segs, kw, **shape), **kw)
    single = F.coalesce(F.col("n_distinct") <= 1, F.lit(False))
    totals = b.totals.where(F.col("computable") & ~single)
    missing = (totals.where(F.col("n_rows") > F.col("n"))
               .select(*KEY, F.lit("missing").alias("kind"),
                       (F.col("n_rows") - F.col("n")).alias("n"),
                       (F.col("bad_rows") - F.col("n_bad")).alias("n_bad"),
                       F.lit(None).cast("double").alias("x_min"),
                       F.lit(None).cast("double").alias("x_max")))
    rows = _with_shares(b.bins.unionByName(missing), totals, KEY)
    w = Window.partitionBy(*KEY).orderBy(F.asc_nulls_last("x_min"))
    return (rows.withColumn("bin_no", F.row_number().over(w))
            .withColumn("bad_rate", F.when(F.col("n_bad") == 0, F.lit(0.5))
                        .otherwise(F.col("n_bad").cast("double")) / F.col("n"))
            .select(*KEY, "bin_no", "kind", "x_min", "x_max", "n", "n_bad", "bad_rate", "woe",
                    "iv"))


def woe_by_value(df: DataFrame, column: str, target: str, min_n: int = GATES.min_n) -> DataFrame:
    """WOE table of a non-numeric column: one bin per value, missing last."""
    y = F.col(target).cast("bigint")
    c = F.col(column).cast("string")
    cells = (df.where(F.col(target).isNotNull()).groupBy(c.alias("value"))
             .agg(F.count("*").alias("n"), F.sum(y).alias("n_bad")))
    tot = cells.agg(F.sum("n").alias("n"), F.sum("n_bad").alias("tb"),
                    F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("nn"),
                    F.count("value").alias("nv")).first()
    n, tb = tot["n"] or 0, tot["tb"] or 0
    usable = (tot["nn"] or 0) >= min_n and tot["nv"] > 1 and 0 < tb < n
    good = F.col("n") - F.col("n_bad")
    sums = (F.lit(n - tb), F.lit(tb))
    return cells.where(F.lit(usable)).select(
        "value", "n", "n_bad",
        (F.when(F.col("n_bad") == 0, F.lit(0.5)).otherwise(F.col("n_bad").cast("double"))
         / F.col("n")).alias("bad_rate"),
        labels.woe(good, F.col("n_bad"), *sums).alias("woe"),
        labels.iv_part(good, F.col("n_bad"), *sums).alias("iv"))


def reliability_summary(iv: DataFrame) -> DataFrame:
    """Counts by reliability level and reliable share of every segment, with a warning flag."""
    rel = F.col("iv_reliability")
    n_rel, n_ref = F.count_if(rel == "reliable"), F.count_if(rel == "reference")
    pct = F.round(F.col("n_reliable") / F.col("n_features") * 100, 1)
    return (iv.groupBy(*SEG)
            .agg(F.first("segment_n").alias("n"), F.first("segment_bad").alias("n_bad"),
                 F.count("*").alias("n_features"), n_rel.alias("n_reliable"),
                 n_ref.alias("n_reference"))
            .withColumn("n_unreliable",
                        F.col("n_features") - F.col("n_reliable") - F.col("n_reference"))
            .withColumn("reliable_pct", pct)
            .withColumn("warn", F.col("reliable_pct") < 50))


def reliability_levels(iv: DataFrame) -> DataFrame:
    counts = iv.groupBy("iv_reliability").agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy())  # a handful of labels
    return counts.withColumn("share_pct", F.round(F.col("n_rows") / total * 100, 1))


def segment_summary(iv: DataFrame) -> DataFrame:
    """Size, rate and reliable / unreliable counts of each segment."""
    rel = F.col("iv_reliability")
    return (iv.groupBy(*SEG)
            .agg(F.first("segment_n").alias("segment_n"),
                 F.first("segment_bad").alias("segment_bad"),
                 F.round(F.first("segment_bad_rate"), 4).alias("segment_bad_rate"),
                 F.count_if(rel == "reliable").alias("n_reliable"),
                 F.count("*").alias("n_features"),
                 F.count_if(rel.startswith("unreliable")).alias("n_unreliable"))
            .withColumn("reliable_pct",
                        F.round(F.col("n_reliable") / F.col("n_features") * 100, 1)))


def _label(dim: str = "segment_dim", name: str = "segment_name") -> Column:
    return F.when(F.col(dim) == ALL, F.lit(ALL)).otherwise(F.concat_ws("_", dim, name))


def group_iv_cells(iv: DataFrame, max_groups: int = 12, top_n: int = 20,
                   prefixes: list[str] | None = None) -> DataFrame:
    """Cells of the feature x group matrix: groups by mean IV, features by full-sample IV."""
    rows = iv.where(F.col("iv").isNotNull()).withColumn("group", _label())
    if prefixes:
        keep = F.lit(False)
        for p in prefixes:
            keep = keep | F.col("group").startswith(p)
        rows = rows.where(keep)
    order_g = Window.partitionBy().orderBy(F.desc("_m"), F.asc("group"))
    groups = (rows.groupBy("group").agg(F.round(F.avg("iv"), 9).alias("_m"))
              .orderBy(F.desc("_m"), F.asc("group")).limit(max_groups)
              .withColumn("group_rank", F.row_number().over(order_g)).drop("_m"))
    rows = rows.join(F.broadcast(groups), "group")  # at most max_groups rows
    base = F.max(F.when(F.col("group") == ALL, F.col("iv")))
    per_feature = rows.groupBy("feature").agg(base.alias("_b"),
                                              F.round(F.avg("iv"), 9).alias("_m"))
    has_base = F.max(F.col("_b").isNotNull()).over(Window.partitionBy())
    score = F.when(has_base, F.col("_b")).otherwise(F.col("_m"))
    order_f = Window.partitionBy().orderBy(F.desc_nulls_last("_score"), F.asc("feature"))
    feats = (per_feature.withColumn("_score", score).where(F.col("_score").isNotNull())
             .orderBy(F.desc_nulls_last("_score"), F.asc("feature")).limit(top_n)
             .withColumn("feature_rank", F.row_number().over(order_f))
             .select("feature", "feature_rank"))
    return (rows.join(F.broadcast(feats), "feature")  # at most top_n rows
            .select("feature", "feature_rank", "group", "group_rank", "iv", "iv_reliability"))


def group_iv_pivot(iv: DataFrame, value: str = "iv", **kw) -> DataFrame:
    cells = pin(group_iv_cells(iv, **kw))
    names = [r["group"] for r in cells.select("group", "group_rank").distinct()
             .orderBy("group_rank").collect()]
    return cells.groupBy("feature").pivot("group", names).agg(F.first(value))


def recommendations(iv: DataFrame, dim: str, name: str, top_n: int = 10,
                    min_iv: float = IV.weak) -> DataFrame:
    """Best trustworthy features of a segment, compared with the full sample."""
    mine = iv.where((F.col("segment_dim") == dim) & (F.col("segment_name") == name)
                    & F.col("iv").isNotNull() & ~F.col("iv_reliability").startswith("unreliable")
                    & (F.col("iv") >= min_iv))
    base = iv.where(F.col("segment_dim") == ALL).select("feature", F.col("iv").alias("iv_all"))
    return (mine.select(*KEY, "iv", "iv_reliability")
            .orderBy(F.desc("iv"), F.asc("feature")).limit(top_n)
            .join(base, "feature", "left")
            .withColumn("iv_diff", F.col("iv") - F.col("iv_all")))


def export_pivots(iv: DataFrame, features: list[str], value: str) -> DataFrame:
    """Segment rows x feature columns of one value."""
    return iv.groupBy(*SEG).pivot("feature", list(features)).agg(F.first(value))
