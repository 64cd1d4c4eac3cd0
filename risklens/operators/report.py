"""Report tables. Inputs are result tables (one row per segment, feature or rule), not raw data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from risklens.config import ALL, IV, Roles, TAG_DIM
from risklens.functions import labels
from risklens.operators.iv import reliability_summary
from risklens.operators.segments import KEY, SEG, tag_name
from risklens.operators.small import pin, side_by_side
from risklens.operators.univariate import to_matrix, top_by

RELIABLE_PCT = 50


def corr_export(corr: DataFrame, sizes: DataFrame, features: list[str]) -> DataFrame:
    """Segment rows with sizes and one correlation column per feature."""
    return sizes.select(*SEG, "n", "n_bad", "bad_rate").join(to_matrix(corr, features, "corr"), SEG)


def lr_export(coefs: DataFrame, auc: DataFrame, features: list[str]) -> DataFrame:
    return (auc.select(*SEG, "n", "n_bad", "bad_rate", "auc", "auc_type")
            .join(to_matrix(coefs, features, "lr_coef"), SEG, "left"))


def comprehensive(iv_full: DataFrame, corr: DataFrame, iv_group: DataFrame, dims: list[str],
                  lr: DataFrame | None = None) -> DataFrame:
    """One row per feature: full IV, labels, mean r and mean IV per dim, mean coefficient."""
    out = iv_full.select("feature", "feature_type", F.col("iv").alias("iv_all"), "iv_reliability",
                         "iv_power")
    for prefix, src, value in (("corr", corr, "corr"), ("iv", iv_group, "iv")):
        wide = src.groupBy("feature").pivot("segment_dim", dims).agg(F.avg(value))
        out = out.join(wide.toDF("feature", *[f"{prefix}_{d.strip('_')}" for d in dims]), "feature",
                       "left")
    if lr is not None:
        out = out.join(lr.groupBy("feature").agg(F.avg("lr_coef").alias("lr_coef_mean")), "feature",
                       "left")
    return out.orderBy(F.desc_nulls_last("iv_all"), "feature")


def overview(df: DataFrame, roles: Roles, rel: DataFrame) -> DataFrame:
    """One row: sample, dims, features, segments by reliability, number of warnings."""
    base = df.agg(F.count("*").alias("n"), F.sum(F.col(roles.target).cast("bigint")).alias("n_bad"))
    seg = rel.agg(F.count("*").alias("n_segments"),
                  F.count_if(F.col("reliable_pct") >= RELIABLE_PCT).alias("n_reliable_segments"),
                  F.count_if(F.col("warn")).alias("n_warnings"))
    return (side_by_side(base, seg)
            .withColumn("bad_rate", F.round(F.col("n_bad") / F.col("n"), 4))
            .withColumn("n_unreliable_segments", F.col("n_segments") - F.col("n_reliable_segments"))
            .withColumn("dims", F.lit(",".join(roles.dims)))
            .withColumn("tags", F.lit(",".join(tag_name(t) for t in roles.tags)))
            .withColumn("n_features", F.lit(len(roles.features))))


def _reliable(values: DataFrame, rel: DataFrame) -> DataFrame:
    good = rel.where(F.col("reliable_pct") >= RELIABLE_PCT).select(*SEG)
    return values.join(good, SEG, "left_semi")


def corr_stats(corr: DataFrame, rel: DataFrame) -> DataFrame:
    """Mean, spread, range and sign agreement of r over the reliable segments."""
    c = F.col("corr")
    clear, up = F.abs(c) > 0.02, c > 0.02
    share = F.col("_up") / F.col("_clear")
    many = F.col("_clear") >= 3
    agree = F.when(many, (share >= 0.8) | (share <= 0.2)).otherwise(
        (F.col("_pos") == F.col("n_groups")) | (F.col("_neg") == F.col("n_groups")))
    return (_reliable(corr.where(c.isNotNull()), rel).groupBy("feature")
            .agg(F.avg("corr").alias("corr_mean"), F.stddev_pop("corr").alias("corr_std"),
                 (F.max("corr") - F.min("corr")).alias("corr_range"), F.count("*").alias("n_groups"),
                 F.count_if(clear).alias("_clear"), F.count_if(up).alias("_up"),
                 F.count_if(c > 0).alias("_pos"), F.count_if(c < 0).alias("_neg"))
            .withColumn("sign_consistent", agree).drop("_clear", "_up", "_pos", "_neg"))


def lr_stats(coefs: DataFrame, rel: DataFrame) -> DataFrame:
    return (_reliable(coefs, rel).groupBy("feature")
            .agg(F.avg("lr_coef").alias("lr_mean"), F.stddev_pop("lr_coef").alias("lr_std")))


RATING_ORDER = ("core", "important", "auxiliary", "invalid")


def feature_summary(iv_full: DataFrame, stats: DataFrame, lr: DataFrame | None = None) -> DataFrame:
    """Strength, agreement and rating of every feature, best first."""
    out = iv_full.select("feature", "feature_type", "iv", "iv_power", "iv_reliability")
    out = out.join(stats, "feature", "left")
    if lr is not None:
        out = out.join(lr.select("feature", "lr_mean"), "feature", "left")
    same = F.coalesce("sign_consistent", F.lit(False))
    out = (out.withColumn("sign_consistent", same)
           .withColumn("n_groups", F.coalesce("n_groups", F.lit(0)))
           .withColumn("consistency", labels.consistency_level(F.col("corr_range"), same))
           .withColumn("rating", labels.rate_feature(F.col("iv"), F.col("corr_mean"), same)))
    rank = F.array_position(F.array(*[F.lit(x) for x in RATING_ORDER]), F.col("rating"))
    return out.orderBy(rank, F.desc_nulls_last("iv"), "feature")


def top3_text(values: DataFrame, keys: list[str], value: Column, order: list[Column],
              text: Column, name: str) -> DataFrame:
    """The three leading features per segment as one text."""
    top = top_by(values.where(value.isNotNull()), keys, order, 3)
    return top.groupBy(*keys).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("rank", text.alias("t")))), lambda s: s["t"]),
        ", ").alias(name))


def top3_corr(corr: DataFrame) -> DataFrame:
    c = F.col("corr")
    text = F.concat("feature", F.lit("("), F.when(c > 0, "+").otherwise("-"),
                    F.format_string("%.3f", F.abs(c)), F.lit(")"))
    return top3_text(corr, SEG, c, [F.desc(F.round(F.abs(c), 9)), F.asc("feature")], text, "top3_corr")


def top3_iv(iv: DataFrame) -> DataFrame:
    """Reliable features first; any others only when a segment has no reliable one."""
    w = Window.partitionBy(*SEG)
    rel = F.col("iv_reliability") == "reliable"
    rows = (iv.where(F.col("iv").isNotNull()).withColumn("_any", F.max(rel).over(w))
            .where(rel | ~F.col("_any")))
    text = F.concat("feature", F.lit("("), F.format_string("%.3f", "iv"), F.lit(")"))
    return top3_text(rows, SEG, F.col("iv"), [F.desc(F.round("iv", 9)), F.asc("feature")], text, "top3_iv")


def segment_profiles(sizes: DataFrame, rel: DataFrame, corr: DataFrame, iv: DataFrame,
                     auc: DataFrame | None = None, winners: DataFrame | None = None) -> DataFrame:
    """One row per segment: size (reliability table fills gaps), rate, AUC, leading features."""
    a = sizes.select(*SEG, "n", "n_bad")
    b = rel.select(*SEG, F.col("n").alias("_n"), F.col("n_bad").alias("_b"), "reliable_pct")
    out = a.join(b, SEG, "full").select(
        *SEG, F.coalesce("n", "_n").alias("n"), F.coalesce("n_bad", "_b").alias("n_bad"),
        "reliable_pct")
    out = out.withColumn("bad_rate", F.round(F.col("n_bad") / F.col("n"), 4))
    none = F.lit(None)
    if auc is not None:
        out = out.join(auc.select(*SEG, F.round("auc", 4).alias("auc"), "auc_type"), SEG, "left")
    else:
        out = out.withColumn("auc", none.cast("double")).withColumn("auc_type", none.cast("string"))
    if winners is not None:
        out = out.join(winners.select(*SEG, "winner", F.round("auc_diff", 4).alias("auc_diff")), SEG,
                       "left")
    return out.join(top3_corr(corr), SEG, "left").join(top3_iv(iv), SEG, "left")


def risk_sentences(profiles: DataFrame, corr: DataFrame, overall: float,
                   lr: DataFrame | None = None) -> DataFrame:
    """One generated sentence per segment."""
    pct = lambda c: F.concat(F.format_string("%.1f", c * 100), F.lit("%"))
    rate, auc = F.col("bad_rate"), F.col("auc")
    rows = corr.where(F.col("corr").isNotNull())
    if lr is not None:
        rows = rows.join(lr.select(*KEY, "lr_coef"), KEY, "left")
    else:
        rows = rows.withColumn("lr_coef", F.lit(None).cast("double"))
    c = F.col("corr")
    agrees = F.coalesce((c > 0) == (F.col("lr_coef") > 0), F.lit(False))
    part = F.when(F.abs(c) >= 0.08, F.concat(
        "feature", F.when(c > 0, " raises risk").otherwise(" lowers risk"),
        F.when(agrees, " (robust)").otherwise("")))
    top = top_by(rows.withColumn("_t", part), SEG, [F.desc(F.round(F.abs(c), 9)), F.asc("feature")], 2)
    said = top.groupBy(*SEG).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", F.col("_t").alias("t")))),
                    lambda s: s["t"]).alias("_parts"), F.max(F.abs("corr")).alias("_max"))
    feats = F.filter("_parts", lambda t: t.isNotNull())
    corr_text = (F.when(F.col("_parts").isNull(), F.when(F.col("n") > 0, "no correlation: sample too small"))
                 .when(F.size(feats) > 0, F.array_join(feats, "; "))
                 .otherwise(F.concat(F.lit("weak correlations (max |r|="),
                                     F.format_string("%.3f", "_max"), F.lit(")"))))
    text = F.concat_ws("; ",
                       F.when((rate > 0) & (rate > overall * 2), F.concat(
                           F.lit("bad rate "), pct(rate), F.lit(" far above "), pct(F.lit(overall))))
                       .when((rate > 0) & (rate < overall * 0.5), F.concat(
                           F.lit("bad rate "), pct(rate), F.lit(" far below "), pct(F.lit(overall)))),
                       F.when(auc < 0.6, "model separates poorly").when(auc >= 0.75, F.concat(
                           F.lit("model separates well (AUC="), F.format_string("%.3f", auc), F.lit(")"))),
                       corr_text)
    return profiles.join(said, SEG, "left").withColumn("summary", text).drop("_parts", "_max")


def key_findings(summary: DataFrame, profiles: DataFrame, rel: DataFrame,
                 overall: float) -> DataFrame:
    """Short list of findings (rank, finding), each from one small aggregate."""
    spark = summary.sparkSession
    imp = pin(summary.where(F.col("rating").isin("core", "important")))
    prof = pin(profiles)
    order = [F.desc_nulls_last("iv"), F.asc("feature")]
    out: list[tuple[int, str]] = []
    n = imp.count()
    if n:
        rank = F.array_position(F.array(*[F.lit(x) for x in RATING_ORDER]), F.col("rating"))
        top = imp.orderBy(rank, *order).first()
        out.append((1, f"{n} important or core features, strongest {top['feature']} (IV={top['iv']:.4f})"))
        same = [r["feature"] for r in imp.where("sign_consistent").orderBy(rank, *order).limit(3).collect()]
        if same:
            out.append((2, f"same direction across segments: {', '.join(same)}"))
    best = prof.where(F.col("auc").isNotNull()).orderBy(F.desc("auc"), *SEG).first()
    if best and best["auc"] >= 0.65:
        out.append((3, f"best model: {best['segment_dim']}/{best['segment_name']} (AUC={best['auc']:.3f})"))
    for rank_no, cond, word in ((4, F.col("bad_rate") > overall * 2, "high"),
                                (5, (F.col("bad_rate") > 0) & (F.col("bad_rate") < overall * 0.5), "low")):
        hits = prof.where(cond).groupBy("segment_name").agg(F.max("bad_rate").alias("r"))
        total = hits.count()
        if total:
            names = [f"{r['segment_name']} ({r['r']:.1%})" for r in hits.orderBy("segment_name").limit(5).collect()]
            more = f" and {total - 5} more" if total > 5 else ""
            out.append((rank_no, f"{word}-risk segments: {', '.join(names)}{more}"))
    row = rel.agg(F.count("*").alias("n"), F.count_if(F.col("reliable_pct") >= RELIABLE_PCT).alias("k")).first()
    if row["n"]:
        verdict = "conclusions are sound overall" if row["k"] / row["n"] >= 0.5 else "read some segments with care"
        out.append((6, f"{row['k']}/{row['n']} segments are mostly reliable: {verdict}"))
    return spark.createDataFrame(out, "rank int, finding string")


def redundant_dims(segments: DataFrame, share: float = 0.7) -> DataFrame:
    """Dims most of whose groups equal those of another dim in name, size and bads."""
    a = segments.select(F.col("segment_dim").alias("d1"), "segment_name", "n", "n_bad")
    b = segments.select(F.col("segment_dim").alias("d2"), "segment_name", "n", "n_bad")
    same = (a.join(b, ["segment_name", "n", "n_bad"]).where(F.col("d1") < F.col("d2"))
            .groupBy("d1", "d2").agg(F.count("*").alias("n_same")))
    size = segments.groupBy("segment_dim").agg(F.count("*").alias("k"))
    out = (same.join(size.select(F.col("segment_dim").alias("d1"), F.col("k").alias("k1")), "d1")
           .join(size.select(F.col("segment_dim").alias("d2"), F.col("k").alias("k2")), "d2")
           .withColumn("overlap", F.col("n_same") / F.least("k1", "k2"))
           .where(F.col("overlap") >= share))
    drop_second = F.col("k2") <= F.col("k1")
    return out.select(F.when(drop_second, F.col("d2")).otherwise(F.col("d1")).alias("redundant_dim"),
                      F.when(drop_second, F.col("d1")).otherwise(F.col("d2")).alias("primary_dim"),
                      "n_same", "overlap")


def split_profiles(profiles: DataFrame, overall: float) -> DataFrame:
    """Profiles without duplicates of redundant dims, marked key or brief, with a JSON form."""
    red = redundant_dims(profiles)
    prim = profiles.select(F.col("segment_dim").alias("primary_dim"), "segment_name")
    doubled = (profiles.select(*SEG).join(red, F.col("segment_dim") == F.col("redundant_dim"))
               .join(prim, ["primary_dim", "segment_name"], "left_semi").select(*SEG).distinct())
    kept = profiles.join(doubled, SEG, "left_anti")
    rate, auc = F.col("bad_rate"), F.col("auc")
    key = ((auc >= 0.65) | (rate > overall * 2) | ((rate > 0) & (rate < overall * 0.5))
           | ((F.col("n") >= 1000) & auc.isNotNull()))
    out = kept.withColumn("detail", F.when(F.coalesce(key, F.lit(False)), "key").otherwise("brief"))
    brief = [c for c in (*SEG, "n", "n_bad", "bad_rate", "auc", "auc_type", "summary") if c in kept.columns]
    return out.withColumn("document", F.when(F.col("detail") == "key", F.to_json(F.struct(*kept.columns)))
                          .otherwise(F.to_json(F.struct(*brief))))


def audit(iv_full: DataFrame, rules: DataFrame) -> DataFrame:
    """Features above the leak limit and unstable rules, one row each."""
    a = iv_full.where(F.col("iv") > IV.suspect).select(
        F.lit("iv_suspect").alias("kind"), F.col("feature").alias("item"), F.round("iv", 6).alias("value"))
    b = rules.where(F.col("stability") == "unstable").select(
        F.lit("unstable_rule").alias("kind"),
        F.concat_ws(".", *SEG, F.col("rule_id").cast("string")).alias("item"),
        F.col("stab_valid_n").cast("double").alias("value"))
    return a.unionByName(b)


# ---- ranked look-ups -------------------------------------------------------------------------

def top_features(table: DataFrame, kind: str, *, n: int = 15, dim: str | None = None,
                 group: str | None = None, sign: str | None = None) -> DataFrame:
    """Leading rows of a result table: kind is 'iv', 'iv_group', 'corr' or 'lr'."""
    if kind != "iv":
        if dim:
            table = table.where(F.col("segment_dim") == dim)
        if group:
            table = table.where(F.col("segment_name") == group)
    elif dim or group:
        import warnings
        warnings.warn("the full-sample table has no segments; use kind='iv_group'", stacklevel=2)
    col = {"iv": "iv", "iv_group": "iv", "corr": "corr", "lr": "lr_coef"}[kind]
    value = F.col(col)
    if kind == "lr" and sign == "positive":
        order = F.desc(value)
    elif kind == "lr" and sign == "negative":
        order = F.asc(value)
    else:
        order = F.desc(F.abs(value)) if kind in ("corr", "lr") else F.desc(value)
    return table.where(value.isNotNull()).orderBy(order, *[c for c in KEY if c in table.columns]).limit(n)


# ---- chart data ------------------------------------------------------------------------------

def chart_iv_full(iv_full: DataFrame, n: int = 20) -> DataFrame:
    return (top_features(iv_full, "iv", n=n)
            .select("feature", "iv", labels.iv_power(F.col("iv")).alias("level")))


def chart_iv_heatmap(iv_group: DataFrame, iv_full: DataFrame | None = None, n: int = 15) -> DataFrame:
    """Cells per dim; feature order by full-sample IV, or by the mean IV inside the dim."""
    rows = iv_group.where(F.col("iv").isNotNull())
    order = rows.groupBy("segment_dim", "feature").agg(F.avg("iv").alias("_m"))
    if iv_full is not None:
        order = (order.join(iv_full.where(F.col("iv").isNotNull())
                            .select("feature", F.col("iv").alias("_f")), "feature"))
        score = F.col("_f")
    else:
        score = F.col("_m")
    top = top_by(order, ["segment_dim"], [F.desc(F.round(score, 9)), F.asc("feature")], n)
    return (rows.join(top.select("segment_dim", "feature", "rank"), ["segment_dim", "feature"])
            .select(*KEY, "rank", "iv", "iv_reliability",
                    F.col("iv_reliability").startswith("unreliable").alias("crossed")))


def chart_heatmap(values: DataFrame, value: str, n: int = 15) -> DataFrame:
    """Cells of the features with the largest absolute value inside each dim."""
    rows = values.where(F.col(value).isNotNull())
    order = rows.groupBy("segment_dim", "feature").agg(F.max(F.abs(value)).alias("_m"))
    top = top_by(order, ["segment_dim"], [F.desc(F.round("_m", 9)), F.asc("feature")], n)
    return (rows.join(top.select("segment_dim", "feature", "rank"), ["segment_dim", "feature"])
            .select(*KEY, "rank", value))


def chart_auc(auc: DataFrame, dim: str | None = None) -> DataFrame:
    rows = auc.where(F.col("auc").isNotNull())
    if dim:
        rows = rows.where(F.col("segment_dim") == dim)
    return rows.select(*SEG, "auc", "auc_type").orderBy("auc", *SEG)


def chart_segments(profiles: DataFrame) -> DataFrame:
    """Bad-rate bars with the unweighted and the weighted baseline."""
    w = Window.partitionBy()  # one row per segment
    return (profiles.where(F.col("bad_rate").isNotNull())
            .select(*SEG, "n", "n_bad", "bad_rate", F.avg("bad_rate").over(w).alias("baseline"),
                    (F.sum("n_bad").over(w) / F.sum("n").over(w)).alias("weighted_rate"))
            .orderBy(F.desc("bad_rate"), *SEG))


def chart_rules(rules: DataFrame) -> DataFrame:
    """Scatter points: coverage, lift, bubble size, and the three best by lift."""
    w = Window.partitionBy()  # one row per rule
    most = F.greatest(F.max("bad_n").over(w), F.lit(1))
    rank = F.row_number().over(w.orderBy(F.desc("lift"), F.desc("coverage_pct"), F.asc("rule_id")))
    return rules.where(F.col("lift").isNotNull() & F.col("coverage_pct").isNotNull()).select(
        *[c for c in SEG if c in rules.columns], "rule_id", "coverage_pct", "lift",
        (F.lit(30.0) + F.col("bad_n") / most * 300).alias("size"), (rank <= 3).alias("labelled"))


def chart_combinations(rules: DataFrame, n: int = 15) -> DataFrame:
    """Best lift, total coverage and rule count per feature combination."""
    combo = F.array_join(F.array_sort("feature_list"), " + ")
    return (rules.withColumn("combination", combo).where(F.col("lift").isNotNull() & (F.col("combination") != ""))
            .groupBy("combination").agg(F.max("lift").alias("max_lift"),
                                        F.sum(F.coalesce("coverage_pct", F.lit(0.0))).alias("total_coverage"),
                                        F.count("*").alias("n_rules"),
                                        F.max(F.size("feature_list")).alias("n_features"))
            .orderBy(F.desc("max_lift"), "combination").limit(n))


def chart_threshold_bins(bins: DataFrame, cuts: DataFrame) -> DataFrame:
    """Bin bars with the high-risk side marked; open ends of the outer bins are infinite."""
    inf = F.lit(float("inf"))
    lo, hi = F.coalesce("lo", -inf), F.coalesce("hi", inf)
    side = F.when(F.col("direction") == "positive", lo >= F.col("cutoff")).otherwise(hi <= F.col("cutoff"))
    return (bins.join(cuts.select(*KEY, "cutoff", "direction"), KEY)
            .select(*KEY, "bin", "n", F.coalesce(F.try_divide(F.col("n_bad").cast("double"), F.col("n")),
                                                 F.lit(0.0)).alias("bad_rate"),
                    side.alias("high_risk"),
                    F.coalesce(F.abs(F.col("hi") - F.col("cutoff")) < 1e-9, F.lit(False)).alias("at_cutoff")))


def chart_threshold_ratios(summary: DataFrame) -> DataFrame:
    return (summary.where(F.col("risk_ratio").isNotNull())
            .select(*KEY, "risk_ratio", "is_valid").orderBy("segment_dim", "risk_ratio", "segment_name", "feature"))


__all__ = [n for n in dir() if not n.startswith("_")]
