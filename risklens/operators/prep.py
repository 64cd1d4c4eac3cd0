"""Preparation: labels, joins, cleaning, filters and the two multi-table wide builders."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from risklens.config import GATES, Roles
from risklens.operators.segments import SEG, eligible, expand, long_form
from risklens.operators.small import attach, derived, pin, side_by_side

NUMERIC_TEXT_SHARE = 0.8


def clean_key(c: Column) -> Column:
    """Text key without padding and without a trailing ``.0``."""
    return F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")


def label_from_list(df: DataFrame, bad: DataFrame, key: str, bad_key: str | None = None,
                    target: str = "is_bad") -> DataFrame:
    """1 when the key is on the list. The list is de-duplicated; keys compare as text."""
    ids = bad.select(F.col(bad_key or key).cast("string").alias("_bad")).distinct()
    out = df.drop(target).join(ids, F.col(key).cast("string") == F.col("_bad"), "left")
    return out.withColumn(target, F.col("_bad").isNotNull().cast("int")).drop("_bad")


def label_check(labelled: DataFrame, bad: DataFrame, bad_key: str,
                target: str = "is_bad") -> DataFrame:
    """One row: list and match counts and the status of the labelling."""
    lst = bad.agg(F.countDistinct(F.col(bad_key).cast("string")).alias("n_list"))
    tab = labelled.agg(F.count("*").alias("n"),
                       F.coalesce(F.sum(F.col(target).cast("bigint")), F.lit(0)).alias("n_bad"))
    n, b, m = F.col("n"), F.col("n_bad"), F.col("n_list")
    status = (F.when(m == 0, "error_empty_list").when(b == 0, "error_no_match")
              .when(b == n, "error_all_bad")
              .when((b / m < 0.5) & (b / n >= 0.005), "note_subset")
              .when(b / m < 0.5, "warn_key_mismatch").otherwise("ok"))
    return (side_by_side(tab, lst)
            .withColumn("n_outside", m - b)
            .withColumn("hit_rate", F.try_divide(b.cast("double"), m.cast("double")))
            .withColumn("bad_rate", F.try_divide(b.cast("double"), n.cast("double")))
            .withColumn("status", status))


def target_check(df: DataFrame, target: str) -> DataFrame:
    """One row: missing values, foreign codes, distinct codes and the status of a 0/1 target."""
    v = F.expr(f"try_cast(`{target}` AS DOUBLE)")
    present = F.col(target).isNotNull()
    out = df.agg(F.count("*").alias("n"), F.count_if(~present).alias("n_missing"),
                 F.count_if(present & (v.isNull() | ~v.isin(0.0, 1.0))).alias("n_foreign"),
                 F.countDistinct(v).alias("n_codes"))
    return out.withColumn("status", F.when(F.col("n_missing") > 0, "error_missing")
                          .when(F.col("n_foreign") > 0, "error_coding")
                          .when(F.col("n_codes") < 2, "error_single_class").otherwise("ok"))


def require_ok(check: DataFrame) -> None:
    """Raise when a check row reports an error."""
    row = check.first()
    if row["status"].startswith("error"):
        raise ValueError(f"{row['status']}: {row.asDict()}")


def coerce_target(df: DataFrame, target: str) -> DataFrame:
    return df.withColumn(target, F.expr(f"CAST(try_cast(`{target}` AS DOUBLE) AS INT)"))


def one_per_key(df: DataFrame, key: str, order: list[Column], *, largest: bool) -> DataFrame:
    """One row per key by an explicit order, as an aggregate.

    ``max_by`` / ``min_by`` combine map-side, so a key holding a large part of the rows never has
    to be collected or sorted in one task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    pick = F.max_by if largest else F.min_by
    return df.groupBy(F.col(key).alias("_key")).agg(pick(row, F.struct(*order)).alias("_r")
                                                    ).select("_r.*")


def latest_record(df: DataFrame, key: str, date: str, tiebreak: str) -> DataFrame:
    """Most recent row per key; rows without a readable date come last."""
    ts = F.try_to_timestamp(F.col(date).cast("string"))
    return one_per_key(df, key, [ts, F.col(tiebreak)], largest=True)


def first_record(df: DataFrame, key: str, order: str) -> DataFrame:
    return one_per_key(df, key, [F.col(order)], largest=False)


def supplement(df: DataFrame, other: DataFrame, key: str, order: str,
               other_key: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Left join of a side table: text keys, first row per key, side table wins collisions."""
    okey = other_key or key
    keep = [c for c in (columns or other.columns) if c not in (okey,)]
    side = (other.withColumn("_k", F.col(okey).cast("string"))
            .groupBy("_k")
            .agg(F.min_by(F.struct(*[F.col(c) for c in keep]), F.col(order)).alias("_r"))
            .select("_k", "_r.*"))
    base = df.drop(*[c for c in keep if c in df.columns and c != key])
    return base.join(side, base[key].cast("string") == side["_k"], "left").drop("_k")


def supplement_check(before: DataFrame, after: DataFrame, first_column: str) -> DataFrame:
    """One row: rows before and after, matches, and whether the join is usable."""
    a = before.agg(F.count("*").alias("n_before"))
    b = after.agg(F.count("*").alias("n_after"), F.count(first_column).alias("n_matched"))
    return (side_by_side(a, b)
            .withColumn("status", F.when(F.col("n_matched") == 0, "error_no_match")
                        .when(F.col("n_after") != F.col("n_before"), "error_fan_out")
                        .otherwise("ok")))


def apply_filter(df: DataFrame, spec: dict[str, dict[str, Any]]) -> DataFrame:
    """Conjunctive filter: exclude, include, min / max / range, drop_na per column.

    ``exclude`` keeps nulls, ``include`` and ranges drop them; unknown columns are ignored.
    """
    cond: Column | None = None
    types = {f.name: f.dataType for f in df.schema.fields}

    def add(c: Column) -> None:
        nonlocal cond
        cond = c if cond is None else cond & c

    for col, rule in spec.items():
        if col not in types:
            continue
        c = F.col(f"`{col}`")
        if isinstance(types[col], NumericType):
            listed = lambda vals: c.cast("double").isin([float(v) for v in vals])
        else:
            listed = lambda vals: c.cast("string").isin([str(v) for v in vals])
        if "exclude" in rule:
            add(c.isNull() | ~listed(rule["exclude"]))
        if "include" in rule:
            add(listed(rule["include"]))
        lo, hi = rule.get("min"), rule.get("max")
        if "range" in rule:
            if not isinstance(rule["range"], (list, tuple)) or len(rule["range"]) != 2:
                raise ValueError(f"range of {col!r} must be [min, max]")
            lo = rule["range"][0] if lo is None else lo
            hi = rule["range"][1] if hi is None else hi
        num = F.expr(f"try_cast(`{col}` AS DOUBLE)")
        if lo is not None:
            add(num >= float(lo))
        if hi is not None:
            add(num <= float(hi))
        if rule.get("drop_na"):
            add(c.isNotNull())
    return df if cond is None else df.where(cond)


def numeric_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def feature_spread(df: DataFrame, exclude: list[str] = (), min_std: float = 0.0) -> DataFrame:
    """Sample std of every numeric column in one pass and whether it qualifies as a feature."""
    cols = numeric_columns(df, exclude)
    row = df.agg(*[F.stddev_samp(F.col(f"`{c}`").cast("double")).alias(c) for c in cols])
    out = row.unpivot([], cols, "feature", "std")
    return out.withColumn("keep", F.coalesce(F.col("std") > min_std, F.lit(False)))


def discover_features(df: DataFrame, exclude: list[str] = (), min_std: float = 0.0) -> list[str]:
    kept = {r["feature"] for r in feature_spread(df, exclude, min_std).where("keep").collect()}
    return [c for c in numeric_columns(df, exclude) if c in kept]


def drop_flat(df: DataFrame, features: list[str]) -> DataFrame:
    """Without the features that do not vary."""
    keep = set(discover_features(df.select(*features)))
    return df.drop(*[f for f in features if f not in keep])


def amount(c: Column, fill: float | None = None) -> Column:
    """Amount text to number: separators dropped, placeholders to null or to ``fill``."""
    text = F.trim(F.replace(c.cast("string"), F.lit(","), F.lit("")))
    out = text.try_cast("double") if hasattr(text, "try_cast") else text.cast("double")
    return out if fill is None else F.coalesce(out, F.lit(float(fill)))


def backfill_total(total: Column, parts: list[Column]) -> Column:
    """Missing totals become the sum of whatever parts are present."""
    any_part = F.coalesce(*parts).isNotNull()
    added = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    return F.when(total.isNull() & any_part, added).otherwise(total)


def numeric_text_share(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """Share of the values of each text column that read as numbers (whole column, one pass)."""
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in set(exclude)]
    row = df.agg(*[F.struct(F.count(c).alias("n_present"),
                            F.count(amount(F.col(c))).alias("n_numeric")).alias(c) for c in cols])
    out = row.unpivot([], cols, "column", "s").select("column", "s.*")
    share = F.try_divide(F.col("n_numeric").cast("double"), F.col("n_present").cast("double"))
    return (out.withColumn("share", share)
            .withColumn("is_numeric", F.coalesce(share >= NUMERIC_TEXT_SHARE, F.lit(False))))


def numeric_text(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """Turn the text columns that hold numbers into doubles."""
    hits = {r["column"] for r in numeric_text_share(df, exclude).where("is_numeric").collect()}
    return df.select(*[amount(F.col(c)).alias(c) if c in hits else F.col(c) for c in df.columns])


def zero_fill(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    return df.fillna(0, subset=numeric_columns(df, exclude))


def fill_counts(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """Cells that zero filling replaces, per column."""
    cols = numeric_columns(df, exclude)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "n_filled")


def pairwise_valid(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull())


def fit_fill_values(df: DataFrame, roles: Roles, min_n: int = GATES.min_n, min_bad: int = 0,
                    **shape) -> DataFrame:
    """Median of every feature per segment (null where a feature has no value)."""
    from risklens.operators.quantiles import group_median
    shape = shape or dict(full=True, dims=False, tags=False)
    segs = eligible(df, roles, min_n, min_bad, **shape)
    return group_median(long_form(df, roles, segs, **shape), [*SEG, "feature"])


def impute(df: DataFrame, roles: Roles, fills: DataFrame, policy: str = "median",
           **shape) -> DataFrame:
    """Rows of every fitted segment with missing features replaced by the fitted values."""
    shape = shape or dict(full=True, dims=False, tags=False)
    if policy == "zero":
        return expand(df, roles, **shape).fillna(0, subset=list(roles.features))
    wide = pin(fills.groupBy(*SEG).pivot("feature", list(roles.features)).agg(F.first("median"))
               .toDF(*SEG, *[f"_fill_{i}" for i in range(len(roles.features))]))
    rows = attach(expand(df, roles, **shape), derived(wide, wide.select("*")), SEG)
    at = {f: i for i, f in enumerate(roles.features)}
    return rows.select(*SEG, *[
        F.coalesce(F.col(c).cast("double"), F.col(f"_fill_{at[c]}")).alias(c) if c in at
        else F.col(c) for c in df.columns])


# Credit tiers.
MID_MIN, MID_MAX = 1e7, 2e8
HIGH_RATINGS = ("A-", "A", "A+", "AA-", "AA")


def credit_tier(amt: Column, rating: Column) -> dict[str, Column]:
    """Tier label, mid-tier-high-rating flag and mid-tier-other flag."""
    high = F.coalesce(rating.isin(*HIGH_RATINGS), F.lit(False))
    mid = amt.between(MID_MIN, MID_MAX)
    tier = (F.when(amt <= 0, "no_credit").when(amt < MID_MIN, "low")
            .when(mid & high, "mid_high_rating").when(mid & ~high, "mid_other")
            .when(amt > MID_MAX, "high").otherwise("no_credit"))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return {"credit_tier": tier, "is_mid_high_rating": flag(mid & high),
            "is_mid_other": flag(mid & ~high)}


def credit_wide_table(customers: DataFrame, bad: DataFrame, reports: DataFrame, *, key: str,
                      report_key: str, bad_key: str, report_date: str, report_tiebreak: str,
                      amounts: list[str] = (), industry: DataFrame | None = None,
                      industry_key: str | None = None, industry_order: str | None = None,
                      order: str | None = None, target: str = "is_bad",
                      keep_text: list[str] = ()) -> DataFrame:
    """Customers + label + cleaned amounts + latest report + industry columns, zero filled."""
    base = first_record(customers.withColumn(key, clean_key(F.col(key))), key, order or key)
    base = label_from_list(base, bad.withColumn(bad_key, clean_key(F.col(bad_key))), key, bad_key,
                           target)
    if amounts:
        cleaned = {a: amount(F.when(F.trim(F.col(a).cast("string")) != "-", F.col(a)))
                   for a in amounts}
        base = base.withColumns(cleaned)
        if len(amounts) > 1:
            base = base.withColumn(amounts[0], backfill_total(
                F.col(amounts[0]), [F.col(a) for a in amounts[1:]]))
    rep = latest_record(reports.withColumn(report_key, clean_key(F.col(report_key))), report_key,
                        report_date, report_tiebreak)
    rep = rep.drop(report_date).withColumn("_has_report", F.lit(1))
    rep = rep.withColumnRenamed(report_key, "_rk")
    out = base.join(rep, F.col(key) == F.col("_rk"), "left").drop("_rk")
    if industry is not None:
        ind = first_record(industry.withColumn(industry_key, clean_key(F.col(industry_key))),
                           industry_key, industry_order or industry_key)
        ind = ind.withColumnRenamed(industry_key, "_ik")
        out = out.join(ind, F.col(key) == F.col("_ik"), "left").drop("_ik")
    out = numeric_text(out, exclude=[key, *keep_text])
    return zero_fill(out.withColumn("has_report", F.coalesce("_has_report", F.lit(0)))
                     .drop("_has_report"), exclude=[target])


def coverage_summary(customers: DataFrame, reports: DataFrame, key: str, report_key: str,
                     target: str = "is_bad") -> DataFrame:
    """One row: base size, bads, customers with and without a report, reports out of scope."""
    base = customers.select(clean_key(F.col(key)).alias("k"), F.col(target).alias("y"))
    rep = reports.select(clean_key(F.col(report_key)).alias("k")).distinct().withColumn("r", F.lit(1))
    both = base.withColumn("b", F.lit(1)).join(rep, "k", "full")
    out = both.agg(F.count("b").alias("n"), F.sum(F.col("y").cast("bigint")).alias("n_bad"),
                   F.count_if(F.col("b").isNotNull() & F.col("r").isNotNull()).alias("n_matched"),
                   F.count_if(F.col("b").isNotNull() & F.col("r").isNull()).alias("n_unmatched"),
                   F.count_if(F.col("b").isNull()).alias("n_out_of_scope"))
    return out.withColumn("bad_rate", F.col("n_bad") / F.col("n"))


def finance_wide_table(customers: DataFrame, bad: DataFrame, *, key: str, bad_key: str,
                       changes: DataFrame | None = None, change_date: str | None = None,
                       change_tiebreak: str | None = None, finance: DataFrame | None = None,
                       finance_order: str | None = None, finance_drop: list[str] = (),
                       industry: DataFrame | None = None, industry_order: str | None = None,
                       industry_columns: list[str] = (), amounts: list[str] = (),
                       rating: str | None = None, target: str = "is_bad") -> DataFrame:
    """Customers + latest change row + first finance row + industry + label + amounts + tiers."""
    strip = lambda d: d.withColumn(key, F.trim(F.col(key).cast("string")))
    out = strip(customers)
    if changes is not None:
        ch = strip(changes)
        if change_date:
            ch = latest_record(ch, key, change_date, change_tiebreak or change_date)
        out = out.join(ch, key, "left")
    if finance is not None:
        fin = first_record(strip(finance), key, finance_order or key)
        drop = [c for c in fin.columns if c.endswith("_source") or c in set(finance_drop)]
        out = out.join(fin.drop(*drop), key, "left")
    if industry is not None:
        ind = industry.withColumn(key, clean_key(F.col(key)))
        ind = first_record(ind, key, industry_order or key).select(key, *industry_columns)
        out = out.join(ind, key, "left")
    out = label_from_list(out, strip(bad.withColumnRenamed(bad_key, key)), key, target=target)
    if amounts:
        out = out.withColumns({a: amount(F.col(a), 0.0) for a in amounts})
        r = F.col(rating) if rating else F.lit(None).cast("string")
        out = out.withColumns(credit_tier(F.col(amounts[0]), r))
    return out
