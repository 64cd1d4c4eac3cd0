"""Label and score expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from risklens.config import IV, RULES, THRESHOLDS


def adaptive_bins(n: Column, n_bad: Column, bins: int = IV.bins) -> Column:
    by_bad = F.greatest(F.lit(IV.min_bins), F.floor(n_bad / 3).cast("int"))
    by_n = F.greatest(F.lit(IV.min_bins), F.floor(n / 20).cast("int"))
    small = F.greatest(F.lit(IV.min_bins), F.least(by_bad, by_n, F.lit(bins)))
    return F.when((n >= IV.full_bins_n) & (n_bad >= IV.full_bins_bad), F.lit(bins)).otherwise(small)


def iv_reliability(iv: Column, n: Column, n_bad: Column) -> Column:
    return (F.when(iv.isNull(), "not_computable")
            .when(iv > IV.suspect, "unreliable_leak")
            .when((n_bad < IV.strict_bad) & (iv > IV.low_bad_iv), "unreliable_small")
            .when(n_bad < IV.strict_bad, "reference")
            .when(n < IV.low_n, "reference")
            .when(iv > IV.reference_iv, "reference")
            .otherwise("reliable"))


def iv_power(iv: Column) -> Column:
    return (F.when(iv >= IV.strong, "strong").when(iv >= IV.medium, "medium")
            .when(iv >= IV.weak, "weak").otherwise("none"))


def iv_level(iv: Column) -> Column:
    """Six-way label of the full-sample table."""
    return (F.when(iv.isNull(), "not_computable").when(iv >= IV.too_strong, "too_strong")
            .otherwise(iv_power(iv)))


def woe(good: Column, bad: Column, total_good: Column, total_bad: Column) -> Column:
    raw = F.ln(share(good, total_good) / share(bad, total_bad))
    return F.greatest(F.lit(-IV.woe_cap), F.least(F.lit(IV.woe_cap), raw))


def share(cell: Column, total: Column) -> Column:
    """Share of the class total; an empty cell counts as half a case."""
    return F.when(cell == 0, F.lit(0.5)).otherwise(cell.cast("double")) / total.cast("double")


def iv_part(good: Column, bad: Column, total_good: Column, total_bad: Column) -> Column:
    return ((share(good, total_good) - share(bad, total_bad))
            * woe(good, bad, total_good, total_bad))


def signal_strength(iv: Column, reliability: Column) -> Column:
    return (F.when(reliability.isNull() | (reliability != "reliable"), "watch")
            .when(iv >= 0.10, "strong").when(iv >= 0.05, "medium")
            .when(iv >= 0.02, "weak").otherwise("watch"))


def rate_feature(iv: Column, corr_mean: Column, consistent: Column) -> Column:
    strong_corr = F.coalesce(F.abs(corr_mean) >= 0.05, F.lit(False))
    return (F.when((iv >= 0.2) & consistent, "core")
            .when((iv >= 0.1) | (consistent & strong_corr), "important")
            .when((iv >= 0.02) | strong_corr, "auxiliary")
            .otherwise("invalid"))


def consistency_level(corr_range: Column, consistent: Column) -> Column:
    return (F.when(consistent, "high").when(corr_range < 0.2, "mid").otherwise("low"))


def stars(p: Column) -> Column:
    c = None
    for limit, label in THRESHOLDS.stars:
        c = F.when(p < limit, label) if c is None else c.when(p < limit, label)
    return c.otherwise("ns")


def wilson(p: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    n = n.cast("double")
    z2 = F.lit(z * z)
    denom = F.lit(1.0) + z2 / n
    center = (p + z2 / (F.lit(2.0) * n)) / denom
    margin = (F.lit(z) / denom) * F.sqrt(p * (F.lit(1.0) - p) / n + z2 / (F.lit(4.0) * n * n))
    low = F.when(n > 0, F.greatest(F.lit(0.0), center - margin))
    high = F.when(n > 0, F.least(F.lit(1.0), center + margin))
    return low, high


def stability_grade(mean: Column, std: Column, valid_ratio: Column) -> Column:
    cv = F.try_divide(std, mean)
    return (F.when((valid_ratio < RULES.min_valid_ratio) | mean.isNull() | (mean == 0), "unstable")
            .when(cv <= RULES.cv_stable, "stable").when(cv <= RULES.cv_fair, "fair")
            .otherwise("unstable"))


def suggested_use(lift: Column, stability: Column) -> Column:
    return (F.when(stability == "unstable", "reference")
            .when(lift >= RULES.lift_stop, "hard_stop")
            .when(lift >= RULES.lift_warn, "warning").otherwise("reference"))


def safe_divide(num: Column, den: Column, fill: float | None = None) -> Column:
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return q if fill is None else F.coalesce(q, F.lit(float(fill)))
