"""Segment profiling and univariate test queries."""

from pyspark.sql import functions as F

from risklens.operators import segments as S, univariate as U
from risklens.plans import oracle as O
from risklens.plans.catalog import query, r, rounded
from risklens.plans.workspace import FEATURES, ROLES, Workspace

K = O.K


def corr_ctes(fill=None, full=False, dims=O.DIMS, tags=O.TAGS, zero=False, only_groups=False) -> list[str]:
    """CTEs up to ``uni``: moments, r, difference, t and dof of the eligible segments."""
    gate = ("elig AS (SELECT * FROM sizes WHERE (n >= 50 OR segment_dim = '__tag__') AND n_bad >= 15 "
            "AND n_good >= 30" + (" AND segment_dim <> '__all__')" if only_groups else ")"))
    pear = "CASE WHEN sx > 0 AND sy > 0 THEN cov / (sx * sy) END"
    se = "(vb / n_bad + vg / n_good)"
    t = f"CASE WHEN {se} > 0 THEN (mean_bad - mean_good) / SQRT({se}) END"
    dof = (f"CASE WHEN {se} > 0 THEN {se} * {se} / (vb / n_bad * vb / n_bad / (n_bad - 1) + "
           f"vg / n_good * vg / n_good / (n_good - 1)) END")
    if zero:
        tested = "n_good >= 30 AND n_bad >= 15"
        corr = f"CASE WHEN n >= 50 AND sx > 0 THEN COALESCE({pear}, 0.0) ELSE 0.0 END"
        diff = f"CASE WHEN {tested} THEN mean_bad - mean_good ELSE 0.0 END"
    else:
        tested = "n_bad > 1 AND n_good > 1"
        corr = f"CASE WHEN n > 2 AND sx > 0 THEN {pear} ELSE 0.0 END"
        diff = "COALESCE(mean_bad - mean_good, 0.0)"
    return [
        O.WIDE, O.seg(full, dims, tags), O.sizes(), gate, O.long(fill=fill),
        f"mom AS (SELECT {K}, COUNT(x) AS n, COUNT(x) FILTER (y = 1) AS n_bad, COUNT(x) FILTER (y = 0) AS n_good, "
        f"AVG(x) FILTER (y = 1) AS mean_bad, AVG(x) FILTER (y = 0) AS mean_good, VAR_SAMP(x) FILTER (y = 1) AS vb, "
        f"VAR_SAMP(x) FILTER (y = 0) AS vg, STDDEV_SAMP(x) AS sx, STDDEV_SAMP(y) FILTER (x IS NOT NULL) AS sy, "
        f"COVAR_SAMP(x, CAST(y AS DOUBLE)) AS cov FROM long GROUP BY {K})",
        f"uni AS (SELECT {K}, n, n_bad, n_good, {corr} AS corr, mean_bad, mean_good, {diff} AS mean_diff, "
        f"CASE WHEN {tested} THEN {t} END AS t_stat, CASE WHEN {tested} THEN {dof} END AS t_dof FROM mom)",
    ]


COLS = ("corr", "t_stat", "t_dof")
OUT = f"SELECT {K}, n, n_bad, n_good, {r(*COLS)}, {r('mean_bad', 'mean_good', 'mean_diff', digits=6)} FROM uni"


def _shown(df):
    keep = [*S.KEY, "n", "n_bad", "n_good", *COLS, "mean_bad", "mean_good", "mean_diff"]
    return rounded(rounded(df.select(*keep), COLS), ("mean_bad", "mean_good", "mean_diff"), 6)


@query("d2_segment_stats", O.with_(O.WIDE, O.seg(full=False, tags=()), O.sizes()) + """
SELECT * FROM (SELECT segment_dim, segment_name, n, n_bad, ROUND(n_bad * 1.0 / n, 4) AS bad_rate,
 ROUND(n * 100.0 / SUM(n) OVER (PARTITION BY segment_dim), 2) AS share_pct FROM sizes) WHERE n >= 50""")
def segment_stats(ws: Workspace):
    return S.segment_stats(ws.wide, ROLES)


_tags = " UNION ALL ".join(
    f"SELECT '{t[3:]}' AS tag, CASE WHEN {t} = 1 THEN 'has' ELSE 'has_not' END AS side, COUNT(*) AS n, "
    f"CAST(SUM(is_bad) AS BIGINT) AS n_bad, SUM(is_bad) * 1.0 / COUNT(*) AS bad_rate FROM wide GROUP BY 2"
    for t in O.TAGS)


@query("d3_tag_stats", O.with_(O.WIDE) + f"SELECT tag, side, n, n_bad, {r('bad_rate')} FROM ({_tags})")
def tag_stats(ws: Workspace):
    return rounded(S.tag_stats(ws.wide, ROLES), ("bad_rate",))


@query("d3_tag_pivot", O.with_(O.WIDE) + f"""
SELECT tag, ROUND(MAX(bad_rate) FILTER (side = 'has'), 6) AS has, ROUND(MAX(bad_rate) FILTER (side = 'has_not'), 6) AS has_not,
 ROUND(MAX(bad_rate) FILTER (side = 'has') - MAX(bad_rate) FILTER (side = 'has_not'), 6) AS rate_diff FROM ({_tags}) GROUP BY tag""")
def tag_pivot(ws: Workspace):
    return rounded(S.tag_pivot(ws.wide, ROLES), ("has", "has_not", "rate_diff"))


@query("d4_univariate_by_group", O.with_(*corr_ctes(tags=())) + OUT)
def univariate_by_group(ws: Workspace):
    return _shown(U.univariate(ws.wide, ROLES, tags=False, p_values=False))


@query("d4_welch_p_values")
def welch_p_values(ws: Workspace):
    return ws.corr.select(*S.KEY, "corr", "mean_diff", "t_stat", "t_dof", "p_value")


@query("d5_univariate_by_tag", O.with_(*corr_ctes(dims=())) + OUT)
def univariate_by_tag(ws: Workspace):
    return _shown(U.univariate(ws.wide, ROLES, dims=False, p_values=False))


@query("d6_univariate_zero_fill", O.with_(*corr_ctes(fill=0, zero=True)) + OUT)
def univariate_zero_fill(ws: Workspace):
    return _shown(U.univariate(ws.wide, ROLES, missing="zero", p_values=False))


_pb = f"""
, pb AS (SELECT feature, n, corr, corr * SQRT((n - 2) / (1 - corr * corr)) AS corr_t, mean_good, mean_bad,
 mean_bad - mean_good AS mean_diff, t_stat, t_dof FROM (SELECT feature, n, CASE WHEN n >= 50 THEN corr END AS corr,
 CASE WHEN n_good >= 30 AND n_bad >= 15 THEN mean_good END AS mean_good,
 CASE WHEN n_good >= 30 AND n_bad >= 15 THEN mean_bad END AS mean_bad,
 CASE WHEN n_good >= 30 AND n_bad >= 15 THEN t_stat END AS t_stat,
 CASE WHEN n_good >= 30 AND n_bad >= 15 THEN t_dof END AS t_dof FROM uni))
"""
FULL = O.with_(*corr_ctes(full=True, dims=(), tags=())) + _pb


@query("d7_point_biserial", FULL + f"SELECT feature, n, {r('corr', 'corr_t')} FROM pb")
def point_biserial(ws: Workspace):
    out = U.point_biserial(ws.wide, ROLES, p_values=False).select("feature", "n", "corr", "corr_t")
    return rounded(out, ("corr", "corr_t"))


@query("d8_welch_t", FULL + f"SELECT feature, {r('mean_good', 'mean_bad', digits=6)}, {r('t_stat', 't_dof')} FROM pb")
def welch_t(ws: Workspace):
    out = U.point_biserial(ws.wide, ROLES, p_values=False)
    out = out.select("feature", "mean_good", "mean_bad", "t_stat", "t_dof")
    return rounded(rounded(out, ("t_stat", "t_dof")), ("mean_good", "mean_bad"), 6)


@query("d9_univariate_full", FULL + f"SELECT feature, n, {r('corr', 'corr_t', 't_stat', 't_dof')}, "
       f"{r('mean_good', 'mean_bad', 'mean_diff', digits=6)} FROM pb")
def univariate_full(ws: Workspace):
    out = U.point_biserial(ws.wide, ROLES, p_values=False)
    out = rounded(out, ("corr", "corr_t", "t_stat", "t_dof"))
    return rounded(out, ("mean_good", "mean_bad", "mean_diff"), 6)


@query("d9_univariate_full_p")
def univariate_full_p(ws: Workspace):
    return U.point_biserial(ws.wide, ROLES).select("feature", "n", "corr", "corr_p", "t_stat", "t_p")


UNI = O.with_(*corr_ctes())


@query("d10_dispersion", UNI + f"""
SELECT segment_dim, feature, {r('corr_mean', 'corr_std', 'corr_range')}, n_groups FROM (SELECT segment_dim, feature,
 AVG(corr) AS corr_mean, STDDEV_SAMP(corr) AS corr_std, MAX(corr) - MIN(corr) AS corr_range, COUNT(*) AS n_groups
 FROM uni WHERE corr IS NOT NULL GROUP BY 1, 2) WHERE n_groups > 1""")
def dispersion(ws: Workspace):
    return rounded(U.dispersion(ws.corr), ("corr_mean", "corr_std", "corr_range"))


@query("d10_dispersion_summary", UNI + """
SELECT feature, ROUND(AVG(m), 4) AS avg_corr, ROUND(AVG(s), 4) AS avg_std, ROUND(AVG(g), 4) AS avg_range FROM (
 SELECT segment_dim, feature, AVG(corr) AS m, STDDEV_SAMP(corr) AS s, MAX(corr) - MIN(corr) AS g, COUNT(*) AS c
 FROM uni WHERE corr IS NOT NULL GROUP BY 1, 2) WHERE c > 1 GROUP BY feature""")
def dispersion_summary(ws: Workspace):
    return U.dispersion_summary(ws.corr)


@query("d11_wide_to_long", UNI + f"SELECT {K}, ROUND(corr, 6) AS corr, ROUND(ABS(corr), 6) AS abs_corr FROM uni "
       f"WHERE corr IS NOT NULL")
def wide_to_long(ws: Workspace):
    matrix = U.to_matrix(ws.corr, FEATURES, "corr")
    return rounded(U.to_long(matrix, FEATURES, "corr"), ("corr", "abs_corr"))


@query("d12_corr_p_long", O.with_(*corr_ctes(fill=0, zero=True, tags=())) +
       f"SELECT {K}, ROUND(corr, 6) AS corr, t_stat IS NOT NULL AS tested FROM uni")
def corr_p_long(ws: Workspace):
    out = U.univariate(ws.wide, ROLES, missing="zero", tags=False)
    return out.select(*S.KEY, F.round("corr", 6).alias("corr"), F.col("t_stat").isNotNull().alias("tested"))
