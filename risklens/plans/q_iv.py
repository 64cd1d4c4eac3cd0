"""Information value queries."""

from pyspark.sql import functions as F

from risklens.config import ALL, TAG_DIM
from risklens.functions import labels
from risklens.operators import iv as IV
from risklens.plans import oracle as O
from risklens.plans.catalog import query, r, rounded
from risklens.plans.workspace import DERIVED, DIMS, FEATURES, ROLES, TAGS, Workspace

IV_COLS = ("iv", "iv_missing", "iv_nonmissing")
K = O.K
FULL = O.with_(*O.iv_all(dims=(), tags=()))
EVERY = O.with_(*O.iv_all())
DERIVED_SQL = "(" + ", ".join(f"'{f}'" for f in DERIVED) + ")"


@query("e1_adaptive_bins", O.with_(O.WIDE, O.seg(), O.sizes(), O.elig(1, 0), O.long(), *O.binning()[:1]) +
       f"SELECT {K}, n, n_bad, CAST(k AS INTEGER) AS k FROM tot")
def adaptive_bins(ws: Workspace):
    from risklens.operators.segments import eligible, long_form
    segs = eligible(ws.wide, ROLES, 1, 0)
    y = F.when(F.col("x").isNotNull(), F.col("y").cast("bigint"))
    return (long_form(ws.wide, ROLES, segs).groupBy("segment_dim", "segment_name", "feature")
            .agg(F.count("x").alias("n"), F.coalesce(F.sum(y), F.lit(0)).alias("n_bad"))
            .withColumn("k", labels.adaptive_bins(F.col("n"), F.col("n_bad"))))


@query("e2_quantile_bins", O.with_(*O.iv_all()[:-2]) +
       f"SELECT {K}, kind, n, n_bad, {r('x_min', 'x_max')} FROM bins")
def quantile_bins(ws: Workspace):
    from risklens.operators.segments import eligible, long_form
    segs = eligible(ws.wide, ROLES, 50, 10)
    return rounded(IV.adaptive_binning(long_form(ws.wide, ROLES, segs)).bins, ("x_min", "x_max"))


@query("e3_iv_value", EVERY + f"SELECT {K}, n, n_bad, n_missing, n_bins, {r(*IV_COLS)} FROM ivt")
def iv_value(ws: Workspace):
    out = ws.iv_all.select("segment_dim", "segment_name", "feature", "n", "n_bad", "n_missing",
                           "n_bins", *IV_COLS)
    return rounded(out, IV_COLS)


@query("e4_iv_reliability", EVERY + f"SELECT {K}, iv_reliability FROM ivt")
def iv_reliability(ws: Workspace):
    return ws.iv_all.select("segment_dim", "segment_name", "feature", "iv_reliability")


@query("e5_iv_power", EVERY + f"SELECT {K}, iv_power FROM ivt")
def iv_power(ws: Workspace):
    return ws.iv_all.select("segment_dim", "segment_name", "feature", "iv_power")


@query("e6_iv_full", FULL + f"SELECT feature, CASE WHEN feature IN {DERIVED_SQL} THEN 'derived' ELSE 'raw' "
       f"END AS feature_type, {r('iv')}, {O.level()} AS iv_level, iv_reliability, segment_n, segment_bad "
       f"FROM ivt")
def iv_full(ws: Workspace):
    out = ws.iv_full.select("feature", "feature_type", F.round("iv", 6).alias("iv"), "iv_level",
                            "iv_reliability", "segment_n", "segment_bad")
    return out.orderBy(F.desc_nulls_last("iv"), "feature")


@query("e7_iv_by_group", O.with_(*O.iv_all(full=False, tags=())) +
       f"SELECT {K}, n, n_bad, {r('iv')}, iv_reliability, iv_power FROM ivt")
def iv_by_group(ws: Workspace):
    out = IV.iv_segments(ws.wide, ROLES, tags=False)
    return rounded(out.select("segment_dim", "segment_name", "feature", "n", "n_bad", "iv",
                              "iv_reliability", "iv_power"), ("iv",))


@query("e8_iv_by_tag", O.with_(*O.iv_all(full=False, dims=())) +
       f"SELECT {K}, n, n_bad, {r('iv')}, iv_reliability, iv_power FROM ivt")
def iv_by_tag(ws: Workspace):
    out = IV.iv_segments(ws.wide, ROLES, dims=False)
    return rounded(out.select("segment_dim", "segment_name", "feature", "n", "n_bad", "iv",
                              "iv_reliability", "iv_power"), ("iv",))


CAPS = {"n_name": 10, "c_mktsegment": 3}
_capped = ("elig AS (SELECT * EXCLUDE (rk) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_dim "
           "ORDER BY n DESC, segment_name) AS rk FROM sizes WHERE segment_dim = '__all__' OR "
           "(n >= 50 AND n_bad >= 10)) WHERE NOT (segment_dim = 'n_name' AND rk > 10) "
           "AND NOT (segment_dim = 'c_mktsegment' AND rk > 3))")


@query("e9_iv_analysis", O.with_(O.WIDE, O.seg(), O.sizes(), _capped, O.long(), *O.iv_ctes()) +
       f"SELECT {K}, {r(*IV_COLS)}, n_missing, segment_n, segment_bad, "
       f"ROUND(segment_bad_rate, 4) AS segment_bad_rate, n, n_bad, n_bins, iv_reliability FROM ivt")
def iv_analysis(ws: Workspace):
    out = IV.iv_segments(ws.wide, ROLES, full=True, caps=CAPS)
    out = out.withColumn("segment_bad_rate", F.round("segment_bad_rate", 4))
    return rounded(out.drop("iv_power"), IV_COLS)


_summary = ("SELECT segment_dim, segment_name, MAX(segment_n) AS n, MAX(segment_bad) AS n_bad, "
            "COUNT(*) AS n_features, COUNT(*) FILTER (iv_reliability = 'reliable') AS n_reliable, "
            "COUNT(*) FILTER (iv_reliability = 'reference') AS n_reference, "
            "COUNT(*) FILTER (iv_reliability NOT IN ('reliable', 'reference')) AS n_unreliable, "
            "ROUND(COUNT(*) FILTER (iv_reliability = 'reliable') * 100.0 / COUNT(*), 1) AS reliable_pct "
            "FROM ivt WHERE segment_dim <> '__all__' GROUP BY 1, 2")
REL_SUMMARY = _summary


@query("e10_reliability_diagnosis", EVERY + f"SELECT *, reliable_pct < 50 AS warn FROM ({_summary})")
def reliability_diagnosis(ws: Workspace):
    return IV.reliability_summary(ws.iv_all.where(F.col("segment_dim") != ALL))


@query("e10_reliability_levels", EVERY +
       "SELECT iv_reliability, COUNT(*) AS n_rows, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 1) "
       "AS share_pct FROM ivt WHERE segment_dim <> '__all__' GROUP BY 1")
def reliability_levels(ws: Workspace):
    return IV.reliability_levels(ws.iv_all.where(F.col("segment_dim") != ALL))


def woe_sql(ctes: list[str]) -> str:
    tg = "(n_rows - bad_rows)"
    w = O.woe("(n - n_bad)", "n_bad", "tg", "tb")
    p = O.part("(n - n_bad)", "n_bad", "tg", "tb")
    return O.with_(*ctes[:-2]) + (
        f"SELECT {K}, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY x_min NULLS LAST) AS bin_no, kind, "
        f"{r('x_min', 'x_max')}, n, n_bad, ROUND((CASE WHEN n_bad = 0 THEN 0.5 ELSE n_bad END) / n, 6) "
        f"AS bad_rate, ROUND({w}, 6) AS woe, ROUND({p}, 6) AS iv FROM ("
        f"SELECT b.segment_dim, b.segment_name, b.feature, b.kind, b.n, b.n_bad, x_min, x_max, {tg} AS tg, "
        f"bad_rows AS tb FROM bins b JOIN tot USING ({K}) WHERE nd > 1 UNION ALL "
        f"SELECT {K}, 'missing', n_rows - n, bad_rows - n_bad, NULL, NULL, {tg}, bad_rows FROM tot "
        f"WHERE computable AND nd > 1 AND n_rows > n)")


@query("e11_woe_table", woe_sql(O.iv_all(dims=(), tags=())))
def woe_table(ws: Workspace):
    return rounded(IV.woe_table(ws.wide, ROLES), ("x_min", "x_max", "bad_rate", "woe", "iv"))


@query("e11_woe_by_value", O.with_(O.WIDE) + f"""
SELECT value, n, n_bad, ROUND((CASE WHEN n_bad = 0 THEN 0.5 ELSE n_bad END) / n, 6) AS bad_rate,
 ROUND({O.woe('(n - n_bad)', 'n_bad', 'tg', 'tb')}, 6) AS woe,
 ROUND({O.part('(n - n_bad)', 'n_bad', 'tg', 'tb')}, 6) AS iv
FROM (SELECT n_name AS value, COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad,
 (SELECT COUNT(*) - SUM(is_bad) FROM wide) AS tg, (SELECT SUM(is_bad) FROM wide) AS tb
 FROM wide GROUP BY n_name)""")
def woe_by_value(ws: Workspace):
    return rounded(IV.woe_by_value(ws.wide, "n_name", "is_bad"), ("bad_rate", "woe", "iv"))


@query("e12_group_woe_table", woe_sql(O.iv_all(full=False, dims=("c_mktsegment",), tags=())))
def group_woe_table(ws: Workspace):
    from risklens.config import Roles
    roles = Roles("c_custkey", "is_bad", FEATURES, ("c_mktsegment",))
    return rounded(IV.woe_table(ws.wide, roles, full=False, dims=True),
                   ("x_min", "x_max", "bad_rate", "woe", "iv"))


_cells = f"""
, g0 AS (SELECT *, CASE WHEN segment_dim = '__all__' THEN '__all__' ELSE segment_dim || '_' || segment_name
 END AS grp FROM ivt WHERE iv IS NOT NULL AND (segment_dim IN ('__all__', 'c_mktsegment', 'r_name'))),
g1 AS (SELECT grp, ROW_NUMBER() OVER (ORDER BY ROUND(AVG(iv), 9) DESC, grp) AS group_rank FROM g0 GROUP BY grp),
f1 AS (SELECT feature, ROW_NUMBER() OVER (ORDER BY iv DESC, feature) AS feature_rank FROM g0
 WHERE grp = '__all__'),
cells AS (SELECT feature, feature_rank, grp AS "group", group_rank, iv, iv_reliability FROM g0
 JOIN g1 USING (grp) JOIN f1 USING (feature) WHERE group_rank <= 12 AND feature_rank <= 8)
"""
PREFIXES = [ALL, "c_mktsegment", "r_name"]


@query("e13_group_iv_pivot", EVERY + _cells + 'SELECT feature, CAST(feature_rank AS INTEGER) AS feature_rank, '
       '"group", CAST(group_rank AS INTEGER) AS group_rank, ROUND(iv, 6) AS iv FROM cells')
def group_iv_pivot(ws: Workspace):
    c = IV.group_iv_cells(ws.iv_all, 12, 8, PREFIXES)
    return rounded(c.drop("iv_reliability"), ("iv",))


@query("e14_reliability_pivot", EVERY + _cells + 'SELECT feature, "group", iv_reliability FROM cells')
def reliability_pivot(ws: Workspace):
    return IV.group_iv_cells(ws.iv_all, 12, 8, PREFIXES).select("feature", "group", "iv_reliability")


@query("e15_segment_summary", EVERY +
       "SELECT segment_dim, segment_name, MAX(segment_n) AS segment_n, MAX(segment_bad) AS segment_bad, "
       "ROUND(MAX(segment_bad_rate), 4) AS segment_bad_rate, COUNT(*) FILTER (iv_reliability = 'reliable') "
       "AS n_reliable, COUNT(*) AS n_features, COUNT(*) FILTER (iv_reliability LIKE 'unreliable%') AS "
       "n_unreliable, ROUND(COUNT(*) FILTER (iv_reliability = 'reliable') * 100.0 / COUNT(*), 1) AS "
       "reliable_pct FROM ivt GROUP BY 1, 2")
def segment_summary(ws: Workspace):
    return IV.segment_summary(ws.iv_all)


@query("e16_recommendations", EVERY +
       f"SELECT m.feature, m.segment_dim, m.segment_name, {r('m.iv').replace('AS m.iv', 'AS iv')}, "
       f"m.iv_reliability, ROUND(b.iv, 6) AS iv_all, ROUND(m.iv - b.iv, 6) AS iv_diff FROM ivt m "
       f"LEFT JOIN ivt b ON b.feature = m.feature AND b.segment_dim = '__all__' "
       f"WHERE m.segment_dim = 'c_mktsegment' AND m.segment_name = 'BUILDING' AND m.iv IS NOT NULL "
       f"AND m.iv_reliability NOT LIKE 'unreliable%' AND m.iv >= 0.02 ORDER BY m.iv DESC, m.feature LIMIT 10")
def recommendations(ws: Workspace):
    return rounded(IV.recommendations(ws.iv_all, "c_mktsegment", "BUILDING"),
                   ("iv", "iv_all", "iv_diff"))


def _pivot_sql(value: str, digits: int | None) -> str:
    val = f"ROUND({value}, {digits})" if digits else value
    return EVERY + "SELECT segment_dim, segment_name, " + ", ".join(
        f"MAX(CASE WHEN feature = '{f}' THEN {val} END) AS {f}" for f in FEATURES) + (
        " FROM ivt WHERE segment_dim <> '__all__' GROUP BY 1, 2")


@query("e17_export_iv_pivot", _pivot_sql("iv", 6))
def export_iv_pivot(ws: Workspace):
    return rounded(IV.export_pivots(ws.iv_all.where(F.col("segment_dim") != ALL), FEATURES, "iv"),
                   FEATURES)


@query("e17_export_reliability_pivot", _pivot_sql("iv_reliability", None))
def export_reliability_pivot(ws: Workspace):
    return IV.export_pivots(ws.iv_all.where(F.col("segment_dim") != ALL), FEATURES, "iv_reliability")
