"""Report, look-up and chart-data queries."""

from pyspark.sql import functions as F

from risklens.config import ALL
from risklens.functions import labels
from risklens.operators import iv as IV, report as RP, thresholds as TH
from risklens.operators.segments import KEY, SEG, group_ledger
from risklens.operators.small import pin
from risklens.plans import oracle as O, q_actions as QA, q_models as QM
from risklens.plans.catalog import query, r, rounded
from risklens.plans.q_iv import REL_SUMMARY
from risklens.plans.q_univariate import UNI, corr_ctes
from risklens.sources.results import OLD_NAMES, export_results, load_results, manifest
from risklens.plans.workspace import DERIVED, DIMS, FEATURES, MODEL_FEATURES, ROLES, Workspace

K = O.K
ALL_DIMS = [*DIMS, "__tag__"]


def rel(ws: Workspace):
    return IV.reliability_summary(ws.iv_all.where(F.col("segment_dim") != ALL))


def groups(ws: Workspace):
    return ws.iv_all.where(F.col("segment_dim") != ALL)


def sizes(ws: Workspace):
    return group_ledger(ws.wide, ROLES).where("status = 'analysed'")


def overall(ws: Workspace) -> float:
    row = ws.wide.agg((F.sum("is_bad") / F.count("*")).alias("r")).first()
    return round(row["r"], 4)


BOTH = [*corr_ctes(full=True, only_groups=True), O.elig(name="gateiv"), O.long(name="lgiv", gate="gateiv"), *O.iv_ctes(src="lgiv"), f"rel AS ({REL_SUMMARY})"]
FULLQ = O.with_(*BOTH)


@query("j1_corr_export", O.with_(*corr_ctes()) + "SELECT segment_dim, segment_name, g.n, g.n_bad, ROUND(g.n_bad * 1.0 / g.n, 6) AS bad_rate, " +
       ", ".join(f"ROUND(MAX(CASE WHEN feature = '{f}' THEN corr END), 6) AS {f}" for f in FEATURES) +
       " FROM uni JOIN elig g USING (segment_dim, segment_name) GROUP BY 1, 2, 3, 4")
def corr_export(ws: Workspace):
    return rounded(RP.corr_export(ws.corr, sizes(ws), FEATURES), ("bad_rate", *FEATURES))


@query("j2_lr_export")
def lr_export(ws: Workspace):
    return RP.lr_export(ws.lr.coefs, ws.lr.auc, MODEL_FEATURES)


_dimcols = [f"{p}_{d.strip('_')}" for p in ("corr", "iv") for d in ALL_DIMS]
_comp = ", ".join([f"ROUND(AVG(corr) FILTER (segment_dim = '{d}'), 6) AS corr_{d.strip('_')}" for d in ALL_DIMS])
_compiv = ", ".join([f"ROUND(AVG(iv) FILTER (segment_dim = '{d}'), 6) AS iv_{d.strip('_')}" for d in ALL_DIMS])
DER = "(" + ", ".join(f"'{f}'" for f in DERIVED) + ")"


@query("j3_comprehensive", FULLQ + f"""
SELECT feature, CASE WHEN feature IN {DER} THEN 'derived' ELSE 'raw' END AS feature_type, ROUND(f.iv, 6) AS iv_all, f.iv_reliability, f.iv_power,
 c.* EXCLUDE (feature), v.* EXCLUDE (feature) FROM ivt f LEFT JOIN (SELECT feature, {_comp} FROM uni GROUP BY feature) c USING (feature)
 LEFT JOIN (SELECT feature, {_compiv} FROM ivt WHERE segment_dim <> '__all__' GROUP BY feature) v USING (feature) WHERE segment_dim = '__all__'""")
def comprehensive(ws: Workspace):
    out = RP.comprehensive(ws.iv_full, ws.corr, groups(ws), ALL_DIMS)
    return rounded(out, ("iv_all", *_dimcols))


@query("j3_comprehensive_lr")
def comprehensive_lr(ws: Workspace):
    return RP.comprehensive(ws.iv_full, ws.corr, groups(ws), ALL_DIMS, ws.lr.coefs)


@query("j4_overview", FULLQ + f"""
SELECT n, n_bad, n_segments, n_reliable_segments, n_warnings, ROUND(n_bad * 1.0 / n, 4) AS bad_rate, n_segments - n_reliable_segments AS
 n_unreliable_segments, '{",".join(DIMS)}' AS dims, 'urgent_buyer,high_balance' AS tags, {len(FEATURES)} AS n_features FROM
 (SELECT COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad FROM wide), (SELECT COUNT(*) AS n_segments, COUNT(*) FILTER (reliable_pct >= 50)
 AS n_reliable_segments, COUNT(*) FILTER (reliable_pct < 50) AS n_warnings FROM rel)""")
def overview(ws: Workspace):
    return RP.overview(ws.wide, ROLES, rel(ws))


STATS = f"""st AS (SELECT feature, AVG(corr) AS corr_mean, STDDEV_POP(corr) AS corr_std, MAX(corr) - MIN(corr) AS corr_range, COUNT(*) AS n_groups,
 CASE WHEN COUNT(*) FILTER (ABS(corr) > 0.02) >= 3 THEN COUNT(*) FILTER (corr > 0.02) * 1.0 / COUNT(*) FILTER (ABS(corr) > 0.02) >= 0.8 OR
 COUNT(*) FILTER (corr > 0.02) * 1.0 / COUNT(*) FILTER (ABS(corr) > 0.02) <= 0.2 ELSE COUNT(*) FILTER (corr > 0) = COUNT(*) OR
 COUNT(*) FILTER (corr < 0) = COUNT(*) END AS sign_consistent FROM uni JOIN rel USING (segment_dim, segment_name)
 WHERE corr IS NOT NULL AND reliable_pct >= 50 GROUP BY feature)"""
_S = ("corr_mean", "corr_std", "corr_range")


@query("j5_corr_stats", O.with_(*BOTH, STATS) + f"SELECT feature, {r(*_S)}, n_groups, sign_consistent FROM st")
def corr_stats(ws: Workspace):
    return rounded(RP.corr_stats(ws.corr, rel(ws)), _S)


@query("j6_lr_stats")
def lr_stats(ws: Workspace):
    return RP.lr_stats(ws.lr.coefs, rel(ws))


SUMM = f"""fs AS (SELECT feature, CASE WHEN feature IN {DER} THEN 'derived' ELSE 'raw' END AS feature_type, iv, iv_power, iv_reliability, corr_mean, corr_std,
 corr_range, COALESCE(st.n_groups, 0) AS n_groups, COALESCE(sign_consistent, FALSE) AS sign_consistent FROM ivt LEFT JOIN st USING (feature)
 WHERE segment_dim = '__all__'),
fr AS (SELECT *, CASE WHEN sign_consistent THEN 'high' WHEN corr_range < 0.2 THEN 'mid' ELSE 'low' END AS consistency,
 CASE WHEN iv >= 0.2 AND sign_consistent THEN 'core' WHEN iv >= 0.1 OR (sign_consistent AND COALESCE(ABS(corr_mean) >= 0.05, FALSE)) THEN 'important'
 WHEN iv >= 0.02 OR COALESCE(ABS(corr_mean) >= 0.05, FALSE) THEN 'auxiliary' ELSE 'invalid' END AS rating FROM fs)"""
SUMQ = O.with_(*BOTH, STATS, SUMM)


def summary(ws: Workspace):
    return RP.feature_summary(ws.iv_full, RP.corr_stats(ws.corr, rel(ws)))


@query("j7_feature_rating", SUMQ + "SELECT feature, rating FROM fr")
def feature_rating(ws: Workspace):
    return summary(ws).select("feature", "rating")


@query("j8_consistency", SUMQ + "SELECT feature, consistency FROM fr")
def consistency(ws: Workspace):
    return summary(ws).select("feature", "consistency")


@query("j9_feature_summary", SUMQ + f"SELECT feature, feature_type, {r('iv', *_S)}, iv_power, iv_reliability, n_groups, sign_consistent, consistency, rating FROM fr")
def feature_summary(ws: Workspace):
    return rounded(summary(ws), ("iv", *_S))


TOPC = """tc AS (SELECT segment_dim, segment_name, STRING_AGG(feature || '(' || CASE WHEN corr > 0 THEN '+' ELSE '-' END || PRINTF('%.3f', ABS(corr)) || ')',
 ', ' ORDER BY rk) AS top3_corr FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_dim, segment_name ORDER BY ROUND(ABS(corr), 9) DESC, feature) AS rk
 FROM uni WHERE corr IS NOT NULL) WHERE rk <= 3 GROUP BY 1, 2)"""
TOPI = """ti AS (SELECT segment_dim, segment_name, STRING_AGG(feature || '(' || PRINTF('%.3f', iv) || ')', ', ' ORDER BY rk) AS top3_iv FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY segment_dim, segment_name ORDER BY ROUND(iv, 9) DESC, feature) AS rk FROM (SELECT *, MAX(CASE WHEN
 iv_reliability = 'reliable' THEN 1 ELSE 0 END) OVER (PARTITION BY segment_dim, segment_name) AS anyrel FROM ivt WHERE iv IS NOT NULL AND
 segment_dim <> '__all__') WHERE anyrel = 0 OR iv_reliability = 'reliable') WHERE rk <= 3 GROUP BY 1, 2)"""


@query("j10_segment_profiles", O.with_(*BOTH, TOPC, TOPI) + """
SELECT segment_dim, segment_name, COALESCE(g.n, rel.n) AS n, COALESCE(g.n_bad, rel.n_bad) AS n_bad, rel.reliable_pct,
 ROUND(COALESCE(g.n_bad, rel.n_bad) * 1.0 / COALESCE(g.n, rel.n), 4) AS bad_rate, tc.top3_corr, ti.top3_iv FROM elig g FULL JOIN rel USING (segment_dim,
 segment_name) LEFT JOIN tc USING (segment_dim, segment_name) LEFT JOIN ti USING (segment_dim, segment_name)""")
def segment_profiles(ws: Workspace):
    return RP.segment_profiles(sizes(ws), rel(ws), ws.corr, groups(ws)).drop("auc", "auc_type")


def profiles(ws: Workspace):
    if not hasattr(ws, "_profiles"):
        ws._profiles = pin(RP.segment_profiles(sizes(ws), rel(ws), ws.corr, groups(ws), ws.lr.auc))
    return ws._profiles


@query("j10_segment_profiles_auc")
def segment_profiles_auc(ws: Workspace):
    return profiles(ws)


@query("j11_top3_corr", O.with_(*corr_ctes(), TOPC) + "SELECT * FROM tc")
def top3_corr(ws: Workspace):
    return RP.top3_corr(ws.corr)


@query("j12_top3_iv", O.with_(*BOTH, TOPI) + "SELECT * FROM ti")
def top3_iv(ws: Workspace):
    return RP.top3_iv(groups(ws))


@query("j13_risk_sentences")
def risk_sentences(ws: Workspace):
    return RP.risk_sentences(profiles(ws), ws.corr, overall(ws), ws.lr.coefs).select(*SEG, "summary")


@query("j14_key_findings")
def key_findings(ws: Workspace):
    return RP.key_findings(summary(ws), profiles(ws), rel(ws), overall(ws))


# A copy of the region dim under another name, minus one group, to have something redundant.
@query("j15_redundant_dims", O.with_(O.WIDE) + """
SELECT 'zone' AS redundant_dim, 'r_name' AS primary_dim, COUNT(*) AS n_same, COUNT(*) * 1.0 / (SELECT COUNT(DISTINCT CASE WHEN r_name = 'ASIA' THEN
 'EAST' ELSE r_name END) FROM wide) AS overlap FROM (SELECT DISTINCT r_name FROM wide WHERE r_name <> 'ASIA')""")
def redundant_dims(ws: Workspace):
    def seg(dim, name):
        return (ws.wide.groupBy(name.alias("segment_name"))
                .agg(F.count("*").alias("n"), F.sum("is_bad").alias("n_bad"))
                .select(F.lit(dim).alias("segment_dim"), "segment_name", "n", "n_bad"))
    zone = F.when(F.col("r_name") == "ASIA", "EAST").otherwise(F.col("r_name"))
    segs = seg("r_name", F.col("r_name")).unionByName(seg("zone", zone)).unionByName(seg("c_mktsegment", F.col("c_mktsegment")))
    return RP.redundant_dims(segs)


@query("j16_split_profiles")
def split_profiles(ws: Workspace):
    p = RP.risk_sentences(profiles(ws), ws.corr, overall(ws), ws.lr.coefs)
    return RP.split_profiles(p, overall(ws)).select(*SEG, "detail", "document")


@query("j17_audit")
def audit(ws: Workspace):
    return RP.audit(ws.iv_full, ws.rules)


@query("j17_audit_iv", O.with_(*O.iv_all(dims=(), tags=())) + "SELECT 'iv_suspect' AS kind, feature AS item, ROUND(iv, 6) AS value FROM ivt WHERE iv > 2.0")
def audit_iv(ws: Workspace):
    return RP.audit(ws.iv_full, ws.rules).where("kind = 'iv_suspect'")


# ---- look-ups --------------------------------------------------------------------------------

IVA = O.with_(*O.iv_all())


@query("k1_top_iv", O.with_(*O.iv_all(dims=(), tags=())) + "SELECT feature, ROUND(iv, 6) AS iv FROM ivt WHERE iv IS NOT NULL ORDER BY ivt.iv DESC, feature LIMIT 5")
def top_iv(ws: Workspace):
    return rounded(RP.top_features(ws.iv_full, "iv", n=5).select("feature", "iv"), ("iv",))


@query("k2_top_iv_group", IVA + f"SELECT {K}, ROUND(iv, 6) AS iv FROM ivt WHERE segment_dim = 'r_name' AND segment_name = 'ASIA' AND iv IS NOT NULL "
       "ORDER BY ivt.iv DESC, feature LIMIT 6")
def top_iv_group(ws: Workspace):
    return rounded(RP.top_features(ws.iv_all, "iv_group", n=6, dim="r_name", group="ASIA").select(*KEY, "iv"), ("iv",))


@query("k3_top_corr", UNI + f"SELECT {K}, ROUND(corr, 6) AS corr FROM uni WHERE segment_dim = 'c_mktsegment' AND corr IS NOT NULL "
       "ORDER BY ABS(uni.corr) DESC, segment_dim, segment_name, feature LIMIT 12")
def top_corr(ws: Workspace):
    return rounded(RP.top_features(ws.corr, "corr", n=12, dim="c_mktsegment").select(*KEY, "corr"), ("corr",))


@query("k4_top_lr")
def top_lr(ws: Workspace):
    return RP.top_features(ws.lr.coefs, "lr", n=10, sign="positive")


# ---- chart data ------------------------------------------------------------------------------

@query("l1_iv_bars", O.with_(*O.iv_all(dims=(), tags=())) + f"SELECT feature, ROUND(iv, 6) AS iv, {O.power()} AS level FROM ivt WHERE iv IS NOT NULL "
       "ORDER BY ivt.iv DESC, feature LIMIT 10")
def iv_bars(ws: Workspace):
    return rounded(RP.chart_iv_full(ws.iv_full, 10), ("iv",))


@query("l2_iv_heatmap", IVA + f""", ordr AS (SELECT segment_dim, feature, ROW_NUMBER() OVER (PARTITION BY segment_dim ORDER BY ROUND(f.iv, 9) DESC, feature) AS rank
 FROM (SELECT DISTINCT segment_dim, feature FROM ivt WHERE segment_dim <> '__all__' AND iv IS NOT NULL) JOIN (SELECT feature, iv FROM ivt WHERE
 segment_dim = '__all__' AND iv IS NOT NULL) f USING (feature)) SELECT {K}, CAST(rank AS INTEGER) AS rank, ROUND(iv, 6) AS iv, iv_reliability,
 iv_reliability LIKE 'unreliable%' AS crossed FROM ivt JOIN ordr USING (segment_dim, feature) WHERE rank <= 8 AND iv IS NOT NULL""")
def iv_heatmap(ws: Workspace):
    return rounded(RP.chart_iv_heatmap(groups(ws), ws.iv_full, 8), ("iv",))


@query("l3_corr_heatmap", UNI + f""", ordr AS (SELECT segment_dim, feature, ROW_NUMBER() OVER (PARTITION BY segment_dim ORDER BY ROUND(MAX(ABS(corr)), 9) DESC, feature)
 AS rank FROM uni WHERE corr IS NOT NULL GROUP BY 1, 2) SELECT {K}, CAST(rank AS INTEGER) AS rank, ROUND(corr, 6) AS corr FROM uni JOIN ordr
 USING (segment_dim, feature) WHERE rank <= 5 AND corr IS NOT NULL""")
def corr_heatmap(ws: Workspace):
    return rounded(RP.chart_heatmap(ws.corr, "corr", 5), ("corr",))


@query("l4_lr_heatmap")
def lr_heatmap(ws: Workspace):
    return RP.chart_heatmap(ws.lr.coefs, "lr_coef", 5)


@query("l5_auc_bars")
def auc_bars(ws: Workspace):
    return RP.chart_auc(ws.lr.auc)


@query("l6_segment_bars", O.with_(*corr_ctes()) + """SELECT segment_dim, segment_name, n, n_bad, ROUND(n_bad * 1.0 / n, 6) AS bad_rate,
 ROUND(AVG(n_bad * 1.0 / n) OVER (), 6) AS baseline, ROUND(SUM(n_bad) OVER () * 1.0 / SUM(n) OVER (), 6) AS weighted_rate FROM elig""")
def segment_bars(ws: Workspace):
    return rounded(RP.chart_segments(sizes(ws)), ("bad_rate", "baseline", "weighted_rate"))


@query("l7_rule_scatter", QM.EV + """SELECT rule_id, ROUND(coverage_pct, 6) AS coverage_pct, ROUND(lift, 6) AS lift, ROUND(30 + bad_n * 300.0 / GREATEST(1,
 MAX(bad_n) OVER ()), 6) AS size, ROW_NUMBER() OVER (ORDER BY lift DESC, coverage_pct DESC, rule_id) <= 3 AS labelled FROM ev WHERE lift IS NOT NULL""")
def rule_scatter(ws: Workspace):
    out = RP.chart_rules(QM._given_eval(ws))
    return rounded(out, ("coverage_pct", "lift", "size"))


_combo = ", ".join(f"({i}, '{' + '.join(sorted({c[0] for c in cs}))}', {len({c[0] for c in cs})})" for i, cs in QM.GIVEN.items())


@query("l8_combination_lift", QM.EV + f"""SELECT combination, ROUND(MAX(lift), 6) AS max_lift, ROUND(SUM(coverage_pct), 6) AS total_coverage, COUNT(*) AS n_rules,
 CAST(MAX(k) AS INTEGER) AS n_features FROM ev JOIN (VALUES {_combo}) c(rule_id, combination, k) USING (rule_id) WHERE lift IS NOT NULL GROUP BY combination""")
def combination_lift(ws: Workspace):
    named = ws.spark.createDataFrame([(i, sorted({c[0] for c in cs})) for i, cs in QM.GIVEN.items()],
                                     "rule_id int, feature_list array<string>")
    out = RP.chart_combinations(QM._given_eval(ws).join(F.broadcast(named), "rule_id"))  # the given rules
    return rounded(out, ("max_lift", "total_coverage"))


@query("l9_threshold_bins", O.with_(*QA.BASE, *QA.PRE, QA.DIRS, QA.BEST) + f"""
SELECT {K}, CAST(p.bin AS INTEGER) AS bin, p.n, ROUND(p.n_bad * 1.0 / p.n, 6) AS bad_rate, CASE WHEN direction = 'positive' THEN
 COALESCE(p.lo, -CAST('infinity' AS DOUBLE)) >= b.cutoff ELSE COALESCE(p.hi, CAST('infinity' AS DOUBLE)) <= b.cutoff END AS high_risk,
 COALESCE(ABS(p.hi - b.cutoff) < 1e-9, FALSE) AS at_cutoff FROM (SELECT *, LAG(hi) OVER (PARTITION BY {K} ORDER BY bin) AS lo FROM pre) p
 JOIN (SELECT {K}, cutoff, direction FROM best) b USING ({K})""")
def threshold_bins(ws: Workspace):
    from pyspark.sql import Window
    pairs, *_, rows = QA._rows(ws)
    pre = pin(TH.pre_bins(rows))
    cuts = TH.best_cut(pre, QA._directions(ws, pairs, pre))
    lo = F.lag("hi").over(Window.partitionBy(*KEY).orderBy("bin"))
    return rounded(RP.chart_threshold_bins(pre.withColumn("lo", lo), cuts), ("bad_rate",))


@query("l10_threshold_ratios", O.with_(*QA.BASE, QA.GIVEN) + f"SELECT {K}, ROUND(risk_ratio, 6) AS risk_ratio, risk_ratio >= 2 AS is_valid FROM met")
def threshold_ratios(ws: Workspace):
    m = QA._cut_metrics(ws).withColumn("is_valid", F.col("risk_ratio") >= 2)
    return rounded(RP.chart_threshold_ratios(m), ("risk_ratio",))


# ---- sources that need results ----------------------------------------------------------------

@query("a8_threshold_outputs")
def threshold_outputs(ws: Workspace):
    """Summary and bin detail as written and read again."""
    s, d, _ = QA.explored(ws)
    path = ws.path("thresholds")
    export_results({"summary": s, "bins": d}, path)
    got = load_results(ws.spark, path, ["summary", "bins"])
    return got["bins"].join(got["summary"].select(*KEY, "cutoff", "is_valid"), KEY)


@query("a5_result_bundle", FULLQ + """
SELECT 'iv_full' AS result, COUNT(*) AS n_rows FROM ivt WHERE segment_dim = '__all__' UNION ALL SELECT 'iv_group', COUNT(*) FROM ivt WHERE segment_dim <> '__all__'
UNION ALL SELECT 'corr', COUNT(*) FROM uni UNION ALL SELECT 'reliability', COUNT(*) FROM rel""")
def result_bundle(ws: Workspace):
    """Manifest of the named result tables as exported and reloaded."""
    path = ws.path("results")
    tables = {"iv_full": ws.iv_full, "iv_group": groups(ws), "corr": ws.corr, "reliability": rel(ws)}
    export_results(tables, path)
    return manifest(load_results(ws.spark, path, list(tables)))


@query("a6_reload_old_names", FULLQ + "SELECT segment_dim, segment_name, feature, ROUND(iv, 6) AS iv, iv_reliability FROM ivt WHERE segment_dim <> '__all__'")
def reload_old_names(ws: Workspace):
    """Results exported under older table and column names."""
    path = ws.path("old_results")
    now = groups(ws).select(*KEY, "iv", "iv_reliability")
    back = {n: o for o, n in reversed(OLD_NAMES.items()) if n in now.columns}
    export_results({"iv_by_group": now.withColumnsRenamed(back)}, path)
    return rounded(load_results(ws.spark, path, ["iv_group"], {"iv_group": ["iv_by_group"]})["iv_group"], ("iv",))


COLUMNS = {
    "customer": "c_acctbal c_custkey c_mktsegment c_name c_nationkey", "supplier": "s_acctbal s_name s_nationkey s_suppkey",
    "part": "p_brand p_name p_partkey p_retailprice p_size p_type"}


def _hash_sql(table: str) -> str:
    text = " || ".join(f"COALESCE(LENGTH({c}::VARCHAR) || ':' || {c}::VARCHAR, '-1:')" for c in COLUMNS[table].split())
    return f"SELECT '{table}' AS table_name, COUNT(*) AS n_rows, SUM(('0x' || md5({text})[1:15])::HUGEINT)::VARCHAR AS hash_sum FROM {table}"


@query("a11_fingerprint_checked", " UNION ALL ".join(map(_hash_sql, COLUMNS)))
def fingerprint_checked(ws: Workspace):
    """Fingerprints of the tables whose values read the same as text in both engines."""
    from risklens.sources.tables import fingerprint
    out = None
    for t, cols in COLUMNS.items():
        row = fingerprint(ws.table(t).select(*cols.split())).select(F.lit(t).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query("a11_table_fingerprint")
def table_fingerprint(ws: Workspace):
    from risklens.sources.tables import fingerprint
    out = None
    for t in ("customer", "orders", "lineitem", "part", "supplier", "events"):
        row = fingerprint(ws.table(t)).select(F.lit(t).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out
