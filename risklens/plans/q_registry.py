"""Indicator registry queries. Proposals and registry rows are derived from the part table."""

from pyspark.sql import functions as F

from risklens.operators import registry as RG
from risklens.plans import oracle as O
from risklens.plans.catalog import query, r, rounded
from risklens.plans.q_univariate import corr_ctes
from risklens.plans.workspace import Workspace

TODAY, EARLIER = "2024-06-01", "2024-01-01"
OPEN = RG.OPEN
_doms = "[" + ", ".join(f"'{d}'" for d in RG.DOMAINS) + "]"

PROP = f"""prop AS (SELECT p_partkey, p_type, p_size, dom || '_' || gran || '_' || p_type || '_' || p_partkey || '_SNAP_AMT' AS ind_code, 1 AS ind_version,
 CASE WHEN p_type = 'ECONOMY' THEN p_name || ' economy' WHEN p_type = 'LARGE' THEN p_name || ' fresh wording' ELSE p_name || ' ' || LOWER(p_type) || ' ' || p_size END AS ind_name,
 dom AS domain, gran AS granularity, 'SNAP' AS "window", 'NUM' AS value_type, 'price of ' || p_name AS biz_definition,
 CASE WHEN p_type = 'PROMO' THEN 'datediff(current_date, x)' WHEN p_type = 'SMALL' THEN 'NOW () - min(x)' WHEN p_type = 'LARGE' THEN 'x' ELSE
 'sum(' || LOWER(p_type) || ') / nullif(count(x), 0) where part_ymd = d' END AS calc_logic,
 CASE WHEN p_size = 50 THEN NULL ELSE REPLACE(UPPER(p_brand), '#', '_') END AS src_table, CASE WHEN p_size = 49 THEN 'odd text' ELSE REPLACE(UPPER(p_brand), '#', '_') || '.' || p_type || '(x)' END AS src_field,
 CASE WHEN p_size = 48 THEN 'P9' WHEN p_size >= 45 THEN 'P0-blocked' ELSE 'P2' END AS priority, (p_retailprice - 900) / 397 AS current_iv, p_size / 50.0 AS current_coverage_rate,
 CASE WHEN p_type = 'MEDIUM' THEN 'reference' ELSE 'reliable' END AS current_reliability,
 CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN 'SUCCESS' WHEN p_size % 4 = 2 THEN 'FAIL' ELSE 'NO_DATA' END AS vstatus
 FROM (SELECT *, {_doms}[p_size % 9 + 1] AS dom, ['M', 'D', 'A'][p_size % 3 + 1] AS gran FROM part))"""

REG = f"""reg AS (SELECT ind_code, CASE WHEN p_size <= 5 THEN 2 ELSE 1 END AS ind_version, ind_name, domain, granularity, "window", value_type,
 CASE WHEN p_type = 'STANDARD' THEN 'old ' ELSE '' END || biz_definition AS biz_definition, calc_logic, src_table, current_iv / 2 AS current_iv, 'P3-watch' AS priority,
 'ACTIVE' AS lifecycle_status, '{EARLIER}' AS eff_dt, '{OPEN}' AS exp_dt, 'b0' AS batch_id FROM prop WHERE p_size <= 30 UNION ALL
 SELECT ind_code, 1, ind_name, domain, granularity, "window", value_type, 'first ' || biz_definition, calc_logic, src_table, current_iv / 2, 'P3-watch', 'ACTIVE', '2023-01-01',
 '{EARLIER}', 'b00' FROM prop WHERE p_size <= 5)"""
SQL = O.with_(PROP, REG)


def proposals(ws: Workspace):
    p = ws.table("part")
    dom = F.element_at(F.array(*[F.lit(d) for d in RG.DOMAINS]), F.col("p_size") % 9 + 1)
    gran = F.element_at(F.array(*[F.lit(g) for g in "MDA"]), F.col("p_size") % 3 + 1)
    key, size, kind = F.col("p_partkey").cast("string"), F.col("p_size").cast("string"), F.col("p_type")
    brand = F.replace(F.upper("p_brand"), F.lit("#"), F.lit("_"))
    name = (F.when(kind == "ECONOMY", F.concat("p_name", F.lit(" economy")))
            .when(kind == "LARGE", F.concat("p_name", F.lit(" fresh wording")))
            .otherwise(F.concat_ws(" ", "p_name", F.lower("p_type"), size)))
    calc = (F.when(kind == "PROMO", "datediff(current_date, x)").when(kind == "SMALL", "NOW () - min(x)").when(kind == "LARGE", "x")
            .otherwise(F.concat(F.lit("sum("), F.lower("p_type"), F.lit(") / nullif(count(x), 0) where part_ymd = d"))))
    field = F.when(F.col("p_size") == 49, "odd text").otherwise(F.concat(brand, F.lit("."), kind, F.lit("(x)")))
    return p.select(
        "p_partkey", "p_type", "p_size", F.concat_ws("_", dom, gran, kind, key, F.lit("SNAP"), F.lit("AMT")).alias("ind_code"),
        F.lit(1).alias("ind_version"), name.alias("ind_name"), dom.alias("domain"), gran.alias("granularity"), F.lit("SNAP").alias("window"),
        F.lit("NUM").alias("value_type"), F.concat(F.lit("price of "), "p_name").alias("biz_definition"), calc.alias("calc_logic"),
        F.when(F.col("p_size") == 50, F.array().cast("array<string>")).otherwise(F.array(brand)).alias("source_tables"),
        F.array(field).alias("source_fields"),
        F.when(F.col("p_size") == 48, "P9").when(F.col("p_size") >= 45, "P0-blocked").otherwise("P2").alias("priority"),
        ((F.col("p_retailprice") - 900) / 397).alias("current_iv"), (F.col("p_size") / 50.0).alias("current_coverage_rate"),
        F.when(kind == "MEDIUM", "reference").otherwise("reliable").alias("current_reliability"),
        F.lit(None).cast("string").alias("current_risk_direction"),
        F.lit(None).cast("array<struct<snap_dt:string,iv:double,credibility:string,sample_size:bigint,project:string>>").alias("iv_history"),
        F.lit("ACTIVE").alias("lifecycle_status"), F.lit("AGENT").alias("proposer"), F.lit("RISK_TEAM").alias("owner"),
        F.lit(TODAY).alias("eff_dt"), F.lit(OPEN).alias("exp_dt"), F.lit(0).alias("is_dynamic_expansion"), F.lit("BATCH_MAX").alias("ref_date_logic"),
        F.array(F.lit("KEEP_NULL")).alias("null_handling"), F.lit("NONE").alias("post_processing_rule"))


REG_COLS = ("ind_code", "ind_version", "ind_name", "domain", "granularity", "window", "value_type", "biz_definition", "calc_logic", "source_tables",
            "current_iv", "priority", "lifecycle_status", "eff_dt", "exp_dt", "batch_id")


def registry(ws: Workspace):
    base = proposals(ws).where("p_size <= 30").withColumn("current_iv", F.col("current_iv") / 2).withColumn("priority", F.lit("P3-watch"))
    biz = F.col("biz_definition")
    now = base.withColumns({
        "ind_version": F.when(F.col("p_size") <= 5, 2).otherwise(1), "batch_id": F.lit("b0"), "eff_dt": F.lit(EARLIER),
        "biz_definition": F.when(F.col("p_type") == "STANDARD", F.concat(F.lit("old "), biz)).otherwise(biz)})
    past = base.where("p_size <= 5").withColumns({
        "batch_id": F.lit("b00"), "eff_dt": F.lit("2023-01-01"), "exp_dt": F.lit(EARLIER), "biz_definition": F.concat(F.lit("first "), biz)})
    return now.select(*REG_COLS).unionByName(past.select(*REG_COLS))


# ---- candidates ------------------------------------------------------------------------------

IVQ = O.with_(*O.iv_all(tags=()), """proj AS (SELECT CASE WHEN segment_dim = '__all__' THEN '财务行业风险分析' WHEN segment_name = 'ASIA' THEN '征信 ASIA' WHEN segment_name = 'EUROPE'
 THEN '担保 EUROPE' ELSE segment_name END AS project, * FROM ivt WHERE segment_dim IN ('__all__', 'r_name'))""")


def projects(ws: Workspace):
    """The full sample and every region as if they were separate projects."""
    def part(df):
        return df.select(F.lit("__all__").alias("segment_dim"), F.lit("__all__").alias("segment_name"),
                         *[c for c in df.columns if c not in ("segment_dim", "segment_name")])
    names = {"ASIA": "征信 ASIA", "EUROPE": "担保 EUROPE", "AFRICA": "AFRICA", "AMERICA": "AMERICA", "MIDDLE EAST": "MIDDLE EAST"}
    tables = {"财务行业风险分析": part(ws.iv_all.where("segment_dim = '__all__'"))}
    for region, project in names.items():
        tables[project] = part(ws.iv_all.where((F.col("segment_dim") == "r_name") & (F.col("segment_name") == region)))
    return RG.union_projects(tables)


@query("m1_union_iv", IVQ + "SELECT project, feature, ROUND(iv, 6) AS iv, iv_reliability FROM proj")
def union_iv(ws: Workspace):
    return rounded(projects(ws).select("project", "feature", "iv", "iv_reliability"), ("iv",))


COEF = O.with_(*corr_ctes(tags=()))


def coefs(ws: Workspace):
    """Signed per-segment measures standing in for coefficients, so that the check SQL can follow."""
    return ws.corr.where("segment_dim <> '__tag__'").select("segment_dim", "segment_name", "feature", F.col("corr").alias("lr_coef"))


@query("m2_union_lr", COEF + "SELECT segment_dim AS project, segment_name, feature, ROUND(corr, 6) AS lr_coef FROM uni")
def union_lr(ws: Workspace):
    c = coefs(ws)
    out = RG.union_projects({d: c.where(F.col("segment_dim") == d).drop("segment_dim") for d in O.DIMS})
    return rounded(out.select("project", "segment_name", "feature", "lr_coef"), ("lr_coef",))


@query("m2_union_lr_coefs")
def union_lr_coefs(ws: Workspace):
    """The fitted coefficients of every project."""
    c = ws.lr.coefs.where("segment_dim <> '__tag__'")
    return RG.union_projects({d: c.where(F.col("segment_dim") == d).drop("segment_dim") for d in O.DIMS}).select(
        "project", "segment_name", "feature", "lr_coef")


FIL = "fil AS (SELECT *, ROUND(1 - n_missing * 1.0 / segment_n, 4) AS coverage_rate FROM proj WHERE iv_reliability NOT IN ('not_computable', 'unreliable_leak') AND iv < 2)"


def filtered(ws: Workspace):
    return RG.add_coverage(RG.filter_iv(projects(ws)))


@query("m3_filter_iv", IVQ + f", {FIL} SELECT project, feature, ROUND(iv, 6) AS iv FROM fil")
def filter_iv(ws: Workspace):
    return rounded(RG.filter_iv(projects(ws)).select("project", "feature", "iv"), ("iv",))


@query("m4_coverage_rate", IVQ + f", {FIL} SELECT project, feature, coverage_rate FROM fil")
def coverage_rate(ws: Workspace):
    return filtered(ws).select("project", "feature", "coverage_rate")


_signal = ("CASE WHEN iv_reliability <> 'reliable' THEN 'watch' WHEN iv >= 0.10 THEN 'strong' WHEN iv >= 0.05 THEN 'medium' WHEN iv >= 0.02 "
           "THEN 'weak' ELSE 'watch' END")


@query("m5_signal_strength", IVQ + f", {FIL} SELECT project, feature, {_signal} AS signal_strength FROM fil")
def signal_strength(ws: Workspace):
    from risklens.functions.labels import signal_strength as s
    return filtered(ws).select("project", "feature", s(F.col("iv"), F.col("iv_reliability")).alias("signal_strength"))


VOTE = ("vote AS (SELECT feature, AVG(CASE WHEN corr > 0 THEN 1.0 ELSE 0.0 END) AS positive_share FROM uni WHERE corr IS NOT NULL GROUP BY feature), "
        "votes AS (SELECT *, CASE WHEN positive_share >= 0.7 THEN 'positive' WHEN positive_share <= 0.3 THEN 'negative' ELSE 'undecided' END AS risk_direction FROM vote)")


@query("m6_direction_vote", COEF + f", {VOTE} SELECT feature, ROUND(positive_share, 6) AS positive_share, risk_direction FROM votes")
def direction_vote(ws: Workspace):
    return rounded(RG.direction_vote(coefs(ws)), ("positive_share",))


@query("m6_direction_vote_coefs")
def direction_vote_coefs(ws: Workspace):
    """The vote of the fitted coefficients."""
    return RG.direction_vote(ws.lr.coefs.where("segment_dim <> '__tag__'"))


_domain = ("CASE WHEN project = '财务行业风险分析' THEN 'FIN' WHEN project LIKE '%财务%' THEN 'FIN' WHEN project LIKE '%征信%' THEN 'CRDTC' WHEN project LIKE '%担保%' THEN 'GUAR' "
           "ELSE 'UNKNOWN' END")


@query("m7_project_domain", IVQ + f"SELECT DISTINCT project, {_domain} AS domain FROM proj")
def project_domain(ws: Workspace):
    return projects(ws).select("project").distinct().withColumn("domain", RG.project_domain(F.col("project")))


SEEDQ = O.with_(*[c for c in O.iv_all(tags=())], """proj AS (SELECT CASE WHEN segment_dim = '__all__' THEN '财务行业风险分析' WHEN segment_name = 'ASIA' THEN '征信 ASIA' WHEN segment_name = 'EUROPE'
 THEN '担保 EUROPE' ELSE segment_name END AS project, * FROM ivt WHERE segment_dim IN ('__all__', 'r_name'))""", FIL,
    "known(feature) AS (VALUES ('c_acctbal'), ('urgent_share'))",
    f"""seed AS (SELECT feature, project, {_domain} AS domain, ROUND(iv, 4) AS iv, iv_reliability, coverage_rate, {_signal} AS signal_strength, segment_n AS sample_size,
 segment_bad AS bad_size, feature IN (SELECT feature FROM known) AS already_registered FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY iv DESC, project DESC) AS rk
 FROM fil WHERE iv IS NOT NULL) WHERE rk = 1)""")


def seeds(ws: Workspace):
    known = ws.spark.createDataFrame([("c_acctbal", OPEN), ("urgent_share", OPEN), ("lines_per_order", EARLIER)], "ind_name string, exp_dt string")
    return RG.build_seeds(filtered(ws), RG.direction_vote(coefs(ws)), known)


@query("m8_seeds", SEEDQ + "SELECT * FROM seed")
def seed_table(ws: Workspace):
    return seeds(ws).drop("risk_direction")


@query("m9_seed_stats", SEEDQ + "SELECT domain, COUNT(*) AS n, COUNT(*) FILTER (already_registered) AS n_registered, COUNT(*) FILTER (NOT already_registered) "
       "AS n_to_propose FROM seed GROUP BY domain")
def seed_stats(ws: Workspace):
    return RG.seed_stats(seeds(ws))


@query("m10_fill_defaults", SEEDQ + f"""SELECT s.feature AS ind_name, s.domain, 1 AS ind_version, '{TODAY}' AS eff_dt, 'DRAFT' AS lifecycle_status, 'M' AS granularity,
 CASE WHEN s.domain IN ('OPN', 'PUB', 'JUDI') THEN 'PAD_ZERO_ON_LEFT_JOIN' ELSE 'KEEP_NULL_ON_LEFT_JOIN' END AS post_processing_rule, s.iv AS current_iv, s.iv_reliability AS current_reliability,
 s.coverage_rate AS current_coverage_rate, 1 AS n_history FROM seed s""")
def fill_defaults(ws: Workspace):
    s = seeds(ws)
    props = s.select(F.col("feature").alias("ind_name"), "domain")
    out = RG.fill_defaults(props, s, TODAY)
    return out.select("ind_name", "domain", "ind_version", "eff_dt", "lifecycle_status", "granularity", "post_processing_rule", "current_iv",
                      "current_reliability", "current_coverage_rate", F.size("iv_history").alias("n_history"))


# ---- codes and checks ------------------------------------------------------------------------

_code = "CASE WHEN p_size = 40 THEN LOWER(ind_code) WHEN p_size = 41 THEN 'XX' || ind_code WHEN p_size = 42 THEN REPLACE(ind_code, '_M_', '_EVT_') ELSE ind_code END"
PAT = "'^(FIN|CRDTC|OPN|PUB|JUDI|LON|GUAR|RELA|FUND)_[MDA]_[A-Z0-9_]+$'"
DOMS = "('" + "', '".join(RG.DOMAINS) + "')"


def _codes(ws: Workspace):
    c = F.col("ind_code")
    bad = (F.when(F.col("p_size") == 40, F.lower(c)).when(F.col("p_size") == 41, F.concat(F.lit("XX"), c))
           .when(F.col("p_size") == 42, F.replace(c, F.lit("_M_"), F.lit("_EVT_"))).otherwise(c))
    return proposals(ws).select("p_partkey", bad.alias("code"))


@query("m11_code_check", O.with_(PROP, f"c AS (SELECT p_partkey, {_code} AS code FROM prop)") + f"""
SELECT p_partkey, code, CONCAT_WS(',', CASE WHEN LENGTH(code) > 60 THEN 'too_long' END, CASE WHEN NOT REGEXP_MATCHES(code, {PAT}) THEN 'pattern' END,
 CASE WHEN SPLIT_PART(code, '_', 1) NOT IN {DOMS} THEN 'domain' END, CASE WHEN SPLIT_PART(code, '_', 2) NOT IN ('M', 'D', 'A', 'EVT') THEN 'granularity' END) AS errors FROM c""")
def code_check(ws: Workspace):
    return _codes(ws).select("p_partkey", "code", F.concat_ws(",", RG.code_errors(F.col("code"))).alias("errors"))


@query("m12_parse_code", O.with_(PROP) + """SELECT p_partkey, SPLIT_PART(ind_code, '_', 1) AS domain, SPLIT_PART(ind_code, '_', 2) AS granularity,
 p_type || '_' || p_partkey AS business_key, 'SNAP' AS "window", 'AMT' AS stat FROM prop""")
def parse_code(ws: Workspace):
    return proposals(ws).select("p_partkey", *[c.alias(n) for n, c in RG.parse_code(F.col("ind_code")).items()])


@query("m12_compose_code", O.with_(PROP) + """SELECT p_partkey, domain || '_' || granularity || '_' || TRIM(REGEXP_REPLACE(REGEXP_REPLACE(UPPER(ind_name || '--'), '[^A-Z0-9_]+', '_', 'g'),
 '_+', '_', 'g'), '_') || '_SNAP_CNT' AS code FROM prop""")
def compose_code(ws: Workspace):
    p = proposals(ws)
    code = RG.compose_code(F.col("domain"), F.concat("ind_name", F.lit("--")), F.lit("SNAP"), F.lit("CNT"), F.col("granularity"))
    return p.select("p_partkey", code.alias("code"))


_serr = ("CONCAT_WS(',', CASE WHEN priority = 'P9' THEN 'priority:enum' END, CASE WHEN LENGTH(calc_logic) < 5 THEN 'calc_logic:length' END, "
         "CASE WHEN p_size = 50 THEN 'source_tables:empty' END)")


@query("m13_schema_check", O.with_(PROP) + f"SELECT ind_code, {_serr} AS errors FROM prop")
def schema_check(ws: Workspace):
    p = proposals(ws)
    return p.select("ind_code", F.concat_ws(",", RG.schema_errors(p)).alias("errors"))


DICT = """dict AS (SELECT DISTINCT REPLACE(UPPER(p_brand), '#', '_') AS table_name, p_type AS field_name FROM part WHERE p_brand <> 'Brand#25'
 AND NOT (p_brand IN ('Brand#1', 'Brand#2') AND p_type = 'LARGE'))"""


def dictionary(ws: Workspace):
    p = ws.table("part").where("p_brand <> 'Brand#25' AND NOT (p_brand IN ('Brand#1', 'Brand#2') AND p_type = 'LARGE')")
    return p.select(F.replace(F.upper("p_brand"), F.lit("#"), F.lit("_")).alias("table_name"), F.col("p_type").alias("field_name")).distinct()


FLD = """fld AS (SELECT ind_code, p_size = 50 AND priority <> 'P0-blocked' AS no_table, CASE WHEN p_size <> 50 AND src_table NOT IN (SELECT table_name FROM dict)
 THEN 1 ELSE 0 END AS n_unknown_tables, CASE WHEN p_size = 49 THEN 1 ELSE 0 END AS n_odd_fields, CASE WHEN p_size <> 49 AND brand IN (SELECT table_name FROM dict)
 AND brand || '.' || p_type NOT IN (SELECT table_name || '.' || field_name FROM dict) THEN 1 ELSE 0 END AS n_unknown_fields FROM (SELECT *, SPLIT_PART(src_field, '.', 1) AS brand FROM prop))"""


@query("m14_field_check", O.with_(PROP, DICT, FLD) + "SELECT *, n_unknown_fields = 0 AND NOT no_table AS passed, n_unknown_tables + n_odd_fields AS n_warnings FROM fld")
def field_check(ws: Workspace):
    return RG.check_fields(proposals(ws), dictionary(ws))


@query("a12_load_dictionary", O.with_(DICT) + """SELECT d.table_name, d.field_name, COALESCE(t.title, '') AS table_title FROM dict d LEFT JOIN (SELECT DISTINCT
 REPLACE(UPPER(p_brand), '#', '_') AS table_name, 'Parts of ' || p_brand AS title FROM part WHERE p_brand < 'Brand#3') t USING (table_name)""")
def load_dictionary(ws: Workspace):
    from risklens.sources.tables import load_dictionary as load
    titles = ws.table("part").where("p_brand < 'Brand#3'").select(
        F.replace(F.upper("p_brand"), F.lit("#"), F.lit("_")).alias("table_name"), F.concat(F.lit("Parts of "), "p_brand").alias("table_title")).distinct()
    return load(titles, dictionary(ws))


TOK = """ca AS (SELECT ind_code, LIST_SORT(LIST_DISTINCT(STRING_SPLIT(LOWER(ind_name), ' '))) AS a FROM prop WHERE p_size > 30),
ex AS (SELECT ind_code, LIST_SORT(LIST_DISTINCT(STRING_SPLIT(LOWER(ind_name), ' '))) AS b FROM prop WHERE p_size <= 30),
sets AS (SELECT a, b, LEN(LIST_INTERSECT(a, b)) * 100.0 / LEAST(LEN(a), LEN(b)) AS score FROM (SELECT DISTINCT a FROM ca), (SELECT DISTINCT b FROM ex)),
scored AS (SELECT ca.ind_code AS a_code, ex.ind_code AS b_code, score FROM ca JOIN (SELECT * FROM sets WHERE score >= 72.25) USING (a) JOIN ex USING (b))"""


def _names(ws: Workspace):
    p = proposals(ws).select("ind_code", "ind_name", "p_size")
    return p.where("p_size > 30"), p.where("p_size <= 30")


@query("m15_duplicate_names", O.with_(PROP, TOK) + """SELECT c.ind_code, s.b_code AS matched_code, ROUND(COALESCE(s.score, 0.0), 6) AS score, CASE WHEN s.score >= 85 THEN 'duplicate'
 WHEN s.score >= 72.25 THEN 'similar' ELSE 'new' END AS verdict FROM ca c LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY a_code ORDER BY score DESC, b_code) AS rk
 FROM scored) WHERE rk = 1) s ON s.a_code = c.ind_code""")
def duplicate_names(ws: Workspace):
    return rounded(RG.check_duplicates(*_names(ws)), ("score",))


@query("m15_top_similar", O.with_(PROP, TOK) + """SELECT a_code, b_code, ROUND(score, 6) AS score, CAST(rk AS INTEGER) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY a_code
 ORDER BY score DESC, b_code) AS rk FROM scored) WHERE rk <= 3""")
def top_similar(ws: Workspace):
    return rounded(RG.top_similar(*_names(ws), k=3), ("score",))


_forbid = "CASE WHEN p_type = 'PROMO' THEN 'current_date' WHEN p_type = 'SMALL' THEN 'now' ELSE '' END"
_funcs = "CASE WHEN p_type = 'PROMO' THEN 'datediff' WHEN p_type = 'SMALL' THEN 'min,now' WHEN p_type = 'LARGE' THEN '' ELSE 'count,nullif,sum' END"


@query("m16_calc_scan", O.with_(PROP) + f"SELECT ind_code, {_funcs} AS functions, {_forbid} AS forbidden, calc_logic LIKE '%part_ymd%' AS has_partition, "
       f"LENGTH(calc_logic) >= 5 AND {_forbid} = '' AS passed FROM prop")
def calc_scan(ws: Workspace):
    s = RG.calc_scan(F.col("calc_logic"))
    return proposals(ws).select("ind_code", F.concat_ws(",", s["functions"]).alias("functions"), F.concat_ws(",", s["forbidden"]).alias("forbidden"),
                                s["has_partition"].alias("has_partition"), s["passed"].alias("passed"))


@query("m16_calc_references", O.with_(PROP) + """SELECT ind_code, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE') THEN 'x' ELSE
 array_to_string(list_sort(['d', 'part_ymd', LOWER(p_type), 'x']), ',') END AS columns, '' AS tables, false AS odd FROM prop""")
def calc_references(ws: Workspace):
    s = RG.calc_scan(F.col("calc_logic"))
    return proposals(ws).select("ind_code", F.concat_ws(",", s["columns"]).alias("columns"), F.concat_ws(",", s["tables"]).alias("tables"),
                                s["odd"].alias("odd"))


def _rolled(ws: Workspace):
    p = proposals(ws)
    none, scan = F.lit(0), RG.calc_scan(F.col("calc_logic"))
    checks = {"schema": (F.size(RG.schema_errors(p)) == 0, none), "naming": (F.size(RG.code_errors(F.col("ind_code"))) == 0, none),
              "fields": RG.check_fields(p, dictionary(ws)), "calc_logic": (scan["passed"], scan["odd"].cast("int")),
              "dedup": RG.check_duplicates(p, RG.code_name_pairs(registry(ws))).select(
                  "ind_code", (F.col("verdict") != "duplicate").alias("passed"), (F.col("verdict") == "similar").cast("int").alias("n_warnings"))}
    return RG.roll_up(p, checks)


ROLL = f"""cb AS (SELECT ind_code, LIST_SORT(LIST_DISTINCT(STRING_SPLIT(LOWER(ind_name), ' '))) AS a FROM prop),
eb AS (SELECT DISTINCT LIST_SORT(LIST_DISTINCT(STRING_SPLIT(LOWER(ind_name), ' '))) AS b FROM prop WHERE p_size <= 30),
dd AS (SELECT a, MAX(LEN(LIST_INTERSECT(a, b)) * 100.0 / LEAST(LEN(a), LEN(b))) AS score FROM (SELECT DISTINCT a FROM cb), eb GROUP BY a),
roll AS (SELECT p.ind_code, CASE WHEN {_serr.replace('priority', 'p.priority')} <> '' THEN 'schema' WHEN n_unknown_fields > 0 OR no_table THEN 'fields'
 WHEN LENGTH(calc_logic) < 5 OR {_forbid} <> '' THEN 'calc_logic' WHEN score >= 85 THEN 'dedup' END AS rejected_at,
 n_unknown_tables + n_odd_fields + CASE WHEN score >= 72.25 AND score < 85 THEN 1 ELSE 0 END AS n_warnings
 FROM prop p JOIN fld USING (ind_code) JOIN cb USING (ind_code) LEFT JOIN dd USING (a))"""
ROLLQ = O.with_(PROP, DICT, FLD, ROLL)


@query("m17_roll_up", ROLLQ + "SELECT ind_code, rejected_at, n_warnings FROM roll")
def roll_up(ws: Workspace):
    return _rolled(ws).drop("failed_checks")


@query("m17_roll_up_stats", ROLLQ + """SELECT COUNT(*) AS n, COUNT(*) - COUNT(rejected_at) AS n_validated, COUNT(rejected_at) AS n_rejected,
 ROUND(COUNT(rejected_at) * 1.0 / COUNT(*), 3) AS rejection_rate, ROUND(COUNT(rejected_at) * 1.0 / COUNT(*), 3) > 0.5 AS alarm FROM roll""")
def roll_up_stats(ws: Workspace):
    return RG.roll_up_stats(_rolled(ws))


@query("m17_rejected_by_check", ROLLQ + "SELECT rejected_at, COUNT(*) AS n FROM roll WHERE rejected_at IS NOT NULL GROUP BY rejected_at")
def rejected_by_check(ws: Workspace):
    return RG.rejected_by_check(_rolled(ws))


# ---- verification and delivery ---------------------------------------------------------------

@query("m18_verification_request", O.with_(PROP) + f"SELECT ind_code, ind_version, ind_name, {r('expected_iv_low', 'expected_iv_high', digits=4)}, ROUND(cov, 6) AS expected_coverage_rate "
       "FROM (SELECT *, GREATEST(0.0, current_iv * 0.7) AS expected_iv_low, current_iv * 1.3 AS expected_iv_high, current_coverage_rate AS cov FROM prop)")
def verification_request(ws: Workspace):
    out = RG.verification_request(proposals(ws)).select("ind_code", "ind_version", "ind_name", "expected_iv_low", "expected_iv_high", "expected_coverage_rate")
    return rounded(out, ("expected_coverage_rate",))


def response(ws: Workspace):
    """A reply for every proposal whose size is not a multiple of four."""
    size = F.col("p_size") % 4
    return proposals(ws).where(size != 0).select(
        "ind_code", F.when(size == 1, "SUCCESS").when(size == 2, "FAIL").otherwise("NO_DATA").alias("status"),
        F.when(size == 1, F.col("current_iv") + 0.01).alias("iv"), F.when(F.col("p_size") > 20, F.lit(0.9)).alias("coverage_rate"),
        F.when(F.col("p_type") == "LARGE", F.lit("")).otherwise("reliable").alias("reliability"), F.lit(500).alias("sample_size"),
        F.lit("positive").alias("risk_direction"), F.lit(TODAY).alias("snap_dt"))


def merged(ws: Workspace):
    return RG.merge_verification(proposals(ws), response(ws))


MERGE = """mer AS (SELECT *, COALESCE(vstatus, 'NOT_PROCESSED') AS verification_status, CASE WHEN vstatus = 'SUCCESS' THEN current_iv + 0.01 ELSE current_iv END AS iv2,
 CASE WHEN vstatus = 'SUCCESS' AND p_size > 20 THEN 0.9 ELSE current_coverage_rate END AS cov2, CASE WHEN vstatus = 'SUCCESS' AND p_type <> 'LARGE' THEN 'reliable' ELSE current_reliability END AS rel2,
 CASE WHEN vstatus = 'SUCCESS' THEN 1 ELSE 0 END AS n_history FROM prop)"""


@query("m19_merge_verification", O.with_(PROP, MERGE) + f"""SELECT ind_code, verification_status, ROUND(iv2, 6) AS current_iv, ROUND(cov2, 6) AS current_coverage_rate, rel2 AS current_reliability,
 CASE WHEN vstatus = 'SUCCESS' THEN 'positive' END AS current_risk_direction, n_history FROM mer""")
def merge_verification(ws: Workspace):
    out = merged(ws).select("ind_code", "verification_status", "current_iv", "current_coverage_rate", "current_reliability", "current_risk_direction",
                            F.coalesce(F.size(F.coalesce("iv_history", F.array().cast(
                                "array<struct<snap_dt:string,iv:double,credibility:string,sample_size:bigint,project:string>>"))), F.lit(0)).alias("n_history"))
    return rounded(out, ("current_iv", "current_coverage_rate"))


_prio = """CASE WHEN rel2 <> 'reliable' THEN 'P4-watch' WHEN priority = 'P0-blocked' AND verification_status <> 'SUCCESS' THEN 'P0-blocked' WHEN iv2 >= 0.10 AND cov2 >= 0.95 THEN 'P0'
 WHEN iv2 >= 0.10 THEN 'P0-blocked' WHEN iv2 >= 0.05 AND cov2 >= 0.80 THEN 'P1' WHEN cov2 < 0.50 AND iv2 >= 0.02 THEN 'P1-sparse' WHEN iv2 >= 0.02 THEN 'P2' ELSE 'P3-watch' END"""


@query("m20_priority", O.with_(PROP, MERGE) + f"SELECT ind_code, {_prio} AS priority FROM mer")
def priority(ws: Workspace):
    p = RG.priority(F.col("current_iv"), F.col("current_coverage_rate"), F.col("current_reliability"), F.col("priority"), F.col("verification_status"))
    return merged(ws).select("ind_code", p.alias("priority"))


def _after(ws: Workspace):
    return RG.scd2_merge(registry(ws), proposals(ws), "b1", TODAY)


AFTER = f"""aft AS (SELECT ind_code, ind_version, biz_definition, current_iv, priority, eff_dt, exp_dt, batch_id, 'kept' AS action FROM reg WHERE exp_dt <> '{OPEN}'
UNION ALL SELECT r.ind_code, r.ind_version, r.biz_definition, CASE WHEN same THEN p.current_iv ELSE r.current_iv END, CASE WHEN same THEN p.priority ELSE r.priority END, r.eff_dt,
 CASE WHEN same THEN r.exp_dt ELSE '{TODAY}' END, CASE WHEN same THEN 'b1' ELSE r.batch_id END, CASE WHEN same THEN 'soft_update' ELSE 'closed' END
 FROM (SELECT *, biz_definition NOT LIKE 'old %' AS same FROM reg WHERE exp_dt = '{OPEN}') r JOIN prop p USING (ind_code)
UNION ALL SELECT p.ind_code, r.ind_version + 1, p.biz_definition, p.current_iv, p.priority, '{TODAY}', '{OPEN}', 'b1', 'new_version' FROM prop p JOIN reg r USING (ind_code)
 WHERE r.exp_dt = '{OPEN}' AND r.biz_definition LIKE 'old %'
UNION ALL SELECT ind_code, 1, biz_definition, current_iv, priority, '{TODAY}', '{OPEN}', 'b1', 'inserted' FROM prop WHERE ind_code NOT IN (SELECT ind_code FROM reg))"""
AFTERQ = O.with_(PROP, REG, AFTER)


@query("m21_scd2_merge", AFTERQ + f"SELECT ind_code, ind_version, biz_definition, {r('current_iv')}, priority, eff_dt, exp_dt, batch_id, action FROM aft")
def scd2_merge(ws: Workspace):
    out = _after(ws).select("ind_code", "ind_version", "biz_definition", "current_iv", "priority", "eff_dt", "exp_dt", "batch_id", "action")
    return rounded(out, ("current_iv",))


def _sequence(ws: Workspace):
    """Every proposal, and for each seventh size a second record that follows it."""
    p = proposals(ws).withColumn("seq", F.lit(1))
    again = p.where("p_size % 7 = 0").withColumns({
        "seq": F.lit(2), "biz_definition": F.concat(F.lit("new "), "biz_definition"), "current_iv": F.col("current_iv") + 1})
    return p.unionByName(again)


SEQUENCE = f"""rep AS (SELECT ind_code, biz_definition AS biz, current_iv + 1 AS iv, p_size, p_type FROM prop WHERE p_size % 7 = 0),
seq AS (SELECT a.ind_code, ind_version, biz_definition, current_iv, a.priority, eff_dt, CASE WHEN biz IS NOT NULL AND exp_dt = '{OPEN}' THEN '{TODAY}' ELSE exp_dt END AS exp_dt, batch_id,
 CASE WHEN biz IS NOT NULL AND exp_dt = '{OPEN}' AND action = 'soft_update' THEN 'closed' ELSE action END AS action FROM aft a LEFT JOIN rep USING (ind_code)
UNION ALL SELECT a.ind_code, ind_version + 1, 'new ' || biz, iv, a.priority, '{TODAY}', '{OPEN}', 'b1', 'new_version' FROM aft a JOIN rep USING (ind_code) WHERE exp_dt = '{OPEN}')"""


@query("m21_scd2_sequence", O.with_(PROP, REG, AFTER, SEQUENCE) + f"SELECT ind_code, ind_version, biz_definition, {r('current_iv')}, priority, eff_dt, exp_dt, batch_id, action FROM seq")
def scd2_sequence(ws: Workspace):
    out = RG.scd2_merge(registry(ws), _sequence(ws), "b1", TODAY, order="seq").select(
        "ind_code", "ind_version", "biz_definition", "current_iv", "priority", "eff_dt", "exp_dt", "batch_id", "action")
    return rounded(out, ("current_iv",))


@query("m26_register_sequence", O.with_(PROP, REG, MERGE) + f"""SELECT action, COUNT(*) AS n FROM (SELECT CASE WHEN vstatus = 'FAIL' THEN 'skipped' WHEN r.ind_code IS NULL THEN 'inserted'
 WHEN r.biz_definition LIKE 'old %' THEN 'new_version' ELSE 'soft_update' END AS action FROM mer p LEFT JOIN (SELECT * FROM reg WHERE exp_dt = '{OPEN}') r USING (ind_code)
 UNION ALL SELECT CASE WHEN vstatus = 'FAIL' THEN 'skipped' ELSE 'new_version' END FROM mer WHERE p_size % 7 = 0) GROUP BY action""")
def register_sequence(ws: Workspace):
    batch = RG.merge_verification(_sequence(ws), response(ws))
    return RG.register(registry(ws), batch, "b1", TODAY, order="seq")[1]


@query("m22_soft_update", AFTERQ + f"SELECT ind_code, ind_version, {r('current_iv')}, priority, batch_id FROM aft WHERE action = 'soft_update'")
def soft_update(ws: Workspace):
    out = _after(ws).where("action = 'soft_update'").select("ind_code", "ind_version", "current_iv", "priority", "batch_id")
    return rounded(out, ("current_iv",))


@query("m23_active_list", SQL + f"SELECT ind_code, ind_version, ind_name, domain FROM reg WHERE exp_dt = '{OPEN}'")
def active_list(ws: Workspace):
    return RG.active(registry(ws)).select("ind_code", "ind_version", "ind_name", "domain")


@query("m24_deprecate", SQL + f"""SELECT ind_code, ind_version, CASE WHEN exp_dt = '{OPEN}' AND domain = 'PUB' THEN 'DEPRECATED' ELSE lifecycle_status END AS lifecycle_status,
 CASE WHEN exp_dt = '{OPEN}' AND domain = 'PUB' THEN '{TODAY}' ELSE exp_dt END AS exp_dt FROM reg""")
def deprecate(ws: Workspace):
    reg = registry(ws)
    return RG.deprecate(reg, reg.where("domain = 'PUB'"), TODAY).select("ind_code", "ind_version", "lifecycle_status", "exp_dt")


@query("m25_snapshot", SQL + f"""SELECT ind_code, ind_version, CASE WHEN src_table IS NULL THEN '[]' ELSE '["' || src_table || '"]' END AS source_tables, biz_definition FROM reg WHERE exp_dt = '{OPEN}'""")
def snapshot(ws: Workspace):
    return RG.snapshot(registry(ws)).select("ind_code", "ind_version", "source_tables", "biz_definition")


@query("m26_register_counts", O.with_(PROP, REG, MERGE) + f"""SELECT action, COUNT(*) AS n FROM (SELECT CASE WHEN vstatus = 'FAIL' THEN 'skipped' WHEN r.ind_code IS NULL THEN 'inserted'
 WHEN r.biz_definition LIKE 'old %' THEN 'new_version' ELSE 'soft_update' END AS action FROM mer p LEFT JOIN (SELECT * FROM reg WHERE exp_dt = '{OPEN}') r USING (ind_code)) GROUP BY action""")
def register_counts(ws: Workspace):
    return RG.register(registry(ws), merged(ws), "b1", TODAY)[1]


@query("m27_review_counts", O.with_(PROP, MERGE) + """SELECT 'domain' AS kind, domain AS value, COUNT(*) AS n FROM mer GROUP BY 2 UNION ALL SELECT 'priority', priority, COUNT(*) FROM mer GROUP BY 2
 UNION ALL SELECT 'status', verification_status, COUNT(*) FROM mer GROUP BY 2""")
def review_counts(ws: Workspace):
    return RG.review_counts(merged(ws))


@query("m28_top_registered", SQL + f"""SELECT domain, CAST(rk AS INTEGER) AS rank, ind_code, ROUND(current_iv, 6) AS current_iv FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY domain ORDER BY
 current_iv DESC, ind_code) AS rk FROM reg WHERE exp_dt = '{OPEN}') WHERE rk <= 30""")
def top_registered(ws: Workspace):
    return rounded(RG.top_registered(registry(ws)).select("domain", "rank", "ind_code", "current_iv"), ("current_iv",))


@query("m29_base_table_fields", O.with_(PROP, DICT, "dt AS (SELECT DISTINCT domain, src_table AS table_name FROM prop WHERE src_table IS NOT NULL)") + """
SELECT domain, table_name, field_name, CAST(rk AS INTEGER) AS rank, n_fields, field_name IS NULL AS is_missing FROM (SELECT dt.domain, dt.table_name, d.field_name,
 ROW_NUMBER() OVER (PARTITION BY dt.domain, dt.table_name ORDER BY d.field_name) AS rk, COUNT(d.field_name) OVER (PARTITION BY dt.domain, dt.table_name) AS n_fields
 FROM dt LEFT JOIN dict d USING (table_name)) WHERE rk <= 4""")
def base_table_fields(ws: Workspace):
    dt = proposals(ws).select("domain", F.explode("source_tables").alias("table_name")).distinct()
    return RG.base_table_fields(dt, dictionary(ws), cap=4)


@query("a13_delivery", O.with_(PROP, MERGE) + """SELECT ind_code, ind_name, priority, CASE WHEN src_table IS NULL THEN '[]' ELSE '["' || src_table || '"]' END AS source_tables,
 '["' || src_field || '"]' AS source_fields, ROUND(iv2, 6) AS current_iv, '["KEEP_NULL"]' AS null_handling, verification_status FROM mer""")
def delivery(ws: Workspace):
    out = RG.delivery(merged(ws)).select("ind_code", "ind_name", "priority", "source_tables", "source_fields", "current_iv", "null_handling", "verification_status")
    return rounded(out, ("current_iv",))
