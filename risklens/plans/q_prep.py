"""Source, preparation and feature queries."""

from pyspark.sql import functions as F

from risklens.config import Roles
from risklens.functions.labels import safe_divide
from risklens.operators import features as FE, prep as P, segments as S
from risklens.plans import oracle as O
from risklens.plans.catalog import query, r, rounded
from risklens.sources.tables import load_tables, read_csv, read_prepared, write_prepared
from risklens.plans.workspace import DIMS, FEATURES, ROLES, TAGS, Workspace

WIDE = O.with_(O.WIDE)
NUM = ("c_acctbal", "urgent_share", "lines_per_order", "qty_per_line")
BAD = "SELECT CAST(c_custkey AS VARCHAR) || '.0' AS bad_id FROM wide WHERE is_bad = 1"


def bad_list(ws: Workspace):
    return ws.wide.where("is_bad = 1").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("bad_id"))


@query("a3_prepared_table", WIDE + f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, n_name, "
       f"r_name, n_orders, n_lines, qty_sum, price_cents, {r(*NUM)}, is_bad FROM wide")
def prepared(ws: Workspace):
    """The prepared wide table as written and read again: key as text, roles typed."""
    path = ws.path("prepared")
    write_prepared(ws.wide, path, "c_custkey", partition_by=("r_name",))
    out = read_prepared(ws.spark, path, "c_custkey")
    cols = ["c_custkey", "c_mktsegment", "n_name", "r_name", "n_orders", "n_lines", "qty_sum",
            "price_cents", *NUM, "is_bad"]
    return rounded(out.select(*cols), NUM)


@query("a1_read_csv", "SELECT LPAD(CAST(c_custkey AS VARCHAR), 9, '0') AS c_custkey, c_mktsegment, ROUND(c_acctbal, 2) AS c_acctbal FROM customer")
def read_back_csv(ws: Workspace):
    """The customers as CSV, read with the encoding found and the key as text."""
    path = ws.path("customers")
    key = F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("c_custkey")
    ws.table("customer").select(key, "c_mktsegment", "c_acctbal").write.option("header", True).csv(path)
    return rounded(read_csv(ws.spark, path, keys=("c_custkey",)), ("c_acctbal",), 2)


@query("a2_load_tables", "SELECT 'customer' AS name, COUNT(*) AS n_rows FROM customer UNION ALL SELECT 'orders', COUNT(*) FROM orders")
def load_named(ws: Workspace):
    """A named set of tables, of which an optional one is missing."""
    from risklens.sources.results import manifest
    paths = {n: f"{ws.sf_dir}/{n}.parquet" for n in ("customer", "orders", "no_such_table")}
    return manifest(load_tables(ws.spark, paths, required=("customer",))).withColumnRenamed("result", "name")


@query("b1_label_from_list", WIDE + "SELECT c_custkey, is_bad FROM wide")
def label_from_list(ws: Workspace):
    bad = bad_list(ws).withColumn("bad_id", P.clean_key(F.col("bad_id")))
    return P.label_from_list(ws.table("customer").select("c_custkey"), bad, "c_custkey", "bad_id")


@query("b2_label_check", WIDE + """
SELECT n, n_bad, n_list, n_list - n_bad AS n_outside, ROUND(n_bad * 1.0 / n_list, 6) AS hit_rate,
 ROUND(n_bad * 1.0 / n, 6) AS bad_rate, CASE WHEN n_list = 0 THEN 'error_empty_list'
 WHEN n_bad = 0 THEN 'error_no_match' WHEN n_bad = n THEN 'error_all_bad'
 WHEN n_bad * 1.0 / n_list < 0.5 AND n_bad * 1.0 / n >= 0.005 THEN 'note_subset'
 WHEN n_bad * 1.0 / n_list < 0.5 THEN 'warn_key_mismatch' ELSE 'ok' END AS status
FROM (SELECT (SELECT COUNT(*) FROM wide WHERE r_name = 'ASIA') AS n,
 (SELECT COUNT(*) FROM wide WHERE r_name = 'ASIA' AND is_bad = 1) AS n_bad,
 (SELECT COUNT(*) FROM wide WHERE is_bad = 1) AS n_list)""")
def label_check(ws: Workspace):
    """The list covers all regions, the table only one: a regular subset."""
    bad = bad_list(ws).withColumn("bad_id", P.clean_key(F.col("bad_id")))
    part = ws.wide.where("r_name = 'ASIA'").select("c_custkey")
    out = P.label_check(P.label_from_list(part, bad, "c_custkey", "bad_id"), bad, "bad_id")
    return rounded(out, ("hit_rate", "bad_rate"))


@query("b2_label_check_all", WIDE + """
SELECT COUNT(*) AS n, SUM(is_bad)::BIGINT AS n_bad, SUM(is_bad)::BIGINT AS n_list, 0 AS n_outside, 1.0 AS hit_rate,
 ROUND(SUM(is_bad) * 1.0 / COUNT(*), 6) AS bad_rate, 'ok' AS status FROM wide""")
def label_check_all(ws: Workspace):
    """The list against the whole table."""
    bad = bad_list(ws).withColumn("bad_id", P.clean_key(F.col("bad_id")))
    out = P.label_check(P.label_from_list(ws.wide.select("c_custkey"), bad, "c_custkey", "bad_id"), bad, "bad_id")
    return rounded(out, ("hit_rate", "bad_rate"))


@query("b3_target_check", WIDE + """
SELECT 'is_bad' AS target, COUNT(*) AS n, 0 AS n_missing, 0 AS n_foreign, 2 AS n_codes, 'ok' AS status FROM wide
UNION ALL SELECT 'ev_error_cnt', COUNT(*), COUNT(*) - COUNT(ev_error_cnt),
 COUNT(*) FILTER (ev_error_cnt NOT IN (0, 1)), COUNT(DISTINCT ev_error_cnt), 'error_missing' FROM wide
UNION ALL SELECT 'c_mktsegment', COUNT(*), 0, COUNT(*), 0, 'error_coding' FROM wide
UNION ALL SELECT 'toxic', COUNT(*), COUNT(*) - COUNT(toxic), COUNT(*) FILTER (toxic NOT IN (0, 1)),
 COUNT(DISTINCT toxic), CASE WHEN COUNT(*) > COUNT(toxic) THEN 'error_missing'
 WHEN COUNT(*) FILTER (toxic NOT IN (0, 1)) > 0 THEN 'error_coding'
 WHEN COUNT(DISTINCT toxic) < 2 THEN 'error_single_class' ELSE 'ok' END FROM labels""")
def target_check(ws: Workspace):
    out = None
    for df, t in ((ws.wide, "is_bad"), (ws.wide, "ev_error_cnt"), (ws.wide, "c_mktsegment"),
                  (ws.table("labels"), "toxic")):
        row = P.target_check(df, t).select(F.lit(t).alias("target"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query("b4_supplement_join", """
SELECT c_custkey, c_mktsegment, f.event_type, ROUND(COALESCE(f.value, NULL), 6) AS c_acctbal
FROM customer c LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
 FROM events) WHERE rn = 1) f ON CAST(f.user_id AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)""")
def supplement_join(ws: Workspace):
    """First event per customer; the event value replaces the column of the same name."""
    side = ws.table("events").withColumnRenamed("value", "c_acctbal")
    base = ws.table("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    out = P.supplement(base, side, "c_custkey", "event_id", "user_id", ["event_type", "c_acctbal"])
    return rounded(out.select("c_custkey", "c_mktsegment", "event_type", "c_acctbal"), ("c_acctbal",))


@query("b4_supplement_check", """
SELECT COUNT(*) AS n_before, COUNT(*) AS n_after, COUNT(f.event_type) AS n_matched, CASE WHEN COUNT(f.event_type) = 0
 THEN 'error_no_match' ELSE 'ok' END AS status FROM customer c LEFT JOIN (SELECT user_id,
 MIN(event_type) AS event_type FROM events GROUP BY user_id) f ON f.user_id = c.c_custkey""")
def supplement_check(ws: Workspace):
    base = ws.table("customer").select("c_custkey", "c_mktsegment")
    out = P.supplement(base, ws.table("events"), "c_custkey", "event_id", "user_id", ["event_type"])
    return P.supplement_check(base, out, "event_type")


FILTER = {"c_mktsegment": {"exclude": ["HOUSEHOLD"]}, "r_name": {"include": ["ASIA", "EUROPE"]},
          "n_orders": {"min": 3}, "c_acctbal": {"range": [-500, 9000], "max": 8000},
          "urgent_share": {"drop_na": True}, "ev_cnt": {"exclude": [60]}, "no_such_column": {"min": 1}}


@query("b5_filter_spec", WIDE + """SELECT c_custkey, c_mktsegment, r_name, n_orders FROM wide
WHERE (c_mktsegment IS NULL OR c_mktsegment <> 'HOUSEHOLD') AND r_name IN ('ASIA', 'EUROPE') AND n_orders >= 3
 AND c_acctbal >= -500 AND c_acctbal <= 8000 AND urgent_share IS NOT NULL AND (ev_cnt IS NULL OR ev_cnt <> 60)""")
def filter_spec(ws: Workspace):
    return P.apply_filter(ws.wide, FILTER).select("c_custkey", "c_mktsegment", "r_name", "n_orders")


_spread = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, STDDEV_SAMP(CAST({c} AS DOUBLE)) AS std FROM wide"
    for c in (*FEATURES, *TAGS))


@query("b6_discover_features", WIDE + f"SELECT feature, COALESCE(std > 0.5, FALSE) AS keep FROM ({_spread})")
def discover_features(ws: Workspace):
    return P.feature_spread(ws.wide, ["c_custkey", "is_bad"], 0.5).select("feature", "keep")


@query("b7_clean_key", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS key_text FROM customer")
def clean_key(ws: Workspace):
    messy = F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(".0 "))
    return ws.table("customer").select("c_custkey", P.clean_key(messy).alias("key_text"))


@query("b8_latest_record", """
SELECT user_id, event_id, event_type, ROUND(value, 6) AS value FROM (SELECT *, ROW_NUMBER() OVER (
 PARTITION BY user_id ORDER BY CASE WHEN event_type = 'view' THEN NULL ELSE ts END DESC NULLS LAST, event_id DESC)
 AS rn FROM events) WHERE rn = 1""")
def latest_record(ws: Workspace):
    """Some dates are unreadable text on purpose; those rows come last."""
    date = F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(F.col("ts").cast("string"))
    ev = ws.table("events").select("user_id", "event_id", "event_type", "value", date.alias("d"))
    out = P.latest_record(ev, "user_id", "d", "event_id")
    return rounded(out.drop("d"), ("value",))


@query("b9_first_record", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
 ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def first_record(ws: Workspace):
    o = ws.table("orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return P.first_record(o, "o_custkey", "o_orderkey")


def _amount_text(c):
    """Amounts as they arrive: thousands separators, dashes for nothing."""
    return F.when(F.col(c) > 0, F.format_number(F.col(c), 2)).otherwise(F.lit("-"))


@query("b10_clean_amount", """
SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN ROUND(s_acctbal, 2) END AS amount_null,
 CASE WHEN s_acctbal > 0 THEN ROUND(s_acctbal, 2) ELSE 0.0 END AS amount_zero FROM supplier""")
def clean_amount(ws: Workspace):
    s = ws.table("supplier").withColumn("t", _amount_text("s_acctbal"))
    return s.select("s_suppkey", P.amount(F.col("t")).alias("amount_null"),
                    P.amount(F.col("t"), 0.0).alias("amount_zero"))


@query("b11_backfill_total", WIDE + """
SELECT c_custkey, CASE WHEN is_high_balance = 1 THEN CAST(price_cents AS DOUBLE) WHEN urgent_share IS NULL
 AND ev_cnt IS NULL THEN NULL ELSE COALESCE(CASE WHEN urgent_share IS NOT NULL THEN CAST(qty_sum AS DOUBLE) END, 0)
 + COALESCE(CAST(ev_cnt AS DOUBLE), 0) END AS total FROM wide""")
def backfill_total(ws: Workspace):
    w = ws.wide
    total = F.when(F.col("is_high_balance") == 1, F.col("price_cents").cast("double"))
    a = F.when(F.col("urgent_share").isNotNull(), F.col("qty_sum").cast("double"))
    b = F.col("ev_cnt").cast("double")
    return w.select("c_custkey", P.backfill_total(total, [a, b]).alias("total"))


def _text_table(ws: Workspace):
    """Customers with number columns delivered as text."""
    return ws.table("customer").select(
        F.col("c_custkey").cast("string").alias("id"), "c_mktsegment", "c_name",
        _amount_text("c_acctbal").alias("bal_text"),
        F.format_number(F.col("c_custkey") * 1000, 0).alias("num_text"))


@query("b12_numeric_text", """
SELECT "column", n_present, n_numeric, ROUND(n_numeric * 1.0 / n_present, 6) AS share,
 n_numeric * 1.0 / n_present >= 0.8 AS is_numeric FROM (
SELECT 'bal_text' AS "column", COUNT(*) AS n_present, COUNT(*) FILTER (c_acctbal > 0) AS n_numeric FROM customer
UNION ALL SELECT 'num_text', COUNT(*), COUNT(*) FROM customer
UNION ALL SELECT 'c_mktsegment', COUNT(*), 0 FROM customer
UNION ALL SELECT 'c_name', COUNT(*), 0 FROM customer)""")
def numeric_text(ws: Workspace):
    return rounded(P.numeric_text_share(_text_table(ws), exclude=["id"]), ("share",))


_nulls = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS n_filled FROM wide" for c in FEATURES)


@query("b13_zero_fill_counts", WIDE + _nulls)
def zero_fill_counts(ws: Workspace):
    return P.fill_counts(ws.wide.select(*FEATURES))


@query("b13_zero_fill", WIDE + "SELECT c_custkey, COALESCE(ev_cnt, 0) AS ev_cnt, ROUND(COALESCE(urgent_share, 0), 6) "
       "AS urgent_share FROM wide")
def zero_fill(ws: Workspace):
    out = P.zero_fill(ws.wide.select("c_custkey", "ev_cnt", "urgent_share"), ["c_custkey"])
    return rounded(out, ("urgent_share",))


_latest_order = """lo AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey
 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)"""


@query("b14_credit_wide_table", O.with_(O.WIDE, _latest_order) + """
SELECT CAST(c.c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, ROUND(COALESCE(CASE WHEN c_acctbal > 0 THEN c_acctbal
 END, CASE WHEN c.c_custkey % 3 = 0 THEN c.c_custkey END, 0), 6) AS amt, CAST(COALESCE(CASE WHEN c.c_custkey % 3 = 0
 THEN c.c_custkey END, 0) AS DOUBLE) AS part_amt, c.is_bad, ROUND(COALESCE(o_totalprice, 0), 6) AS o_totalprice,
 o_orderstatus, CASE WHEN o_custkey IS NULL THEN 0 ELSE 1 END AS has_report, COALESCE(e.event_type, NULL) AS event_type
FROM wide c LEFT JOIN lo ON o_custkey = c.c_custkey LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
 PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1) e ON e.user_id = c.c_custkey""")
def credit_wide_table(ws: Workspace):
    key = F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))
    cust = ws.table("customer").select(
        key.alias("c_custkey"), "c_mktsegment", _amount_text("c_acctbal").alias("amt"),
        F.when(F.col("c_custkey") % 3 == 0, F.format_number("c_custkey", 0)).alias("part_amt"))
    rep = ws.table("orders").select(
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("rk"), "o_orderkey",
        F.col("o_orderdate").cast("string").alias("d"),
        F.format_number("o_totalprice", 2).alias("o_totalprice"), "o_orderstatus")
    ind = ws.table("events").select(F.col("user_id").alias("ik"), "event_id", "event_type")
    out = P.credit_wide_table(
        cust, bad_list(ws), rep, key="c_custkey", report_key="rk", bad_key="bad_id",
        report_date="d", report_tiebreak="o_orderkey", amounts=["amt", "part_amt"],
        industry=ind, industry_key="ik", industry_order="event_id",
        keep_text=["c_mktsegment", "o_orderstatus", "event_type"])
    return rounded(out.select("c_custkey", "c_mktsegment", "amt", "part_amt", "is_bad",
                              "o_totalprice", "o_orderstatus", "has_report", "event_type"),
                   ("amt", "o_totalprice"))


FIN_AMT = "ABS(c_acctbal) * 30000"


@query("b15_finance_wide_table", O.with_(O.WIDE, _latest_order) + f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, o_orderstatus, o_orderpriority, f.event_type,
 c.is_bad, ROUND({FIN_AMT}, 2) AS amt FROM wide c LEFT JOIN lo ON o_custkey = c.c_custkey
LEFT JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
 WHERE rn = 1) f ON f.user_id = c.c_custkey""")
def finance_wide_table(ws: Workspace):
    return _finance(ws).select("c_custkey", "c_mktsegment", "o_orderstatus", "o_orderpriority",
                               "event_type", "is_bad", F.round("amt", 2).alias("amt"))


def _finance(ws: Workspace):
    k = lambda c: F.concat(F.lit(" "), F.col(c).cast("string")).alias("c_custkey")
    cust = ws.table("customer").select(
        k("c_custkey"), "c_mktsegment", F.format_number(F.abs("c_acctbal") * 30000, 2).alias("amt"))
    ch = ws.table("orders").select(k("o_custkey"), F.col("o_orderdate").cast("string").alias("d"),
                                   "o_orderkey", "o_orderstatus", "o_orderpriority")
    fin = ws.table("events").select(k("user_id"), "event_id", "event_type",
                                    F.lit("x").alias("value_source"), F.lit(0).alias("c_mktsegment"))
    bad = bad_list(ws).select(P.clean_key(F.col("bad_id")).alias("bad_id"))
    return P.finance_wide_table(
        cust, bad, key="c_custkey", bad_key="bad_id", changes=ch, change_date="d",
        change_tiebreak="o_orderkey", finance=fin, finance_order="event_id",
        finance_drop=["c_mktsegment", "event_id"], amounts=["amt"], rating="c_mktsegment")


@query("b16_credit_tier", WIDE + f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN amt <= 0 THEN 'no_credit' WHEN amt < 1e7 THEN 'low' WHEN amt > 2e8 THEN 'high'
 WHEN hr THEN 'mid_high_rating' ELSE 'mid_other' END AS credit_tier,
 CASE WHEN amt >= 1e7 AND amt <= 2e8 AND hr THEN 1 ELSE 0 END AS is_mid_high_rating,
 CASE WHEN amt >= 1e7 AND amt <= 2e8 AND NOT hr THEN 1 ELSE 0 END AS is_mid_other
FROM (SELECT c_custkey, ROUND({FIN_AMT}, 2) AS amt, n_orders > 9 AS hr FROM wide)""")
def credit_tier(ws: Workspace):
    rating = F.when(F.col("n_orders") > 9, "A+").otherwise("BBB")
    w = ws.wide.select(F.col("c_custkey").cast("string").alias("c_custkey"),
                       F.round(F.abs("c_acctbal") * 30000, 2).alias("amt"), rating.alias("rating"))
    return w.withColumns(P.credit_tier(F.col("amt"), F.col("rating"))).drop("amt", "rating")


@query("b17_coverage_summary", WIDE + """
SELECT COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad, COUNT(e.user_id) AS n_matched,
 COUNT(*) - COUNT(e.user_id) AS n_unmatched, (SELECT COUNT(DISTINCT user_id) FROM events WHERE user_id NOT IN
 (SELECT c_custkey FROM wide WHERE r_name <> 'ASIA')) AS n_out_of_scope, ROUND(SUM(is_bad) * 1.0 / COUNT(*), 6) AS bad_rate
FROM wide LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON e.user_id = c_custkey WHERE r_name <> 'ASIA'""")
def coverage_summary(ws: Workspace):
    out = P.coverage_summary(ws.wide.where("r_name <> 'ASIA'"), ws.table("events"), "c_custkey", "user_id")
    return rounded(out, ("bad_rate",))


@query("b17_coverage_all", WIDE + """
SELECT COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad, COUNT(e.user_id) AS n_matched,
 COUNT(*) - COUNT(e.user_id) AS n_unmatched, (SELECT COUNT(DISTINCT user_id) FROM events WHERE user_id NOT IN
 (SELECT c_custkey FROM wide)) AS n_out_of_scope, ROUND(SUM(is_bad) * 1.0 / COUNT(*), 6) AS bad_rate
FROM wide LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON e.user_id = c_custkey""")
def coverage_all(ws: Workspace):
    out = P.coverage_summary(ws.wide, ws.table("events"), "c_custkey", "user_id")
    return rounded(out, ("bad_rate",))


@query("b19_pairwise_valid", WIDE + "SELECT c_custkey, ev_cnt, ROUND(urgent_share, 6) AS urgent_share FROM wide "
       "WHERE ev_cnt IS NOT NULL AND urgent_share IS NOT NULL")
def pairwise_valid(ws: Workspace):
    out = P.pairwise_valid(ws.wide, "ev_cnt", "urgent_share")
    return rounded(out.select("c_custkey", "ev_cnt", "urgent_share"), ("urgent_share",))


@query("b20_fit_fill_values", O.with_(O.WIDE, O.seg(), O.sizes(), O.elig(50, 0, full_free=False), O.long()) +
       f"SELECT {O.K}, COUNT(*) AS n_rows, COUNT(x) AS n, ROUND(MEDIAN(x), 6) AS median FROM long GROUP BY {O.K}")
def fit_fill_values(ws: Workspace):
    out = P.fit_fill_values(ws.wide, ROLES, full=True, dims=True, tags=True)
    return rounded(out, ("median",))


@query("b20_impute", O.with_(O.WIDE, O.seg(full=False, dims=("c_mktsegment",), tags=()), O.sizes(),
                             O.elig(50, 0, full_free=False)) + """
SELECT s.segment_name, c_custkey, ROUND(COALESCE(CAST(ev_cnt AS DOUBLE), m), 6) AS ev_cnt FROM seg s
JOIN (SELECT segment_name, MEDIAN(ev_cnt) AS m FROM seg JOIN elig USING (segment_name) GROUP BY 1) USING (segment_name)""")
def impute(ws: Workspace):
    roles = Roles("c_custkey", "is_bad", ("ev_cnt",), ("c_mktsegment",))
    shape = dict(full=False, dims=True, tags=False)
    fills = P.fit_fill_values(ws.wide, roles, **shape)
    out = P.impute(ws.wide.select("c_custkey", "c_mktsegment", "ev_cnt", "is_bad"), roles, fills, **shape)
    return rounded(out.select("segment_name", "c_custkey", "ev_cnt"), ("ev_cnt",))


@query("b21_sample_summary", WIDE + "SELECT COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad, COUNT(*) - "
       "CAST(SUM(is_bad) AS BIGINT) AS n_good, ROUND(SUM(is_bad) * 1.0 / COUNT(*), 6) AS bad_rate FROM wide")
def sample_summary(ws: Workspace):
    return rounded(S.sample_summary(ws.wide, ROLES), ("bad_rate",))


_reason = ("CASE WHEN n < 50 AND segment_dim <> '__tag__' THEN 'n' WHEN n_bad < 15 THEN 'bad' "
           "WHEN n_good < 30 THEN 'good' END")


@query("b22_group_ledger", O.with_(O.WIDE, O.seg(full=False), O.sizes()) +
       f"SELECT *, ROUND(n_bad * 1.0 / n, 6) AS bad_rate, {_reason} AS skip_reason, CASE WHEN {_reason} IS NULL "
       f"THEN 'analysed' ELSE 'skipped' END AS status FROM sizes")
def group_ledger(ws: Workspace):
    return rounded(S.group_ledger(ws.wide, ROLES), ("bad_rate",))


# ---- features -------------------------------------------------------------------------------

@query("c1_safe_divide", WIDE + "SELECT c_custkey, ROUND(CASE WHEN n_orders <> 0 THEN urgent_orders * 1.0 / n_orders "
       "END, 6) AS ratio, ROUND(CASE WHEN COALESCE(ev_cnt, 0) <> 0 THEN COALESCE(ev_error_cnt, 0) * 1.0 / ev_cnt "
       "ELSE -1 END, 6) AS ratio_filled FROM wide")
def safe_divide_query(ws: Workspace):
    return rounded(ws.wide.select(
        "c_custkey", safe_divide(F.col("urgent_orders"), F.col("n_orders")).alias("ratio"),
        safe_divide(F.col("ev_error_cnt"), F.col("ev_cnt"), -1).alias("ratio_filled")),
        ("ratio", "ratio_filled"))


CHANGE_NAMES = {"changes_total": "n_lines", "changes_30d": "urgent_orders", "changes_90d": "open_orders",
                "changes_180d": "n_orders", "changes_365d": "ev_cnt", "change_types": "n_orders",
                "legal_rep_changes": "urgent_orders", "shareholder_changes": "ev_error_cnt",
                "capital_changes": "open_orders", "legal_rep_changes_30d": "ev_cnt",
                "shareholder_changes_30d": "urgent_orders", "capital_changes_90d": "open_orders",
                "tags_added": "n_orders", "tags_removed": "ev_cnt"}
CHANGE_OUT = ("change_share_30d", "change_share_90d", "change_share_180d", "change_share_365d",
              "type_concentration", "high_risk_changes", "high_risk_change_share",
              "high_risk_changes_30d", "high_risk_changes_90d", "net_tags")


def _div(a, b):
    return f"CASE WHEN ({b}) <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def _z(c):
    return f"COALESCE({c}, 0)"


_hr = f"({_z('urgent_orders')} + {_z('ev_error_cnt')} + {_z('open_orders')})"


@query("c2_change_features", WIDE + "SELECT c_custkey, " + ", ".join(f"ROUND({e}, 6) AS {n}" for n, e in zip(CHANGE_OUT, (
    _div("urgent_orders", "n_lines"), _div("open_orders", "n_lines"), _div("n_orders", "n_lines"),
    _div("ev_cnt", "n_lines"), f"1 - {_div('n_orders', 'n_lines')}", f"CAST({_hr} AS DOUBLE)", _div(_hr, "n_lines"),
    f"CAST({_z('ev_cnt')} + {_z('urgent_orders')} AS DOUBLE)", f"CAST({_z('open_orders')} AS DOUBLE)",
    f"CAST({_z('n_orders')} - {_z('ev_cnt')} AS DOUBLE)"))) + " FROM wide")
def change_features(ws: Workspace):
    out = FE.change_features(ws.wide, CHANGE_NAMES)
    return rounded(out.select("c_custkey", *CHANGE_OUT), CHANGE_OUT)


CREDIT_NAMES = {"guarantor_queries": "n_orders", "institutions": "n_lines", "open_institutions": "open_orders",
                "nonbank_institutions": "urgent_orders", "bank_institutions": "n_orders",
                "overdue_institutions": "ev_error_cnt", "overdue_balance": "price_cents",
                "small_loan_companies": "ev_cnt", "consumer_finance_companies": "urgent_orders"}
_c = {"nonbank_share": _div("urgent_orders", "n_lines"), "bank_share": _div("n_orders", "n_lines"),
      "small_loan_share": _div("ev_cnt", "n_lines"), "consumer_finance_share": _div("urgent_orders", "n_lines"),
      "open_share": _div("open_orders", "n_lines"), "high_risk_channels": "ev_cnt + urgent_orders",
      "high_risk_share": _div("ev_cnt + urgent_orders", "n_lines"),
      "has_high_risk": "CASE WHEN ev_cnt + urgent_orders > 0 THEN 1 ELSE 0 END",
      "nonbank_bank_ratio": _div("urgent_orders", "n_orders"), "credit_spread": "LN(1 + n_lines)",
      "query_open_ratio": _div("n_orders", "open_orders"), "query_institution_ratio": _div("n_orders", "n_lines"),
      "high_risk_open_cross": "(ev_cnt + urgent_orders) * open_orders",
      "settled_share": _div("n_lines - open_orders", "n_lines"), "overdue_share": _div("ev_error_cnt", "n_lines"),
      "queries_per_institution": _div("n_orders", "n_lines"), "open_per_institution": _div("open_orders", "n_lines"),
      "overdue_per_lender": _div("price_cents", "urgent_orders + n_orders"),
      "pure_nonbank_share": _div("urgent_orders", "urgent_orders + n_orders"),
      "review_pressure": _div("n_orders", "open_orders"), "high_risk_total": "ev_cnt + urgent_orders",
      "high_risk_total_share": _div("ev_cnt + urgent_orders", "n_lines"),
      "channel_variety": " + ".join(f"(CASE WHEN {c} > 0 THEN 1 ELSE 0 END)" for c in
                                    ("n_orders", "urgent_orders", "ev_cnt", "urgent_orders")),
      "log_institutions": "LN(1 + COALESCE(n_lines, 0))", "log_open_institutions": "LN(1 + COALESCE(open_orders, 0))"}
_whole = {"high_risk_channels", "has_high_risk", "high_risk_open_cross", "high_risk_total", "channel_variety"}


@query("c3_credit_features", WIDE + "SELECT c_custkey, " + ", ".join(
    f"{e} AS {n}" if n in _whole else f"ROUND({e}, 6) AS {n}" for n, e in _c.items()) + " FROM wide")
def credit_features(ws: Workspace):
    out = FE.credit_features(ws.wide, CREDIT_NAMES).select("c_custkey", *_c)
    return rounded(out, [n for n in _c if n not in _whole])


# Inputs of the financial ratios, dealt over the numeric columns of the wide table.
_pool = ("price_cents", "qty_sum", "n_lines", "n_orders", "urgent_orders", "open_orders", "ev_cnt", "c_acctbal")
FIN_INPUTS = sorted({c for f in FE.FINANCE for c in f.needs} - {f.name for f in FE.FINANCE})
FIN_NAMES = {c: _pool[i % len(_pool)] for i, c in enumerate(FIN_INPUTS)}
FIN_OUT = [f.name for f in FE.FINANCE]


def _fin_sql() -> dict[str, str]:
    n = {k: f"CAST({v} AS DOUBLE)" for k, v in FIN_NAMES.items()}
    z = lambda c: f"COALESCE({n[c]}, 0.0)"
    loans = f"({z('short_term_loans')} + {z('long_term_loans')})"
    wc = f"({n['current_assets']} - {n['current_liabilities']})"
    special = {
        "working_capital": wc, "working_capital_ratio": _div(wc, n["total_assets"]),
        "loan_dependence": _div(loans, n["total_assets"]),
        "receivable_inventory_share": _div(f"({z('receivables')} + {z('inventory')})", n["current_assets"]),
        "working_capital_turnover": _div(n["revenue"], wc),
        "cost_profit_ratio": _div(n["total_profit"], f"({z('operating_cost')} + {z('period_expenses')})"),
        "cash_loan_cover": _div(n["operating_cash_in"], loans),
        "free_cash_flow": f"{z('operating_cash_in')} - ABS({z('investing_net')})",
        "cash_months": _div(n["cash"], f"({n['operating_cost']} / 12)"),
        "own_loan_share": f"CASE WHEN {loans} <> 0 AND {n['on_balance_credit']} IS NOT NULL THEN "
                          f"LEAST(1.0, {n['on_balance_credit']} / {loans}) END",
        "other_bank_loans": f"GREATEST(0.0, {loans} - {z('on_balance_credit')})",
        "debt_revenue_ratio": _div(loans, n["revenue"]),
        "paid_in_loan_ratio": _div(n["paid_in_capital"], loans)}
    out = {}
    for f in FE.FINANCE:
        out[f.name] = special.get(f.name) or _div(n[f.needs[0]], n[f.needs[1]])
    return out


FIN_SQL = _fin_sql()
# Amount-sized outputs are compared to fewer decimals: doubles carry no more.
FIN_BIG = ("debt_revenue_ratio", "other_bank_loans")


def _fin_digits(c: str) -> int:
    return 4 if c in FIN_BIG else 7


def _fin_rounded(df):
    return df.select(*[F.round(c, _fin_digits(c)).alias(c) if c in FIN_OUT else F.col(c) for c in df.columns])


_raw = "fin AS (SELECT c_custkey, " + ", ".join(f"{e} AS {k}" for k, e in FIN_SQL.items()) + " FROM wide)"


@query("c4_finance_ratios", O.with_(O.WIDE, _raw) + f"SELECT c_custkey, " + ", ".join(f"ROUND({c}, {_fin_digits(c)}) AS {c}" for c in FIN_OUT) + " FROM fin")
def finance_ratios(ws: Workspace):
    out = FE.finance_features(ws.wide, FIN_NAMES, clip=False).select("c_custkey", *FIN_OUT)
    return _fin_rounded(out)


def _clip(c):
    lo, hi = f"q.{c}[1]", f"q.{c}[2]"
    return (f"ROUND(CASE WHEN {c}_n < 20 OR {lo} = {hi} OR fin.{c} IS NULL THEN fin.{c} "
            f"ELSE LEAST({hi}, GREATEST({lo}, fin.{c})) END, {_fin_digits(c)}) AS {c}")


_clipped = [f.name for f in FE.FINANCE if f.winsorise]
_q = "q AS (SELECT " + ", ".join(f"QUANTILE_CONT({c}, [0.01, 0.99]) AS {c}, COUNT({c}) AS {c}_n" for c in _clipped) + " FROM fin)"


@query("c5_winsorise", O.with_(O.WIDE, _raw, _q) + "SELECT c_custkey, " + ", ".join(_clip(c) for c in _clipped) + " FROM fin, q")
def winsorise(ws: Workspace):
    out = FE.finance_features(ws.wide, FIN_NAMES).select("c_custkey", *_clipped)
    return _fin_rounded(out)


@query("c8_drop_flat", WIDE + "SELECT c_custkey, n_orders, open_orders FROM wide")
def drop_flat(ws: Workspace):
    w = ws.wide.select("c_custkey", "n_orders", "open_orders",
                       (F.col("n_orders") - F.col("n_orders")).alias("flat"))
    return P.drop_flat(w, ["n_orders", "open_orders", "flat"])


@query("d1_detect_dims", WIDE + """
SELECT 'c_mktsegment' AS dim, 'category' AS kind, COUNT(c_mktsegment) AS n_present FROM wide
UNION ALL SELECT 'r_name', 'category', COUNT(r_name) FROM wide
UNION ALL SELECT 'is_urgent_buyer', 'tag', COUNT(is_urgent_buyer) FROM wide
UNION ALL SELECT 'is_high_balance', 'tag', COUNT(is_high_balance) FROM wide""")
def detect_dims(ws: Workspace):
    return S.detect_dims(ws.wide, ["c_mktsegment", "r_name", "not_there"], exclude=["is_bad"])
