"""Logistic regression and rule queries."""

from pyspark.sql import functions as F

from risklens.config import Roles
from risklens.functions import labels
from risklens.functions.hashing import in_sample
from risklens.operators import logistic as L, ranking as R, rules as RU, segments as S
from risklens.operators.strata import fold_of, key_hash
from risklens.plans import oracle as O
from risklens.plans.catalog import query, r, rounded
from risklens.plans.workspace import DERIVED, MODEL_FEATURES, MODEL_ROLES, ROLES, Workspace

K = O.K
WIDE = O.with_(O.WIDE)


def _hash(salt: str) -> str:
    return f"CAST('0x' || SUBSTR(MD5(CAST(c_custkey AS VARCHAR) || '|{salt}'), 1, 15) AS BIGINT)"


@query("f1_lr_by_group")
def lr_by_group(ws: Workspace):
    return ws.lr.coefs.where(~F.col("segment_dim").isin("__tag__", "__all__"))


@query("f2_lr_by_tag")
def lr_by_tag(ws: Workspace):
    return ws.lr.coefs.where("segment_dim = '__tag__'")


@query("f1_lr_gate_ledger", O.with_(O.WIDE, O.seg(), O.sizes()) +
       "SELECT *, CASE WHEN n < 50 AND segment_dim <> '__tag__' THEN 'n' WHEN n_bad < 20 THEN 'bad' "
       "WHEN n_good < 50 THEN 'good' END AS skip_reason FROM sizes")
def lr_gate_ledger(ws: Workspace):
    return ws.lr.ledger.drop("converged")


@query("f3_cv_auc")
def cv_auc(ws: Workspace):
    return ws.lr.auc


@query("f3_auc_types", O.with_(O.WIDE, O.seg(), O.sizes()) +
       "SELECT segment_dim, segment_name, n, n_bad, CASE WHEN n >= 200 AND n_bad >= 30 THEN 'cv5' ELSE "
       "'train_small' END AS auc_type FROM sizes WHERE (n >= 50 OR segment_dim = '__tag__') AND n_bad >= 20 "
       "AND n_good >= 50")
def auc_types(ws: Workspace):
    return ws.lr.auc.select(*S.SEG, "n", "n_bad", "auc_type")


@query("f3_fold_sizes", O.with_(O.WIDE, O.seg(), O.sizes()) + f"""SELECT segment_dim, segment_name, y, fold, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys
FROM (SELECT segment_dim, segment_name, is_bad AS y, c_custkey, CAST(len([i FOR i IN RANGE(1, 5) IF rn - 1 >= i * n_class // 5]) AS INTEGER) AS fold FROM (
  SELECT seg.*, COUNT(*) OVER (PARTITION BY seg.segment_dim, seg.segment_name, is_bad) AS n_class,
    ROW_NUMBER() OVER (PARTITION BY seg.segment_dim, seg.segment_name, is_bad ORDER BY {_hash('fold')}) AS rn
  FROM seg JOIN sizes USING (segment_dim, segment_name) WHERE n >= 200 AND n_bad >= 30)) GROUP BY 1, 2, 3, 4""")
def fold_sizes(ws: Workspace):
    segs = S.segment_sizes(ws.wide, ROLES).where("n >= 200 AND n_bad >= 30").select(*S.SEG)
    begins = L.fold_cuts(ws.wide, ROLES, segs)
    slim = ws.wide.select("c_custkey", *ROLES.dims, *ROLES.tags, F.col("is_bad").alias("y"), key_hash(F.col("c_custkey"), "fold").alias("h"))
    rows = S.expand(slim, Roles("c_custkey", "y", (), ROLES.dims, ROLES.tags)).join(begins, [*S.SEG, "y"])
    return rows.groupBy(*S.SEG, "y", fold_of("h", "cuts").alias("fold")).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


_auc_features = ("n_lines", "c_acctbal", "open_orders", "ev_cnt")


@query("f3_auc_of_scores", O.with_(O.WIDE, O.seg(), O.sizes(), O.elig(50, 10), O.long(_auc_features)) + f"""
SELECT {K}, n_pos, n_neg, ROUND(CASE WHEN n_pos * n_neg > 0 THEN u / (CAST(n_pos AS DOUBLE) * n_neg) END, 6) AS auc
FROM (SELECT {K}, SUM(pos * (below + neg / 2.0)) AS u, CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg
 FROM (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY {K} ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
 AS below FROM (SELECT {K}, x, COUNT(*) FILTER (y = 1) AS pos, COUNT(*) FILTER (y = 0) AS neg FROM long
 WHERE x IS NOT NULL GROUP BY {K}, x)) GROUP BY {K})""")
def auc_of_scores(ws: Workspace):
    roles = ROLES.only(*_auc_features)
    segs = S.eligible(ws.wide, roles, 50, 10)
    return rounded(R.auc(S.long_form(ws.wide, roles, segs), S.KEY, "x", "y"), ("auc",))


@query("f4_compare_feature_sets")
def compare_feature_sets(ws: Workspace):
    raw = [f for f in MODEL_FEATURES if f not in DERIVED]
    return L.compare_feature_sets(ws.wide, MODEL_ROLES, raw, list(DERIVED), full=False, dims=True, tags=False)


@query("f5_complete_case_lr")
def complete_case_lr(ws: Workspace):
    m = L.fit_segments(ws.wide, MODEL_ROLES, full=True, dims=False, tags=False, policy="complete")
    return m.coefs.join(m.auc.select(*S.SEG, "auc", "auc_type"), S.SEG)


# ---- rules -----------------------------------------------------------------------------------

@query("g1_holdout_split", O.with_(O.WIDE, O.seg(True, ("c_mktsegment",), ())) + f"""SELECT segment_dim, segment_name, c_custkey,
n_bad * 0.3 >= 10 AND n_bad * 0.7 >= 20 AND rn <= FLOOR(n_class * 0.3 + 0.5) AS held_out FROM (SELECT *, COUNT(*) OVER s AS n, SUM(is_bad) OVER s AS n_bad,
  COUNT(*) OVER c AS n_class, ROW_NUMBER() OVER (PARTITION BY segment_dim, segment_name, is_bad ORDER BY {_hash('holdout')}) AS rn FROM seg
  WINDOW s AS (PARTITION BY segment_dim, segment_name), c AS (PARTITION BY segment_dim, segment_name, is_bad)) WHERE segment_dim = '__all__' OR n >= 50""")
def holdout_split(ws: Workspace):
    dims = ("c_mktsegment",)
    segs = RU.split_segments(ws.wide, ROLES, dims=dims)
    slim = ws.wide.select("c_custkey", "c_mktsegment", F.col("is_bad").alias("y"), key_hash(F.col("c_custkey"), "holdout").alias("h"))
    rows = S.expand(slim, Roles("c_custkey", "y", (), dims), full=True, tags=False).join(segs.select(*S.SEG, "eval_scope"), S.SEG)
    return RU.held_out(rows, 0.3).select(*S.SEG, "c_custkey", F.col("out").alias("held_out"))


@query("g1_split_scope", O.with_(O.WIDE, O.seg(tags=()), O.sizes()) +
       "SELECT *, CASE WHEN n_bad * 0.3 >= 10 AND n_bad * 0.7 >= 20 THEN 'holdout' ELSE 'in_sample' END AS eval_scope "
       "FROM sizes WHERE segment_dim = '__all__' OR n >= 50")
def split_scope(ws: Workspace):
    return RU.split_segments(ws.wide, MODEL_ROLES, dims=MODEL_ROLES.dims)


@query("g2_tree_rules")
def tree_rules(ws: Workspace):
    """Bad-enriched leaf paths of the full-sample tree, mined on the training side."""
    rules, rows, _ = RU.candidates(ws.wide, MODEL_ROLES)
    rows.unpersist()
    return rules.select(*S.SEG, "leaf", RU.conditions_text(F.col("conditions")).alias("rule"), "leaf_n", "leaf_bad")


GIVEN = {1: [("open_orders", ">", 3.5), ("lines_per_order", "<=", 4.2)], 2: [("urgent_orders", ">", 2.5)],
         3: [("ev_cnt", ">", 65.5)], 4: [("qty_per_line", "<=", 25.0), ("urgent_share", ">", 0.1)],
         5: [("c_acctbal", "<=", 0.0), ("lines_per_order", ">", 3.9), ("open_orders", ">", 4.5)],
         6: [("n_lines", ">", 55.5)], 7: [("n_lines", ">", 45.5), ("qty_sum", ">", 1100.0)]}
FILLS = {"ev_cnt": 66.0}


def _mask(conds) -> str:
    cell = lambda f: f"COALESCE({f}, {FILLS[f]})" if f in FILLS else f
    return "COALESCE(" + " AND ".join(f"{cell(f)} {op} {t}" for f, op, t in conds) + ", FALSE)"


_given = "given AS (" + " UNION ALL ".join(
    f"SELECT {i} AS rule_id, COUNT(*) FILTER ({_mask(c)}) AS coverage_n, COUNT(*) FILTER ({_mask(c)} AND is_bad = 1) "
    f"AS bad_n, COUNT(*) AS n, COUNT(*) FILTER (is_bad = 1) AS n_bad FROM {{src}}" for i, c in GIVEN.items()) + ")"
_ev = """ev AS (SELECT *, CAST(coverage_n AS DOUBLE) / n AS coverage_pct, CASE WHEN coverage_n > 0 THEN CAST(bad_n AS DOUBLE) / coverage_n
 END AS bad_rate, CAST(n_bad AS DOUBLE) / n AS overall_bad_rate, CASE WHEN coverage_n > 0 THEN (CAST(bad_n AS DOUBLE) / coverage_n)
 / (CAST(n_bad AS DOUBLE) / n) END AS lift FROM given)"""
EV = O.with_(O.WIDE, _given.format(src="wide"), _ev)
_cols = ("coverage_pct", "bad_rate", "overall_bad_rate", "lift")


def _given_eval(ws: Workspace, df=None):
    return RU.evaluate_given(ws.wide if df is None else df, "is_bad", GIVEN, FILLS)


@query("g4_leaf_counts")
def leaf_counts(ws: Workspace):
    rules, rows, _ = RU.candidates(ws.wide, MODEL_ROLES, dims=("c_mktsegment",))
    rows.unpersist()
    return rules.select(*S.SEG, "leaf", "leaf_n", "leaf_bad")


@query("g5_simplify_conditions", O.with_(O.WIDE) + """
SELECT c_mktsegment, 'c_acctbal' AS feature, op, ROUND(thr, 4) AS threshold FROM (
 SELECT c_mktsegment, CASE WHEN is_bad = 1 THEN '<=' ELSE '>' END AS op, CASE WHEN is_bad = 1 THEN MIN(c_acctbal)
 ELSE MAX(c_acctbal) END AS thr FROM wide GROUP BY c_mktsegment, is_bad)""")
def simplify_conditions(ws: Workspace):
    """Every customer contributes a bound; per segment the tightest one of each kind remains."""
    cond = F.struct(F.lit("c_acctbal").alias("feature"),
                    F.when(F.col("is_bad") == 1, "<=").otherwise(">").alias("op"),
                    F.col("c_acctbal").alias("threshold"))
    # Already reduced per operator on the map side, so the condition arrays stay short.
    one = (ws.wide.groupBy("c_mktsegment", "is_bad")
           .agg(F.when(F.col("is_bad") == 1, F.min("c_acctbal")).otherwise(F.max("c_acctbal")).alias("c_acctbal"))
           .groupBy("c_mktsegment").agg(F.collect_list(cond).alias("conditions")))
    out = RU.simplify(one, ["c_mktsegment"])
    return out.select("c_mktsegment", F.explode("conditions").alias("c")).select("c_mktsegment", "c.*")


@query("g7_rule_mask", WIDE + "SELECT c_custkey, " + ", ".join(f"{_mask(c)} AS r{i}" for i, c in GIVEN.items()) + " FROM wide")
def rule_mask(ws: Workspace):
    return ws.wide.select("c_custkey", *[RU.condition_mask(c, FILLS).alias(f"r{i}") for i, c in GIVEN.items()])


@query("g8_dedupe_rules", O.with_(O.WIDE) + """
SELECT MIN(c_custkey) AS rule_key, n_orders AS threshold FROM wide WHERE n_orders > 0 GROUP BY n_orders""")
def dedupe_rules(ws: Workspace):
    cond = F.array(F.struct(F.lit("n_orders").alias("feature"), F.lit(">").alias("op"),
                            F.col("n_orders").cast("double").alias("threshold")))
    rules = ws.wide.where("n_orders > 0").select(F.col("c_custkey").alias("rule_key"), cond.alias("conditions"))
    # One candidate per condition set before the ordered pick.
    first = rules.groupBy("conditions").agg(F.min("rule_key").alias("rule_key"))
    out = RU.dedupe(first, [], "rule_key")
    return out.select("rule_key", F.col("conditions")[0]["threshold"].cast("bigint").alias("threshold"))


@query("g10_evaluate_rule", EV + f"SELECT rule_id, coverage_n, bad_n, n, n_bad, {r(*_cols)} FROM ev")
def evaluate_rule(ws: Workspace):
    out = _given_eval(ws).select("rule_id", "coverage_n", "bad_n", "n", "n_bad", *_cols)
    return rounded(out, _cols)


_z2 = 1.96 * 1.96
_den = f"(1.0 + {_z2!r} / coverage_n)"
_cen = f"((bad_rate + {_z2!r} / (2.0 * coverage_n)) / {_den})"
_mar = (f"((1.96 / {_den}) * SQRT(bad_rate * (1 - bad_rate) / coverage_n + {_z2!r} / (4.0 * coverage_n * coverage_n)))")


@query("g11_wilson_interval", EV + f"SELECT rule_id, ROUND(GREATEST(0.0, {_cen} - {_mar}), 6) AS bad_rate_ci_low, "
       f"ROUND(LEAST(1.0, {_cen} + {_mar}), 6) AS bad_rate_ci_high FROM ev")
def wilson_interval(ws: Workspace):
    out = _given_eval(ws).select("rule_id", "bad_rate_ci_low", "bad_rate_ci_high")
    return rounded(out, ("bad_rate_ci_low", "bad_rate_ci_high"))


_gate = """gated AS (SELECT *, ROW_NUMBER() OVER (ORDER BY lift DESC, coverage_pct DESC, rule_id) AS rule_no FROM ev
 WHERE coverage_pct >= 0.01 AND lift >= 1.5 AND bad_n >= 5)"""
GATED = O.with_(O.WIDE, _given.format(src="wide"), _ev, _gate)


def _gated(ws: Workspace, df=None):
    ev = _given_eval(ws, df).withColumn("scope", F.lit("all"))
    return RU.gate(ev, ["scope"], "rule_id")


@query("g12_gate_rules", GATED + "SELECT rule_id, CAST(rule_no AS INTEGER) AS rule_no, ROUND(lift, 6) AS lift FROM gated "
       "WHERE rule_no <= 10")
def gate_rules(ws: Workspace):
    return _gated(ws).select("rule_id", "rule_no", F.round("lift", 6).alias("lift"))


_side = "CAST('0x' || SUBSTR(MD5(CAST(c_custkey AS VARCHAR) || '|holdout'), 1, 8) AS BIGINT) < CAST(FLOOR(0.3 * 4294967296) AS BIGINT)"


@query("g13_train_test_lift", O.with_(
    O.WIDE, f"sides AS (SELECT *, {_side} AS held_out FROM wide)",
    "wt AS (SELECT * FROM sides WHERE held_out)", "wn AS (SELECT * FROM sides WHERE NOT held_out)",
    _given.format(src="wt"), _ev,
    _given.format(src="wn").replace("given AS", "given2 AS"), _ev.replace("ev AS", "ev2 AS").replace("FROM given", "FROM given2")) +
    "SELECT rule_id, ROUND(e.lift, 6) AS lift, ROUND(t.lift, 6) AS train_lift, 'holdout' AS eval_scope FROM ev e JOIN ev2 t USING (rule_id)")
def train_test_lift(ws: Workspace):
    out = in_sample(F.col("c_custkey"), 0.3)
    test = _given_eval(ws, ws.wide.where(out)).select("rule_id", "lift")
    train = _given_eval(ws, ws.wide.where(~out)).select("rule_id", F.col("lift").alias("train_lift"))
    return rounded(test.join(train, "rule_id"), ("lift", "train_lift")).withColumn("eval_scope", F.lit("holdout"))


@query("g14_bootstrap_stability")
def bootstrap_stability(ws: Workspace):
    out = RU.stability(_given_eval(ws), ["rule_id"])
    return out.select("rule_id", "stab_bad_rate_mean", "stab_bad_rate_std", "stab_valid_n", "stab_n", "stability")


_std = "SQRT(bad_rate * (1 - bad_rate) / coverage_n)"
_grade = (f"CASE WHEN bad_n < 5 OR bad_rate IS NULL OR bad_rate = 0 THEN 'unstable' WHEN {_std} / bad_rate <= 0.20 THEN 'stable' "
          f"WHEN {_std} / bad_rate <= 0.40 THEN 'fair' ELSE 'unstable' END")


def _graded(ws: Workspace):
    """Grades from the binomial standard error in place of the bootstrap."""
    std = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / F.col("coverage_n"))
    valid = F.when(F.col("bad_n") >= 5, 1.0).otherwise(0.0)
    return _given_eval(ws).withColumn("stability", labels.stability_grade(F.col("bad_rate"), std, valid))


@query("g15_stability_grade", EV + f"SELECT rule_id, {_grade} AS stability FROM ev")
def stability_grade(ws: Workspace):
    return _graded(ws).select("rule_id", "stability")


@query("g16_suggested_use", EV + f"SELECT rule_id, ROUND(lift, 6) AS lift, CASE WHEN {_grade} = 'unstable' THEN 'reference' WHEN "
       f"lift >= 3 THEN 'hard_stop' WHEN lift >= 2 THEN 'warning' ELSE 'reference' END AS suggestion FROM ev")
def suggested_use(ws: Workspace):
    return rounded(RU.suggest(_graded(ws)).select("rule_id", "lift", "suggestion"), ("lift",))


@query("g19_unstable_rules", EV + f"SELECT rule_id FROM ev WHERE {_grade} = 'unstable'")
def unstable_rules(ws: Workspace):
    return RU.unstable(_graded(ws)).select("rule_id")


@query("g9_mine_rules")
def mine_rules(ws: Workspace):
    return RU.export_table(ws.rules.where("segment_dim = '__all__'"))


@query("g17_rules_by_group")
def rules_by_group(ws: Workspace):
    return RU.export_table(ws.rules.where("segment_dim <> '__all__'"))


@query("g18_rule_export")
def rule_export(ws: Workspace):
    return RU.export_table(ws.rules)


@query("g20_rule_payload")
def rule_payload(ws: Workspace):
    return RU.compact_payload(ws.rules)
