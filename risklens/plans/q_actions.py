"""Threshold and trigger queries."""

from pyspark.sql import functions as F

from risklens.config import THRESHOLDS as T
from risklens.functions import labels
from risklens.operators import thresholds as TH, triggers as TR
from risklens.operators.quantiles import group_median
from risklens.operators.segments import KEY, SEG
from risklens.operators.small import pin
from risklens.plans import oracle as O
from risklens.plans.catalog import query, r, rounded
from risklens.plans.q_univariate import corr_ctes
from risklens.plans.workspace import ROLES, Workspace

K = O.K
PAIR_FEATURES = ("c_acctbal", "open_orders", "lines_per_order", "ev_cnt", "ev_error_cnt0", "urgent_orders")
SHAPE = dict(full=True, dims=True, tags=True)
ODD = [("c_mktsegment", "NOPE", "c_acctbal"), ("planet", "EARTH", "c_acctbal"), ("r_name", "ASIA", "no_feature"),
       ("r_name", None, "c_acctbal")]


def pair_list(ws: Workspace):
    """Every market segment and the full sample with the pair features, plus broken pairs."""
    seg = ws.wide.select(F.lit("c_mktsegment").alias("segment_dim"), F.col("c_mktsegment").alias("segment_name")).distinct()
    seg = seg.unionByName(ws.spark.createDataFrame([("__all__", "__all__")], "segment_dim string, segment_name string"))
    ok = seg.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in PAIR_FEATURES])))
    odd = ws.spark.createDataFrame(ODD, "segment_dim string, segment_name string, feature string")
    return ok.unionByName(odd)


_feats = "(" + ", ".join(f"('{f}')" for f in PAIR_FEATURES) + ")"
PAIRS = (f"pairs AS (SELECT segment_dim, segment_name, f.feature FROM (SELECT DISTINCT 'c_mktsegment' AS segment_dim, "
         f"c_mktsegment AS segment_name FROM wide UNION ALL SELECT '__all__', '__all__'), "
         f"(VALUES {', '.join(f'({chr(39)}{f}{chr(39)})' for f in PAIR_FEATURES)}) f(feature) "
         f"UNION ALL VALUES ('c_mktsegment', 'NOPE', 'c_acctbal'), ('planet', 'EARTH', 'c_acctbal'), ('r_name', 'ASIA', 'no_feature'))")
BASE = [*corr_ctes(full=True), PAIRS,
        f"pl AS (SELECT long.*, COALESCE(x, MEDIAN(x) OVER (PARTITION BY {K})) AS xf FROM long JOIN pairs USING ({K}))"]


def _rows(ws: Workspace):
    """(raw rows, medians, filled rows) of the valid pairs."""
    pairs = pin(TH.read_pairs(pair_list(ws)).where(
        F.col("segment_dim").isin("c_mktsegment", "__all__") & (F.col("segment_name") != "NOPE")))
    raw = TH.pair_rows(ws.wide, ROLES, pairs, **SHAPE)
    med = group_median(raw, KEY)
    return pairs, raw, med, TH.filled(raw, med)


@query("a7_pair_list", O.with_(O.WIDE, PAIRS) + f"SELECT {K} FROM pairs")
def read_pairs(ws: Workspace):
    return TH.read_pairs(pair_list(ws))


@query("h1_pair_ledger", O.with_(O.WIDE, O.seg(), O.sizes(), O.elig(0, 0), O.long(), PAIRS) + f"""
SELECT {K}, n, n_bad, n_valid, CASE WHEN segment_dim NOT IN ('__all__', '__tag__', 'c_mktsegment', 'r_name', 'n_name') THEN 'dim_missing'
 WHEN feature = 'no_feature' THEN 'feature_missing' WHEN n IS NULL THEN 'no_rows' WHEN n < 50 THEN 'n' WHEN n_bad < 10 THEN 'bad'
 WHEN n_bad = n OR n_bad = 0 THEN 'single_class' WHEN COALESCE(n_valid, 0) = 0 OR lo = hi THEN 'no_variation' END AS skip_reason
FROM pairs LEFT JOIN (SELECT segment_dim, segment_name, n, n_bad FROM sizes) USING (segment_dim, segment_name)
LEFT JOIN (SELECT {K}, COUNT(x) AS n_valid, MIN(x) AS lo, MAX(x) AS hi FROM long GROUP BY {K}) USING ({K})""")
def pair_ledger(ws: Workspace):
    return TH.pair_ledger(ws.wide, ROLES, pin(TH.read_pairs(pair_list(ws))), **SHAPE)


_probs = "[" + ", ".join(f"{i}/20.0" for i in range(1, 20)) + "]"
PRE = [f"qs AS (SELECT {K}, LIST_SORT(LIST_DISTINCT(QUANTILE_CONT(xf, {[i / 20 for i in range(1, 20)]}))) AS es FROM pl GROUP BY {K})",
       f"pre AS (SELECT {K}, bin, COUNT(*) AS n, COUNT(*) FILTER (y = 1) AS n_bad, MIN(xf) AS x_min, MAX(xf) AS x_max, "
       f"ANY_VALUE(es[bin + 1]) AS hi FROM (SELECT pl.*, es, LEN([v FOR v IN es IF v < xf]) AS bin FROM pl JOIN qs USING ({K})) "
       f"GROUP BY {K}, bin)"]


@query("h2_pre_bins", O.with_(*BASE, *PRE) + f"SELECT {K}, CAST(bin AS INTEGER) AS bin, n, n_bad, {r('x_min', 'x_max', 'hi')} FROM pre")
def pre_bins(ws: Workspace):
    *_, rows = _rows(ws)
    return rounded(TH.pre_bins(rows), ("x_min", "x_max", "hi"))


def _best_bins() -> list[str]:
    """CTEs up to ``chosen``(K, m, cuts): the best monotone grouping of the pre-bins, one CTE for each number of bins."""
    g, b = "GREATEST(y.cn - x.cn - (y.cb - x.cb), 0.5) / CAST(t - tb AS DOUBLE)", "GREATEST(y.cb - x.cb, 0.5) / CAST(tb AS DOUBLE)"
    ctes = [
        f"pos AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY bin) AS j FROM pre)",
        f"brd AS MATERIALIZED (SELECT {K}, j, SUM(n) OVER w AS cn, SUM(n_bad) OVER w AS cb FROM pos WINDOW w AS (PARTITION BY {K} ORDER BY j) "
        f"UNION ALL SELECT DISTINCT {K}, 0, 0, 0 FROM pos)",
        f"ends AS MATERIALIZED (SELECT {K}, MAX(j) AS m, MAX(cn) AS t, MAX(cb) AS tb FROM brd GROUP BY {K})",
        f"sg AS MATERIALIZED (SELECT {K}, x.j AS i, y.j AS j, (y.cb - x.cb) / CAST(y.cn - x.cn AS DOUBLE) AS rate, ({g} - {b}) * LN(({g}) / ({b})) AS v "
        f"FROM brd x JOIN brd y USING ({K}) JOIN ends USING ({K}) WHERE x.j < y.j AND y.cn - x.cn >= {T.min_bin_share!r} * t)",
        f"l1 AS MATERIALIZED (SELECT {K}, sign, j, rate, v AS iv, [0, j] AS cuts FROM sg, (VALUES (1), (-1)) AS s(sign) WHERE i = 0)"]
    for k in range(2, T.max_bins + 1):
        ctes.append(f"l{k} AS MATERIALIZED (SELECT {K}, sign, sg.j, sg.rate, MAX(iv + v) AS iv, ARG_MAX(LIST_APPEND(cuts, sg.j), iv + v) AS cuts FROM l{k - 1} l JOIN sg USING ({K}) "
                    f"WHERE sg.i = l.j AND sign * (sg.rate - l.rate) > 0 GROUP BY {K}, sign, sg.i, sg.j, sg.rate)")
    every = " UNION ALL ".join(f"SELECT * FROM l{k}" for k in range(2, T.max_bins + 1))
    ctes.append(f"chosen AS MATERIALIZED (SELECT {K}, m, COALESCE(cuts, [0, m]) AS cuts FROM ends LEFT JOIN (SELECT {K}, cuts FROM ({every}) JOIN ends USING ({K}) "
                f"WHERE j = m AND iv > 1e-12 QUALIFY ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY ROUND(iv, 10) DESC, sign DESC, LEN(cuts)) = 1) USING ({K}))")
    return ctes


@query("h2_merged_bins", O.with_(*BASE, *PRE, *_best_bins()) + f"""SELECT {K}, CAST(e - 1 AS INTEGER) AS bin, ROUND(CASE WHEN e > 1 THEN low.hi END, 6) AS lo,
ROUND(CASE WHEN u < m THEN top.hi END, 6) AS hi, CAST(y.cn - x.cn AS BIGINT) AS n, CAST(y.cb - x.cb AS BIGINT) AS n_bad
FROM (SELECT {K}, m, UNNEST(RANGE(1, LEN(cuts))) AS e, UNNEST(cuts[1:LEN(cuts) - 1]) AS f, UNNEST(cuts[2:]) AS u FROM chosen)
JOIN (SELECT {K}, j AS f, cn, cb FROM brd) x USING ({K}, f) JOIN (SELECT {K}, j AS u, cn, cb FROM brd) y USING ({K}, u)
LEFT JOIN (SELECT {K}, j AS f, hi FROM pos) low USING ({K}, f) LEFT JOIN (SELECT {K}, j AS u, hi FROM pos) top USING ({K}, u)""")
def merged_bins(ws: Workspace):
    *_, rows = _rows(ws)
    return rounded(TH.merged_bins(TH.pre_bins(rows)), ("lo", "hi"))


MODES = f"""modes AS (SELECT {K}, x AS mode_x, n_valid, n_mode FROM (SELECT {K}, x, COUNT(*) AS n_mode, SUM(COUNT(*)) OVER (PARTITION BY {K})
 AS n_valid, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY COUNT(*) DESC, x) AS rn FROM pl WHERE x IS NOT NULL GROUP BY {K}, x)
 WHERE rn = 1 AND n_mode * 1.0 / n_valid >= 0.8)"""


@query("h3_zero_inflated", O.with_(*BASE, MODES) + f"SELECT {K}, mode_x, CAST(n_valid AS BIGINT) AS n_valid, n_mode, "
       f"ROUND(n_mode * 1.0 / n_valid, 6) AS mode_share FROM modes")
def zero_inflated(ws: Workspace):
    _, raw, med, _ = _rows(ws)
    return rounded(TH.zero_inflated(raw, med), ("mode_share",))


@query("h4_manual_bins", O.with_(*BASE, MODES) + f"""
SELECT {K}, cutoff, bin, n, n_bad, n - n_bad AS n_good, ROUND(n * 1.0 / t, 6) AS share, ROUND(n_bad * 1.0 / n, 6) AS bad_rate,
 ROUND(CASE WHEN pg > 0 AND pb > 0 THEN LN(pg / pb) ELSE 0.0 END, 6) AS woe,
 ROUND(CASE WHEN pg > 0 AND pb > 0 THEN (pg - pb) * LN(pg / pb) ELSE 0.0 END, 6) AS iv FROM (
 SELECT *, (n - n_bad) * 1.0 / GREATEST(t - tb, 1) AS pg, n_bad * 1.0 / GREATEST(tb, 1) AS pb FROM (
 SELECT *, CAST(SUM(n) OVER (PARTITION BY {K}) AS BIGINT) AS t, CAST(SUM(n_bad) OVER (PARTITION BY {K}) AS BIGINT) AS tb FROM (
 SELECT {K}, mode_x AS cutoff, CASE WHEN x > mode_x THEN 1 ELSE 0 END AS bin, COUNT(*) AS n, COUNT(*) FILTER (y = 1) AS n_bad
 FROM pl JOIN modes USING ({K}) WHERE x IS NOT NULL GROUP BY {K}, mode_x, 5)))""")
def manual_bins(ws: Workspace):
    _, raw, med, _ = _rows(ws)
    cuts = pin(TH.zero_inflated(raw, med).select(*KEY, F.col("mode_x").alias("cutoff")))
    return rounded(TH.manual_bins(raw, cuts), ("share", "bad_rate", "woe", "iv"))


DIRS = f"""jump AS (SELECT {K}, d FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY ABS(d) DESC, bin) AS rn FROM (
 SELECT {K}, bin, n_bad * 1.0 / n - LAG(n_bad * 1.0 / n) OVER (PARTITION BY {K} ORDER BY bin) AS d FROM pre) WHERE d IS NOT NULL) WHERE rn = 1),
dirs AS (SELECT {K}, CASE WHEN v > 0 THEN 'positive' WHEN v < 0 THEN 'negative' END AS direction, src AS direction_source FROM (
 SELECT {K}, CASE WHEN ABS(c) > 1e-6 THEN c WHEN d <> 0 THEN d END AS v, CASE WHEN ABS(c) > 1e-6 THEN 'corr'
 WHEN d <> 0 THEN 'bin_jump' END AS src FROM (SELECT DISTINCT {K} FROM pre) LEFT JOIN (SELECT {K}, corr AS c FROM uni WHERE
 segment_dim = 'c_mktsegment') USING ({K}) LEFT JOIN jump USING ({K})))"""


def _directions(ws: Workspace, pairs, pre):
    return TH.direction(pairs, None, ws.corr.where("segment_dim = 'c_mktsegment'"), pre)


@query("h5_direction", O.with_(*BASE, *PRE, DIRS) + f"SELECT {K}, direction, direction_source FROM dirs")
def direction(ws: Workspace):
    """Market segments take the correlation, the full sample falls back to the rate jump."""
    pairs, *_, rows = _rows(ws)
    return _directions(ws, pairs, pin(TH.pre_bins(rows)))


def sides(high: str, low: str, src: str) -> str:
    """SQL of the side metrics of ``src`` (high_n, high_bad, low_n, low_bad)."""
    e = lambda n, b: f"({n} * ({b}) / ({high}_n + {low}_n))"
    bads, goods = f"(CAST({high}_bad AS DOUBLE) + {low}_bad)", f"({high}_n + {low}_n - {high}_bad - {low}_bad)"
    terms = []
    for s in (high, low):
        for seen, want in ((f"{s}_bad", e(f"{s}_n", bads)), (f"({s}_n - {s}_bad)", e(f"{s}_n", f"CAST({goods} AS DOUBLE)"))):
            terms.append(f"POWER(ABS({seen} - {want}) - LEAST(0.5, ABS({seen} - {want})), 2) / {want}")
    ok = f"{high}_n > 0 AND {low}_n > 0 AND {bads} > 0 AND {goods} > 0"
    rate = lambda s: f"CASE WHEN {s}_n > 0 THEN CAST({s}_bad AS DOUBLE) / {s}_n ELSE 0.0 END"
    return (f"SELECT *, {rate(high)} AS high_rate, {rate(low)} AS low_rate, CASE WHEN {rate(low)} <= 0 THEN 999.0 ELSE "
            f"LEAST(999.0, ({rate(high)}) / ({rate(low)})) END AS risk_ratio, CASE WHEN {ok} THEN {' + '.join(terms)} END AS chi2, "
            f"CAST({high}_n AS DOUBLE) / ({high}_n + {low}_n) AS alert_rate FROM {src}")


BEST = f"""cum AS (SELECT {K}, bin, hi AS cutoff, SUM(n) OVER w AS n0, SUM(n_bad) OVER w AS b0, SUM(n) OVER (PARTITION BY {K}) AS tn,
 SUM(n_bad) OVER (PARTITION BY {K}) AS tb FROM pre WINDOW w AS (PARTITION BY {K} ORDER BY bin ROWS UNBOUNDED PRECEDING)),
cand AS (SELECT {K}, bin, cutoff, direction, direction_source, CAST(CASE WHEN direction = 'positive' THEN tn - n0 ELSE n0 END AS BIGINT) AS high_n,
 CAST(CASE WHEN direction = 'positive' THEN n0 ELSE tn - n0 END AS BIGINT) AS low_n, CAST(CASE WHEN direction = 'positive' THEN tb - b0 ELSE b0 END AS BIGINT) AS high_bad,
 CAST(CASE WHEN direction = 'positive' THEN b0 ELSE tb - b0 END AS BIGINT) AS low_bad FROM cum JOIN dirs USING ({K}) WHERE cutoff IS NOT NULL
 AND direction IS NOT NULL),
best AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY risk_ratio DESC, bin) AS rn FROM ({sides('high', 'low', 'cand')})) WHERE rn = 1)"""
_M = ("high_rate", "low_rate", "risk_ratio", "chi2", "alert_rate")


@query("h6_best_cut", O.with_(*BASE, *PRE, DIRS, BEST) + f"SELECT {K}, ROUND(cutoff, 6) AS cutoff, direction, direction_source, "
       f"high_n, low_n, high_bad, low_bad, {r(*_M)} FROM best")
def best_cut(ws: Workspace):
    pairs, *_, rows = _rows(ws)
    pre = pin(TH.pre_bins(rows))
    return rounded(TH.best_cut(pre, _directions(ws, pairs, pre)), ("cutoff", *_M))


CUTS = {"c_acctbal": (1000.0, "negative"), "open_orders": (4.0, "positive"), "lines_per_order": (4.2, "positive"),
        "ev_cnt": (66.0, "positive"), "ev_error_cnt0": (0.0, "positive"), "urgent_orders": (2.0, "positive")}
_cv = ", ".join(f"('{f}', CAST({c} AS DOUBLE), '{d}')" for f, (c, d) in CUTS.items())
GIVEN = f"""cuts(feature, cutoff, direction) AS (VALUES {_cv}),
cand AS (SELECT {K}, cutoff, direction, COUNT(*) FILTER (hi) AS high_n, COUNT(*) FILTER (NOT hi) AS low_n, COUNT(*) FILTER (hi AND y = 1)
 AS high_bad, COUNT(*) FILTER (NOT hi AND y = 1) AS low_bad FROM (SELECT *, CASE WHEN direction = 'positive' THEN xf > cutoff ELSE
 NOT (xf > cutoff) END AS hi FROM pl JOIN cuts USING (feature)) GROUP BY {K}, cutoff, direction),
met AS ({sides('high', 'low', 'cand')})"""


def _cut_metrics(ws: Workspace):
    pairs, *_, rows = _rows(ws)
    given = ws.spark.createDataFrame([(f, c, d) for f, (c, d) in CUTS.items()], "feature string, cutoff double, direction string")
    return TH.cut_metrics(rows, pin(pairs.join(given, "feature")))


@query("h7_cut_metrics", O.with_(*BASE, GIVEN) + f"SELECT {K}, cutoff, direction, high_n, low_n, high_bad, low_bad, {r(*_M)} FROM met")
def cut_metrics(ws: Workspace):
    return rounded(_cut_metrics(ws), _M)


@query("h7_cut_p_values")
def cut_p_values(ws: Workspace):
    from risklens.functions.stats import chi2_1_p_value
    return _cut_metrics(ws).select(*KEY, "chi2", chi2_1_p_value("chi2").alias("p_value"))


# p <= .05 / .01 / .001 of one degree of freedom, as quantiles of the statistic.
Q05, Q01, Q001 = 3.841458820694124, 6.634896601021213, 10.827566170662733
IVG = O.with_(*BASE, GIVEN, *O.iv_ctes())
_ref = f"""ref AS (SELECT {K}, COALESCE(g.iv, f.iv) AS ref_iv, CASE WHEN g.iv IS NOT NULL THEN 'group' WHEN f.iv IS NOT NULL THEN 'full' ELSE
 'missing' END AS iv_source FROM pairs LEFT JOIN (SELECT {K}, iv FROM ivt WHERE segment_dim = 'c_mktsegment') g USING ({K})
 LEFT JOIN (SELECT feature, iv FROM ivt WHERE segment_dim = '__all__') f USING (feature))"""
REF = O.with_(*BASE, GIVEN, *O.iv_ctes(), _ref)


def _reference(ws: Workspace, pairs):
    return TH.reference_iv(pairs, ws.iv_all.where("segment_dim = 'c_mktsegment'"), ws.iv_full)


@query("h9_reference_iv", REF + f"SELECT {K}, ROUND(ref_iv, 6) AS ref_iv, iv_source FROM ref")
def reference_iv(ws: Workspace):
    return rounded(_reference(ws, TH.read_pairs(pair_list(ws))), ("ref_iv",))


_p = f"CASE WHEN COALESCE(chi2, 0) >= {Q05} THEN 0.01 ELSE 1.0 END"


@query("h8_validity", REF + f"""
SELECT {K}, CASE WHEN risk_ratio < 2 THEN 'risk_ratio' WHEN COALESCE(chi2, 0) < {Q05} THEN 'p_value' WHEN high_bad < 10 THEN 'high_bad'
 WHEN alert_rate < 0.01 THEN 'alert_low' WHEN alert_rate > 0.30 THEN 'alert_high' WHEN ref_iv IS NULL THEN 'iv_missing'
 WHEN ref_iv < 0.02 THEN 'iv' ELSE '-' END AS fail_reason FROM met JOIN ref USING ({K})""")
def validity(ws: Workspace):
    p = F.when(F.coalesce("chi2", F.lit(0.0)) >= Q05, 0.01).otherwise(1.0)
    out = _reference(ws, pin(_cut_metrics(ws)))
    return out.select(*KEY, TH.validity(p).alias("fail_reason"))


@query("h10_significance", O.with_(*BASE, GIVEN) + f"""
SELECT {K}, CASE WHEN chi2 > {Q001} THEN '***' WHEN chi2 > {Q01} THEN '**' WHEN chi2 > {Q05} THEN '*' ELSE 'ns' END AS significance FROM met""")
def significance(ws: Workspace):
    from risklens.functions.stats import chi2_1_p_value
    out = pin(_cut_metrics(ws)).withColumn("p", F.coalesce(chi2_1_p_value("chi2"), F.lit(1.0)))
    return out.select(*KEY, labels.stars(F.col("p")).alias("significance"))


@query("h12_mark_cutoff", O.with_(*BASE, *PRE, DIRS, BEST) + f"""
SELECT {K}, CAST(p.bin AS INTEGER) AS bin, p.n, CASE WHEN ABS(p.hi - b.cutoff) < 1e-9 THEN 1 ELSE 0 END AS is_cutoff
FROM pre p JOIN (SELECT {K}, cutoff FROM best) b USING ({K})""")
def mark_cutoff(ws: Workspace):
    pairs, *_, rows = _rows(ws)
    pre = pin(TH.pre_bins(rows))
    cuts = TH.best_cut(pre, _directions(ws, pairs, pre))
    return TH.mark_cutoff(pre, cuts).select(*KEY, "bin", "n", "is_cutoff")


def explored(ws: Workspace):
    if not hasattr(ws, "_explored"):
        ws._explored = TH.explore(ws.wide, ROLES, pair_list(ws), iv_full=ws.iv_full, iv_group=ws.iv_all, lr=ws.lr.coefs,
                                  corr=ws.corr, **SHAPE)
    return ws._explored


@query("h13_explore_thresholds")
def explore_thresholds(ws: Workspace):
    return explored(ws)[0]


@query("h13_explore_detail")
def explore_detail(ws: Workspace):
    return explored(ws)[1]


@query("h13_explore_skipped")
def explore_skipped(ws: Workspace):
    return explored(ws)[2]


# ---- triggers ---------------------------------------------------------------------------------

TRIGGERS = [
    TR.Trigger("open orders", "open_orders", "positive", 0.64, "volume-open"),
    TR.Trigger("lines per order", "lines_per_order", "positive", 0.62, "ratio"),
    TR.Trigger("urgent orders", "urgent_orders", "positive", 0.42, "volume-urgent", explicit=(">=", 3.0)),
    TR.Trigger("balance in asia", "c_acctbal", "negative", 0.02, "balance", scope={"dim": "r_name", "value": "ASIA"}),
    TR.Trigger("quantity", "qty_per_line", "positive", 0.14, "ratio",
               scope={"dim": "c_mktsegment", "values": ["BUILDING", "MACHINERY"]}),
    TR.Trigger("errors in japan", "ev_error_cnt", "positive", 0.01, "event", scope={"dim": "n_name", "value": "NATION_12"}),
    TR.Trigger("no column", "nope", "positive", 0.05, "ghost"),
    TR.Trigger("no scope", "n_lines", "positive", 0.05, "ghost", scope={"dim": "nope", "value": 1}),
    TR.Trigger("waist balance", "c_acctbal", "negative", 0.02, "balance", scope="waist", iv_waist=0.03),
]


def trigger_input(ws: Workspace):
    return ws.wide.withColumn("is_mid_high_rating", (F.col("n_orders") > 9).cast("int"))


_scopes = {3: "r_name = 'ASIA'", 4: "c_mktsegment IN ('BUILDING', 'MACHINERY')", 5: "n_name = 'NATION_12'", 8: "n_orders > 9"}
_dead = {6, 7}


def _th_row(i: int) -> str:
    t = TRIGGERS[i]
    s = _scopes.get(i, "TRUE")
    label = TR.scope_label(t.scope).replace("'", "''")
    head = f"SELECT {i} AS i, '{t.name}' AS name, '{label}' AS scope, '{t.direction}' AS direction, "
    if i in _dead:
        reason = "column_missing" if i == 6 else "scope_missing"
        return head + f"NULL AS operator, CAST(NULL AS DOUBLE) AS value, NULL AS source, CAST(NULL AS DOUBLE) AS good_mean, CAST(NULL AS DOUBLE) AS bad_mean, NULL AS chk, '{reason}' AS skip_reason"
    op = t.explicit[0] if t.explicit else (">=" if t.direction == "positive" else "<=")
    if t.explicit:
        return head + f"'{op}', {t.explicit[1]}, 'explicit', NULL, NULL, NULL, NULL"
    cmp_ = ">" if t.direction == "positive" else "<"
    thin = f"(COUNT({t.column}) FILTER (is_bad = 0) < 10 OR COUNT({t.column}) FILTER (is_bad = 1) < 5)"
    g, b = f"AVG({t.column}) FILTER (is_bad = 0)", f"AVG({t.column}) FILTER (is_bad = 1)"
    return head + (f"'{op}', CASE WHEN {thin} THEN MEDIAN({t.column}) ELSE {b} END, CASE WHEN {thin} THEN 'scope_median' ELSE 'bad_mean' END, "
                   f"CASE WHEN NOT {thin} THEN {g} END, CASE WHEN NOT {thin} THEN {b} END, CASE WHEN NOT {thin} THEN CASE WHEN {b} {cmp_} {g} THEN "
                   f"'consistent' ELSE 'conflict' END END, NULL FROM wide WHERE {s}")


TH_CTE = "th AS (" + " UNION ALL ".join(_th_row(i) for i in (6, 0, 1, 2, 3, 4, 5, 7, 8)) + ")"


def _hit(i: int) -> str:
    t = TRIGGERS[i]
    if i in _dead:
        return f"CAST(NULL AS INTEGER) AS hit_{i}"
    op = t.explicit[0] if t.explicit else (">=" if t.direction == "positive" else "<=")
    return (f"CASE WHEN {t.column} IS NOT NULL AND (SELECT value FROM th WHERE i = {i}) IS NOT NULL THEN CASE WHEN {t.column} {op} "
            f"(SELECT value FROM th WHERE i = {i}) AND {_scopes.get(i, 'TRUE')} THEN 1 ELSE 0 END END AS hit_{i}")


N = len(TRIGGERS)
FLAGS = "fl AS (SELECT *, " + ", ".join(_hit(i) for i in range(N)) + " FROM wide)"
_h = [f"COALESCE(hit_{i}, 0)" for i in range(N)]
_total = sum(t.weight for t in TRIGGERS)
_cats: dict = {}
for _i, _t in enumerate(TRIGGERS):
    if _i not in _dead:
        _cats.setdefault(_t.category_short, []).append(_i)
SCORED = ("sc AS (SELECT *, " + " + ".join(_h) + " AS n_hits, ROUND((" + " + ".join(f"{h} * {t.weight}" for h, t in zip(_h, TRIGGERS)) +
          f") / {_total!r} * 100, 2) AS score, " + ", ".join(f"{' + '.join(_h[i] for i in ii)} AS hits_{c}" for c, ii in _cats.items()) +
          ", CONCAT_WS('; ', " + ", ".join(f"CASE WHEN hit_{i} = 1 THEN '{t.name}' END" for i, t in enumerate(TRIGGERS)) + ") AS hit_names FROM fl)")
TSQL = O.with_(O.WIDE, TH_CTE, FLAGS, SCORED)


def found(ws: Workspace):
    if not hasattr(ws, "_found"):
        ws._found = TR.thresholds(trigger_input(ws), TRIGGERS, "is_bad")
    return ws._found


def flagged(ws: Workspace, keep=()):
    return TR.flags(trigger_input(ws), TRIGGERS, found(ws), key="c_custkey", target="is_bad", keep=list(keep))


def scored(ws: Workspace, keep=()):
    return TR.score(flagged(ws, keep), TRIGGERS, found(ws))


@query("i1_scope", O.with_(O.WIDE) + "SELECT c_custkey, " + ", ".join(f"{_scopes.get(i, 'TRUE')} AS s{i}" for i in range(N) if i != 7) + " FROM wide")
def scope(ws: Workspace):
    df = trigger_input(ws)
    masks = [TR.scope_mask(df.columns, t.scope) for t in TRIGGERS]
    return df.select("c_custkey", *[m.alias(f"s{i}") for i, m in enumerate(masks) if m is not None])


_TC = ("value", "good_mean", "bad_mean")


@query("i3_thresholds", O.with_(O.WIDE, TH_CTE) + f"SELECT name, scope, direction, operator, source, {r(*_TC)}, chk AS \"check\", skip_reason FROM th")
def thresholds(ws: Workspace):
    t = TR.threshold_table(ws.spark, TR.thresholds(trigger_input(ws), TRIGGERS, "is_bad"))
    return rounded(t.select("name", "scope", "direction", "operator", "source", *_TC, "check", "skip_reason"), _TC)


@query("i4_flags", TSQL + "SELECT c_custkey, " + ", ".join(f"hit_{i}" for i in range(N)) + " FROM fl")
def flags(ws: Workspace):
    return flagged(ws).select("c_custkey", *[f"hit_{i}" for i in range(N)])


@query("i5_category_counts", TSQL + "SELECT c_custkey, n_hits, " + ", ".join(f"hits_{c}" for c in _cats) + " FROM sc")
def category_counts(ws: Workspace):
    return scored(ws).select("c_custkey", "n_hits", *[f"hits_{c}" for c in _cats])


@query("i6_trigger_score", TSQL + "SELECT c_custkey, is_bad, score FROM sc")
def trigger_score(ws: Workspace):
    return scored(ws).select("c_custkey", "is_bad", "score")


@query("i7_trigger_names", TSQL + "SELECT c_custkey, hit_names FROM sc")
def trigger_names(ws: Workspace):
    return scored(ws).select("c_custkey", "hit_names")


def _col(i: int) -> str:
    return TRIGGERS[i].column if i != 6 else "NULL"


LONG = " UNION ALL ".join(
    f"SELECT c_custkey, is_bad, ROUND(CAST({_col(i)} AS DOUBLE), 6) AS value, t.name AS trigger, t.scope, t.operator, ROUND(t.value, 6) AS threshold, "
    f"t.source AS threshold_source FROM fl, th t WHERE t.i = {i} AND hit_{i} = 1" for i in range(N) if i not in _dead)


@query("i8_trigger_long", TSQL + LONG)
def trigger_long(ws: Workspace):
    out = TR.long_table(flagged(ws), TRIGGERS, found(ws), key="c_custkey", target="is_bad")
    out = out.select("c_custkey", "is_bad", "value", "trigger", "scope", "operator", "threshold", "threshold_source")
    return rounded(out, ("value", "threshold"))


@query("i9_threshold_table", O.with_(O.WIDE, TH_CTE) + "SELECT name, scope, CASE WHEN skip_reason IS NULL THEN operator ELSE '-' END AS operator, "
       "COALESCE(source, skip_reason) AS source FROM th")
def threshold_table(ws: Workspace):
    t = TR.threshold_table(ws.spark, found(ws))
    return t.select("name", "scope", F.coalesce("operator", F.lit("-")).alias("operator"), F.coalesce("source", "skip_reason").alias("source"))


@query("i11_extract_triggers", TSQL + "SELECT c_custkey, c_mktsegment, is_bad, n_hits, score, hit_names FROM sc")
def extract_triggers(ws: Workspace):
    wide, _, _ = TR.extract(trigger_input(ws), TRIGGERS, key="c_custkey", target="is_bad", keep=["c_mktsegment"])
    return wide.select("c_custkey", "c_mktsegment", "is_bad", "n_hits", "score", "hit_names")


@query("a9_trigger_export", TSQL + "SELECT c_custkey, n_hits, score, hit_names, " + ", ".join(f"hits_{c}" for c in _cats) + ", " +
       ", ".join(f"ROUND(CAST({_col(i)} AS DOUBLE), 6) AS value_{i}, hit_{i}" for i in range(N)) + " FROM sc")
def trigger_export(ws: Workspace):
    out = TR.slim(scored(ws, ["c_mktsegment"]), key="c_custkey")
    return rounded(out, [f"value_{i}" for i in range(N)])


@query("i12_hit_summary", TSQL + " UNION ALL ".join(
    f"SELECT '{t.name}' AS trigger, COUNT(hit_{i}) AS n_valid, COUNT(*) FILTER (hit_{i} = 1) AS n_hit, COUNT(*) FILTER (hit_{i} = 1 AND is_bad = 1) "
    f"AS n_bad_hit, COUNT(hit_{i}) FILTER (is_bad = 1) AS n_bad, ROUND(COALESCE(COUNT(*) FILTER (hit_{i} = 1) * 100.0 / NULLIF(COUNT(hit_{i}), 0), 0), 6) AS hit_pct, "
    f"ROUND(COALESCE(COUNT(*) FILTER (hit_{i} = 1 AND is_bad = 1) * 100.0 / NULLIF(COUNT(hit_{i}) FILTER (is_bad = 1), 0), 0), 6) AS bad_hit_pct FROM fl"
    for i, t in enumerate(TRIGGERS)))
def hit_summary(ws: Workspace):
    return rounded(TR.hit_summary(flagged(ws), TRIGGERS, "is_bad"), ("hit_pct", "bad_hit_pct"))


@query("i12_class_summary", TSQL + "SELECT is_bad, COUNT(*) AS n, ROUND(AVG(n_hits), 6) AS avg_hits, ROUND(AVG(score), 6) AS avg_score FROM sc GROUP BY is_bad")
def class_summary(ws: Workspace):
    return rounded(TR.class_summary(scored(ws), "is_bad"), ("avg_hits", "avg_score"))


@query("i13_score_bands", TSQL + """SELECT band, COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad, ROUND(SUM(is_bad) * 100.0 / COUNT(*), 6) AS bad_pct FROM (
SELECT is_bad, CASE WHEN score <= 0 THEN '0' WHEN score <= 5 THEN '0-5' WHEN score <= 10 THEN '5-10' WHEN score <= 15 THEN '10-15' WHEN score <= 20 THEN '15-20'
 WHEN score <= 30 THEN '20-30' WHEN score <= 50 THEN '30-50' ELSE '50+' END AS band FROM sc) GROUP BY band""")
def score_bands(ws: Workspace):
    return rounded(TR.score_bands(scored(ws), "is_bad"), ("bad_pct",))


@query("i14_threshold_issues", O.with_(O.WIDE, TH_CTE) + "SELECT name, scope, COALESCE(skip_reason, chk) AS issue FROM th WHERE skip_reason IS NOT NULL OR chk = 'conflict'")
def threshold_issues(ws: Workspace):
    return TR.issues(ws.spark, found(ws))
