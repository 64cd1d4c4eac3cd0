"""Building blocks of the DuckDB check queries: common table expressions as text."""

from __future__ import annotations

from risklens.plans.workspace import DIMS, FEATURES, TAGS

K = "segment_dim, segment_name, feature"
S = "segment_dim, segment_name"

WIDE = """wide AS (
SELECT c.c_custkey, c.c_mktsegment, n.n_name, r.r_name, c.c_acctbal,
       COALESCE(o.n_orders, 0) AS n_orders, COALESCE(l.n_lines, 0) AS n_lines,
       COALESCE(l.qty_sum, 0) AS qty_sum, COALESCE(l.price_cents, 0) AS price_cents,
       COALESCE(o.urgent_orders, 0) AS urgent_orders, COALESCE(o.open_orders, 0) AS open_orders,
       CASE WHEN o.n_orders > 0 THEN CAST(o.urgent_orders AS DOUBLE) / CAST(o.n_orders AS DOUBLE) END AS urgent_share,
       CASE WHEN o.n_orders > 0 THEN CAST(l.n_lines AS DOUBLE) / CAST(o.n_orders AS DOUBLE) END AS lines_per_order,
       CASE WHEN l.n_lines > 0 THEN CAST(l.qty_sum AS DOUBLE) / CAST(l.n_lines AS DOUBLE) END AS qty_per_line,
       e.ev_cnt, e.ev_error_cnt, COALESCE(e.ev_error_cnt, 0) AS ev_error_cnt0,
       CASE WHEN COALESCE(o.urgent_orders, 0) >= 3 THEN 1 ELSE 0 END AS is_urgent_buyer,
       CASE WHEN c.c_acctbal >= 5000 THEN 1 ELSE 0 END AS is_high_balance,
       CASE WHEN COALESCE(l.n_returned, 0) >= 18 THEN 1 ELSE 0 END AS is_bad
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS n_orders,
    CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent_orders,
    CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_orders
  FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT o2.o_custkey, CAST(COUNT(*) AS BIGINT) AS n_lines,
    CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty_sum,
    CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents,
    CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned
  FROM lineitem JOIN orders o2 ON l_orderkey = o2.o_orderkey GROUP BY o2.o_custkey) l
  ON l.o_custkey = c.c_custkey
LEFT JOIN (SELECT user_id, CAST(COUNT(*) AS BIGINT) AS ev_cnt,
    CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS ev_error_cnt
  FROM events GROUP BY user_id) e ON e.user_id = c.c_custkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def seg(full=True, dims=DIMS, tags=TAGS, src="wide", name="seg", null_group=None) -> str:
    parts = []
    if full:
        parts.append(f"SELECT '__all__' AS segment_dim, '__all__' AS segment_name, * FROM {src}")
    for d in dims:
        if null_group:
            parts.append(f"SELECT '{d}', COALESCE({d}, '{null_group}'), * FROM {src}")
        else:
            parts.append(f"SELECT '{d}' AS segment_dim, {d} AS segment_name, * FROM {src} "
                         f"WHERE {d} IS NOT NULL")
    for t in tags:
        parts.append(f"SELECT '__tag__' AS segment_dim, '{t[3:]}' AS segment_name, * "
                     f"FROM {src} WHERE {t} = 1")
    return f"{name} AS (" + "\nUNION ALL ".join(parts) + ")"


def sizes(src="seg", name="sizes") -> str:
    return (f"{name} AS (SELECT {S}, COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad, "
            f"COUNT(*) - CAST(SUM(is_bad) AS BIGINT) AS n_good FROM {src} GROUP BY {S})")


def elig(min_n=50, min_bad=10, min_good=0, full_free=True, tag_n=True, name="elig") -> str:
    n_ok = f"n >= {min_n}" if tag_n else f"(n >= {min_n} OR segment_dim = '__tag__')"
    cond = f"{n_ok} AND n_bad >= {min_bad} AND n_good >= {min_good}"
    if full_free:
        cond = f"segment_dim = '__all__' OR ({cond})"
    return f"{name} AS (SELECT * FROM sizes WHERE {cond})"


def long(features=FEATURES, extra="", name="long", fill=None, gate="elig") -> str:
    val = (lambda f: f"COALESCE(CAST({f} AS DOUBLE), {fill})") if fill is not None else (
        lambda f: f"CAST({f} AS DOUBLE)")
    items = ", ".join(f"{{'f': '{f}', 'x': {val(f)}}}" for f in features)
    more = f", {extra}" if extra else ""
    return (f"{name} AS (SELECT {S}, p.f AS feature, p.x AS x, y{more} FROM (SELECT seg.segment_dim, "
            f"seg.segment_name, is_bad AS y{more}, UNNEST([{items}]) AS p FROM seg "
            f"JOIN {gate} g ON seg.segment_dim = g.segment_dim AND seg.segment_name = g.segment_name))")


def _quantile_bins(src: str, meta: str, p: str) -> list[str]:
    """Bins of ``src``(K, x, y) with per-key ``meta``(K, n, k, nd): by value or by quantile."""
    return [
        f"{p}rk AS (SELECT s.*, ROW_NUMBER() OVER (PARTITION BY {K} ORDER BY x) AS rn FROM {src} s)",
        f"{p}pos AS (SELECT {K}, i, CAST(n - 1 AS DOUBLE) * (CAST(i AS DOUBLE) / CAST(k AS DOUBLE)) AS p "
        f"FROM {meta}, (SELECT UNNEST(RANGE(0, 11)) AS i) WHERE i <= k)",
        f"{p}edge AS (SELECT {K}, a + (b - a) * (p - FLOOR(p)) AS e FROM (SELECT {K}, i, p, "
        f"MAX(CASE WHEN rn = FLOOR(p) + 1 THEN x END) AS a, MAX(CASE WHEN rn = CEIL(p) + 1 THEN x END) AS b "
        f"FROM {p}pos JOIN {p}rk USING ({K}) WHERE rn = FLOOR(p) + 1 OR rn = CEIL(p) + 1 "
        f"GROUP BY {K}, i, p))",
        f"{p}es AS (SELECT {K}, LIST(DISTINCT e) AS es, COUNT(DISTINCT e) AS ne FROM {p}edge GROUP BY {K})",
        f"{p}bin AS (SELECT s.*, m.nd <= m.k AS by_value, e.ne, CASE WHEN m.nd <= m.k THEN x ELSE "
        f"GREATEST(1, LEN([v FOR v IN e.es IF v < x])) END AS b "
        f"FROM {src} s JOIN {meta} m USING ({K}) JOIN {p}es e USING ({K}))",
    ]


def binning(src: str = "long") -> list[str]:
    """CTEs up to ``bins``(K, kind, n, n_bad, x_min, x_max) and ``tot``."""
    out = [
        f"tot AS (SELECT *, CASE WHEN n >= 300 AND n_bad >= 30 THEN 10 ELSE GREATEST(3, LEAST("
        f"GREATEST(3, n_bad // 3), GREATEST(3, n // 20), 10)) END AS k, (n_rows > bad_rows AND bad_rows > 0 "
        f"AND n >= 50 AND n_bad > 0 AND n > n_bad) AS computable FROM (SELECT {K}, COUNT(*) AS n_rows, "
        f"CAST(SUM(y) AS BIGINT) AS bad_rows, COUNT(x) AS n, CAST(COALESCE(SUM(CASE WHEN x IS NOT NULL "
        f"THEN y END), 0) AS BIGINT) AS n_bad, COUNT(DISTINCT x) AS nd FROM {src} GROUP BY {K}))",
        "m1 AS (SELECT * FROM tot WHERE computable)",
        f"l1 AS (SELECT l.* FROM {src} l JOIN m1 USING ({K}) WHERE x IS NOT NULL)",
        *_quantile_bins("l1", "m1", "q1"),
        f"modes AS (SELECT {K}, x AS mode_x FROM (SELECT {K}, x, ROW_NUMBER() OVER (PARTITION BY {K} "
        f"ORDER BY COUNT(*) DESC, x) AS r FROM q1bin WHERE NOT by_value AND ne <= 2 GROUP BY {K}, x) "
        f"WHERE r = 1)",
        f"l2 AS (SELECT l1.* FROM l1 JOIN modes USING ({K}) WHERE x <> mode_x)",
        f"m2 AS (SELECT {K}, COUNT(*) AS n, COUNT(DISTINCT x) AS nd, GREATEST(2, ANY_VALUE(m1.k) - 1) AS k "
        f"FROM l2 JOIN m1 USING ({K}) GROUP BY {K})",
        *_quantile_bins("l2", "m2", "q2"),
        f"bins AS (SELECT {K}, kind, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS n_bad, MIN(x) AS x_min, "
        f"MAX(x) AS x_max, MAX(ne) AS ne FROM ("
        f"SELECT {K}, CASE WHEN by_value THEN 'value' ELSE 'quantile' END AS kind, b, x, y, ne FROM q1bin "
        f"WHERE by_value OR ne > 2 UNION ALL "
        f"SELECT {K}, 'mode', 0, x, y, 0 FROM l1 JOIN modes USING ({K}) WHERE x = mode_x UNION ALL "
        f"SELECT {K}, 'tail', b, x, y, 0 FROM q2bin) GROUP BY {K}, kind, b)",
    ]
    return out


def share(cell: str, total: str) -> str:
    return f"((CASE WHEN {cell} = 0 THEN 0.5 ELSE CAST({cell} AS DOUBLE) END) / CAST({total} AS DOUBLE))"


def woe(good: str, bad: str, tg: str, tb: str) -> str:
    return f"GREATEST(-5.0, LEAST(5.0, LN({share(good, tg)} / {share(bad, tb)})))"


def part(good: str, bad: str, tg: str, tb: str) -> str:
    return f"(({share(good, tg)} - {share(bad, tb)}) * {woe(good, bad, tg, tb)})"


def reliability(iv="iv", n="n", bad="n_bad") -> str:
    return (f"CASE WHEN {iv} IS NULL THEN 'not_computable' WHEN {iv} > 2.0 THEN 'unreliable_leak' "
            f"WHEN {bad} < 20 AND {iv} > 0.5 THEN 'unreliable_small' WHEN {bad} < 20 THEN 'reference' "
            f"WHEN {n} < 200 THEN 'reference' WHEN {iv} > 1.0 THEN 'reference' ELSE 'reliable' END")


def power(iv="iv") -> str:
    return (f"CASE WHEN {iv} >= 0.3 THEN 'strong' WHEN {iv} >= 0.1 THEN 'medium' "
            f"WHEN {iv} >= 0.02 THEN 'weak' ELSE 'none' END")


def level(iv="iv") -> str:
    return (f"CASE WHEN {iv} IS NULL THEN 'not_computable' WHEN {iv} >= 0.5 THEN 'too_strong' "
            f"ELSE {power(iv)} END")


def iv_ctes(name: str = "ivt", src: str = "long") -> list[str]:
    """CTEs up to the IV table; needs ``long``."""
    tg = "(n_rows - bad_rows)"
    return [
        *binning(src),
        f"parts AS (SELECT {K}, SUM({part('(b.n - b.n_bad)', 'b.n_bad', tg, 'bad_rows')}) AS iv_s, "
        f"COUNT(*) AS n_bins, MAX(CASE WHEN kind = 'quantile' THEN ne - 1 END) AS n_edges "
        f"FROM bins b JOIN tot t USING ({K}) GROUP BY {K})",
        f"{name} AS (SELECT *, {reliability()} AS iv_reliability, {power()} AS iv_power FROM ("
        f"SELECT *, iv_missing + iv_nonmissing AS iv FROM (SELECT {K}, n_rows AS segment_n, "
        f"bad_rows AS segment_bad, CAST(bad_rows AS DOUBLE) / n_rows AS segment_bad_rate, n, n_bad, "
        f"n_rows - n AS n_missing, COALESCE(n_bins, 0) AS n_bins, "
        f"CASE WHEN computable THEN CASE WHEN n_rows = n THEN 0.0 ELSE "
        f"{part('((n_rows - n) - (bad_rows - n_bad))', '(bad_rows - n_bad)', tg, 'bad_rows')} END END AS iv_missing, "
        f"CASE WHEN computable THEN iv_s + CASE WHEN COALESCE(n_edges - n_bins, 0) > 0 THEN "
        f"(n_edges - n_bins) * {part('0', '0', tg, 'bad_rows')} ELSE 0.0 END END AS iv_nonmissing "
        f"FROM tot LEFT JOIN parts USING ({K}))))",
    ]


def iv_all(full=True, dims=DIMS, tags=TAGS, features=FEATURES, **gates) -> list[str]:
    return [WIDE, seg(full, dims, tags), sizes(), elig(**gates), long(features), *iv_ctes()]
