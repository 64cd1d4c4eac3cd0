"""Queries about which of the triggers are needed, from their flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from risklens.operators import pruning as P
from risklens.plans.catalog import query, rounded
from risklens.plans.q_actions import N, TRIGGERS, TSQL, flagged
from risklens.plans.workspace import Workspace

RULES = {t.name: f"hit_{i}" for i, t in enumerate(TRIGGERS)}
#: Every rule alone, all but one, the categories, and all.
SETS = ({f"only {n}": [n] for n in RULES} | {f"without {n}": [m for m in RULES if m != n] for n in RULES}
        | {f"category {c}": [t.name for t in TRIGGERS if t.category_short == c] for c in dict.fromkeys(t.category_short for t in TRIGGERS)}
        | {"all": list(RULES), "none": []})
POLICY = P.Policy(recall_floor=0.8, merge_overlap=0.8, tighten_touch=0.2)

# Check SQL goes back to the flags: one row for each entity and rule that hits it.
TOTAL = "tot AS (SELECT COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad FROM fl)"
RULE = "rule AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', {i})" for i, n in enumerate(RULES)) + ") AS t(rule, i))"
HIT = "hit AS (" + " UNION ALL ".join(f"SELECT c_custkey, is_bad, '{n}' AS rule FROM fl WHERE hit_{i} = 1" for i, n in enumerate(RULES)) + ")"
BASE = TSQL.rstrip() + ",\n" + ",\n".join((TOTAL, RULE, HIT))


def _body(*ctes: str) -> str:
    return BASE + "".join(",\n" + c for c in ctes) + "\n"


def masks(ws: Workspace) -> P.Masks:
    if not hasattr(ws, "_masks"):
        ws._masks = P.hit_masks(flagged(ws), RULES, "is_bad")
    return ws._masks


def steps(ws: Workspace) -> list[P.Step]:
    if not hasattr(ws, "_steps"):
        ws._steps = P.eliminate(masks(ws), POLICY.recall_floor)
    return ws._steps


_RATES = ("touch_rate", "recall")


def _set_row(name: str, rules: list[str]) -> str:
    cond = " OR ".join(f"hit_{list(RULES).index(r)} = 1" for r in rules) or "FALSE"
    return (f"SELECT '{name}' AS rule_set, {len(rules)} AS rules, COUNT(*) FILTER ({cond}) AS touched, COUNT(*) FILTER (({cond}) AND is_bad = 1) AS bad_touched, "
            f"ROUND(COUNT(*) FILTER ({cond}) / CAST(COUNT(*) AS DOUBLE), 6) AS touch_rate, "
            f"ROUND(COUNT(*) FILTER (({cond}) AND is_bad = 1) / CAST(SUM(is_bad) AS DOUBLE), 6) AS recall FROM fl")


@query("p1_rule_sets", TSQL + " UNION ALL ".join(_set_row(k, v) for k, v in SETS.items()))
def rule_sets(ws: Workspace):
    return rounded(P.rates(masks(ws), SETS), _RATES)


@query("p1_hit_masks", TSQL + "SELECT " + " + ".join(f"COALESCE(hit_{i}, 0) * {1 << i}" for i in range(N)) +
       " AS mask, COUNT(*) AS n, CAST(SUM(is_bad) AS BIGINT) AS n_bad FROM fl GROUP BY 1")
def hit_masks(ws: Workspace):
    return masks(ws).table.select(F.col("mask")[0].alias("mask"), "n", "n_bad")


@query("p2_baseline", TSQL + _set_row("__all__", list(RULES)))
def baseline(ws: Workspace):
    return rounded(P.baseline(masks(ws)), _RATES)


HEALTH = """one AS (SELECT c_custkey, MAX(is_bad) AS is_bad, MIN(rule) AS rule FROM hit GROUP BY 1 HAVING COUNT(*) = 1),
health AS (SELECT r.rule, COALESCE(a.t, 0) AS touched, COALESCE(a.b, 0) AS bad_touched, COALESCE(o.t, 0) AS only_touched, COALESCE(o.b, 0) AS only_bad FROM rule r
  LEFT JOIN (SELECT rule, COUNT(*) AS t, CAST(SUM(is_bad) AS BIGINT) AS b FROM hit GROUP BY 1) a ON a.rule = r.rule
  LEFT JOIN (SELECT rule, COUNT(*) AS t, CAST(SUM(is_bad) AS BIGINT) AS b FROM one GROUP BY 1) o ON o.rule = r.rule),
shares AS (SELECT health.*, CASE WHEN touched > 0 THEN bad_touched / CAST(touched AS DOUBLE) END AS bad_rate, touched / CAST(n AS DOUBLE) AS touch_share,
  bad_touched / CAST(n_bad AS DOUBLE) AS recall_share, only_bad / CAST(n_bad AS DOUBLE) AS only_recall FROM health, tot)"""
_SHARES = ("bad_rate", "touch_share", "recall_share", "only_recall")


@query("p3_rule_health", _body(HEALTH) + "SELECT rule, touched, bad_touched, only_touched, only_bad, " +
       ", ".join(f"ROUND({c}, 6) AS {c}" for c in _SHARES) + " FROM shares")
def rule_health(ws: Workspace):
    return rounded(P.health(masks(ws)), _SHARES)


def _overlap(rules: str, name: str = "near") -> str:
    return f"""{name} AS (SELECT r.rule, p.partner, p.both_bad, p.both_bad / CAST(o.own AS DOUBLE) AS overlap FROM {rules} r
  LEFT JOIN (SELECT rule, COUNT(*) AS own FROM hit WHERE is_bad = 1 GROUP BY 1) o ON o.rule = r.rule
  LEFT JOIN (SELECT a.rule, b.rule AS partner, COUNT(*) AS both_bad FROM hit a JOIN hit b ON a.c_custkey = b.c_custkey AND a.rule <> b.rule
    JOIN {rules} x ON x.rule = b.rule WHERE a.is_bad = 1 GROUP BY 1, 2
    QUALIFY ROW_NUMBER() OVER (PARTITION BY a.rule ORDER BY COUNT(*) DESC, b.rule) = 1) p ON p.rule = r.rule)"""


@query("p4_overlap", _body(_overlap("rule")) + "SELECT rule, partner, both_bad, ROUND(overlap, 6) AS overlap FROM near")
def overlap(ws: Workspace):
    return rounded(P.overlaps(masks(ws)), ("overlap",))


def _walk() -> str:
    """CTEs s0, s1, ... of the steps, each from the flags of the rules that are left, and their union ``walk``."""
    out = ["""l0 AS (SELECT rule FROM rule),
s0 AS (SELECT 0 AS step, CAST(NULL AS VARCHAR) AS rule, COUNT(*) AS touched, CAST(SUM(is_bad) AS BIGINT) AS bad_touched, 0 AS saved, 0 AS lost
  FROM (SELECT c_custkey, MAX(is_bad) AS is_bad FROM hit GROUP BY 1))"""]
    for k in range(1, N + 1):
        out.append(f"""e{k} AS (SELECT rule, COUNT(*) AS saved, CAST(SUM(is_bad) AS BIGINT) AS lost FROM (SELECT c_custkey, MIN(rule) AS rule, MAX(is_bad) AS is_bad
  FROM hit JOIN l{k - 1} USING (rule) GROUP BY 1 HAVING COUNT(*) = 1) GROUP BY 1),
s{k} AS (SELECT {k} AS step, c.rule, s{k - 1}.touched - c.saved AS touched, s{k - 1}.bad_touched - c.lost AS bad_touched, c.saved, c.lost FROM s{k - 1}, tot,
  (SELECT rule, COALESCE(saved, 0) AS saved, COALESCE(lost, 0) AS lost FROM l{k - 1} LEFT JOIN e{k} USING (rule)
   ORDER BY CASE WHEN COALESCE(saved, 0) = 0 THEN 0 ELSE lost / CAST(saved AS DOUBLE) END, COALESCE(saved, 0) DESC, rule LIMIT 1) c
  WHERE (s{k - 1}.bad_touched - c.lost) * 1000 >= {round(POLICY.recall_floor * 1000)} * n_bad),
l{k} AS (SELECT l{k - 1}.rule FROM l{k - 1}, s{k} WHERE l{k - 1}.rule <> s{k}.rule)""")
    out.append("walk AS (" + " UNION ALL ".join(f"SELECT * FROM s{k}" for k in range(N + 1)) + ")")
    # The farthest above the chord from the first to the last point; of equal ones the last.
    out.append("""ends AS (SELECT MAX(touched) AS x0, MIN(touched) AS x1, MAX(bad_touched) AS y0, MIN(bad_touched) AS y1, COUNT(*) AS points FROM walk),
knee AS (SELECT step AS knee_step FROM walk, ends ORDER BY CASE WHEN points > 2 THEN (bad_touched - y0) * (x0 - x1) - (y1 - y0) * (x0 - touched) ELSE 0 END DESC,
  step DESC LIMIT 1)""")
    return ",\n".join(out)


WALK = _walk()


@query("p5_frontier", _body(WALK) + "SELECT step, rule, touched, bad_touched, ROUND(touched / CAST(n AS DOUBLE), 6) AS touch_rate, "
       "ROUND(bad_touched / CAST(n_bad AS DOUBLE), 6) AS recall, CAST(saved AS BIGINT) AS saved, CAST(lost AS BIGINT) AS lost FROM walk, tot")
def frontier(ws: Workspace):
    return rounded(P.frontier(masks(ws), steps(ws)).drop("is_knee"), _RATES)


@query("p6_knee", _body(WALK) + "SELECT step, rule, touched, bad_touched, ROUND(touched / CAST(n AS DOUBLE), 6) AS touch_rate, "
       "ROUND(bad_touched / CAST(n_bad AS DOUBLE), 6) AS recall FROM walk, tot, knee WHERE step = knee_step")
def knee(ws: Workspace):
    return rounded(P.frontier(masks(ws), steps(ws)).where("is_knee").drop("is_knee", "saved", "lost"), _RATES)


ADVICE = f"""stay AS (SELECT rule FROM rule WHERE rule NOT IN (SELECT rule FROM walk WHERE step > 0 AND lost = 0)),
{_overlap("stay")},
advice AS (SELECT s.rule, w.step, w.saved, w.lost, near.partner AS near_partner, s.only_touched, s.only_bad, n, n_bad, CASE WHEN w.lost = 0 THEN 'delete'
    WHEN near.overlap >= {POLICY.merge_overlap} THEN 'merge'
    WHEN s.touch_share >= {POLICY.tighten_touch} AND s.bad_rate < {POLICY.tighten_bad_rate} * (n_bad / CAST(n AS DOUBLE)) THEN 'tighten'
    WHEN w.lost > 0 AND w.step <= knee_step THEN 'demote' ELSE 'keep' END AS action
  FROM shares s LEFT JOIN walk w ON w.rule = s.rule LEFT JOIN near ON near.rule = s.rule, tot, knee)"""


@query("p7_actions", _body(HEALTH, WALK, ADVICE) + """SELECT rule, action, CASE action WHEN 'merge' THEN near_partner WHEN 'tighten' THEN 'threshold exploration' END AS partner,
ROUND(CASE action WHEN 'tighten' THEN -only_touched / CAST(n AS DOUBLE) WHEN 'delete' THEN -saved / CAST(n AS DOUBLE) WHEN 'demote' THEN -saved / CAST(n AS DOUBLE) ELSE 0 END, 6) AS touch_change,
ROUND(CASE action WHEN 'tighten' THEN -only_bad / CAST(n_bad AS DOUBLE) WHEN 'demote' THEN -lost / CAST(n_bad AS DOUBLE) ELSE 0 END, 6) AS recall_change FROM advice""")
def actions(ws: Workspace):
    return rounded(advised(ws).drop("reason"), ("touch_change", "recall_change"))


def advised(ws: Workspace):
    return P.actions(masks(ws), POLICY, steps(ws))


@query("p7_after_deletes", _body(WALK) + """SELECT 'after delete' AS rule_set, (SELECT CAST(COUNT(*) AS INTEGER) FROM rule WHERE rule NOT IN (SELECT rule FROM walk WHERE step > 0 AND lost = 0)) AS rules,
COUNT(*) AS touched, CAST(SUM(is_bad) AS BIGINT) AS bad_touched, ROUND(COUNT(*) / CAST((SELECT n FROM tot) AS DOUBLE), 6) AS touch_rate,
ROUND(SUM(is_bad) / CAST((SELECT n_bad FROM tot) AS DOUBLE), 6) AS recall
FROM (SELECT c_custkey, MAX(is_bad) AS is_bad FROM hit WHERE rule NOT IN (SELECT rule FROM walk WHERE step > 0 AND lost = 0) GROUP BY 1)""")
def after_deletes(ws: Workspace):
    return rounded(P.apply_actions(masks(ws), advised(ws), ("delete",)), _RATES)
