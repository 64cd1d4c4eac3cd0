"""Which of many overlapping rules are needed: touch rate against recall of rule sets.

An entity's hits are a bit mask of any number of rules. One aggregation with map-side combine reduces the
entities to (mask, n, n_bad); every further question is put to the masks, of which there are few
beside the entities. Touch rate is the share of entities that any rule of a set hits, recall the share of
bad entities among them.

Rules leave one after the other, the one that costs the fewest bad entities for each touch saved first. The
counts of what only one rule hits are kept up to date: when a rule leaves, only masks that hold it change, and
of these only such as are left with one rule. The walk is greedy, so its points are not the best of all sets.

A missing flag is no hit, a missing target not bad. Without bad entities recall is null and no rule leaves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from risklens.operators.small import local, pin

WORD = 62
SETS_AT_ONCE = 200
ACTIONS = ("delete", "merge", "tighten", "demote", "keep")


@dataclass(frozen=True)
class Policy:
    """Floor of recall, limits of the actions and the order in which they are tried."""
    recall_floor: float = 0.9
    merge_overlap: float = 0.9       # share of a rule's bad entities that another rule also hits
    tighten_touch: float = 0.1       # share of all entities that a rule hits at least
    tighten_bad_rate: float = 1.0    # its bad rate, below so many times the bad rate of all
    order: Sequence[str] = ACTIONS


@dataclass(frozen=True)
class Masks:
    """(mask, rules, n, n_bad): entities by the set of rules that hit them; ``rules`` are its indexes."""
    table: DataFrame
    names: tuple[str, ...]
    n: int
    n_bad: int


def hit_masks(flags: DataFrame, rules: Mapping[str, str], target: str) -> Masks:
    """Masks of a table with one 1 / 0 / null column for each rule; ``rules`` maps names to columns."""
    words = []
    columns = list(rules.values())
    for at in range(0, max(len(columns), 1), WORD):
        word = F.lit(0).cast("bigint")
        for i, c in enumerate(columns[at:at + WORD]):
            word = word.bitwiseOR(F.when(F.col(f"`{c}`") == 1, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        words.append(word)
    bad = F.when(F.col(f"`{target}`") == 1, 1).otherwise(0)
    grouped = flags.groupBy(F.array(*words).alias("mask")).agg(F.count("*").alias("n"), F.sum(bad).alias("n_bad"))
    held = F.expr(f"filter(sequence(0, {max(len(columns) - 1, 0)}), "
                  f"i -> (shiftright(mask[cast(i div {WORD} as int)], cast(i % {WORD} as int)) & 1) = 1)")
    table = pin(grouped.select("mask", held.alias("rules"), "n", "n_bad"))
    total = table.agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")).first()
    return Masks(table, tuple(rules), total.n or 0, total.n_bad or 0)


def _words(masks: Masks, rules: Iterable[int]) -> list[int]:
    out = [0] * max(1, -(-len(masks.names) // WORD))
    for i in rules:
        out[i // WORD] |= 1 << (i % WORD)
    return out


def _any(masks: Masks, rules: Iterable[int]) -> Column:
    """Whether a mask holds any of the rules."""
    hit = F.lit(False)
    for w, bits in enumerate(_words(masks, rules)):
        if bits:
            hit = hit | (F.col("mask")[w].bitwiseAND(F.lit(bits).cast("bigint")) != 0)
    return hit


def _rate(part: int, whole: int) -> float | None:
    return part / whole if whole else None


def rates(masks: Masks, sets: Mapping[str, Iterable[str]]) -> DataFrame:
    """(rule_set, rules, touched, bad_touched, touch_rate, recall) of any sets of rules."""
    at = {n: i for i, n in enumerate(masks.names)}
    items, rows = [(name, [at[r] for r in rules]) for name, rules in sets.items()], []
    for k in range(0, len(items), SETS_AT_ONCE):
        part = items[k:k + SETS_AT_ONCE]
        aggs = [F.coalesce(F.sum(F.when(_any(masks, rules), F.col(c))), F.lit(0)).alias(f"{c}_{i}")
                for i, (_, rules) in enumerate(part) for c in ("n", "n_bad")]
        found = masks.table.agg(*aggs).first()
        rows += [(name, len(set(rules)), found[f"n_{i}"], found[f"n_bad_{i}"], _rate(found[f"n_{i}"], masks.n),
                  _rate(found[f"n_bad_{i}"], masks.n_bad)) for i, (name, rules) in enumerate(part)]
    return local(masks.table.sparkSession, rows, "rule_set string, rules int, touched bigint, bad_touched bigint, "
                                                 "touch_rate double, recall double")


def baseline(masks: Masks) -> DataFrame:
    """The point of all rules together."""
    return rates(masks, {"__all__": masks.names})


def _named(masks: Masks) -> DataFrame:
    return local(masks.table.sparkSession, list(enumerate(masks.names)), "i int, rule string")


def health(masks: Masks) -> DataFrame:
    """One row for each rule: what it hits, what only it hits, its bad rate and contributions.

    (rule, touched, bad_touched, only_touched, only_bad, bad_rate, touch_share, recall_share, only_recall)
    """
    alone = F.size("rules") == 1
    each = masks.table.select(F.explode("rules").alias("i"), alone.alias("alone"), "n", "n_bad").groupBy("i").agg(
        F.sum("n").alias("touched"), F.sum("n_bad").alias("bad_touched"),
        F.sum(F.when(F.col("alone"), F.col("n"))).alias("only_touched"), F.sum(F.when(F.col("alone"), F.col("n_bad"))).alias("only_bad"))
    counts = ("touched", "bad_touched", "only_touched", "only_bad")
    out = _named(masks).join(F.broadcast(each), "i", "left").select("rule", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts])
    share = lambda c, whole: F.try_divide(F.col(c).cast("double"), F.lit(float(whole)))
    return out.select("*", F.try_divide(F.col("bad_touched").cast("double"), F.col("touched").cast("double")).alias("bad_rate"),
                      share("touched", masks.n).alias("touch_share"), share("bad_touched", masks.n_bad).alias("recall_share"),
                      share("only_bad", masks.n_bad).alias("only_recall"))


def overlaps(masks: Masks, among: Iterable[str] | None = None) -> DataFrame:
    """(rule, partner, both_bad, overlap): the rule that hits most of a rule's bad entities, ties by name.

    ``overlap`` is the share of the rule's bad entities that the partner also hits. Rules without bad entities,
    or without a partner that hits any of them, have null. ``among`` restricts rules and partners.
    """
    wanted = sorted(i for i, n in enumerate(masks.names) if among is None or n in set(among))
    inside = F.array_intersect("rules", F.array(*[F.lit(i) for i in wanted]).cast("array<int>"))
    held = masks.table.where("n_bad > 0").select(inside.alias("rules"), "n_bad")
    pairs = (held.select(F.explode("rules").alias("i"), "rules", "n_bad").select("i", F.explode("rules").alias("j"), "n_bad")
             .groupBy("i", "j").agg(F.sum("n_bad").alias("both")))
    names = F.broadcast(_named(masks).withColumnsRenamed({"i": "j", "rule": "partner"}))
    own = pairs.where("i = j").select("i", F.col("both").alias("own"))
    best = (pairs.where("i != j").join(names, "j").groupBy("i")
            .agg(F.min(F.struct((-F.col("both")).alias("less"), "partner")).alias("best")))
    rules = _named(masks).where(F.col("i").isin(wanted)) if among is not None else _named(masks)
    return (rules.join(own, "i", "left").join(best, "i", "left")
            .select("rule", F.col("best.partner").alias("partner"), (-F.col("best.less")).alias("both_bad"),
                    F.try_divide((-F.col("best.less")).cast("double"), F.col("own").cast("double")).alias("overlap")))


@dataclass(frozen=True)
class Step:
    """A point of the frontier: what is touched after ``rule`` has left, and what that saved and lost."""
    step: int
    rule: str | None
    touched: int
    bad_touched: int
    saved: int
    lost: int


def eliminate(masks: Masks, recall_floor: float = 0.9) -> list[Step]:
    """Steps of the greedy backward elimination; a step that would fall below the floor ends it.

    The rule with the lowest cost (bad entities lost for each touch saved, none for none is zero) leaves, of
    equal ones the one that saves most, then the first by name.
    """
    table, names = masks.table, masks.names
    start = table.where(F.size("rules") > 0).agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")).first()
    steps = [Step(0, None, start.n or 0, start.n_bad or 0, 0, 0)]
    if not masks.n_bad:
        return steps
    alone = {i: [0, 0] for i in range(len(names))}

    def count(found: DataFrame) -> None:
        for r in found.groupBy("i").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")).collect():
            alone[r.i][0] += r.n
            alone[r.i][1] += r.n_bad

    count(table.where(F.size("rules") == 1).select(F.col("rules")[0].alias("i"), "n", "n_bad"))
    floor, held = Fraction(str(recall_floor)) * masks.n_bad, len(names)
    while alone:
        cost = lambda i: Fraction(alone[i][1], alone[i][0]) if alone[i][0] else Fraction(0)
        gone = min(alone, key=lambda i: (cost(i), -alone[i][0], names[i], i))
        saved, lost = alone.pop(gone)
        if steps[-1].bad_touched - lost < floor:
            break
        steps.append(Step(len(steps), names[gone], steps[-1].touched - saved, steps[-1].bad_touched - lost, saved, lost))
        # Masks with the rule that left: those that have one rule now are only that rule's.
        left = F.array_intersect("rules", F.array(*[F.lit(i) for i in alone]).cast("array<int>"))
        changed = table.where(F.array_contains("rules", gone)).select(left.alias("left"), "n", "n_bad")
        count(changed.where(F.size("left") == 1).select(F.col("left")[0].alias("i"), "n", "n_bad"))
        if 0 < len(alone) <= held // 2:  # masks that differ in rules that left only become one
            held = len(alone)
            table = pin(table.select(left.alias("rules"), "n", "n_bad").groupBy("rules").agg(
                F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")))
    return steps


def knee(steps: Sequence[Step]) -> Step:
    """The point farthest above the chord from the first to the last point, of equal ones the last.

    Distances are compared as integers. Without a point above the chord it is the last one.
    """
    first, last = steps[0], steps[-1]
    over = lambda s: ((s.bad_touched - first.bad_touched) * (first.touched - last.touched)
                      - (last.bad_touched - first.bad_touched) * (first.touched - s.touched))
    return max(steps, key=lambda s: (over(s), s.step)) if len(steps) > 2 else last


def frontier(masks: Masks, steps: Sequence[Step]) -> DataFrame:
    """(step, rule, touched, bad_touched, touch_rate, recall, saved, lost, is_knee)."""
    at = knee(steps)
    rows = [(s.step, s.rule, s.touched, s.bad_touched, _rate(s.touched, masks.n), _rate(s.bad_touched, masks.n_bad), s.saved, s.lost, s == at)
            for s in steps]
    return local(masks.table.sparkSession, rows, "step int, rule string, touched bigint, bad_touched bigint, touch_rate double, "
                                                 "recall double, saved bigint, lost bigint, is_knee boolean")


def actions(masks: Masks, policy: Policy = Policy(), steps: Sequence[Step] | None = None) -> DataFrame:
    """(rule, action, reason, partner, touch_change, recall_change): what to do with each rule.

    delete: left the walk without a loss, so all deletions together lose nothing. merge: a rule that isn't deleted
    hits most of its bad entities. tighten: touches much at a low bad rate; handed to the threshold exploration,
    and the change is what it can be at most. demote: left at a loss before the knee. keep: none of these.
    Changes are those of the rates of all rules together; deletions and demotions add up in the order of the walk.
    """
    if unknown := set(policy.order) - set(ACTIONS):
        raise ValueError(f"unknown actions: {sorted(unknown)}")
    steps = eliminate(masks, policy.recall_floor) if steps is None else steps
    spark, last = masks.table.sparkSession, knee(steps).step
    walk = local(spark, [(s.step, s.rule, s.saved, s.lost) for s in steps if s.rule is not None],
                 "step int, rule string, saved bigint, lost bigint")
    deleted = {s.rule for s in steps if s.rule is not None and not s.lost} if "delete" in policy.order else set()
    near = overlaps(masks, [n for n in masks.names if n not in deleted])
    table = (health(masks).join(F.broadcast(walk), "rule", "left").join(F.broadcast(near), "rule", "left"))
    bad_rate = masks.n_bad / masks.n if masks.n else 0.0
    n, n_bad = float(max(masks.n, 1)), float(max(masks.n_bad, 1))
    share = lambda c, whole: -F.col(c) / F.lit(whole)
    zero = F.lit(0.0)
    cases = {
        "delete": (F.col("lost") == 0, F.lit("others hit all its bad entities"), share("saved", n), zero),
        "merge": (F.col("overlap") >= policy.merge_overlap, F.lit("partner hits nearly the same bad entities"), zero, zero),
        "tighten": ((F.col("touch_share") >= policy.tighten_touch) & (F.col("bad_rate") < policy.tighten_bad_rate * bad_rate),
                    F.lit("touches many at a low bad rate"), share("only_touched", n), share("only_bad", n_bad)),
        "demote": ((F.col("lost") > 0) & (F.col("step") <= last), F.lit("small loss before the knee"), share("saved", n), share("lost", n_bad)),
        "keep": (F.lit(True), F.lit("needed for recall"), zero, zero),
    }
    pick = lambda k: _first([(cases[a][0], cases[a][k] if k else F.lit(a)) for a in (*policy.order, "keep")])
    action = pick(0)
    handed = F.when(action == "merge", F.col("partner")).when(action == "tighten", F.lit("threshold exploration"))
    return table.select("rule", action.alias("action"), pick(1).alias("reason"), handed.alias("partner"),
                        pick(2).alias("touch_change"), pick(3).alias("recall_change"))


def _first(cases: list[tuple[Column, Column]]) -> Column:
    out = F.when(F.coalesce(cases[0][0], F.lit(False)), cases[0][1])
    for condition, value in cases[1:]:
        out = out.when(F.coalesce(condition, F.lit(False)), value)
    return out


def apply_actions(masks: Masks, advice: DataFrame, which: Sequence[str] = ("delete",)) -> DataFrame:
    """The rates of the rules that stay when the named actions take rules away."""
    gone = {r.rule for r in advice.where(F.col("action").isin(list(which))).select("rule").collect()}
    return rates(masks, {"after " + ", ".join(which): [n for n in masks.names if n not in gone]})
