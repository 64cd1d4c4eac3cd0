"""Rule pruning against a brute force over entities."""

import random
from fractions import Fraction

import pytest

from risklens.operators import pruning as P


def flags(spark, rows, rules):
    """rows: (set of rules that hit, is_bad); a missing flag stands for no hit in every third row."""
    table = [(i, bad, *[1 if r in hit else (None if i % 3 == 0 else 0) for r in rules]) for i, (hit, bad) in enumerate(rows)]
    schema = ", ".join(["id int", "is_bad int", *[f"h{i} int" for i in range(len(rules))]])
    return P.hit_masks(spark.createDataFrame(table, schema).repartition(3), {r: f"h{i}" for i, r in enumerate(rules)}, "is_bad")


def brute_walk(rows, rules, floor):
    left, total = set(rules), sum(b or 0 for _, b in rows)
    counted = lambda left: (sum(1 for h, _ in rows if h & left), sum(b or 0 for h, b in rows if h & left))
    out = [(None, *counted(left), 0, 0)]
    while left and total:
        best = None
        for r in left:
            t, b = counted(left - {r})
            saved, lost = out[-1][1] - t, out[-1][2] - b
            key = (Fraction(lost, saved) if saved else 0, -saved, r)
            if best is None or key < best[0]:
                best = (key, r, t, b, saved, lost)
        if best[3] < Fraction(str(floor)) * total:
            break
        left.remove(best[1])
        out.append(best[1:])
    return out


def random_rows(n, rules, seed):
    r = random.Random(seed)
    weight = {x: r.random() ** 2 * 0.5 for x in rules}
    rows = []
    for _ in range(n):
        hit = {x for x in rules if r.random() < weight[x]}
        rows.append((hit, r.choice([0, 0, 0, 1, None]) if not hit else int(r.random() < 0.1 + 0.1 * len(hit))))
    return rows


@pytest.mark.parametrize("seed,floor", [(1, 0.9), (2, 0.5), (3, 0.0)])
def test_frontier_equals_brute_force(spark, seed, floor):
    rules = [f"rule {i}" for i in range(8)]
    rows = random_rows(400, rules, seed)
    steps = P.eliminate(flags(spark, rows, rules), floor)
    assert [(s.rule, s.touched, s.bad_touched, s.saved, s.lost) for s in steps] == brute_walk(rows, rules, floor)
    assert all(a.touched >= b.touched and a.bad_touched >= b.bad_touched for a, b in zip(steps, steps[1:]))


def test_more_rules_than_a_word_has_bits(spark):
    rules = [f"r{i:03}" for i in range(70)]
    r = random.Random(4)
    rows = [(set(r.sample(rules, r.randint(0, 3))), r.randint(0, 1)) for _ in range(300)]
    masks = flags(spark, rows, rules)
    assert sum(x.n for x in masks.table.collect()) == 300
    sets = {"first": rules[:1], "late": rules[61:64], "all": rules, "none": []}
    got = {x.rule_set: (x.touched, x.bad_touched) for x in P.rates(masks, sets).collect()}
    assert got == {k: (sum(1 for h, _ in rows if h & set(v)), sum(b for h, b in rows if h & set(v))) for k, v in sets.items()}
    steps = P.eliminate(masks, 0.97)
    assert [(s.rule, s.touched, s.bad_touched, s.saved, s.lost) for s in steps] == brute_walk(rows, rules, 0.97)


def test_health_and_overlaps_equal_brute_force(spark):
    rules = ["b", "a", "c", "d", "never"]
    rows = random_rows(300, rules[:4], 9)
    masks = flags(spark, rows, rules)
    for x in P.health(masks).collect():
        own = [(h, b or 0) for h, b in rows if x.rule in h]
        only = [b for h, b in own if h == {x.rule}]
        assert (x.touched, x.bad_touched, x.only_touched, x.only_bad) == (len(own), sum(b for _, b in own), len(only), sum(only))
        assert x.bad_rate == (pytest.approx(sum(b for _, b in own) / len(own)) if own else None)
    for x in P.overlaps(masks).collect():
        own = sum(b or 0 for h, b in rows if x.rule in h)
        both = {o: sum(b or 0 for h, b in rows if x.rule in h and o in h) for o in rules if o != x.rule}
        best = max(both.values())
        assert (x.partner, x.both_bad) == ((min(o for o in both if both[o] == best), best) if own and best else (None, None))


def example():
    """core alone holds half of the bads; twin and copy hit the same ones; wide touches many good ones."""
    rows = [({"core"}, 1)] * 100 + [({"core"}, 0)] * 20
    rows += [({"twin", "copy"}, 1)] * 38 + [({"twin"}, 1)] * 1 + [({"copy"}, 1)] * 1 + [({"twin", "copy"}, 0)] * 10
    rows += [({"wide"}, 1)] * 25 + [({"wide"}, 0)] * 450
    rows += [({"weak"}, 1)] * 2 + [({"weak"}, 0)] * 40
    rows += [({"core", "spare"}, 1)] * 5 + [({"core", "spare"}, 0)] * 5 + [(set(), 0)] * 300 + [(set(), 1)] * 3
    return rows, ["core", "twin", "copy", "wide", "weak", "spare"]


def test_every_action_occurs(spark):
    rows, rules = example()
    masks = flags(spark, rows, rules)
    policy = P.Policy(recall_floor=0.8, merge_overlap=0.9, tighten_touch=0.2, tighten_bad_rate=0.5)
    got = {x.rule: x for x in P.actions(masks, policy).collect()}
    assert {r: x.action for r, x in got.items()} == {"core": "keep", "twin": "merge", "copy": "merge", "wide": "tighten",
                                                      "weak": "demote", "spare": "delete"}
    assert (got["twin"].partner, got["copy"].partner, got["wide"].partner) == ("copy", "twin", "threshold exploration")
    assert got["weak"].touch_change == pytest.approx(-42 / 1000) and got["weak"].recall_change == pytest.approx(-2 / 175)
    assert got["wide"].recall_change == pytest.approx(-25 / 175)
    other = P.actions(masks, P.Policy(0.8, 0.9, 0.2, 0.5, order=("tighten", "demote")))
    assert {x.action for x in other.collect()} == {"tighten", "demote", "keep"}
    with pytest.raises(ValueError):
        P.actions(masks, P.Policy(order=("drop",)))


def test_deletions_add_up(spark):
    """Equal rules don't both go; all deletions together have the effect that the list states."""
    rows = [({"a", "b", "c"}, 1)] * 10 + [({"a", "b"}, 0)] * 7 + [({"c", "d"}, 0)] * 5 + [({"d"}, 0)] * 4 + [(set(), 0)] * 74
    masks = flags(spark, rows, ["a", "b", "c", "d"])
    advice = P.actions(masks, P.Policy(recall_floor=1.0))
    after, base = P.apply_actions(masks, advice).first(), P.baseline(masks).first()
    gone = [x for x in advice.collect() if x.action == "delete"]
    assert after.recall == base.recall == 1.0
    assert after.touch_rate == pytest.approx(base.touch_rate + sum(x.touch_change for x in gone))
    assert len(gone) == 3


def test_knee_is_where_recall_begins_to_fall():
    steps = [P.Step(i, str(i), t, b, 0, 0) for i, (t, b) in enumerate([(100, 50), (80, 50), (60, 50), (40, 49), (30, 40), (20, 30)])]
    assert P.knee(steps).step == 3
    line = [P.Step(i, None, 100 - 10 * i, 50 - 5 * i, 0, 0) for i in range(5)]
    assert P.knee(line).step == 4  # all as far from the chord: the last
    assert P.knee(line[:2]).step == 1 and P.knee(line[:1]).step == 0


def test_tables_without_entities_bads_or_rules(spark):
    none = flags(spark, [], ["a"])
    assert [tuple(x) for x in P.baseline(none).collect()] == [("__all__", 1, 0, 0, None, None)]
    assert [x.action for x in P.actions(none).collect()] == ["keep"]
    good = flags(spark, [({"a"}, 0), ({"a", "b"}, None), (set(), 0)], ["a", "b"])
    assert len(P.eliminate(good)) == 1 and P.baseline(good).first().recall is None
    assert {x.action for x in P.actions(good).collect()} == {"keep"}
    ruleless = flags(spark, [(set(), 1), (set(), 0)], [])
    assert len(P.eliminate(ruleless)) == 1 and P.health(ruleless).collect() == []
