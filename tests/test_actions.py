"""Thresholds, triggers, filters, labels and the registry on small tables."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from risklens.config import Roles
from risklens.functions import labels
from risklens.functions.stats import t_two_sided
from risklens.operators import prep as P, registry as RG, thresholds as TH, triggers as TR


def test_t_tail_golden_values():
    # Two-sided 5 % points of Student's t.
    for dof, t in ((1, 12.706204736), (5, 2.570581836), (30, 2.042272456), (200, 1.971896224)):
        assert t_two_sided([t], [dof])[0] == pytest.approx(0.05, abs=1e-8)


def test_merged_bins_are_monotone_and_large_enough():
    rng = np.random.default_rng(0)
    n = np.full(20, 50)
    rate = np.linspace(0.05, 0.6, 20)
    pdf = pd.DataFrame({"segment_dim": "d", "segment_name": "s", "feature": "f", "bin": range(20), "n": n,
                        "n_bad": rng.binomial(50, rate), "hi": [*np.arange(1.0, 20.0), np.nan]})
    out = TH._merge(pdf)
    r = (out.n_bad / out.n).to_numpy()
    assert 2 <= len(out) <= 8 and (np.diff(r) > 0).all() and (out.n >= 50).all()
    assert out.n.sum() == 1000 and out.n_bad.sum() == pdf.n_bad.sum()


def test_side_metrics_against_hand_counts(spark):
    df = spark.createDataFrame([(30, 70, 20, 180), (0, 10, 0, 20)],
                               "high_bad long, high_good long, low_bad long, low_good long")
    df = df.select(F.expr("high_bad + high_good").alias("high_n"), "high_bad",
                   F.expr("low_bad + low_good").alias("low_n"), "low_bad")
    r = TH.side_metrics(df).collect()
    cells = [(30, 100 * 50 / 300), (70, 100 * 250 / 300), (20, 200 * 50 / 300), (180, 200 * 250 / 300)]
    want = sum((abs(o - e) - min(0.5, abs(o - e))) ** 2 / e for o, e in cells)
    assert r[0].risk_ratio == pytest.approx(3.0) and r[0].chi2 == pytest.approx(want)
    assert r[1].risk_ratio == 999.0 and r[1].chi2 is None


def test_direction_priority(spark):
    pairs = spark.createDataFrame([("d", g, "f") for g in "abcde"],
                                  "segment_dim string, segment_name string, feature string")
    row = "segment_dim string, segment_name string, feature string, {} double"
    lr = spark.createDataFrame([("d", "a", "f", -0.5), ("d", "b", "f", 0.0)], row.format("lr_coef"))
    corr = spark.createDataFrame([("d", "a", "f", 0.5), ("d", "b", "f", 0.3)], row.format("corr"))
    bins = spark.createDataFrame([("d", g, "f", i, 10, b) for g, bs in
                                  (("c", (1, 2, 9)), ("d", (5, 5, 5)), ("e", (3,))) for i, b in enumerate(bs)],
                                 "segment_dim string, segment_name string, feature string, bin int, n long, n_bad long")
    got = {r.segment_name: (r.direction, r.direction_source)
           for r in TH.direction(pairs, lr, corr, bins).collect()}
    assert got == {"a": ("negative", "lr"), "b": ("positive", "corr"), "c": ("positive", "bin_jump"),
                   "d": (None, None), "e": (None, None)}


def test_trigger_scope_thresholds_and_score(spark):
    rng = np.random.default_rng(1)
    n = 400
    size = np.where(np.arange(n) % 2 == 0, "L", "S")
    bad = (rng.random(n) < 0.3).astype(int)
    v = np.where((size == "L") & (bad == 1), 10.0, 1.0)
    v[:5] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"id": range(n), "size": size, "bad": bad, "v": v}))
    trig = [TR.Trigger("v", "v", "positive", 0.3, "a-1", scope={"dim": "size", "value": "L"}),
            TR.Trigger("w", "v", "negative", 0.1, "a-2"),
            TR.Trigger("gone", "v", "positive", 0.1, "b", scope={"dim": "none", "value": 1})]
    found = TR.thresholds(df, trig, "bad")
    assert found[0]["value"] == 10.0 and found[0]["check"] == "consistent"
    assert found[1]["check"] == "conflict" and found[2]["skip_reason"] == "scope_missing"
    out = TR.score(TR.flags(df, trig, found, key="id", target="bad"), trig, found).toPandas()
    live = out.value_0.notna()
    hit = live & (size == "L") & (out.value_0 >= 10)
    assert (out.hit_0[live] == hit[live].astype(int)).all() and out.hit_0[~live].isna().all()
    # A skipped trigger stays in the weight.
    want = (out.hit_0.fillna(0) * 0.3 + out.hit_1.fillna(0) * 0.1) / 0.5 * 100
    assert np.allclose(out.score, want.round(2), atol=0.0051)


def test_filter_semantics(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 5.0), (None, 9.0), ("c", None)], "g string, x double")
    ids = lambda spec: [r.x for r in P.apply_filter(df, spec).collect()]
    assert ids({"g": {"exclude": ["a"]}}) == [5.0, 9.0, None]
    assert ids({"g": {"include": ["a", "c"]}}) == [1.0, None]
    assert ids({"x": {"range": [0, 6], "max": 4}}) == [1.0]
    assert ids({"x": {"drop_na": True}, "nope": {"min": 3}}) == [1.0, 5.0, 9.0]
    with pytest.raises(ValueError):
        P.apply_filter(df, {"x": {"range": [1]}})


def test_label_checks(spark):
    wide = spark.createDataFrame([(f"0{i}",) for i in range(6)], "id string")
    for bad, status in (([], "error_empty_list"), (["zz"], "error_no_match"),
                        ([f"0{i}" for i in range(6)], "error_all_bad"),
                        (["00", "77", "88", "99"], "note_subset"), (["00", "01"], "ok")):
        lst = spark.createDataFrame([(b,) for b in bad], "id string")
        out = P.label_check(P.label_from_list(wide, lst, "id"), lst, "id")
        assert out.first().status == status
    with pytest.raises(ValueError):
        P.require_ok(out.withColumn("status", F.lit("error_all_bad")))


def test_target_checks(spark):
    for vals, status in ((["0", "1"], "ok"), (["0.0", "1.0"], "ok"), ([None, "1"], "error_missing"),
                         (["yes", "no"], "error_coding"), (["1", "2"], "error_coding"),
                         (["1", "1"], "error_single_class")):
        df = spark.createDataFrame([(v,) for v in vals], "t string")
        assert P.target_check(df, "t").first().status == status


def test_scd2_replay(spark):
    schema = ("ind_code string, ind_version int, ind_name string, domain string, current_iv double, "
              "lifecycle_status string, eff_dt string, exp_dt string, batch_id string")
    empty = spark.createDataFrame([], schema)
    prop = "ind_code string, ind_name string, domain string, current_iv double, lifecycle_status string"
    one = spark.createDataFrame([("A", "a", "FIN", 0.1, "ACTIVE"), ("B", "b", "FIN", 0.2, "ACTIVE")], prop)
    two = spark.createDataFrame([("A", "a", "FIN", 0.9, "ACTIVE"), ("B", "b2", "FIN", 0.2, "ACTIVE")], prop)
    r1 = RG.scd2_merge(empty, one, "b1", "2024-01-01").drop("action")
    r2 = RG.scd2_merge(r1, two, "b2", "2024-02-01")
    got = {(r.ind_code, r.ind_version): (r.ind_name, r.current_iv, r.exp_dt, r.action) for r in r2.collect()}
    assert got == {("A", 1): ("a", 0.9, RG.OPEN, "soft_update"), ("B", 1): ("b", 0.2, "2024-02-01", "closed"),
                   ("B", 2): ("b2", 0.2, RG.OPEN, "new_version")}
    gone = RG.deprecate(r2.drop("action"), ["B"], "2024-03-01")
    assert RG.active(gone).count() == 1 and RG.find(gone, "B", 2).first().lifecycle_status == "DEPRECATED"
    again = RG.scd2_merge(gone, two, "b3", "2024-04-01").where("ind_code = 'B' AND exp_dt = '9999-12-31'").first()
    assert again.ind_version == 3


def test_scd2_repeated_codes_take_effect_in_order(spark):
    schema = ("ind_code string, ind_version int, ind_name string, domain string, current_iv double, "
              "lifecycle_status string, eff_dt string, exp_dt string, batch_id string")
    start = spark.createDataFrame([("A", 3, "a", "FIN", 0.1, "ACTIVE", "2023-01-01", RG.OPEN, "b0")], schema)
    rows = [("A", "a", 0.2, 1), ("A", "a2", 0.3, 2), ("A", "a2", 0.4, 3), ("N", "n", 0.5, 1), ("N", "n", 0.6, 2), ("N", "n3", 0.7, 3)]
    batch = spark.createDataFrame([(c, n, "FIN", iv, "ACTIVE", "2020-05-05", o) for c, n, iv, o in rows],
                                  "ind_code string, ind_name string, domain string, current_iv double, lifecycle_status string, eff_dt string, o int")
    got = {(r.ind_code, r.ind_version): (r.ind_name, r.current_iv, r.eff_dt, r.exp_dt, r.action)
           for r in RG.scd2_merge(start, batch, "b1", "2024-01-01", order="o").collect()}
    assert got == {("A", 3): ("a", 0.2, "2023-01-01", "2024-01-01", "closed"),
                   ("A", 4): ("a2", 0.4, "2024-01-01", RG.OPEN, "new_version"),
                   ("N", 1): ("n", 0.6, "2020-05-05", "2024-01-01", "inserted"),
                   ("N", 2): ("n3", 0.7, "2024-01-01", RG.OPEN, "new_version")}
    checked = batch.withColumn("verification_status", F.lit("SUCCESS"))
    counts = {r.action: r.n for r in RG.register(start, checked, "b1", "2024-01-01", order="o")[1].collect()}
    assert counts == {"soft_update": 3, "new_version": 2, "inserted": 1}
    with pytest.raises(Exception, match="without an order"):
        RG.scd2_merge(start, batch, "b1", "2024-01-01").collect()


def test_calc_scan_finds_references(spark):
    calc = ("-- now() is only a note\nselect sum(t.amt) / nullif(count(distinct cust), 0) from dw.loans t join dw.cust c on t.id = c.id\n"
            "where t.kind = 'from x now()' # today()\nand part_ymd = 20240101")
    s = RG.calc_scan(F.col("c"))
    r = spark.createDataFrame([(calc,), ("sum(x",), ("now() + today_x",), (None,)], "c string").select(*[v.alias(k) for k, v in s.items()]).collect()
    assert r[0].functions == ["count", "nullif", "sum"] and r[0].forbidden == [] and r[0].passed and not r[0].odd
    assert r[0].tables == ["dw.cust", "dw.loans"] and r[0].has_partition
    assert r[0].columns == ["c", "c.id", "cust", "part_ymd", "t", "t.amt", "t.id", "t.kind"]
    assert r[1].odd and r[2].forbidden == ["now"] and r[2].columns == ["today_x"] and not r[3].passed


def test_one_word_names_match_without_pairs(spark):
    known = spark.createDataFrame([(f"e{i:02d}", f"fresh w{i}") for i in range(50)] + [("e99", "fresh")], "ind_code string, ind_name string")
    new = spark.createDataFrame([("c1", "fresh"), ("c2", "old fresh thing"), ("c3", "other"), ("c4", "w7 fresh")], "ind_code string, ind_name string")
    got = {r.ind_code: (r.matched_code, r.score, r.verdict) for r in RG.check_duplicates(new, known).collect()}
    assert got == {"c1": ("e00", 100.0, "duplicate"), "c2": ("e99", 100.0, "duplicate"), "c3": (None, 0.0, "new"),
                   "c4": ("e07", 100.0, "duplicate")}


def test_code_checks(spark):
    rows = [("FIN_M_DEBT_RATIO_SNAP_RATIO", ""), ("fin_m_x", "pattern,domain,granularity"),
            ("FIN_EVT_X", "pattern"), ("FIN_M_" + "X" * 60, "too_long")]
    df = spark.createDataFrame(rows, "c string, want string")
    for r in df.select("want", F.concat_ws(",", RG.code_errors(F.col("c"))).alias("got")).collect():
        assert r.got == r.want
    p = df.limit(1).select(*[c.alias(n) for n, c in RG.parse_code(F.col("c")).items()]).first()
    assert (p.business_key, p.window, p.stat) == ("DEBT_RATIO", "SNAP", "RATIO")


def test_similarity_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    words = ["debt", "ratio", "loan", "cash", "flow", "asset", "net", "率", "比"]
    names = [" ".join(rng.choice(words, rng.integers(1, 6))) for _ in range(120)]
    a = spark.createDataFrame([(f"a{i}", n) for i, n in enumerate(names[:60])], "ind_code string, ind_name string")
    b = spark.createDataFrame([(f"b{i}", n) for i, n in enumerate(names[60:])], "ind_code string, ind_name string")
    left, right = RG.similar_names(a, b)
    got = {(r.a_code, r.b_code): r.score for r in left.join(right, "b").collect()}
    want = {}
    for i, x in enumerate(names[:60]):
        for j, y in enumerate(names[60:]):
            s, t = set(x.split()), set(y.split())
            score = 100 * len(s & t) / min(len(s), len(t))
            if score >= 72.25:
                want[f"a{i}", f"b{j}"] = score
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def test_ratings(spark):
    rows = [(0.25, 0.1, True, "core"), (0.25, 0.1, False, "important"), (0.05, 0.06, True, "important"),
            (0.05, 0.01, True, "auxiliary"), (0.01, -0.06, False, "auxiliary"), (0.01, None, False, "invalid")]
    df = spark.createDataFrame(rows, "iv double, c double, s boolean, want string")
    for r in df.select("want", labels.rate_feature(F.col("iv"), F.col("c"), F.col("s")).alias("got")).collect():
        assert r.got == r.want


@pytest.mark.parametrize("seed", range(6))
def test_merged_bins_equal_the_best_of_all_groupings(seed):
    """Twelve pre-bins: all 2,048 groupings are tried."""
    import itertools
    import math
    r = np.random.default_rng(seed)
    m = 12
    n = r.integers(10, 60, m)
    rate = np.sort(r.uniform(0.02, 0.6, m)) if seed % 2 else r.uniform(0.02, 0.6, m)
    bad = r.binomial(n, rate if seed % 3 else rate[::-1])
    pdf = pd.DataFrame({"segment_dim": "d", "segment_name": "s", "feature": "f", "bin": range(m), "n": n, "n_bad": bad,
                        "hi": [*range(1, m), np.nan]})
    got = TH._merge(pdf.sample(frac=1, random_state=seed))
    tg, tb = n.sum() - bad.sum(), bad.sum()

    def iv(groups):
        total = 0.0
        for g in groups:
            b, a = max(bad[g].sum(), 0.5), max((n[g] - bad[g]).sum(), 0.5)
            total += (a / tg - b / tb) * math.log((a / tg) / (b / tb))
        return total

    best = 0.0
    for k in range(1, TH._MAX_BINS):
        for cuts in itertools.combinations(range(1, m), k):
            groups = [slice(a, b) for a, b in zip((0, *cuts), (*cuts, m))]
            rates = [bad[g].sum() / n[g].sum() for g in groups]
            steps = np.diff(rates)
            if all(n[g].sum() >= TH._MIN_SHARE * n.sum() for g in groups) and ((steps > 0).all() or (steps < 0).all()):
                best = max(best, iv(groups))
    ends = np.cumsum(got.n.to_numpy())
    at = [0, *[int(np.searchsorted(np.cumsum(n), e)) + 1 for e in ends]]
    assert iv([slice(a, b) for a, b in zip(at, at[1:])]) == pytest.approx(best, abs=1e-9)
    assert got.n_bad.sum() == bad.sum() and len(got) <= TH._MAX_BINS
