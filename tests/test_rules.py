"""Trees against a brute-force search; rule bookkeeping and invariants."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from risklens.config import Roles
from risklens.operators import rules as RU


def data(n=1500, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x[:, 1] = np.round(x[:, 1], 1)
    p = 1 / (1 + np.exp(-(1.2 * x[:, 0] - 0.8 * x[:, 1] - 1.0)))
    return pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2],
                         "y": (rng.random(n) < p).astype(int)})


def best_split(x, y, w, min_leaf):
    """(quality, feature, threshold) by trying every midpoint."""
    best = None
    for f in sorted(x):
        v = x[f]
        vals = np.unique(v)
        for lo, hi in zip(vals, vals[1:]):
            left = v <= lo
            if left.sum() < min_leaf or (~left).sum() < min_leaf:
                continue
            q = 0.0
            for m in (left, ~left):
                g, b = w[0] * (y[m] == 0).sum(), w[1] * (y[m] == 1).sum()
                q += (g * g + b * b) / (g + b)
            cand = (-round(q, 12), f, (lo + hi) / 2)
            if best is None or cand < best:
                best = cand
    return best


def brute_tree(x, y, depth, min_leaf, w, node=1, out=None):
    out = {} if out is None else out
    if depth == 0 or y.min() == y.max():
        return out
    s = best_split(x, y, w, min_leaf)
    if s:
        out[node] = (s[1], s[2])
        left = x[s[1]] <= s[2]
        for child, m in ((2 * node, left), (2 * node + 1, ~left)):
            brute_tree({k: v[m] for k, v in x.items()}, y[m], depth - 1, min_leaf, w, child, out)
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_tree_equals_brute_force(spark, seed):
    pdf = data(seed=seed)
    roles = Roles("id", "y", ("a", "b", "c"))
    df = spark.createDataFrame(pdf)
    segs = RU.split_segments(df, roles, holdout=0.0)
    rows = RU.split_rows(df, roles, segs, holdout=0.0)
    key = ("__all__", "__all__")
    n, bad = len(pdf), int(pdf.y.sum())
    trees = RU.grow(rows, ["a", "b", "c"], {key: [0.0] * 3}, {key: (n, bad)})
    got = {k: (["a", "b", "c"][f], t) for k, (f, t) in trees.splits[key].items()}
    want = brute_tree({c: pdf[c].to_numpy() for c in "abc"}, pdf.y.to_numpy(), 3,
                      max(10, int(n * 0.05)), (1 / (n - bad), 1 / bad))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    for k in want:
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-12)


def test_mined_rules_hold_their_gates(spark):
    pdf = data(4000, 7)
    pdf["seg"] = np.where(pdf.id % 2 == 0, "p", "q")
    roles = Roles("id", "y", ("a", "b", "c"), ("seg",))
    out = RU.mine(spark.createDataFrame(pdf), roles, dims=("seg",)).toPandas()
    assert len(out) and set(out.segment_dim) == {"__all__", "seg"}
    assert (out.coverage_pct >= 0.01).all() and (out.lift >= 1.5).all() and (out.bad_n >= 5).all()
    assert np.allclose(out.lift, out.bad_rate / out.overall_bad_rate)
    assert (out.bad_rate_ci_low <= out.bad_rate).all() and (out.eval_scope == "holdout").all()
    assert (out.stab_valid_n <= out.stab_n).all()
    assert set(out.stability) <= {"stable", "fair", "unstable"}


def test_few_bads_fall_back_to_in_sample(spark):
    pdf = data(400, 2)
    pdf["y"] = ((pdf.a > 1.3) & (pdf.id % 3 > 0)).astype(int)
    assert 20 <= pdf.y.sum() < 34
    out = RU.split_segments(spark.createDataFrame(pdf), Roles("id", "y", ("a",))).first()
    assert out.eval_scope == "in_sample"


def test_simplify_and_dedupe(spark):
    rows = [(1, [("x", "<=", 0.8), ("x", "<=", 0.6), ("x", ">", 0.3), ("x", ">", 0.5)]),
            (2, [("x", ">", 0.50001), ("x", "<=", 0.6)])]
    df = spark.createDataFrame(rows, f"k int, conditions array<{RU.CONDITION}>")
    out = RU.dedupe(RU.simplify(df, ["k"]), [], "k").collect()
    assert len(out) == 1 and [tuple(c) for c in out[0].conditions] == [("x", "<=", 0.6), ("x", ">", 0.5)]


def test_mask_uses_fill_values(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 1), (3.0, 0)], "x double, y int")
    with_fill = df.where(RU.condition_mask([("x", ">", 2.0)], {"x": 2.5})).count()
    without = df.where(RU.condition_mask([("x", ">", 2.0)])).count()
    assert (with_fill, without) == (2, 1)
