"""Logistic regression against an independent Newton solver, AUC against brute force."""

import numpy as np
import pandas as pd
import pytest

from risklens.config import Roles
from risklens.operators import logistic as L, ranking as R


def table(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 5, 0.2] + [0, 3, -1]
    x[rng.random(n) < 0.1, 1] = np.nan
    eta = 0.9 * x[:, 0] - 0.2 * np.nan_to_num(x[:, 1], nan=3.0) - 0.8
    y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(int)
    return pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "flat": 1.0,
                         "seg": np.where(np.arange(n) % 3 == 0, "p", "q"), "y": y})


def newton(pdf, feats):
    x = pdf[feats].fillna(pdf[feats].median())
    z = ((x - x.mean()) / x.std(ddof=0)).to_numpy()
    z = np.c_[z, np.ones(len(z))]
    w, ridge = np.zeros(z.shape[1]), np.r_[np.ones(len(feats)), 0]
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge),
                               z.T @ (p - pdf.y) + ridge * w)
        w = w - step
    return dict(zip(feats, w))


ROLES = Roles("id", "y", ("a", "b", "c", "flat"), ("seg",))


def test_coefficients_equal_newton(spark):
    pdf = table()
    m = L.fit_segments(spark.createDataFrame(pdf), ROLES)
    got = {(r.segment_dim, r.segment_name, r.feature): r.lr_coef for r in m.coefs.collect()}
    parts = {("__all__", "__all__"): pdf, ("seg", "p"): pdf[pdf.seg == "p"],
             ("seg", "q"): pdf[pdf.seg == "q"]}
    assert len(got) == 9  # the flat feature is dropped
    for key, sub in parts.items():
        for f, w in newton(sub, ["a", "b", "c"]).items():
            assert got[(*key, f)] == pytest.approx(w, abs=1e-7)
    for r in m.auc.collect():
        assert 0.5 < r.auc <= 1.0 and r.auc_type == "cv5"


def test_gates_and_training_auc(spark):
    pdf = table(150)
    m = L.fit_segments(spark.createDataFrame(pdf), ROLES)
    assert {r.auc_type for r in m.auc.collect()} == {"train_small"}
    assert all(r.skip_reason for r in m.ledger.where("n < 50").collect())


def test_auc_equals_pair_count(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 1500), "s": np.round(rng.normal(size=1500), 1),
                        "y": rng.integers(0, 2, 1500)})
    for r in R.auc(spark.createDataFrame(pdf), ["g"], "s", "y").collect():
        sub = pdf[pdf.g == r.g]
        pos, neg = sub[sub.y == 1].s.to_numpy(), sub[sub.y == 0].s.to_numpy()
        want = ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())
        assert r.auc == pytest.approx(want, abs=1e-12)
