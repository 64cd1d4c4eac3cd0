"""L2 logistic regression of all segments at once, and its cross-validated AUC.

One Newton iteration is one pass over the wide rows: every partition adds up gradients and Hessians
of all its (segment, model) pairs in numpy, the partial sums are combined by an aggregation, and
only the small systems (one per model) are solved on the driver. A row travels to Python once,
whatever the number of segments it belongs to, and no segment is ever gathered in one task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from risklens.config import ALL, GATES, TAG_DIM, Roles
from risklens.operators.quantiles import SMALL_N, group_median
from risklens.operators.ranking import auc
from risklens.operators.segments import (KEY, SEG, clean_double, eligible, expand, long_form, segment_sizes,
                                         skip_reason, tag_name)
from risklens.operators.small import attach, derived, is_pinned, local, pin
from risklens.operators.strata import cuts, fold_of, fold_starts, key_hash

FOLDS = 5
MAX_ITER = 50
# Newton steps square the error: a step below this leaves an error far below 1e-9.
TOL = 1e-6
# Models solved together; bounds what one pass returns to the driver.
CHUNK = 400


@dataclass
class SegmentModels:
    coefs: DataFrame   # KEY, lr_coef (standardised)
    ledger: DataFrame  # SEG, n, n_bad, n_good, skip_reason
    score: Callable[[], DataFrame]

    @cached_property
    def auc(self) -> DataFrame:
        """SEG, n, n_bad, bad_rate, auc, auc_type; rows are scored when it is first asked for."""
        return self.score()


def standardiser(df: DataFrame, roles: Roles, segs: DataFrame, **shape) -> DataFrame:
    """Fill value, mean and population std after imputation, per (segment, feature).

    The moments of the imputed column follow from those of the observed values and the number of
    gaps, so the data is not scanned again after the medians are known.
    """
    rows = group_median(long_form(df, roles, segs, small_n=SMALL_N, **shape), KEY,
                        {"_n": F.count("x"), "_m": F.avg("x"), "_v": F.var_pop("x")})
    gaps = (F.col("n_rows") - F.col("_n")).cast("double")
    total = F.col("n_rows").cast("double")
    mean = (F.col("_n") * F.col("_m") + gaps * F.col("median")) / total
    dm, df_ = F.col("_m") - F.col("mean"), F.col("median") - F.col("mean")
    var = (F.col("_n") * (F.col("_v") + dm * dm) + gaps * df_ * df_) / total
    return pin(rows.withColumn("mean", mean)
               .select(*KEY, F.col("median").alias("fill"), "mean", F.sqrt(var).alias("scale")),
               max_rows=200_000)


def fold_cuts(df: DataFrame, roles: Roles, segs: DataFrame, **shape) -> DataFrame:
    """Pinned (SEG, y, n, cuts): where the folds of each class of the given segments begin."""
    slim = df.select(*dict.fromkeys([*roles.dims, *roles.tags]), F.col(roles.target).cast("int").alias("y"),
                     key_hash(F.col(roles.key), "fold").alias("h"))
    rows = attach(expand(slim, Roles(roles.key, "y", (), roles.dims, roles.tags), **shape), segs, SEG)
    return cuts(rows, [*SEG, "y"], "h", fold_starts(FOLDS))


def _with_codes(df: DataFrame, roles: Roles, codes: dict[tuple[str, str], int], begins: DataFrame, full: bool,
                dims: bool, tags: bool) -> tuple[DataFrame, int]:
    """Columns ``s_i`` with the model code of each segment a row belongs to (null: none), ``fold_i`` with its fold there.

    ``begins`` has the cuts of the segments with folds; rows of others are in fold 0.
    """
    spark = df.sparkSession
    starts: dict[tuple[str, str], list] = {}
    for r in begins.collect():
        starts.setdefault((r["segment_dim"], r["segment_name"]), [[], []])[r["y"]] = list(r["cuts"])
    none = [[], []]
    fold = lambda c: fold_of("_h", f"IF(_y = 1, {c}[1], {c}[0])")
    df = df.withColumns({"_h": key_hash(F.col(roles.key), "fold"), "_y": F.col(roles.target).cast("int")})
    by_dim: dict[str, dict[str, int]] = {}
    for (dim, name), code in codes.items():
        by_dim.setdefault(dim, {})[name] = code
    cols: dict[str, Column] = {}
    if full and ALL in by_dim:
        df = df.withColumn("_c", _arrays(starts.get((ALL, ALL), none))).withColumn("fold_0", fold("_c")).drop("_c")
        cols["s_0"] = F.lit(float(by_dim[ALL][ALL]))
    i = len(cols)
    for d in roles.dims if dims else ():
        if d in by_dim:
            table = local(spark, [(n, float(c), starts.get((d, n), none)) for n, c in by_dim[d].items()],
                          f"_g_{i} string, s_{i} double, _c array<array<bigint>>")
            table = F.broadcast(table) if is_pinned(table) else table
            df = df.join(table, F.col(d).cast("string") == F.col(f"_g_{i}"), "left").withColumn(f"fold_{i}", fold("_c")).drop(f"_g_{i}", "_c")
            i += 1
    for t in roles.tags if tags else ():
        code = by_dim.get(TAG_DIM, {}).get(tag_name(t))
        if code is not None:
            held = _arrays(starts.get((TAG_DIM, tag_name(t)), none))
            df = df.withColumn("_c", held).withColumn(f"fold_{i}", fold("_c")).drop("_c")
            cols[f"s_{i}"] = F.when(F.col(t) == 1, F.lit(float(code)))
            i += 1
    return df.withColumns(cols) if cols else df, i


def _arrays(values: list[list[int]]) -> Column:
    return F.array(*[F.array(*[F.lit(x).cast("bigint") for x in v]).cast("array<bigint>") for v in values])


def _sums(n_codes: int, n_feats: int, params: dict, state: dict):
    """Partition function: partial log-loss gradients and Hessians per (code, model)."""
    codes = [f"s_{i}" for i in range(n_codes)]
    feats = [f"f_{i}" for i in range(n_feats)]
    upper = np.triu_indices(n_feats + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[tuple[int, int], np.ndarray] = {}
        for pdf in batches:
            x_all = pdf[feats].to_numpy(dtype=float)
            y_all = pdf["y"].to_numpy(dtype=float)
            for i, c in enumerate(codes):
                member, fold_all = pdf[c].to_numpy(dtype=float), pdf[f"fold_{i}"].to_numpy()
                for code in np.unique(member[~np.isnan(member)]).astype(int):
                    if code not in params:
                        continue
                    rows = member == code
                    fill, mean, scale = params[code]
                    x = x_all[rows]
                    x = np.where(np.isnan(x), fill, x)
                    live = scale > 0
                    zmat = np.zeros((x.shape[0], n_feats + 1))
                    zmat[:, :-1][:, live] = (x[:, live] - mean[live]) / scale[live]
                    zmat[:, -1] = 1.0
                    y, fold = y_all[rows], fold_all[rows]
                    # All models of the segment at once: a column each, rows of a model's own fold weigh nothing.
                    ids = list(state[code])
                    use = np.stack([fold != m if m >= 0 else np.ones(len(y), bool) for m in ids], axis=1).astype(float)
                    eta = zmat @ np.stack([state[code][m] for m in ids], axis=1)
                    tail = np.exp(-np.abs(eta))
                    p = np.where(eta >= 0, 1.0, tail) / (1.0 + tail)
                    grad = zmat.T @ ((p - y[:, None]) * use)
                    hess = (zmat[:, upper[0]] * zmat[:, upper[1]]).T @ (p * (1 - p) * use)
                    loss = ((np.maximum(eta, 0) + np.log1p(tail) - y[:, None] * eta) * use).sum(axis=0)
                    parts = np.vstack([grad, hess, loss, y @ use, use.sum(axis=0)])
                    for j, model in enumerate(ids):
                        key = (code, model)
                        acc[key] = acc[key] + parts[:, j] if key in acc else parts[:, j]
        if acc:
            size = len(next(iter(acc.values())))
            yield pd.DataFrame({
                "code": np.repeat([k[0] for k in acc], size),
                "model": np.repeat([k[1] for k in acc], size),
                "pos": np.tile(np.arange(size), len(acc)),
                "value": np.concatenate(list(acc.values()))})

    return run


_SUM_SCHEMA = StructType([StructField("code", IntegerType()), StructField("model", IntegerType()),
                          StructField("pos", IntegerType()), StructField("value", DoubleType())])


def _newton(rows: DataFrame, n_codes: int, n_feats: int, params: dict, models: dict) -> tuple[dict, dict]:
    """Solve every model: {(code, model): weights}, None where there are none, and why not.

    Reasons: ``class`` (one class only), ``failed`` (singular or not finite), and ``not_converged`` with
    the weights of the last step.
    """
    dim = n_feats + 1
    upper = np.triu_indices(dim)
    ridge = np.r_[np.ones(n_feats), 0.0]
    weights = {(c, m): np.zeros(dim) for c, ms in models.items() for m in ms}
    best: dict = {}
    open_ = set(weights)
    done: dict = {}
    why: dict = {}
    for _ in range(MAX_ITER):
        state: dict[int, dict[int, np.ndarray]] = {}
        for c, m in open_:
            state.setdefault(c, {})[m] = weights[c, m]
        got = (rows.mapInPandas(_sums(n_codes, n_feats, {c: params[c] for c in state}, state),
                                _SUM_SCHEMA)
               .groupBy("code", "model", "pos").agg(F.sum("value").alias("value")).toPandas())
        for (c, m), part in got.groupby(["code", "model"]):
            v = part.sort_values("pos")["value"].to_numpy()
            if v[-2] == 0 or v[-2] == v[-1]:  # one class only
                done[c, m], why[c, m] = None, "class"
                open_.discard((c, m))
                continue
            w = weights[c, m]
            loss = v[-3] + 0.5 * (ridge * w) @ w
            if (c, m) in best and loss > best[c, m][0] + 1e-9 * abs(best[c, m][0]):
                weights[c, m] = 0.5 * (w + best[c, m][1])  # overshoot: halve the step
                continue
            grad = v[:dim] + ridge * w
            hess = np.zeros((dim, dim))
            hess[upper] = v[dim:dim + len(upper[0])]
            hess = hess + np.triu(hess, 1).T + np.diag(ridge)
            try:
                step = np.linalg.solve(hess, grad)
            except np.linalg.LinAlgError:
                step = np.full(dim, np.nan)
            if not np.isfinite(step).all():
                done[c, m], why[c, m] = None, "failed"
                open_.discard((c, m))
                continue
            best[c, m] = (loss, w)
            weights[c, m] = w - step
            if np.abs(step).max() < TOL:
                done[c, m] = weights[c, m]
                open_.discard((c, m))
        if not open_:
            break
    done.update({k: weights[k] for k in open_})
    why.update({k: "not_converged" for k in open_})
    return done, why


def fit_segments(df: DataFrame, roles: Roles, *, full: bool = True, dims: bool = True,
                 tags: bool = True, min_n: int = GATES.min_n, min_bad: int = GATES.min_bad_lr,
                 min_good: int = GATES.min_good_lr, cross_validate: bool = True,
                 policy: str = "median") -> SegmentModels:
    """Standardised coefficients and AUC of every segment that passes the gates."""
    spark = df.sparkSession
    shape = dict(full=full, dims=dims, tags=tags)
    feats = list(roles.features)
    df = df.where(F.col(roles.target).isNotNull())
    if policy == "complete":
        df = df.dropna(subset=feats)
    elif policy == "zero":
        df = df.fillna(0, subset=feats)
    sizes = segment_sizes(df, roles, **shape)
    reason = skip_reason(min_n, min_bad, min_good, n_gate_on_tags=False)
    ledger = sizes.withColumn("skip_reason", reason)
    segs = eligible(df, roles, min_n, min_bad, min_good, full_gated=True, n_gate_on_tags=False,
                    **shape)
    spec = standardiser(df, roles, segs, **shape)

    seg_rows = sorted(segs.collect(), key=lambda r: (r["segment_dim"], r["segment_name"]))
    spec_by: dict = {}
    for r in spec.toPandas().itertuples():
        spec_by.setdefault((r.segment_dim, r.segment_name), {})[r.feature] = (r.fill, r.mean, r.scale)
    params, models, names, thin = {}, {}, {}, []
    for code, r in enumerate(seg_rows):
        key = (r["segment_dim"], r["segment_name"])
        cells = [spec_by.get(key, {}).get(f, (np.nan,) * 3) for f in feats]
        fill, mean, scale = (np.array([c[i] for c in cells], dtype=float) for i in range(3))
        scale = np.where(np.isfinite(scale), scale, 0.0)
        if (scale > 0).sum() < 2:
            thin.append(key)
            continue
        params[code] = (np.where(np.isfinite(fill), fill, 0.0), mean, scale)
        cv = cross_validate and r["n"] >= GATES.min_n_cv and r["n_bad"] >= GATES.min_bad_cv
        models[code] = [-1, *range(FOLDS)] if cv else [-1]
        names[code] = (*key, r["n"], r["n_bad"])
    if thin:
        few = local(spark, [(*k, "features") for k in thin],
                    "segment_dim string, segment_name string, _few string")
        ledger = (attach(ledger, few, SEG, "left")
                  .withColumn("skip_reason", F.coalesce("skip_reason", "_few")).drop("_few"))

    folded = local(spark, [names[c][:2] for c in names if len(models[c]) > 1], "segment_dim string, segment_name string")
    begins = fold_cuts(df, roles, folded, **shape)
    coded, n_codes = _with_codes(df, roles, {names[c][:2]: c for c in names}, begins, full, dims, tags)
    rows = coded.select(F.col(roles.target).cast("int").alias("y"),
                     *[f"{c}_{i}" for i in range(n_codes) for c in ("s", "fold")],
                     *[clean_double(F.col(f)).alias(f"f_{i}") for i, f in enumerate(feats)]).persist()
    solved: dict = {}
    why: dict = {}
    todo = list(models)
    for i in range(0, len(todo), CHUNK):
        part = todo[i:i + CHUNK]
        found, reasons = _newton(rows, n_codes, len(feats), params, {c: models[c] for c in part})
        solved.update(found)
        why.update(reasons)
    rows.unpersist()
    # A segment whose own model has no weights is skipped with a reason; the others go on.
    lost = {c: why[c, -1] for c in names if solved.get((c, -1)) is None}
    marks = [(*names[c][:2], f"fit_{r}") for c, r in lost.items()] + [
        (*names[c][:2], None) for c in names if c not in lost and why.get((c, -1)) == "not_converged"]
    if marks:
        table = local(spark, [(*m, m[2] is None) for m in marks],
                      "segment_dim string, segment_name string, _lost string, _open boolean")
        ledger = (attach(ledger, table, SEG, "left").withColumn("skip_reason", F.coalesce("skip_reason", "_lost"))
                  .withColumn("converged", ~F.coalesce("_open", F.lit(False))).drop("_lost", "_open"))
    else:
        ledger = ledger.withColumn("converged", F.lit(True))
    names = {c: v for c, v in names.items() if c not in lost}

    coef_rows, lines = [], []
    for c, (dim, name, n, n_bad) in names.items():
        fill, mean, scale = params[c]
        cv_ok = len(models[c]) > 1 and all(solved[c, m] is not None for m in range(FOLDS))
        kind = "train_small" if len(models[c]) == 1 else "cv5" if cv_ok else "train_cv_failed"
        live = scale > 0
        w = solved[c, -1]
        coef_rows += [(dim, name, f, float(w[i])) for i, f in enumerate(feats) if live[i]]
        for m in (range(FOLDS) if cv_ok else [-1]):
            w = solved[c, m]
            slope = np.where(live, w[:-1] / np.where(live, scale, 1.0), 0.0)
            base = float(w[-1] - (slope[live] * mean[live]).sum())
            lines.append((dim, name, int(m), kind, int(n), int(n_bad), base,
                          [float(s) for s in slope], [float(v) for v in fill]))
    coefs = local(
        spark, coef_rows, "segment_dim string, segment_name string, feature string, lr_coef double")
    table = local(
        spark, lines, "segment_dim string, segment_name string, model int, auc_type string, n bigint, "
               "n_bad bigint, base double, slope array<double>, fill array<double>")
    return SegmentModels(coefs, ledger, lambda: _segment_auc(df, roles, table, begins, shape))


def _segment_auc(df: DataFrame, roles: Roles, lines: DataFrame, begins: DataFrame, shape: dict) -> DataFrame:
    """Mean fold AUC where cross-validated, training AUC elsewhere."""
    feats = [f"f_{i}" for i in range(len(roles.features))]
    slim = df.select(*dict.fromkeys([*roles.dims, *roles.tags]),
                     F.col(roles.target).cast("int").alias("y"),
                     key_hash(F.col(roles.key), "fold").alias("h"),
                     *[clean_double(F.col(f)).alias(n) for f, n in zip(roles.features, feats)])
    rows = expand(slim, Roles(roles.key, "y", (), roles.dims, roles.tags), **shape)
    rows = attach(rows, derived(begins, begins.select(*SEG, "y", "cuts")), [*SEG, "y"], "left").withColumn(
        "fold", F.coalesce(fold_of("h", "cuts"), F.lit(0)))
    table = lines
    hit = attach(rows, table, SEG).where((F.col("model") == -1) | (F.col("model") == F.col("fold")))
    score = "base" + "".join(f" + slope[{i}] * coalesce({f}, fill[{i}])" for i, f in enumerate(feats))
    scores = hit.select(*SEG, "model", "y", F.expr(score).alias("score"))
    per = auc(scores, [*SEG, "model"], "score", "y").groupBy(*SEG).agg(F.avg("auc").alias("auc"))
    info = table.select(*SEG, "n", "n_bad", "auc_type").distinct()
    return (info.join(per, SEG, "left").withColumn("bad_rate", F.col("n_bad") / F.col("n"))
            .select(*SEG, "n", "n_bad", "bad_rate", "auc", "auc_type"))


def compare_feature_sets(df: DataFrame, roles: Roles, raw: list[str], derived: list[str],
                         **shape) -> DataFrame:
    """AUC of the raw and of the derived features per segment, and which set wins."""
    side = {}
    for label, fs in (("raw", raw), ("derived", derived)):
        m = fit_segments(df, roles.only(*fs), min_n=0, **shape)
        side[label] = m.auc.select(*SEG, F.col("auc").alias(f"auc_{label}"))
        sizes = m.ledger.where("skip_reason IS NULL OR skip_reason = 'features'").select(
            *SEG, "n", "n_bad")
    diff = F.col("auc_derived") - F.col("auc_raw")
    return (sizes.join(side["raw"], SEG, "left").join(side["derived"], SEG, "left")
            .withColumn("bad_rate", F.col("n_bad") / F.col("n"))
            .withColumn("auc_diff", diff)
            .withColumn("winner", F.when(diff > 0, "derived").when(diff < 0, "raw")
                        .when(diff == 0, "tie")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
