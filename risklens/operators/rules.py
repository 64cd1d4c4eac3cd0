"""Readable risk rules: shallow trees per segment, hold-out evaluation, stability, suggestions.

The trees of all segments grow level by level. Each level finds the exact best split of every node
in two aggregations: a coarse histogram over 32 value buckets gives exact split qualities at the
bucket borders and an upper bound inside each bucket (the weighted Gini gain is convex in the
left-side class counts, so its maximum over a bucket lies at a corner); only buckets whose bound
beats the best border are then resolved to single values.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from risklens.config import GATES, RULES, Roles
from risklens.functions.labels import stability_grade, suggested_use, wilson
from risklens.operators.quantiles import SMALL_N, group_median, running_total
from risklens.operators.ranking import bucketed, grid_edges
from risklens.operators.segments import SEG, clean_double, expand, segment_sizes
from risklens.operators.small import attach, derived, is_pinned, local, pin
from risklens.operators.strata import cuts, key_hash, share_start

NULL_GROUP = "(missing)"
CONDITION = "struct<feature:string,op:string,threshold:double>"


# ---- training and evaluation rows ------------------------------------------------------------

def split_segments(df: DataFrame, roles: Roles, *, full: bool = True, dims: tuple[str, ...] = (),
                   holdout: float = RULES.holdout_ratio) -> DataFrame:
    """Pinned eligible segments with their evaluation scope ('holdout' or 'in_sample')."""
    r = Roles(roles.key, roles.target, (), tuple(dims))
    sizes = segment_sizes(df, r, full=full, tags=False, null_group=NULL_GROUP)
    enough = ((F.lit(0 < holdout < 1)) & (F.col("n_bad") * holdout >= RULES.holdout_min_bad)
              & (F.col("n_bad") * (1 - holdout) >= GATES.min_bad_lr))
    keep = (F.col("segment_dim") == "__all__") | (F.col("n") >= GATES.min_n)
    return pin(sizes.where(keep).withColumn(
        "eval_scope", F.when(enough, "holdout").otherwise("in_sample")))


def held_out(rows: DataFrame, share: float) -> DataFrame:
    """``rows`` (SEG, y, eval_scope, h) with ``out``: the first ``share`` of each segment's class by hash.

    Classes keep their proportions, to the row; a row's side is the same on every run. Nothing is held out in
    segments evaluated in sample.
    """
    split = rows.where("eval_scope = 'holdout'")
    ends = cuts(split, [*SEG, "y"], "h", share_start(share))
    rows = attach(rows, derived(ends, ends.select(*SEG, "y", F.col("cuts")[0].alias("_end"))), [*SEG, "y"], "left")
    return rows.withColumn("out", F.coalesce((F.col("eval_scope") == "holdout") & (F.col("h") < F.col("_end")), F.lit(False))).drop("_end")


def split_rows(df: DataFrame, roles: Roles, segs: DataFrame, *, full: bool = True,
               dims: tuple[str, ...] = (), holdout: float = RULES.holdout_ratio) -> DataFrame:
    """(SEG, y, train, test, x[]) of every row of the given segments; in-sample segments use every row on both sides."""
    x = F.array(*[clean_double(F.col(f)) for f in roles.features])
    slim = df.where(F.col(roles.target).isNotNull()).select(
        *dict.fromkeys(dims), F.col(roles.target).cast("int").alias("y"),
        key_hash(F.col(roles.key), "holdout").alias("h"), x.alias("x"))
    r = Roles(roles.key, "y", (), tuple(dims))
    rows = attach(expand(slim, r, full=full, tags=False, null_group=NULL_GROUP),
                  derived(segs, segs.select(*SEG, "eval_scope")), SEG)
    rows, whole = held_out(rows, holdout), F.col("eval_scope") == "in_sample"
    return rows.select(*SEG, "y", (whole | ~F.col("out")).alias("train"),
                       (whole | F.col("out")).alias("test"), "x")


def _exploded(rows: DataFrame, features: list[str]) -> DataFrame:
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.get("x", F.lit(i)).alias("v"))
        for i, f in enumerate(features)]))
    rest = [c for c in rows.columns if c != "x"]
    return rows.select(*rest, pairs.alias("p")).select(*rest, "p.feature", F.col("p.v").alias("x"))


# ---- trees -----------------------------------------------------------------------------------

@dataclass
class Trees:
    """Splits per (segment, node): node 1 is the root, 2i and 2i+1 are its children."""

    splits: dict[tuple[str, str], dict[int, tuple[int, float]]]
    fills: dict[tuple[str, str], list[float | None]]
    train: dict[tuple[str, str], tuple[int, int]]  # n, n_bad

    def table(self, spark) -> DataFrame:
        size = 2 ** RULES.max_depth
        rows = []
        for key, nodes in self.splits.items():
            feat = [int(nodes[i][0]) if i in nodes else None for i in range(size)]
            thr = [float(nodes[i][1]) if i in nodes else None for i in range(size)]
            n, bad = self.train[key]
            rows.append((*key, feat, thr, self.fills[key], n, bad))
        return local(spark, rows, "segment_dim string, segment_name string, feat array<int>, "
                                  "thr array<double>, fill array<double>, train_n bigint, train_bad bigint")


def _imputed(n: int) -> str:
    return "array(" + ", ".join(f"coalesce(x[{i}], fill[{i}])" for i in range(n)) + ")"


def _descend(levels: int) -> str:
    """SQL of the node a row reaches after ``levels`` levels of splits."""
    node = "1"
    for _ in range(levels):
        node = (f"transform(array({node}), k -> IF(k >= size(feat) OR feat[k] IS NULL, k, "
                f"IF(x[feat[k]] <= thr[k], 2 * k, 2 * k + 1)))[0]")
    return node


def _gain(gl: str, bl: str, g: str, b: str, tg: str, tb: str) -> Column:
    """Weighted Gini quality of a split (larger is better); classes weigh the same in total."""
    w0, w1 = f"(1D / {tg})", f"(1D / {tb})"

    def side(gs: str, bs: str) -> str:
        p, q = f"({gs}) * {w0}", f"({bs}) * {w1}"
        return f"IF({gs} + {bs} = 0, 0D, ({p} * {p} + {q} * {q}) / ({p} + {q}))"

    return F.expr(f"{side(gl, bl)} + {side(f'({g} - {gl})', f'({b} - {bl})')}")


NODE = [*SEG, "node"]
CELL = [*NODE, "feature"]


def grow(rows: DataFrame, features: list[str], fills: dict, train: dict,
         max_depth: int = RULES.max_depth, min_leaf: dict | None = None) -> Trees:
    """Exact depth-limited Gini trees with balanced class weights, all segments together."""
    spark = rows.sparkSession
    trees = Trees({k: {} for k in train}, fills, train)
    min_leaf = min_leaf or {k: max(RULES.min_leaf_floor, int(n * RULES.min_leaf_ratio))
                            for k, (n, _) in train.items()}
    leaf_table = local(spark, [(*k, int(v)) for k, v in min_leaf.items()],
                       "segment_dim string, segment_name string, min_leaf bigint")
    grid = grid_edges(_exploded(rows.where("train"), features).where(F.col("x").isNotNull()),
                      [*SEG, "feature"], "x")
    for depth in range(max_depth):
        best = _level(rows, features, trees, leaf_table, grid, depth)
        for r in best:
            key = (r["segment_dim"], r["segment_name"])
            trees.splits[key][r["node"]] = (features.index(r["feature"]), r["threshold"])
        if not best:
            break
    return trees


def _level(rows: DataFrame, features: list[str], trees: Trees, leaf_table: DataFrame,
           grid: DataFrame, depth: int) -> list:
    spark = rows.sparkSession
    table = trees.table(spark)
    at = attach(attach(rows.where("train"), table, SEG), leaf_table, SEG)
    at = at.select(*SEG, "y", F.expr(_imputed(len(features))).alias("x"), "feat", "thr",
                   "train_n", "train_bad", "min_leaf")
    at = at.withColumn("node", F.expr(_descend(depth)).cast("int"))
    at = at.where(F.col("node") >= 2 ** depth).select(
        *NODE, "y", "x", (F.col("train_n") - F.col("train_bad")).alias("tg"),
        F.col("train_bad").alias("tb"), "min_leaf")
    long = _exploded(at, features).where(F.col("x").isNotNull())
    long = bucketed(attach(long, grid, [*SEG, "feature"]), "x", "bucket")

    good, bad = F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)
    coarse = (long.groupBy(*CELL, "bucket", "tg", "tb", "min_leaf")
              .agg(good.alias("g"), bad.alias("b"), F.min("x").alias("x_min"),
                   F.max("x").alias("x_max")))
    w = Window.partitionBy(*CELL).orderBy("bucket")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*CELL)
    coarse = pin(coarse.select(
        "*", F.sum("g").over(upto).alias("cg"), F.sum("b").over(upto).alias("cb"),
        F.sum("g").over(every).alias("ng"), F.sum("b").over(every).alias("nb"),
        F.lead("x_min").over(w).alias("x_next")), max_rows=200_000)

    mixed = (F.col("ng") > 0) & (F.col("nb") > 0)
    fits = ((F.col("cg") + F.col("cb") >= F.col("min_leaf"))
            & (F.col("ng") + F.col("nb") - F.col("cg") - F.col("cb") >= F.col("min_leaf")))
    border = coarse.where(mixed & fits & F.col("x_next").isNotNull()).select(
        *CELL, _gain("cg", "cb", "ng", "nb", "tg", "tb").alias("gain"),
        ((F.col("x_max") + F.col("x_next")) / 2).alias("threshold"))
    floor = border.groupBy(*NODE).agg(F.max("gain").alias("best"))
    corners = F.greatest(*[
        _gain(gl, bl, "ng", "nb", "tg", "tb")
        for gl in ("(cg - g)", "cg") for bl in ("(cb - b)", "cb")])
    reach = ((F.col("cg") + F.col("cb") > F.col("min_leaf"))
             & (F.col("ng") + F.col("nb") - F.col("cg") - F.col("cb") + F.col("g") + F.col("b")
                > F.col("min_leaf")))
    open_ = pin(coarse.where(mixed & reach & (F.col("x_min") < F.col("x_max")))
                .join(floor, NODE, "left")
                .where(F.col("best").isNull() | (corners >= F.col("best") - 1e-12))
                .select(*CELL, "bucket", (F.col("cg") - F.col("g")).alias("og"),
                        (F.col("cb") - F.col("b")).alias("ob"), "ng", "nb",
                        (F.col("g") + F.col("b")).alias("size")), max_rows=200_000)
    found, kept = border, None
    if not (is_pinned(open_) and open_._pinned_rows == 0):
        fine = (attach(long, open_, [*CELL, "bucket"])
                .groupBy(*CELL, "bucket", "x", "tg", "tb", "min_leaf", "og", "ob", "ng", "nb")
                .agg(good.alias("g"), bad.alias("b"))).persist()  # read by the grid, the totals and the totals' heads
        kept, fine = fine, _sliced(fine, open_)
        cum = running_total(fine, [*CELL, "bucket"], "slice", [F.col("x")], ["g", "b"])
        heads = cum.groupBy(*CELL, "bucket", "slice").agg(F.min("x").alias("_h"))
        ws = Window.partitionBy(*CELL, "bucket").orderBy("slice")
        heads = heads.select(*CELL, "bucket", "slice", F.lead("_h").over(ws).alias("_next_head"))
        wx = Window.partitionBy(*CELL, "bucket", "slice").orderBy("x")
        cum = cum.join(heads, [*CELL, "bucket", "slice"]).withColumn(
            "_nx", F.coalesce(F.lead("x").over(wx), F.col("_next_head")))
        inner = cum.where(F.col("_nx").isNotNull()).select(
            *CELL, "tg", "tb", "ng", "nb", "min_leaf", F.col("_nx"), "x",
            (F.col("og") + F.col("cum_g")).alias("cg"), (F.col("ob") + F.col("cum_b")).alias("cb"))
        inner = inner.where(fits).select(
            *CELL, _gain("cg", "cb", "ng", "nb", "tg", "tb").alias("gain"),
            ((F.col("x") + F.col("_nx")) / 2).alias("threshold"))
        found = border.unionByName(inner)
    order = F.struct((-F.round("gain", 12)).alias("a"), F.col("feature"), F.col("threshold"))
    best = found.groupBy(*NODE).agg(
        F.min_by(F.struct("feature", "threshold"), order).alias("s")).select(*NODE, "s.*")
    best = best.collect()  # at most one row per open node
    if kept is not None:
        kept.unpersist()
    return best


def _sliced(fine: DataFrame, open_: DataFrame) -> DataFrame:
    """Order column for the running totals: large buckets are cut once more, small ones stay whole."""
    big = derived(open_, open_.where(F.col("size") > SMALL_N))
    if big.isEmpty():
        return fine.withColumn("slice", F.lit(0))
    keys = [*CELL, "bucket"]
    grid = grid_edges(attach(fine, derived(big, big.select(*keys)), keys), keys, "x")
    cut = attach(fine, grid, keys, "left").withColumn("_whole", F.col("_grid").isNull())
    return bucketed(cut, "x", "slice").withColumn("slice", F.when(F.col("_whole"), 0).otherwise(F.col("slice"))).drop("_whole")


def paths(trees: Trees, features: list[str]) -> list[tuple]:
    """Leaf paths as (segment_dim, segment_name, leaf, [(feature, op, threshold)])."""
    out = []
    for key, nodes in trees.splits.items():
        stack = [(1, [])]
        while stack:
            node, conds = stack.pop()
            if node in nodes:
                i, thr = nodes[node]
                stack.append((2 * node + 1, [*conds, (features[i], ">", float(thr))]))
                stack.append((2 * node, [*conds, (features[i], "<=", float(thr))]))
            elif conds:
                out.append((*key, node, conds))
    return out


def leaf_counts(rows: DataFrame, trees: Trees, n_features: int) -> DataFrame:
    """Unweighted training rows and bads of every leaf."""
    at = attach(rows.where("train"), trees.table(rows.sparkSession), SEG)
    at = at.select(*SEG, "y", F.expr(_imputed(n_features)).alias("x"), "feat", "thr")
    return (at.withColumn("leaf", F.expr(_descend(RULES.max_depth)).cast("int"))
            .groupBy(*SEG, "leaf").agg(F.count("*").alias("leaf_n"),
                                       F.sum(F.col("y").cast("bigint")).alias("leaf_bad")))


# ---- rule tables -----------------------------------------------------------------------------

def simplify(rules: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the tightest bound per feature and operator, rounded and sorted."""
    cond = rules.select(*keys, F.explode("conditions").alias("c")).select(*keys, "c.*")
    tight = cond.groupBy(*keys, "feature", "op").agg(
        F.round(F.when(F.col("op").isin("<=", "<"), F.min("threshold"))
                .otherwise(F.max("threshold")), RULES.decimals).alias("threshold"))
    packed = tight.groupBy(*keys).agg(F.sort_array(F.collect_list(
        F.struct("feature", "op", "threshold"))).alias("_conditions"))
    return (rules.join(packed, keys).drop("conditions")
            .withColumnRenamed("_conditions", "conditions"))


def dedupe(rules: DataFrame, keys: list[str], order: str) -> DataFrame:
    """First rule per distinct condition set."""
    w = Window.partitionBy(*keys, F.to_json("conditions")).orderBy(order)
    return rules.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def condition_mask(conditions: list[tuple[str, str, float]],
                   fills: dict[str, float] | None = None) -> Column:
    """AND of comparisons over the columns of a table; unfilled nulls miss."""
    ops = {"<=": lambda c, t: c <= t, ">": lambda c, t: c > t, "<": lambda c, t: c < t,
           ">=": lambda c, t: c >= t, "==": lambda c, t: c == t}
    mask = F.lit(True)
    for feature, op, thr in conditions:
        c = F.col(f"`{feature}`").cast("double")
        if fills and fills.get(feature) is not None:
            c = F.coalesce(c, F.lit(float(fills[feature])))
        mask = mask & ops[op](c, F.lit(float(thr)))
    return F.coalesce(mask, F.lit(False))


def _metrics(df: DataFrame, n: str = "n", bad: str = "n_bad") -> DataFrame:
    rate = F.try_divide(F.col("bad_n").cast("double"), F.col("coverage_n").cast("double"))
    overall = F.try_divide(F.col(bad).cast("double"), F.col(n).cast("double"))
    low, high = wilson(F.col("bad_rate"), F.col("coverage_n"))
    return (df.withColumn("coverage_pct", F.try_divide(F.col("coverage_n").cast("double"),
                                                       F.col(n).cast("double")))
            .withColumn("bad_rate", rate).withColumn("overall_bad_rate", overall)
            .withColumn("lift", F.try_divide(F.col("bad_rate"), F.col("overall_bad_rate")))
            .withColumn("bad_rate_ci_low", low).withColumn("bad_rate_ci_high", high))


def evaluate_given(df: DataFrame, target: str, rules: dict[int, list[tuple[str, str, float]]],
                   fills: dict[str, float] | None = None) -> DataFrame:
    """Coverage, rate, lift and Wilson interval of given rules in one aggregate."""
    y = F.col(target) == 1
    aggs = [F.count("*").alias("n"), F.count_if(y).alias("n_bad")]
    for i, conds in rules.items():
        m = condition_mask(conds, fills)
        aggs += [F.count_if(m).alias(f"c_{i}"), F.count_if(m & y).alias(f"b_{i}")]
    row = df.where(F.col(target).isNotNull()).agg(*aggs)
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("rule_id"), F.col(f"c_{i}").alias("coverage_n"),
                 F.col(f"b_{i}").alias("bad_n")) for i in rules]))
    return _metrics(row.select("n", "n_bad", cells.alias("r")).select("r.*", "n", "n_bad"))


def evaluate(rows: DataFrame, rules: DataFrame, features: list[str], side: str) -> DataFrame:
    """Counts of every segment's rules on one side of the split, all rules in one pass."""
    at = {f: i for i, f in enumerate(features)}
    index = F.create_map(*[x for f, i in at.items() for x in (F.lit(f), F.lit(i))])
    small = pin(rules.select(*SEG, "leaf", "fill", F.transform(
        "conditions", lambda c: F.struct(index[c["feature"]].alias("i"), c["op"].alias("op"),
                                         c["threshold"].alias("t"))).alias("cs")))
    per_seg = pin(small.groupBy(*SEG).agg(F.first("fill").alias("fill"), F.collect_list(
        F.struct("leaf", "cs")).alias("rs")))  # at most one rule per leaf
    hit = ("transform(rs, r -> IF(forall(r.cs, c -> coalesce(IF(c.op = '<=', "
           "coalesce(x[c.i], fill[c.i]) <= c.t, coalesce(x[c.i], fill[c.i]) > c.t), false)), "
           "r.leaf, NULL))")
    base = attach(rows.where(F.col(side)), per_seg, SEG)
    totals = base.groupBy(*SEG).agg(F.count("*").alias("n"), F.count_if(F.col("y") == 1).alias("n_bad"))
    hits = (base.select(*SEG, "y", F.explode(F.expr(hit)).alias("leaf"))
            .where(F.col("leaf").isNotNull()).groupBy(*SEG, "leaf")
            .agg(F.count("*").alias("coverage_n"), F.count_if(F.col("y") == 1).alias("bad_n")))
    out = (small.select(*SEG, "leaf").join(totals, SEG).join(hits, [*SEG, "leaf"], "left")
           .fillna(0, subset=["coverage_n", "bad_n"]))
    return _metrics(out)


def gate(evaluated: DataFrame, keys: list[str], tiebreak: str) -> DataFrame:
    """Coverage, lift and bad-count gates, then the best rules per segment, renumbered."""
    ok = ((F.col("coverage_pct") >= RULES.min_coverage) & (F.col("lift") >= RULES.min_lift)
          & (F.col("bad_n") >= RULES.min_bad_in_leaf))
    w = Window.partitionBy(*keys).orderBy(F.desc("lift"), F.desc("coverage_pct"), F.asc(tiebreak))
    return (evaluated.where(ok).withColumn("rule_no", F.row_number().over(w))
            .where(F.col("rule_no") <= RULES.top_k))


_BOOT = StructType([StructField("stab_bad_rate_mean", DoubleType()),
                    StructField("stab_bad_rate_std", DoubleType()),
                    StructField("stab_valid_n", LongType())])
_N_BOOT, _MIN_BAD = RULES.bootstrap_n, RULES.min_bad_in_leaf


@pandas_udf(_BOOT)
def _bootstrap(seed: pd.Series, n: pd.Series, cover: pd.Series, bad: pd.Series) -> pd.DataFrame:
    out = []
    for s, total, c, b in zip(seed, n, cover, bad):
        rng = np.random.default_rng(int(s) & 0x7FFFFFFF)
        draws = rng.multinomial(int(total), [b / total, (c - b) / total, (total - c) / total], _N_BOOT)
        hit = draws[:, 0] + draws[:, 1]
        ok = (hit > 0) & (draws[:, 0] >= _MIN_BAD)
        rates = draws[ok, 0] / hit[ok]
        out.append((rates.mean() if len(rates) else None, rates.std() if len(rates) else None,
                    int(ok.sum())))
    return pd.DataFrame(out, columns=["stab_bad_rate_mean", "stab_bad_rate_std", "stab_valid_n"])


def stability(evaluated: DataFrame, keys: list[str]) -> DataFrame:
    """Bootstrap of the rule bad rate and its grade.

    Resampling the evaluation rows with replacement changes a rule's numbers only through three
    counts (bad hits, good hits, misses), and those are exactly multinomial; so the draws are made
    from the counts and no row is resampled.
    """
    seed = F.crc32(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    out = evaluated.withColumn("_b", _bootstrap(seed, "n", "coverage_n", "bad_n"))
    ratio = F.col("stab_valid_n") / F.lit(float(RULES.bootstrap_n))
    return (out.select(*evaluated.columns, "_b.*").withColumn("stab_n", F.lit(RULES.bootstrap_n))
            .withColumn("stability", stability_grade(F.col("stab_bad_rate_mean"),
                                                     F.col("stab_bad_rate_std"), ratio)))


def suggest(rules: DataFrame) -> DataFrame:
    stab = F.col("stability") if "stability" in rules.columns else F.lit("stable")
    return rules.withColumn("suggestion", suggested_use(F.col("lift"), stab))


def candidates(df: DataFrame, roles: Roles, *, full: bool = True, dims: tuple[str, ...] = (),
               max_depth: int = RULES.max_depth):
    """Mined bad-enriched leaves of every segment: (rules, split rows, segments).

    The split rows are kept, since every level reads them; who has no more use for them calls ``unpersist``.
    """
    spark = df.sparkSession
    feats = list(roles.features)
    segs = split_segments(df, roles, full=full, dims=dims)
    rows = split_rows(df, roles, segs, full=full, dims=dims).persist()
    counts = {(r["segment_dim"], r["segment_name"]): (r["n"], r["b"]) for r in pin(
        rows.where("train").groupBy(*SEG).agg(
            F.count("*").alias("n"), F.count_if(F.col("y") == 1).alias("b"))).collect()}
    train = {k: v for k, v in counts.items()
             if v[1] >= GATES.min_bad_lr and v[0] - v[1] >= GATES.min_good_lr}
    med = group_median(_exploded(rows.where("train"), feats), [*SEG, "feature"])
    fills: dict = {k: [None] * len(feats) for k in train}
    for r in med.collect():
        key = (r["segment_dim"], r["segment_name"])
        if key in fills:
            fills[key][feats.index(r["feature"])] = r["median"]
    keep = local(spark, list(train), "segment_dim string, segment_name string")
    mined = attach(rows, keep, SEG)
    trees = grow(mined, feats, fills, train, max_depth)
    raw = local(spark, [
        (d, n, leaf, [dict(zip(("feature", "op", "threshold"), c)) for c in conds], fills[d, n])
        for d, n, leaf, conds in paths(trees, feats)],
        f"segment_dim string, segment_name string, leaf int, conditions array<{CONDITION}>, "
        "fill array<double>")
    stats = leaf_counts(mined, trees, len(feats))
    table = trees.table(spark)
    overall = derived(table, table.select(*SEG, "train_n", "train_bad"))
    rate = F.col("leaf_bad") / F.col("leaf_n")
    rules = (raw.join(stats, [*SEG, "leaf"]).join(overall, SEG)
             .where((F.col("leaf_bad") >= RULES.min_bad_in_leaf)
                    & (rate > F.col("train_bad") / F.col("train_n"))))
    rules = dedupe(simplify(rules, [*SEG, "leaf"]), SEG, "leaf")
    rules = rules.withColumn("feature_list", F.array_sort(F.array_distinct(
        F.transform("conditions", lambda c: c["feature"]))))
    return pin(rules), rows, segs


def mine(df: DataFrame, roles: Roles, *, full: bool = True, dims: tuple[str, ...] = (),
         max_depth: int = RULES.max_depth) -> DataFrame:
    """Rules of the full sample and of every group: mined on train rows, judged on test rows."""
    feats = list(roles.features)
    rules, rows, segs = candidates(df, roles, full=full, dims=dims, max_depth=max_depth)
    keys = [*SEG, "leaf"]
    test = gate(evaluate(rows, rules, feats, "test"), SEG, "leaf")
    train = evaluate(rows, rules, feats, "train").select(*keys, F.col("lift").alias("train_lift"))
    out = (rules.select(*keys, "conditions", "fill", "feature_list", "leaf_n", "leaf_bad")
           .join(test, keys).join(train, keys)
           .join(segs.select(*SEG, "eval_scope"), SEG))
    fill = F.map_from_arrays(F.array(*[F.lit(f) for f in feats]), F.col("fill"))
    out = out.withColumn("fill_values", F.map_filter(
        fill, lambda k, v: F.array_contains("feature_list", k) & v.isNotNull()))
    out = suggest(stability(out, keys))
    out = pin(out.drop("fill").withColumn("depth", F.size("feature_list"))
              .withColumn("leaf_good", F.col("leaf_n") - F.col("leaf_bad"))
              .withColumnRenamed("rule_no", "rule_id"))
    rows.unpersist()
    return out


def conditions_text(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda x: F.concat_ws(
        " ", x["feature"], x["op"], F.format_string("%.4f", x["threshold"]))), " and ")


EXPORT_COLUMNS = ("segment_dim", "segment_name", "rule_id", "rule", "features", "depth",
                  "coverage_n", "coverage_pct", "bad_n", "bad_rate", "overall_bad_rate", "lift",
                  "train_lift", "bad_rate_ci_low", "bad_rate_ci_high", "stab_bad_rate_mean",
                  "stab_bad_rate_std", "stab_valid_n", "stab_n", "stability", "eval_scope",
                  "suggestion")


def export_table(rules: DataFrame) -> DataFrame:
    """The 22 ordered columns of the delivered rule table."""
    return (rules.withColumn("rule", conditions_text(F.col("conditions")))
            .withColumn("features", F.concat_ws(", ", "feature_list")).select(*EXPORT_COLUMNS))


def unstable(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("stability") == "unstable")


def compact_payload(rules: DataFrame) -> DataFrame:
    """One short JSON document per rule."""
    return rules.select(*SEG, "rule_id", F.to_json(F.struct(
        F.col("segment_name").alias("segment"), conditions_text(F.col("conditions")).alias("rule"),
        F.round("coverage_pct", 4).alias("coverage"), F.round("bad_rate", 4).alias("bad_rate"),
        F.round("lift", 2).alias("lift"), "stability", "eval_scope", "suggestion")).alias("payload"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
