"""Exact per-group quantiles and histograms without sorting whole groups.

A few shared passes over the data serve any number of groups:

1. ``sketch`` - counts of every group and, for the large groups, a bracket of two values around
   every wanted order statistic. Where rows come with the cell of their value (``with_cells``),
   cells are counted by a plain hash aggregation; elsewhere a mergeable quantile sketch of each
   group (map-side combine, one small row per group) bounds the rank error.
2. ``histogram`` - one hash aggregation: values inside a bracket keep their identity, the rows of
   each gap between brackets collapse into one counting row. Only the bracketed values are shuffled.

Ranks inside the brackets follow from exact counts, so the quantiles (linear interpolation) are
exact whatever the sketch returned; a bracket that misses its rank raises instead of answering.
Groups below ``small_n`` rows or with few distinct values keep all values, i.e. a value histogram.
"""

from __future__ import annotations

from collections.abc import Iterable
from fractions import Fraction
from math import inf, isfinite, isqrt

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from risklens.operators.small import attach, derived, pin

MAX_K = 10
SLOTS = MAX_K - 1
ACCURACY = 10_000
SMALL_N = 20_000
FEW_VALUES = 64
CELLS = 256


def _probes(max_k: int) -> tuple[list[Fraction], list[list[int]]]:
    """All fractions i/k up to ``max_k``, and for each k where its fractions are (-1: unused slot)."""
    probes = sorted({Fraction(i, k) for k in range(2, max_k + 1) for i in range(1, k)})
    place = {p: i for i, p in enumerate(probes)}
    return probes, [[place[Fraction(i, k)] if i < k else -1 for i in range(1, max_k)]
                    for k in range(2, max_k + 1)]


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list[Column],
                  cols: list[str]) -> DataFrame:
    """Inclusive running sums per group, computed in two levels.

    ``bucket`` must grow with the order. Bucket totals give every bucket its offset, so no task
    sorts more than one bucket of one group.
    """
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    before = (Window.partitionBy(*keys).orderBy(bucket)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, bucket, *[
        F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in cols])
    upto = (Window.partitionBy(*keys, bucket).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = df.join(offsets, [*keys, bucket])
    return out.select(*df.columns, *[
        (F.sum(c).over(upto) + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in cols])


def with_cells(df: DataFrame, columns: list[str], names: list[str], cells: int = CELLS) -> DataFrame:
    """``df`` with the cell that each of the double ``columns`` falls into, null for null, under ``names``.

    Cells part all rows of a column evenly, as far as equal values allow. They never decide results.
    """
    probs = [i / cells for i in range(1, cells)]
    found = df.agg(*[F.percentile_approx(c, probs, 10 * cells).alias(n) for c, n in zip(columns, names)]).first()
    splits = [sorted({e for e in found[n] or () if isfinite(e)}) or [0.0] for n in names]
    return Bucketizer(splitsArray=[[-inf, *s, inf] for s in splits], inputCols=columns, outputCols=names,
                      handleInvalid="keep").transform(df).withColumns({n: F.col(n).cast("int") for n in names})


def sketch(long: DataFrame, keys: list[str], k: Column, *, accuracy: int = ACCURACY,
           small_n: int = SMALL_N, few_values: int = FEW_VALUES, max_k: int = MAX_K,
           extra: Iterable[Column] = ()) -> DataFrame:
    """Pinned row per group: counts, range, bin count ``k`` and the brackets of its quantiles.

    ``k``, at most ``max_k``, may use the columns ``n`` and ``n_bad`` (rows with a value). ``extra`` are more
    aggregates of the first pass. ``long`` may have the ``cell`` of each value, which must grow with it.
    """
    all_probes, slot_index = _probes(max_k)
    has = F.col("x").isNotNull()
    basic = pin(long.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.sum(F.col("y").cast("bigint")).alias("bad_rows"),
        F.count("x").alias("n"),
        F.coalesce(F.sum(F.when(has, F.col("y").cast("bigint"))), F.lit(0)).alias("n_bad"),
        F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), *extra).withColumn("k", k.cast("int")),
        max_rows=200_000)
    everything = _bounds("lo", max_k - 1), _bounds("hi", max_k - 1)
    big = derived(basic, basic.where(F.col("n") > small_n))
    if big.isEmpty():
        out = basic.selectExpr("*", "true AS whole", *everything)
        return derived(basic, out)
    if "cell" in long.columns:
        celled = _brackets(long, keys, big, max_k - 1)
        many = f"coalesce(_nd > {max_k}, false)"
        return pin(basic.join(celled, keys, "left").selectExpr(
            *basic.columns, f"NOT {many} AS whole", f"IF({many}, _lo, {everything[0].removesuffix(' AS lo')}) AS lo",
            f"IF({many}, _hi, {everything[1].removesuffix(' AS hi')}) AS hi"), max_rows=200_000)
    margin = 2.0 / accuracy
    probes = [max(0.0, min(1.0, float(p) + s)) for p in all_probes for s in (-margin, margin)]
    table = "array(" + ", ".join(f"array({', '.join(map(str, r))})" for r in slot_index) + ")"
    picked = [f"transform(element_at({table}, k - 1), j -> IF(j >= 0, get(_s, j * 2 + {side}), double('inf')))"
              for side in (0, 1)]
    many = f"_nd > {few_values}"
    sketched = _sketch_big(long, keys, big, probes, accuracy)
    return pin(basic.join(sketched, keys, "left").selectExpr(
        *basic.columns, f"NOT coalesce({many}, false) AS whole",
        f"IF(coalesce({many}, false), {picked[0]}, {everything[0].removesuffix(' AS lo')}) AS lo",
        f"IF(coalesce({many}, false), {picked[1]}, {everything[1].removesuffix(' AS hi')}) AS hi"),
        max_rows=200_000)


def _brackets(long: DataFrame, keys: list[str], big: DataFrame, slots: int) -> DataFrame:
    """Of the large groups: least number of distinct values, ends of the cells that hold the wanted ranks.

    Quantile sketches of many groups at once would sort all their rows (an object aggregation falls back to that
    beyond 128 groups in a task); counts of cells don't.
    """
    rows = attach(long.where(F.col("x").isNotNull()), derived(big, big.select(*keys)), keys)
    cells = rows.groupBy(*keys, "cell").agg(F.count("*").alias("_c"), F.min("x").alias("x_min"), F.max("x").alias("x_max"))
    upto = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    listed = cells.withColumn("cum", F.sum("_c").over(upto)).groupBy(*keys).agg(
        F.sum(F.when(F.col("x_min") < F.col("x_max"), 2).otherwise(1)).alias("_nd"),
        F.sort_array(F.collect_list(F.struct("cum", "x_min", "x_max"))).alias("_cells"))
    end = lambda r, side: (f"concat(transform({_POSITIONS}, p -> get(filter(_cells, c -> c.cum > {r}(p)), 0).{side}), "  # noqa: E731
                           f"array_repeat(double('inf'), {slots + 1} - k))")
    return listed.join(derived(big, big.select(*keys, "n", "k")), keys).selectExpr(
        *keys, "_nd", f"{end('floor', 'x_min')} AS _lo", f"{end('ceil', 'x_max')} AS _hi")


def _sketch_big(long: DataFrame, keys: list[str], big: DataFrame, probes: list[float],
                accuracy: int) -> DataFrame:
    """Quantile sketch and distinct estimate of the large groups only."""
    rows = attach(long.where(F.col("x").isNotNull()), derived(big, big.select(*keys)), keys)
    return rows.groupBy(*keys).agg(F.approx_count_distinct("x").alias("_nd"),
                                   F.percentile_approx("x", probes, accuracy).alias("_s"))


def _bounds(side: str, slots: int = SLOTS) -> str:
    """Bracket array of a group kept whole: one bracket around everything."""
    first = "double('-inf')" if side == "lo" else "double('inf')"
    return f"concat(array({first}), array_repeat(double('inf'), {slots - 1})) AS {side}"


def below(edges: str, op: str, slots: int, x: str = "x") -> tuple[str, str]:
    """SQL of how many of the ascending ``edges`` are below ``x``: whole steps of them, then (with these as ``_edges``) all."""
    step = max(1, isqrt(slots))
    whole = " + ".join(f"IF({edges}[{i}] {op} {x}, {step}, 0)" for i in range(step - 1, slots, step))
    return whole, " + ".join([f"_{edges}", *[f"IF(get({edges}, _{edges} + {i}) {op} {x}, 1, 0)" for i in range(step - 1)]])


def histogram(long: DataFrame, keys: list[str], sk: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Counting rows per group: bracketed values (``v``) and gaps between brackets (``v`` null)."""
    rows = attach(long.where(F.col("x").isNotNull()), derived(sk, sk.select(*keys, "lo", "hi")), keys)
    # Both arrays ascend. A comparison of each element would make a method that the JVM no longer compiles.
    hi, lo = below("hi", "<", slots), below("lo", "<=", slots)
    rows = (rows.selectExpr(*keys, "x", "y", "hi", "lo", f"{hi[0]} AS _hi", f"{lo[0]} AS _lo")
            .selectExpr(*keys, "x", "y", f"{hi[1]} AS gap", f"{lo[1]} AS _begun"))
    return (rows.groupBy(*keys, "gap", F.expr("IF(_begun > gap, x, NULL)").alias("v"))
            .agg(F.count("*").alias("n"), F.sum(F.col("y").cast("bigint")).alias("n_bad"),
                 F.min("x").alias("x_min"), F.max("x").alias("x_max")))


_POSITIONS = ("transform(sequence(1, k - 1), i -> CAST(n - 1 AS DOUBLE) * "
              "(CAST(i AS DOUBLE) / CAST(k AS DOUBLE)))")


def edges(hist: DataFrame, keys: list[str], sk: DataFrame) -> DataFrame:
    """Distinct quantile edges 0, 1/k .. 1 of every group, and its value-bin flag."""
    meta = derived(sk, sk.selectExpr(*keys, "k", "whole", "x_lo", "x_hi", f"{_POSITIONS} AS pos"))
    cuts = _interpolated(hist, keys, meta)
    distinct = hist.groupBy(*keys).agg(F.count("v").alias("_nv"))
    return meta.join(cuts, keys).join(distinct, keys).selectExpr(
        *keys, "k", "array_distinct(concat(array(x_lo), cuts, array(x_hi))) AS edges", "cuts",
        "whole AND _nv <= k AS by_value", "IF(whole, _nv, NULL) AS n_distinct")


def _interpolated(hist: DataFrame, keys: list[str], meta: DataFrame) -> DataFrame:
    """Values at the fractional positions ``pos`` (zero based) of every group, as array ``cuts``.

    Only the few histogram rows that hold a wanted rank go into the final aggregation.
    """
    ranks = "array_distinct(flatten(transform(pos, p -> array(floor(p) + 1, ceil(p) + 1))))"
    small = derived(meta, meta.selectExpr(*keys, "pos", f"{ranks} AS ranks"))
    cum = running_total(hist, keys, "gap", [F.col("x_min")], ["n"])
    hit = (attach(cum, small, keys)
           .selectExpr(*keys, "v", "pos", "filter(ranks, r -> cum_n - n < r AND r <= cum_n) AS hits")
           .where("size(hits) > 0").select(*keys, "v", "pos", F.explode("hits").alias("r")))
    missed = "CAST(raise_error('quantile bracket missed its rank') AS DOUBLE)"
    at = lambda rank: f"coalesce(at[{rank} + 1], {missed})"
    low, high = at("floor(p)"), at("ceil(p)")
    return (hit.groupBy(*keys).agg(F.first("pos").alias("pos"),
                                   F.expr("map_from_entries(collect_list(struct(r, v)))").alias("at"))
            .selectExpr(*keys, f"transform(pos, p -> {low} + ({high} - {low}) * (p - floor(p))) AS cuts"))


def group_median(long: DataFrame, keys: list[str], extra: dict[str, Column] | None = None, **kw) -> DataFrame:
    """Exact median of ``x`` per group, with the counts of the sketch and the ``extra`` aggregates by name."""
    extra = extra or {}
    sk = sketch(long, keys, F.lit(2), extra=[c.alias(n) for n, c in extra.items()], **kw)
    # The running totals read the histogram several times, each time with other columns.
    hist = histogram(long, keys, sk).persist()
    med = edges(hist, keys, sk).select(*keys, F.get("cuts", F.lit(0)).alias("median"))
    out = pin(sk.select(*keys, "n_rows", "n", *extra).join(med, keys, "left"), max_rows=200_000)
    hist.unpersist()
    return out


def group_quantiles(long: DataFrame, keys: list[str], probs: list[float], *,
                    accuracy: int = ACCURACY, small_n: int = SMALL_N,
                    few_values: int = FEW_VALUES) -> DataFrame:
    """Exact quantiles at fixed probabilities per group (array ``q``)."""
    slots = len(probs)
    base = long.where(F.col("x").isNotNull())
    basic = pin(base.groupBy(*keys).agg(F.count("x").alias("n")), max_rows=200_000)
    big = derived(basic, basic.where(F.col("n") > small_n))
    lo, hi = _bounds("lo", slots), _bounds("hi", slots)
    if big.isEmpty():
        sk = derived(basic, basic.selectExpr("*", lo, hi))
    else:
        margin = 2.0 / accuracy
        wanted = [max(0.0, min(1.0, p + s)) for p in probs for s in (-margin, margin)]
        many = f"coalesce(_nd > {few_values}, false)"
        picked = ["array(" + ", ".join(f"_s[{2 * i + side}]" for i in range(slots)) + ")"
                  for side in (0, 1)]
        sk = pin(basic.join(_sketch_big(base, keys, big, wanted, accuracy), keys, "left").selectExpr(
            *keys, "n", f"IF({many}, {picked[0]}, {lo.removesuffix(' AS lo')}) AS lo",
            f"IF({many}, {picked[1]}, {hi.removesuffix(' AS hi')}) AS hi"), max_rows=200_000)
    if "y" not in base.columns:
        base = base.withColumn("y", F.lit(0))
    hist = histogram(base, keys, sk, slots).persist()
    pos = "array(" + ", ".join(f"CAST(n - 1 AS DOUBLE) * {p!r}D" for p in probs) + ")"
    meta = derived(sk, sk.selectExpr(*keys, "n", f"{pos} AS pos"))
    cuts = _interpolated(hist, keys, meta)
    out = pin(meta.select(*keys, "n").join(cuts, keys).select(*keys, "n", F.col("cuts").alias("q")),
              max_rows=200_000)
    hist.unpersist()
    return out
