"""Segments of a wide table: the full sample, every category value, every set tag.

All per-segment operators share one pass over the data: each row is expanded to the segments it
belongs to, rows of ineligible segments are dropped by a broadcast join, and features are unpivoted
so that one hash aggregation with map-side combine covers every (segment, feature) pair.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from risklens.config import ALL, GATES, TAG_DIM, TAG_PREFIX, Roles
from risklens.operators import quantiles as Q
from risklens.operators.small import attach, pin

SEG = ["segment_dim", "segment_name"]
KEY = SEG + ["feature"]


def tag_name(column: str) -> str:
    return column[len(TAG_PREFIX):] if column.startswith(TAG_PREFIX) else column


def detect_dims(df: DataFrame, candidates: Iterable[str], tag_prefix: str = TAG_PREFIX,
                exclude: Iterable[str] = (), tags: Iterable[str] | None = None) -> DataFrame:
    """Usable dims: configured columns with at least one value, and 0/1 tags by prefix or by list."""
    skip = set(exclude)
    cats = [c for c in candidates if c in df.columns and c not in skip]
    tag_cols = ([t for t in tags if t in df.columns] if tags is not None else
                [c for c in df.columns if c.startswith(tag_prefix) and c not in skip])
    pairs = [(c, "category") for c in cats] + [(c, "tag") for c in tag_cols if c not in cats]
    if not pairs:
        return df.sparkSession.createDataFrame([], "dim string, kind string, n_present bigint")
    counts = df.agg(*[F.count(c).alias(c) for c, _ in pairs])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("dim"), F.lit(k).alias("kind"), F.col(f"`{c}`").alias("n_present"))
        for c, k in pairs]))
    out = counts.select(rows.alias("r")).select("r.*")
    return out.where((F.col("n_present") > 0) | (F.col("kind") == "tag"))


def _segment_struct(dim: str, name: Column) -> Column:
    return F.struct(F.lit(dim).alias("segment_dim"), name.alias("segment_name"))


def expand(df: DataFrame, roles: Roles, *, full: bool = True, dims: bool = True,
           tags: bool = True, null_group: str | None = None) -> DataFrame:
    """One output row per (row, segment). ``null_group`` keeps null dims under that label."""
    parts: list[Column] = []
    if full:
        parts.append(_segment_struct(ALL, F.lit(ALL)))
    if dims:
        for d in roles.dims:
            name = F.col(d).cast("string")
            if null_group is not None:
                parts.append(_segment_struct(d, F.coalesce(name, F.lit(null_group))))
            else:
                parts.append(F.when(name.isNotNull(), _segment_struct(d, name)))
    if tags:
        for t in roles.tags:
            parts.append(F.when(F.col(t) == 1, _segment_struct(TAG_DIM, F.lit(tag_name(t)))))
    expanded = df.withColumn("_seg", F.explode(F.array(*parts))).where(F.col("_seg").isNotNull())
    return expanded.select(F.col("_seg.segment_dim").alias("segment_dim"),
                           F.col("_seg.segment_name").alias("segment_name"), *df.columns)


def segment_sizes(df: DataFrame, roles: Roles, **kw) -> DataFrame:
    """Rows, bads and goods of every segment; reads only the dims, tags and target."""
    cols = list(dict.fromkeys([roles.target, *roles.dims, *roles.tags]))
    y = F.col(roles.target)
    return (expand(df.select(*cols).where(y.isNotNull()), roles, **kw)
            .groupBy(*SEG)
            .agg(F.count("*").alias("n"), F.sum(y.cast("bigint")).alias("n_bad"))
            .withColumn("n_good", F.col("n") - F.col("n_bad")))


def skip_reason(min_n: int = 0, min_bad: int = 0, min_good: int = 0,
                n_gate_on_tags: bool = True) -> Column:
    """First failing gate of a segment, null when it is analysed."""
    n_fails = F.col("n") < min_n
    if not n_gate_on_tags:
        n_fails = n_fails & (F.col("segment_dim") != TAG_DIM)
    return (F.when(n_fails, F.lit("n"))
            .when(F.col("n_bad") < min_bad, F.lit("bad"))
            .when(F.col("n_good") < min_good, F.lit("good")))


def group_ledger(df: DataFrame, roles: Roles, min_n: int = GATES.min_n,
                 min_bad: int = GATES.min_bad_corr, min_good: int = GATES.min_good_corr,
                 n_gate_on_tags: bool = False, full: bool = False) -> DataFrame:
    """Every segment with its size, rate, status and first failing gate."""
    sizes = segment_sizes(df, roles, full=full)
    reason = skip_reason(min_n, min_bad, min_good, n_gate_on_tags)
    return (sizes.withColumn("bad_rate", F.col("n_bad") / F.col("n"))
            .withColumn("skip_reason", reason)
            .withColumn("status", F.when(reason.isNull(), "analysed").otherwise("skipped")))


def cap_groups(sizes: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Keep the largest groups of the capped dims (size desc, name asc)."""
    if not caps:
        return sizes
    pairs = [x for d, k in caps.items() for x in (F.lit(d), F.lit(k))]
    cap = F.create_map(*pairs)[F.col("segment_dim")]
    w = Window.partitionBy("segment_dim").orderBy(F.desc("n"), F.asc("segment_name"))
    return (sizes.withColumn("_rank", F.row_number().over(w))
            .where(cap.isNull() | (F.col("_rank") <= cap)).drop("_rank"))


def eligible(df: DataFrame, roles: Roles, min_n: int, min_bad: int, min_good: int = 0, *,
             full_gated: bool = False, n_gate_on_tags: bool = True, caps: dict | None = None,
             **kw) -> DataFrame:
    """Pinned table of the segments that pass the gates."""
    sizes = segment_sizes(df, roles, **kw)
    ok = skip_reason(min_n, min_bad, min_good, n_gate_on_tags).isNull()
    if not full_gated:
        ok = ok | (F.col("segment_dim") == ALL)
    sizes = sizes.where(ok)
    if caps:
        sizes = cap_groups(sizes, caps)
    return pin(sizes)


def clean_double(c: Column) -> Column:
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def long_form(df: DataFrame, roles: Roles, segments: DataFrame, extra: Iterable[str] = (),
              small_n: int | None = None, **kw) -> DataFrame:
    """(segment_dim, segment_name, feature, x, y[, extra][, cell]) for the given segments.

    With ``small_n``, values come with their cell for ``quantiles.sketch`` if a segment has more rows than that.
    """
    extra, cell = list(extra), []
    slim = df.where(F.col(roles.target).isNotNull()).select(
        *dict.fromkeys([*roles.dims, *roles.tags, *extra]),
        F.col(roles.target).cast("int").alias("y"),
        *[clean_double(F.col(f)).alias(f"f_{i}") for i, f in enumerate(roles.features)])
    if small_n is not None and roles.features and not segments.where(F.col("n") > small_n).isEmpty():
        at = range(len(roles.features))
        slim, cell = Q.with_cells(slim, [f"f_{i}" for i in at], [f"cell_{i}" for i in at]), ["cell"]
    seg_roles = Roles(roles.key, "y", (), roles.dims, roles.tags)
    rows = attach(expand(slim, seg_roles, **kw), segments.select(*SEG), SEG)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"f_{i}").alias("x"), *[F.col(f"{c}_{i}").alias(c) for c in cell])
        for i, f in enumerate(roles.features)]))
    return (rows.select(*SEG, *extra, "y", pairs.alias("p"))
            .select(*SEG, "p.feature", "p.x", "y", *extra, *[f"p.{c}" for c in cell]))


def segment_stats(df: DataFrame, roles: Roles, min_n: int = GATES.min_n) -> DataFrame:
    """Size, bads, rate and share of each category group; the share precedes the size filter."""
    sizes = segment_sizes(df, roles, full=False, tags=False)
    w = Window.partitionBy("segment_dim")
    return (sizes.withColumn("bad_rate", F.round(F.col("n_bad") / F.col("n"), 4))
            .withColumn("share_pct", F.round(F.col("n") / F.sum("n").over(w) * 100, 2))
            .where(F.col("n") >= min_n)
            .select(*SEG, "n", "n_bad", "bad_rate", "share_pct"))


def tag_stats(df: DataFrame, roles: Roles) -> DataFrame:
    """Has / has-not rows of each 0/1 tag."""
    y = F.col(roles.target)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(tag_name(t)).alias("tag"), F.col(t).cast("int").alias("v"))
        for t in roles.tags]))
    return (df.select(y.alias("y"), pairs.alias("p")).where(F.col("p.v").isin(0, 1))
            .groupBy(F.col("p.tag").alias("tag"),
                     F.when(F.col("p.v") == 1, "has").otherwise("has_not").alias("side"))
            .agg(F.count("*").alias("n"), F.sum(F.col("y").cast("bigint")).alias("n_bad"))
            .withColumn("bad_rate", F.col("n_bad") / F.col("n")))


def tag_pivot(df: DataFrame, roles: Roles) -> DataFrame:
    """Bad rate with and without each tag, and the difference."""
    return (tag_stats(df, roles).groupBy("tag").pivot("side", ["has", "has_not"])
            .agg(F.first("bad_rate"))
            .withColumn("rate_diff", F.col("has") - F.col("has_not")))


def sample_summary(df: DataFrame, roles: Roles) -> DataFrame:
    y = F.col(roles.target)
    return (df.agg(F.count("*").alias("n"), F.sum(y.cast("bigint")).alias("n_bad"))
            .withColumn("n_good", F.col("n") - F.col("n_bad"))
            .withColumn("bad_rate", F.when(F.col("n") > 0, F.col("n_bad") / F.col("n"))))
