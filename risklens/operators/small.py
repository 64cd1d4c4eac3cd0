"""Pinning of intermediate tables that are small by construction.

Segment lists, quantile sketches and fitted models have one row per segment or per
(segment, feature) pair. ``pin`` computes such a table once and then looks at its rows and bytes. Within
the bounds it becomes a local relation: every later stage sees the same values even when an executor
is lost and recomputes its part, and joins against it can broadcast. Beyond them it is written to the
shared folder named by ``spark.checkpoint.dir`` (or stays cached where none is configured) and joins
against it are left to the optimizer, whose adaptive execution splits the partitions of dominant keys.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

MAX_ROWS = 200_000
MAX_BYTES = 128 << 20
#: Rows that are fetched without a look at the size of the table before.
FETCH_ROWS = 4_000


def pin(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, many: bool = False) -> DataFrame:
    """``many`` says that more than ``FETCH_ROWS`` rows are likely, so that the first look is left out."""
    spark = df.sparkSession
    max_rows, max_bytes = min(max_rows, MAX_ROWS), min(max_bytes, MAX_BYTES)
    # Most such tables have a few rows: one job fetches them, and no more than the bound of rows.
    first = min(max_rows, FETCH_ROWS)
    head = None if many else df.limit(first + 1).toArrow()
    if head is not None and head.num_rows <= first and head.nbytes <= max_bytes:
        return _local(spark, head, df.schema)
    # Others are cached and measured where they lie.
    df.persist()
    cached = df.select("*")  # a new plan, which reads the cache
    rows = cached.count()
    size = int(cached._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if rows <= max_rows and size <= max_bytes:
        head = cached.toArrow()
        df.unpersist()
        return _local(spark, head, df.schema)
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        return cached
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    out = cached.checkpoint()
    df.unpersist()
    return out


def _local(spark: SparkSession, table: pa.Table, schema: StructType) -> DataFrame:
    out = spark.createDataFrame(table, schema=schema)
    out._pinned_rows = table.num_rows
    return out


def is_pinned(df: DataFrame) -> bool:
    return getattr(df, "_pinned_rows", None) is not None


def attach(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join a large table to a pinned one; broadcast only when the pin kept it local."""
    return df.join(F.broadcast(small) if is_pinned(small) else small, keys, how)


def is_empty(df: DataFrame) -> bool:
    if is_pinned(df):
        return df._pinned_rows == 0
    return df.isEmpty()


def derived(small: DataFrame, df: DataFrame) -> DataFrame:
    """Mark ``df``, a projection or filter of the pinned ``small``, as just as small."""
    if is_pinned(small):
        df._pinned_rows = small._pinned_rows
    return df


def local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Table from driver-side rows (fitted models, configuration), pinned within the bounds."""
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrow = to_arrow_schema(fields)
    table = pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)
    df = spark.createDataFrame(table, schema=fields)
    if len(rows) <= MAX_ROWS and table.nbytes <= MAX_BYTES:
        df._pinned_rows = len(rows)
    return df


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out.agg(*[F.first(c, ignorenulls=True).alias(c) for c in out.columns])
