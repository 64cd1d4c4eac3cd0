"""Small Spark helpers of this package."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character unchanged."""
    return F.translate(text, UPPER, LOWER)


_TEMPORARY: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables. Only a local session without one gets a temporary folder."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        known = _TEMPORARY.get(app) or _TEMPORARY.setdefault(app, tempfile.mkdtemp(prefix="risklens-"))
    return known.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = f"{folder(spark)}/risklens-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by position, so that clashing extra columns do no harm.

    Of columns with the same name the first counts.
    """
    at = [df.columns.index(n) for n in names]
    if len({c.lower() for c in df.columns}) != len(df.columns):
        df = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
        return df.select(*[F.col(f"_{i}").alias(n) for i, n in zip(at, names)])
    return df.select(*[F.col(f"`{n}`") for n in names])


def spread(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def own_names(*needed: str):
    """For functions of a table that return its columns: all but the needed ones are renamed meanwhile.

    Column names that differ in case only, or that the function uses itself, so do no harm.
    """
    def wrap(function):
        @wraps(function)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            at = {docs.columns.index(n): n for n in needed}
            names = [at.get(i, f"other_{i}") for i in range(len(docs.columns))]
            return function(docs.toDF(*names), *args, **options).toDF(*docs.columns)
        return run
    return wrap


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded(table: DataFrame, rows: int = 20_000) -> DataFrame:
    """A written table, to be broadcast if it is counted to have ``rows`` rows at most."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table
