"""Registration of the driver's queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from risklens.plans.workspace import Workspace, workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(workspace) -> DataFrame`` under ``name``."""
    def register(fn: Callable[[Workspace], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(workspace(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def rounded(df: DataFrame, cols: Iterable[str], digits: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def r(*cols: str, digits: int = 6) -> str:
    """SQL text: rounded columns under their own names."""
    return ", ".join(f"ROUND({c}, {digits}) AS {c}" for c in cols)
