"""The entity wide table used by the registered queries, and shared result tables.

``wide`` plays the part of a prepared table: it is derived once per session from the base tables
and kept (memory, then disk); a lost executor recomputes its part from the base tables.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from risklens.config import Roles

FEATURES = ("c_acctbal", "n_orders", "n_lines", "qty_sum", "price_cents", "urgent_orders",
            "open_orders", "urgent_share", "lines_per_order", "qty_per_line", "ev_cnt",
            "ev_error_cnt", "ev_error_cnt0")
DERIVED = ("urgent_share", "lines_per_order", "qty_per_line")
# Without the four volume counts, which would dominate a multivariate model.
MODEL_FEATURES = ("c_acctbal", "urgent_orders", "open_orders", "urgent_share",
                  "lines_per_order", "qty_per_line", "ev_error_cnt0")
DIMS = ("c_mktsegment", "r_name", "n_name")
TAGS = ("is_urgent_buyer", "is_high_balance")

ROLES = Roles("c_custkey", "is_bad", FEATURES, DIMS, TAGS, DERIVED)
MODEL_ROLES = Roles("c_custkey", "is_bad", MODEL_FEATURES, DIMS, TAGS, DERIVED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _flag(cond):
    return F.when(cond, 1).otherwise(0)


def risk_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer. Facts are aggregated by customer before they meet the dimension."""
    t = lambda name: table(spark, sf_dir, name)
    orders = t("orders")
    o = orders.groupBy("o_custkey").agg(
        F.count("*").alias("o_n"),
        F.sum(_flag(F.col("o_orderpriority") == "1-URGENT")).alias("o_urgent"),
        F.sum(_flag(F.col("o_orderstatus") == "O")).alias("o_open"))
    # Lines collapse to one row per order before the join, so the join carries orders, not lines.
    per_order = t("lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("k_n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("k_qty"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("k_cents"),
        F.sum(_flag(F.col("l_returnflag") == "R")).alias("k_ret"))
    lines = (per_order.join(orders.select("o_orderkey", "o_custkey"),
                            F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy(F.col("o_custkey").alias("l_custkey"))
             .agg(F.sum("k_n").alias("l_n"), F.sum("k_qty").alias("l_qty"),
                  F.sum("k_cents").alias("l_cents"), F.sum("k_ret").alias("l_ret")))
    ev = t("events").groupBy("user_id").agg(
        F.count("*").alias("ev_cnt"),
        F.sum(_flag(F.col("event_type") == "error")).alias("ev_error_cnt"))
    places = (t("nation").select("n_nationkey", "n_name", "n_regionkey")
              .join(t("region").select("r_regionkey", "r_name"),
                    F.col("n_regionkey") == F.col("r_regionkey")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    d = lambda c: F.col(c).cast("double")
    return (t("customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(o, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(lines, F.col("l_custkey") == F.col("c_custkey"), "left")
            .join(ev, F.col("user_id") == F.col("c_custkey"), "left")
            .select("c_custkey", "c_mktsegment", "n_name", "r_name", "c_acctbal",
                    zero(F.col("o_n")).alias("n_orders"), zero(F.col("l_n")).alias("n_lines"),
                    zero(F.col("l_qty")).alias("qty_sum"),
                    zero(F.col("l_cents")).alias("price_cents"),
                    zero(F.col("o_urgent")).alias("urgent_orders"),
                    zero(F.col("o_open")).alias("open_orders"),
                    F.try_divide(d("o_urgent"), d("o_n")).alias("urgent_share"),
                    F.try_divide(d("l_n"), d("o_n")).alias("lines_per_order"),
                    F.try_divide(d("l_qty"), d("l_n")).alias("qty_per_line"),
                    F.col("ev_cnt").cast("bigint").alias("ev_cnt"),
                    F.col("ev_error_cnt").cast("bigint").alias("ev_error_cnt"),
                    zero(F.col("ev_error_cnt")).alias("ev_error_cnt0"),
                    _flag(F.coalesce("o_urgent", F.lit(0)) >= 3).alias("is_urgent_buyer"),
                    _flag(F.col("c_acctbal") >= 5000).alias("is_high_balance"),
                    _flag(F.coalesce("l_ret", F.lit(0)) >= 18).alias("is_bad")))


class Workspace:
    """Lazily built shared tables of one (session, data directory)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def path(self, name: str) -> str:
        """A new place for a file, in the folder that the session names for files or checkpoints."""
        known = self.spark.conf.get("spark.risklens.dir", None) or self.spark.conf.get("spark.checkpoint.dir", None)
        if not known and not re.fullmatch(r"local(\[.*\])?", self.spark.sparkContext.master):
            raise ValueError("set spark.risklens.dir or spark.checkpoint.dir to a folder that the driver and all executors share")
        return f"{known or tempfile.mkdtemp(prefix='risklens-')}/{uuid.uuid4().hex}/{name}"

    def _keep(self, df: DataFrame) -> DataFrame:
        return df.persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def wide(self) -> DataFrame:
        """The prepared table, laid out by key for the passes that fan every row out.

        Each analysis pass expands a row to its segments and features, so the small partitions
        that adaptive execution would merge are kept apart.
        """
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self._keep(risk_wide(self.spark, self.sf_dir).repartition(parts, "c_custkey"))

    @cached_property
    def iv_full(self) -> DataFrame:
        from risklens.operators.iv import iv_full
        return self._keep(iv_full(self.wide, ROLES))

    @cached_property
    def iv_all(self) -> DataFrame:
        """Full sample and every eligible segment."""
        from risklens.operators.iv import iv_segments
        return self._keep(iv_segments(self.wide, ROLES, full=True))

    @cached_property
    def corr(self) -> DataFrame:
        from risklens.operators.univariate import univariate
        return self._keep(univariate(self.wide, ROLES))

    @cached_property
    def lr(self):
        from risklens.operators.logistic import fit_segments
        m = fit_segments(self.wide, MODEL_ROLES)
        m.coefs = self._keep(m.coefs)
        return m

    @cached_property
    def rules(self) -> DataFrame:
        from risklens.operators.rules import mine
        return self._keep(mine(self.wide, MODEL_ROLES, dims=("c_mktsegment",)))


_SPACES: dict[tuple[int, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (id(spark._jsparkSession), spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _SPACES:
        _SPACES[key] = Workspace(spark, key[2])
    return _SPACES[key]
