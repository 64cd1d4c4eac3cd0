"""Export and reload of the named result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Older column names of exported results.
OLD_NAMES = {"分群维度": "segment_dim", "分群名称": "segment_name", "特征": "feature",
             "特征名称": "feature", "样本数": "n", "坏客户数": "n_bad", "坏客户率": "bad_rate",
             "IV值": "iv", "IV可信度": "iv_reliability", "预测能力": "iv_power",
             "相关系数": "corr", "系数": "lr_coef", "AUC类型": "auc_type"}


def manifest(results: dict[str, DataFrame]) -> DataFrame:
    """Row count of every result table."""
    out = None
    for name, df in results.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("result"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


def export_results(results: dict[str, DataFrame], path: str, fmt: str = "parquet") -> list[str]:
    """Write each table under its name; CSV carries nested columns as JSON."""
    written = []
    for name, df in results.items():
        if df is None:
            continue
        if fmt == "csv":
            flat = [F.to_json(f.name).alias(f.name)
                    if f.dataType.typeName() in ("array", "map", "struct") else F.col(f.name)
                    for f in df.schema.fields]
            df.select(*flat).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        written.append(name)
    return written


def load_results(spark: SparkSession, path: str, names: list[str],
                 fallbacks: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Reload exported tables, trying fallback names and translating old column names."""
    out = {}
    for name in names:
        for candidate in [name, *(fallbacks or {}).get(name, [])]:
            try:
                df = spark.read.parquet(f"{path}/{candidate}")
            except Exception as err:
                if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
                    continue
                raise
            out[name] = normalise(df)
            break
    return out


def normalise(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({o: n for o, n in OLD_NAMES.items()
                                  if o in df.columns and n not in df.columns})
