"""Writers for splits, reports and result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def write_splits(df: DataFrame, path: str, helpers=("trans_dt", "hour"), fmt: str = "parquet") -> None:
    """One folder per fold, without helper columns."""
    df.drop(*helpers).write.mode("overwrite").partitionBy("fold").option("header", True).format(fmt).save(path)


def write_report(spark: SparkSession, report: Mapping, path: str) -> None:
    """A nested report as one JSON record."""
    def plain(value):
        if isinstance(value, Mapping):
            return {str(k): plain(v) for k, v in value.items()}
        if hasattr(value, "item"):
            return value.item()
        return value

    import json
    text = json.dumps(plain(report), default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)
