"""Run records and model versions as append-only Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

# Table layouts.
RUN_COLUMNS = "run_id string, started_at timestamp, params map<string,string>, metrics map<string,double>, artifacts array<string>"
VERSION_COLUMNS = "name string, version long, path string, alias string, assigned_at timestamp"


def log_run(spark: SparkSession, table: str, run_id: str, params: Mapping, metrics: Mapping, artifacts=()) -> None:
    row = (run_id, datetime.now(timezone.utc).replace(tzinfo=None), {k: str(v) for k, v in params.items()},
           {k: float(v) for k, v in metrics.items()}, list(artifacts))
    spark.createDataFrame([row], RUN_COLUMNS).coalesce(1).write.mode("append").parquet(table)


def best_runs(spark: SparkSession, table: str, metric: str = "pr_auc") -> DataFrame:
    """Runs with the metric at hand, best first."""
    value = F.col("metrics")[metric]
    return spark.read.parquet(table).withColumn(metric, value).orderBy(F.desc_nulls_last(metric), "run_id")


def assign_alias(spark: SparkSession, table: str, name: str, version: int, path: str, alias: str) -> None:
    """Point an alias at a version; earlier assignments stay in the table."""
    row = (name, version, path, alias, datetime.now(timezone.utc).replace(tzinfo=None))
    spark.createDataFrame([row], VERSION_COLUMNS).coalesce(1).write.mode("append").parquet(table)


def latest_aliases(versions: DataFrame) -> DataFrame:
    """Newest assignment per (name, alias). A maximum combines map-side, unlike a ranking window."""
    newest = F.max(F.struct("assigned_at", "version", "path")).alias("v")
    return versions.groupBy("name", "alias").agg(newest).select("name", "alias", "v.version", "v.path", "v.assigned_at")


def resolve(spark: SparkSession, table: str, name: str, alias: str) -> str:
    """Path of the version an alias points at."""
    hit = latest_aliases(spark.read.parquet(table).filter((F.col("name") == name) & (F.col("alias") == alias))).first()
    if hit is None:
        raise LookupError(f"no version of {name} has alias {alias}")
    return hit["path"]
