"""How the operators reach their tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of the data folder, with this library on the Python workers."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a labelled row is kept for testing: a fifth of the ids, by checksum. A null id is kept."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))
