"""Readers for transaction tables, and the transaction views over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave import schema
from riskweave.functions import scalar


def read_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Stack raw CSV files. Columns are found by the header's names, in any order and file by file, also within a folder.

    Further columns, such as a leading index without a name, are left out; a missing name is an error. The types
    are given, so no pass is spent on inference. Files with one header are read together.
    """
    out = None
    for header, files in _by_header(spark, paths).items():
        text = spark.read.csv(files, header=True, enforceSchema=False)  # all columns as text: only the header is looked at here
        missing = [f.name for f in schema.RAW_TRANSACTION if f.name not in text.columns]
        if missing:
            raise ValueError(f"{files[0]} lacks column(s): {', '.join(missing)}")
        part = text.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.RAW_TRANSACTION])
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no file to read")
    return out


def _by_header(spark: SparkSession, paths) -> dict[str, list[str]]:
    """Files of paths, patterns and folders by their first line, which is all that is read of them here."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    out: dict[str, list[str]] = {}
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        store = target.getFileSystem(conf)
        found = store.globStatus(target)
        if found is None or not len(found):
            raise FileNotFoundError(path)
        for status in found:
            root = len(status.getPath().toString())
            files = store.listFiles(status.getPath(), True)
            while files.hasNext():
                file = files.next().getPath()
                # As Spark does: names that begin with a mark are not data.
                if any(part[:1] in ("_", ".") for part in file.toString()[root:].split("/")):
                    continue
                codec = codecs.getCodec(file)
                stream = store.open(file)
                try:
                    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
                    header = reader.readLine()
                finally:
                    stream.close()
                if header is not None:
                    out.setdefault(header, []).append(file.toString())
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder matches, in any store that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table or CSV file(s), told apart by suffix."""
    return read_csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def parse_times(df: DataFrame, time_col: str = "trans_date_trans_time") -> DataFrame:
    """Event time as an instant and birth date as a date (unreadable ones become null)."""
    out = df.withColumn("trans_ts", scalar.event_time(time_col))
    return out.withColumn("dob", scalar.lenient_date("dob")) if "dob" in df.columns else out


def read_splits(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A folder with `fold=train` and `fold=test` as written by `sinks.write_splits`, as Parquet or CSV.

    Also a folder that holds `train.csv` and `test.csv`.
    """
    if exists(spark, f"{folder}/train.csv"):
        return tuple(parse_times(read_csv(spark, f"{folder}/{fold}.csv")) for fold in ("train", "test"))
    csv = exists(spark, f"{folder}/fold=*/*.csv*")
    both = _typed(spark.read.csv(folder, header=True)) if csv else spark.read.parquet(folder)
    return tuple(parse_times(both.filter(F.col("fold") == f).drop("fold")) if "trans_ts" not in both.columns
                 else both.filter(F.col("fold") == f).drop("fold") for f in ("train", "test"))


def _typed(text: DataFrame) -> DataFrame:
    """CSV columns of the raw layout in their types; others (engineered ones, instants) as Spark reads their text."""
    kinds = {f.name: f.dataType for f in schema.RAW_TRANSACTION} | {"trans_ts": "timestamp", "dob": "date"}
    return text.select([F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in text.columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared table with zone-less timestamps turned into instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({n: F.col(n).cast("timestamp") for n, k in df.dtypes if k == "timestamp_ntz"})


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `events` table seen as card transactions."""
    return as_transactions(table(spark, sf_dir, "events"))


def as_transactions(e: DataFrame) -> DataFrame:
    """Rows of the `events` layout, from a table or a stream, as card transactions."""
    eid, uid = F.col("event_id"), F.col("user_id")
    return e.select(
        eid.alias("trans_num"), uid.alias("cc_num"), F.col("ts").cast("timestamp").alias("trans_ts"),
        F.col("value").alias("amt"), F.col("event_type").alias("category"),
        F.concat(F.lit("m_"), ((eid * 7 + uid) % 41).cast("string")).alias("merchant"),
        F.when(uid % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.lit(500) + (uid * 7919) % 90000).cast("int").alias("city_pop"),
        F.when(uid % 29 != 0, F.date_add(F.lit("1940-01-01").cast("date"), ((uid * 104729) % 22000).cast("int"))).alias("dob"),
        (F.lit(25.0) + ((eid * 7919) % 2400).cast("double") / 100.0).alias("merch_lat"),
        (F.lit(-120.0) + ((eid * 104729) % 5000).cast("double") / 100.0).alias("merch_long"),
        F.when(((eid * 31 + uid) % 53 == 0) | ((F.col("value") > 150) & (eid % 7 == 0)), 1).otherwise(0).alias("is_fraud"))


def tied_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `orders` table as transactions on whole days, which has equal times per card."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trans_num"), F.col("o_custkey").alias("cc_num"),
        F.col("o_orderdate").alias("trans_ts"), F.col("o_totalprice").alias("amt"),
        F.col("o_orderpriority").alias("category"), F.lit(0.0).alias("merch_lat"), F.lit(0.0).alias("merch_long"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in scores over `transactions`: `p` nearly continuous, `p_tied` with at most 101 values."""
    t = transactions(spark, sf_dir)
    return t.select(
        F.col("trans_num").alias("id"), F.col("is_fraud").alias("y"), "amt", "category", "trans_ts",
        (F.floor(F.least(F.col("amt"), F.lit(400.0)) / 4.0).cast("double") / 100.0).alias("p_tied"),
        (F.col("amt") / 500.0).alias("p"))
