"""Corpus preparation: language, near copies, benchmark leaks, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next one's
`docs`. All but the last return the columns of `documents`. Every row is decided about by its own id and text: ids may be
null or repeat with other texts. Rows that agree in both are one document; near_copies leaves one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe, langid, latent, ordermin, secrets
from riskweave.llm.queries import vocabulary
from riskweave.llm.tables import table
from riskweave.session import scratch_path, ship_package

FARTHEST = 0.8  # share of the greatest out-of-place distance beyond which a text is in no known language


def _same_row(docs: DataFrame, keys: DataFrame):
    """The condition that a row of `docs` has the id and text of a row of `keys` (key_id, key_md5)."""
    text = F.md5(docs["text"].cast("binary"))
    return docs["doc_id"].cast("long").eqNullSafe(keys["key_id"]) & text.eqNullSafe(keys["key_md5"])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and texts that are far from every language learned from `docs`."""
    ship_package(spark)
    found = langid.identify(docs, row=True)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("distance") <= FARTHEST)).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class, the one with the smallest doc_id (a null one last)."""
    ship_package(spark)
    classes = ordermin.near_classes(docs).filter("class_key is not null")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_md5")
    kept = classes.groupBy("class_key").agg(F.min(order).alias("it")).select(
        F.col("it.doc_id").alias("key_id"), F.col("it.text_md5").alias("key_md5"))
    named = docs.filter("text is not null").join(kept, _same_row(docs, kept), "left_semi")
    named = named.withColumn("_text_md5", F.md5(F.col("text").cast("binary"))).dropDuplicates(["doc_id", "_text_md5"])
    return named.drop("_text_md5").unionByName(docs.filter("text is null")).select(docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = latent.leaks(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("key_id"), F.col("text_md5").alias("key_md5")).distinct()
    return docs.join(found, _same_row(docs, found), "left_anti").select(docs.columns)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; n_chars is the length of the text that is left."""
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every document that is left."""
    ship_package(spark)
    return bpe.digests(docs, vocabulary())


STAGES = [
    ("language", language), ("near_copies", near_copies), ("benchmark_leaks", benchmark_leaks),
    ("secret_spans", secret_spans), ("tokens", tokens)]

#: Language, near-copy and leak decisions are models and searches, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written below the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
