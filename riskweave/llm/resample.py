"""Quality sampling by importance weights of hashed n-gram models.

Two generative models of hashed word and mark 1- and 2-grams are counted: one over all documents (raw), one over
the documents that the labels call good (target). A document's log weight is the sum over its n-grams of
log p_target - log p_raw. Adding Gumbel noise, a hash of the id, and keeping the k largest draws k documents
without replacement in proportion to their weights. k is the share of good rows among all labelled rows, times
the number of documents with any n-gram.

The target model may be fitted on a bounded sample: at most TARGET_ROWS labelled ids, those with the smallest
hashes. Raw counts, the share and the threshold cover all rows. The target is mixed with a tenth of the raw
model, so that a word unseen in the target costs a bounded amount.

Defined results: a null text or one without any token has no n-gram, weight and key are null and it is not
selected. Without labels every other document is selected. Rows whose key equals the k-th largest are all
selected, so repeated rows fare alike. Conflicting labels of one id count as good if any does. A null doc_id has
a weight and takes part with one common noise. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.words import combine, hash_words
from riskweave.session import checkpointed

BUCKETS = 1 << 15
RAW_SHARE = 0.1
TARGET_ROWS = 20_000
SEED = 11
CELLS = 4096
LAST_ROWS = 10_000  # keys sorted on the driver at the end of the threshold search


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of all 1- and 2-grams, by text."""
    hashes, offsets = hash_words(texts, marks=True)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    pairs = combine(hashes, 2)
    inside = owner[1:] == owner[:-1] if len(owner) > 1 else np.zeros(0, bool)
    bucket = np.concatenate((hashes, pairs[inside])) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate((owner, owner[:-1][inside] if len(owner) > 1 else owner[:0]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for lo in range(0, len(batch), 128):
            part = batch.slice(lo, 128)
            bucket, owner = _grams(part.column("text").to_pylist())
            raw += np.bincount(bucket, minlength=BUCKETS)
            good = part.column("good").to_numpy(zero_copy_only=False).astype(bool)
            target += np.bincount(bucket[good[owner]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, good_ids: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of every bucket; `good_ids` (doc_id, at most TARGET_ROWS rows) is broadcast."""
    flagged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(good_ids.withColumn("good", F.lit(True))), "doc_id", "left").select(
        "text", F.coalesce("good", F.lit(False)).alias("good"))
    rows = flagged.mapInArrow(_count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows.column("bucket").to_numpy()] = rows.column("raw").to_numpy()
    target[rows.column("bucket").to_numpy()] = rows.column("target").to_numpy()
    if not target.sum():
        return np.zeros(BUCKETS)
    p_raw = (raw + 1) / (raw + 1).sum()
    return np.log((1 - RAW_SHARE) * target / target.sum() + RAW_SHARE * p_raw) - np.log(p_raw)


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, n_grams, log_weight) of every row of `docs` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 128):
                part = batch.slice(lo, 128)
                bucket, owner = _grams(part.column("text").to_pylist())
                n = np.bincount(owner, minlength=len(part))
                weight = np.bincount(owner, ratios[bucket], minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(weight, pa.float64(), mask=n == 0)],
                    ["doc_id", "n_grams", "log_weight"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_grams long, log_weight double")


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest non-null value, exactly, by narrowing a histogram; None if there are fewer."""
    values = df.select(F.col(column).alias("x")).filter("x is not null")
    low, high, n = values.agg(F.min("x"), F.max("x"), F.count("*")).first()
    if k < 1 or n < k:
        return None
    while n > LAST_ROWS and low < high:
        width = (high - low) / CELLS
        cell = F.least(F.floor((F.col("x") - low) / width), F.lit(CELLS - 1))
        inside = values.filter((F.col("x") >= low) & (F.col("x") <= high))
        rows = sorted(inside.groupBy(cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect(), reverse=True)
        for row in rows:
            if row.n >= k:
                n, low, high = row.n, row.low, row.high
                break
            k -= row.n
        if width == 0:
            break
    if low == high:
        return low
    last = values.filter((F.col("x") >= low) & (F.col("x") <= high)).orderBy(F.desc("x")).limit(k).collect()
    return last[-1].x


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_grams, log_weight, key, selected) for every row of `docs`; `labels` has doc_id and quality."""
    labelled = labels.filter("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("quality") > 0).alias("is_good"))
    share = labelled.agg(F.avg(F.col("is_good").cast("double"))).first()[0]
    good = labelled.filter("is_good").select("doc_id").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(TARGET_ROWS)
    scored = weigh(docs, log_ratios(docs, good))
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED)), 11).cast("double") + 0.5) / float(1 << 53)
    scored = checkpointed(scored.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))))
    any_gram = scored.filter("n_grams > 0").count()
    least = kth_largest(scored, "key", round(any_gram * (1.0 if share is None else share)))
    chosen = F.lit(False) if least is None else F.coalesce(F.col("key") >= F.lit(least), F.lit(False))
    return scored.withColumn("selected", chosen)
