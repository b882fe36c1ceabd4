"""Nearest neighbours by a permutation index.

Every vector is represented by its nearest pivots in order of nearness. The rows are dealt into blocks, and each
block posts its vectors in one inverted file per pivot, with the pivot's place in the vector's order. A query
reads the files of its own pivots, ranks the block's vectors by the footrule distance of the two orders (a pivot
that a vector does not order counts as the last), and reranks the best share of the block by the Euclidean
distance in double precision. All vectors are indexed; only the pivots are a sample (256 vectors, those with the
smallest hashes of their ids). README gives the recall measured against brute force.

Equal vectors are one entry with their smallest ids, so copies of any number cost no more than one. Blocks of
queries meet blocks of rows, so a task holds one bounded block of each, whatever the tables' sizes.

Defined results: vectors that are null, zero or hold null or non-finite components take no part, nor do rows
without an id. Vectors are compared with those of their own length only. Repeated rows count once; a vec_id with
several vectors is as near as the nearest of them, and as a query it stands for each of them. Ties go to the
smaller vec_id. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.session import checkpointed

NEIGHBOURS = 10
PIVOTS = 256
ORDERED = 192  # pivots in a vector's order
BLOCK = 16_384  # rows of a block
ASKED = 4_096  # queries of a block
RERANKED = 0.2  # share of a block that is measured exactly, and no fewer than this many:
LEAST_RERANKED = 4_096


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, each once; `vectors` has vec_id and embedding."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & whole & F.exists("v", lambda x: x != 0)).distinct()


def _orders(vectors: np.ndarray, pivots: np.ndarray, size: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first; ties go to the smaller number."""
    norm = (pivots * pivots).sum(axis=1)
    out = np.empty((len(vectors), size), np.int16)
    for lo in range(0, len(vectors), 1024):
        far = norm - 2 * (vectors[lo : lo + 1024] @ pivots.T)
        if size < len(pivots):
            near = np.sort(np.argpartition(far, size - 1, axis=1)[:, :size], axis=1)
        else:
            near = np.broadcast_to(np.arange(len(pivots)), far.shape)
        order = np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable")
        out[lo : lo + 1024] = np.take_along_axis(near, order, axis=1)
    return out


def _vectors(table: pa.Table) -> np.ndarray:
    flat = pa.concat_arrays([x.flatten() for x in table.column("v").chunks])
    return flat.to_numpy().reshape(len(table), -1)


class _Files:
    """The inverted files of one block."""

    def __init__(self, near: np.ndarray, pivots: int):
        order = np.argsort(near, axis=None, kind="stable")
        self.row, self.place = np.divmod(order, near.shape[1])
        self.end = np.cumsum(np.bincount(near.ravel(), minlength=pivots))
        self.rows, self.size = near.shape

    def footrule(self, near: np.ndarray) -> np.ndarray:
        """The distance of each row's order to the given one, over the pivots of the latter."""
        total = np.full(self.rows, int((self.size - np.arange(self.size)).sum()))
        for rank, pivot in enumerate(near.tolist()):
            part = slice(int(self.end[pivot - 1]) if pivot else 0, int(self.end[pivot]))
            total[self.row[part]] += np.abs(self.place[part] - rank) - (self.size - rank)
        return total


def _meet(pivots: np.ndarray):
    """Within a block: the nearest of the best ranked rows to each query."""
    size = min(ORDERED, len(pivots))

    def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
        keys, ids, scores = [], [], []
        if len(rows) and len(queries):
            rows = rows.sort_by("key")
            v, asked = _vectors(rows), _vectors(queries)
            files = _Files(_orders(v, pivots, size), len(pivots))
            lists = pa.concat_arrays(rows.column("ids").chunks)
            count = np.asarray(lists.value_lengths())
            start, flat = np.cumsum(count) - count, lists.flatten().to_numpy()
            wanted = max(LEAST_RERANKED, math.ceil(RERANKED * len(v)))
            for key, q, near in zip(queries.column("key").to_pylist(), asked, _orders(asked, pivots, size)):
                foot = files.footrule(near) * len(v) + np.arange(len(v))  # ties: the smaller id
                best = np.argpartition(foot, wanted - 1)[:wanted] if wanted < len(v) else np.arange(len(v))
                far = np.sqrt(((v[best] - q) ** 2).sum(axis=1))
                kept = far <= np.partition(far, NEIGHBOURS)[NEIGHBOURS] if len(far) > NEIGHBOURS + 1 else slice(None)
                best, far = best[kept], far[kept]
                every = np.concatenate([flat[start[i] : start[i] + count[i]] for i in best])
                far = np.repeat(far, count[best])
                order = np.lexsort((every, far))[: NEIGHBOURS + 1]
                keys.append(np.full(len(order), key))
                ids.append(every[order])
                scores.append(far[order])
        none = np.zeros(0, np.int64)
        return pa.table({
            "key": pa.array(np.concatenate(keys or [none]), pa.int64()),
            "vec_id": pa.array(np.concatenate(ids or [none]), pa.int64()),
            "score": pa.array(np.concatenate(scores or [np.zeros(0)]), pa.float64())})
    return meet


_FOUND = "key long, vec_id long, score double"


def _grouped(rows: DataFrame) -> DataFrame:
    """(key, ids, v): each distinct vector once, with its smallest ids, one more than are ever needed."""
    by = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(by)).filter(F.col("n") <= NEIGHBOURS + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.element_at("ids", 1).alias("key"), "ids", "v")


def _search(entries: DataFrame, n: int, queries: DataFrame, asked: int, pivots: np.ndarray) -> DataFrame:
    """(key, vec_id, score): the nearest found for each distinct query vector, at most one more than asked for."""
    blocks, query_blocks = -(-n // BLOCK), -(-asked // ASKED)

    def dealt(block_count: int):
        return F.pmod(F.xxhash64("key"), F.lit(block_count)).cast("int")

    def every(block_count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(block_count - 1)))

    left = entries.select("key", "ids", "v", dealt(blocks).alias("block"), every(query_blocks).alias("query_block"))
    right = queries.select("key", "v", every(blocks).alias("block"), dealt(query_blocks).alias("query_block"))
    by = ("block", "query_block")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_meet(pivots), _FOUND)
    found = found.groupBy("key", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("key").orderBy("score", "vec_id")
    return found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= NEIGHBOURS + 1).drop("n")


def nearest(vectors: DataFrame, is_query) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for the rows of `vectors` that `is_query` selects."""
    rows = checkpointed(usable(vectors))
    lengths = sorted(x.n for x in rows.select(F.size("v").alias("n")).distinct().collect())
    out = None
    for length in lengths:
        part = _nearest_of(rows.filter(F.size("v") == length) if len(lengths) > 1 else rows, is_query)
        out = part if out is None else out.union(part)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return out


def _nearest_of(rows: DataFrame, is_query) -> DataFrame:
    entries = checkpointed(_grouped(rows))
    sample = entries.select("v", F.xxhash64("key").alias("h"), "key").orderBy("h", "key").limit(PIVOTS)
    pivots = np.asarray([x.v for x in sample.collect()], np.float64)
    # Query ids by vector; copies are searched once, under the smallest of their ids.
    named = rows.filter(is_query)
    queries = checkpointed(named.groupBy("v").agg(F.min("vec_id").alias("key")))
    named = named.join(queries, "v").select("key", F.col("vec_id").alias("query_id"))
    asked = queries.count()
    if not asked:
        return named.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = checkpointed(_search(entries, entries.count(), queries, asked, pivots))
    pairs = named.join(found, "key").filter("query_id != vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEIGHBOURS).select(
        "query_id", "rank", "vec_id", "score")
