"""Time chunks for keys that hold too many rows for one task.

A history window is a prefix computation per key. A key with more rows than a task should take
would pin that prefix to a single task, so its rows are cut into consecutive chunks; each chunk is
scanned on its own and receives the totals of the chunks before it. Ordinary keys keep one chunk.
What counts as hot is an absolute number of rows, so the number of hot keys grows with the data:
their tables are broadcast while there are few, and joined by shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.session import checkpointed

HOT_SHARE = 0.0  # a further, relative bound; none by default
BROADCAST_KEYS = 1000
MIN_HOT_ROWS = 1_000_000
CELLS = 4096


class KeyChunks:
    """Chunk table of the hot keys, or none when every key fits a task."""

    COLUMNS = ("_t0", "_cell", "_chunks", "_fine")

    def __init__(self, key: str, table: DataFrame | None, keys: int = 0):
        self.key = key
        self.table = table
        self.keys = keys

    @property
    def any_hot(self) -> bool:
        return self.table is not None

    def sized(self, df: DataFrame) -> DataFrame:
        """A table of the hot keys' chunks, to be broadcast only while the keys are few."""
        return F.broadcast(df) if self.keys <= BROADCAST_KEYS else df

    def attach(self, df: DataFrame) -> DataFrame:
        """Add the chunk table's columns for `chunk_of`."""
        return df.join(self.sized(self.table), self.key, "left")

    @staticmethod
    def chunk_of(order: Column) -> Column:
        """Chunk of an order value; monotone in it, equal values share a chunk."""
        cell = F.floor((order - F.col("_t0")) / F.col("_cell")).cast("int")
        bounded = F.least(F.greatest(cell, F.lit(0)), F.lit(CELLS - 1))
        passed = F.filter(F.col("_fine")[bounded], lambda b: b["_start"] <= order)
        return F.coalesce(F.try_element_at(passed, F.lit(-1))["_chunk"], F.get(F.col("_chunks"), bounded), F.lit(0))


def _burst_bounds(rows: DataFrame, heavy: DataFrame, key: str, order: str, limit: int) -> DataFrame | None:
    """(key, _at, _start, _chunk): chunks that begin inside time cells of more than `limit` rows.

    `heavy` (key, _at, _low, _width, _prev) lists these cells and how many rows of the key lie before them. Each
    turn counts the rows of open cells in CELLS parts; parts that are still too large are opened next, until one
    order value is left. A turn divides the width by CELLS, so a few turns reach microseconds.
    """
    rows, found = rows.select(key, order, "_at"), None
    part = ["_at", "_low", "_width", "_prev"]
    opened = checkpointed(heavy)
    while not opened.isEmpty():
        finer = F.greatest(F.ceil(F.col("_width") / F.lit(CELLS)), F.lit(1)).cast("long")
        ends = F.broadcast(opened) if opened.count() <= BROADCAST_KEYS else opened
        inside = rows.join(ends, [key, "_at"]).filter(
            (F.col(order) >= F.col("_low")) & (F.col(order) < F.col("_low") + F.col("_width")))
        counts = inside.groupBy(key, *part, F.floor((F.col(order) - F.col("_low")) / finer).alias("_sub")).agg(F.count("*").alias("_n"))
        # At most CELLS rows per open cell.
        upto = Window.partitionBy(key, "_at", "_low").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
        cut = checkpointed(counts.select(
            key, "_at", (F.col("_low") + F.col("_sub") * finer).alias("_low"), finer.alias("_width"),
            (F.col("_prev") + F.coalesce(F.sum("_n").over(upto), F.lit(0))).alias("_prev"), "_n"))
        bounds = cut.select(key, "_at", F.col("_low").alias("_start"), F.floor(F.col("_prev") / F.lit(limit)).cast("int").alias("_chunk"))
        found = bounds if found is None else found.unionByName(bounds)
        opened = cut.filter((F.col("_n") > limit) & (F.col("_width") > 1)).drop("_n")
    # The first start of each chunk is enough.
    return None if found is None else found.groupBy(key, "_at", "_chunk").agg(F.min("_start").alias("_start"))


def find_chunks(df: DataFrame, key: str, order: str,
                hot_share: float = HOT_SHARE, min_hot_rows: int = MIN_HOT_ROWS) -> KeyChunks:
    """Look for hot keys of `df` and cut them by the long column `order`.

    A chunk of a hot key holds at most twice the limit, also in a burst; only rows of one order value stay together.
    """
    counts = df.groupBy(key).count()
    total, most = counts.agg(F.sum("count"), F.max(F.when(F.col(key).isNotNull(), F.col("count")))).first()
    limit = max(min_hot_rows, int((total or 0) * hot_share))
    if (most or 0) <= limit:
        return KeyChunks(key, None)
    hot = checkpointed(counts.filter((F.col("count") > limit) & F.col(key).isNotNull()).select(key))
    keys = hot.count()
    few = (lambda t: F.broadcast(t)) if keys <= BROADCAST_KEYS else (lambda t: t)
    hot_rows = df.select(key, order).join(few(hot), key)
    span = hot_rows.groupBy(key).agg(F.min(order).alias("_t0"), F.max(order).alias("_t1")).select(
        key, "_t0",
        F.greatest(F.ceil((F.col("_t1") - F.col("_t0") + 1) / F.lit(CELLS)), F.lit(1)).cast("long").alias("_cell"))
    cell_of = F.floor((F.col(order) - F.col("_t0")) / F.col("_cell")).cast("int")
    placed = hot_rows.join(few(span), key).withColumn("_at", cell_of)
    filled = placed.groupBy(key, "_at").agg(F.count("*").alias("_n"))
    cells = span.select(key, F.explode(F.sequence(F.lit(0), F.lit(CELLS - 1))).alias("_at"))
    # At most CELLS rows per hot key from here on.
    running = Window.partitionBy(key).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    chunked = checkpointed(cells.join(filled, [key, "_at"], "left").withColumn(
        "_prev", F.coalesce(F.sum("_n").over(running), F.lit(0))))
    chunk = F.floor(F.col("_prev") / F.lit(limit)).cast("int").alias("_chunk")
    dense = chunked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_at", chunk))).alias("_p")).select(
        key, F.transform("_p", lambda s: s["_chunk"]).alias("_chunks"))
    heavy = chunked.filter((F.col("_n") > limit)).join(few(span), key).filter("_cell > 1").select(
        key, "_at", (F.col("_t0") + F.col("_at") * F.col("_cell")).alias("_low"), F.col("_cell").alias("_width"), "_prev")
    bounds = _burst_bounds(placed, heavy, key, order, limit)
    table = span.join(dense, key)
    if bounds is None:
        table = table.withColumn("_fine", F.lit(None).cast("map<int,array<struct<_start:bigint,_chunk:int>>>"))
    else:
        # As many bounds as a cell has chunks.
        per_cell = bounds.groupBy(key, "_at").agg(F.array_sort(F.collect_list(F.struct("_start", "_chunk"))).alias("_b"))
        fine = per_cell.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_at", "_b"))).alias("_fine"))
        table = table.join(fine, key, "left")
    # Read by several parts of a plan: written once.
    return KeyChunks(key, checkpointed(table), keys)
