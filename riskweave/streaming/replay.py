"""The online features computed over a finished table, for backfills and to check the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskweave.functions import scalar
from riskweave.operators import keyed_chunks
from riskweave.streaming.online import COLD_START_GAP_H, MAX_HISTORY, WINDOWS_S, valid_input, with_clock

BLOCK_ROWS = 100_000


def _blocks(rows: DataFrame, key: str, max_history: int, block_rows: int, chunks: keyed_chunks.KeyChunks) -> DataFrame:
    """Cut cards into runs of `block_rows` rows, each preceded by the `max_history` rows before it."""
    rows = chunks.attach(rows).withColumn("_chunk", chunks.chunk_of(F.col("clock_s"))).drop(*chunks.COLUMNS)
    in_chunk = Window.partitionBy(key, "_chunk").orderBy("clock_s", "trans_num")
    # Cards with one chunk have no offset.
    sizes = rows.groupBy(key, "_chunk").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.sum("_n").over(upto)).filter("_start is not null").drop("_n")
    ranked = rows.withColumn("_at", F.row_number().over(in_chunk) - 1).join(chunks.sized(starts), [key, "_chunk"], "left")
    ranked = ranked.withColumn("_at", F.col("_at") + F.coalesce("_start", F.lit(0)))
    block = F.floor(F.col("_at") / block_rows).cast("int")
    near_end = F.col("_at") % block_rows >= block_rows - max_history
    spread = F.explode(F.when(near_end, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_halo")
    return ranked.select("*", block.alias("_b"), spread).withColumn("_block", F.col("_b") + F.col("_halo")).drop("_at", "_start", "_b", "_chunk")


def replay(transactions: DataFrame, key: str = "cc_num", max_history: int = MAX_HISTORY, block_rows: int = BLOCK_ROWS,
           hot_share: float = keyed_chunks.HOT_SHARE, min_hot_rows: int = keyed_chunks.MIN_HOT_ROWS,
           digits: int | None = 2) -> DataFrame:
    """(trans_num, online features, cold_start), cards in (time, id) order, no expiry."""
    rows = with_clock(transactions).filter(valid_input()).select("trans_num", key, "clock_s", "amt", "merch_lat", "merch_long")
    chunks = keyed_chunks.find_chunks(rows, key, "clock_s", hot_share, min_hot_rows)
    if chunks.any_hot:
        rows = _blocks(rows, key, max_history, max(block_rows, max_history), chunks)
    else:
        rows = rows.withColumns({"_block": F.lit(0), "_halo": F.lit(0)})
    ordered = Window.partitionBy(key, "_block").orderBy("clock_s", "trans_num")
    out = rows.withColumns({
        "_past": F.collect_list(F.struct("clock_s", "amt")).over(ordered.rowsBetween(-max_history, -1)),
        "_prev": F.lag(F.struct("clock_s", "merch_lat", "merch_long")).over(ordered),
    }).filter("_halo = 0")
    now = F.col("clock_s")

    def inside(width: int):
        return F.filter("_past", lambda t: (now - t["clock_s"] >= 0) & (now - t["clock_s"] <= width))

    def total(width: int):
        return F.aggregate(inside(width), F.lit(0.0), lambda acc, t: acc + t["amt"])

    km = scalar.haversine_km("_prev.merch_lat", "_prev.merch_long", "merch_lat", "merch_long")
    gap = F.greatest((now - F.col("_prev.clock_s")) / F.lit(3600.0), F.lit(0.0))
    cold = F.size("_past") == 0
    cut = (lambda c: F.bround(c, digits)) if digits is not None else (lambda c: c)
    out = out.withColumns({"_km": km, "_gap": gap})
    return out.select(
        "trans_num", F.size(inside(WINDOWS_S[0])).cast("long").alias("txn_count_1h"),
        F.size(inside(WINDOWS_S[1])).cast("long").alias("txn_count_24h"),
        cut(total(WINDOWS_S[0])).alias("txn_amount_1h"), cut(total(WINDOWS_S[1])).alias("txn_amount_24h"),
        F.when(cold, 0.0).otherwise(cut(F.col("_km"))).alias("dist_from_prev_km"),
        F.when(cold, COLD_START_GAP_H).otherwise(cut(F.col("_gap"))).alias("time_since_prev_h"),
        F.when(cold, 0.0).otherwise(cut(F.col("_km") / F.greatest("_gap", F.lit(scalar.MIN_GAP_H)))).alias("speed_kmh"),
        cold.alias("cold_start"))
