"""Shards by jump consistent hashing, with SQL expressions only.

A row's shard follows from its doc_id and the number of shards alone: a 64-bit generator seeded with the id
jumps to ever later shard numbers and the last one below the count is the shard. With one more shard a row
either stays or moves to the new one. No ring or table of shards exists.

SQL integers may not overflow, so the generator's state is kept in limbs of 22, 22 and 20 bits.

Slots number a shard's rows from 0 without gaps, in the order of doc_id, text_crc32 and size (nulls first).
Rows are ranged over this order with a tie-breaker, so that neither a repeated id nor a large shard becomes one
task: a slot is the number of the shard's rows in earlier ranges plus the place in its own range.

Defined results: a null text has size 1 and the checksum of an empty text; a null doc_id is placed as id 0.
Rows that repeat an id share its shard, and fully equal rows get consecutive slots. Equal texts have no
influence: the law is `key`. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.session import checkpointed

SHARDS = 8
RANGE_ROWS = 200_000  # rows numbered by one task
# The generator of the published algorithm.
_MULTIPLIER = 2_862_933_555_777_941_757
_LIMB = (1 << 22) - 1


def _limbs(value: int) -> tuple[int, int, int]:
    return value & _LIMB, value >> 22 & _LIMB, value >> 44


def jump_shard(key: Column, shards: int) -> Column:
    """The shard (0 to shards - 1) of a 64-bit key."""
    m0, m1, m2 = (F.lit(x).cast("long") for x in _limbs(_MULTIPLIER))

    def step(state: Column, i: Column) -> Column:
        k0, k1, k2, last, ahead = (state[x] for x in ("k0", "k1", "k2", "last", "ahead"))
        low = k0 * m0 + 1
        middle = k0 * m1 + k1 * m0 + F.shiftright(low, 22)
        high = k0 * m2 + k1 * m1 + k2 * m0 + F.shiftright(middle, 22)
        n0, n1, n2 = low.bitwiseAND(_LIMB), middle.bitwiseAND(_LIMB), high.bitwiseAND((1 << 20) - 1)
        top = n2 * 2048 + F.shiftright(n1, 11)  # the highest 31 bits of 64
        going = ahead < shards
        jump = F.floor((ahead + 1).cast("double") * (F.lit(float(1 << 31)) / (top + 1).cast("double")))
        return F.struct(
            n0.alias("k0"), n1.alias("k1"), n2.alias("k2"), F.when(going, ahead).otherwise(last).alias("last"),
            F.when(going, jump).otherwise(ahead).alias("ahead"))

    start = F.struct(
        key.bitwiseAND(_LIMB).alias("k0"), F.shiftrightunsigned(key, 22).bitwiseAND(_LIMB).alias("k1"),
        F.shiftrightunsigned(key, 44).alias("k2"), F.lit(-1).cast("long").alias("last"), F.lit(0).cast("long").alias("ahead"))
    # Every jump goes on by one shard at least, so `shards` jumps are enough; those after the last change nothing.
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["last"].cast("int"))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of `docs` (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    key = F.coalesce("doc_id", F.lit(0).cast("long"))
    slim = checkpointed(slim.select(
        "doc_id", "size", "text_crc32", jump_shard(key, shards).alias("shard"), jump_shard(key, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("tie")))
    order = ["doc_id", "text_crc32", "size", "tie"]
    ranges = max(1, -(-slim.count() // RANGE_ROWS))
    ranged = checkpointed(slim.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("shard", "range").agg(F.count("*").alias("n")).select(
        "shard", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("range", "shard").orderBy(*order))
    return ranged.withColumn("place", place).join(before, ["range", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("before") + F.col("place") - 1).cast("long").alias("slot"), "grown_shard")


def crc_sql(text: str) -> str:
    """DuckDB SQL for the CRC-32 of a text's UTF-8 bytes."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::bigint)"
    return (f"xor(list_reduce({data}, lambda c, b: xor(c >> 8, list_extract(steps, (xor(c, b) & 255) + 1)), "
            "4294967295::bigint), 4294967295)")


def assign_sql(shards: int = SHARDS) -> str:
    """DuckDB SQL for `assign`."""
    steps = ("crc as (select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) "
             "else c >> 1 end, i) order by i) as steps from range(256) t(i))")
    sized = ("j0 as (select doc_id, strlen(coalesce(text, '')) + 1 as size, "
             f"{crc_sql("coalesce(text, '')")} as text_crc32, "
             "case when coalesce(doc_id, 0) < 0 then coalesce(doc_id, 0)::hugeint + 18446744073709551616::hugeint "
             "else coalesce(doc_id, 0)::hugeint end as k, 0::bigint as j, [0::bigint] as js from documents, crc)")
    jumps = []
    for i in range(1, shards + 2):
        key = f"((k * {_MULTIPLIER}::hugeint + 1) % 18446744073709551616::hugeint)"
        ahead = f"least(floor((j + 1)::double * (2147483648.0::double / (({key} // 8589934592::hugeint) + 1)::double)), 1e6)::bigint"
        jumps.append(f"j{i} as (select doc_id, size, text_crc32, {key} as k, {ahead} as j, list_append(js, {ahead}) as js from j{i - 1})")
    return (f"with {steps}, {sized}, {', '.join(jumps)}, placed as (select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, "
            f"list_max(list_filter(js, lambda x: x < {shards}))::int as shard, "
            f"list_max(list_filter(js, lambda x: x < {shards + 1}))::int as grown_shard from j{shards + 1}) "
            "select doc_id, size, text_crc32, 'key' as law, shard, (row_number() over (partition by shard "
            "order by doc_id nulls first, text_crc32, size) - 1)::bigint as slot, grown_shard from placed")
