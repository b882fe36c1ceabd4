"""Ordered computations without a global sort in one task: prefix sums, exact order statistics, row at rank.

Rows are first collapsed to one per distinct value. If the values may exceed what one task should
sort, approximate quantiles cut the axis into buckets of similar size; buckets are scanned on their
own and shifted by the totals of the buckets before them (at most MAX_BUCKETS rows).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.session import checkpointed

ROWS_PER_TASK = 2_000_000
MAX_BUCKETS = 4096
RANK_CELLS = 4096
LAST_STEP_ROWS = 20_000


@dataclass
class Axis:
    """How a double column is cut into buckets; no splits means a single bucket."""

    column: str
    splits: list[float]

    def assign(self, df: DataFrame, out: str = "_bucket") -> DataFrame:
        if not self.splits:
            return df.withColumn(out, F.lit(0))
        cut = Bucketizer(splits=[-math.inf, *self.splits, math.inf], inputCol=self.column, outputCol=out,
                         handleInvalid="keep")
        return cut.transform(df).withColumn(out, F.col(out).cast("int"))


def make_axis(df: DataFrame, column: str, rows_per_task: int = ROWS_PER_TASK, rows: int | None = None) -> Axis:
    """Choose buckets for `column` from the number of rows; small inputs keep one bucket."""
    rows = df.count() if rows is None else rows
    buckets = min(MAX_BUCKETS, math.ceil(rows / rows_per_task))
    if buckets <= 1:
        return Axis(column, [])
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.stat.approxQuantile(column, probs, 1.0 / (4 * buckets))
    return Axis(column, sorted({float(c) for c in cuts}))


def running_totals(grouped: DataFrame, axis: Axis, columns: Sequence[str], descending: bool = False,
                   by: Sequence[str] = ()) -> DataFrame:
    """Add `cum_<column>`: totals over all rows up to and including this one, in axis order.

    `grouped` holds one row per value of the axis column (and per `by` group).
    """
    order = F.desc(axis.column) if descending else F.asc(axis.column)
    rows = axis.assign(grouped)
    local = Window.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({f"cum_{c}": F.sum(c).over(local) for c in columns})
    if axis.splits:
        bucket_order = F.desc("_bucket") if descending else F.asc("_bucket")
        earlier = Window.partitionBy(*by).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
        totals = rows.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in columns])
        shift = totals.select(*by, "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}")
                                                for c in columns])
        # Without groups the offsets are one row per bucket; with groups their number is not known.
        if by:
            names = [*by, "_bucket"]
            shift = shift.withColumnsRenamed({c: f"_s_{c}" for c in names})
            same = [out[c].eqNullSafe(F.col(f"_s_{c}")) for c in names]
            out = out.join(shift, same).drop(*[f"_s_{c}" for c in names])
        else:
            out = out.join(F.broadcast(shift), "_bucket")
        out = out.withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"_o_{c}") for c in columns})
        out = out.drop(*[f"_o_{c}" for c in columns])
    return out.drop("_bucket")


def values_at_ranks(df: DataFrame, column: str, ranks: Sequence[int], rows: int,
                    rows_per_task: int = ROWS_PER_TASK) -> dict[int, float]:
    """Exact order statistics (0-based ranks) of the non-null values of a double column.

    Only the requested values reach the driver.
    """
    ranks = sorted(set(ranks))
    known = df.select(F.col(column).alias("v"))
    axis = make_axis(known, "v", rows_per_task, rows)
    counts = known.groupBy("v").agg(F.count("*").alias("n"))
    if axis.splits:
        # Only buckets that hold a wanted rank are scanned further.
        totals = {int(r["_bucket"]): r["n"] for r in
                  axis.assign(counts).groupBy("_bucket").agg(F.sum("n").alias("n")).collect()}
        start, wanted = 0, {}
        for bucket in sorted(totals):
            inside = [r for r in ranks if start <= r < start + totals[bucket]]
            if inside:
                wanted[bucket] = (start, inside)
            start += totals[bucket]
        spark = df.sparkSession
        plan = spark.createDataFrame([(b, s, r) for b, (s, r) in wanted.items()],
                                     "_bucket int, _start long, _ranks array<long>")
        counts = axis.assign(counts).join(F.broadcast(plan), "_bucket")
        local = Window.partitionBy("_bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.sum("n").over(local) + F.col("_start")
    else:
        counts = counts.withColumn("_ranks", F.array(*[F.lit(r).cast("long") for r in ranks]))
        upto = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", upto.cast("double")).withColumn("_from", F.col("_upto") - F.col("n"))
    # A binary search in the rank list finds the few rows that cover a rank.
    search = Bucketizer(splitsArray=[[-math.inf, *map(float, ranks), math.inf]] * 2, inputCols=["_from", "_upto"],
                        outputCols=["_rank_from", "_rank_upto"])
    shifted = placed.withColumns({"_from": F.col("_from") - 0.5, "_upto": F.col("_upto") - 0.5})
    hits = search.transform(shifted).filter(F.col("_rank_upto") > F.col("_rank_from")).select(
        "v", F.explode(F.filter("_ranks", lambda r: (r < F.col("_upto")) & (r >= F.col("_from")))).alias("rank"))
    return {row["rank"]: row["v"] for row in hits.collect()}


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                    rows_per_task: int = ROWS_PER_TASK) -> list[float]:
    """Quantiles with linear interpolation between order statistics; NaN when there are no values."""
    known = df.filter(F.col(column).isNotNull() & ~F.isnan(column))
    rows = known.count()
    if rows == 0:
        return [math.nan] * len(probs)
    places = [(rows - 1) * q for q in probs]
    below = [min(int(math.floor(p)), rows - 1) for p in places]
    found = values_at_ranks(known, column, [r for b in below for r in (b, min(b + 1, rows - 1))], rows, rows_per_task)
    out = []
    for place, low in zip(places, below):
        a, b, t = found[low], found[min(low + 1, rows - 1)], place - low
        out.append(a + (b - a) * t if t < 0.5 else b - (b - a) * (1.0 - t))
    return out


def nearest_rank(rows: int, pct: float) -> int:
    """0-based position of a nearest-rank percentile, kept inside the list."""
    return min(max(round(pct / 100.0 * rows + 0.5) - 1, 0), rows - 1)


def row_at_rank(df: DataFrame, first: str, second: str, rank: int) -> tuple[int, int]:
    """The (first, second) pair at a 0-based rank in lexicographic order; both are long columns.

    Each step counts rows in at most RANK_CELLS ranges and keeps the one range that holds the rank,
    so nothing is sorted until a few thousand rows are left.
    """
    rows = df.select(first, second)
    for column in (first, second):
        low, high = rows.agg(F.min(column), F.max(column)).first()
        while True:
            width = max(1, -(-(high - low + 1) // RANK_CELLS))
            cell = F.expr(f"(`{column}` - ({low}L)) div {width}L")
            counts = sorted((r["cell"], r["n"]) for r in
                            rows.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect())
            for at, n in counts:
                if rank < n:
                    break
                rank -= n
            low, high = low + at * width, min(high, low + (at + 1) * width - 1)
            rows = rows.filter(F.col(column).between(low, high))
            if n <= LAST_STEP_ROWS:
                found = rows.orderBy(first, second).limit(rank + 1).collect()[rank]
                return found[0], found[1]
            if width == 1:
                break
    return rows.first()[0], rows.first()[1]


def before(first: str, second: str, cut: tuple[int, int]) -> Column:
    """Rows in front of the pair `cut`."""
    return (F.col(first) < F.lit(cut[0])) | ((F.col(first) == F.lit(cut[0])) & (F.col(second) < F.lit(cut[1])))


def numbered(df: DataFrame, *by: str, name: str = "_number") -> DataFrame:
    """`df` with the place of each row in the order of `by`, from 0 and without gaps; sorted by ranges, one count per range."""
    spot = checkpointed(df.orderBy(*by).withColumns({"_spot": F.monotonically_increasing_id(), "_range": F.spark_partition_id()}))
    counts = sorted((r["_range"], r["count"]) for r in spot.groupBy("_range").count().collect())
    offsets, total = [], 0
    for range_, count in counts:
        offsets.append((range_, total))
        total += count
    # One row per range that holds rows.
    table = df.sparkSession.createDataFrame(offsets, "_range int, _offset long")
    within = F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1))
    return spot.join(F.broadcast(table), "_range").withColumn(name, F.col("_offset") + within).drop("_range", "_offset", "_spot")
