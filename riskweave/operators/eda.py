"""Exploratory aggregates over transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweave.functions.scalar import clip, hour_of_day, nan_to_null
from riskweave.operators.ordered import ROWS_PER_TASK, exact_quantiles, make_axis, nearest_rank, running_totals, values_at_ranks


def missing_audit(df: DataFrame) -> DataFrame:
    """One row per column: missing count and percentage, from one pass. NaN counts as missing."""
    names, fractional = df.columns, {n for n, k in df.dtypes if k in ("double", "float")}

    def missing(c: str):
        return F.col(c).isNull() | F.isnan(c) if c in fractional else F.col(c).isNull()

    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(missing(c)).alias(c) for c in names])
    long = counted.unpivot("_rows", names, "column_name", "missing")
    return long.select("column_name", "missing", F.round(F.col("missing") * 100.0 / F.col("_rows"), 2).alias("missing_pct"))


def class_balance(df: DataFrame, target: str = "is_fraud", by: str = "fold") -> DataFrame:
    """Rows, positives, negatives and positive rate in percent per group and overall."""
    counts = df.groupBy(by).agg(F.count("*").alias("rows_n"), F.sum(target).alias("positives"))
    both = counts.unionByName(counts.agg(F.lit("all").alias(by), F.sum("rows_n").alias("rows_n"),
                                         F.sum("positives").alias("positives")))
    return both.withColumns({"negatives": F.col("rows_n") - F.col("positives"),
                             "rate_pct": F.col("positives") * 100.0 / F.col("rows_n")})


def class_ratio(df: DataFrame, target: str = "is_fraud") -> DataFrame:
    """Negatives per positive, with at least one positive assumed."""
    return df.agg((F.count_if(F.col(target) == 0) / F.greatest(F.count_if(F.col(target) == 1), F.lit(1))).alias("class_ratio"))


def describe(df: DataFrame, column: str = "amt", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Count, mean, spread, range and quartiles of `column`; NaN is missing."""
    df = df.select(nan_to_null(column).alias(column))
    q25, q50, q75 = exact_quantiles(df, column, [0.25, 0.5, 0.75], rows_per_task)
    return df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
                  F.min(column).alias("min"), F.max(column).alias("max")).withColumns(
        {"q25": F.lit(q25), "q50": F.lit(q50), "q75": F.lit(q75)})


def by_class(df: DataFrame, column: str = "amt", target: str = "is_fraud", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Mean, median, spread and range of `column` per class, for all classes in one plan; NaN is missing."""
    df = df.select(target, nan_to_null(column).alias(column))
    stats = df.groupBy(target).agg(F.count(column).alias("n"), F.avg(column).alias("mean"),
                                   F.stddev_samp(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max"))
    known = df.filter(F.col(column).isNotNull()).select(target, F.col(column).alias("_v"))
    axis = make_axis(known, "_v", rows_per_task)
    upto = running_totals(known.groupBy(target, "_v").agg(F.count("*").alias("_n")), axis, ["_n"], by=[target])
    sizes = stats.select(F.col(target).alias("_class"), F.col("n").alias("_all"))
    ranked = upto.join(sizes, upto[target].eqNullSafe(F.col("_class")))
    # The median lies halfway between the values at these two ranks, which are one for an odd count.
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    median = ranked.groupBy("_class").agg(
        ((F.min(F.when(F.col("cum__n") >= low, F.col("_v"))) + F.min(F.when(F.col("cum__n") >= high, F.col("_v")))) / 2.0).alias("median"))
    return stats.join(median, stats[target].eqNullSafe(F.col("_class")), "left").drop("_class")


def rate_by_hour(df: DataFrame, time_col: str = "trans_ts", target: str = "is_fraud") -> DataFrame:
    return df.groupBy(hour_of_day(time_col).alias("hour")).agg(
        (F.avg(target) * 100.0).alias("rate_pct"), F.count("*").alias("n"))


def top_hours(df: DataFrame, top: int = 5, **columns) -> DataFrame:
    return rate_by_hour(df, **columns).orderBy(F.desc("rate_pct"), "hour").limit(top)


def rate_by_value(df: DataFrame, column: str, target: str = "is_fraud", at_least: int = 0, top: int | None = None) -> DataFrame:
    """Positive rate and count per non-null value, best first; optional minimum count and head."""
    out = df.filter(F.col(column).isNotNull()).groupBy(column).agg((F.avg(target) * 100.0).alias("rate_pct"), F.count("*").alias("n"))
    if at_least:
        out = out.filter(F.col("n") >= at_least)
    out = out.orderBy(F.desc("rate_pct"), column)
    return out if top is None else out.limit(top)


def distinct_count(df: DataFrame, column: str = "merchant", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("distinct_n"))


def time_range(df: DataFrame, time_col: str = "trans_ts") -> DataFrame:
    """First and last second since the epoch, and the span in whole days."""
    lo, hi = F.unix_timestamp(F.min(time_col)), F.unix_timestamp(F.max(time_col))
    return df.agg(lo.alias("first_s"), hi.alias("last_s"), F.floor((hi - lo) / 86400).alias("span_days"))


def split_summary(df: DataFrame, time_col: str = "trans_ts", target: str = "is_fraud") -> DataFrame:
    width = len(df.columns) - 1
    return df.groupBy("fold").agg(
        F.count("*").alias("rows_n"), F.lit(width).alias("columns_n"),
        F.unix_timestamp(F.min(time_col)).alias("first_s"), F.unix_timestamp(F.max(time_col)).alias("last_s"),
        F.count_if(F.col(target) == 1).alias("positives"), F.count_if(F.col(target) == 0).alias("negatives"),
        (F.avg(target) * 100.0).alias("rate_pct"))


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None, shared_range: bool = False,
              density: bool = False) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed on the right; empty bins are listed.

    With `by`, each group has its own range unless `shared_range`. Density divides by n * width.
    """
    keys = [by] if by else []
    range_keys = [] if shared_range else keys
    known = df.filter(F.col(column).isNotNull() & ~F.isnan(column)).select(*keys, F.col(column).alias("_v"))
    spans = known.groupBy(*range_keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    spans = spans.select(*range_keys, (F.col("_lo") - F.when(flat, 0.5).otherwise(0.0)).alias("_lo"),
                         (F.col("_hi") + F.when(flat, 0.5).otherwise(0.0)).alias("_hi"))
    if range_keys:
        ranged = known.join(spans, range_keys)
    else:
        lo, hi = spans.select("_lo").scalar(), spans.select("_hi").scalar()
        ranged = known.withColumns({"_lo": lo, "_hi": hi})
    at = F.floor((F.col("_v") - F.col("_lo")) * F.lit(float(bins)) / (F.col("_hi") - F.col("_lo")))
    counts = ranged.groupBy(*keys, "_lo", "_hi", F.least(at, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    # From here on one row per group and bin.
    filled = counts.groupBy(*keys, "_lo", "_hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_m"), F.sum("n").alias("_total")).select(
        *keys, "_lo", "_hi", "_total", "_m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    n = F.coalesce(F.try_element_at("_m", "bin"), F.lit(0))
    out = [*[F.col(k) for k in keys], F.col("bin"), (F.col("_lo") + F.col("bin") * width).alias("left_edge"), n.alias("n")]
    if density:
        out.append((n / (F.col("_total") * width)).alias("density"))
    return filled.select(*out)


def clipped(df: DataFrame, column: str, low_pct: float = 1.0, high_pct: float = 99.0,
            rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Replace `column` by its values clipped to two of its percentiles."""
    low, high = exact_quantiles(df, column, [low_pct / 100.0, high_pct / 100.0], rows_per_task)
    return df.withColumn(column, clip(column, low, high))


def latency_summary(log: DataFrame, column: str = "latency_ms", started: str = "started_us", finished: str = "finished_us",
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Nearest-rank percentiles, maximum, mean and rows per second of a request log."""
    known = log.filter(F.col(column).isNotNull())
    rows = known.count()
    places = {p: nearest_rank(rows, p) for p in (50, 95, 99)}
    found = values_at_ranks(known, column, list(places.values()), rows, rows_per_task)
    wall_s = (F.max(finished) - F.min(started)) / F.lit(1e6)
    return known.agg(F.count("*").alias("n"), F.max(column).alias("max_ms"), F.avg(column).alias("mean_ms"),
                     F.try_divide(F.count("*"), wall_s).alias("per_second")).withColumns(
        {f"p{p}": F.lit(found[r]) for p, r in places.items()})
