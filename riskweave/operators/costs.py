"""Cost of decisions, and the threshold that minimises it."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.operators.ordered import ROWS_PER_TASK, exact_quantiles, make_axis, running_totals
from riskweave.operators.ranking import _ratio, pr_curve, with_rates


@dataclass(frozen=True)
class CostMatrix:
    """Cost per outcome. With amounts, `c_fn` is the share of the missed amount that is lost."""

    # Defaults.
    c_fn: float = 200.0
    c_fp: float = 5.0
    c_tp: float = 0.0
    c_tn: float = 0.0


def fixed_threshold_cost(scored: DataFrame, threshold, costs: CostMatrix, amount: str | None = None,
                         label: str = "y", score: str = "p") -> DataFrame:
    """Cost of one threshold: missed positives and false alarms only."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit, pos = F.col(score) >= t, F.col(label) == 1
    missed = F.coalesce(F.sum(F.when(~hit & pos, F.col(amount))), F.lit(0.0)) if amount else F.count_if(~hit & pos)
    out = scored.agg(F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"),
                     F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn"),
                     missed.cast("double").alias("_missed"), F.count("*").alias("_n"))
    total = F.lit(costs.c_fn) * F.col("_missed") + F.lit(costs.c_fp) * F.col("fp")
    out = out.withColumns({"threshold": t, "total_cost": total}).withColumn(
        "cost_per_txn", F.col("total_cost") / F.greatest(F.col("_n"), F.lit(1)))
    return with_rates(out).drop("_missed", "_n", "f1")


def flat_cost(scored: DataFrame, threshold: float, c_fn: float = 100.0, c_fp: float = 5.0,
              label: str = "y", score: str = "p") -> DataFrame:
    hit, pos = F.col(score) >= F.lit(float(threshold)), F.col(label) == 1
    out = scored.agg(F.count_if(~hit & pos).alias("flat_fn"), F.count_if(hit & ~pos).alias("flat_fp"), F.count("*").alias("_n"))
    total = F.lit(float(c_fn)) * F.col("flat_fn") + F.lit(float(c_fp)) * F.col("flat_fp")
    return out.withColumns({"flat_total_cost": total, "flat_cost_per_txn": total / F.greatest(F.col("_n"), F.lit(1))}).drop("_n")


def _curve(sums: DataFrame, costs: CostMatrix, keep: str) -> DataFrame:
    """Cost and rates from `pos`, `neg`, `lost` below a threshold and the totals."""
    tp, fp = F.col("_all_pos") - F.col("fn"), F.col("_all_neg") - F.col("tn")
    out = sums.withColumns({"tp": tp, "fp": fp})
    total = (F.lit(costs.c_fn) * F.col("_missed") + F.lit(costs.c_fp) * F.col("fp")
             + F.lit(costs.c_tp) * F.col("tp") + F.lit(costs.c_tn) * F.col("tn"))
    return with_rates(out.withColumn("total_cost", total)).select(
        keep, "total_cost", "precision", "recall", "tp", "fp", "fn", "tn")


def threshold_grid(scored: DataFrame, n_grid: int = 200, score: str = "p", rows_per_task: int = ROWS_PER_TASK) -> list[float]:
    """Distinct values of `n_grid` evenly spaced quantiles of the score."""
    probs = [i / (n_grid - 1) for i in range(n_grid)]
    return sorted({q for q in exact_quantiles(scored, score, probs, rows_per_task) if not math.isnan(q)})


def sweep(scored: DataFrame, costs: CostMatrix, amount: str | None = None, n_grid: int = 200,
          grid: str = "quantile", label: str = "y", score: str = "p", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Cost, precision, recall and counts for every candidate threshold.

    One scan places each score between two candidates; the rest works on one row per candidate.
    `grid="exact"` tries every distinct score instead of a quantile grid.
    """
    lost = F.sum(F.when(F.col(label) == 1, F.col(amount)).otherwise(0.0)) if amount else F.count_if(F.col(label) == 1)
    sums = [F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"),
            lost.cast("double").alias("lost")]
    if grid == "exact":
        known = scored.withColumn("threshold", F.col(score).cast("double"))
        axis = make_axis(known, "threshold", rows_per_task)
        grouped = known.groupBy("threshold").agg(*sums)
        run = running_totals(grouped, axis, ["pos", "neg", "lost"])
        return _curve(run.withColumns({
            "fn": F.col("cum_pos") - F.col("pos"), "tn": F.col("cum_neg") - F.col("neg"),
            "_missed": F.when(F.col("cum_pos") > F.col("pos"), F.col("cum_lost") - F.col("lost")).otherwise(0.0),
            "_all_pos": grouped.agg(F.sum("pos")).scalar(), "_all_neg": grouped.agg(F.sum("neg")).scalar(),
        }), costs, "threshold")
    if grid != "quantile":
        raise ValueError(f"unknown grid: {grid!r}")
    points = threshold_grid(scored, n_grid, score, rows_per_task)
    # Bin i holds scores in [points[i - 1], points[i]); bin 0 is empty because points[0] is the minimum.
    cut = Bucketizer(splits=[-math.inf, *points, math.inf], inputCol="_score", outputCol="_bin")
    binned = cut.transform(scored.filter(F.col(score).isNotNull()).withColumn("_score", F.col(score).cast("double")))
    per_bin = binned.groupBy(F.col("_bin").cast("int").alias("_bin")).agg(*sums)
    spark = scored.sparkSession
    candidates = spark.createDataFrame([(i, t) for i, t in enumerate(points)], "_bin int, threshold double")
    # At most n_grid rows from here on. A candidate's own bin starts at `_bin` + 1.
    ends = candidates.withColumn("_bin", F.col("_bin") + 1).join(F.broadcast(per_bin), "_bin", "left").fillna(0, ["pos", "neg", "lost"])
    below = Window.partitionBy(F.lit(0)).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    return _curve(ends.select(
        "threshold",
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"), F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn"),
        F.coalesce(F.sum("lost").over(below), F.lit(0.0)).alias("_missed"),
        F.sum("pos").over(every).alias("_all_pos"), F.sum("neg").over(every).alias("_all_neg")), costs, "threshold")


def best_threshold(scored: DataFrame, costs: CostMatrix, **options) -> DataFrame:
    """The cheapest candidate; the lowest threshold wins a tie."""
    rows = scored.count()
    out = sweep(scored, costs, **options).orderBy("total_cost", "threshold").limit(1)
    return out.withColumn("cost_per_txn", F.col("total_cost") / F.lit(max(rows, 1)))


def best_f1_threshold(scored: DataFrame, **options) -> DataFrame:
    """The score with the highest F1; the lowest one wins a tie."""
    points = pr_curve(scored, **options).filter(F.col("threshold").isNotNull())
    f1 = _ratio(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return points.withColumn("f1", f1).orderBy(F.desc("f1"), "threshold").limit(1)


def saving_over_f1(scored: DataFrame, costs: CostMatrix, amount: str | None = None, **options) -> DataFrame:
    """Cost at the F1-best threshold, at the cost-best one, and the difference."""
    f1_row = best_f1_threshold(scored).first()
    cost_row = best_threshold(scored, costs, amount=amount, **options).first()
    at_f1 = fixed_threshold_cost(scored, f1_row["threshold"], costs, amount).select(
        F.col("threshold").alias("f1_threshold"), F.col("total_cost").alias("f1_cost"))
    return at_f1.withColumns({
        "best_f1": F.lit(f1_row["f1"]), "cost_threshold": F.lit(cost_row["threshold"]),
        "best_cost": F.lit(cost_row["total_cost"])}).withColumn("saving", F.col("f1_cost") - F.col("best_cost"))
