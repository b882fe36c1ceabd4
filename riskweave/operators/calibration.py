"""Probability quality measures, and two monotone recalibrations fitted on a held-out fold."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Row, functions as F

from riskweave.operators.ordered import ROWS_PER_TASK, exact_quantiles

# Fixed value: smallest probability the log loss distinguishes from 0.
EPSILON = 2.220446049250313e-16


def brier_log_loss(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    y, p = F.col(label), F.col(score)
    q = F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    loss = -F.when(y == 1, F.ln(q)).otherwise(F.ln(F.lit(1.0) - q))
    return scored.agg(F.avg((p - y) * (p - y)).alias("brier"), F.avg(loss).alias("log_loss"))


def reliability_curve(scored: DataFrame, n_bins: int = 10, label: str = "y", score: str = "p",
                      rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Mean score and positive share per quantile bin; empty bins are dropped."""
    edges = exact_quantiles(scored, score, [i / n_bins for i in range(n_bins + 1)], rows_per_task)
    at = sum(((F.col(score) > F.lit(e)).cast("int") for e in edges[1:-1]), F.lit(0))
    return scored.groupBy(at.alias("bin")).agg(F.avg(score).alias("mean_score"), F.avg(label).alias("positive_share"),
                                               F.count("*").alias("n"))


def _distinct_scores(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Fits depend on each score's weight and positives only, so equal scores travel once."""
    return scored.groupBy(F.col(score).cast("double").alias("p")).agg(
        F.count("*").cast("double").alias("w"), F.sum(label).cast("double").alias("pos"))


@dataclass
class Calibrator:
    """A fitted recalibration of a score column."""

    method: str
    model: object

    def transform(self, df: DataFrame, score: str = "p", out: str = "p_cal") -> DataFrame:
        vec = VectorAssembler(inputCols=[score], outputCol="_cal_x")
        scored = self.model.transform(vec.transform(df))
        if self.method == "isotonic":
            return scored.withColumn(out, F.col("_cal_y")).drop("_cal_x", "_cal_y")
        return scored.withColumn(out, vector_to_array("_cal_prob")[1]).drop("_cal_x", "_cal_prob", "_cal_raw", "_cal_pred")


    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/{self.method}")

    @classmethod
    def load(cls, path: str, method: str) -> "Calibrator":
        kind = {"isotonic": IsotonicRegressionModel, "sigmoid": LogisticRegressionModel}[method]
        return cls(method, kind.load(f"{path}/{method}"))


def fit_isotonic(scored: DataFrame, label: str = "y", score: str = "p") -> Calibrator:
    """Pool-adjacent-violators fit with linear interpolation, clipped at both ends."""
    rows = _distinct_scores(scored, label, score).select("p", "w", (F.col("pos") / F.col("w")).alias("share"))
    rows = VectorAssembler(inputCols=["p"], outputCol="_cal_x").transform(rows)
    fit = IsotonicRegression(featuresCol="_cal_x", labelCol="share", weightCol="w", predictionCol="_cal_y").fit(rows)
    return Calibrator("isotonic", fit)


def fit_platt(scored: DataFrame, label: str = "y", score: str = "p", iterations: int = 100) -> Calibrator:
    """Two-parameter logistic fit against targets smoothed by the class counts."""
    groups = _distinct_scores(scored, label, score)
    totals = groups.agg(F.sum("pos").alias("pos"), F.sum("w").alias("n")).first()
    high = (totals["pos"] + 1.0) / (totals["pos"] + 2.0)
    low = 1.0 / (totals["n"] - totals["pos"] + 2.0)
    # Each score enters once as a positive and once as a negative, weighted by its soft target.
    soft = F.col("pos") * F.lit(high) + (F.col("w") - F.col("pos")) * F.lit(low)
    halves = groups.select("p", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), soft.alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("w") - soft).alias("weight")))).alias("h")).select("p", "h.*")
    rows = VectorAssembler(inputCols=["p"], outputCol="_cal_x").transform(halves)
    fit = LogisticRegression(featuresCol="_cal_x", labelCol="label", weightCol="weight", regParam=0.0, tol=1e-10,
                             maxIter=iterations, probabilityCol="_cal_prob", rawPredictionCol="_cal_raw",
                             predictionCol="_cal_pred").fit(rows)
    return Calibrator("sigmoid", fit)


FITS = {"isotonic": fit_isotonic, "sigmoid": fit_platt}


def fit_calibrator(scored: DataFrame, method: str = "auto", label: str = "y", score: str = "p") -> tuple[Calibrator, dict]:
    """Fit one method, or both and keep the lower Brier score (isotonic wins a tie)."""
    if method != "auto" and method not in FITS:
        raise ValueError(f"unknown calibration method: {method!r}")
    inherits = inheritable_thread_target(scored.sparkSession)

    def tried(name: str) -> tuple[Calibrator, Row]:
        candidate = FITS[name](scored, label, score)
        return candidate, brier_log_loss(candidate.transform(scored, score), label, "p_cal").first()
    best, best_metrics = None, None
    with ThreadPoolExecutor(1 + len(FITS)) as pool:
        unfitted = pool.submit(inherits(lambda: brier_log_loss(scored, label, score).first()))
        found = list(pool.map(inherits(tried), FITS if method == "auto" else [method]))
        before = unfitted.result()
    for candidate, after in found:
        metrics = {"brier_before": before["brier"], "brier_after": after["brier"],
                   "log_loss_before": before["log_loss"], "log_loss_after": after["log_loss"]}
        if best is None or metrics["brier_after"] < best_metrics["brier_after"]:
            best, best_metrics = candidate, metrics
    return best, best_metrics
