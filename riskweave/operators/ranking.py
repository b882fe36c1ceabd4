"""Ranking metrics over (label, score) rows.

All of them read the same table: one row per distinct score with its positives and negatives and
the totals at or above it. It is built with one pre-aggregated exchange plus a bucketed prefix sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.operators.ordered import ROWS_PER_TASK, make_axis, running_totals

# Fixed values.
PRECISION_FLOOR = 0.80


def score_steps(scored: DataFrame, label: str = "y", score: str = "p", rows_per_task: int = ROWS_PER_TASK,
                by: Sequence[str] = ()) -> DataFrame:
    """(score, pos, neg, tp, fp) per distinct score (and `by` group); tp and fp count rows with at least this score."""
    known = scored.select(*by, F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("score"))
    axis = make_axis(known, "score", rows_per_task)
    grouped = known.groupBy(*by, "score").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    steps = running_totals(grouped, axis, ["pos", "neg"], descending=True, by=by)
    return steps.select(*by, "score", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def average_precision_of(steps_prefix: str = "") -> Column:
    """Step sum of precision over recall gains; 0 without positives."""
    tp, fp, pos = (F.col(steps_prefix + c) for c in ("tp", "fp", "pos"))
    return _ratio(F.sum(pos * tp / (tp + fp)), F.sum(pos))


def roc_auc_of() -> Column:
    """Share of (positive, negative) pairs in the right order, ties half; NaN for a single class."""
    above = F.col("tp") - F.col("pos")
    pairs = F.sum(F.col("neg").cast("double") * (above.cast("double") + F.col("pos") / 2.0))
    return F.coalesce(F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg")), F.lit(float("nan")))


def recall_at_precision_of(floor: float) -> Column:
    ok = F.col("tp") / (F.col("tp") + F.col("fp")) >= F.lit(floor)
    return _ratio(F.max(F.when(ok, F.col("tp"))), F.sum("pos"))


def average_precision(scored: DataFrame, **options) -> DataFrame:
    return score_steps(scored, **options).agg(average_precision_of().alias("average_precision"))


def roc_auc(scored: DataFrame, **options) -> DataFrame:
    return score_steps(scored, **options).agg(roc_auc_of().alias("roc_auc"))


def pr_curve(scored: DataFrame, **options) -> DataFrame:
    """Precision and recall per distinct score, and the closing point (1, 0) without a threshold."""
    steps = score_steps(scored, **options)
    total = steps.agg(F.sum("pos")).scalar()
    points = steps.select(F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                          _ratio(F.col("tp"), total).alias("recall"))
    end = scored.sparkSession.sql("select cast(null as double) threshold, 1d `precision`, 0d recall")
    return points.unionByName(end)


def roc_curve(scored: DataFrame, **options) -> DataFrame:
    """False and true positive rate per distinct score, collinear points included, from (0, 0)."""
    steps = score_steps(scored, **options)
    pos, neg = steps.agg(F.sum("pos")).scalar(), steps.agg(F.sum("neg")).scalar()
    points = steps.select(F.col("score").alias("threshold"), _ratio(F.col("fp"), neg).alias("fpr"),
                          _ratio(F.col("tp"), pos).alias("tpr"))
    start = scored.sparkSession.sql("select cast(null as double) threshold, 0d fpr, 0d tpr")
    return points.unionByName(start)


def recall_at_precision(scored: DataFrame, floor: float = PRECISION_FLOOR, **options) -> DataFrame:
    return score_steps(scored, **options).agg(recall_at_precision_of(floor).alias("recall_at_precision"))


def threshold_at_precision(scored: DataFrame, floor: float = PRECISION_FLOOR, **options) -> DataFrame:
    """Lowest score whose precision reaches the floor; 1.0 if none does."""
    ok = F.col("tp") / (F.col("tp") + F.col("fp")) >= F.lit(floor)
    return score_steps(scored, **options).agg(F.coalesce(F.min(F.when(ok, F.col("score"))), F.lit(1.0)).alias("threshold"))


def confusion(scored: DataFrame, threshold: float, label: str = "y", score: str = "p") -> DataFrame:
    hit, pos = F.col(score) >= F.lit(float(threshold)), F.col(label) == 1
    return scored.agg(F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"),
                      F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn"))


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from confusion counts; a zero denominator gives 0."""
    return counts.withColumns({
        "precision": _ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": _ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        "f1": _ratio(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn")),
    })


def metric_bundle(scored: DataFrame, threshold: float = 0.5, floor: float = PRECISION_FLOOR, by: Sequence[str] = (),
                  **options) -> DataFrame:
    """PR-AUC, ROC-AUC, point metrics at a threshold and recall at a precision floor, in one plan for all `by` groups."""
    hit = F.col("score") >= F.lit(float(threshold))
    tp, fp = F.sum(F.when(hit, F.col("pos")).otherwise(0)), F.sum(F.when(hit, F.col("neg")).otherwise(0))
    fn = F.sum(F.when(hit, 0).otherwise(F.col("pos")))
    return score_steps(scored, by=by, **options).groupBy(*by).agg(
        average_precision_of().alias("pr_auc"), roc_auc_of().alias("roc_auc"),
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"),
        recall_at_precision_of(floor).alias(f"recall_at_p{int(floor * 100)}"))


def classification_report(scored: DataFrame, threshold: float = 0.5, **columns) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support, rounded to 4 digits."""
    c = confusion(scored, threshold, **columns)
    c = c.withColumns({
        "n1": F.col("tp") + F.col("fn"), "n0": F.col("tn") + F.col("fp"),
        "p1": _ratio(F.col("tp"), F.col("tp") + F.col("fp")), "p0": _ratio(F.col("tn"), F.col("tn") + F.col("fn")),
    }).withColumns({
        "r1": _ratio(F.col("tp"), F.col("n1")), "r0": _ratio(F.col("tn"), F.col("n0")),
        "f1": _ratio(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn")),
        "f0": _ratio(2.0 * F.col("tn"), 2.0 * F.col("tn") + F.col("fp") + F.col("fn")),
        "n": F.col("n1") + F.col("n0"),
    })
    mean = lambda m: (F.col(f"{m}0") + F.col(f"{m}1")) / 2.0
    weighted = lambda m: _ratio(F.col(f"{m}0") * F.col("n0") + F.col(f"{m}1") * F.col("n1"), F.col("n"))
    accuracy = _ratio(F.col("tp") + F.col("tn"), F.col("n"))
    line = lambda name, p, r, f, n: F.struct(
        F.lit(name).alias("row_name"), F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"),
        F.round(f, 4).alias("f1"), n.alias("support"))
    rows = [line("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("n0")),
            line("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("n1")),
            line("accuracy", accuracy, accuracy, accuracy, F.col("n")),
            line("macro avg", mean("p"), mean("r"), mean("f"), F.col("n")),
            line("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("n"))]
    return c.select(F.inline(F.array(*rows)))


def leaderboard(runs: DataFrame, metric: str = "pr_auc") -> DataFrame:
    """Runs best first, with the winner marked. One row per run, so a single ordered window is enough."""
    best_first = Window.orderBy(F.desc(metric), "approach")
    return runs.withColumn("place", F.row_number().over(best_first)).withColumn("is_winner", (F.col("place") == 1).cast("int"))


def running_best(trials: DataFrame, order: str, value: str) -> DataFrame:
    """Best value so far per trial. One row per trial of a study."""
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn("best_so_far", F.max(value).over(upto))
