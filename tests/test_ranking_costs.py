"""Ranking metrics and cost curves against direct computation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import costs, ranking


def brute(y, p):
    """Average precision and ROC-AUC by definition."""
    ap, seen = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = (y[hit] == 1).sum() / (y == 1).sum()
        ap += (recall - seen) * (y[hit] == 1).mean()
        seen = recall
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    return ap, auc


@pytest.fixture(scope="module")
def arrays(scores):
    pdf = scores.toPandas()
    return pdf.y.to_numpy(), pdf.p.to_numpy(), pdf.p_tied.to_numpy(), pdf.amt.to_numpy()


@pytest.mark.parametrize("rows_per_task", [10**9, 50])
def test_average_precision_and_auc(scores, arrays, rows_per_task):
    y, p, tied, _ = arrays
    for column, values in (("p", p), ("p_tied", tied)):
        row = ranking.metric_bundle(scores, score=column, rows_per_task=rows_per_task).first()
        ap, auc = brute(y, values)
        assert row["pr_auc"] == pytest.approx(ap, abs=1e-12)
        assert row["roc_auc"] == pytest.approx(auc, abs=1e-12)


def test_single_class_and_equal_scores(spark):
    none = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    row = ranking.metric_bundle(none).first()
    assert row["pr_auc"] == 0 and math.isnan(row["roc_auc"]) and row["recall"] == 0
    equal = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.5), (1, 0.5)], "y int, p double")
    row = ranking.metric_bundle(equal).first()
    assert row["pr_auc"] == 0.5 and row["roc_auc"] == 0.5
    assert ranking.threshold_at_precision(equal, 0.9).first()[0] == 1.0
    assert ranking.recall_at_precision(equal, 0.9).first()[0] == 0.0


@pytest.mark.parametrize("amount", [None, "amt"])
def test_sweep_equals_brute_force(scores, arrays, amount):
    y, p, _, amt = arrays
    cost = costs.CostMatrix(3.0, 5.0, 1.0, 0.5)
    got = costs.sweep(scores, cost, amount, n_grid=50, rows_per_task=70).toPandas().sort_values("threshold").reset_index(drop=True)
    grid = np.unique(np.quantile(p, np.linspace(0, 1, 50)))
    np.testing.assert_allclose(got.threshold, grid, atol=1e-15)
    for i, t in enumerate(got.threshold):
        hit = p >= t
        tp, fp = ((y == 1) & hit).sum(), ((y == 0) & hit).sum()
        fn, tn = ((y == 1) & ~hit).sum(), ((y == 0) & ~hit).sum()
        lost = amt[(y == 1) & ~hit].sum() if amount else fn
        assert got.loc[i, ["tp", "fp", "fn", "tn"]].tolist() == [tp, fp, fn, tn]
        assert got.total_cost[i] == pytest.approx(3.0 * lost + 5.0 * fp + tp + 0.5 * tn)


@pytest.mark.parametrize("rows_per_task", [10**9, 50])
def test_exact_grid_covers_every_score(scores, arrays, rows_per_task):
    y, p, _, amt = arrays
    got = costs.sweep(scores, costs.CostMatrix(1.0, 5.0), "amt", grid="exact", rows_per_task=rows_per_task).toPandas()
    assert sorted(got.threshold) == sorted(set(p))
    for row in got.sample(20, random_state=1).itertuples():
        hit = p >= row.threshold
        assert row.total_cost == pytest.approx(amt[(y == 1) & ~hit].sum() + 5.0 * ((y == 0) & hit).sum())


def test_golden_cost_arithmetic(spark):
    rows = spark.range(369122 + 8 + 171 + 1178).select(
        F.when(F.col("id") < 1178 + 171, 1).otherwise(0).alias("y"),
        F.when((F.col("id") < 1178) | F.col("id").between(1349, 1356), 0.9).otherwise(0.0).alias("p"))
    row = costs.flat_cost(rows, 0.1).first()
    assert (row["flat_fn"], row["flat_fp"], row["flat_total_cost"]) == (171, 8, 17140.0)
    row = ranking.with_rates(spark.createDataFrame([(991, 202, 44, 221051)], "tp long, fp long, fn long, tn long")).first()
    assert row["precision"] == pytest.approx(0.83068, abs=1e-5) and row["recall"] == pytest.approx(0.95749, abs=1e-5)


def test_lowest_threshold_wins_a_tie(spark):
    rows = spark.createDataFrame([(0, 0.1, 0.0), (0, 0.2, 0.0), (1, 0.9, 0.0)], "y int, p double, amt double")
    assert costs.best_threshold(rows, costs.CostMatrix(0.0, 0.0)).first()["threshold"] == 0.1


def test_missing_amount_is_no_loss(spark):
    rows = spark.createDataFrame([(1, 0.1, None), (1, 0.9, 5.0)], "y int, p double, amt double")
    assert costs.fixed_threshold_cost(rows, 0.5, costs.CostMatrix(1.0, 5.0), "amt").first()["total_cost"] == 0.0
