"""Prefix sums, quantiles and rank search against in-memory answers, in one and in many buckets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import ordered, splits


@pytest.mark.parametrize("rows_per_task", [10**9, 60])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, scores, rows_per_task, descending):
    grouped = scores.groupBy(F.col("p").alias("v")).agg(F.count("*").alias("n"))
    axis = ordered.make_axis(scores.select(F.col("p").alias("v")), "v", rows_per_task)
    assert bool(axis.splits) == (rows_per_task == 60)
    out = ordered.running_totals(grouped, axis, ["n"], descending).toPandas().sort_values("v", ascending=not descending)
    assert out.cum_n.tolist() == out.n.cumsum().tolist()


@pytest.mark.parametrize("rows_per_task", [10**9, 50])
def test_quantiles_equal_numpy(spark, scores, rows_per_task):
    values = np.array([r[0] for r in scores.select("p").collect()])
    probs = np.linspace(0, 1, 41).tolist()
    got = ordered.exact_quantiles(scores, "p", probs, rows_per_task)
    np.testing.assert_allclose(got, np.quantile(values, probs), rtol=0, atol=1e-15)


def test_quantiles_of_mostly_equal_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(500).cast("double").alias("v"))
    values = np.array([r[0] for r in df.collect()])
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    assert ordered.exact_quantiles(df, "v", probs, 40) == pytest.approx(np.quantile(values, probs).tolist())


def test_quantiles_without_values(spark):
    assert np.isnan(ordered.exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5])[0])


@pytest.mark.parametrize("last_step", [20_000, 1])
def test_row_at_rank(spark, monkeypatch, last_step):
    monkeypatch.setattr(ordered, "LAST_STEP_ROWS", last_step)
    monkeypatch.setattr(ordered, "RANK_CELLS", 16)
    rng = np.random.default_rng(1)
    rows = sorted({(int(a), int(b)) for a, b in zip(rng.integers(-10**12, 10**12, 300) // 10**11, rng.integers(0, 10**6, 300))})
    df = spark.createDataFrame(rows, "a long, b long").repartition(3)
    for rank in (0, 1, 150, len(rows) - 1):
        assert ordered.row_at_rank(df, "a", "b", rank) == rows[rank]


def test_split_with_equal_times(spark):
    df = spark.range(100).select(F.col("id").alias("trans_num"), F.lit("2024-01-01").cast("timestamp").alias("trans_ts"))
    out = splits.train_test(df, 0.37)
    assert sorted(r[0] for r in splits.take_fold(out, "train").select("trans_num").collect()) == list(range(37))


def test_folds_partition_all_rows(transactions):
    out = splits.folds(transactions)
    counts = {r["fold"]: r["count"] for r in out.groupBy("fold").count().collect()}
    n = transactions.count()
    assert sum(counts.values()) == n and counts["test"] == n - int(n * 0.8)
    splits.assert_chronological(out, ("fit", "val", "test"))


def test_leak_and_empty_fold_raise(transactions):
    swapped = splits.folds(transactions).withColumn("fold", F.when(F.col("fold") == "fit", "test").otherwise("fit"))
    with pytest.raises(ValueError):
        splits.assert_chronological(swapped, ("fit", "test"))
    with pytest.raises(ValueError):
        splits.assert_chronological(swapped, ("fit", "val", "test"))


def test_subsamples(transactions):
    n = transactions.count()
    assert splits.most_recent(transactions, None).count() == n
    assert splits.most_recent(transactions, 1.0).count() == n
    assert splits.most_recent(transactions, 0.05).count() == int(n * 0.05)
    assert splits.most_recent(transactions, 1e-9).count() == 0
    assert splits.tuning_tail(transactions, 0.5).count() == n - int(n * 0.5)
    assert splits.seeded_sample(transactions, 10).count() == 10


def test_text_ids(transactions):
    out = splits.train_test(transactions.withColumn("trans_num", F.concat(F.lit("t"), "trans_num")))
    assert splits.take_fold(out, "train").count() == int(transactions.count() * 0.8)
