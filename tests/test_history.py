"""Window edges, ties, hot cards and the rule that no row sees the future."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import features, history

T0 = dt.datetime(2024, 1, 1)
COLUMNS = "trans_num long, cc_num long, trans_ts timestamp, amt double, merch_lat double, merch_long double"


def card(spark, rows, cc=1):
    """rows: (minutes, amount[, lat, lon])."""
    data = [(i, cc, T0 + dt.timedelta(minutes=r[0]), r[1], *(r[2:] or (0.0, 0.0))) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, COLUMNS)


def ordered(df):
    return df.orderBy("trans_num").toPandas()


def test_window_is_closed_left_and_excludes_equal_times(spark):
    out = ordered(history.history_features(card(spark, [(0, 1.0), (30, 2.0), (30, 4.0), (60, 8.0), (90, 16.0)])))
    assert out.txn_count_1h.tolist() == [0, 1, 1, 3, 3]
    assert out.txn_amount_1h.tolist() == [0, 1, 1, 7, 14]


def test_equal_amounts_have_no_spread_and_no_score(spark):
    out = ordered(history.history_features(card(spark, [(0, 5.0), (1, 5.0), (2, 7.0)])))
    assert out.amt_hist_std.tolist() == [0, 0, 0]
    assert out.amt_zscore.tolist() == [0, 0, 0]
    assert out.amt_hist_mean.tolist() == [5, 5, 5]


def test_row_statistics_see_an_earlier_row_at_the_same_time(spark):
    out = ordered(history.history_features(card(spark, [(0, 1.0), (10, 2.0), (10, 4.0)])))
    assert out.amt_hist_mean.tolist() == [1, 1, 1.5]
    assert out.time_since_prev_h.tolist()[2] == 0


def test_missing_amount_counts_nowhere(spark):
    out = ordered(history.history_features(card(spark, [(0, 1.0), (1, None), (2, 3.0), (3, float("nan")), (4, 4.0)])))
    assert out.txn_count_1h.tolist() == [0, 1, 1, 2, 2]
    assert out.amt_hist_mean.tolist()[4] == 2
    assert out.amt_zscore.tolist()[1] == 0


def test_speed_floor(spark):
    out = ordered(history.history_features(card(spark, [
        (0, 1.0, 10.0, 10.0), (0, 1.0, 11.0, 10.0), (0.5, 1.0, 10.0, 10.0), (60.5, 1.0, 11.0, 10.0)])))
    km = 2 * 6371.0088 * np.arcsin(np.sin(np.radians(1) / 2))
    assert out.dist_from_prev_km.tolist()[1:] == pytest.approx([km] * 3)
    assert out.speed_kmh.tolist() == pytest.approx([0, 0, km * 60, km])


def test_missing_point_gives_no_distance(spark):
    out = ordered(history.history_features(card(spark, [(0, 1.0, None, 1.0), (5, 1.0, 1.0, 1.0), (9, 1.0, 1.0, 1.0)])))
    assert out.dist_from_prev_km.tolist() == [0, 0, 0]


def test_rows_without_a_card_have_no_history(spark):
    out = ordered(history.history_features(card(spark, [(i, 5.0) for i in range(6)], cc=None)))
    assert out.txn_count_1h.sum() == 0 and out.time_since_prev_h.sum() == 0
    assert out.amt_hist_mean.tolist() == [5.0] * 6


def _same(a, b, tolerance=1e-9):
    a, b = a.sort_values("trans_num").reset_index(drop=True), b.sort_values("trans_num").reset_index(drop=True)
    assert list(a.columns) == list(b.columns) and len(a) == len(b)
    for c in a.columns:
        if a[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c].to_numpy(), b[c].to_numpy(), rtol=tolerance, atol=1e-7, err_msg=c)
        else:
            assert (a[c].astype(str) == b[c].astype(str)).all(), c


def test_hot_cards_in_chunks_equal_whole_cards(transactions):
    plain = history.history_features(transactions).toPandas()
    # About a third of all rows on one card, and chunks of 40 rows.
    skewed = transactions.withColumn("cc_num", F.when(F.col("trans_num") % 3 == 0, 1).otherwise(F.col("cc_num")))
    whole = history.history_features(skewed)
    cut = history.history_features(skewed, hot_share=1e-9, min_hot_rows=40)
    assert "_omean" in cut._jdf.queryExecution().analyzed().toString()
    _same(whole.toPandas(), cut.toPandas())
    _same(plain, history.history_features(transactions, hot_share=1e-9, min_hot_rows=20).toPandas())


def test_hot_card_with_equal_times(spark):
    rows = [(m // 7, float(m % 11)) for m in range(300)]
    df = card(spark, rows).unionByName(card(spark, [(5, 1.0)], cc=2).withColumn("trans_num", F.lit(9999).cast("long")))
    _same(history.history_features(df).toPandas(), history.history_features(df, hot_share=1e-9, min_hot_rows=25).toPandas())


def test_later_rows_do_not_change_earlier_features(transactions):
    cut = "2024-01-15"
    model = features.fit_features(transactions, age_fill="fit")
    early = model.transform(transactions.filter(F.col("trans_ts") < cut)).toPandas()
    changed = transactions.withColumn("amt", F.when(F.col("trans_ts") < cut, F.col("amt")).otherwise(F.col("amt") * 50))
    ids = early.trans_num.tolist()
    later = model.transform(changed).filter(F.col("trans_num").isin(ids)).toPandas()
    _same(early, later)


def test_input_order_does_not_matter(transactions):
    model = features.fit_features(transactions)
    _same(model.transform(transactions).toPandas(), model.transform(transactions.orderBy(F.rand(1)).repartition(5)).toPandas())


def test_past_features_equal_the_slice_of_a_full_pass(transactions):
    model = features.fit_features(transactions, age_fill="fit")
    past, target = transactions.filter("trans_num < 700"), transactions.filter("trans_num >= 700")
    full = model.transform(transactions).filter("trans_num >= 700").toPandas()
    _same(full, model.transform_with_past(past, target).toPandas())


def test_engineered_frame_is_complete(transactions):
    out = features.fit_features(transactions).transform(transactions)
    from riskweave.schema import FEATURE_ORDER
    assert out.columns == ["trans_num", *FEATURE_ORDER, "is_fraud"]
    assert sum(features.missing_values(out).first()) == 0


def test_custom_windows(spark):
    model_rows = card(spark, [(0, 1.0), (20, 2.0), (45, 4.0)])
    out = ordered(history.history_features(model_rows, windows={"30m": 0.5}))
    assert out.txn_count_30m.tolist() == [0, 1, 1]


def test_missing_required_column(transactions):
    model = features.fit_features(transactions)
    with pytest.raises(ValueError, match="merch_lat"):
        model.transform(transactions.drop("merch_lat"))


def test_one_exchange_and_one_sort_for_all_windows(transactions, spark):
    plan = history.history_features(transactions)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_amounts_of_any_size_leave_nothing_behind(spark, limit):
    """Against a plain range frame: large, tiny, negative and infinite amounts enter and leave a window."""
    start = 1_600_000_000
    amounts = [1e17, 1.0, 0.01, 1e9, -2.5, float("inf"), 3.0, None, 7e-9, float("-inf"), 1e16, 0.1, 0.2, float("nan")] * 6
    rows = [(i, i % 2, start + 1500 * i, a) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "trans_num long, cc_num long, s long, amt double").select(
        "trans_num", "cc_num", F.col("s").cast("timestamp").alias("trans_ts"), "amt", F.lit(1.0).alias("merch_lat"), F.lit(1.0).alias("merch_long"))
    got = {r["trans_num"]: r for r in history.history_features(df, min_hot_rows=limit).collect()}
    for i, card, at, _ in rows:
        inside = [a for _, c, t, a in rows if c == card and at - 3600 <= t < at and a is not None and a == a]
        assert got[i]["txn_count_1h"] == len(inside)
        assert got[i]["txn_amount_1h"] == pytest.approx(float(sum(inside)), rel=1e-12, abs=1e-11, nan_ok=True)


def test_many_hot_keys_join_by_shuffle(spark, transactions, monkeypatch):
    from riskweave.operators import keyed_chunks
    plain = history.history_features(transactions).toPandas()
    monkeypatch.setattr(keyed_chunks, "BROADCAST_KEYS", 0)
    _same(plain, history.history_features(transactions, min_hot_rows=20).toPandas())
