"""The stream against the batch replay, and the rules of the online state."""

import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.session import scratch_path
from riskweave.streaming import online, replay

COLS = ["trans_num", *online.ONLINE_COLUMNS.names, "cold_start"]


def run(spark, folder, struct, files_per_trigger=100, **options):
    s = online.read_stream(spark, folder, struct, "parquet", files_per_trigger)
    out = online.with_online_features(s, **options)
    return online.run_to_end(out, scratch_path(spark, "out"), scratch_path(spark, "state"), 120)


def test_two_event_scenario():
    first = online.online_features(1000, 36.01, -82.04, np.empty((0, 4)))
    assert first == (0, 0, 0.0, 0.0, 0.0, 999.0, 0.0)
    past = np.array([(1000.0, 100.0, 36.01, -82.04)])
    c1, c24, a1, a24, km, gap, speed = online.online_features(1000 + 1800, 36.40, -82.40, past)
    assert (c1, c24, a1, a24, gap) == (1, 1, 100.0, 100.0, 0.5) and km > 0
    assert speed == pytest.approx(km / 0.5, abs=0.02)


def test_both_window_ends_are_closed_and_future_rows_ignored():
    past = np.array([(0.0, 1.0, 0, 0), (3600.0, 2.0, 0, 0), (9999.0, 4.0, 0, 0)])
    out = online.online_features(3600, 0.0, 1.0, past)
    assert out[:4] == (2, 2, 3.0, 3.0)
    # The last arrival lies in the future: no gap, and the gap floor gives the speed.
    assert out[5] == 0.0 and out[6] == pytest.approx(out[4] * 60, rel=1e-3)


def test_stream_over_several_batches_equals_replay(spark, transactions):
    folder = scratch_path(spark, "in")
    for part in range(3):
        (transactions.filter(F.col("trans_num").between(part * 334, part * 334 + 333)).coalesce(1)
         .write.mode("append").parquet(folder))
    got = run(spark, folder, transactions.schema, files_per_trigger=1).select(COLS).toPandas().sort_values("trans_num")
    want = replay.replay(transactions).select(COLS).toPandas().sort_values("trans_num")
    assert len(got) == len(want) == 1000
    for c in COLS:
        if c in ("txn_amount_1h", "txn_amount_24h", "dist_from_prev_km", "time_since_prev_h", "speed_kmh"):
            # Half-way values may round to either side.
            np.testing.assert_allclose(got[c], want[c], atol=0.011)
        else:
            assert (got[c].to_numpy() == want[c].to_numpy()).all(), c


def test_only_the_newest_entries_are_kept(spark, transactions):
    one = transactions.withColumns({"cc_num": F.lit(7).cast("long"), "trans_ts": F.lit("2024-01-01").cast("timestamp")})
    folder = scratch_path(spark, "in")
    one.coalesce(1).write.parquet(folder)
    got = run(spark, folder, one.schema, max_history=10, expiry_ms=None)
    assert got.agg(F.max("txn_count_1h"), F.count("*")).first() == (10, 1000)
    assert replay.replay(one, max_history=10).agg(F.max("txn_count_1h"), F.count("*")).first() == (10, 1000)


def test_replay_blocks_equal_whole_cards(transactions):
    skewed = transactions.withColumn("cc_num", F.when(F.col("trans_num") % 3 == 0, 1).otherwise(F.col("cc_num")))
    key = lambda df: df.toPandas().sort_values("trans_num").reset_index(drop=True)
    whole = key(replay.replay(skewed, max_history=20))
    cut = key(replay.replay(skewed, max_history=20, block_rows=50, hot_share=1e-9, min_hot_rows=30))
    assert whole.equals(cut)


def test_invalid_rows_are_set_aside(spark, transactions):
    broken = transactions.withColumn("merch_lat", F.when(F.col("trans_num") % 10 != 0, F.col("merch_lat")))
    assert online.quarantine(broken).count() == 100
    assert replay.replay(broken).count() == 900
    assert online.cold_defaults(broken).filter("cold_start and time_since_prev_h = 999").count() == 100


def test_messages_are_parsed(spark):
    from riskweave.schema import RAW_TRANSACTION
    raw = spark.createDataFrame([('{"trans_num": "a", "cc_num": 5, "amt": 4.97, "unix_time": 1371816865, "merch_lat": 1.0, "merch_long": 2.0}',),
                                 ("not json",)], "value string")
    out = online.with_clock(online.parse_messages(raw, RAW_TRANSACTION), "trans_date_trans_time")
    assert [r["clock_s"] for r in out.filter(online.valid_input()).collect()] == [1371816865]


def test_stream_scoring(spark, transactions):
    from riskweave.plans import training
    trained = training.train(transactions, {"trees": 2, "max_depth": 2, "learning_rate": 0.3})
    broken = transactions.withColumn("merch_lat", F.when(F.col("trans_num") != 5, F.col("merch_lat")))
    folder = scratch_path(spark, "in")
    broken.coalesce(1).write.parquet(folder)
    s = online.score_stream(online.read_stream(spark, folder, broken.schema, "parquet"), trained)
    out = online.run_to_end(s, scratch_path(spark, "out"), scratch_path(spark, "state"), 180).toPandas()
    assert len(out) == 1000 and out.fraud_probability.between(0, 1).all()
    assert (out.reasons.map(len) == 5).all()
    assert out[out.trans_num == 5].warnings.iloc[0].tolist() == [online.NO_INPUT_WARNING]
    assert set(out.decision) <= {"fraud", "not_fraud"}
    assert (out.latency_ms >= 0).all()


def test_amount_behaviour_equals_the_offline_features(spark, transactions):
    """Over several batches, for cards with more transactions than the list holds."""
    from riskweave.operators.history import history_features
    crowded = transactions.withColumn("cc_num", F.col("cc_num") % 4)
    folder = scratch_path(spark, "in")
    for part in range(3):
        crowded.filter(F.col("trans_num").between(part * 334, part * 334 + 333)).coalesce(1).write.mode("append").parquet(folder)
    ordered = crowded.withColumn("trans_ts", F.timestamp_seconds(F.col("trans_num").cast("long")))
    for df, out in ((ordered, folder + "-o"),):
        for part in range(3):
            df.filter(F.col("trans_num").between(part * 334, part * 334 + 333)).coalesce(1).write.mode("append").parquet(out)
    names = ["trans_num", *online.AMOUNT_COLUMNS.names]
    got = run(spark, folder + "-o", ordered.schema, files_per_trigger=1, amounts=True).select(names).toPandas().sort_values("trans_num")
    want = history_features(ordered).select(names).toPandas().sort_values("trans_num")
    assert len(got) == len(want) == 1000 and got.groupby(lambda i: 0).size()[0] == 1000
    for name in names[1:]:
        np.testing.assert_allclose(got[name], want[name], rtol=1e-9, atol=1e-9)


def test_repeated_batches_neither_lose_nor_double_rows(spark, transactions, tmp_path):
    broken = transactions.withColumn("merch_lat", F.when(F.col("trans_num") % 10 != 5, F.col("merch_lat")))
    folder = str(tmp_path / "in")
    for part in range(3):
        broken.filter(F.col("trans_num").between(part * 334, part * 334 + 333)).coalesce(1).write.mode("append").parquet(folder)
    paths = [str(tmp_path / n) for n in ("scored", "rejected", "state")]

    def step():
        stream = online.read_stream(spark, folder, broken.schema, "parquet", files_per_trigger=1)
        rows = online.with_online_features(stream, expiry_ms=None).withColumn("warnings", F.array().cast("array<string>")).unionByName(
            online.cold_defaults(stream).withColumn("warnings", F.array(F.lit(online.NO_INPUT_WARNING))))
        query = online.write_apart(rows, *paths, available_now=True)
        query.awaitTermination()
        return [spark.read.parquet(p).select("trans_num").toPandas()["trans_num"] for p in paths[:2]]
    before = {name: spark.conf.get(name) for name in ("spark.sql.streaming.noDataMicroBatches.enabled",)}
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        first = step()
        # The last batch was written but not noted as done: it runs again.
        last = max((p for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
        last.unlink()
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
        again = step()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for rows in (first, again):
        assert len(rows[0]) == 900 and len(rows[1]) == 100 and not set(rows[0]) & set(rows[1])
        assert rows[0].is_unique and rows[1].is_unique


def test_idle_cards_expire(spark, transactions):
    import time
    folder, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    one = transactions.filter("trans_num < 20").withColumn("cc_num", F.lit(7).cast("long"))

    def step(low, high):
        one.filter(F.col("trans_num").between(low, high)).coalesce(1).write.mode("append").parquet(folder)
        s = online.with_online_features(online.read_stream(spark, folder, one.schema, "parquet"), expiry_ms=4000)
        return {r["trans_num"]: r["cold_start"] for r in online.run_to_end(s, out, state, 120).collect()}

    assert sum(step(0, 9).values()) == 1
    time.sleep(6)
    # Longer than the expiry without a write: the whole list is gone.
    after = step(10, 19)
    assert [after[i] for i in range(10, 20)].count(True) == 1 and after[10]


def test_a_batch_of_a_card_equals_its_rows_one_by_one(monkeypatch):
    monkeypatch.setattr(online, "BLOCK", 7)
    r = np.random.default_rng(5)
    every = np.stack([r.integers(0, 200_000, 60), np.round(r.random(60) * 100, 2), r.random(60), r.random(60)], axis=1).astype(float)
    for first, most in ((0, 100), (0, 1), (13, 10), (59, 100), (60, 5)):
        for digits in (None, 2):
            found = online.online_features_of(every, first, most, digits)
            for k in range(first, 60):
                one = online.online_features(int(every[k, 0]), *every[k, 2:].tolist(), every[max(0, k - most) : k], digits)
                assert [v[k - first] for v in found.values()] == pytest.approx(list(one), rel=1e-12)


def test_a_card_of_a_batch_takes_under_two_thousand_calls():
    """Work per row in Python made the job's time; a batch of a card is handled by columns."""
    class Held:
        def get(self):
            return None

        def update(self, value):
            self.rows = np.frombuffer(value[0]).reshape(-1, 4)
    card, calls = online.CardHistory(["trans_num", "clock_s"], digits=None), []
    card.history = Held()
    n = 400
    batch = pd.DataFrame({"trans_num": np.arange(n)[::-1], "clock_s": np.arange(n) // 3, "amt": 1.0, "merch_lat": 2.0, "merch_long": 3.0})
    sys.setprofile(lambda frame, event, _: calls.append(frame.f_code.co_name) if event == "call" else None)
    try:
        (out,) = card.handleInputRows(("c",), iter([batch]), None)
    finally:
        sys.setprofile(None)
    assert len(calls) < 2000 and len(card.history.rows) == online.MAX_HISTORY
    assert out["clock_s"].is_monotonic_increasing and out["cold_start"].tolist() == [True] + [False] * (n - 1)
    assert out["txn_count_1h"].tolist() == [min(k, 100) for k in range(n)]
