"""No operator forgets rows, groups or values because there are many of them; raw files are read by name."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import schema
from riskweave.operators import eda, encoders, ranking, splits
from riskweave.sources import sinks, transactions as tx

NAMES = [f.name for f in schema.RAW_TRANSACTION]
ROW = {"trans_date_trans_time": "2020-06-21 12:14:25", "merchant": "m", "category": "misc_net", "amt": "4.97", "first": "a", "last": "b",
       "gender": "F", "street": "s", "city": "c", "state": "WI", "zip": "1", "lat": "45.8", "long": "-90.3", "city_pop": "3495", "job": "j",
       "dob": "1988-03-09", "trans_num": "t", "unix_time": "1371816865", "merch_lat": "36.0", "merch_long": "-82.0", "is_fraud": "1"}


def write(path, names, index=False, **values):
    row = {**ROW, "cc_num": "7", **values}
    lines = [("," if index else "") + ",".join(names), ("0," if index else "") + ",".join(row[n] for n in names)]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_raw_files_are_read_by_name(spark, tmp_path):
    paths = [write(tmp_path / "index.csv", NAMES, index=True, cc_num="1"), write(tmp_path / "turned.csv", NAMES[::-1], cc_num="2"),
             write(tmp_path / "plain.csv", NAMES, cc_num="3", amt="bad")]
    rows = {r["cc_num"]: r for r in tx.parse_times(tx.read_csv(spark, *paths)).collect()}
    assert set(rows) == {1, 2, 3}
    for n in (1, 2):
        assert rows[n]["amt"] == 4.97 and rows[n]["is_fraud"] == 1 and rows[n]["trans_num"] == "t"
        assert str(rows[n]["dob"]) == "1988-03-09" and rows[n]["trans_ts"].hour == 12
    assert rows[3]["amt"] is None
    with pytest.raises(ValueError, match="amt"):
        tx.read_csv(spark, write(tmp_path / "less.csv", [n for n in NAMES if n != "amt"]))


def test_splits_as_csv(spark, transactions, tmp_path):
    from riskweave.plans import training
    cut = splits.train_test(transactions)
    sinks.write_splits(cut, str(tmp_path / "s"), fmt="csv")
    train, test = training.load_train_test(spark, str(tmp_path / "s"))
    assert (train.count(), test.count()) == (800, 200)
    assert dict(train.dtypes)["amt"] == "double" and train.filter("trans_ts is null").count() == 0
    (tmp_path / "raw").mkdir()
    for fold in ("train", "test"):
        write(tmp_path / "raw" / f"{fold}.csv", NAMES, index=True, merchant=fold)
    assert [part.first()["merchant"] for part in training.load_train_test(spark, str(tmp_path / "raw"))] == ["train", "test"]
    with pytest.raises(FileNotFoundError):
        training.load_train_test(spark, str(tmp_path / "nothing"))


def test_many_categories(spark):
    words = [f"{'äbc'[i % 3]}{i:05d}" for i in range(1500)]
    train = spark.createDataFrame([(w,) for w in words] + [(None,)], "category string")
    rows = spark.createDataFrame([(w,) for w in words] + [("new",), (None,)], "category string")
    got = encoders.with_known_category(rows, encoders.category_table(train, "category"), "category").collect()
    code = {w: i for i, w in enumerate(sorted(words))}
    assert sorted((r[0] or "", r[1]) for r in got) == sorted([*code.items(), ("", -1), ("", -1)])


def test_many_classes_and_runs(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 1200), float(rng.integers(0, 40)), int(rng.integers(0, 2))) for i in range(9000)] + [(None, 1.0, 0), (3, float("nan"), 1)]
    df = spark.createDataFrame(rows, "k int, amt double, y int")
    got = {r["k"]: r for r in eda.by_class(df, "amt", "k", rows_per_task=2000).collect()}
    assert len(got) == 1201
    for k in (None, 0, 3, 700):
        values = [a for i, a, _ in rows if i == k and not np.isnan(a)]
        assert got[k]["n"] == len(values) and got[k]["median"] == np.median(values) and got[k]["max"] == max(values)
    assert eda.histogram(df, "amt", 5, by="k").select("k").distinct().count() == 1200
    runs = ranking.metric_bundle(df.withColumnRenamed("amt", "p").filter("k is not null and not isnan(p)"), 20.0, by=["k"]).collect()
    assert len(runs) == 1200
    for r in (x for x in runs if x["k"] in (5, 900)):
        one = ranking.metric_bundle(df.withColumnRenamed("amt", "p").filter((F.col("k") == r["k"]) & ~F.isnan("p")), 20.0).first()
        assert {k: v for k, v in r.asDict().items() if k != "k"} == one.asDict()


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "amt double")
    row = eda.describe(df).first()
    assert (row["n"], row["mean"], row["max"]) == (2, 2.0, 3.0)
    assert eda.missing_audit(df).first()["missing"] == 2


def test_rates_are_sorted_without_nulls(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), (None, 1), ("c", 1), ("c", 0)], "k string, is_fraud int")
    assert [r["k"] for r in eda.rate_by_value(df, "k").collect()] == ["b", "c", "a"]
