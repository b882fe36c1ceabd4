import pytest
from pyspark.sql import functions as F

from riskweave.operators import encoders

ROWS = [("a", "x", 1), ("a", "x", 0), ("b", "x", 0), (None, "y", 1)]


@pytest.fixture
def train(spark):
    return spark.createDataFrame(ROWS, "merchant string, category string, is_fraud int")


def test_values(spark, train):
    fitted = encoders.fit_encoders(train)
    rows = {r["merchant"]: r for r in fitted.transform(spark.createDataFrame(
        [("a", "x"), ("b", "y"), ("new", "x"), (None, "z")], "merchant string, category string")).collect()}
    assert rows["a"]["merchant_freq"] == 0.5 and rows["b"]["merchant_freq"] == 0.25
    assert rows["a"]["merchant_target_enc"] == pytest.approx((1 + 0.5 * 50) / 52)
    assert rows["new"]["merchant_freq"] == 0 and rows["new"]["merchant_target_enc"] == 0.5
    assert rows[None]["merchant_freq"] == 0 and rows[None]["category_target_enc"] == 0.5


def test_labels_outside_training_have_no_influence(spark, train):
    fitted = encoders.fit_encoders(train)
    other = spark.createDataFrame([("a", "x", 0), ("a", "x", 1)], "merchant string, category string, is_fraud int")
    a = fitted.transform(other).drop("is_fraud").distinct().collect()
    b = fitted.transform(other.withColumn("is_fraud", F.lit(1))).drop("is_fraud").distinct().collect()
    assert a == b


def test_large_tables_are_not_broadcast(spark, train):
    fitted = encoders.fit_encoders(train, broadcast_rows=2)
    assert not any(fitted.small.values())
    assert fitted.transform(train).count() == 4


def test_save_and_load(spark, train, tmp_path):
    fitted = encoders.fit_encoders(train)
    fitted.save(str(tmp_path / "enc"))
    again = encoders.Encoders.load(spark, str(tmp_path / "enc"))
    key = lambda r: str(r)
    assert sorted(fitted.transform(train).collect(), key=key) == sorted(again.transform(train).collect(), key=key)
