import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import schema
from riskweave.functions import scalar
from riskweave.operators import eda, splits
from riskweave.sources import sinks, transactions as tx

HEADER = ("trans_date_trans_time,cc_num,merchant,category,amt,first,last,gender,street,city,state,zip,lat,long,city_pop,job,dob,"
          "trans_num,unix_time,merch_lat,merch_long,is_fraud\n")
LINE = "2020-06-21 12:14:25,{},m,misc_net,4.97,a,b,F,s,c,WI,1,45.8,-90.3,3495,j,{},t{},1371816865,36.0,-82.0,0\n"


def test_a_folder_of_files_with_different_headers(spark, tmp_path):
    names = [f.name for f in schema.RAW_TRANSACTION]
    value = lambda n, k: {"cc_num": str(k), "amt": f"{k}.5", "trans_num": f"t{k}"}.get(n, "")
    folder = tmp_path / "raw"
    folder.mkdir()
    line = lambda columns, k: ",".join(value(n, k) for n in columns) + "\n"
    (folder / "a.csv").write_text(",".join(names) + "\n" + line(names, 1) + line(names, 2))
    (folder / "b.csv").write_text(",".join(names[::-1]) + "\n" + line(names[::-1], 3))
    import gzip
    with gzip.open(folder / "c.csv.gz", "wt") as file:
        file.write("index," + ",".join(names) + "\n7," + line(names, 4))
    (folder / "_note").write_text("not data")
    (folder / "empty.csv").write_text("")
    got = {(r.cc_num, r.amt, r.trans_num) for r in tx.read_csv(spark, str(folder)).collect()}
    assert got == {(k, k + 0.5, f"t{k}") for k in (1, 2, 3, 4)}
    (folder / "d.csv").write_text("cc_num,amt\n1,2\n")
    with pytest.raises(ValueError, match="lacks column"):
        tx.read_csv(spark, str(folder))


def test_csv_files_stack_and_parse(spark, tmp_path):
    paths = []
    for i, dob in enumerate(("1988-03-09", "unknown")):
        path = tmp_path / f"raw{i}.csv"
        path.write_text(HEADER + LINE.format(i, dob, i))
        paths.append(str(path))
    out = tx.parse_times(tx.read_csv(spark, *paths)).orderBy("cc_num").collect()
    assert [str(r["dob"]) for r in out] == ["1988-03-09", "None"]
    assert out[0]["trans_ts"].hour == 12 and out[0]["city_pop"] == 3495
    assert tx.read_table(spark, paths[0]).count() == 1


def test_splits_round_trip(spark, transactions, tmp_path):
    sinks.write_splits(splits.train_test(transactions).withColumn("hour", F.lit(1)), str(tmp_path / "s"))
    train, test = tx.read_splits(spark, str(tmp_path / "s"))
    assert (train.count(), test.count()) == (800, 200) and "hour" not in train.columns
    sinks.write_csv(eda.rate_by_hour(transactions), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 24


def test_columns_are_pruned_into_the_scan(spark, data_dir):
    few = eda.rate_by_value(tx.table(spark, data_dir, "lineitem").filter("l_quantity > 10"), "l_returnflag", "l_discount")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan


def test_scalars(spark):
    row = spark.range(1).select(
        scalar.day_of_week(F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("dow"),
        scalar.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        scalar.haversine_km(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("none"),
        scalar.implied_speed(F.lit(2.0), F.lit(0.0)).alias("still"),
        scalar.category_code(F.lit("b"), ["c", "b"]).alias("code"),
        scalar.category_code(F.lit(None).cast("string"), ["c", "b"]).alias("nocode"),
        scalar.clip(F.lit(None).cast("double"), 0.0, 1.0).alias("noclip")).first()
    assert row["dow"] == 0 and row["half"] == pytest.approx(np.pi * scalar.EARTH_RADIUS_KM)
    assert row["none"] is None and row["still"] == 0 and row["noclip"] is None
    assert (row["code"], row["nocode"]) == (0, -1)


def test_histogram_equals_numpy(transactions):
    values = np.array([r[0] for r in transactions.select("amt").collect()])
    counts, edges = np.histogram(values, 30)
    got = eda.histogram(transactions, "amt", 30).toPandas().sort_values("bin")
    assert got.n.tolist() == counts.tolist()
    np.testing.assert_allclose(got.left_edge, edges[:-1])
    density = eda.histogram(transactions, "amt", 30, density=True).toPandas().sort_values("bin").density
    np.testing.assert_allclose(density, np.histogram(values, 30, density=True)[0])


def test_histogram_of_one_value(spark):
    got = eda.histogram(spark.range(5).select(F.lit(3.0).alias("amt")), "amt", 4).toPandas().sort_values("bin")
    assert got.n.tolist() == np.histogram([3.0] * 5, 4)[0].tolist()


def test_latency_percentiles(spark):
    log = spark.range(1, 201).select(F.col("id").cast("double").alias("latency_ms"), (F.col("id") * 1_000_000).alias("started_us"),
                                     (F.col("id") * 1_000_000 + 5).alias("finished_us"))
    row = eda.latency_summary(log, rows_per_task=30).first()
    assert (row["p50"], row["p95"], row["p99"], row["max_ms"]) == (100.0, 190.0, 198.0, 200.0)


def test_missing_audit(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert {r["column_name"]: (r["missing"], r["missing_pct"]) for r in eda.missing_audit(rows).collect()} == {"a": (1, 33.33), "b": (2, 66.67)}
