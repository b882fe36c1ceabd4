"""Named queries over the shared tables, one per operator.

Every query reads its tables whole. Doubles are rounded so that engines which add in a different
order agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave import schema
from riskweave.functions import scalar
from riskweave.models import explain, trees, tuning
from riskweave.operators import (
    calibration, costs, eda, encoders, features, history, imbalance, ordered, ranking, splits)
from riskweave.plans import training
from riskweave.session import scratch_path
from riskweave.sources import runs, transactions as tx
from riskweave.streaming import online, replay

DIGITS = 6
# Fixed values used by the cost queries.
FLAT = costs.CostMatrix(c_fn=100.0, c_fp=5.0)
AMOUNT_AWARE = costs.CostMatrix(c_fn=1.0, c_fp=5.0)
WITH_REVIEW = costs.CostMatrix(c_fn=1.0, c_fp=5.0, c_tp=2.0, c_tn=0.01)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    # Means of cents and micros in hours can end in an exact 5 behind the last digit; the nudge keeps
    # them on one side.
    nudge = F.lit(float(f"1.2345678e-{digits + 2}"))
    return df.select(*[F.round(F.col(f"`{n}`") + nudge, digits).alias(n) if k == "double" else F.col(f"`{n}`")
                       for n, k in df.dtypes])


def _folds(spark, d):
    return splits.folds(tx.transactions(spark, d))


def _train_test(spark, d):
    both = splits.train_test(tx.transactions(spark, d))
    return splits.take_fold(both, "train"), splits.take_fold(both, "test")


# ---- features ---------------------------------------------------------------------------------

def time_features(spark, d):
    return features.calendar_features(tx.transactions(spark, d)).select("trans_num", "hour", "day_of_week", "is_night")


def _history(spark, d):
    t = tx.transactions(spark, d).select("trans_num", "cc_num", "trans_ts", "amt", "merch_lat", "merch_long")
    return history.history_features(t)


def card_velocity(spark, d):
    return rounded(_history(spark, d).select("trans_num", "txn_count_1h", "txn_amount_1h", "txn_count_24h", "txn_amount_24h"))


def amount_behaviour(spark, d):
    return rounded(_history(spark, d).select("trans_num", "amt_hist_mean", "amt_hist_std", "amt_zscore"))


def geo_travel(spark, d):
    return rounded(_history(spark, d).select("trans_num", "dist_from_prev_km", "time_since_prev_h", "speed_kmh"))


def tied_history(spark, d):
    out = history.history_features(tx.tied_transactions(spark, d), windows={"30d": 30 * 24, "90d": 90 * 24})
    return rounded(out.select("trans_num", "txn_count_30d", "txn_amount_30d", "txn_count_90d", "txn_amount_90d",
                              "amt_hist_mean", "amt_hist_std", "time_since_prev_h"), 4)


def customer_age(spark, d):
    return rounded(features.customer_age(tx.transactions(spark, d)).select("trans_num", "age"))


def frequency_encoding(spark, d):
    t = tx.transactions(spark, d)
    train, _ = _train_test(spark, d)
    fitted = encoders.fit_encoders(train, target_columns=())
    return rounded(fitted.transform(t).select("trans_num", "merchant_freq", "category_freq"))


def target_encoding(spark, d):
    t = tx.transactions(spark, d)
    train, _ = _train_test(spark, d)
    fitted = encoders.fit_encoders(train, frequency=())
    return rounded(fitted.transform(t).select("trans_num", "category_target_enc", "merchant_target_enc"))


def encoder_tables(spark, d):
    t = tx.transactions(spark, d)
    return rounded(encoders.frequency_table(t, "category").join(encoders.target_table(t, "category"), "category"))


def engineered_features(spark, d):
    train, _ = _train_test(spark, d)
    return rounded(features.fit_features(train).transform(tx.transactions(spark, d)))


def history_transform(spark, d):
    train, test = _train_test(spark, d)
    return rounded(features.fit_features(train).transform_with_past(train, test))


def feature_gaps(spark, d):
    train, _ = _train_test(spark, d)
    return features.missing_values(features.fit_features(train).transform(tx.transactions(spark, d)))


def defaults_without_profile(spark, d):
    """Optional columns absent from the input: population 0, gender 'U', no age."""
    t = tx.transactions(spark, d).drop("dob", "city_pop", "gender")
    out = features.fit_features(t).transform(t)
    return rounded(out.select("trans_num", "city_pop", "gender", "merchant_freq", F.lit(len(out.columns)).alias("columns_n")))


def categories(spark, d):
    """Training vocabulary applied to all rows: unseen values become null, codes become -1."""
    t = tx.transactions(spark, d)
    training = t.filter((F.col("amt") > 20) & (F.col("category") != "error"))
    return encoders.with_known_category(t, encoders.category_table(training, "category"), "category").select(
        "trans_num", "category", "category_code")


def raw_csv_stack(spark, d):
    """All transactions written as raw CSV files of two layouts, one with a further first column, into one folder and stacked again."""
    t = tx.transactions(spark, d)
    there = {"trans_date_trans_time": F.date_format("trans_ts", "yyyy-MM-dd HH:mm:ss"), "unix_time": F.unix_timestamp("trans_ts")}
    columns = [(there[f.name] if f.name in there else F.col(f.name) if f.name in t.columns else F.lit("x")).alias(f.name)
               for f in schema.RAW_TRANSACTION]
    folder = scratch_path(spark, "raw")
    t.filter("trans_num % 2 = 0").select(F.monotonically_increasing_id().alias("index"), *columns).write.csv(folder, header=True)
    t.filter("trans_num % 2 = 1").select(*columns[::-1]).write.mode("append").csv(folder, header=True)
    back = tx.parse_times(tx.read_csv(spark, folder))
    return rounded(back.select(F.col("trans_num").cast("long").alias("trans_num"), "cc_num", F.unix_timestamp("trans_ts").alias("clock_s"),
                               "amt", "category", "gender", F.col("city_pop").cast("int").alias("city_pop"), "is_fraud",
                               F.col("dob").isNull().cast("int").alias("dob_missing")))


def event_clock(spark, d):
    """The numeric clock where present, else the parsed timestamp."""
    t = tx.transactions(spark, d)
    unix = F.when(F.col("trans_num") % 3 == 0, F.lit(None)).otherwise(F.unix_timestamp("trans_ts") - 86400)
    return t.select("trans_num", scalar.online_clock(unix, "trans_ts").alias("clock_s"),
                    scalar.lenient_date(F.when(F.col("trans_num") % 5 == 0, "not a date")
                                        .otherwise(F.col("dob").cast("string"))).isNull().cast("int").alias("dob_missing"))


def travel_from_home(spark, d):
    """Great-circle distance to a fixed point, for every row."""
    return rounded(tx.transactions(spark, d).select(
        "trans_num", scalar.haversine_km("merch_lat", "merch_long", F.lit(40.0), F.lit(-100.0)).alias("km")))


def decisions(spark, d):
    return rounded(tx.scores(spark, d).select("id", scalar.half_even("p", 4).alias("p4"), scalar.decision("p", 0.1).alias("decision")), 4)


# ---- splits -----------------------------------------------------------------------------------

def chrono_split(spark, d):
    return splits.train_test(tx.transactions(spark, d)).select("trans_num", "fold")


def chrono_folds(spark, d):
    return _folds(spark, d).select("trans_num", "fold")


def tied_split(spark, d):
    return splits.train_test(tx.tied_transactions(spark, d), train_share=0.7).select("trans_num", "fold")


def recent_subsample(spark, d):
    train, test = _train_test(spark, d)
    return splits.most_recent(train, 0.1).select("trans_num", F.lit("train").alias("part")).unionByName(
        splits.most_recent(test, 0.1).select("trans_num", F.lit("test").alias("part")))


def tuning_tail(spark, d):
    return splits.tuning_tail(_train_test(spark, d)[0], 0.3).select("trans_num")


def fold_bounds(spark, d):
    f = _folds(spark, d)
    splits.assert_chronological(f, ("fit", "val", "test"))
    return f.groupBy("fold").agg(F.unix_micros(F.min("trans_ts")).alias("first_us"), F.unix_micros(F.max("trans_ts")).alias("last_us"))


def fit_plus_val(spark, d):
    f = _folds(spark, d)
    return splits.take_fold(f, "fit").unionByName(splits.take_fold(f, "val")).select("trans_num", "is_fraud")


def seeded_sample(spark, d):
    return splits.seeded_sample(tx.transactions(spark, d), 4000).select("trans_num")


def highest_scored_positive(spark, d):
    return rounded(tx.scores(spark, d).filter("y = 1").orderBy(F.desc("p"), "id").limit(1).select("id", "p"))


# ---- exploratory aggregates -------------------------------------------------------------------

def split_summary(spark, d):
    return rounded(eda.split_summary(_folds(spark, d)))


def missing_audit(spark, d):
    return rounded(eda.missing_audit(tx.transactions(spark, d)))


def class_balance(spark, d):
    return rounded(eda.class_balance(_folds(spark, d)))


def class_ratio(spark, d):
    return rounded(eda.class_ratio(splits.take_fold(_folds(spark, d), "fit")))


def amount_describe(spark, d):
    return rounded(eda.describe(tx.transactions(spark, d)))


def order_value_describe(spark, d):
    return rounded(eda.describe(tx.table(spark, d, "lineitem"), "l_extendedprice"), 3)


def amount_by_class(spark, d):
    return rounded(eda.by_class(tx.transactions(spark, d)))


def rate_by_hour(spark, d):
    return rounded(eda.rate_by_hour(tx.transactions(spark, d)))


def top_hours(spark, d):
    return rounded(eda.top_hours(tx.transactions(spark, d)))


def rate_by_category(spark, d):
    return rounded(eda.rate_by_value(tx.transactions(spark, d), "category"))


def rate_by_merchant(spark, d):
    return rounded(eda.rate_by_value(tx.transactions(spark, d), "merchant", at_least=100, top=20))


def distinct_merchants(spark, d):
    return eda.distinct_count(tx.transactions(spark, d))


def time_range(spark, d):
    return eda.time_range(tx.transactions(spark, d))


def amount_histogram(spark, d):
    return rounded(eda.histogram(tx.transactions(spark, d), "amt", 100))


def small_amount_histogram(spark, d):
    return rounded(eda.histogram(tx.transactions(spark, d).filter("amt < 500"), "amt", 100))


def class_histogram(spark, d):
    return rounded(eda.histogram(tx.transactions(spark, d), "amt", 80, by="is_fraud"))


def clipped_histogram(spark, d):
    return rounded(eda.histogram(eda.clipped(tx.transactions(spark, d), "amt"), "amt", 40, by="is_fraud", density=True))


def quantile_grid(spark, d):
    probs = [i / 20 for i in range(21)]
    values = ordered.exact_quantiles(tx.table(spark, d, "lineitem"), "l_extendedprice", probs)
    return rounded(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "step int, value double"))


def latency_summary(spark, d):
    log = tx.table(spark, d, "events").select(
        F.col("value").alias("latency_ms"), F.unix_micros("ts").alias("started_us"),
        (F.unix_micros("ts") + F.round(F.col("value") * 1000).cast("long")).alias("finished_us"))
    return rounded(eda.latency_summary(log))


# ---- ranking, cost and calibration ------------------------------------------------------------

def confusion(spark, d):
    return ranking.confusion(tx.scores(spark, d), 0.2)


def point_metrics(spark, d):
    return rounded(ranking.with_rates(ranking.confusion(tx.scores(spark, d), 0.2)))


def average_precision(spark, d):
    s = tx.scores(spark, d)
    return rounded(ranking.average_precision(s).withColumn("average_precision_tied", ranking.average_precision(s, score="p_tied").scalar()))


def base_rate(spark, d):
    return rounded(tx.scores(spark, d).agg(F.avg("y").alias("base_rate")))


def roc_auc(spark, d):
    s = tx.scores(spark, d)
    return rounded(ranking.roc_auc(s).withColumn("roc_auc_tied", ranking.roc_auc(s, score="p_tied").scalar()))


def pr_curve(spark, d):
    return rounded(ranking.pr_curve(tx.scores(spark, d)))


def roc_curve(spark, d):
    return rounded(ranking.roc_curve(tx.scores(spark, d), score="p_tied"))


def recall_at_precision(spark, d):
    return rounded(ranking.recall_at_precision(tx.scores(spark, d), floor=0.15))


def threshold_at_precision(spark, d):
    return rounded(ranking.threshold_at_precision(tx.scores(spark, d), floor=0.15))


def metric_bundle(spark, d):
    return rounded(ranking.metric_bundle(tx.scores(spark, d), threshold=0.3, floor=0.15, score="p_tied"))


def classification_report(spark, d):
    return ranking.classification_report(tx.scores(spark, d), 0.3)


def flat_cost(spark, d):
    return rounded(costs.flat_cost(tx.scores(spark, d), 0.2))


def amount_cost(spark, d):
    return rounded(costs.fixed_threshold_cost(tx.scores(spark, d), 0.2, AMOUNT_AWARE, "amt"))


def threshold_sweep(spark, d):
    return rounded(costs.sweep(tx.scores(spark, d), WITH_REVIEW, "amt"))


def threshold_sweep_exact(spark, d):
    return rounded(costs.sweep(tx.scores(spark, d), FLAT, grid="exact", score="p_tied"))


def best_threshold(spark, d):
    return rounded(costs.best_threshold(tx.scores(spark, d), AMOUNT_AWARE, amount="amt"))


def f1_threshold(spark, d):
    return rounded(costs.saving_over_f1(tx.scores(spark, d), AMOUNT_AWARE, "amt"))


def brier_log_loss(spark, d):
    return rounded(calibration.brier_log_loss(tx.scores(spark, d), score="p_tied"))


def reliability_curve(spark, d):
    return rounded(calibration.reliability_curve(tx.scores(spark, d)))


def isotonic_calibration(spark, d):
    s = tx.scores(spark, d)
    return rounded(calibration.fit_isotonic(s, score="p_tied").transform(s, "p_tied").select("id", "p_cal"))


def platt_calibration(spark, d):
    s = tx.scores(spark, d)
    return rounded(calibration.fit_platt(s, score="p_tied").transform(s, "p_tied").select("id", "p_cal"), 4)


def calibrator_choice(spark, d):
    chosen, metrics = calibration.fit_calibrator(tx.scores(spark, d))
    return rounded(spark.createDataFrame([(chosen.method, *metrics.values())],
                                         "method string, " + ", ".join(f"{m} double" for m in metrics)), 4)


def calibrator_choice_tied(spark, d):
    """The same choice on scores with few values."""
    chosen, metrics = calibration.fit_calibrator(tx.scores(spark, d), score="p_tied")
    return rounded(spark.createDataFrame([(chosen.method, *metrics.values())],
                                         "method string, " + ", ".join(f"{m} double" for m in metrics)), 4)


# ---- run records ------------------------------------------------------------------------------

def run_leaderboard(spark, d):
    """Each category's score set is one run."""
    runs = ranking.metric_bundle(tx.scores(spark, d).filter("category is not null"), threshold=0.2, by=["category"])
    return rounded(ranking.leaderboard(runs.select(F.col("category").alias("approach"), "pr_auc", "roc_auc", "recall")))


def running_best(spark, d):
    """Each day's mean amount is one trial's objective."""
    days = tx.transactions(spark, d).groupBy(F.datediff("trans_ts", F.lit("2024-01-01").cast("date")).alias("trial")).agg(F.avg("amt").alias("objective"))
    return rounded(ranking.running_best(days, "trial", "objective"))


def alias_latest(spark, d):
    """Orders as model versions: newest version per (name, alias)."""
    o = tx.table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("name"), F.col("o_orderkey").alias("version"),
        F.col("o_orderstatus").alias("alias"), F.col("o_orderdate").alias("assigned_at"), F.lit("").alias("path"))
    return runs.latest_aliases(o).select("name", "alias", "version")


# ---- online features --------------------------------------------------------------------------

def online_features_replay(spark, d):
    out = replay.replay(tx.transactions(spark, d), digits=None)
    return rounded(out.withColumn("cold_start", F.col("cold_start").cast("int")), 2)


def online_overwrite(spark, d):
    """History columns of the engineered frame replaced by the online ones."""
    t = tx.transactions(spark, d)
    fresh = online.overwrite_with_online(_history(spark, d), replay.replay(t, digits=None))
    return rounded(fresh.select("trans_num", *online.ONLINE_COLUMNS.names, "amt_hist_mean"), 2)


def _event_stream(spark, d):
    struct = spark.read.parquet(f"{d}/events.parquet").schema
    raw = online.read_stream(spark, d, struct, "parquet", pattern="events.parquet")
    return tx.as_transactions(raw).withColumn("ingest_ms", F.lit(0).cast("long"))


def stream_online_features(spark, d):
    out = online.with_online_features(_event_stream(spark, d), digits=None).select(
        "trans_num", *online.ONLINE_COLUMNS.names, F.col("cold_start").cast("int").alias("cold_start"))
    return rounded(online.run_to_end(out, scratch_path(spark, "online"), scratch_path(spark, "online-state")), 2)


def stream_scores(spark, d):
    """Calibrated probability, decision and reasons of every event, scored as a stream."""
    trained = training.train(tx.transactions(spark, d))
    out = online.score_stream(_event_stream(spark, d), trained).drop("latency_ms")
    return online.run_to_end(out, scratch_path(spark, "scores"), scratch_path(spark, "scores-state"))


# ---- resampling -------------------------------------------------------------------------------

POINT = ["amt", "merch_lat", "merch_long", "city_pop"]


def minority_neighbours(spark, d):
    fraud = tx.transactions(spark, d).filter("is_fraud = 1")
    near = imbalance.minority_neighbours(fraud, POINT)
    return near.select("trans_num", F.posexplode("near").alias("pos", "n")).select(
        "trans_num", (F.col("pos") + 1).alias("place"), F.col("n.neighbour").alias("neighbour"))


def smote(spark, d):
    return rounded(imbalance.synthetic_minority(tx.transactions(spark, d), POINT))


def tomek_links(spark, d):
    return imbalance.tomek_links(tx.transactions(spark, d), POINT)


def without_tomek_links(spark, d):
    t = tx.transactions(spark, d)
    return imbalance.without_links(t, imbalance.tomek_links(t, POINT)).select("trans_num", "is_fraud")


# ---- models -----------------------------------------------------------------------------------

def train_report(spark, d):
    """The whole training job; one row of test metrics."""
    trained = training.train(tx.transactions(spark, d))
    test = {k: float(v) for k, v in trained.report["test"].items()}
    row = (trained.calibrator.method, float(trained.threshold), float(trained.report["val_pr_auc"]),
           float(trained.report["test_cost"]["cost_per_txn"]), *test.values())
    return rounded(spark.createDataFrame([row], "calibrator string, threshold double, val_pr_auc double, cost_per_txn double, "
                                         + ", ".join(f"{k} double" for k in test)))


def _fitted(spark, d):
    _, engineered = training.engineered_folds(tx.transactions(spark, d))
    fit = splits.take_fold(engineered, "fit")
    matrix = trees.Matrix.fit(fit, training.feature_columns(engineered))
    return engineered, matrix, trees.fit_class_weighted(fit, matrix)


def batch_scores(spark, d):
    engineered, matrix, model = _fitted(spark, d)
    return rounded(trees.score(model, matrix, engineered, ["trans_num", "fold"]))


def split_importance(spark, d):
    _, matrix, model = _fitted(spark, d)
    return rounded(trees.split_importance(model, matrix, spark))


def split_counts(spark, d):
    _, matrix, model = _fitted(spark, d)
    return trees.split_counts(model, matrix, spark)


def attributions(spark, d):
    engineered, matrix, model = _fitted(spark, d)
    return rounded(explain.attributions(model, matrix, engineered))


def attribution_importance(spark, d):
    engineered, matrix, model = _fitted(spark, d)
    return rounded(explain.global_importance(explain.attributions(model, matrix, engineered), matrix.columns))


def top_reasons(spark, d):
    engineered, matrix, model = _fitted(spark, d)
    return explain.reasons(model, matrix, engineered, top=6)


def six_feature_baseline(spark, d):
    return rounded(training.baseline(tx.transactions(spark, d)))


def imbalance_comparison(spark, d):
    _, engineered = training.engineered_folds(tx.transactions(spark, d))
    return rounded(training.compare_strategies(engineered))


def winner_on_test(spark, d):
    """The best strategy of the comparison, refit on fit + val, on the test fold."""
    _, engineered = training.engineered_folds(tx.transactions(spark, d))
    winner = training.compare_strategies(engineered).first()["approach"]
    return rounded(training.confirm_on_test(engineered, winner))


def tuning_trials(spark, d):
    """25 guided trials over the whole space, each on the latest half of the fit fold, scored on the validation fold."""
    _, engineered = training.engineered_folds(tx.transactions(spark, d))
    fit, val = splits.take_fold(engineered, "fit"), splits.take_fold(engineered, "val")
    matrix = trees.Matrix.fit(fit, training.feature_columns(engineered))
    _, history = tuning.search(fit, val, matrix, trials=25, recent_share=0.5)
    rows = spark.createDataFrame([(t["trial"], t["pr_auc"]) for t in history], "trial int, pr_auc double")
    return rounded(ranking.running_best(rows, "trial", "pr_auc"))


QUERIES = {f.__name__: f for f in (
    time_features, card_velocity, amount_behaviour, geo_travel, tied_history, customer_age, frequency_encoding,
    target_encoding, encoder_tables, engineered_features, history_transform, feature_gaps, defaults_without_profile,
    categories, raw_csv_stack, event_clock, travel_from_home, decisions,
    chrono_split, chrono_folds, tied_split, recent_subsample, tuning_tail, fold_bounds, fit_plus_val, seeded_sample,
    highest_scored_positive,
    split_summary, missing_audit, class_balance, class_ratio, amount_describe, order_value_describe, amount_by_class,
    rate_by_hour, top_hours, rate_by_category, rate_by_merchant, distinct_merchants, time_range, amount_histogram,
    small_amount_histogram, class_histogram, clipped_histogram, quantile_grid, latency_summary,
    confusion, point_metrics, average_precision, base_rate, roc_auc, pr_curve, roc_curve, recall_at_precision,
    threshold_at_precision, metric_bundle, classification_report, flat_cost, amount_cost, threshold_sweep,
    threshold_sweep_exact, best_threshold, f1_threshold, brier_log_loss, reliability_curve, isotonic_calibration,
    platt_calibration, calibrator_choice, calibrator_choice_tied, run_leaderboard, running_best, alias_latest,
    online_features_replay, online_overwrite, stream_online_features, stream_scores,
    minority_neighbours, smote, tomek_links, without_tomek_links,
    train_report, batch_scores, split_importance, split_counts, attributions, attribution_importance, top_reasons,
    six_feature_baseline, imbalance_comparison, winner_on_test, tuning_trials)}
