"""End-to-end jobs: train and report, compare imbalance strategies, score new transactions."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from riskweave import schema
from riskweave.functions.scalar import decision
from riskweave.models import boosting, trees, tuning
from riskweave.operators import calibration, costs, encoders, features, imbalance, ranking, splits
from riskweave.session import checkpointed
from riskweave.sources import sinks, transactions as tx

AMOUNT_AWARE = costs.CostMatrix(c_fn=1.0, c_fp=5.0)
FLAT = costs.CostMatrix(c_fn=100.0, c_fp=5.0)
TARGET = schema.TARGET
EXTRA = ("trans_num", "trans_ts", "cc_num")


@dataclass
class TrainedModel:
    """Everything needed to score: features, vector layout, trees, recalibration and operating point."""

    features: features.FeatureModel
    matrix: trees.Matrix
    trees: boosting.Booster
    calibrator: calibration.Calibrator | None
    threshold: float
    report: dict = field(default_factory=dict)

    def score_features(self, engineered: DataFrame, keep=("trans_num",)) -> DataFrame:
        """`keep` columns, calibrated probability `p` and decision."""
        scored = trees.score(self.trees, self.matrix, engineered, list(keep))
        if self.calibrator is not None:
            scored = self.calibrator.transform(scored, "p").drop("p").withColumnRenamed("p_cal", "p")
        return scored.withColumn("decision", decision("p", self.threshold))

    def save(self, spark, path: str) -> None:
        """Encoders, layout, trees, recalibration and operating point below one folder."""
        self.features.encoders.save(f"{path}/encoders")
        self.trees.save(spark, f"{path}/trees")
        if self.calibrator is not None:
            self.calibrator.save(f"{path}/calibrator")
        fm = self.features
        meta = {"columns": self.matrix.columns, "categories": self.matrix.categories, "threshold": self.threshold,
                "calibrator": self.calibrator.method if self.calibrator else None, "windows": fm.windows,
                "night_hours": list(fm.night_hours), "age_fill": fm.age_fill, "time_col": fm.time_col,
                "hot_share": fm.hot_share, "min_hot_rows": fm.min_hot_rows}
        sinks.write_report(spark, meta, f"{path}/manifest")

    @classmethod
    def load(cls, spark, path: str) -> "TrainedModel":
        meta = json.loads(spark.read.text(f"{path}/manifest").first()[0])
        fm = features.FeatureModel(encoders.Encoders.load(spark, f"{path}/encoders"), windows=meta["windows"],
                                   night_hours=tuple(meta["night_hours"]), age_fill=meta["age_fill"], time_col=meta["time_col"],
                                   hot_share=meta["hot_share"], min_hot_rows=meta["min_hot_rows"])
        calibrator = calibration.Calibrator.load(f"{path}/calibrator", meta["calibrator"]) if meta["calibrator"] else None
        return cls(fm, trees.Matrix(meta["columns"], meta["categories"]), boosting.Booster.load(spark, f"{path}/trees"),
                   calibrator, meta["threshold"])


def load_train_test(spark, path: str, test_share: float = 0.2):
    """A folder of splits as written, or a single file that is cut by time."""
    if not tx.exists(spark, path):
        raise FileNotFoundError(f"neither a folder of splits nor a file: {path}")
    if not path.endswith((".csv", ".parquet")):
        return tx.read_splits(spark, path)
    raw = tx.read_table(spark, path)
    rows = raw if "trans_ts" in raw.columns else tx.parse_times(raw)
    both = splits.hold_out(rows, test_share, names=("train", "test"))
    splits.assert_chronological(both, ("train", "test"))
    return splits.take_fold(both, "train"), splits.take_fold(both, "test")


def engineered_folds(transactions: DataFrame, train_share: float = splits.TRAIN_SHARE,
                     val_share: float = splits.VALIDATION_SHARE, **options) -> tuple[features.FeatureModel, DataFrame]:
    """Features of all folds in one pass, with `fold`; written to the shared folder for repeated use.

    Encoders and the age fill come from the fit fold. Windows look back only, so a row of a later
    fold remembers the earlier ones and a fit row never sees them.
    """
    folded = splits.folds(transactions, train_share, val_share)
    splits.assert_chronological(folded, ("fit", "val", "test"))
    fit_rows = splits.take_fold(folded, "fit")
    model = features.fit_features(fit_rows, age_fill="fit", materialise=True, **options)
    model.keep = (*EXTRA, "fold")
    names = model.names(folded)
    out = model.add_all(folded).select(*model.keep, *names, TARGET)
    model.keep = ("trans_num",)
    return model, checkpointed(out)


def feature_columns(engineered: DataFrame) -> list[str]:
    return [c for c in engineered.columns if c in schema.FEATURE_ORDER or c.startswith("txn_")]


def train(transactions: DataFrame, params: dict | None = None, tune_trials: int = 0, tune_timeout_s: float | None = None,
          tune_share: float | None = None, calibration_method: str = "auto", cost: costs.CostMatrix = AMOUNT_AWARE,
          amount: str | None = "amt", floor: float = ranking.PRECISION_FLOOR, refit_with_validation: bool = False,
          feature_options: dict | None = None) -> TrainedModel:
    """Split, engineer, (tune,) fit, calibrate, choose a threshold, refit and report on the test fold.

    By default the model is refit on fit + val only when `refit_with_validation` is set, because the
    calibration fold would then be part of its training rows.
    """
    model, engineered = engineered_folds(transactions, **(feature_options or {}))
    fit, val, test = (splits.take_fold(engineered, f) for f in ("fit", "val", "test"))
    matrix = trees.Matrix.fit(fit, feature_columns(engineered))
    weight = imbalance.class_weight(fit)
    params = dict(params or {})
    report: dict = {"class_weight": weight}
    if tune_trials:
        best, history = tuning.search(fit, val, matrix, tune_trials, tune_timeout_s, tune_share, weight=weight)
        params = {**best, **params}
        report["trials"] = history
    report["params"] = {**trees.BASE_PARAMS, **params}

    keep = ["trans_num", TARGET, "amt"]
    booster = trees.fit_trees(fit, matrix, TARGET, weight, **params)
    val_scores = checkpointed(trees.score(booster, matrix, val, keep).withColumnRenamed(TARGET, "y"))
    report["val_pr_auc"] = ranking.average_precision(val_scores).first()[0]
    calibrator, report["calibration"] = calibration.fit_calibrator(val_scores, calibration_method)
    report["calibration"]["method"] = calibrator.method
    calibrated = calibrator.transform(val_scores).drop("p").withColumnRenamed("p_cal", "p")
    point = costs.best_threshold(calibrated, cost, amount=amount).first().asDict()
    report["validation"] = point
    threshold = point["threshold"]

    if refit_with_validation:
        both = fit.unionByName(val)
        booster = trees.fit_trees(both, matrix, TARGET, imbalance.class_weight(both), **params)
        again = trees.score(booster, matrix, val, keep).withColumnRenamed(TARGET, "y")
        calibrator, _ = calibration.fit_calibrator(again, calibrator.method)

    trained = TrainedModel(model, matrix, booster, calibrator, threshold, report)
    scored = checkpointed(trained.score_features(test, keep).withColumnRenamed(TARGET, "y"))
    report["test"] = ranking.metric_bundle(scored, threshold, floor).first().asDict()
    report["test_cost"] = costs.fixed_threshold_cost(scored, threshold, cost, amount).first().asDict()
    report["test_flat_cost"] = costs.flat_cost(scored, threshold, FLAT.c_fn, FLAT.c_fp).first().asDict()
    return trained


def threshold_report(trained: TrainedModel, cost: costs.CostMatrix = AMOUNT_AWARE) -> dict:
    """Operating point with its costs on validation and test."""
    return {"threshold": trained.threshold, "cost_matrix": vars(cost), "calibration": trained.report["calibration"],
            "validation": trained.report["validation"], "test": trained.report["test_cost"],
            "test_flat_cost": trained.report["test_flat_cost"]}


def oversampled(fit: DataFrame, matrix: trees.Matrix, id_col: str = "trans_num", **options) -> DataFrame:
    """Original and synthetic rows as codes, written to the shared folder; both resampling strategies begin with them."""
    numeric = matrix.numeric(fit).select(id_col, *matrix.columns, TARGET)
    return checkpointed(imbalance.oversample(numeric, matrix.columns, TARGET, id_col, **options))


def resampled(fit: DataFrame, matrix: trees.Matrix, method: str, id_col: str = "trans_num", made: Callable[[], DataFrame] | None = None,
              **options) -> DataFrame:
    """Training rows of a strategy; resampling works on codes and sees the fit fold only. `made` gives `oversampled` rows that exist already."""
    if method not in ("smote", "smote_tomek"):
        raise ValueError(f"unknown method: {method!r}")
    rows = oversampled(fit, matrix, id_col, **options) if made is None else made()
    if method == "smote_tomek":
        rows = checkpointed(imbalance.without_links(rows, imbalance.tomek_links(rows, matrix.columns, TARGET, id_col), id_col))
    return rows


STRATEGIES = ("class_weight", "smote", "smote_tomek")


def fit_strategy(fit: DataFrame, matrix: trees.Matrix, strategy: str, made: Callable[[], DataFrame] | None = None, **params):
    """(model, layout for scoring, training rows) of one imbalance strategy."""
    if strategy == "class_weight":
        return trees.fit_class_weighted(fit, matrix, TARGET, **params), fit.count()
    rows = resampled(fit, matrix, strategy, made=made)
    # The rows already hold codes, so the layout without categories applies; scoring uses `matrix` as is.
    return trees.fit_trees(rows, trees.Matrix(matrix.columns), TARGET, None, **params), rows.count()


def compare_strategies(engineered: DataFrame, floor: float = 0.90, strategies=STRATEGIES, **params) -> DataFrame:
    """Validation metrics per strategy with the same trees; PR-AUC decides.

    Strategies run at a time, as Spark jobs of a thread pool; synthetic rows are made once for all of them.
    """
    fit, val = splits.take_fold(engineered, "fit"), splits.take_fold(engineered, "val")
    matrix = trees.Matrix.fit(fit, feature_columns(engineered))
    inherits = inheritable_thread_target(engineered.sparkSession)
    with ThreadPoolExecutor(len(strategies) + 1) as pool:
        # The place beside the strategies' own: those that wait for these rows can't keep them from being made.
        made = pool.submit(inherits(oversampled), fit, matrix) if set(strategies) - {"class_weight"} else None

        def run(name: str) -> DataFrame:
            model, rows = fit_strategy(fit, matrix, name, made and made.result, **params)
            scored = trees.score(model, matrix, val, [TARGET]).withColumnRenamed(TARGET, "y")
            return checkpointed(ranking.metric_bundle(scored, 0.5, floor).select(
                F.lit(name).alias("approach"), F.lit(rows).cast("long").alias("train_rows"), "*"))
        table = functools.reduce(DataFrame.unionByName, pool.map(inherits(run), strategies))
    return ranking.leaderboard(table)


def confirm_on_test(engineered: DataFrame, strategy: str, floor: float = 0.90, **params) -> DataFrame:
    """Refit the chosen strategy on fit + val and report on the test fold."""
    both = engineered.filter(F.col("fold") != "test").drop("fold")
    test = splits.take_fold(engineered, "test")
    matrix = trees.Matrix.fit(both, feature_columns(engineered))
    model, rows = fit_strategy(both, matrix, strategy, **params)
    scored = trees.score(model, matrix, test, [TARGET]).withColumnRenamed(TARGET, "y")
    return ranking.metric_bundle(scored, 0.5, floor).select(
        F.lit(strategy).alias("approach"), F.lit(rows).cast("long").alias("train_rows"), "*")


def baseline(transactions: DataFrame, **params) -> DataFrame:
    """Six row-local features, class weights, test metrics."""
    both = splits.train_test(transactions)
    splits.assert_chronological(both, ("train", "test"))
    plain = features.calendar_features(both).withColumn(
        "age", F.round(F.datediff("trans_ts", "dob") / F.lit(365.25), 1))
    train_rows, test_rows = splits.take_fold(plain, "train"), splits.take_fold(plain, "test")
    matrix = trees.Matrix.fit(train_rows, trees.BASELINE_FEATURES)
    model = trees.fit_class_weighted(train_rows, matrix, TARGET, **params)
    scored = trees.score(model, matrix, test_rows, [TARGET]).withColumnRenamed(TARGET, "y")
    return ranking.metric_bundle(scored, 0.5).select(F.lit("baseline").alias("approach"), "*")
