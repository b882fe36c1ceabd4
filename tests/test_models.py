"""Trees, attributions and the training job on small settings."""

import itertools
import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.models import boosting, explain, trees, tuning
from riskweave.plans import training
from riskweave.operators import ranking, splits
from riskweave.sources import runs, sinks

SMALL = {"trees": 3, "max_depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def fitted(spark, transactions):
    _, engineered = training.engineered_folds(transactions)
    fit = splits.take_fold(engineered, "fit")
    matrix = trees.Matrix.fit(fit, training.feature_columns(engineered))
    return engineered, matrix, trees.fit_class_weighted(fit, matrix, **SMALL)


def test_attributions_add_up(fitted):
    engineered, matrix, model = fitted
    parts = explain.attributions(model, matrix, engineered)
    total = sum((F.col(c) for c in matrix.columns), F.col("base_value"))
    scored = trees.score(model, matrix, engineered, ["trans_num"])
    gap = parts.join(scored, "trans_num").agg(F.max(F.abs(F.ln(F.col("p") / (1 - F.col("p"))) - total))).first()[0]
    assert gap < 1e-9


def test_attributions_equal_shapley_by_definition():
    r = np.random.default_rng(5)
    for size in (1, 2, 3, 4):
        leaf = explain.Leaves(np.arange(size)[None], np.full((1, size), -np.inf), np.zeros((1, size)), np.ones((1, size), bool),
                              r.uniform(0.1, 0.9, (1, size)), np.array([1.7]))
        for pattern in range(2 ** size):
            ok = [(pattern >> i) & 1 for i in range(size)]
            game = lambda known: 1.7 * math.prod(ok[i] if i in known else leaf.share[0, i] for i in range(size))
            want = [sum(math.factorial(k) * math.factorial(size - 1 - k) / math.factorial(size) * (game({*s, j}) - game(set(s)))
                        for k in range(size) for s in itertools.combinations([i for i in range(size) if i != j], k)) for j in range(size)]
            assert explain.attribute(np.array([[-1.0 if x else 1.0 for x in ok]]), [leaf])[0] == pytest.approx(want)


def test_attributions_of_deep_paths(spark):
    """Paths of more than twelve features, with missing values."""
    r = np.random.default_rng(6)
    x = r.normal(size=(4000, 18))
    y = ((x > 0).sum(axis=1) + r.normal(size=4000) > 9).astype(int)
    x[r.random(x.shape) < 0.05] = np.nan
    rows = spark.createDataFrame([([None if math.isnan(v) else float(v) for v in a], int(b), 1.0) for a, b in zip(x, y)],
                                 "x array<double>, y int, weight double")
    model = boosting.fit(rows, 18, trees=12, leaves=255, min_rows=1, learning_rate=0.2)
    leaves, base = explain.read_leaves(model)
    assert max(g.features.shape[1] for g in leaves) >= 12
    part = explain.attribute(x[:300], leaves)
    assert part.sum(axis=1) + base == pytest.approx(model.margin(x[:300]), abs=1e-9)


def test_attributions_of_many_rows_take_patterns_not_rows(spark, monkeypatch):
    # Quadrature for every row and leaf took over 4 ms a row with 300 trees.
    r = np.random.default_rng(8)
    x = np.round(r.normal(size=(6000, 6)), 1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0.5).astype(int)
    x[r.random(x.shape) < 0.05] = np.nan
    x[0], x[1], x[2] = np.inf, -99.0, np.nan
    rows = spark.createDataFrame([([None if math.isnan(v) else float(v) for v in a], int(b), 1.0) for a, b in zip(x[3:], y[3:])],
                                 "x array<double>, y int, weight double")
    model = boosting.fit(rows, 6, trees=8, leaves=15, learning_rate=0.2)
    leaves, base = explain.read_leaves(model)
    few = np.vstack([explain.attribute(x[i : i + 1], leaves) for i in range(100)])
    cells, plain = [], explain._contributions
    monkeypatch.setattr(explain, "_contributions", lambda ok, *rest: (cells.append(ok.size), plain(ok, *rest))[1])
    many = explain.attribute(x, leaves)
    assert many[:100] == pytest.approx(few, abs=1e-12)
    assert many.sum(axis=1) + base == pytest.approx(model.margin(x), abs=1e-9)
    assert sum(cells) == sum(g.features.size << g.features.shape[1] for g in leaves) < len(x) * sum(g.features.size for g in leaves) / 50
    assert explain.attribute(x[:0], leaves).shape == (0, 6)


def test_neighbouring_leaves_are_looked_up_together(monkeypatch):
    """Leaves of paths with two-sided bounds and missing values, against the definition row by row."""
    r = np.random.default_rng(9)
    x = np.round(r.normal(size=(3000, 4)), 2)
    x[r.random(x.shape) < 0.1] = np.nan
    cuts = [-np.inf, -0.5, 0.25, 1.0, np.inf]
    paths = [(i, j, k) for i in range(4) for j in range(4) for k in range(2)]
    low = np.array([[cuts[i], cuts[j], cuts[2 * k]] for i, j, k in paths])
    high = np.array([[cuts[i + 1], cuts[j + 1], cuts[2 * k + 2]] for i, j, k in paths])
    missing = np.array([[i == 1, j == 3, k == 0] for i, j, k in paths])
    group = explain.Leaves(np.tile([0, 2, 3], (len(paths), 1)), low, high, missing, r.uniform(0.1, 0.9, low.shape), r.normal(size=len(paths)))
    few = np.vstack([explain.attribute(x[i : i + 1], [group]) for i in range(200)])
    tables, plain = [], explain._Bundle.table
    monkeypatch.setattr(explain._Bundle, "table", lambda self, *a: tables.append(len(self.leaves)) or plain(self, *a))
    assert explain.attribute(x, [group])[:200] == pytest.approx(few, abs=1e-12)
    assert sum(tables) == len(paths) and len(tables) <= len(paths) // 8


def test_no_few_rows_are_left_for_the_end(monkeypatch):
    # Patterns are worked out anew for every call, however few rows it has.
    sizes = []
    monkeypatch.setattr(explain, "ROWS", 100)
    monkeypatch.setattr(explain, "attribute", lambda x, leaves: sizes.append(len(x)) or x)
    rows = [float(i) for i in range(520)]
    parts = [pd.Series([np.array([v]) for v in rows[lo : lo + 70]]) for lo in range(0, 520, 70)]
    got = [v[0] for part in explain.attribution_udf([]).func(iter(parts)) for v in part]
    assert got == rows and min(sizes) >= 100 and max(sizes) < 200


def test_reasons_are_ordered(fitted):
    engineered, matrix, model = fitted
    rows = explain.reasons(model, matrix, engineered.limit(20), top=4).collect()
    for row in rows:
        size = [abs(r["attribution"]) for r in row["reasons"]]
        assert len(size) == 4 and size == sorted(size, reverse=True)
        assert all((r["impact"] == "pushes_towards_fraud") == (r["attribution"] > 0) for r in row["reasons"])
        assert {"gender"} >= {r["feature"] for r in row["reasons"] if r["value"] in ("F", "M")}


def test_split_counts(fitted, spark):
    _, matrix, model = fitted
    counts = trees.split_counts(model, matrix, spark).toPandas()
    assert counts.splits.sum() == (model.nodes["feature"] >= 0).sum() > 0 and len(counts) == len(matrix.columns)


def test_importance_tables(fitted, spark):
    engineered, matrix, model = fitted
    gain = trees.split_importance(model, matrix, spark).toPandas()
    assert gain.importance.sum() == pytest.approx(1) and gain.importance.is_monotonic_decreasing
    mean = explain.global_importance(explain.attributions(model, matrix, engineered), matrix.columns).toPandas()
    assert len(mean) == len(matrix.columns) and mean.mean_abs_attribution.is_monotonic_decreasing


def test_unseen_category_and_missing_value(fitted, spark):
    engineered, matrix, model = fitted
    odd = engineered.limit(3).withColumns({"gender": F.lit("new"), "age": F.lit(None).cast("double")})
    assert trees.score(model, matrix, odd, ["trans_num"]).filter(F.col("p").between(0, 1)).count() == 3


def test_training_job_and_records(transactions, spark, tmp_path):
    trained = training.train(transactions, SMALL)
    report = training.threshold_report(trained)
    assert report["test"]["tp"] + report["test"]["fn"] + report["test"]["fp"] + report["test"]["tn"] == 200
    assert 0 <= trained.report["test"]["pr_auc"] <= 1
    sinks.write_report(spark, report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first()["threshold"] == pytest.approx(trained.threshold)

    table = str(tmp_path / "runs")
    runs.log_run(spark, table, "one", trained.report["params"], {"pr_auc": 0.2}, ["report"])
    runs.log_run(spark, table, "two", {}, {"pr_auc": 0.3})
    assert [r["run_id"] for r in runs.best_runs(spark, table).collect()] == ["two", "one"]

    trained.trees.save(spark, str(tmp_path / "model"))
    versions = str(tmp_path / "versions")
    runs.assign_alias(spark, versions, "fraud", 1, str(tmp_path / "old"), "serving")
    runs.assign_alias(spark, versions, "fraud", 2, str(tmp_path / "model"), "serving")
    again = boosting.Booster.load(spark, runs.resolve(spark, versions, "fraud", "serving"))
    assert again.trees == trained.trees.trees and (again.nodes["value"] == trained.trees.nodes["value"]).all()
    with pytest.raises(LookupError):
        runs.resolve(spark, versions, "fraud", "none")


def test_model_round_trip(transactions, spark, tmp_path):
    trained = training.train(transactions, {"trees": 2, "max_depth": 2, "learning_rate": 0.3})
    trained.save(spark, str(tmp_path / "m"))
    again = training.TrainedModel.load(spark, str(tmp_path / "m"))
    rows = lambda m: sorted(m.score_features(m.features.transform(transactions)).collect())
    assert rows(trained) == rows(again) and again.threshold == trained.threshold


def test_load_splits_or_file(transactions, spark, tmp_path):
    sinks.write_splits(splits.train_test(transactions), str(tmp_path / "splits"))
    transactions.write.parquet(str(tmp_path / "all.parquet"))
    for path in ("splits", "all.parquet"):
        train, test = training.load_train_test(spark, str(tmp_path / path))
        assert (train.count(), test.count()) == (800, 200)
    with pytest.raises(Exception):
        training.load_train_test(spark, str(tmp_path / "none"))[0].count()


def plain_log_density(values, low, high, x):
    """The mixture's log density, written out."""
    marks = sorted([(v, i) for i, v in enumerate([*values, (low + high) / 2])])
    line = [low, *[v for v, _ in marks], high]
    total = 0
    for k, (centre, i) in enumerate(marks):
        width = max(line[k + 1] - line[k], line[k + 2] - line[k + 1])
        width = min(max(width, (high - low) / min(100, len(marks) + 1)), high - low) if i < len(values) else high - low
        normal = statistics.NormalDist(centre, width)
        total += normal.pdf(x) / (normal.cdf(high) - normal.cdf(low))
    return math.log(total / len(marks))


def test_proposals_follow_the_estimator():
    r = random.Random(4)
    log = [{"trial": i, "params": tuning.propose([], [], i), "pr_auc": r.random()} for i in range(30)]
    for t in log:
        for name, (low, high, kind) in tuning.SEARCH_SPACE.items():
            assert low <= t["params"][name] <= high and (kind == "float" or kind == "log" or isinstance(t["params"][name], int))
    assert len({t["params"]["trees"] for t in log}) > 5 and all(t["params"]["trees"] % 50 == 0 for t in log)
    pending = [tuning.propose(log, [], 30)]
    assert tuning.propose(log, pending, 31) == tuning.propose(log, pending, 31) != tuning.propose(log, [], 32)

    best = sorted(log, key=lambda t: -t["pr_auc"])[:3]
    rest = [t["params"] for t in log if t not in best] + pending
    rng, want = np.random.default_rng((42, 31)), {}
    for name, (low, high, kind) in tuning.SEARCH_SPACE.items():
        place = math.log if kind == "log" else float
        half = {"int": 0.5, "step50": 25}.get(kind, 0)
        a, b = (math.log(low), math.log(high)) if kind == "log" else (low - half, high + half)
        good, bad = [place(t["params"][name]) for t in best], [place(p[name]) for p in rest]
        near = tuning.Density(good, a, b)
        drawn = [near.draw(rng) for _ in range(24)]
        x = max(drawn, key=lambda v: plain_log_density(good, a, b, v) - plain_log_density(bad, a, b, v))
        want[name] = math.exp(x) if kind == "log" else x if kind == "float" else low + round((x - low) / (2 * half)) * 2 * half
    got = tuning.propose(log, pending, 31)
    assert {k: got[k] for k in want} == pytest.approx({k: min(max(v, tuning.SEARCH_SPACE[k][0]), tuning.SEARCH_SPACE[k][1]) for k, v in want.items()})


def test_estimator_beats_chance():
    aim = {name: (lo * hi) ** 0.5 if kind == "log" else lo + (hi - lo) * 0.7 for name, (lo, hi, kind) in tuning.SEARCH_SPACE.items()}

    def value(p):
        return -sum(((math.log(p[k] / aim[k]) / math.log(hi / lo)) if kind == "log" else (p[k] - aim[k]) / (hi - lo)) ** 2
                    for k, (lo, hi, kind) in tuning.SEARCH_SPACE.items())
    wins = 0
    for seed in range(5):
        guided, chance = [], [value(tuning.propose([], [], i, seed + 100)) for i in range(60)]
        while len(guided) < 60:
            p = tuning.propose(guided, [], len(guided), seed)
            guided.append({"params": p, "pr_auc": value(p)})
        wins += max(t["pr_auc"] for t in guided) > max(chance)
    assert wins >= 4


def test_timeout_keeps_the_first_round(fitted):
    engineered, matrix, _ = fitted
    fit, val = splits.take_fold(engineered, "fit"), splits.take_fold(engineered, "val")
    space = {"trees": (2, 2, "int"), "max_depth": (2, 2, "int"), "l2": (0.1, 1.0, "log")}
    ticks = iter(range(0, 1000, 100))
    best, history = tuning.search(fit, val, matrix, trials=5, timeout_s=50, space=space, at_once=2, clock=lambda: next(ticks))
    assert [t["trial"] for t in history] == [0, 1] and best in [t["params"] for t in history]
    _, again = tuning.search(fit, val, matrix, trials=3, space=space, at_once=2)
    assert again[:2] == history and len(again) == 3


def test_trials_share_rows_and_cuts(spark, fitted, monkeypatch):
    # Each trial wrote the rows and looked for cuts again.
    engineered, matrix, _ = fitted
    fit, val = splits.take_fold(engineered, "fit"), splits.take_fold(engineered, "val")
    calls, plain = [], boosting.Prepared.of
    monkeypatch.setattr(boosting.Prepared, "of", lambda rows, features: (calls.append(features), plain(rows, features))[1])
    space = {**tuning.SEARCH_SPACE, "trees": (2, 3, "int")}
    _, history = tuning.search(fit, val, matrix, trials=3, space=space, at_once=3, weight=7.0)
    assert calls == [len(matrix.columns)] and len(history) == 3
    alone = trees.fit_trees(fit, matrix, weight=7.0, **history[1]["params"])
    want = ranking.average_precision(trees.score(alone, matrix, val, ["is_fraud"]), label="is_fraud").first()[0]
    assert history[1]["pr_auc"] == pytest.approx(want, abs=1e-12)


def test_refit_with_validation_rows(transactions):
    trained = training.train(transactions, {"trees": 2, "max_depth": 2, "learning_rate": 0.3}, calibration_method="sigmoid",
                             refit_with_validation=True)
    assert trained.calibrator.method == "sigmoid" and 0 <= trained.report["test"]["roc_auc"] <= 1
