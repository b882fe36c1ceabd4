import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import calibration


def pav(p, y):
    """Pool adjacent violators over distinct scores."""
    blocks = []
    for v in np.unique(p):
        m = p == v
        blocks.append([y[m].sum(), m.sum(), [v]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, vs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + vs]
    return {v: s / n for s, n, vs in blocks for v in vs}


def test_isotonic(scores):
    pdf = scores.toPandas()
    want = pav(pdf.p.to_numpy(), pdf.y.to_numpy())
    got = calibration.fit_isotonic(scores).transform(scores).select("p", "p_cal").toPandas()
    np.testing.assert_allclose(got.p_cal, [want[v] for v in got.p], atol=1e-12)


def test_isotonic_interpolates_and_clips(spark):
    rows = spark.createDataFrame([(0, 0.2), (1, 0.8)], "y int, p double")
    fit = calibration.fit_isotonic(rows)
    probe = spark.createDataFrame([(0.0,), (0.2,), (0.5,), (0.8,), (1.0,)], "p double")
    assert [r[0] for r in fit.transform(probe).orderBy("p").select("p_cal").collect()] == pytest.approx([0, 0, 0.5, 1, 1])


def test_platt_equals_newton(scores):
    pdf = scores.toPandas()
    p, y = pdf.p.to_numpy(), pdf.y.to_numpy()
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.c_[p, np.ones(len(p))], np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-x @ w))
        w = w + np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x, x.T @ (t - q))
    want = 1 / (1 + np.exp(-(p * w[0] + w[1])))
    got = calibration.fit_platt(scores).transform(scores).select("id", "p_cal").toPandas().set_index("id").p_cal
    np.testing.assert_allclose(got.loc[pdf.id].to_numpy(), want, atol=1e-5)


def test_lower_brier_wins_and_unknown_method_fails(scores):
    chosen, metrics = calibration.fit_calibrator(scores)
    assert chosen.method == "isotonic" and metrics["brier_after"] <= metrics["brier_before"]
    with pytest.raises(ValueError):
        calibration.fit_calibrator(scores, "beta")


def test_reliability_bins(scores):
    pdf = scores.toPandas()
    edges = np.quantile(pdf.p, np.linspace(0, 1, 11))
    bins = np.searchsorted(edges[1:-1], pdf.p)
    got = calibration.reliability_curve(scores, rows_per_task=60).toPandas().set_index("bin").sort_index()
    for b in np.unique(bins):
        assert got.loc[b, "n"] == (bins == b).sum()
        assert got.loc[b, "mean_score"] == pytest.approx(pdf.p[bins == b].mean())


def test_log_loss_clips(spark):
    row = calibration.brier_log_loss(spark.createDataFrame([(1, 0.0), (0, 0.5)], "y int, p double")).first()
    assert row["log_loss"] == pytest.approx((-np.log(calibration.EPSILON) - np.log(0.5)) / 2)


def test_methods_are_tried_at_a_time(spark, monkeypatch):
    r = np.random.default_rng(12)
    rows = [(float(p), int(r.random() < p * p)) for p in np.round(r.random(500), 2)]
    scored = spark.createDataFrame(rows, "p double, y int").cache()
    alone = {name: calibration.fit_calibrator(scored, name) for name in calibration.FITS}
    together = threading.Barrier(2)
    monkeypatch.setattr(calibration, "FITS", {name: lambda *a, f=f: (together.wait(60), f(*a))[1] for name, f in calibration.FITS.items()})
    chosen, metrics = calibration.fit_calibrator(scored)
    want = min(alone, key=lambda name: alone[name][1]["brier_after"])
    assert chosen.method == want and metrics == pytest.approx(alone[want][1])
