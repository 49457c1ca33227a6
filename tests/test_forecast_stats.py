"""Known answers, numpy/pandas differentials for the statistics, metric edge rules."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratecast.operators import stats as ST
from ratecast.operators.evaluate import evaluate
from ratecast.operators.prep import minmax_apply, minmax_fit, minmax_inverse
from ratecast.operators.series import resample_count
from ratecast.plans.replay import replay_metrics


def _series(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "idx long, txn_count double")


def test_flagship_known_answers(events):
    r = replay_metrics(events).collect()[0]
    assert r["n_predictions"] == 4320
    assert math.isclose(r["mae"], 0.3588734568, rel_tol=1e-9)
    assert math.isclose(r["rmse"], 0.5406567033, rel_tol=1e-9)
    assert math.isclose(r["wape"], 155.96914822, rel_tol=1e-8)
    assert math.isnan(r["mape"])


def test_hourly_known_answers(events):
    s = resample_count(events, freq="1 hour")
    m = replay_metrics(events, freq="1 hour").collect()[0]
    assert math.isclose(m["mae"], 3.412037, abs_tol=1e-6)
    assert math.isclose(m["mape_nonzero"], 28.205574, abs_tol=1e-6)
    sk = ST.skewness_class(s).collect()[0]
    assert math.isclose(sk["skewness"], 0.313516, abs_tol=1e-6)
    ku = ST.kurtosis_class(s).collect()[0]
    assert math.isclose(ku["kurtosis"], 0.349224, abs_tol=1e-6)
    jb = ST.normality_test(s).collect()[0]
    assert math.isclose(jb["jarque_bera"], 15.183047, abs_tol=1e-5)


def test_acf_matches_numpy(spark):
    rng = np.random.default_rng(5)
    t = np.arange(3000)
    x = np.sin(2 * np.pi * t / 144) * 5 + rng.normal(size=len(t))
    got = ST.acf(_series(spark, x), range(0, 200)).toPandas().sort_values("lag")
    xc = x - x.mean()
    exp = [np.dot(xc[k:], xc[:len(x) - k]) / np.dot(xc, xc) for k in range(200)]
    assert np.allclose(got["acf"].to_numpy(), exp)
    lb = ST.recommended_lookback(ST.acf(_series(spark, x), range(101))).collect()[0]
    assert lb["max_significant_lag"] == max(k for k in range(100) if abs(exp[k]) > 0.2)


def test_constant_series(spark):
    s = _series(spark, [4.0] * 200)
    lb = ST.recommended_lookback(ST.acf(s, range(101))).collect()[0]
    assert lb["recommended_lookback"] == 10 and lb["max_significant_lag"] is None
    assert ST.zscore_outliers(s).collect()[0]["n_outliers"] == 0
    assert ST.skewness_class(s).collect()[0]["skewness"] == 0.0


def _adf_numpy(x, maxlag):
    """Direct least-squares ADF (constant, AIC over the common sample) for checking."""
    dx = np.diff(x)
    n = len(x)

    def design(p):
        t = np.arange(p + 1, n)
        cols = [np.ones(len(t)), x[t - 1]] + [dx[t - 1 - j] for j in range(1, p + 1)]
        return np.column_stack(cols), dx[t - 1], t

    X, y, t0 = design(maxlag)
    best = None
    for p in range(maxlag + 1):
        Xp = X[:, :2 + p]
        beta, *_ = np.linalg.lstsq(Xp, y, rcond=None)
        ssr = float(((y - Xp @ beta) ** 2).sum())
        nobs = len(y)
        aic = nobs * math.log(ssr / nobs) + 2 * (2 + p)
        if best is None or aic < best[0]:
            best = (aic, p)
    p = best[1]
    X, y, _ = design(p)
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    s2 = resid @ resid / (len(y) - X.shape[1])
    cov = s2 * np.linalg.inv(X.T @ X)
    return beta[1] / math.sqrt(cov[1, 1]), p, len(y)


@pytest.mark.parametrize("kind", ["walk", "ar1"])
def test_adf_matches_direct_ols(spark, kind):
    rng = np.random.default_rng(11)
    e = rng.normal(size=1500)
    x = np.cumsum(e) if kind == "walk" else np.zeros(1500)
    if kind == "ar1":
        for i in range(1, 1500):
            x[i] = 0.5 * x[i - 1] + e[i]
    got = ST.adf_test(_series(spark, x)).collect()[0]
    stat, lag, nobs = _adf_numpy(x, ST.adf_max_lag(len(x)))
    assert got["used_lag"] == lag and got["nobs"] == nobs
    assert math.isclose(got["adf_statistic"], stat, rel_tol=1e-7)
    assert math.isclose(got["p_value"], ST.mackinnon_p(stat), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(got["crit_5pct"], ST.mackinnon_crit(nobs)["5%"])
    if kind == "ar1":
        assert got["p_value"] < 0.01 and got["is_stationary"]


def test_mackinnon_p_shape():
    assert abs(ST.mackinnon_p(-3.43) - 0.01) < 0.002
    assert abs(ST.mackinnon_p(-2.86) - 0.05) < 0.003
    assert ST.mackinnon_p(-30) == 0.0 and ST.mackinnon_p(3) == 1.0


def test_metric_zero_rules(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (2.0, 1.0)], "actual double, predicted double")
    r = evaluate(df, by=()).collect()[0]
    assert math.isnan(r["mape_raw"])
    assert r["mape_eps"] > 1e15
    assert math.isclose(r["mape_nonzero"], 50.0)
    assert math.isclose(r["wape"], (2 / 3) / (2 / 3) * 100)
    df2 = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "actual double, predicted double")
    assert math.isinf(evaluate(df2, by=()).collect()[0]["mape_raw"])


def test_minmax_round_trip_and_constant(spark):
    s = _series(spark, [3, 5, 9, 1])
    sc = minmax_fit(s, ["txn_count"])
    t = minmax_apply(s, sc, ["txn_count"]).orderBy("idx").toPandas()
    assert list(t["txn_count"]) == [0.25, 0.5, 1.0, 0.0]
    back = minmax_inverse(minmax_apply(s, sc, ["txn_count"]), sc, ["txn_count"]).orderBy("idx").toPandas()
    assert np.allclose(back["txn_count"], [3, 5, 9, 1])
    c = _series(spark, [7, 7])
    assert [r["txn_count"] for r in minmax_apply(c, minmax_fit(c, ["txn_count"]), ["txn_count"]).collect()] == [0.0, 0.0]
