"""Tree QR on lagged values: nested fits from one factor, ADF at high levels."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import leastsq as LS
from ratecast.operators import stats as ST
from ratecast.operators.prep import temporal_split

from .test_forecast_stats import _adf_numpy


def series(spark, x, parts=4):
    return spark.createDataFrame([(k, float(v)) for k, v in enumerate(x)], "idx bigint, txn_count double").repartition(parts)


def walk(n, level=0.0, seed=0, pull=0.1):
    rng = np.random.default_rng(seed)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = (1 - pull) * x[t - 1] + rng.normal()
    return x + level


def direct(x, lookback):
    z = np.column_stack([np.ones(len(x) - lookback), *(x[lookback - k:len(x) - k] for k in range(1, lookback + 1))])
    return np.linalg.lstsq(z, x[lookback:], rcond=None)[0]


@pytest.mark.parametrize("level", [0.0, 1e6])
@pytest.mark.parametrize("block", [64, 4096])
def test_all_lookbacks_from_one_factor(spark, level, block):
    x = walk(700, level)
    s = temporal_split(series(spark, x), 0.8)
    blocks = LS.pack_series(s, (3, 10, 25), block=block).cache()
    fits = {r["lookback"]: r for r in LS.lagged_fit(blocks, (10, 3, 25)).collect()}
    for k in (3, 10, 25):
        want = direct(x[:560], k)
        assert fits[k]["n"] == 560 - k
        np.testing.assert_allclose(fits[k]["coefs"], want[1:], rtol=1e-6, atol=1e-8)
        assert fits[k]["intercept"] == pytest.approx(want[0], rel=1e-4, abs=1e-6)
    got = LS.lagged_predictions(blocks, LS.lagged_fit(blocks, (3, 10, 25))).orderBy("lookback", "idx").toPandas()
    for k in (3, 10, 25):
        mine = got[got["lookback"] == k]
        assert mine["row"].tolist() == list(range(140 - k)) and mine["idx"].iloc[0] == 560 + k
        np.testing.assert_allclose(mine["actual"], x[560 + k:], rtol=1e-12)
        b = direct(x[:560], k)
        np.testing.assert_allclose(mine["predicted"], [b[0] + b[1:] @ x[t - k:t][::-1] for t in range(560 + k, 700)], rtol=1e-7)


def test_short_and_constant_series(spark):
    for x in ([5.0] * 60, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [1.0, 2.0]):
        blocks = LS.pack_series(temporal_split(series(spark, x), 0.8), (2, 4))
        fits = LS.lagged_fit(blocks, (2, 4)).collect()
        assert all(np.isfinite([r["intercept"], *r["coefs"]]).all() for r in fits)
        pred = LS.lagged_predictions(blocks, LS.lagged_fit(blocks, (2, 4))).collect()
        if len(x) == 60:
            assert {round(r["predicted"], 6) for r in pred} == {5.0} and len(pred) == 10 + 8


@pytest.mark.parametrize("level", [0.0, 1e9])
@pytest.mark.parametrize("pull", [0.0, 0.2])
def test_adf_at_any_level(spark, level, pull, monkeypatch):
    monkeypatch.setattr(LS, "MIN_BLOCK", 64)            # several blocks and merges
    monkeypatch.setattr(LS, "FAN", 2)
    monkeypatch.setattr(LS, "block_for", lambda halo: max(2 * halo, 64))
    x = np.round(walk(900, seed=4, pull=pull), 3)       # the same differences at every level, up to 1e-7
    got = ST.adf_test(series(spark, x + level)).collect()[0]
    stat, lag, nobs = _adf_numpy(x, ST.adf_max_lag(len(x)))
    assert (got["used_lag"], got["nobs"]) == (lag, nobs)
    assert math.isclose(got["adf_statistic"], stat, rel_tol=1e-5 if level else 1e-9)


def test_adf_reads_the_series_once(spark):
    s = series(spark, walk(500))
    plan = ST.adf_test(s)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_adf_keys_keep_their_own_lags(spark):
    a, b = walk(300, seed=1), walk(150, 50.0, seed=2)
    s = series(spark, a).withColumn("k", F.lit("a")).unionByName(series(spark, b).withColumn("k", F.lit(None)))
    got = {r["k"]: r for r in ST.adf_test(s, keys=["k"]).collect()}
    for k, x in (("a", a), (None, b)):
        stat, lag, nobs = _adf_numpy(x, ST.adf_max_lag(len(x)))
        assert (got[k]["used_lag"], got[k]["nobs"]) == (lag, nobs)
        assert math.isclose(got[k]["adf_statistic"], stat, rel_tol=1e-8)


@pytest.mark.parametrize("n", [4, 5, 6, 8])
def test_adf_of_very_short_series(spark, n):
    got = ST.adf_test(series(spark, walk(n))).collect()[0]
    assert got["nobs"] >= 0
