"""Rolling mean and std equal to two-pass sums, also after a spike."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import windows as WI


def two_pass(x, rows, mp):
    mean, std = np.full(len(x), np.nan), np.full(len(x), np.nan)
    for i in range(len(x)):
        v = x[max(0, i - rows + 1):i + 1]
        if len(v) >= mp:
            mean[i] = np.mean(v)
            if len(v) > 1:
                std[i] = np.std(v, ddof=1)
    return mean, std


def rolled(spark, x, rows, mp=None, block=None, start=0):
    s = spark.createDataFrame([(k + start, float(v)) for k, v in enumerate(x)], "idx bigint, txn_count double").repartition(3)
    return WI.rolling_mean_std(s, rows=rows, min_periods=mp, block=block).orderBy("idx").toPandas()


@pytest.mark.parametrize("rows,mp,block,start", [(20, None, 64, 0), (20, 1, 64, 0), (7, 3, 7, 0), (1, None, 16, 0), (2, None, 8, 0),
                                                 (20, 5, 50, 13), (300, 1, 300, 0), (50, 50, 60, 101)])
def test_rolling_after_a_spike(spark, rows, mp, block, start):
    rng = np.random.default_rng(rows)
    x = rng.poisson(3, 260).astype(float)
    x[31] = x[130] = 1e9
    got = rolled(spark, x, rows, mp, block, start)
    mean, std = two_pass(x, rows, rows if mp is None else mp)
    np.testing.assert_allclose(got["rolling_mean"].to_numpy(float), mean, rtol=1e-12, atol=1e-9)
    np.testing.assert_allclose(got["rolling_std"].to_numpy(float), std, rtol=1e-9, atol=1e-9)


def test_constant_and_high_level(spark):
    got = rolled(spark, [1e9 + 5.0] * 90, 10, block=32)
    assert (got["rolling_std"].dropna() == 0).all() and got["rolling_std"].count() == 81
    x = 1e9 + np.arange(100) % 7
    np.testing.assert_allclose(rolled(spark, x, 14, block=40)["rolling_std"].dropna(), np.std(x[:14], ddof=1), rtol=1e-9)


def test_rolling_with_keys(spark):
    s = spark.range(400).select((F.col("id") % 2).alias("k"), F.floor(F.col("id") / 2).alias("idx"),
                                F.when(F.col("id") == 60, 1e9).otherwise(F.col("id") % 5).cast("double").alias("txn_count"))
    got = WI.rolling_mean_std(s, rows=9, keys=["k"], block=32).orderBy("k", "idx").toPandas()
    for k in (0, 1):
        x = np.array([1e9 if i == 60 else i % 5 for i in range(k, 400, 2)], float)
        mean, std = two_pass(x, 9, 9)
        mine = got[got["k"] == k]
        np.testing.assert_allclose(mine["rolling_std"].to_numpy(float), std, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(mine["rolling_mean"].to_numpy(float), mean, rtol=1e-12)
