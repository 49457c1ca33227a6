"""Shapiro-Francia against plain numpy; the normal quantile against the standard library."""
import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import normality as NO


def plain(x):
    x, n = np.sort(np.asarray(x, float)), len(x)
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    w = (m @ (x - x.mean())) ** 2 / (m @ m) / ((x - x.mean()) ** 2).sum()
    u, v = math.log(n), math.log(math.log(n))
    z = (math.log(1 - w) - (-1.2725 + 1.0521 * (v - u))) / (1.0308 - 0.26758 * (v + 2 / u))
    return w, 0.5 * math.erfc(z / math.sqrt(2))


def test_normal_quantile(spark):
    p = [1e-300, 1e-20, 1e-9, 1e-3, 0.07, 0.075, 0.3, 0.5, 0.70001, 0.925, 0.926, 0.9999, 1 - 1e-12]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in p], "p double").select(NO.normal_quantile(F.col("p"))).collect()]
    np.testing.assert_allclose(got, [NormalDist().inv_cdf(v) for v in p], rtol=1e-13, atol=1e-15)


@pytest.mark.parametrize("kind", ["normal", "poisson", "hot", "heavy", "five"])
def test_statistic(spark, kind, monkeypatch):
    monkeypatch.setattr(NO, "CHUNK", 64)
    rng = np.random.default_rng(5)
    x = {"normal": rng.normal(1e6, 2, 800), "poisson": rng.poisson(2, 1500), "hot": np.where(rng.random(2000) < 0.7, 0, rng.normal(size=2000)),
         "heavy": rng.standard_cauchy(400), "five": np.array([1.0, 2, 4, 4, 9])}[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "txn_count double").repartition(4)
    got = NO.shapiro_francia(df).collect()
    w, p = plain(x)
    assert len(got) == 1 and got[0]["n"] == len(x)
    assert got[0]["w_statistic"] == pytest.approx(w, rel=1e-9)
    assert got[0]["p_value"] == pytest.approx(p, rel=1e-5, abs=1e-12) and got[0]["is_normal"] == (p > 0.05)


def test_keys_and_short_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(None, float(v)) for v in rng.normal(size=60)] + [("c", 4.0)] * 30 + [("s", 1.0), ("s", 2.0)]
    got = {r["k"]: r for r in NO.shapiro_francia(spark.createDataFrame(rows, "k string, txn_count double"), keys=["k"]).collect()}
    assert got[None]["w_statistic"] == pytest.approx(plain([v for k, v in rows if k is None])[0], rel=1e-9)
    assert got["c"]["w_statistic"] is None and got["s"]["w_statistic"] is None and got["s"]["n"] == 2
    assert NO.shapiro_francia(spark.createDataFrame([], "txn_count double")).collect()[0]["n"] == 0
