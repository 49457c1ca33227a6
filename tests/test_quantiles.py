"""Exact quantiles from sketches: equal to numpy, also where the sketch misses; no shuffle of all values."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import quantiles as QU

PROBS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]


def data(kind, n=20_000):
    rng = np.random.default_rng(1)
    return {"normal": rng.normal(size=n), "ties": rng.integers(0, 5, n).astype(float), "hot": np.where(rng.random(n) < 0.7, 0.0, rng.normal(size=n)),
            "wide": rng.choice([-1e300, 1e300, 0.0, 1e-300], n), "one": np.array([3.5]), "two": np.array([1.0, 2.0])}[kind]


@pytest.mark.parametrize("kind", ["normal", "ties", "hot", "wide", "one", "two"])
@pytest.mark.parametrize("slack", [0.009, -0.02])
def test_equal_to_numpy(spark, kind, slack, monkeypatch):
    monkeypatch.setattr(QU, "SLACK", slack)                  # a negative slack makes brackets that miss their target
    x = data(kind)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double").repartition(4)
    got = {r["p"]: r["value"] for r in QU.exact_quantiles(df, "x", PROBS).collect()}
    np.testing.assert_allclose([got[p] for p in PROBS], np.quantile(x, PROBS), rtol=1e-12, atol=1e-300)


@pytest.mark.parametrize("slack", [0.009, -0.3])
def test_keys_and_ranks_of_large_ids(spark, slack, monkeypatch):
    monkeypatch.setattr(QU, "SLACK", slack)
    base = 2**60
    df = spark.range(5000).select((base + F.col("id") * 3).alias("x"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 2).alias("g"))
    rows = df.collect()
    got = {(r["g"], r["rank"]): r["value"] for r in QU.rank_values(df, "x", [0, 7, 10**9], keys=["g"]).collect()}
    for g in (None, 0, 1):
        v = sorted(r["x"] for r in rows if r["g"] == g)
        assert [got[g, k] for k in (0, 7, 10**9)] == [v[0], v[7], v[-1]]
    q = {r["g"]: r["value"] for r in QU.exact_quantiles(df.withColumn("x", F.col("x") - base), "x", [0.5], keys=["g"]).collect()}
    for g in (None, 0, 1):
        assert q[g] == np.median([r["x"] - base for r in rows if r["g"] == g])


def test_text_and_empty(spark):
    df = spark.createDataFrame([(c,) for c in "delta alpha echo bravo".split()], "x string")
    assert [r["value"] for r in QU.rank_values(df, "x", [1]).collect()] == ["bravo"]
    assert QU.exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]).collect() == []


def test_few_values_are_shuffled(spark, monkeypatch):
    seen = []
    real = QU.materialize
    monkeypatch.setattr(QU, "materialize", lambda df: seen.append(real(df)) or seen[-1])
    df = spark.range(0, 200_000, 1, 4).select(F.sin("id").alias("x"))
    QU.exact_quantiles(df, "x", [0.5]).collect()
    assert seen[1].count() < 0.035 * 200_000
