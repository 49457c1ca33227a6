"""Properties: block-parallel results equal the plain global-window results."""
import random

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratecast.operators.blocks import bounded_window, range_scan, running_sums
from ratecast.operators.quantiles import exact_quantiles, rank_values


def _series(spark, n, seed=0, keys=None):
    rng = np.random.default_rng(seed)
    rows = []
    for k in (keys or [None]):
        for i in range(n):
            rows.append((k, i, float(rng.poisson(3))))
    return spark.createDataFrame(rows, "k string, idx long, v double")


def test_halo_equals_global_window(spark):
    for n, b, lag in [(9, 4, 3), (16, 8, 8), (17, 8, 5), (40, 5, 5), (1, 4, 2)]:
        s = _series(spark, n, seed=n)
        got = bounded_window(s, {"m": lambda w: F.avg("v").over(w.rowsBetween(-lag, 0)),
                                 "l": lambda w: F.lag("v", lag).over(w)}, halo=lag, block=b)
        w = Window.orderBy("idx")
        exp = s.withColumn("m", F.avg("v").over(w.rowsBetween(-lag, 0))).withColumn("l", F.lag("v", lag).over(w))
        a = got.orderBy("idx").toPandas()
        e = exp.orderBy("idx").toPandas()
        pd.testing.assert_frame_equal(a[["idx", "m", "l"]], e[["idx", "m", "l"]])


def test_halo_with_keys(spark):
    s = _series(spark, 23, keys=["a", "b"])
    got = bounded_window(s, {"m": lambda w: F.sum("v").over(w.rowsBetween(-4, -1))}, halo=4, keys=["k"], block=5)
    exp = s.withColumn("m", F.sum("v").over(Window.partitionBy("k").orderBy("idx").rowsBetween(-4, -1)))
    a = got.orderBy("k", "idx").toPandas()
    e = exp.orderBy("k", "idx").toPandas()
    pd.testing.assert_frame_equal(a[["k", "idx", "m"]], e[["k", "idx", "m"]])


def test_running_sums_equal_cumulative(spark):
    s = _series(spark, 50, keys=["a", "b"])
    s = s.withColumn("w", F.when(F.col("idx") == 7, F.lit(float("nan"))).otherwise(F.col("v")))
    got = running_sums(s, ["v", "w"], keys=["k"], block=8).orderBy("k", "idx").toPandas()
    exp = s.toPandas().sort_values(["k", "idx"])
    exp["cv"] = exp.groupby("k")["v"].cumsum()
    exp["cn"] = exp.groupby("k").cumcount() + 1
    assert np.allclose(got["cum_v"], exp["cv"])
    assert (got["cum_n"].to_numpy() == exp["cn"].to_numpy()).all()
    assert got.loc[got["idx"] < 7, "cum_w"].notna().all()
    assert got.loc[got["idx"] >= 7, "cum_w"].isna().all()  # NaN propagates as in numpy


def test_range_scan_lag_and_position_with_ties(spark):
    random.seed(1)
    rows = [(i, random.choice([10, 10, 10, 11, 12, 40]), random.choice(["x", "y"])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t long, k string")
    got = range_scan(df, ["t", "id"], carry=["t"], with_position=True, partitions=7).toPandas()
    e = df.toPandas().sort_values(["t", "id"]).reset_index(drop=True)
    e["prev"] = e["t"].shift(1)
    e["pos"] = range(len(e))
    m = got.merge(e, on="id")
    assert (m["pos_x"] == m["pos_y"]).all()
    assert ((m["prev_t"] == m["prev"]) | (m["prev_t"].isna() & m["prev"].isna())).all()
    gk = range_scan(df, ["t", "id"], keys=["k"], carry=["t"], partitions=5).toPandas()
    e = df.toPandas().sort_values(["k", "t", "id"])
    e["prev"] = e.groupby("k")["t"].shift(1)
    m = gk.merge(e, on="id")
    assert len(m) == 300
    assert ((m["prev_t"] == m["prev"]) | (m["prev_t"].isna() & m["prev"].isna())).all()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=500), np.zeros(300)])  # a hot value
    df = spark.createDataFrame([(float(v), "a" if i % 2 else "b") for i, v in enumerate(vals)], "x double, g string")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "x", probs, partitions=6).toPandas().sort_values("p")
    assert np.allclose(got["value"].to_numpy(), np.quantile(vals, probs))
    gk = exact_quantiles(df, "x", [0.5], keys=["g"], partitions=4).toPandas().set_index("g")
    pdf = df.toPandas()
    for g in ("a", "b"):
        assert np.isclose(gk.loc[g, "value"], np.quantile(pdf[pdf.g == g].x, 0.5))
    rv = rank_values(df, "x", [0, 10, 10_000], partitions=3).toPandas().sort_values("rank")
    srt = np.sort(vals)
    assert list(rv["value"]) == [srt[0], srt[10], srt[-1]]
