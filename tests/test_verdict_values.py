"""Values that the test tables lack: NULL keys, high levels, large errors and ids, constants."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.functions.timecols import freq_micros
from ratecast.operators import forecast as FC
from ratecast.operators import prep, series, stats, windows
from ratecast.sources import io


def dense(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "idx long, txn_count double") \
        .withColumn("ts", F.timestamp_seconds(F.col("idx") * 60).cast("timestamp_ntz"))


def test_null_keys_keep_their_rows(events):
    ev = events.limit(1000).withColumn("k", F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("event_type")))
    want = {r["k"]: r["n"] for r in ev.groupBy("k").agg(F.count("*").alias("n")).collect()}
    s = series.resample_count(ev, keys=["k"])
    assert {r["k"]: r["n"] for r in s.groupBy("k").agg(F.sum("txn_count").alias("n")).collect()} == want
    assert windows.event_gaps(ev, keys=["k"]).count() == 1000
    assert prep.temporal_split(s, keys=["k"]).where("k is null").count() == s.where("k is null").count()


def test_rolling_std_at_a_high_level(spark):
    x = 1_000_000_007 + np.arange(5000) % 2
    r = windows.rolling_mean_std(dense(spark, x), rows=1440, block=2000).where("rolling_std is not null").agg(
        F.min("rolling_std"), F.max("rolling_std")).first()
    assert abs(r[0] - np.std(x[:1440], ddof=1)) < 1e-6 and abs(r[1] - r[0]) < 1e-6
    flat = windows.rolling_mean_std(dense(spark, [0.1] * 3000), rows=1440).where("rolling_std is not null")
    assert flat.agg(F.max("rolling_std")).first()[0] == 0


@pytest.mark.parametrize("error", [1e9, 1e10, 1e14])
def test_running_metrics_of_large_errors(spark, error):
    d = dense(spark, np.ones(1000)).select("idx", F.col("txn_count").alias("actual"), (F.col("txn_count") + error).alias("predicted"))
    last = windows.running_metrics(d).where("idx = 999").first()
    assert math.isclose(last["running_rmse"], error, rel_tol=1e-9) and math.isclose(last["running_mae"], error, rel_tol=1e-9)


def test_first_rows_of_large_ids(spark):
    d = spark.range(100).select((F.col("id") + 2**60).alias("event_id"))
    assert sorted(r[0] for r in io.first_rows_by(d, 10).collect()) == [2**60 + k for k in range(10)]
    t = spark.range(100).select(F.format_string("k%03d", "id").alias("name"))
    assert io.first_rows_by(t, 7, "name").count() == 7


def test_missing_times_come_last(spark, events):
    ev = events.limit(50).withColumn("ts", F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("ts")))
    got = series.sort_by_time(ev, tiebreak="event_id").orderBy("row_index").collect()
    empty = [r["ts"] is None for r in got]
    assert any(empty) and empty == sorted(empty) and [r["row_index"] for r in got] == list(range(50))


def test_weeks_are_rejected_and_zoom_has_n_pairs(spark):
    with pytest.raises(ValueError):
        freq_micros("1w")
    pairs = spark.range(10, 500).withColumnRenamed("id", "pos")
    assert FC.zoom_first(pairs, 100, lookback=10).count() == 100


def test_adf_of_a_constant_key(spark):
    rng = np.random.default_rng(1)
    rows = [("flat", i, 3.0) for i in range(200)] + [("noise", i, float(v)) for i, v in enumerate(rng.normal(size=200))]
    s = spark.createDataFrame(rows, "k string, idx long, txn_count double")
    got = {r["k"]: r["adf_statistic"] for r in stats.adf_test(s, keys=["k"]).collect()}
    assert got["noise"] < -5 and (got.get("flat") is None or math.isnan(got["flat"]))


def test_running_sums_are_exact(spark):
    """Sums of finite values do not depend on the order or the size of what they pass through, nor on where a batch ends."""
    from ratecast.operators.blocks import EXACT_SUM, running_sums
    values = [1e16, 1.0 / 4, -1e16] * 1000
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "idx bigint, v double").repartition(3)
    whole = running_sums(df, ["v"], block=64)
    assert whole.where("idx = 2999").first()["cum_v"] == 250.0
    zero = F.struct(*[F.lit(0).alias(k) for k in ("int", "frac", "nan", "pinf", "ninf")]).cast(EXACT_SUM)
    first = running_sums(df.where("idx < 1234").withColumn("s", zero), ["v"], block=64, start={"v": "s"})
    end = first.where("idx = 1233").select(F.col("cum_v_exact").alias("s"))
    rest = running_sums(df.where("idx >= 1234").crossJoin(end), ["v"], block=64, start={"v": "s"})
    both = {r["idx"]: r["cum_v"] for r in first.unionByName(rest, allowMissingColumns=True).collect()}
    assert both == {r["idx"]: r["cum_v"] for r in whole.collect()}
