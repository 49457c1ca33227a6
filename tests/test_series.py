"""Resample, split and calendar semantics against pandas on hand-written fixtures."""
import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratecast.functions.calendar import add_time_features
from ratecast.operators.prep import temporal_split
from ratecast.operators.series import daily_counts, resample_count


def _ev(spark, stamps):
    rows = [(i, s) for i, s in enumerate(stamps)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz")


def _pandas_resample(stamps, freq):
    s = pd.Series(1, index=pd.to_datetime([x for x in stamps if x is not None]))
    r = s.resample(freq).size()
    return list(r.index), list(r.values)


@pytest.mark.parametrize("freq,pfreq", [("1 minute", "1min"), ("7min", "7min"), ("1 hour", "1h")])
def test_resample_matches_pandas(spark, freq, pfreq):
    stamps = [dt.datetime(2024, 1, 1, 0, 0, 7), dt.datetime(2024, 1, 1, 0, 0, 9), dt.datetime(2024, 1, 1, 1, 13),
              dt.datetime(2024, 1, 5, 23, 59, 59), None]
    got = resample_count(_ev(spark, stamps), freq=freq).orderBy("idx").toPandas()
    idx, vals = _pandas_resample(stamps, pfreq)
    assert list(got["ts"]) == idx
    assert list(got["txn_count"]) == list(vals)
    assert list(got["idx"]) == list(range(len(idx)))
    assert got["txn_count"].sum() == 4  # null timestamps fall out


def test_first_7min_bin_starts_at_midnight(spark):
    got = resample_count(_ev(spark, [dt.datetime(2024, 1, 1, 0, 0, 7)]), freq="7min").toPandas()
    assert got["ts"].iloc[0] == pd.Timestamp("2024-01-01 00:00:00")


def test_edge_fixtures(spark):
    assert resample_count(_ev(spark, [])).count() == 0
    one = resample_count(_ev(spark, [dt.datetime(2024, 1, 1, 3, 4, 5)])).collect()
    assert len(one) == 1 and one[0]["txn_count"] == 1
    same = resample_count(_ev(spark, [dt.datetime(2024, 1, 1, 3, 4, s) for s in range(5)])).collect()
    assert len(same) == 1 and same[0]["txn_count"] == 5
    gap = _ev(spark, [dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 5, 12)])
    assert resample_count(gap, freq="1 day").count() == 5      # zero-filled
    assert daily_counts(gap).count() == 2                      # absent dates stay absent


def test_split_fractions(spark, events):
    s = resample_count(events)
    sp = temporal_split(s, test_frac=0.1)
    c = {r["split"]: r["count"] for r in sp.groupBy("split").count().collect()}
    assert c == {"train": 38878, "test": 4320}
    for bad in (0.0, 1.0, 1.5):
        with pytest.raises(ValueError):
            temporal_split(s, bad)
    with pytest.raises(ValueError):
        temporal_split(s.withColumnRenamed("txn_count", "n"), 0.8)


def test_calendar_monday_zero(spark):
    d = _ev(spark, [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 7)])
    f = add_time_features(d, ("day_of_week", "is_weekend", "day_name")).orderBy("ts").collect()
    assert [r["day_of_week"] for r in f] == [0, 5, 6]
    assert [r["is_weekend"] for r in f] == [0, 1, 1]
    assert f[0]["day_name"] == "Monday"


def test_resample_independent_of_session_zone(spark):
    from ratecast.functions.timecols import from_micros, to_micros
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamps = [dt.datetime(2024, 3, 10, 1, 59), dt.datetime(2024, 3, 10, 2, 30, 0, 123456),
                  dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]
        d = _ev(spark, stamps)
        r = d.select("ts", to_micros(F.col("ts")).alias("us")).select(
            "ts", "us", from_micros(F.col("us")).alias("back")).collect()
        for x in r:
            assert x.us == int((x.ts - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
            assert x.back == x.ts
        s = resample_count(_ev(spark, stamps[:2])).orderBy("idx").collect()
        assert len(s) == 32 and s[-1]["ts"] == dt.datetime(2024, 3, 10, 2, 30)  # wall clock kept in the DST gap
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
