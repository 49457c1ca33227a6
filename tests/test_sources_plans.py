"""Timestamp parsing, plan shape (no single-partition exchange), driver contract."""
import pytest
from pyspark.sql import functions as F

from ratecast.operators import forecast as FC
from ratecast.operators import windows as WI
from ratecast.operators.series import resample_count
from ratecast.sources.timeparse import parse_timestamp, parse_timestamp_iso


def test_mixed_text(spark):
    rows = [("2024-09-30 00:00:00.123456+00:00",), ("2024-09-30 00:00:01+00:00",), ("2024-09-30T00:00:01Z",),
            ("2024-09-30",), (None,), ("2024-09-30 10:00:00+02:00",), ("09/30/2024 10:00",)]
    df = spark.createDataFrame(rows, "timestamp string")
    got = [r["timestamp"] for r in parse_timestamp(df).collect()]
    assert str(got[0]) == "2024-09-30 00:00:00.123456"
    assert str(got[2]) == "2024-09-30 00:00:01"
    assert str(got[3]) == "2024-09-30 00:00:00"
    assert got[4] is None
    assert str(got[5]) == "2024-09-30 10:00:00"  # wall clock kept
    assert str(got[6]) == "2024-09-30 10:00:00"


def test_bad_text_raises(spark):
    df = spark.createDataFrame([("bad",)], "timestamp string")
    with pytest.raises(Exception):
        parse_timestamp(df).collect()
    with pytest.raises(Exception):
        parse_timestamp_iso(spark.createDataFrame([("09/30/2024",)], "timestamp string")).collect()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_inputs(plan: str):
    """The child operator of every single-partition exchange."""
    lines = plan.splitlines()
    return [lines[i + 1] for i, l in enumerate(lines) if "Exchange SinglePartition" in l]


def test_no_single_partition_windows(events):
    """The log and the series are never moved into one task; only small aggregated
    tables (carry tables, one-row statistics) may be."""
    s = resample_count(events)
    for df in (WI.event_gaps(events), WI.rolling_mean_std(s), WI.moving_average(s),
               FC.forecast_moving_avg(s), WI.lookback_windows(s, lookback=60),
               WI.running_metrics(FC.walk_forward(s))):
        for child in _single_partition_inputs(_plan(df)):
            assert "Aggregate" in child, child


def test_filter_and_projection_pushdown(events, spark):
    s = resample_count(events.where(F.col("event_type") == "click"))
    plan = _plan(s)
    assert "EqualTo(event_type,click)" in plan and "IsNotNull(ts)" in plan  # pushed to the scan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 1
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


def test_resample_scans_log_once(events):
    s = resample_count(events)
    s.collect()
    plan = s._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final


def test_first_rows_by_exact(spark, events):
    from ratecast.sources.io import first_rows_by
    got = sorted(r["event_id"] for r in first_rows_by(events, 777, "event_id").select("event_id").collect())
    exp = sorted(r["event_id"] for r in events.orderBy("event_id").limit(777).select("event_id").collect())
    assert got == exp
    assert first_rows_by(events, 10**9, "event_id").count() == events.count()


def test_describe_matches_pandas(spark):
    from ratecast.operators.profile import describe_numeric
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    got = describe_numeric(orders).toPandas().set_index("column_name")
    d = orders.select("o_orderkey", "o_custkey", "o_totalprice").toPandas().astype("float64").describe()
    for c in ("o_orderkey", "o_custkey", "o_totalprice"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert abs(got.loc[c, ours] - d.loc[theirs, c]) <= 1e-9 * max(1.0, abs(d.loc[theirs, c]))
