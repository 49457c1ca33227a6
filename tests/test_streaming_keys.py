"""Batch == streaming on closed minutes; keyed operators == per-key unkeyed runs."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ratecast.operators import forecast as FC
from ratecast.operators import windows as WI
from ratecast.operators.series import resample_count
from ratecast.plans.catalog import q_stream_forecast

SF0001 = "/root/testdata/sf0.001"


def test_stream_forecast_equals_batch(spark):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    live = q_stream_forecast(spark, SF0001).toPandas().sort_values("ts").reset_index(drop=True)
    batch = FC.forecast_moving_avg(resample_count(ev)).orderBy("idx").toPandas()
    batch = batch[batch["ts"] <= live["ts"].max()].reset_index(drop=True)
    assert len(live) == len(batch)
    assert (live["ts"].to_numpy() == batch["ts"].to_numpy()).all()
    assert np.allclose(live["actual"], batch["txn_count"])
    assert np.allclose(live["predicted"], batch["predicted"])
    # running MAE from the stream == cumulative mean of the batch errors
    err = (batch["predicted"] - batch["txn_count"]).abs()
    cm = err.cumsum() / np.arange(1, len(err) + 1)
    assert np.allclose(live["running_mae"].iloc[1:], cm.iloc[1:])
    assert pd.isna(live["running_mae"].iloc[0])


def test_keyed_equals_per_key(spark, events):
    keyed = resample_count(events, freq="1 hour", keys=["event_type"])
    kf = FC.forecast_moving_avg(keyed, keys=["event_type"]).toPandas()
    kr = WI.rolling_mean_std(keyed, rows=24, keys=["event_type"]).toPandas()
    for et in ["click", "error"]:
        one = resample_count(events.where(F.col("event_type") == et), freq="1 hour")
        f1 = FC.forecast_moving_avg(one).orderBy("idx").toPandas()
        g = kf[kf.event_type == et].sort_values("idx")
        assert np.allclose(g["predicted"].to_numpy(), f1["predicted"].to_numpy())
        r1 = WI.rolling_mean_std(one, rows=24).orderBy("idx").toPandas()
        gr = kr[kr.event_type == et].sort_values("idx")
        assert np.allclose(gr["rolling_std"].to_numpy(), r1["rolling_std"].to_numpy(), equal_nan=True)
