"""The console replay as one plan: resample, split 90/10, one-step-ahead
baseline forecast over the whole series, keep the test side, score."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ratecast.operators.evaluate import metric_summary
from ratecast.operators.forecast import walk_forward
from ratecast.operators.series import resample_count
from ratecast.session import materialize


def replay_predictions(events: DataFrame, freq: str = "1 minute", test_frac: float = 0.1,
                       forecaster="moving_avg", keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """The prediction table: ``keys.., ts, idx, actual, predicted, error, model``."""
    # the series is read by the split, the forecast and the filter: compute it once
    series = materialize(resample_count(events, ts=ts, freq=freq, keys=keys))
    return walk_forward(series, forecaster, test_frac=test_frac, keys=keys)


def replay_metrics(events: DataFrame, freq: str = "1 minute", test_frac: float = 0.1,
                   forecaster="moving_avg", keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """The final report of the replay, one row per key."""
    pred = replay_predictions(events, freq, test_frac, forecaster, keys, ts)
    return metric_summary(pred, by=[*keys, "model"])
