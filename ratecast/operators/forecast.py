"""Forecast operators. A replay is not a loop: every one-step-ahead
prediction depends only on earlier actuals, so it is a bounded window over the whole
series, evaluated block-parallel, then filtered to the rows being replayed."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.functions import metrics as M
from ratecast.operators.keyjoin import join_keys
from ratecast.operators.blocks import bounded_window
from ratecast.operators.prep import tail_split, temporal_split
from ratecast.operators.series import attach


def moving_avg_of(col: str, k: int):
    """Window function of O1: mean of the last ``k`` values; with fewer, the last one; with none, 0."""
    def pred(w):
        frame = w.rowsBetween(-k, -1)
        x = F.col(col).cast("double")
        return (F.when(F.count(x).over(frame) == k, F.avg(x).over(frame))
                .when(F.count(x).over(frame) > 0, F.lag(x, 1).over(w))
                .otherwise(F.lit(0.0)))
    return pred


def forecast_moving_avg(series: DataFrame, col: str = "txn_count", k: int = 3,
                        keys: Sequence[str] = (), out: str = "predicted") -> DataFrame:
    """O1: mean of the last ``k`` actuals; with fewer, the last actual; with none, 0."""
    return bounded_window(series, {out: moving_avg_of(col, k)}, halo=k, keys=keys)


def forecast_naive_last(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (),
                        out: str = "predicted") -> DataFrame:
    """O2: the previous actual (null for the first row)."""
    return bounded_window(series, {out: lambda w: F.lag(F.col(col).cast("double"), 1).over(w)},
                          halo=1, keys=keys)


def forecast_ar1(split_series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (),
                 out: str = "predicted") -> DataFrame:
    """O3: ``y(t) = a + b*y(t-1)`` fitted by least squares on the 'train' rows, applied
    to every row (``regr_intercept`` / ``regr_slope``)."""
    keys = list(keys)
    lagged = bounded_window(split_series, {"_ylag": lambda w: F.lag(F.col(col).cast("double"), 1).over(w)},
                            halo=1, keys=keys)
    y = F.col(col).cast("double")
    fit = lagged.where(F.col("split") == "train").groupBy(*keys).agg(
        F.regr_intercept(y, F.col("_ylag")).alias("ar_intercept"),
        F.regr_slope(y, F.col("_ylag")).alias("ar_slope"))
    s = attach(lagged, fit, keys)
    return s.withColumn(out, F.col("ar_intercept") + F.col("ar_slope") * F.col("_ylag")) \
        .drop("_ylag", "ar_intercept", "ar_slope")


FORECASTERS: dict[str, Callable] = {
    "moving_avg": forecast_moving_avg,
    "naive": forecast_naive_last,
}
MODEL_LABELS = {"moving_avg": "Baseline (Moving Avg)", "naive": "Naive (last value)", "ar1": "AR(1)"}


def _forecast(split_series: DataFrame, forecaster, col, keys, k):
    if callable(forecaster):
        return forecaster(split_series)
    if forecaster == "moving_avg":
        return forecast_moving_avg(split_series, col, k, keys)
    if forecaster == "naive":
        return forecast_naive_last(split_series, col, keys)
    if forecaster == "ar1":
        return forecast_ar1(split_series, col, keys)
    raise ValueError(f"unknown forecaster {forecaster!r}")


def walk_forward(series: DataFrame, forecaster="moving_avg", test_frac: float = 0.1,
                 col: str = "txn_count", keys: Sequence[str] = (), k: int = 3,
                 model: str | None = None) -> DataFrame:
    """One-step-ahead replay over the test side, history seeded from the train tail.

    Output ``keys.., ts, idx, actual, predicted, error, model``.
    """
    keys = list(keys)
    s = temporal_split(series, test_frac=test_frac, keys=keys, col=col)
    f = _forecast(s, forecaster, col, keys, k)
    label = model or (MODEL_LABELS.get(forecaster, str(forecaster)) if isinstance(forecaster, str) else "model")
    return f.where(F.col("split") == "test").select(
        *keys, "ts", "idx", F.col(col).cast("double").alias("actual"), F.col("predicted"),
        F.abs(F.col("predicted") - F.col(col).cast("double")).alias("error"),
        F.lit(label).alias("model"))


def walk_forward_tail(series: DataFrame, n_tail: int = 300, lookback: int = 10, k: int = 3,
                      col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """Replay inside the last ``n_tail`` rows only; history starts at the first tail
    row, predictions from tail row ``lookback`` on (baseline forecaster)."""
    t = tail_split(series, n_tail, keys)
    f = forecast_moving_avg(t, col, k, keys)
    return f.where(F.col("idx") >= lookback).select(
        *keys, "ts", "idx", F.col(col).cast("double").alias("actual"), "predicted",
        F.abs(F.col("predicted") - F.col(col).cast("double")).alias("error"))


def model_fallback(df: DataFrame, model_col: str = "model_pred", baseline_col: str = "baseline",
                   actual_col: str = "actual", policy: str = "console", out: str = "predicted") -> DataFrame:
    """Model prediction when there is one; otherwise the actual itself (console
    replay) or the baseline (dashboard)."""
    if policy == "console":
        c = F.coalesce(F.col(model_col), F.col(actual_col).cast("double"))
    elif policy == "dashboard":
        c = F.coalesce(F.col(model_col), F.col(baseline_col))
    else:
        raise ValueError("policy must be 'console' or 'dashboard'")
    return df.withColumn(out, c)


def align_predictions(test: DataFrame, preds: DataFrame, lookback: int, col: str = "txn_count",
                      keys: Sequence[str] = ()) -> DataFrame:
    """Pair each prediction (numbered by window ``row`` within the test side) with
    the actual ``lookback`` rows later; an inner join on the index replaces the
    positional trim."""
    keys = list(keys)
    t0 = test.groupBy(*keys).agg(F.min("idx").alias("_t0"))
    t = attach(test, t0, keys).select(*keys, (F.col("idx") - F.col("_t0")).alias("_pos"), "ts",
                                      F.col(col).cast("double").alias("actual"))
    p = preds.select(*keys, (F.col("row") + lookback).alias("_pos"), "predicted")
    return join_keys(t, p, keys, ["_pos"]).withColumnRenamed("_pos", "pos")


def zoom_first(pairs: DataFrame, n: int = 100, lookback: int = 0, pos: str = "pos") -> DataFrame:
    """The first ``min(n, len)`` pairs; the first pair stands at position ``lookback``."""
    return pairs.where(F.col(pos) < lookback + n)


def batch_score(windows: DataFrame, make_predict_fn: Callable, lookback: int,
                n_features: int = 1, batch_size: int = 4096, x: str = "x",
                out: str = "predicted") -> DataFrame:
    """Score every window with a user model in Arrow batches
    (``predict_batch_udf``). ``make_predict_fn()`` returns ``f(ndarray[b, L(, F)]) ->
    ndarray[b]``; it is built once per Python worker."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as T
    shape = [lookback] if n_features == 1 else [lookback * n_features]
    col = F.col(x) if n_features == 1 else F.flatten(F.col(x))

    def factory():
        fn = make_predict_fn()
        if n_features == 1:
            return fn
        return lambda a: fn(a.reshape(len(a), lookback, n_features))

    udf = predict_batch_udf(factory, return_type=T.DoubleType(), batch_size=batch_size,
                            input_tensor_shapes=[shape])
    return windows.withColumn(out, udf(col))


def mean_of_window_model():
    """A stateless reference model for O5 tests and oracles: the mean of the window."""
    import numpy as np

    def predict(a):
        return np.asarray(a, dtype="float64").mean(axis=1)
    return predict


def linear_model(intercept: float, coefs: Sequence[float]):
    """A fitted linear model (``leastsq.lagged_fit``; lag 1 first) as a user model for O5."""
    import numpy as np
    weights = np.asarray(coefs, dtype="float64")[::-1].copy()          # windows are oldest first

    def predict(a):
        return np.asarray(a, dtype="float64") @ weights + intercept
    return predict
