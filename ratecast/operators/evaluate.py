"""Forecast evaluation: one aggregation per model / key, no collects."""
from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.functions import metrics as M
from ratecast.operators.series import attach


def evaluate(pred: DataFrame, by: Sequence[str] = ("model",), actual: str = "actual",
             predicted: str = "predicted") -> DataFrame:
    """E1-E5 in one pass: count, mean actual, MAE, RMSE, the four percentage errors."""
    by = [c for c in by if c in pred.columns]
    return pred.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(actual).cast("double")).alias("avg_actual"),
        M.mae(actual, predicted).alias("mae"),
        M.rmse(actual, predicted).alias("rmse"),
        M.mape_raw(actual, predicted).alias("mape_raw"),
        M.mape_eps(actual, predicted).alias("mape_eps"),
        M.mape_nonzero(actual, predicted).alias("mape_nonzero"),
        M.wape(actual, predicted).alias("wape"))


def metric_summary(pred: DataFrame, by: Sequence[str] = ("model",), actual: str = "actual",
                   predicted: str = "predicted") -> DataFrame:
    """The replay's final report: predictions, mean actual, MAE, RMSE, MAPE (numpy
    rules), accuracy = 100 - MAPE, model label; plus WAPE and MAPE over non-zero actuals."""
    by = [c for c in by if c in pred.columns]
    return pred.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.avg(F.col(actual).cast("double")).alias("avg_actual"),
        M.mae(actual, predicted).alias("mae"),
        M.rmse(actual, predicted).alias("rmse"),
        M.mape_raw(actual, predicted).alias("mape"),
        M.mape_nonzero(actual, predicted).alias("mape_nonzero"),
        M.wape(actual, predicted).alias("wape")) \
        .withColumn("accuracy_pct", F.lit(100.0) - F.col("mape"))


def improvement_over_naive(model_pred: DataFrame, naive_pred: DataFrame, on: Sequence[str] = ("idx",),
                           keys: Sequence[str] = ()) -> DataFrame:
    """``(mae_naive - mae) / mae_naive * 100`` on the rows both predicted."""
    keys = list(keys)
    j = model_pred.select(*keys, *on, "actual", "predicted").join(
        naive_pred.select(*keys, *on, F.col("predicted").alias("_naive")), [*keys, *on])
    a = j.where(F.col("_naive").isNotNull()).groupBy(*keys).agg(
        M.mae("actual", "predicted").alias("mae"), M.mae("actual", "_naive").alias("mae_naive"))
    return a.withColumn("improvement_pct",
                        F.try_divide(F.col("mae_naive") - F.col("mae"), F.col("mae_naive")) * 100)


def leaderboard(pred: DataFrame, by: Sequence[str] = ("model",), order: str | None = "run_order") -> DataFrame:
    """One metric row per model over a long prediction table (``model`` column)."""
    by = list(by)
    board = evaluate(pred, by)
    if order and order in pred.columns:
        ro = pred.groupBy(*by).agg(F.min(order).alias(order))
        board = board.join(ro, by)
    return board


def timed_leaderboard(runs: Sequence[tuple[str, Callable[[], DataFrame]]]) -> DataFrame:
    """E8 with ``seconds``: every ``(name, make)`` of ``runs`` is fitted, predicted and scored by itself, one after another, and timed.
    A model that fails is a row with its ``error`` and no metrics, and the others go on."""
    boards, spark = [], None
    for order, (name, make) in enumerate(runs):
        t0 = time.perf_counter()
        try:
            pred = make()
            spark = pred.sparkSession
            row, error = evaluate(pred, ("model",)).first(), None
        except Exception as e:  # noqa: BLE001 - a failed run is a row
            row, error = None, str(e)[:500]
        boards.append((row.model if row else name, order, *((row[c] for c in METRICS) if row else [None] * len(METRICS)),
                       time.perf_counter() - t0, error))
    schema = "model string, run_order int, n bigint, " + ", ".join(f"{c} double" for c in METRICS[1:]) + ", seconds double, error string"
    return (spark or SparkSession.getActiveSession()).createDataFrame(boards, schema)


METRICS = ("n", "avg_actual", "mae", "rmse", "mape_raw", "mape_eps", "mape_nonzero", "wape")


def best_model(board: DataFrame, metric: str = "mae", order: str = "run_order",
               keys: Sequence[str] = ()) -> DataFrame:
    """Arg-min of ``metric``; the first model in run order wins a tie."""
    keys = list(keys)
    tie = F.col(order) if order in board.columns else F.col("model")
    return board.groupBy(*keys).agg(
        F.min_by(F.col("model"), F.struct(F.col(metric), tie)).alias("best_model"),
        F.min(metric).alias(f"best_{metric}"))


def replay_progress(pred: DataFrame, keys: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """For each replayed row, predictions made so far and progress in percent."""
    keys = list(keys)
    b = pred.groupBy(*keys).agg(F.min(idx).alias("_first"), F.count(F.lit(1)).alias("_total"))
    s = attach(pred, b, keys)
    done = F.col(idx) - F.col("_first") + 1
    return s.withColumn("predictions_so_far", done) \
        .withColumn("progress_pct", done * 100.0 / F.col("_total")).drop("_first", "_total")
