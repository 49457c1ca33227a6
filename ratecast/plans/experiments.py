"""Experiment grid (O4, O9) and run log (S9): features / split computed once, windows
once per lookback, every configuration scored in one aggregation."""
from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.functions import metrics as M
from ratecast.operators import forecast as FC
from ratecast.operators import leastsq as LS
from ratecast.operators.blocks import bounded_window
from ratecast.operators.prep import temporal_split
from ratecast.operators.windows import lookback_windows
from ratecast.session import materialize

BASELINES = ("moving_avg", "naive", "ar1")


def baseline_predictions(split_series: DataFrame, models: Sequence[str] = BASELINES,
                         col: str = "txn_count") -> DataFrame:
    """Long table ``idx, n_train, model, run_order, actual, predicted`` for the
    baseline forecasters over the whole series: one halo window for all of them, stacked."""
    unknown = set(models) - set(BASELINES)
    if unknown:
        raise ValueError(f"unknown models {sorted(unknown)}")
    y = F.col(col).cast("double")
    w = bounded_window(split_series.select("idx", "n_train", "split", y.alias("actual")), {
        "moving_avg": FC.moving_avg_of("actual", 3), "naive": lambda w: F.lag("actual", 1).over(w)}, halo=3)
    if "ar1" in models:
        fit = w.where("split = 'train'").agg(F.regr_intercept("actual", "naive").alias("_a"), F.regr_slope("actual", "naive").alias("_b"))
        w = w.crossJoin(F.broadcast(fit)).withColumn("ar1", F.col("_a") + F.col("_b") * F.col("naive"))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(i).alias("run_order"), F.col(m).alias("predicted"))
                               for i, m in enumerate(models)]))
    return w.select("idx", "n_train", "actual", each.alias("_p")).select("idx", "n_train", "_p.model", "_p.run_order", "actual", "_p.predicted")


def experiment_grid(series: DataFrame, models: Sequence[str] = BASELINES,
                    lookbacks: Sequence[int] = (10, 30, 60), batch_sizes: Sequence[int] = (32, 64),
                    train_frac: float = 0.8, col: str = "txn_count") -> DataFrame:
    """One metric row per (model, lookback, batch_size). As in the reference, the
    test windows are built inside the test side, so the first ``lookback`` test rows
    are not scored; ``batch_size`` is a label (no effect on a closed-form model)."""
    spark = series.sparkSession
    s = temporal_split(series, train_frac, col=col)
    preds = baseline_predictions(s, models, col)
    starts = spark.createDataFrame([(int(l),) for l in lookbacks], "lookback int")
    labels = spark.createDataFrame([(int(b),) for b in batch_sizes], "batch_size int")
    scored = preds.crossJoin(F.broadcast(starts)).where(F.col("idx") >= F.col("n_train") + F.col("lookback"))
    runs = scored.groupBy("model", "run_order", "lookback").agg(
        F.count(F.lit(1)).alias("n"), M.mae().alias("mae"), M.rmse().alias("rmse"),
        M.mape_eps().alias("mape"))
    return runs.crossJoin(F.broadcast(labels)).select("model", "run_order", "lookback", "batch_size",
                                                      "n", "mae", "rmse", "mape")


def fit_predict_lagged(series: DataFrame, lookback: int = 60, estimator: str = "linear",
                       train_frac: float = 0.8, col: str = "txn_count", seed: int = 42):
    """Fit a next-value regressor on ``lookback``-lag windows of the train side and
    predict the test side (windows never cross the split). Returns
    ``(predictions DataFrame, fitted PipelineModel)``.

    The neural networks of the reference are re-aimed to Spark ML regressors."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    s = temporal_split(series, train_frac, col=col)
    win = lookback_windows(s, col, lookback, split_col="split") \
        .withColumn("features", array_to_vector("x")).drop("x")
    train = win.where(F.col("split") == "train").repartitionByRange("idx")
    test = win.where(F.col("split") == "test")
    if estimator == "linear":
        est = LinearRegression(featuresCol="features", labelCol="y", predictionCol="predicted")
    elif estimator == "random_forest":
        est = RandomForestRegressor(featuresCol="features", labelCol="y", predictionCol="predicted",
                                    numTrees=20, maxDepth=6, seed=seed)
    elif estimator == "gbt":
        est = GBTRegressor(featuresCol="features", labelCol="y", predictionCol="predicted",
                           maxIter=20, maxDepth=4, seed=seed)
    else:
        raise ValueError(estimator)
    model = Pipeline(stages=[est]).fit(train)
    pred = model.transform(test).select("idx", "row", F.col("y").alias("actual"), "predicted")
    return pred, model


def lagged_linear(series: DataFrame, lookbacks: Sequence[int], train_frac: float = 0.8, col: str = "txn_count"):
    """O4, linear: ``(packed blocks, fits)`` of least squares on the lags for all ``lookbacks`` in one pass (``leastsq``)."""
    blocks = materialize(LS.pack_series(temporal_split(series, train_frac, col=col), lookbacks, col))
    return blocks, LS.lagged_fit(blocks, lookbacks)


def linear_grid(series: DataFrame, lookbacks: Sequence[int], batch_sizes: Sequence[int], train_frac: float = 0.8) -> DataFrame:
    """One metric row for each lookback and batch size; the fits and the scores are one pass each, whatever the number of rows."""
    spark, t0 = series.sparkSession, time.time()
    blocks, fits = lagged_linear(series, lookbacks, train_frac)
    order = {int(k): i for i, k in enumerate(lookbacks)}
    m = LS.lagged_predictions(blocks, fits).groupBy("lookback").agg(
        F.count(F.lit(1)).alias("n"), M.mae().alias("mae"), M.rmse().alias("rmse"), M.mape_eps().alias("mape"))
    m = materialize(m)                                    # a row for each lookback; its time is the runs' time
    seconds = (time.time() - t0) / len(order)
    names = spark.createDataFrame([(k, i, int(b)) for k, i in order.items() for b in batch_sizes], "lookback int, run_order int, batch_size int")
    return m.join(F.broadcast(names), "lookback").select(
        F.lit("linear").alias("model"), "run_order", "lookback", "batch_size", "n", "mae", "rmse", "mape",
        F.lit(None).cast("string").alias("error"), F.lit(seconds).alias("seconds"),
        F.concat(F.lit("linear_lb"), F.col("lookback").cast("string"), F.lit("_b"), F.col("batch_size").cast("string")).alias("run_name"))


def ml_grid(series: DataFrame, estimators: Sequence[str] = ("linear",), lookbacks: Sequence[int] = (10, 30, 60),
            batch_sizes: Sequence[int] = (32, 64), train_frac: float = 0.8) -> DataFrame:
    """O9 with fitted regressors, timed; the batch size is recorded as a label. All linear fits come from one
    pass; tree learners are one Spark ML fit per (estimator, lookback). Failures become rows with an ``error``."""
    spark = series.sparkSession
    rows = None
    order = 0
    for est in estimators:
        if est == "linear":
            m = linear_grid(series, lookbacks, batch_sizes, train_frac).withColumn("run_order", F.col("run_order") + F.lit(order))
            rows = m if rows is None else rows.unionByName(m)
            order += len(lookbacks)
            continue
        for lb in lookbacks:
            t0 = time.time()
            try:
                pred, _ = fit_predict_lagged(series, lb, est, train_frac)
                m = pred.agg(F.count(F.lit(1)).alias("n"), M.mae().alias("mae"), M.rmse().alias("rmse"),
                             M.mape_eps().alias("mape"))
                m = m.withColumn("error", F.lit(None).cast("string"))
            except Exception as e:  # noqa: BLE001 - a failed run is a row, as in the reference
                m = spark.createDataFrame([(0, None, None, None, str(e))],
                                          "n long, mae double, rmse double, mape double, error string")
            m = m.crossJoin(F.broadcast(spark.createDataFrame([(b,) for b in batch_sizes], "batch_size int")))
            m = m.select(F.lit(est).alias("model"), F.lit(order).alias("run_order"), F.lit(lb).alias("lookback"),
                         "batch_size", "n", "mae", "rmse", "mape", "error",
                         F.lit(time.time() - t0).alias("seconds"),
                         F.concat(F.lit(f"{est}_lb{lb}_b"), F.col("batch_size").cast("string")).alias("run_name"))
            rows = m if rows is None else rows.unionByName(m)
            order += 1
    return rows
