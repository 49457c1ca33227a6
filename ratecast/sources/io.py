"""Scans and sinks."""
from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecast.functions.timecols import as_ntz, to_micros
from ratecast.session import materialize


# Full-microsecond text layouts for timestamps in CSV files.
CSV_TS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV (header, explicit schema or inferred types) or Parquet by extension."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", header).options(**CSV_TS)
        if schema is None:
            r = r.option("inferSchema", True)
        return r.csv(path)
    return r.format(fmt).load(path)


def read_events(spark: SparkSession, path: str, fmt: str | None = None, schema=None,
                limit: int | None = None, order: str = "event_id") -> DataFrame:
    """S1 + S2: read the event log; with ``limit``, only the first ``limit`` events by
    ``order`` (file order is not defined in Spark)."""
    df = read_table(spark, path, fmt, schema)
    return first_rows_by(df, limit, order) if limit is not None else df


def first_rows_by(df: DataFrame, n: int, order: str = "event_id") -> DataFrame:
    """The ``n`` rows with the smallest unique ``order`` key, exactly and without a
    single-task top-k merge: the n-th smallest key is found by the distributed selection
    of ``exact_quantiles`` and used as a pushed-down filter."""
    if n <= 0:
        return df.limit(0)
    thr = _kth_smallest(df, order, n - 1)
    return df.crossJoin(F.broadcast(thr)).where(F.col(order) <= F.col("_thr")).drop("_thr")


def _kth_smallest(df: DataFrame, col: str, k: int) -> DataFrame:
    """One-row ``_thr``: the k-th smallest (0-based) non-null value, or the maximum."""
    from ratecast.operators.quantiles import rank_values
    return rank_values(df, col, [k]).select(F.col("value").alias("_thr"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write predictions, the enriched series (partitioned by date) or the
    profile summary. Parquet by default; CSV with a header row."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).options(**CSV_TS)
    w.format(fmt).save(path)


def write_and_read_back(df: DataFrame, path: str, fmt: str = "parquet",
                        partition_by: Sequence[str] = ()) -> DataFrame:
    """Write, then scan the written table (a lineage cut through the shared folder)."""
    write_table(df, path, fmt, partition_by=partition_by)
    spark = df.sparkSession
    r = spark.read
    if fmt == "csv":
        r = r.option("header", True).options(**CSV_TS).schema(df.schema)
    return r.format(fmt).load(path)


# ----------------------------------------------------------------------------------
# Run log (append-only Parquet table)
# ----------------------------------------------------------------------------------
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("parent_run_id", T.StringType()),
    T.StructField("run_name", T.StringType()), T.StructField("experiment", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("input_path", T.StringType()), T.StructField("seconds", T.DoubleType()),
    T.StructField("error", T.StringType()), T.StructField("logged_at", T.TimestampType()),
])


def input_key(df: DataFrame, ts: str = "ts") -> DataFrame:
    """One row ``input_key``: rows, first and last event of the log, so that ids follow the data and not where they lie."""
    us = to_micros(as_ntz(df, ts))
    return df.agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.min(us).cast("string"), F.max(us).cast("string")).alias("input_key"))


def _id(*parts) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), 1, 32)


def run_records(board: DataFrame, inputs: DataFrame, experiment: str, input_path: str,
                param_cols: Sequence[str], metric_cols: Sequence[str]) -> DataFrame:
    """A metric table (one row per run) as run records, and one record of their parent.

    Ids are digests: the parent's of the experiment and the input, a run's of its parent and its parameters in the order of
    ``param_cols``. The same experiment on the same data has the same ids, whoever computes them and however often."""
    params = F.create_map(*[x for c in param_cols for x in (F.lit(c), F.col(c).cast("string"))])
    mets = F.create_map(*[x for c in metric_cols for x in (F.lit(c), F.col(c).cast("double"))])
    secs = F.col("seconds").cast("double") if "seconds" in board.columns else F.lit(None).cast("double")
    err = F.col("error") if "error" in board.columns else F.lit(None).cast("string")
    name = F.col("run_name") if "run_name" in board.columns else F.concat_ws("_", *[F.col(c).cast("string") for c in param_cols])
    parent = _id(F.lit(experiment), F.col("input_key"))
    rows = board.crossJoin(F.broadcast(inputs)).select(
        _id(parent, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in param_cols]).alias("run_id"), parent.alias("parent_run_id"),
        name.alias("run_name"), F.lit(experiment).alias("experiment"), params.alias("params"), mets.alias("metrics"),
        F.lit(input_path).alias("input_path"), secs.alias("seconds"), err.alias("error"), F.current_timestamp().alias("logged_at"))
    top = rows.groupBy("experiment", "input_path", "parent_run_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("seconds"), F.max("logged_at").alias("logged_at"))
    head = top.crossJoin(F.broadcast(inputs)).select(
        F.col("parent_run_id").alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"), F.col("experiment").alias("run_name"), "experiment",
        F.create_map(F.lit("input_key"), F.col("input_key")).alias("params"), F.create_map(F.lit("runs"), F.col("n").cast("double")).alias("metrics"),
        "input_path", "seconds", F.lit(None).cast("string").alias("error"), "logged_at")
    return head.unionByName(rows)


def append_runs(records: DataFrame, path: str) -> str:
    """Add one parent's records to the run table, once. They are written to a staging folder first and renamed in one step to the
    folder named by the parent's id; if that is there already (an earlier run, or a retry that got further), nothing is added.
    Returns the parent's id."""
    spark = records.sparkSession
    records = materialize(records.select([f.name for f in RUN_SCHEMA.fields]))
    parents = [r.run_id for r in records.where("parent_run_id is null").select("run_id").limit(2).collect()]
    if len(parents) != 1:
        raise ValueError(f"records of one parent are logged at a time, these are of {len(parents)}")
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    staged, final = f"{path}/_staging/{uuid.uuid4().hex}", to_path(f"{path}/parent={parents[0]}")
    fs = final.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(final):
        records.coalesce(1).write.parquet(staged)
        # a rename onto a folder that came meanwhile would move into it: the marker file decides
        if fs.exists(final) or not fs.rename(to_path(staged), final):
            fs.delete(to_path(staged), True)
    return parents[0]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All records of the run table (parents have a null ``parent_run_id``)."""
    return spark.read.schema(RUN_SCHEMA).parquet(path).select([f.name for f in RUN_SCHEMA.fields])


# ----------------------------------------------------------------------------------
# Model persistence
# ----------------------------------------------------------------------------------
def save_model(model, path: str, lookback: int, scaler: DataFrame | None = None) -> None:
    """Persist a fitted ML model with its lookback (and scaler) beside it, so a
    reload cannot be called with the wrong window shape."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(int(lookback), time.time())], "lookback int, saved_at double") \
        .write.mode("overwrite").parquet(f"{path}/meta")
    if scaler is not None:
        scaler.write.mode("overwrite").parquet(f"{path}/scaler")


def load_model(spark: SparkSession, path: str):
    """Reload ``(model, lookback, scaler-or-None)``."""
    from pyspark.ml import PipelineModel
    model = PipelineModel.load(f"{path}/model")
    lookback = spark.read.parquet(f"{path}/meta").first()["lookback"]
    try:
        scaler = spark.read.parquet(f"{path}/scaler")
    except Exception:  # noqa: BLE001 - no scaler saved
        scaler = None
    return model, lookback, scaler


def save_fits(fits: DataFrame, path: str) -> None:
    """The fits of ``leastsq.lagged_fit``, a row for each lookback."""
    fits.write.mode("overwrite").parquet(path)


def load_fits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("lookback int, n bigint, intercept double, coefs array<double>").parquet(path)


NETWORK = "cell string, units int, lookback int, cols array<string>, weights array<double>, low double, high double, saved_at double"


def save_network(spark: SparkSession, model, path: str) -> None:
    """A trained recurrent network with all that scoring needs: its shape, its columns and the target's scaler."""
    row = (model.cell, model.units, model.lookback, list(model.cols), [float(x) for x in model.weights], model.low, model.high, time.time())
    spark.createDataFrame([row], NETWORK).write.mode("overwrite").parquet(path)


def load_network(spark: SparkSession, path: str):
    from ratecast.operators.recurrent import RecurrentModel
    r = spark.read.schema(NETWORK).parquet(path).first()
    return RecurrentModel(r.cell, r.units, r.lookback, tuple(r.cols), np.array(r.weights), r.low, r.high)
