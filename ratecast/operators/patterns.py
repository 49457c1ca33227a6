"""Calendar patterns: group statistics by hour and weekday."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.functions.calendar import DAY_NAMES
from ratecast.operators.series import attach


def hourly_stats(features: DataFrame, col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """G1: mean, sample std, min, max by hour of day."""
    return features.groupBy(*keys, "hour").agg(
        F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"))


def peak_low_hour(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Hour with the highest and the lowest mean; the earlier hour wins a tie."""
    return hourly.groupBy(*keys).agg(
        F.max_by("hour", F.struct(F.col("mean"), -F.col("hour"))).alias("peak_hour"),
        F.max("mean").alias("peak_mean"),
        F.min_by("hour", F.struct(F.col("mean"), F.col("hour"))).alias("low_hour"),
        F.min("mean").alias("low_mean"))


def hourly_variation(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Range of the hourly means and that range as % of their mean."""
    return hourly.groupBy(*keys).agg(
        (F.max("mean") - F.min("mean")).alias("hourly_range"), F.avg("mean").alias("_m")) \
        .withColumn("hourly_range_pct", F.try_divide(F.col("hourly_range"), F.col("_m")) * 100).drop("_m")


def weekday_stats(features: DataFrame, col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """Mean and sample std by day name, Monday..Sunday, null rows for absent days.
    The 7-row day dimension is built from constants and broadcast."""
    keys = list(keys)
    spark = features.sparkSession
    agg = features.groupBy(*keys, F.date_format("ts", "EEEE").alias("day_name")).agg(
        F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))
    dim = spark.createDataFrame(list(enumerate(DAY_NAMES)), "day_of_week int, day_name string")
    if keys:
        dim = features.select(*keys).distinct().crossJoin(F.broadcast(dim))
        return dim.join(agg, [*keys, "day_name"], "left")
    return F.broadcast(dim).join(agg, "day_name", "left").select("day_of_week", "day_name", "mean", "std")


def busiest_quietest_day(weekday: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Arg-max / arg-min of the weekday means (Monday first on ties), range, %."""
    w = weekday.where(F.col("mean").isNotNull())
    return w.groupBy(*keys).agg(
        F.max_by("day_name", F.struct(F.col("mean"), -F.col("day_of_week"))).alias("busiest_day"),
        F.min_by("day_name", F.struct(F.col("mean"), F.col("day_of_week"))).alias("quietest_day"),
        (F.max("mean") - F.min("mean")).alias("weekly_range"), F.avg("mean").alias("_m")) \
        .withColumn("weekly_range_pct", F.try_divide(F.col("weekly_range"), F.col("_m")) * 100).drop("_m")


def weekend_vs_weekday(features: DataFrame, col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """Weekday and weekend means, absolute difference and % of the weekday mean."""
    wk = F.weekday("ts") > 4
    a = features.groupBy(*keys).agg(
        F.avg(F.when(~wk, F.col(col))).alias("weekday_mean"),
        F.avg(F.when(wk, F.col(col))).alias("weekend_mean"))
    a = a.withColumn("difference", F.abs(F.col("weekend_mean") - F.col("weekday_mean")))
    return a.withColumn("difference_pct", F.try_divide(F.col("difference"), F.col("weekday_mean")) * 100)
