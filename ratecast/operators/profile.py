"""Table profile. Every statistic is one distributed aggregation; wide
results are unpivoted into rows with ``stack``."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecast.operators.quantiles import exact_quantiles
from ratecast.operators.prep import numeric_columns


def _stack(df: DataFrame, cols: Sequence[str], name: str = "column_name", value: str = "value") -> DataFrame:
    """Unpivot one-row wide aggregates into ``(name, value)`` rows."""
    return df.unpivot([], list(cols), name, value)


def profile_overview(df: DataFrame) -> DataFrame:
    """One row per column (position, name, Spark type) with the table's row count."""
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "ordinal int, column_name string, data_type string")
    n = df.select(F.count(F.lit(1)).alias("n_rows"))
    return meta.crossJoin(F.broadcast(n))


def first_rows(df: DataFrame, n: int = 10, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The first n rows in time order (a top-k: per-partition heaps, then one merge)."""
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, n: int = 10, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The last n rows, returned in ascending order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def random_rows(df: DataFrame, n: int = 10, seed: int = 42, id_col: str = "event_id") -> DataFrame:
    """Exactly n pseudo-random rows, repeatable for a seed (order of the id's MD5 with the seed)."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))), id_col).limit(n)


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5: count, mean, sample std, min, 25/50/75 % (linear) and max per numeric column.

    Unpivoted to ``(column_name, value)`` so one aggregation serves every column; the
    quartiles use the distributed exact selection (no single-task value map)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = _stack(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), cols)
    base = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], keys=["column_name"])
    qw = q.groupBy("column_name").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("p75"))
    return base.join(qw, "column_name", "left")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, plus whether the table has none at all."""
    cols = df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = _stack(wide, cols, value="null_count")
    from pyspark.sql import Window
    return long.withColumn("table_has_no_nulls", F.sum("null_count").over(Window.partitionBy()) == 0)


def distinct_counts(df: DataFrame, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct non-null values per column. Each column is counted by itself: a scan of that column alone, its
    distinct values combined before they are shuffled by value. (``count_distinct`` of several columns at once would
    copy every row for every column.) HyperLogLog++ in one pass with ``approx``."""
    if approx:
        return _stack(df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in df.columns]), df.columns, value="n_distinct")
    out = None
    for c in df.columns:
        one = df.select(F.col(c).alias("v")).where(F.col("v").isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))
        one = one.select(F.lit(c).alias("column_name"), "n_distinct")
        out = one if out is None else out.unionByName(one)
    return out


# ----------------------------------------------------------------------------------
# P1 / P5 / P6 / P7 kept up to date day by day
# ----------------------------------------------------------------------------------
def daily_profile(df: DataFrame, cols: Sequence[str] | None = None, ts: str = "ts") -> DataFrame:
    """A row for each day and numeric column: rows, nulls, and what merges exactly (sum, mean and squared deviations, min, max) or as a
    sketch (distinct values: HyperLogLog, order: KLL). Kept as a table, a new day is one append and the log is
    not read again; see ``unite_profile``."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = df.select(F.to_date(ts).alias("day"), *[F.col(c).cast("double").alias(c) for c in cols]).unpivot("day", cols, "column_name", "value")
    v = F.col("value")
    return long.groupBy("day", "column_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.hll_sketch_agg(F.hash(v), F.lit(14)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(v, F.lit(1024)).alias("order_sketch"))


def unite_profile(daily: DataFrame) -> DataFrame:
    """The profile of all days of ``daily_profile``: ``column_name, n_rows, null_count, mean, std, min, max`` as one pass over the log would
    give them, ``approx_distinct`` and ``approx_median``."""
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    by = daily.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), total.alias("n"), mean.alias("mean"), F.min("min").alias("min"),
                                          F.max("max").alias("max"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("approx_distinct"),
                                          F.kll_merge_agg_double("order_sketch").alias("_o"))
    # squared deviations of a day about the common mean
    around = daily.join(by.select("column_name", F.col("mean").alias("_mu")), "column_name").groupBy("column_name").agg(
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mu")) * (F.col("mean") - F.col("_mu"))).alias("_m2"))
    median = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_o", F.lit(0.5)))
    return by.join(around, "column_name").select(
        "column_name", "n_rows", (F.col("n_rows") - F.col("n")).alias("null_count"), "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1))).alias("std"), "min", "max", "approx_distinct", median.alias("approx_median"))


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows equal to an earlier row (nulls compare equal): ``sum(count - 1)``."""
    cols = list(cols) if cols is not None else df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
                 F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("total_rows"))


def drop_duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One copy of each row."""
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def time_range(df: DataFrame, ts: str = "ts") -> DataFrame:
    """P10: first and last timestamp, whole days of the span and leftover whole hours."""
    from ratecast.functions.timecols import as_ntz, to_micros
    us = to_micros(as_ntz(df, ts))
    a = df.agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
               (F.max(us) - F.min(us)).alias("_d"))
    day = 86_400_000_000
    return a.select("start", "end",
                    F.floor(F.col("_d") / day).cast("long").alias("duration_days"),
                    F.floor(F.pmod(F.col("_d"), F.lit(day)) / 3_600_000_000).cast("long").alias("duration_hours"))


def numeric_columns_table(df: DataFrame) -> DataFrame:
    """The numeric columns, as rows."""
    spark = df.sparkSession
    cols = numeric_columns(df)
    return spark.createDataFrame([(i, c, df.schema[c].dataType.simpleString()) for i, c in enumerate(cols)],
                                 "ordinal int, column_name string, data_type string")
