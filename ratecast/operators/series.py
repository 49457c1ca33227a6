"""Time-series construction and simple projections / filters (2.C).

A *series* is ``keys.., ts timestamp_ntz, idx bigint, <count_col> bigint``: one row per
bin from the first to the last non-empty bin of each key, zeros present. ``idx`` is the
bin number since the first bin, computed arithmetically (never ``row_number``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecast.functions.timecols import DAY_US, as_ntz, freq_micros, from_micros, to_micros
from ratecast.operators.keyjoin import join_keys
from ratecast.session import shuffle_partitions

GRID_CHUNK = 1440  # bins generated per grid task row


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Attach per-key statistics: a one-row table is broadcast (proven size), a keyed
    table is joined and left to AQE (broadcast when it is small at run time)."""
    keys = list(keys)
    if not keys:
        return df.crossJoin(F.broadcast(stats))
    return join_keys(df, stats, keys)


def bin_events(df: DataFrame, ts: str = "ts", freq: str | int = "1 minute",
               keys: Sequence[str] = ()) -> DataFrame:
    """``keys.., _bin`` (bin start, microseconds) for every event with a timestamp.

    Bins are left-closed, left-labelled and anchored at midnight of each key's first
    day (pandas ``origin='start_day'``). When the step divides a day this equals epoch
    anchoring, so no pass over the log is needed to find the origin.
    """
    keys = list(keys)
    step = freq_micros(freq)
    ev = df.select(*keys, to_micros(as_ntz(df, ts)).alias("_us")).where(F.col("_us").isNotNull())
    if DAY_US % step == 0:
        return ev.select(*keys, (F.col("_us") - F.pmod("_us", F.lit(step))).alias("_bin"))
    origin = ev.groupBy(*keys).agg(F.min("_us").alias("_m")) \
        .select(*keys, (F.col("_m") - F.pmod("_m", F.lit(DAY_US))).alias("_org"))
    j = attach(ev, origin, keys)
    return j.select(*keys, (F.col("_us") - F.pmod(F.col("_us") - F.col("_org"), F.lit(step))).alias("_bin"))


def dense_grid(bounds: DataFrame, step: int, keys: Sequence[str] = (),
               partitions: int | None = None, chunk: int = GRID_CHUNK) -> DataFrame:
    """All bins from ``_lo`` to ``_hi`` (microseconds) per key, as ``keys.., _bin, idx``.

    Generated in two levels: a few chunk rows per key are spread over ``partitions``
    tasks, then each chunk explodes its own bins, so a long or fine grid is never built
    in one task.
    """
    keys = list(keys)
    p = partitions or shuffle_partitions(bounds.sparkSession)
    nb = ((F.col("_hi") - F.col("_lo")) / F.lit(step)).cast("long") + 1
    chunks = bounds.select(*keys, "_lo", nb.alias("_nb")) \
        .select(*keys, "_lo", "_nb",
                F.explode(F.sequence(F.lit(0).cast("long"),
                                     F.floor((F.col("_nb") - 1) / F.lit(chunk)).cast("long"))).alias("_ch"))
    chunks = chunks.repartition(p, *keys, "_ch")
    idx = F.explode(F.sequence(F.col("_ch") * F.lit(chunk),
                               F.least((F.col("_ch") + 1) * F.lit(chunk), F.col("_nb")) - 1))
    g = chunks.select(*keys, "_lo", idx.alias("idx"))
    return g.select(*keys, (F.col("_lo") + F.col("idx") * F.lit(step)).alias("_bin"), "idx")


def resample_count(df: DataFrame, ts: str = "ts", freq: str | int = "1 minute",
                   keys: Sequence[str] = (), count_col: str = "txn_count") -> DataFrame:
    """T1/T2 ``resample_count``: events per bin, zero-filled between the first and last
    non-empty bin. Output ``keys.., ts, idx, <count_col>``.

    Plan: one scan of the log with a partial (map-side) count per bin; the bounds are
    read from the already-aggregated counts (the exchange is reused), the grid is
    generated in parallel chunks, and a bin-sized join fills the zeros.
    """
    keys = list(keys)
    step = freq_micros(freq)
    # the explicit not-null filter makes both uses of ``counts`` identical (the join would
    # otherwise infer it on one side only), so the shuffle of the log is reused
    binned = bin_events(df, ts, step, keys)
    counts = binned.where(F.col("_bin").isNotNull()) \
        .groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 0)
    # referencing the count keeps the bounds on the aggregated counts (whose exchange is
    # reused), instead of letting the optimizer re-derive them from a second log scan
    nonempty = F.when(F.col("_c") > 0, F.col("_bin"))
    bounds = counts.groupBy(*keys).agg(F.min(nonempty).alias("_lo"), F.max(nonempty).alias("_hi"))
    grid = dense_grid(bounds, step, keys)
    s = join_keys(grid, counts, keys, ["_bin"], "left")
    return s.select(*keys, from_micros(F.col("_bin")).alias("ts"), "idx",
                    F.coalesce(F.col("_c"), F.lit(0)).cast("long").alias(count_col))


def series_length(series: DataFrame, keys: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """``keys.., n``: bins per key (``max(idx) + 1`` on a dense series)."""
    return series.groupBy(*keys).agg((F.max(idx) + 1).alias("n"))


def series_completeness(series: DataFrame, freq: str | int = "1 minute", ts: str = "ts",
                        keys: Sequence[str] = ()) -> DataFrame:
    """Expected bins (from the time span) vs actual rows; missing = difference."""
    step = freq_micros(freq)
    us = to_micros(F.col(ts))
    return series.groupBy(*keys).agg(
        ((F.max(us) - F.min(us)) / F.lit(step) + 1).cast("long").alias("expected_bins"),
        F.count(F.lit(1)).alias("actual_bins")) \
        .withColumn("missing_bins", F.col("expected_bins") - F.col("actual_bins"))


def daily_counts(df: DataFrame, ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """T4: events per calendar date; dates without events are absent."""
    return df.where(F.col(ts).isNotNull()).groupBy(*keys, F.to_date(ts).alias("date")) \
        .agg(F.count(F.lit(1)).alias("n_events"))


def daily_count_stats(df: DataFrame, ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """T5: mean / min / max / sample std of the daily counts."""
    d = daily_counts(df, ts, keys)
    return d.groupBy(*keys).agg(
        F.avg("n_events").alias("mean_per_day"), F.min("n_events").alias("min_per_day"),
        F.max("n_events").alias("max_per_day"), F.stddev_samp("n_events").alias("std_per_day"))


def series_stats(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """Mean, median, sample std, min, max, CV = std / mean (NULL when mean is 0).

    ``percentile`` keeps one counter per distinct value; a count series has at most
    ``max(count) + 1`` of them, so the exact median is cheap here.
    """
    return series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_bins"),
        F.avg(col).alias("mean"), F.percentile(col, 0.5).alias("median"),
        F.stddev_samp(col).alias("std"), F.min(col).cast("double").alias("min"),
        F.max(col).cast("double").alias("max")) \
        .withColumn("cv", F.try_divide(F.col("std"), F.col("mean")))


def zero_bins(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (),
              threshold_pct: float = 5.0) -> DataFrame:
    """Number and share of empty bins, flagged above ``threshold_pct``."""
    return series.groupBy(*keys).agg(
        F.count_if(F.col(col) == 0).alias("zero_bins"), F.count(F.lit(1)).alias("n_bins")) \
        .withColumn("zero_pct", F.col("zero_bins") * 100.0 / F.col("n_bins")) \
        .withColumn("high_zero_share", F.col("zero_bins") > F.col("n_bins") * (threshold_pct / 100.0))


PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def series_percentiles(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (),
                       percentiles: Sequence[int] = PERCENTILES, exact_many_values: bool = False) -> DataFrame:
    """Linear-interpolated percentiles as rows ``keys.., percentile, value``.

    ``exact_many_values`` switches to the distributed exact quantile for columns with
    very many distinct values (a log column rather than a count series).
    """
    keys = list(keys)
    if exact_many_values:
        from ratecast.operators.quantiles import exact_quantiles   # which needs this module
        q = exact_quantiles(series, col, [p / 100 for p in percentiles], keys)
        return q.select(*keys, F.round(F.col("p") * 100).cast("int").alias("percentile"), "value")
    arr = F.percentile(F.col(col), F.array(*[F.lit(p / 100) for p in percentiles]))
    a = series.groupBy(*keys).agg(arr.alias("_q"))
    ps = F.array(*[F.lit(p) for p in percentiles])
    return a.select(*keys, F.posexplode("_q").alias("_i", "value")) \
        .select(*keys, ps[F.col("_i")].alias("percentile"), "value")


def sort_by_time(df: DataFrame, ts: str = "ts", tiebreak: str | None = None) -> DataFrame:
    """Global order by time (missing times last), then a 0-based position ``row_index`` (reset_index).

    The position comes from a range scan (per-partition counts + carried offsets), not
    from a single-partition ``row_number``.
    """
    from ratecast.operators.blocks import range_scan
    order = [ts] + ([tiebreak] if tiebreak else [])
    return range_scan(df, order, with_position=True).withColumnRenamed("pos", "row_index")


def split_summary(split_series: DataFrame, col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """Size, share and mean of the train and test sides."""
    keys = list(keys)
    from pyspark.sql import Window
    g = split_series.groupBy(*keys, "split").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(col).alias("mean"))
    tot = F.sum("n_rows").over(Window.partitionBy(*keys))
    return g.withColumn("share_pct", F.col("n_rows") * 100.0 / tot)


# ----------------------------------------------------------------------------------
# 2.C projections / filters
# ----------------------------------------------------------------------------------
def project_columns(df: DataFrame, keep: Sequence[str] | None = None,
                    drop: Sequence[str] | None = None) -> DataFrame:
    """F1."""
    if keep is not None:
        df = df.select(*keep)
    if drop:
        df = df.drop(*drop)
    return df


def large_gaps(gaps: DataFrame, minutes: float = 10.0, n: int | None = None,
               order: Sequence[str] = ("ts",)) -> DataFrame:
    """events whose gap to the previous event exceeds ``minutes``; with ``n``, the
    first n of them in time order (a top-k, not a cap on the work)."""
    out = gaps.where(F.col("gap_us") > F.lit(int(minutes * 60_000_000)))
    if n is not None:
        out = out.orderBy(*order).limit(n)
    return out


def weekend_filter(df: DataFrame, weekend: bool = True, flag: str = "is_weekend") -> DataFrame:
    """rows on (or off) the weekend."""
    c = F.col(flag).cast("boolean")
    return df.where(c if weekend else ~c)


def membership(df: DataFrame, col: str, values: Sequence) -> Column:
    """``isin`` as a boolean column."""
    return F.col(col).isin(list(values))


def positional_slice(df: DataFrame, start: int | None = None, stop: int | None = None,
                     idx: str = "idx") -> DataFrame:
    """rows ``[start, stop)`` by position on the dense index."""
    c = F.lit(True)
    if start is not None:
        c = c & (F.col(idx) >= start)
    if stop is not None:
        c = c & (F.col(idx) < stop)
    return df.where(c)


def rename_cast(series: DataFrame, src: str = "txn_count", dst: str = "txn_count",
                dtype: str = "double") -> DataFrame:
    """name the count column and cast it (float counts, as the grid script does)."""
    return series.withColumnRenamed(src, dst).withColumn(dst, F.col(dst).cast(dtype))
