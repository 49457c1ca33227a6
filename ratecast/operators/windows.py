"""Window operators, all without a single-partition window.

Bounded frames on the dense series use halo blocks; unbounded running state uses the
block carry; ordering the raw log uses the range scan (see ``blocks``).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecast.functions import metrics as M
from ratecast.functions.timecols import as_ntz, to_micros
from ratecast.operators.keyjoin import join_keys
from ratecast.operators.quantiles import exact_quantiles
from ratecast.operators.blocks import (bounded_window, drop_halo, halo_window,
                                       range_scan, running_sums, with_halo)
from ratecast.operators.series import attach, series_length


# ----------------------------------------------------------------------------------
# R1 / R2 on the event log
# ----------------------------------------------------------------------------------
def event_gaps(df: DataFrame, ts: str = "ts", tiebreak: str = "event_id",
               keys: Sequence[str] = ()) -> DataFrame:
    """Time since the previous event (``gap_us``, microseconds; null for the first
    event of each key). Equal timestamps are ordered by ``tiebreak``.

    Output: ``keys.., <tiebreak>, ts, gap_us``.
    """
    keys = list(keys)
    d = df.select(*keys, tiebreak, as_ntz(df, ts).alias("ts")) \
        .where(F.col("ts").isNotNull()).withColumn("_us", to_micros(F.col("ts")))
    s = range_scan(d, ["_us", tiebreak], keys=keys, carry=["_us"])
    return s.select(*keys, tiebreak, "ts", (F.col("_us") - F.col("prev__us")).alias("gap_us"))


def event_gap_stats(gaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """R2: mean, median, min and max gap in seconds. The median is exact and
    distributed (``exact_quantiles``): gaps have about as many distinct values as events."""
    keys = list(keys)
    g = gaps.where(F.col("gap_us").isNotNull())
    base = g.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_gaps"),
        (F.avg("gap_us") / 1e6).alias("mean_gap_s"),
        (F.min("gap_us") / 1e6).alias("min_gap_s"),
        (F.max("gap_us") / 1e6).alias("max_gap_s"))
    med = exact_quantiles(g, "gap_us", [0.5], keys).select(*keys, (F.col("value") / 1e6).alias("median_gap_s"))
    return join_keys(base, med, keys, how="left") if keys else base.crossJoin(F.broadcast(med))


# ----------------------------------------------------------------------------------
# bounded frames on the series
# ----------------------------------------------------------------------------------
def moving_average(series: DataFrame, col: str = "txn_count", rows: int = 5,
                   keys: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Trailing mean of ``rows`` rows, partial at the start (``min_periods=1``)."""
    out = out or f"txn_ma_{rows}"
    return bounded_window(series, {out: lambda w: F.avg(F.col(col).cast("double")).over(
        w.rowsBetween(-(rows - 1), 0))}, halo=rows - 1, keys=keys)


def rolling_mean_std(series: DataFrame, col: str = "txn_count", rows: int = 1440,
                     keys: Sequence[str] = (), min_periods: int | None = None,
                     block: int | None = None) -> DataFrame:
    """Trailing mean and sample std over ``rows`` rows, null until ``min_periods``
    (default ``rows``) rows exist.

    O(n) a block, and no differences of running sums, so a spike leaves nothing behind when it leaves the
    window. The index is cut every ``rows`` rows; a window is the last rows of one cut and the first of the next. The running
    (count, mean, sum of squared deviations) of every cut, from its start and from its end, are aggregates that
    grow by one row; two of them merge into the window's by the pairwise update of Chan et al. They are of distances from the
    block's least value, so a high level costs no digits.
    """
    keys = list(keys)
    mp = rows if min_periods is None else min_periods
    h = with_halo(series, rows, block).withColumn("_cut", F.floor(F.col("idx") / F.lit(rows)))
    h = h.withColumn("_level", F.min(F.col(col).cast("double")).over(Window.partitionBy(*keys, "_blk")))
    x = F.col(col).cast("double") - F.col("_level")
    cut = Window.partitionBy(*keys, "_blk", "_cut")
    grown = (Window.unboundedPreceding, 0)
    ahead, back = (cut.orderBy(o).rowsBetween(*grown) for o in (F.col("idx"), F.col("idx").desc()))
    state = lambda w: F.struct(F.count(x).over(w).alias("n"), F.avg(x).over(w).alias("m"),
                               (F.var_pop(x).over(w) * F.count(x).over(w)).alias("s"))
    h = h.withColumn("_a", state(ahead)).withColumn("_z", F.struct("_cut", state(back).alias("s")))
    w = halo_window(keys)
    # the end of the cut before, from the window's first row on; in the first cut there may be fewer rows
    begin = F.coalesce(F.lag("_z", rows - 1).over(w), F.first("_z").over(w.rowsBetween(*grown))) if rows > 1 else F.col("_z")
    h = h.withColumn("_z", begin)
    old = F.col("_z._cut") == F.col("_cut") - 1
    a, z = (lambda f: F.col(f"_a.{f}")), (lambda f: F.when(old, F.col(f"_z.s.{f}")).otherwise(F.lit(0)))
    n, by = a("n") + z("n"), F.coalesce(z("m"), F.lit(0.0)) - F.coalesce(a("m"), F.lit(0.0))
    share = F.try_divide(z("n").cast("double"), n)
    h = h.select("*", n.alias("_n"), (F.coalesce(a("m"), F.lit(0.0)) + by * share).alias("_m"),
                 (F.coalesce(a("s"), F.lit(0.0)) + F.coalesce(z("s"), F.lit(0.0)) + by * by * share * a("n")).alias("_s"))
    full = F.col("_n") >= mp
    h = h.withColumn("rolling_mean", F.when(full & (F.col("_n") > 0), F.col("_level") + F.col("_m"))) \
        .withColumn("rolling_std", F.when(full & (F.col("_n") > 1), F.sqrt(F.col("_s") / (F.col("_n") - 1))))
    return drop_halo(h).drop("_cut", "_level", "_a", "_z", "_n", "_m", "_s")


def _with_start(out: DataFrame, side_start: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """First index of each side. Without keys that is a row per split side: broadcast, so the windows
    (each ``lookback`` times a row) are not shuffled on a two-valued column."""
    return attach(out, side_start if keys else F.broadcast(side_start), parts)


def lookback_windows(series: DataFrame, col: str = "txn_count", lookback: int = 60,
                     keys: Sequence[str] = (), split_col: str | None = None) -> DataFrame:
    """Every ``lookback``-row input ``x`` (oldest first) with the next value ``y``;
    ``n - lookback`` rows per key (per split side when ``split_col`` is given, so no
    window crosses the boundary). ``row`` numbers the windows from 0 within a side.
    """
    parts = list(keys) + ([split_col] if split_col else [])
    frame = lambda w: w.rowsBetween(-lookback, -1)
    out = bounded_window(series, {
        "x": lambda w: F.collect_list(F.col(col).cast("double")).over(frame(w)),
    }, halo=lookback, keys=parts)
    out = out.where(F.size("x") == lookback)
    side_start = series.groupBy(*parts).agg(F.min("idx").alias("_start"))
    out = _with_start(out, side_start, keys, parts)
    return out.select(*parts, "idx", (F.col("idx") - F.col("_start") - lookback).alias("row"),
                      "x", F.col(col).cast("double").alias("y"))


def lookback_windows_multi(features: DataFrame, cols: Sequence[str] = ("txn_count", "hour", "day_of_week", "is_weekend"),
                           target: str = "txn_count", lookback: int = 60, keys: Sequence[str] = (),
                           split_col: str | None = None) -> DataFrame:
    """``x`` is ``lookback`` rows x F features (target's own past is feature 0),
    ``y`` the next target value."""
    parts = list(keys) + ([split_col] if split_col else [])
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    out = bounded_window(features.withColumn("_vec", vec), {
        "x": lambda w: F.collect_list("_vec").over(w.rowsBetween(-lookback, -1)),
    }, halo=lookback, keys=parts)
    out = out.where(F.size("x") == lookback)
    side_start = features.groupBy(*parts).agg(F.min("idx").alias("_start"))
    out = _with_start(out, side_start, keys, parts)
    return out.select(*parts, "idx", (F.col("idx") - F.col("_start") - lookback).alias("row"),
                      "x", F.col(target).cast("double").alias("y"))


def recent_values(series: DataFrame, col: str = "txn_count", k: int = 5,
                  keys: Sequence[str] = ()) -> DataFrame:
    """The last ``k`` values before each row (fewer at the start), oldest first."""
    return bounded_window(series, {f"recent_{k}": lambda w: F.collect_list(F.col(col)).over(
        w.rowsBetween(-k, -1))}, halo=k, keys=keys)


# ----------------------------------------------------------------------------------
# unbounded running state
# ----------------------------------------------------------------------------------
def running_metrics(pred: DataFrame, actual: str = "actual", predicted: str = "predicted",
                    keys: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """MAE, RMSE and numpy MAPE over all rows so far (null on the first row, as the
    replay only reports from the second prediction on)."""
    d = pred.withColumn("_ae", M.abs_error(actual, predicted)) \
        .withColumn("_se", (F.col(predicted) - F.col(actual)) * (F.col(predicted) - F.col(actual))) \
        .withColumn("_ape", M.ape_raw(actual, predicted))
    r = running_sums(d, ["_ae", "_se", "_ape"], keys, idx)
    ok = F.col("cum_n") > 1
    return r.select(*pred.columns,
                    F.when(ok, F.col("cum__ae") / F.col("cum_n")).alias("running_mae"),
                    F.when(ok, F.sqrt(F.col("cum__se") / F.col("cum_n"))).alias("running_rmse"),
                    F.when(ok, F.col("cum__ape") / F.col("cum_n") * 100).alias("running_mape"))


def last_n_points(pred: DataFrame, k: int = 50, keys: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """The last ``k`` rows of each key with their absolute error."""
    keys = list(keys)
    n = pred.groupBy(*keys).agg(F.max(idx).alias("_last"))
    s = attach(pred, n, keys)
    return s.where(F.col(idx) > F.col("_last") - k).drop("_last") \
        .withColumn("abs_error", M.abs_error("actual", "predicted"))


def stability_halves(rolled: DataFrame, rows: int = 1440, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the rolling mean / std over rows ``[rows, n/2)`` and ``[n/2, n)``,
    their change and change %, and the verdict (mean change < 10 % and std change < 20 %)."""
    keys = list(keys)
    n = series_length(rolled, keys)
    s = attach(rolled, n, keys)
    half = F.floor(F.col("n") / 2)
    first = (F.col("idx") >= rows) & (F.col("idx") < half)
    second = F.col("idx") >= half
    a = s.groupBy(*keys).agg(
        F.avg(F.when(first, F.col("rolling_mean"))).alias("first_mean"),
        F.avg(F.when(second, F.col("rolling_mean"))).alias("second_mean"),
        F.avg(F.when(first, F.col("rolling_std"))).alias("first_std"),
        F.avg(F.when(second, F.col("rolling_std"))).alias("second_std"))
    a = a.withColumn("mean_change", F.abs(F.col("second_mean") - F.col("first_mean"))) \
        .withColumn("std_change", F.abs(F.col("second_std") - F.col("first_std"))) \
        .withColumn("mean_change_pct", F.try_divide(F.col("mean_change"), F.col("first_mean")) * 100) \
        .withColumn("std_change_pct", F.try_divide(F.col("std_change"), F.col("first_std")) * 100)
    stable = (F.col("mean_change_pct") < 10) & (F.col("std_change_pct") < 20)
    return a.withColumn("is_stable", F.coalesce(stable, F.lit(False)))
