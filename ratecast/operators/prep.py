"""Split and scale. Splits are predicates on the dense index; scalers are
one-row (per key) statistics tables attached by broadcast."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecast.operators.series import attach, series_length


def n_train_expr(n: str, frac: float):
    """Python ``int(n * frac)`` in double arithmetic."""
    return F.floor(F.col(n).cast("double") * F.lit(float(frac))).cast("long")


def temporal_split(series: DataFrame, frac: float | None = 0.8, test_frac: float | None = None,
                   keys: Sequence[str] = (), col: str | None = "txn_count", idx: str = "idx") -> DataFrame:
    """M1: first ``int(n*frac)`` rows of each key are 'train', the rest 'test'; never
    shuffled. ``test_frac=f`` uses ``int(n*(1-f))`` as the console replay does.

    Adds ``split`` and ``n_train``.
    """
    if test_frac is not None:
        frac = 1 - test_frac
    if frac is None or not (0 < frac < 1):
        raise ValueError("train fraction must be between 0 and 1 (exclusive), e.g. 0.8")
    if col is not None and col not in series.columns:
        raise ValueError(f"DataFrame must contain a '{col}' column")
    keys = list(keys)
    n = series_length(series, keys, idx).select(*keys, n_train_expr("n", frac).alias("n_train"))
    s = attach(series, n, keys)
    return s.withColumn("split", F.when(F.col(idx) < F.col("n_train"), "train").otherwise("test"))


FEATURE_COLS = ("hour", "day_of_week", "is_weekend")


def split_features_target(features: DataFrame, frac: float = 0.8, target: str = "txn_count",
                          feature_cols: Sequence[str] = FEATURE_COLS, keys: Sequence[str] = ()) -> DataFrame:
    """M2: X/y by side: ``split, idx, <features>, y``."""
    s = temporal_split(features, frac, keys=keys, col=target)
    return s.select(*keys, "split", "idx", *feature_cols, F.col(target).alias("y"))


def tail_split(series: DataFrame, n_tail: int, keys: Sequence[str] = (), idx: str = "idx") -> DataFrame:
    """M3: the last ``n_tail`` rows of each key, re-indexed from 0."""
    keys = list(keys)
    n = series_length(series, keys, idx)
    s = attach(series, n, keys)
    start = F.greatest(F.col("n") - F.lit(n_tail), F.lit(0))
    return s.where(F.col(idx) >= start).withColumn(idx, F.col(idx) - start).drop("n")


def validation_tail(train_windows: DataFrame, val_frac: float = 0.1, keys: Sequence[str] = (),
                    row: str = "row") -> DataFrame:
    """M4: the last ``val_frac`` of the training sequences (cut at
    ``int(m*(1-val_frac))``) flagged ``is_validation``."""
    keys = list(keys)
    m = train_windows.groupBy(*keys).agg((F.max(row) + 1).alias("_m"))
    s = attach(train_windows, m, keys)
    cut = n_train_expr("_m", 1 - val_frac)
    return s.withColumn("is_validation", F.col(row) >= cut).drop("_m")


# ----------------------------------------------------------------------------------
# min-max scaling with scikit-learn's rules (constant column -> x - min, no clipping)
# ----------------------------------------------------------------------------------
def minmax_fit(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
               where=None) -> DataFrame:
    """M5 (fit): one row per key with ``<c>_min``, ``<c>_max``. ``where`` restricts the
    fit (e.g. ``split = 'train'``); the reference fits on all rows."""
    src = df if where is None else df.where(where)
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"{c}_min"), F.max(F.col(c).cast("double")).alias(f"{c}_max")]
    return src.groupBy(*keys).agg(*aggs)


def _scaled(c: str):
    lo, hi = F.col(f"{c}_min"), F.col(f"{c}_max")
    rng = hi - lo
    return F.when(rng == 0, F.col(c) - lo).otherwise((F.col(c) - lo) / rng)


def minmax_apply(df: DataFrame, scaler: DataFrame, cols: Sequence[str],
                 keys: Sequence[str] = ()) -> DataFrame:
    """M6: apply a fitted scaler (saved or fresh) to ``cols``."""
    s = attach(df, scaler, keys)
    for c in cols:
        s = s.withColumn(c, _scaled(c))
    return s.drop(*[f"{c}_{b}" for c in cols for b in ("min", "max")])


def minmax_fit_transform(df: DataFrame, cols: Sequence[str] = ("txn_count",),
                         keys: Sequence[str] = ()) -> DataFrame:
    """M5: fit on all rows, then transform."""
    return minmax_apply(df, minmax_fit(df, cols, keys), cols, keys)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric columns (``select_dtypes(include='number')``)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def minmax_all_numeric(df: DataFrame, exclude: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """M7: every numeric column scaled on its own, all fitted in one aggregation."""
    cols = numeric_columns(df, exclude=list(exclude) + list(keys))
    return minmax_fit_transform(df, cols, keys)


def minmax_inverse(df: DataFrame, scaler: DataFrame, cols: Sequence[str],
                   keys: Sequence[str] = ()) -> DataFrame:
    """M8: back to the original units, ``x * (max - min) + min`` (``x + min`` for a
    constant fit)."""
    s = attach(df, scaler, keys)
    for c in cols:
        lo, hi = F.col(f"{c}_min"), F.col(f"{c}_max")
        rng = hi - lo
        s = s.withColumn(c, F.when(rng == 0, F.col(c) + lo).otherwise(F.col(c) * rng + lo))
    return s.drop(*[f"{c}_{b}" for c in cols for b in ("min", "max")])
