"""Per-row error scalars and aggregate metric expressions.

Spark 4 runs with ANSI on, where ``x / 0`` raises: every ratio here is guarded and the
numpy inf/NaN outcomes are produced explicitly.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the float64 machine epsilon sklearn uses as the MAPE denominator floor.
EPS = 2.220446049250313e-16
NAN = float("nan")
INF = float("inf")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def abs_error(actual="actual", predicted="predicted") -> Column:
    """C7."""
    return F.abs(_c(predicted) - _c(actual))


def ape_guarded(actual="actual", predicted="predicted") -> Column:
    """Percentage error, 0 when the actual is not positive."""
    a = _c(actual).cast("double")
    return F.when(a > 0, F.abs(_c(predicted) - a) / a * 100).otherwise(F.lit(0.0))


def ape_raw(actual="actual", predicted="predicted") -> Column:
    """numpy ``abs((p-a)/a)``: NaN for 0/0, +inf for x/0."""
    a = _c(actual).cast("double")
    e = _c(predicted).cast("double") - a
    return (F.when((a == 0) & (e == 0), F.lit(NAN))
            .when(a == 0, F.lit(INF))
            .otherwise(F.abs(e / a)))


def mae(actual="actual", predicted="predicted") -> Column:
    """E1."""
    return F.avg(F.abs(_c(predicted) - _c(actual)))


def rmse(actual="actual", predicted="predicted") -> Column:
    """E2."""
    d = _c(predicted) - _c(actual)
    return F.sqrt(F.avg(d * d))


def mape_eps(actual="actual", predicted="predicted") -> Column:
    """Sklearn MAPE x 100 (denominator floored at machine epsilon)."""
    a = _c(actual).cast("double")
    return F.avg(F.abs(_c(predicted) - a) / F.greatest(F.abs(a), F.lit(EPS))) * 100


def mape_raw(actual="actual", predicted="predicted") -> Column:
    """Numpy MAPE x 100; NaN or inf as soon as one actual is 0."""
    return F.avg(ape_raw(actual, predicted)) * 100


def mape_nonzero(actual="actual", predicted="predicted") -> Column:
    """E4 (usable variant): MAPE x 100 over rows with a non-zero actual."""
    a = _c(actual).cast("double")
    return F.avg(F.when(a != 0, F.abs((_c(predicted) - a) / a))) * 100


def wape(actual="actual", predicted="predicted") -> Column:
    """E5: MAE / mean(actual) x 100, 0 when the mean actual is <= 0 (the batch
    pipeline's "MAPE")."""
    m = F.avg(_c(actual).cast("double"))
    return F.when(m > 0, mae(actual, predicted) / m * 100).otherwise(F.lit(0.0))
