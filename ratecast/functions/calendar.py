"""Calendar and math scalars. All JVM-side, codegen'd expressions."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English day names, Monday first, and the weekend day numbers (Monday=0).
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
WEEKEND_DAYS = (5, 6)


def hour(ts: str = "ts") -> Column:
    """Hour of day."""
    return F.hour(ts)


def day_of_week(ts: str = "ts") -> Column:
    """Day of week, Monday=0 (``weekday``; not ``dayofweek``, which is Sunday=1)."""
    return F.weekday(ts)


def is_weekend(ts: str = "ts", as_bool: bool = False) -> Column:
    """Saturday/Sunday flag, 0/1 int (batch pipeline) or boolean (profile)."""
    c = F.weekday(ts) > 4
    return c if as_bool else c.cast("int")


def day_name(ts: str = "ts") -> Column:
    """C4: English day name."""
    return F.date_format(ts, "EEEE")


def calendar_date(ts: str = "ts") -> Column:
    """Calendar date."""
    return F.to_date(ts)


def hour_sin(ts: str = "ts") -> Column:
    """sin(2*pi*hour/24)."""
    return F.sin(F.lit(2 * math.pi) * F.hour(ts) / F.lit(24.0))


def hour_cos(ts: str = "ts") -> Column:
    """cos(2*pi*hour/24)."""
    return F.cos(F.lit(2 * math.pi) * F.hour(ts) / F.lit(24.0))


def round2(c: Column | str) -> Column:
    """2-place rounding, half to even (as numpy)."""
    return F.bround(c, 2)


def lag_label(lag: Column | str) -> Column:
    """A lag in minutes as "n min", "n hr" (>= 60) or "n day" (>= 1440)."""
    l = F.col(lag) if isinstance(lag, str) else lag
    return (F.when(l >= 1440, F.concat(F.floor(l / 1440).cast("string"), F.lit(" day")))
            .when(l >= 60, F.concat(F.floor(l / 60).cast("string"), F.lit(" hr")))
            .otherwise(F.concat(l.cast("string"), F.lit(" min"))))


FEATURES = {
    "hour": lambda ts: hour(ts),
    "day_of_week": lambda ts: day_of_week(ts),
    "is_weekend": lambda ts: is_weekend(ts),
    "is_weekend_bool": lambda ts: is_weekend(ts, as_bool=True),
    "day_name": lambda ts: day_name(ts),
    "date": lambda ts: calendar_date(ts),
    "hour_sin": lambda ts: hour_sin(ts),
    "hour_cos": lambda ts: hour_cos(ts),
}


def add_time_features(df: DataFrame, which: Sequence[str] = ("hour", "day_of_week", "is_weekend"),
                      ts: str = "ts") -> DataFrame:
    """Narrow projection adding the named calendar columns (``is_weekend_bool`` is
    written as ``is_weekend`` with boolean type)."""
    cols = [F.col(c) for c in df.columns]
    for w in which:
        name = "is_weekend" if w == "is_weekend_bool" else w
        cols.append(FEATURES[w](ts).alias(name))
    return df.select(*cols)
