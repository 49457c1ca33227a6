"""Joins on series keys in which NULL equals NULL, as in a group-by."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], on: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` (null-safe) and ``on`` (never null); left's key columns stay. Spark
    hashes both sides on the keys, as for a plain equality."""
    keys, on = list(keys), list(on)
    if not keys:
        return left.join(right, on, how)
    both = keys + on
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in both], *[c for c in right.columns if c not in both])
    cond = None
    for c in both:
        e = left[c].eqNullSafe(r[f"_r_{c}"]) if c in keys else left[c] == r[f"_r_{c}"]
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in both])
