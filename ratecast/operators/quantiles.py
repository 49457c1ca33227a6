"""Exact quantiles and k-th values from two scans, without a shuffle of the values.

The first scan makes a KLL sketch for each key (mergeable, some 25 KB whatever the number of rows). Its rank error brackets each target:
the values between the sketch's quantiles a little below and a little above hold the wanted one. The second scan counts the values
below each bracket and keeps those inside, pre-aggregated by value, so some three hundredths of the distinct values are shuffled. The wanted
ranks are then found among them by range partitions (``blocks``). Counts prove that a target lies in its bracket; for a key
whose sketch missed, all values are ranked, so a result is exact always.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecast.operators.blocks import _value_ranks, _values_at
from ratecast.operators.keyjoin import join_keys
from ratecast.operators.series import attach
from ratecast.session import materialize

SKETCH_K = 1024
#: twice the rank error that a sketch of this k keeps in 99 of 100 cases
SLACK = 0.009
GRID = 200               # ranks at which the sketch is read


def _targets(n, targets, kind):
    """Per target: (tag, first rank, last rank) columns; ``kind`` is 'p' (probabilities) or 'rank'."""
    for t in targets:
        if kind == "p":
            h = (n - 1) * F.lit(float(t))
            lo = F.floor(h).cast("bigint")
            yield t, h, lo, F.least(lo + 1, n - 1)
        else:
            r = F.least(F.lit(int(t)).cast("bigint"), n - 1)
            yield t, r.cast("double"), r, r


def _ranked(df: DataFrame, targets: Sequence, kind: str, keys: list[str], exact: str, partitions: int | None) -> DataFrame:
    """``keys.., _t`` (number of the target), ``_h, _r, _x``: the value at each wanted rank."""
    agg, get = ((F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint) if exact == "bigint"
                else (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double))
    sketch = df.groupBy(*keys).agg(agg("_v", F.lit(SKETCH_K)).alias("_s"), F.count(F.lit(1)).alias("_n")).where("_n > 0")
    n = F.col("_n")
    sketch = sketch.select(*keys, "_n", get("_s", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])).alias("_q"))

    def at(share, up):
        cell = F.ceil(share * GRID) if up else F.floor(share * GRID)
        return F.get("_q", F.least(F.greatest(cell, F.lit(0)), F.lit(GRID)).cast("int"))

    wanted = [F.struct(F.lit(i).alias("t"), h.alias("h"), lo.alias("r0"), hi.alias("r1"),
                       at(lo / n - SLACK, False).alias("a"), at((hi + 1) / n + SLACK, True).alias("b"))
              for i, (_, h, lo, hi) in enumerate(_targets(n, targets, kind))]
    brackets = materialize(sketch.select(*keys, "_n", F.array(*wanted).alias("_w")))         # a row for each key
    # below a bracket: counted (value null); inside: counted by value
    told = F.filter(F.transform("_w", lambda w: F.when(F.col("_v") <= w.b, F.struct(w.t.alias("t"), F.when(F.col("_v") >= w.a, F.col("_v")).alias("v")))),
                    lambda x: x.isNotNull())
    cells = materialize(attach(df, brackets.select(*keys, "_w"), keys).select(*keys, F.explode(told).alias("_c"))
                        .groupBy(*keys, F.col("_c.t").alias("_t"), F.col("_c.v").alias("_v")).agg(F.count(F.lit(1)).alias("_m")))
    held = cells.groupBy(*keys, "_t").agg(F.sum(F.when(F.col("_v").isNull(), F.col("_m")).otherwise(0)).alias("_below"), F.sum("_m").alias("_upto"))
    goal = brackets.select(*keys, F.explode("_w").alias("_g")).select(*keys, F.col("_g.t").alias("_t"), F.col("_g.h").alias("_h"),
                                                                     F.col("_g.r0").alias("_r0"), F.col("_g.r1").alias("_r1"))
    goal = join_keys(goal, held, keys, ["_t"], "left")
    missed = F.coalesce((F.col("_r0") < F.col("_below")) | (F.col("_r1") >= F.col("_upto")), F.lit(True))
    ranks = F.explode(F.array_distinct(F.array("_r0", "_r1")))
    inside = (goal.where(~missed).select(*keys, "_t", "_h", "_below", ranks.alias("_rank"))
              .withColumn("_r", F.col("_rank") - F.col("_below")).drop("_below"))
    rp, part = _value_ranks(cells, "_v", [*keys, "_t"], partitions, kind=None, weight="_m")
    found = _values_at(rp, part, inside, [*keys, "_t"]).select(*keys, "_t", "_h", F.col("_rank").alias("_r"), "_x")
    lost = goal.where(missed).select(*keys, "_t", "_h", ranks.alias("_r"))
    if lost.isEmpty():
        return found
    rest = join_keys(df, lost.select(*keys).distinct(), keys, how="left_semi") if keys else df
    rp, part = _value_ranks(rest, "_v", keys, partitions, kind=None)
    lost = lost.select(*keys, "_t", "_h", "_r", F.col("_r").alias("_rank"))
    return found.unionByName(_values_at(rp, part, lost, keys).select(*keys, "_t", "_h", F.col("_rank").alias("_r"), "_x"))


def _values(df: DataFrame, col: str, keys: list[str], kind: str | None) -> DataFrame:
    v = F.col(col).cast(kind) if kind else F.col(col)
    out = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    return out.where(~F.isnan("_v")) if isinstance(out.schema["_v"].dataType, (T.DoubleType, T.FloatType)) else out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], keys: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles (pandas / ``percentile`` / ``quantile_cont``), exact, for a column with any
    number of distinct values: ``keys.., p, value``. Null and NaN values are left out."""
    keys = list(keys)
    r = _ranked(_values(df, col, keys, "double"), probs, "p", keys, "double", partitions)
    a = r.groupBy(*keys, "_t").agg(F.first("_h").alias("_h"), F.min("_r").alias("_r0"), F.min_by("_x", "_r").alias("_x0"), F.max_by("_x", "_r").alias("_x1"))
    p = F.element_at(F.array(*[F.lit(float(q)) for q in probs]), F.col("_t") + 1)
    return a.select(*keys, p.alias("p"), (F.col("_x0") + (F.col("_h") - F.col("_r0")) * (F.col("_x1") - F.col("_x0"))).alias("value"))


def rank_values(df: DataFrame, col: str, ranks: Sequence[int], keys: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """``keys.., rank, value``: the value at each 0-based rank in ascending order (ranks past the end give the
    maximum), in the column's own type. Columns that are no numbers are ranked whole."""
    keys, kind = list(keys), df.schema[col].dataType
    rank = F.element_at(F.array(*[F.lit(int(r)).cast("bigint") for r in ranks]), F.col("_t") + 1).alias("rank")
    if isinstance(kind, T.IntegralType):
        r = _ranked(_values(df, col, keys, "bigint"), ranks, "rank", keys, "bigint", partitions)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        r = _ranked(_values(df, col, keys, "double"), ranks, "rank", keys, "double", partitions)
    else:
        rp, part = _value_ranks(df, col, keys, partitions, kind=None)
        goal = df.sparkSession.createDataFrame([(i, int(k)) for i, k in enumerate(ranks)], "_t int, _k bigint")
        goal = part.select(*keys, "_n").distinct().crossJoin(F.broadcast(goal)).select(*keys, "_t", F.least("_k", F.col("_n") - 1).alias("_r"))
        r = _values_at(rp, part, goal, keys)
    return r.select(*keys, rank, F.col("_x").cast(kind).alias("value"))
