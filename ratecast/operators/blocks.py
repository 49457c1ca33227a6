"""Partitioning building blocks that keep ordered computations parallel.

Three patterns, used by every ordered operator in the library:

* **Halo blocks** (bounded frames on a dense series): rows are grouped into blocks of
  ``B`` consecutive ``idx`` values; the last ``halo`` rows of each block are also copied
  into the next block, so a frame that looks back at most ``halo`` rows is complete inside
  one ``Window.partitionBy(keys, _blk)``. Each block is exactly ``B (+halo)`` rows: no skew,
  whatever the series length.
* **Block carry** (unbounded running state on a dense series): per-block totals, an
  exclusive prefix over the small block table, joined back to the in-block running value.
* **Range scan** (ordering of the raw, possibly skewed log): ``repartitionByRange`` on
  the full, unique ordering key splits even a hot key or a hot instant over many tasks.
  Position and previous value are computed inside each range partition (Arrow batches),
  and the first row of every partition takes its carry from a table of at most
  ``partitions + keys`` rows.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecast.operators.keyjoin import join_keys
from ratecast.session import materialize, shuffle_partitions

MIN_BLOCK = 4096
LARGEST = 1e30


def block_size(halo: int, block: int | None = None) -> int:
    b = block or max(8 * halo, MIN_BLOCK)
    if halo > b:
        raise ValueError(f"halo {halo} larger than block {b}")
    return b


# ----------------------------------------------------------------------------------
# halo blocks
# ----------------------------------------------------------------------------------
def with_halo(df: DataFrame, halo: int, block: int | None = None, idx: str = "idx") -> DataFrame:
    """Add ``_blk`` (the block a copy belongs to) and ``_own`` (the row's own block).

    A row whose position in its block is ``>= B - halo`` is emitted twice: once for its
    own block and once as look-back context for the next one.
    """
    b = block_size(halo, block)
    own = F.floor(F.col(idx) / F.lit(b)).cast("long")
    pos = F.col(idx) - own * F.lit(b)
    copies = F.when((F.lit(halo) > 0) & (pos >= F.lit(b - halo)), F.array(own, own + 1)) \
        .otherwise(F.array(own))
    return df.withColumn("_own", own).withColumn("_blk", F.explode(copies))


def halo_window(keys: Sequence[str] = (), idx: str = "idx"):
    """Ordered window inside a halo block."""
    return Window.partitionBy(*keys, "_blk").orderBy(idx)


def drop_halo(df: DataFrame) -> DataFrame:
    """Keep each row once, in its own block."""
    return df.where(F.col("_blk") == F.col("_own")).drop("_blk", "_own")


def bounded_window(df: DataFrame, cols: dict[str, callable], halo: int,
                   keys: Sequence[str] = (), idx: str = "idx",
                   block: int | None = None) -> DataFrame:
    """Add columns computed by ``fn(window_spec) -> Column`` over a look-back of at most
    ``halo`` rows, evaluated block-parallel."""
    h = with_halo(df, halo, block, idx)
    w = halo_window(keys, idx)
    for name, fn in cols.items():
        h = h.withColumn(name, fn(w))
    return drop_halo(h)


# ----------------------------------------------------------------------------------
# block carry: running (unbounded preceding) sums on a dense series
# ----------------------------------------------------------------------------------
#: an exact sum in fixed size: whole and fractional parts of finite values, and how many values were NaN, +inf, -inf
EXACT_SUM = "struct<int:decimal(38,0),frac:decimal(38,18),nan:bigint,pinf:bigint,ninf:bigint>"


def running_sums(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
                 idx: str = "idx", block: int | None = None, prefix: str = "cum_", start: dict[str, str] | None = None) -> DataFrame:
    """Inclusive running sum of each column (and ``cum_n``, the running row count),
    ordered by ``idx`` within ``keys``; equal to ``sum() OVER (ORDER BY idx ROWS
    UNBOUNDED PRECEDING)`` but never one task for the whole series.

    Finite values are summed as exact decimals, whole parts and fractions apart, so the block
    order of the additions cannot change the result and squares of large errors fit; NaN,
    +inf and -inf (and what is beyond 1e30) are counted apart and restored with IEEE rules (any NaN, or both
    infinities -> NaN; else the infinity).

    ``start`` names for each column the column of an ``EXACT_SUM`` that its sums go on from (the end of an earlier batch); the
    sums so far are then returned as ``<prefix><col>_exact`` too.
    """
    b = block or MIN_BLOCK
    keys = list(keys)
    d = df.withColumn("_blk", F.floor(F.col(idx) / F.lit(b)).cast("long"))
    parts = {}
    for c in cols:
        x = F.col(c).cast("double")
        bad = F.isnan(x) | (F.abs(x) >= F.lit(LARGEST))
        x_int = F.when(bad, F.lit(0.0)).otherwise(x).cast("decimal(38,0)").cast("double")
        parts[c] = {
            "int": F.when(x.isNull() | bad, F.lit(0.0)).otherwise(x).cast("decimal(38,0)"),
            "frac": F.when(x.isNull() | bad, F.lit(0.0)).otherwise(x - x_int).cast("decimal(19,18)"),
            "nan": F.isnan(x).cast("long"),
            "pinf": ((x >= F.lit(LARGEST)) & ~F.isnan(x)).cast("long"),
            "ninf": (x <= F.lit(-LARGEST)).cast("long"),
        }
    d = d.select("*", *[e.alias(f"_{k}_{c}") for c, ps in parts.items() for k, e in ps.items()])
    comps = [f"_{k}_{c}" for c, ps in parts.items() for k in ps]
    per_blk = d.groupBy(*keys, "_blk").agg(
        F.count(F.lit(1)).alias("_bn"), *[F.sum(v).alias(f"_b{v}") for v in comps])
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_blk.select(
        *keys, "_blk", F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_cn"),
        *[F.coalesce(F.sum(f"_b{v}").over(before), F.lit(0)).alias(f"_c{v}") for v in comps])
    inblk = Window.partitionBy(*keys, "_blk").orderBy(idx) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.select("*", F.count(F.lit(1)).over(inblk).alias("_rn"),
                 *[F.sum(v).over(inblk).alias(f"_r{v}") for v in comps])
    # the block table is (#keys x n/B) rows; AQE broadcasts it when it is small and
    # falls back to a shuffle join otherwise
    out = join_keys(d, carry, keys, ["_blk"])
    out = out.withColumn(f"{prefix}n", F.col("_rn") + F.col("_cn"))
    for c in cols:
        tot = {k: F.col(f"_r_{k}_{c}") + F.col(f"_c_{k}_{c}") for k in ("int", "frac", "nan", "pinf", "ninf")}
        if start:
            tot = {k: v + F.col(f"{start[c]}.{k}") for k, v in tot.items()}
            out = out.withColumn(f"{prefix}{c}_exact", F.struct(*[v.alias(k) for k, v in tot.items()]).cast(EXACT_SUM))
        val = (F.when((tot["nan"] > 0) | ((tot["pinf"] > 0) & (tot["ninf"] > 0)), F.lit(float("nan")))
               .when(tot["pinf"] > 0, F.lit(float("inf")))
               .when(tot["ninf"] > 0, F.lit(float("-inf")))
               .otherwise(tot["int"].cast("double") + tot["frac"].cast("double")))
        out = out.withColumn(f"{prefix}{c}", val)
    drop = ["_blk", "_rn", "_cn"] + comps + [f"_r{v}" for v in comps] + [f"_c{v}" for v in comps]
    return out.drop(*drop)


# ----------------------------------------------------------------------------------
# range scan: previous row and global position on the raw log
# ----------------------------------------------------------------------------------
def _local_scan_fn(keys: list[str], carry: list[str]):
    """Per range partition (rows sorted by keys+order): position within (partition, key)
    and the previous row's carry columns; state crosses Arrow batches, not partitions."""

    def fn(batches):
        last_key, last_vals, run = None, None, 0
        for pdf in batches:
            if pdf.empty:
                continue
            m = len(pdf)
            if keys:
                kdf = pdf[keys]
                new = kdf.ne(kdf.shift()).any(axis=1).to_numpy().copy()
                first_key = tuple(kdf.iloc[0])
                new[0] = not (last_key is not None and first_key == last_key)
            else:
                new = np.zeros(m, dtype=bool)
                new[0] = last_key is None
            grp = np.cumsum(new)
            pos = pdf.groupby(grp, sort=False).cumcount().to_numpy().astype("int64")
            if not new[0]:
                first_grp = grp == grp[0]
                pos[first_grp] += run
            pdf["_lpos"] = pos
            for c in carry:
                col = pdf[c]
                if pd.api.types.is_integer_dtype(col.dtype):
                    col = col.astype("Int64")
                prev = col.shift(1)
                prev[new] = None
                if not new[0]:
                    prev.iloc[0] = last_vals[c]
                pdf[f"_lprev_{c}"] = prev
            last_key = tuple(pdf[keys].iloc[-1]) if keys else ()
            last_vals = {c: pdf[c].iloc[-1] for c in carry}
            run = int(pos[-1]) + 1
            yield pdf

    return fn


def range_scan(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (),
               carry: Sequence[str] = (), with_position: bool = False,
               partitions: int | None = None) -> DataFrame:
    """For every row: ``prev_<c>`` = column ``c`` of the previous row in
    ``(keys, order)`` order (null for the first row of a key) and, optionally,
    ``pos`` = 0-based position within the key.

    ``order`` must make rows unique (add an id column to break ties); this is what lets
    range partitioning split a hot key or a hot instant across tasks.
    """
    keys, order, carry = list(keys), list(order), list(carry)
    spark = df.sparkSession
    p = partitions or shuffle_partitions(spark)
    by = [F.col(c).asc_nulls_first() for c in keys] + [F.col(c).asc_nulls_last() for c in order]
    rp = df.repartitionByRange(p, *by)
    schema = T.StructType(list(df.schema.fields) + [T.StructField("_lpos", T.LongType())] + [
        T.StructField(f"_lprev_{c}", df.schema[c].dataType) for c in carry])
    local = (rp.sortWithinPartitions(*by)
             .mapInPandas(_local_scan_fn(keys, carry), schema)
             .withColumn("_pid", F.spark_partition_id()))
    # range bounds are sampled per execution: compute the partitioned scan once
    local = materialize(local)
    # per (range partition, key): row count and last carry values -- at most p + #keys rows
    summ = (local.groupBy("_pid", *keys)
            .agg(F.count(F.lit(1)).alias("_cnt"),
                 F.max(F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c))], *[F.col(c).alias(f"_c_{c}") for c in carry])).alias("_last")))
    prev_parts = Window.partitionBy(*keys).orderBy("_pid")
    carry_tbl = summ.select(
        "_pid", *keys,
        F.coalesce(F.sum("_cnt").over(prev_parts.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        *[F.lag(F.col(f"_last._c_{c}")).over(prev_parts).alias(f"_carry_{c}") for c in carry])
    if not keys:
        # at most p rows: a proven bound, so broadcast
        joined = local.join(F.broadcast(carry_tbl), ["_pid"])
    elif with_position:
        joined = join_keys(local, carry_tbl, keys, ["_pid"])
    else:
        # only the first row of each (partition, key) needs the carry: join that small
        # part and leave the rest of the log where it is
        first = join_keys(local.where(F.col("_lpos") == 0), carry_tbl, keys, ["_pid"])
        rest = local.where(F.col("_lpos") != 0)
        for c in carry:
            rest = rest.withColumn(f"_carry_{c}", F.lit(None).cast(df.schema[c].dataType))
        rest = rest.withColumn("_off", F.lit(0).cast("long"))
        joined = first.unionByName(rest)
    out = joined
    for c in carry:
        out = out.withColumn(f"prev_{c}", F.when(F.col("_lpos") == 0, F.col(f"_carry_{c}"))
                             .otherwise(F.col(f"_lprev_{c}")))
    if with_position:
        out = out.withColumn("pos", F.col("_lpos") + F.col("_off"))
    drop = ["_pid", "_lpos", "_off"] + [f"_lprev_{c}" for c in carry] + [f"_carry_{c}" for c in carry]
    return out.drop(*drop)


# ----------------------------------------------------------------------------------
# exact quantiles / k-th values without a single-task merge of all distinct values
# ----------------------------------------------------------------------------------
def _value_ranks(df: DataFrame, col: str, keys: list[str], partitions: int | None, kind: str | None = "double",
                 weight: str | None = None):
    """Value counts range-partitioned by value, and the per-partition rank offsets. ``kind`` None
    keeps the column's own type (a large id does not fit a double); ``weight`` is a column of counts."""
    spark = df.sparkSession
    p_n = partitions or shuffle_partitions(spark)
    vc = (df.where(F.col(col).isNotNull())
          .groupBy(*keys, (F.col(col).cast(kind) if kind else F.col(col)).alias("_v")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_w")))
    rp = materialize(vc.repartitionByRange(p_n, *keys, "_v").withColumn("_pid", F.spark_partition_id()))
    part = rp.groupBy(*keys, "_pid").agg(F.sum("_w").alias("_pw"))
    wk = Window.partitionBy(*keys).orderBy("_pid")
    part = part.select(*keys, "_pid", "_pw",
                       F.coalesce(F.sum("_pw").over(wk.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias("_poff"),
                       F.sum("_pw").over(Window.partitionBy(*keys)).alias("_n"))
    return rp, part


def _values_at(rp: DataFrame, part: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """``ranks`` (keys.., tags.., _r) -> same rows with ``_x``, the value at rank _r.
    Only the range partitions holding a target rank are sorted."""
    # both sides are tiny (target ranks x range partitions)
    hit = (join_keys(ranks, part, keys) if keys else ranks.crossJoin(F.broadcast(part))).where(
        (F.col("_r") >= F.col("_poff")) & (F.col("_r") < F.col("_poff") + F.col("_pw")))
    pids = hit.select(*keys, "_pid").distinct()
    sel = join_keys(rp, F.broadcast(pids) if not keys else pids, keys, ["_pid"])
    wv = Window.partitionBy(*keys, "_pid").orderBy("_v")
    sel = sel.withColumn("_cum", F.sum("_w").over(wv.rowsBetween(Window.unboundedPreceding, 0)))
    tags = [c for c in ranks.columns if c not in keys]
    loc = join_keys(sel, hit.select(*keys, "_pid", "_poff", *tags), keys, ["_pid"]) \
        .where((F.col("_r") >= F.col("_poff") + F.col("_cum") - F.col("_w"))
               & (F.col("_r") < F.col("_poff") + F.col("_cum")))
    return loc.select(*keys, *tags, F.col("_v").alias("_x"))
