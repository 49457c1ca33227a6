"""Live series with versioned tables (L1-L5), keyed or not: ``foreachBatch`` and a carry table.

Every micro-batch is one version of five tables below ``path``: ``bins`` (closed bins, zero-filled, with their one-step forecast and the
running errors), ``late`` (events that came after their bin was closed, whole rows), ``open`` (counts of bins still open), ``carry`` (of each
series: its first bin, the next bin to close, the last ``k`` values, number and exact sums of the errors) and ``meta`` (watermark), written last.
A version counts once its ``meta`` is there. A batch reads the version before it and overwrites its own folders, so
a batch that is run again, after a failure or in a replay, changes nothing, and every late row is written exactly once.

Inside a batch nothing is sequential: bins are generated in chunks, forecasts are windows over halo blocks that start with the carried
values, running sums are block carries on top of the carried sums. One series without keys is spread over all tasks.

The watermark is the latest event time less ``delay``; a bin closes when it ends at or before the watermark, whether it has events
or not. A row for which ``mark`` (a SQL condition) holds is no event: it says that the feed is complete up to its time, so the last bins of
a finite feed close, empty ones too. The step has to divide a day.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.functions import metrics as M
from ratecast.functions.timecols import DAY_US, as_ntz, freq_micros, from_micros, to_micros
from ratecast.operators.blocks import EXACT_SUM, running_sums
from ratecast.operators.forecast import forecast_moving_avg
from ratecast.operators.keyjoin import join_keys
from ratecast.operators.series import dense_grid
from ratecast.session import materialize

SUMS = ("n", "ae", "se", "ape")


@dataclass(frozen=True)
class Feed:
    path: str
    keys: tuple[str, ...] = ()
    ts: str = "ts"
    freq: str = "1 minute"
    delay: str = "0 seconds"
    k: int = 3
    mark: str | None = None

    @property
    def step(self) -> int:
        step = freq_micros(self.freq)
        if DAY_US % step:
            raise ValueError(f"{self.freq!r} does not divide a day")
        return step

    def delay_us(self) -> int:
        return 0 if self.delay.strip().startswith("0 ") else freq_micros(self.delay)


# ----------------------------------------------------------------------------------
# versions
# ----------------------------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose ``meta`` was written to its end, in order."""
    p, fs = _fs(spark, f"{path}/meta")
    if not fs.exists(p):
        return []
    found = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
        if name.startswith("v=") and fs.exists(done):
            found.append(int(name[2:]))
    return sorted(found)


def read_feed(spark: SparkSession, path: str, table: str = "bins") -> DataFrame:
    """All rows of ``bins`` or ``late`` up to the last complete version."""
    last = versions(spark, path)
    if not last:
        raise ValueError(f"no complete version below {path}")
    return spark.read.parquet(f"{path}/{table}").where(F.col("v") <= last[-1]).drop("v")


def _write(df: DataFrame, feed: Feed, table: str, version: int) -> None:
    df.write.mode("overwrite").parquet(f"{feed.path}/{table}/v={version}")


# ----------------------------------------------------------------------------------
# one micro-batch
# ----------------------------------------------------------------------------------
def advance(events: DataFrame, batch_id: int, feed: Feed) -> None:
    """Take one micro-batch of events into the tables; a batch that is there already is left alone."""
    spark, keys, step = events.sparkSession, list(feed.keys), feed.step
    done = versions(spark, feed.path)
    if batch_id in done:
        return
    before = max((v for v in done if v < batch_id), default=None)
    ev = events.withColumn("_us", to_micros(as_ntz(events, feed.ts))).where(F.col("_us").isNotNull())
    is_mark = F.coalesce(F.expr(feed.mark), F.lit(False)) if feed.mark else F.lit(False)
    ev = ev.withColumn("_mark", is_mark).withColumn("_bin", F.col("_us") - F.pmod("_us", F.lit(step))).persist()
    try:
        top = ev.agg(F.max(F.when(~F.col("_mark"), F.col("_us"))).alias("e"), F.max(F.when(F.col("_mark"), F.col("_us"))).alias("m")).first()
        old = spark.read.parquet(f"{feed.path}/meta/v={before}").first() if before is not None else None
        marks = [x for x in (old and old.watermark, top.e is not None and top.e - feed.delay_us(), top.m) if x not in (None, False)]
        watermark = max(marks) if marks else None
        closed = old.closed if old else None                              # bins before it have been returned
        limit = closed if watermark is None else max(watermark - watermark % step, closed if closed is not None else watermark - watermark % step)
        late = F.lit(False) if closed is None else F.col("_bin") < closed
        _write(ev.where(~F.col("_mark") & late).drop("_us", "_mark", "_bin"), feed, "late", batch_id)
        counts = ev.where(~F.col("_mark") & ~late).groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_c"))
        if before is not None:
            counts = counts.unionByName(spark.read.schema(counts.schema).parquet(f"{feed.path}/open/v={before}"))
        counts = materialize(counts.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_c")))
    finally:
        ev.unpersist()
    ready = counts.where(F.lit(False) if limit is None else F.col("_bin") < limit)
    _write(counts.where(F.lit(True) if limit is None else F.col("_bin") >= limit), feed, "open", batch_id)
    schema = ", ".join([*(f"`{c}` {events.schema[c].dataType.simpleString()}" for c in keys),
                        "first bigint, next bigint, recent array<double>, n bigint", *(f"{c} {EXACT_SUM}" for c in SUMS[1:])])
    if before is not None:
        carry = spark.read.schema(schema).parquet(f"{feed.path}/carry/v={before}")
    else:
        carry = spark.createDataFrame([], schema)
    starts = ready.groupBy(*keys).agg(F.min("_bin").alias("_start")).where(F.col("_start").isNotNull())
    series = materialize(_known_and_new(carry, starts, keys, schema))
    _write(_closed_bins(series, ready, limit, feed), feed, "bins", batch_id)
    written = spark.read.parquet(f"{feed.path}/bins/v={batch_id}")
    _write(_carried(series, written, limit, feed), feed, "carry", batch_id)
    meta = spark.createDataFrame([(batch_id, watermark, limit)], "batch bigint, watermark bigint, closed bigint")
    _write(meta.coalesce(1), feed, "meta", batch_id)


def _known_and_new(carry: DataFrame, starts: DataFrame, keys: Sequence[str], schema: str) -> DataFrame:
    """The carry rows of all series: those carried so far, and series whose first bin closes now."""
    new = join_keys(starts, carry.select(*keys), keys, how="left_anti") if keys else starts.join(carry, F.lit(True), "left_anti")
    zero = F.struct(*[F.lit(0).alias(k) for k in ("int", "frac", "nan", "pinf", "ninf")]).cast(EXACT_SUM)
    return carry.unionByName(new.select(*keys, F.col("_start").alias("first"), F.col("_start").alias("next"), F.array().cast("array<double>").alias("recent"),
                                        F.lit(0).cast("bigint").alias("n"), zero.alias("ae"), zero.alias("se"), zero.alias("ape")))


def _closed_bins(series: DataFrame, ready: DataFrame, limit: int | None, feed: Feed) -> DataFrame:
    keys, step = list(feed.keys), feed.step
    bounds = series.select(*keys, F.col("next").alias("_lo"), (F.lit(limit).cast("bigint") - step).alias("_hi")).where(F.col("_hi") >= F.col("_lo"))
    grid = dense_grid(bounds, step, keys).drop("idx")
    rows = join_keys(grid, ready, keys, ["_bin"], "left").select(*keys, "_bin", F.coalesce(F.col("_c"), F.lit(0)).cast("double").alias("actual"), F.lit(True).alias("_new"))
    # the carried last values stand before the first new bin
    past = (series.select(*keys, "next", F.posexplode("recent").alias("_j", "actual"), F.size("recent").alias("_r"))
            .select(*keys, (F.col("next") - (F.col("_r") - F.col("_j")) * step).alias("_bin"), "actual", F.lit(False).alias("_new")))
    state = series.select(*keys, "first", *[F.col(c).alias(f"_old_{c}") for c in SUMS])
    both = rows.unionByName(past)
    both = join_keys(both, state, keys) if keys else both.crossJoin(F.broadcast(state))          # without keys a row
    both = both.withColumn("idx", ((F.col("_bin") - F.col("first")) / step).cast("bigint"))
    told = forecast_moving_avg(both, "actual", feed.k, keys).where("_new")
    told = told.withColumn("_ae", M.abs_error("actual", "predicted")).withColumn("_se", F.col("_ae") * F.col("_ae")) \
        .withColumn("_ape", M.ape_raw("actual", "predicted"))
    r = running_sums(told, ["_ae", "_se", "_ape"], keys, start={f"_{c}": f"_old_{c}" for c in SUMS[1:]})
    r = r.withColumn("sum_n", F.col("_old_n") + F.col("cum_n")).withColumns({f"sum_{c}": F.col(f"cum__{c}_exact") for c in SUMS[1:]})
    some = F.col("sum_n") > 1
    return r.select(*keys, from_micros(F.col("_bin")).alias("ts"), "idx", "actual", "predicted", F.col("_ae").alias("error"),
                    F.when(some, F.col("cum__ae") / F.col("sum_n")).alias("running_mae"),
                    F.when(some, F.sqrt(F.col("cum__se") / F.col("sum_n"))).alias("running_rmse"),
                    F.when(some, F.col("cum__ape") / F.col("sum_n") * 100).alias("running_mape"), *[f"sum_{c}" for c in SUMS])


def _carried(series: DataFrame, bins: DataFrame, limit: int | None, feed: Feed) -> DataFrame:
    """The carry after the batch: sums of a series' last new bin, its last ``k`` values, the next bin to close."""
    keys, k = list(feed.keys), feed.k
    last = bins.groupBy(*keys).agg(F.max_by(F.struct(*[f"sum_{c}" for c in SUMS]), "idx").alias("_s"), F.max("idx").alias("_last"))
    near = join_keys(bins, last.select(*keys, "_last"), keys) if keys else bins.crossJoin(F.broadcast(last.select("_last")))
    ends = near.where(F.col("idx") > F.col("_last") - k).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("idx", "actual"))).alias("_ends"))               # k values a series at most
    out = series
    for t in (last.drop("_last"), ends):
        out = join_keys(out, t, keys, how="left") if keys else out.join(F.broadcast(t), F.lit(True), "left")
    moved = F.col("_s").isNotNull() & F.col("_s.sum_n").isNotNull()
    recent = F.concat("recent", F.col("_ends.actual"))
    return out.select(*keys, "first", F.when(moved, F.greatest("next", F.lit(limit).cast("bigint"))).otherwise(F.col("next")).alias("next"),
                      F.when(moved, F.slice(recent, F.greatest(F.size(recent) - k, F.lit(0)) + 1, k)).otherwise(F.col("recent")).alias("recent"),
                      *[F.when(moved, F.col(f"_s.sum_{c}")).otherwise(F.col(c)).alias(c) for c in SUMS])


# ----------------------------------------------------------------------------------
# the stream
# ----------------------------------------------------------------------------------
def run_feed(events: DataFrame, feed: Feed, checkpoint: str) -> None:
    """Run the stream over the available input and stop; with the same checkpoint and path the next run goes on (L4)."""
    feed.step  # noqa: B018 - a wrong step is refused before the stream starts
    q = (events.writeStream.foreachBatch(lambda df, batch_id: advance(df, batch_id, feed))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
