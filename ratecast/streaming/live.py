"""Streams on Spark's own event-time aggregates: counts by bin (L1), runs that stop and resume (L4) and
the number of events that the watermark drops (L5). Forecasts (L2, L3) and the late rows themselves are in ``ledger``.

A bin comes out when the watermark passes its end; a finite feed ends with a mark row whose time passes the watermark over its last bin.
"""
from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_stream(spark: SparkSession, path: str, schema: T.StructType, ts: str = "ts",
                 max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Parquet files of a folder as a stream (``glob`` picks one table's files); the
    event time is cast to ``timestamp`` (watermarks need the session-zone type)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path)
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_resample(sdf: DataFrame, watermark: str, ts: str = "ts", freq: str = "1 minute",
                    keys: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """L1: per-bin counts of a live feed, emitted once the watermark closes the bin.
    Output ``keys.., ts (timestamp_ntz bin start), txn_count``.

    ``watermark`` says how late an event may come; there is no default, as everything later is
    dropped. With ``unique`` (an event id) events delivered twice count once; late events
    then reach the first stateful operator one by one, so its dropped rows are events (L5)."""
    src = sdf.withWatermark(ts, watermark)
    if unique:
        src = src.dropDuplicates([*unique, ts])
    g = src.groupBy(*keys, F.window(ts, freq).alias("w")) \
        .agg(F.count(F.lit(1)).alias("txn_count"))
    return g.select(*keys, F.col("w.start").cast("timestamp_ntz").alias("ts"), "txn_count")


def run_to_table(sdf: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> list[dict]:
    """L4: run a stream to completion of the available input (``availableNow``) into a
    table; re-running with the same checkpoint resumes where it stopped. Returns the
    progress reports of all micro-batches (for L5's dropped-row counts); Spark keeps the last 100
    only, so they are gathered while the stream runs.

    The number of state partitions is the session's ``spark.sql.shuffle.partitions`` when the checkpoint is
    first created, and stays so: set it for the size the stream will grow to.
    """
    q = (sdf.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    reports: dict[int, dict] = {}
    running = True
    while running:
        running = not q.awaitTermination(0.5)
        for p in q.recentProgress:
            reports[int(p.batchId)] = json.loads(p.json)
    return [reports[k] for k in sorted(reports)]


def dropped_by_watermark(progress: list[dict]) -> list[tuple[int, int, int]]:
    """``(batch_id, input rows, rows dropped by the watermark)`` per micro-batch."""
    out = []
    for p in progress:
        dropped = sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in p.get("stateOperators", []))
        out.append((int(p["batchId"]), int(p.get("numInputRows", 0)), dropped))
    return out
