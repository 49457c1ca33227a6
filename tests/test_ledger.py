"""Live series in versioned tables: equal to batch, repeatable, late rows kept once."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import forecast as FC
from ratecast.operators import windows as WI
from ratecast.operators.series import resample_count
from ratecast.streaming import ledger as LG
from ratecast.streaming.live import event_stream

SCHEMA = "event_id bigint, ts timestamp_ntz, kind string"
MARK = "kind = 'end of feed'"


def log(n=400, seed=0, span=7200):
    rng = np.random.default_rng(seed)
    us = np.sort(rng.integers(0, span * 1_000_000, n))
    us[n // 3:n // 2] = us[n // 3]                                    # a busy instant and empty minutes
    return [(i, int(u), "ab"[int(rng.random() < 0.2)]) for i, u in enumerate(us)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "event_id bigint, us bigint, kind string").select(
        "event_id", F.timestamp_add("MICROSECOND", F.col("us"), F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'")).alias("ts"), "kind")


def batch_rows(df, keys=()):
    s = resample_count(df, keys=list(keys))
    f = FC.forecast_moving_avg(s.withColumn("actual", F.col("txn_count").cast("double")), "actual", keys=list(keys))
    return WI.running_metrics(f, keys=list(keys)).orderBy(*keys, "idx").toPandas()


def same(live, batch):
    assert len(live) == len(batch) and (live["ts"].to_numpy() == batch["ts"].to_numpy()).all()
    for c in ("actual", "predicted", "running_mae", "running_rmse", "running_mape"):
        np.testing.assert_allclose(live[c].to_numpy(float), batch[c].to_numpy(float), rtol=1e-12, err_msg=c)


def mark_row(rows, seconds=60):
    return [(None, (rows[-1][1] // 60_000_000) * 60_000_000 + seconds * 1_000_000, "end of feed")]


@pytest.mark.parametrize("cuts", [[], [1], [100, 101, 350], [133, 200]])
def test_any_batches_equal_the_whole(spark, tmp_path, cuts):
    rows, feed = log(), LG.Feed(str(tmp_path / "feed"), mark=MARK)
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    for i, part in enumerate(parts):
        LG.advance(frame(spark, part), i, feed)
    got = LG.read_feed(spark, feed.path).orderBy("idx").toPandas()
    want = batch_rows(frame(spark, rows))
    assert len(got) == len(want) - 1                                  # the last minute is open
    LG.advance(frame(spark, mark_row(rows)), len(parts), feed)
    same(LG.read_feed(spark, feed.path).orderBy("idx").toPandas(), want)
    assert LG.read_feed(spark, feed.path, "late").count() == 0


def test_a_batch_again_changes_nothing(spark, tmp_path, monkeypatch):
    rows, feed = log(), LG.Feed(str(tmp_path / "feed"), mark=MARK)
    LG.advance(frame(spark, rows[:150]), 0, feed)
    LG.advance(frame(spark, rows[150:]), 1, feed)
    once = repr(LG.read_feed(spark, feed.path).orderBy("idx").collect())
    count = LG.read_feed(spark, feed.path).count()
    LG.advance(frame(spark, rows[150:]), 1, feed)
    assert repr(LG.read_feed(spark, feed.path).orderBy("idx").collect()) == once
    # a batch that fails before its end leaves no trace, and counts once when it is run again
    real = LG._write

    def failing(df, feed, table, version):
        if table == "meta":
            raise RuntimeError("lost")
        real(df, feed, table, version)
    late = [(900, rows[10][1], "a")]
    monkeypatch.setattr(LG, "_write", failing)
    with pytest.raises(RuntimeError):
        LG.advance(frame(spark, late + mark_row(rows)), 2, feed)
    monkeypatch.setattr(LG, "_write", real)
    assert LG.read_feed(spark, feed.path).count() == count and LG.read_feed(spark, feed.path, "late").count() == 0
    LG.advance(frame(spark, late + mark_row(rows)), 2, feed)
    same(LG.read_feed(spark, feed.path).orderBy("idx").toPandas(), batch_rows(frame(spark, rows)))
    assert [r.event_id for r in LG.read_feed(spark, feed.path, "late").collect()] == [900]


def test_delay_keeps_what_comes_in_time(spark, tmp_path):
    rows = log()
    feed = LG.Feed(str(tmp_path / "feed"), delay="10 minutes", mark=MARK)
    held = [r for r in rows[150:200] if r[1] > rows[199][1] - 500_000_000][:20]       # less than ten minutes late
    first = [r for r in rows[:200] if r not in held]
    LG.advance(frame(spark, first), 0, feed)
    LG.advance(frame(spark, held + rows[200:]), 1, feed)
    LG.advance(frame(spark, mark_row(rows)), 2, feed)
    assert LG.read_feed(spark, feed.path, "late").count() == 0
    same(LG.read_feed(spark, feed.path).orderBy("idx").toPandas(), batch_rows(frame(spark, rows)))


def test_keys_close_together(spark, tmp_path):
    rows, feed = log(), LG.Feed(str(tmp_path / "feed"), keys=("kind",), mark=MARK)
    rows = [(i, u, None if k == "b" else k) for i, u, k in rows]                      # null is a key too
    for i, part in enumerate((rows[:90], rows[90:300], rows[300:], mark_row(rows))):
        LG.advance(frame(spark, part), i, feed)
    got = LG.read_feed(spark, feed.path).orderBy("kind", "idx").toPandas()
    end = got["ts"].max()
    for k, mine in got.groupby("kind", dropna=False):
        k = None if k != k else k
        one = frame(spark, [r for r in rows if r[2] == k])
        want = batch_rows(one)
        same(mine.iloc[:len(want)], want)                              # then zeros up to the end of the feed
        assert mine["ts"].iloc[-1] == end and (mine["actual"].iloc[len(want):] == 0).all()


def test_late_rows_over_a_restart(spark, tmp_path):
    rows, src = log(), str(tmp_path / "src")
    feed = LG.Feed(str(tmp_path / "feed"), mark=MARK)
    schema = frame(spark, rows[:1]).schema
    frame(spark, rows[200:]).write.mode("append").parquet(src)
    LG.run_feed(event_stream(spark, src, schema), feed, str(tmp_path / "ck"))
    frame(spark, rows[:200]).write.mode("append").parquet(src)
    LG.run_feed(event_stream(spark, src, schema), feed, str(tmp_path / "ck"))
    late = sorted(r.event_id for r in LG.read_feed(spark, feed.path, "late").collect())
    last = rows[-1][1] // 60_000_000
    assert late == [r[0] for r in rows[:200] if r[1] // 60_000_000 < last] and len(late) == 200
    LG.run_feed(event_stream(spark, src, schema), feed, str(tmp_path / "ck"))          # nothing new
    assert LG.read_feed(spark, feed.path, "late").count() == 200


def test_empty_batches_and_wrong_step(spark, tmp_path):
    feed = LG.Feed(str(tmp_path / "feed"))
    LG.advance(frame(spark, log(3)).limit(0), 0, feed)
    assert LG.read_feed(spark, feed.path).count() == 0
    LG.advance(frame(spark, log(50)), 1, feed)
    n = LG.read_feed(spark, feed.path).count()
    LG.advance(frame(spark, log(3)).limit(0), 2, feed)
    assert LG.read_feed(spark, feed.path).count() == n > 0
    with pytest.raises(ValueError, match="divide"):
        LG.advance(frame(spark, log(3)), 3, LG.Feed(str(tmp_path / "feed"), freq="7 minutes"))
