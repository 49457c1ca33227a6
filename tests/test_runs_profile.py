"""Run log written once, timed boards, distinct counts and daily profiles, lagged products."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import evaluate as EV
from ratecast.operators import profile as PF
from ratecast.operators import stats as ST
from ratecast.sources import io as IO


def board(spark, maes=(1.0, 2.0)):
    return spark.createDataFrame([("a", 10, maes[0], 0.5), ("b", None, maes[1], 0.25)], "model string, lookback int, mae double, seconds double")


def inputs(spark, n=5):
    return IO.input_key(spark.range(n).select(F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts")))


def records(spark, n=5, maes=(1.0, 2.0)):
    return IO.run_records(board(spark, maes), inputs(spark, n), "exp", "/data", ["model", "lookback"], ["mae"])


def test_run_log_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = IO.append_runs(records(spark), path)
    assert IO.append_runs(records(spark, maes=(9.0, 9.0)), path) == one                   # a rerun: same ids, nothing added
    rows = IO.read_runs(spark, path).collect()
    assert len(rows) == 3 and len({r.run_id for r in rows}) == 3
    top = [r for r in rows if r.parent_run_id is None]
    assert [r.run_id for r in top] == [one] and top[0].seconds == 0.75 and top[0].metrics == {"runs": 2.0}
    assert {r.parent_run_id for r in rows if r.parent_run_id} == {one}
    assert {r.metrics["mae"] for r in rows if r.parent_run_id} == {1.0, 2.0}
    two = IO.append_runs(records(spark, n=6), path)                                       # other data, another parent
    assert two != one and IO.read_runs(spark, path).count() == 6
    assert not list((tmp_path / "runs" / "_staging").iterdir())
    with pytest.raises(ValueError, match="one parent"):
        IO.append_runs(records(spark).unionByName(records(spark, n=7)), path)


def test_timed_board_keeps_a_failed_model(spark):
    ok = spark.createDataFrame([("m", 1.0, 2.0), ("m", 3.0, 3.0)], "model string, actual double, predicted double")

    def broken():
        raise RuntimeError("no data")
    rows = EV.timed_leaderboard([("x", broken), ("m", lambda: ok)]).orderBy("run_order").collect()
    assert rows[0].error == "no data" and rows[0].mae is None and rows[0].model == "x"
    assert rows[1].model == "m" and rows[1].mae == 0.5 and rows[1].n == 2 and rows[1].seconds > 0


def test_distinct_counts(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, None, None), (None, "a", None)], "x int, y string, z double")
    assert {r[0]: r[1] for r in PF.distinct_counts(df).collect()} == {"x": 2, "y": 2, "z": 0}
    assert "Expand" not in PF.distinct_counts(df)._jdf.queryExecution().optimizedPlan().toString()


def test_united_days_equal_one_pass(spark, events):
    cols = ["user_id", "value"]
    whole = PF.unite_profile(PF.daily_profile(events, cols)).orderBy("column_name").toPandas()
    parts = [PF.daily_profile(events.where(F.dayofyear("ts") % 3 == k), cols) for k in range(3)]
    united = PF.unite_profile(parts[0].unionByName(parts[1]).unionByName(parts[2])).orderBy("column_name").toPandas()
    exact = events.select(*[F.col(c).cast("double") for c in cols]).toPandas()
    for c, w, u in zip(cols, whole.itertuples(), united.itertuples()):
        assert (w.n_rows, w.min, w.max) == (u.n_rows, u.min, u.max)
        for r in (w, u):
            assert r.mean == pytest.approx(exact[c].mean(), rel=1e-12) and r.std == pytest.approx(exact[c].std(), rel=1e-10)
            assert r.null_count == exact[c].isna().sum() and abs(r.approx_distinct - exact[c].nunique()) <= 0.05 * exact[c].nunique()


@pytest.mark.parametrize("n,h0,kmax", [(5000, 1500, 1440), (300, 0, 1440), (3000, 0, 700), (100, 40, 99), (2000, 1999, 64)])
def test_lagged_products(n, h0, kmax):
    x = np.random.default_rng(n).normal(size=n) + 3
    got = ST.lagged_products(x, h0, list(range(kmax + 1)))
    want = [sum(x[i] * x[i - k] for i in range(max(h0, k), n)) for k in range(kmax + 1)]
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-7)
    np.testing.assert_allclose(ST.lagged_products(x, h0, [0, 5, kmax]), [want[0], want[5], want[kmax]], rtol=1e-12)
