"""Registered queries: one per operator of the inventory (IDs in each docstring), each
``(spark, sf_dir) -> DataFrame`` over the whole given tables, with a DuckDB oracle where
the operator is SQL-expressible."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.operators import evaluate as EV
from ratecast.operators import forecast as FC
from ratecast.operators import normality as NO
from ratecast.operators import prep as PR
from ratecast.operators import series as SE
from ratecast.operators import windows as WI
from ratecast.plans import replay as RP
from ratecast.plans import sqlgen as Q
from ratecast.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, d):
    return table(spark, d, "events")


def minute_series(spark, d):
    """The per-minute series, computed once from the log and checkpointed: every query
    that reads it several times works on the bins, never re-scans the log."""
    return materialize(SE.resample_count(events(spark, d)))


def hour_series(spark, d):
    return materialize(SE.resample_count(events(spark, d), freq="1 hour"))


# ---------------------------------------------------------------- flagship / 2.D
@query("replay_metrics", Q.replay_cte() + """
SELECT model, count(*) AS n_predictions, avg(actual) AS avg_actual,
       avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
       """ + Q.MAPE_RAW + """ AS mape, """ + Q.MAPE_NZ + """ AS mape_nonzero, """ + Q.WAPE + """ AS wape,
       100 - """ + Q.MAPE_RAW + """ AS accuracy_pct
FROM pr GROUP BY model""")
def q_replay_metrics(spark, d):
    """S1 -> T1 -> M1 -> O1 -> O6 -> E6 at minute grain."""
    return RP.replay_metrics(events(spark, d))


@query("replay_metrics_hourly", Q.replay_cte(Q.HOUR) + """
SELECT model, count(*) AS n_predictions, avg(actual) AS avg_actual,
       avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
       """ + Q.MAPE_RAW + """ AS mape, """ + Q.MAPE_NZ + """ AS mape_nonzero, """ + Q.WAPE + """ AS wape,
       100 - """ + Q.MAPE_RAW + """ AS accuracy_pct
FROM pr GROUP BY model""")
def q_replay_metrics_hourly(spark, d):
    """The same replay at hour grain (no zero bins, so MAPE is finite)."""
    return RP.replay_metrics(events(spark, d), freq="1 hour")


@query("resample_count", Q.with_series("SELECT * FROM s"))
def q_resample_count(spark, d):
    """Per-minute counts, zero-filled."""
    return minute_series(spark, d)


@query("resample_freq", Q.with_series("SELECT * FROM s", step_us=7 * Q.MINUTE))
def q_resample_freq(spark, d):
    """7-minute bins anchored at midnight of the first day."""
    return SE.resample_count(events(spark, d), freq="7min")


@query("resample_count_by_type", Q.with_series("SELECT * FROM s", step_us=Q.HOUR, keys=("event_type",)))
def q_resample_count_by_type(spark, d):
    """T1 with keys (our extension): hourly counts per event type."""
    return SE.resample_count(events(spark, d), freq="1 hour", keys=["event_type"])


@query("resample_daily_lineitem", Q.with_series("SELECT * FROM s", step_us=86_400_000_000,
                                                src="lineitem", ts="l_shipdate"))
def q_resample_daily_lineitem(spark, d):
    """T2 at day grain over lineitem ship dates."""
    return SE.resample_count(table(spark, d, "lineitem"), ts="l_shipdate", freq="1 day")


@query("temporal_split", Q.with_series("""nn AS (SELECT count(*) AS n FROM s)
SELECT s.*, CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS n_train,
       CASE WHEN idx < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM s, nn"""))
def q_temporal_split(spark, d):
    """M1: 80/20 split by position."""
    return PR.temporal_split(minute_series(spark, d), 0.8)


@query("forecast_moving_avg", Q.with_series(
    f"m AS (SELECT *, {Q.MA3} AS predicted FROM s {Q.MA3_WINDOWS}) SELECT * FROM m"))
def q_forecast_moving_avg(spark, d):
    """O1: mean of the last 3 actuals over the whole series."""
    return FC.forecast_moving_avg(minute_series(spark, d))


@query("walk_forward", Q.replay_cte() + "\nSELECT * FROM pr")
def q_walk_forward(spark, d):
    """The replay's prediction table (test side, seeded from the train tail)."""
    return RP.replay_predictions(events(spark, d))


@query("metric_summary", Q.replay_cte(Q.HOUR) + """
SELECT model, count(*) AS n_predictions, avg(actual) AS avg_actual,
       avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
       """ + Q.MAPE_RAW + """ AS mape, """ + Q.MAPE_NZ + """ AS mape_nonzero, """ + Q.WAPE + """ AS wape,
       100 - """ + Q.MAPE_RAW + """ AS accuracy_pct
FROM pr GROUP BY model""")
def q_metric_summary(spark, d):
    """E6 over the hourly replay."""
    return EV.metric_summary(RP.replay_predictions(events(spark, d), freq="1 hour"))


# ================================================================ shared SQL pieces
S_MIN = Q.series_cte()
S_HOUR = Q.series_cte(Q.HOUR)
GAPS_SQL = """g AS (SELECT event_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY ts, event_id) AS gap_us
                    FROM events WHERE ts IS NOT NULL)"""
CAL_SQL = """CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
             CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend"""
ROLL_SQL = """CASE WHEN count(*) OVER w = 1440 THEN avg(CAST(txn_count AS DOUBLE)) OVER w END AS rolling_mean,
              CASE WHEN count(*) OVER w = 1440 THEN stddev_samp(CAST(txn_count AS DOUBLE)) OVER w END AS rolling_std"""
ROLL_W = "WINDOW w AS (ORDER BY idx ROWS BETWEEN 1439 PRECEDING AND CURRENT ROW)"
HOURLY_SQL = """h AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, avg(txn_count) AS mean, stddev_samp(txn_count) AS std,
                       CAST(min(txn_count) AS DOUBLE) AS min, CAST(max(txn_count) AS DOUBLE) AS max FROM s GROUP BY 1)"""
WEEKDAY_SQL = """dn AS (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
                        (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) t(day_of_week, day_name)),
wa AS (SELECT dayname(ts) AS day_name, avg(txn_count) AS mean, stddev_samp(txn_count) AS std FROM s GROUP BY 1),
wd AS (SELECT CAST(dn.day_of_week AS INTEGER) AS day_of_week, dn.day_name, wa.mean, wa.std
       FROM dn LEFT JOIN wa USING (day_name))"""
ACF_SQL = """mu AS (SELECT avg(CAST(txn_count AS DOUBLE)) AS m, count(*) AS n FROM s),
cx AS (SELECT idx, txn_count - m AS x FROM s, mu),
den AS (SELECT sum(x * x) AS d FROM cx),
lg AS (SELECT CAST(unnest({lags}) AS INTEGER) AS lag),
ac AS (SELECT lag, sum(a.x * b.x) / (SELECT d FROM den) AS acf
       FROM lg JOIN cx a ON TRUE JOIN cx b ON b.idx = a.idx - lg.lag, mu WHERE lg.lag < mu.n GROUP BY lag)"""
KEY_LAGS_SQL = "[1, 5, 10, 15, 30, 60, 120, 1440]"
ALL_LAGS_SQL = "range(0, 101)"
IQR_SQL = """qq AS (SELECT quantile_cont(txn_count, 0.25) AS q1, quantile_cont(txn_count, 0.75) AS q3 FROM s),
bb AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 3 * (q3 - q1) AS lower_bound, q3 + 3 * (q3 - q1) AS upper_bound FROM qq)"""
SPLIT80 = "nn AS (SELECT count(*) AS n FROM s), sp AS (SELECT s.*, CASE WHEN idx < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM s, nn)"


def w(body: str, cte: str = S_MIN) -> str:
    return f"WITH {cte},\n{body}"


def minute_replay(spark, d):
    return RP.replay_predictions(events(spark, d))


def hour_replay(spark, d):
    return RP.replay_predictions(events(spark, d), freq="1 hour")


REPLAY_H = Q.replay_cte(Q.HOUR)
REPLAY_M = Q.replay_cte()

from ratecast.functions import calendar as CA  # noqa: E402
from ratecast.functions import metrics as MT  # noqa: E402
from ratecast.operators import patterns as PT  # noqa: E402
from ratecast.operators import profile as PF  # noqa: E402
from ratecast.operators import stats as ST  # noqa: E402
from ratecast.plans import profile_report as PRR  # noqa: E402


# ================================================================ 2.E windows
@query("event_gaps", f"WITH {GAPS_SQL} SELECT * FROM g")
def q_event_gaps(spark, d):
    """Gap to the previous event, range-partitioned scan."""
    return WI.event_gaps(events(spark, d))


@query("event_gaps_by_user", """SELECT user_id, event_id, ts,
       epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap_us
       FROM events WHERE ts IS NOT NULL""")
def q_event_gaps_by_user(spark, d):
    """R1 with keys: gap to the same user's previous event."""
    return WI.event_gaps(events(spark, d), keys=["user_id"])


@query("event_gap_stats", f"""WITH {GAPS_SQL}
SELECT count(gap_us) AS n_gaps, avg(gap_us) / 1e6 AS mean_gap_s, min(gap_us) / 1e6 AS min_gap_s,
       max(gap_us) / 1e6 AS max_gap_s, quantile_cont(gap_us, 0.5) / 1e6 AS median_gap_s
FROM g WHERE gap_us IS NOT NULL""")
def q_event_gap_stats(spark, d):
    """R2: mean / median / min / max gap (exact distributed median)."""
    return WI.event_gap_stats(WI.event_gaps(events(spark, d)))


@query("large_gaps", f"WITH {GAPS_SQL} SELECT * FROM g WHERE gap_us > 600000000 ORDER BY ts, event_id LIMIT 5")
def q_large_gaps(spark, d):
    """the first 5 gaps longer than 10 minutes (a top-k report)."""
    return SE.large_gaps(WI.event_gaps(events(spark, d)), 10, n=5, order=("ts", "event_id"))


@query("large_gaps_count", f"WITH {GAPS_SQL} SELECT count(*) AS n_large_gaps FROM g WHERE gap_us > 600000000")
def q_large_gaps_count(spark, d):
    """how many gaps exceed 10 minutes."""
    return SE.large_gaps(WI.event_gaps(events(spark, d)), 10).agg(F.count(F.lit(1)).alias("n_large_gaps"))


@query("moving_avg_5", w("""m AS (SELECT *, avg(CAST(txn_count AS DOUBLE)) OVER (ORDER BY idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS txn_ma_5 FROM s)
SELECT * FROM m"""))
def q_moving_avg_5(spark, d):
    """Trailing 5-row mean, partial at the start."""
    return WI.moving_average(minute_series(spark, d), rows=5)


@query("rolling_mean_std", w(f"r AS (SELECT *, {ROLL_SQL} FROM s {ROLL_W}) SELECT * FROM r"))
def q_rolling_mean_std(spark, d):
    """1440-row rolling mean and sample std, null until full."""
    return WI.rolling_mean_std(minute_series(spark, d))


@query("lookback_windows", w("""x AS (SELECT idx, list(CAST(txn_count AS DOUBLE)) OVER (ORDER BY idx ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS x,
                     CAST(txn_count AS DOUBLE) AS y FROM s)
SELECT idx, idx - 60 AS row, x, y FROM x WHERE len(x) = 60"""))
def q_lookback_windows(spark, d):
    """L=60 input windows with the next value as target."""
    return WI.lookback_windows(minute_series(spark, d), lookback=60)


@query("lookback_windows_multi", w(f"""f AS (SELECT idx, txn_count, {CAL_SQL} FROM s),
x AS (SELECT idx, flatten(list([CAST(txn_count AS DOUBLE), hour, day_of_week, is_weekend]) OVER (ORDER BY idx ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)) AS x,
             count(*) OVER (ORDER BY idx ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS c,
             CAST(txn_count AS DOUBLE) AS y FROM f)
SELECT idx, idx - 60 AS row, x, y FROM x WHERE c = 60"""))
def q_lookback_windows_multi(spark, d):
    """L=60 x 4 feature windows (flattened row-major for the check)."""
    feats = CA.add_time_features(minute_series(spark, d))
    r = WI.lookback_windows_multi(feats, lookback=60)
    return r.select("idx", "row", F.flatten("x").alias("x"), "y")


@query("running_metrics", REPLAY_M + """,
rm AS (SELECT *, row_number() OVER o AS k,
       avg(abs(predicted - actual)) OVER o AS a1, sqrt(avg((predicted - actual) * (predicted - actual)) OVER o) AS a2,
       avg(CASE WHEN actual = 0 AND predicted - actual = 0 THEN 'NaN'::DOUBLE WHEN actual = 0 THEN 'Infinity'::DOUBLE
                ELSE abs((predicted - actual) / actual) END) OVER o * 100 AS a3
       FROM pr WINDOW o AS (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT ts, idx, actual, predicted, error, model, CASE WHEN k > 1 THEN a1 END AS running_mae,
       CASE WHEN k > 1 THEN a2 END AS running_rmse, CASE WHEN k > 1 THEN a3 END AS running_mape FROM rm""")
def q_running_metrics(spark, d):
    """Running MAE / RMSE / MAPE over the minute replay (two-level carry)."""
    return WI.running_metrics(minute_replay(spark, d))


@query("recent_values", w("""r AS (SELECT *, coalesce(list(txn_count) OVER (ORDER BY idx ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), []) AS recent_5 FROM s)
SELECT * FROM r"""))
def q_recent_values(spark, d):
    """The last 5 actuals before each minute."""
    return WI.recent_values(minute_series(spark, d), k=5)


@query("last_n_points", REPLAY_M + """
SELECT *, abs(predicted - actual) AS abs_error FROM pr WHERE idx > (SELECT max(idx) FROM pr) - 50""")
def q_last_n_points(spark, d):
    """The last 50 replayed points with their error."""
    return WI.last_n_points(minute_replay(spark, d), k=50)


@query("stability_halves", w(f"""r AS (SELECT *, {ROLL_SQL} FROM s {ROLL_W}),
nn AS (SELECT count(*) AS n FROM s),
a AS (SELECT avg(CASE WHEN idx >= 1440 AND idx < floor(n / 2) THEN rolling_mean END) AS first_mean,
             avg(CASE WHEN idx >= floor(n / 2) THEN rolling_mean END) AS second_mean,
             avg(CASE WHEN idx >= 1440 AND idx < floor(n / 2) THEN rolling_std END) AS first_std,
             avg(CASE WHEN idx >= floor(n / 2) THEN rolling_std END) AS second_std FROM r, nn)
SELECT *, abs(second_mean - first_mean) AS mean_change, abs(second_std - first_std) AS std_change,
       abs(second_mean - first_mean) / first_mean * 100 AS mean_change_pct,
       abs(second_std - first_std) / first_std * 100 AS std_change_pct,
       coalesce(abs(second_mean - first_mean) / first_mean < 0.1 AND abs(second_std - first_std) / first_std < 0.2, false) AS is_stable
FROM a"""))
def q_stability_halves(spark, d):
    """First vs second half of the rolling statistics."""
    return WI.stability_halves(WI.rolling_mean_std(minute_series(spark, d)))


# ================================================================ 2.D remaining
@query("series_completeness", w("""SELECT CAST((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000 + 1 AS BIGINT) AS expected_bins,
       count(*) AS actual_bins,
       CAST((epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000 + 1 AS BIGINT) - count(*) AS missing_bins FROM s"""))
def q_series_completeness(spark, d):
    """Expected vs actual minutes."""
    return SE.series_completeness(minute_series(spark, d))


@query("daily_counts", "SELECT CAST(ts AS DATE) AS date, count(*) AS n_events FROM events WHERE ts IS NOT NULL GROUP BY 1")
def q_daily_counts(spark, d):
    """T4: events per calendar date."""
    return SE.daily_counts(events(spark, d))


@query("daily_count_stats", """WITH dc AS (SELECT count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY CAST(ts AS DATE))
SELECT avg(n) AS mean_per_day, min(n) AS min_per_day, max(n) AS max_per_day, stddev_samp(n) AS std_per_day FROM dc""")
def q_daily_count_stats(spark, d):
    """T5: statistics of the daily counts."""
    return SE.daily_count_stats(events(spark, d))


@query("series_stats", w("""SELECT count(*) AS n_bins, avg(txn_count) AS mean, quantile_cont(txn_count, 0.5) AS median,
       stddev_samp(txn_count) AS std, CAST(min(txn_count) AS DOUBLE) AS min, CAST(max(txn_count) AS DOUBLE) AS max,
       stddev_samp(txn_count) / avg(txn_count) AS cv FROM s"""))
def q_series_stats(spark, d):
    """Mean, median, std, min, max, CV of the minute series."""
    return SE.series_stats(minute_series(spark, d))


@query("zero_bins", w("""SELECT count(*) FILTER (WHERE txn_count = 0) AS zero_bins, count(*) AS n_bins,
       count(*) FILTER (WHERE txn_count = 0) * 100.0::DOUBLE / count(*) AS zero_pct,
       count(*) FILTER (WHERE txn_count = 0) > count(*) * 0.05::DOUBLE AS high_zero_share FROM s"""))
def q_zero_bins(spark, d):
    """Empty minutes."""
    return SE.zero_bins(minute_series(spark, d))


@query("series_percentiles", w("""q AS (SELECT quantile_cont(txn_count, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) AS v FROM s)
SELECT CAST(unnest([1, 5, 10, 25, 50, 75, 90, 95, 99]) AS INTEGER) AS percentile, unnest(v) AS value FROM q""", S_HOUR))
def q_series_percentiles(spark, d):
    """Percentiles of the hourly series."""
    return SE.series_percentiles(hour_series(spark, d))


@query("sort_by_time", """SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events""")
def q_sort_by_time(spark, d):
    """Global time order with a 0-based position (range-partitioned)."""
    return SE.sort_by_time(events(spark, d), tiebreak="event_id")


@query("split_summary", w(SPLIT80 + """
SELECT split, count(*) AS n_rows, avg(txn_count) AS mean, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM s) AS share_pct
FROM sp GROUP BY split"""))
def q_split_summary(spark, d):
    """Sizes, shares and means of the 80/20 sides."""
    return SE.split_summary(PR.temporal_split(minute_series(spark, d), 0.8))


PROFILE_SUMMARY_SQL = f"""WITH RECURSIVE dd AS (SELECT DISTINCT * FROM events),
{Q.series_cte(src='dd', count_col='tps')},
{IQR_SQL.replace('txn_count', 'tps')},
hh AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, avg(tps) AS mean FROM s GROUP BY 1),
mu AS (SELECT avg(CAST(tps AS DOUBLE)) AS m, count(*) AS n FROM s),
cx AS (SELECT idx, tps - m AS x FROM s, mu),
den AS (SELECT sum(x * x) AS d FROM cx),
lg AS (SELECT unnest(range(0, 100)) AS lag),
ac AS (SELECT lag, sum(a.x * b.x) / (SELECT d FROM den) AS acf FROM lg JOIN cx a ON TRUE JOIN cx b ON b.idx = a.idx - lg.lag, mu
       WHERE lg.lag < mu.n GROUP BY lag),
{Q.adf_ctes(55, col='tps')}
SELECT (SELECT count(*) FROM dd) AS total_records, count(*) AS total_minutes, avg(tps) AS mean_tps,
       stddev_samp(tps) AS std_tps, CAST(min(tps) AS DOUBLE) AS min_tps, CAST(max(tps) AS DOUBLE) AS max_tps,
       count(*) FILTER (WHERE tps = 0) AS zero_minutes,
       (SELECT count(*) FILTER (WHERE tps < lower_bound OR tps > upper_bound) * 100.0::DOUBLE / count(*) FROM s, bb) AS outliers_pct,
       (SELECT CAST(arg_max(hour, (mean, -hour)) AS INTEGER) FROM hh) AS peak_hour,
       (SELECT CAST(arg_min(hour, (mean, hour)) AS INTEGER) FROM hh) AS low_hour,
       (SELECT CAST(coalesce(max(lag) FILTER (WHERE abs(acf) > 0.2 AND NOT isnan(acf)), 10) AS BIGINT) FROM ac) AS recommended_lookback,
       (SELECT p_value FROM adf) AS adf_pvalue, (SELECT p_value < 0.05 FROM adf) AS is_stationary
FROM s"""


@query("profile_summary", PROFILE_SUMMARY_SQL)
def q_profile_summary(spark, d):
    """The 13-field summary row."""
    return PRR.profile_summary(events(spark, d), with_adf=True)


@query("profile_summary_full", PROFILE_SUMMARY_SQL)
def q_profile_summary_full(spark, d):
    """T11, the name that it had before profile_summary got the ADF fields."""
    return PRR.profile_summary(events(spark, d), with_adf=True)


# ================================================================ 2.B profile
TYPE_MAP = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
              WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END"""


@query("profile_overview", f"""SELECT CAST(ordinal_position - 1 AS INTEGER) AS ordinal, column_name, {TYPE_MAP} AS data_type,
       (SELECT count(*) FROM orders) AS n_rows FROM information_schema.columns WHERE table_name = 'orders'""")
def q_profile_overview(spark, d):
    """Columns, types and row count of orders."""
    return PF.profile_overview(table(spark, d, "orders"))


@query("first_rows", "SELECT * FROM events ORDER BY ts, event_id LIMIT 10")
def q_first_rows(spark, d):
    """head(10) in time order."""
    return PF.first_rows(events(spark, d), 10)


@query("last_rows", "SELECT * FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 10) ORDER BY ts, event_id")
def q_last_rows(spark, d):
    """tail(10) in time order."""
    return PF.last_rows(events(spark, d), 10)


@query("random_rows", "SELECT * FROM events ORDER BY md5('42:' || event_id), event_id LIMIT 10")
def q_random_rows(spark, d):
    """10 repeatable pseudo-random events."""
    return PF.random_rows(events(spark, d), 10, seed=42)


def _describe_sql(tbl: str, cols: list[str]) -> str:
    parts = [f"""SELECT '{c}' AS column_name, count({c}) AS count, avg(CAST({c} AS DOUBLE)) AS mean,
       stddev_samp(CAST({c} AS DOUBLE)) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
       quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
       quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75 FROM {tbl}""" for c in cols]
    return "\nUNION ALL\n".join(parts)


@query("describe_numeric", _describe_sql("orders", ["o_orderkey", "o_custkey", "o_totalprice"]))
def q_describe_numeric(spark, d):
    """P5: describe() of the numeric columns of orders (exact distributed quartiles)."""
    return PF.describe_numeric(table(spark, d, "orders"))


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("null_counts", "WITH nc AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM orders" for c in ORDERS_COLS)
    + ") SELECT *, (SELECT sum(null_count) FROM nc) = 0 AS table_has_no_nulls FROM nc")
def q_null_counts(spark, d):
    """Nulls per column of orders."""
    return PF.null_counts(table(spark, d, "orders"))


@query("distinct_counts", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM orders" for c in ORDERS_COLS))
def q_distinct_counts(spark, d):
    """Distinct values per column of orders."""
    return PF.distinct_counts(table(spark, d, "orders"))


@query("profile_by_day", "\nUNION ALL\n".join(f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS null_count, avg(CAST({c} AS DOUBLE)) AS mean,
       stddev_samp(CAST({c} AS DOUBLE)) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
       true AS distinct_close, true AS median_close FROM events""" for c in ("event_id", "user_id", "value")))
def q_profile_by_day(spark, d):
    """P5-P7 kept by day: the log's days are profiled in two halves, each appended to a table, and united. Sketched
    figures are compared with the exact ones (5 % of the distinct values, 2 % of the ranks)."""
    ev, path = events(spark, d), scratch(spark, "daily")
    cols = ["event_id", "user_id", "value"]
    odd = F.pmod(F.dayofyear("ts"), F.lit(2)) == 1
    for half in (odd, ~odd):
        IO.write_table(PF.daily_profile(ev.where(half), cols), path, mode="append")
    u = materialize(PF.unite_profile(spark.read.parquet(path)))
    exact = PF.distinct_counts(ev.select(*cols))
    at = u.select("column_name", "approx_median")
    share = ev.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column_name", "v").join(F.broadcast(at), "column_name") \
        .groupBy("column_name").agg((F.count_if(F.col("v") < F.col("approx_median")) / F.count("v")).alias("lo"),
                                    (F.count_if(F.col("v") <= F.col("approx_median")) / F.count("v")).alias("hi"))
    u = u.join(exact, "column_name").join(share, "column_name")
    return u.select("column_name", "n_rows", "null_count", "mean", "std", "min", "max",
                    (F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")).alias("distinct_close"),
                    ((F.col("lo") <= 0.52) & (F.col("hi") >= 0.48)).alias("median_close"))


@query("duplicate_count", """SELECT CAST(sum(c - 1) AS BIGINT) AS duplicate_rows, CAST(sum(c) AS BIGINT) AS total_rows
FROM (SELECT count(*) AS c FROM events GROUP BY user_id, event_type)""")
def q_duplicate_count(spark, d):
    """Repeated (user, event type) rows of the log."""
    return PF.duplicate_count(events(spark, d).select("user_id", "event_type"))


@query("duplicate_count_rows", """SELECT CAST(sum(c - 1) AS BIGINT) AS duplicate_rows, CAST(sum(c) AS BIGINT) AS total_rows
FROM (SELECT count(*) AS c FROM events GROUP BY ALL)""".replace("GROUP BY ALL", "GROUP BY event_id, ts, user_id, event_type, value, props"))
def q_duplicate_count_rows(spark, d):
    """P8 on whole rows (the reference's check)."""
    return PF.duplicate_count(events(spark, d))


@query("drop_duplicates", "SELECT DISTINCT user_id, event_type FROM events")
def q_drop_duplicates(spark, d):
    """One copy of each (user, event type)."""
    return PF.drop_duplicates(events(spark, d).select("user_id", "event_type"))


@query("time_range", """SELECT min(ts) AS start, max(ts) AS "end",
       CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) AS BIGINT) AS duration_days,
       CAST(floor(((epoch_us(max(ts)) - epoch_us(min(ts))) % 86400000000) / 3600000000) AS BIGINT) AS duration_hours
FROM events""")
def q_time_range(spark, d):
    """P10: span of the log."""
    return PF.time_range(events(spark, d))


# ================================================================ 2.C filters
@query("project_columns", w("SELECT ts, txn_count FROM s"))
def q_project_columns(spark, d):
    """F1."""
    return SE.project_columns(minute_series(spark, d), keep=["ts", "txn_count"])


@query("weekend_filter", w(f"f AS (SELECT *, {CAL_SQL} FROM s) SELECT * FROM f WHERE is_weekend = 1"))
def q_weekend_filter(spark, d):
    """weekend minutes."""
    return SE.weekend_filter(CA.add_time_features(minute_series(spark, d)))


@query("weekday_filter", w(f"f AS (SELECT *, {CAL_SQL} FROM s) SELECT * FROM f WHERE is_weekend = 0"))
def q_weekday_filter(spark, d):
    """F3 negated: weekday minutes."""
    return SE.weekend_filter(CA.add_time_features(minute_series(spark, d)), weekend=False)


@query("outlier_filter", w(IQR_SQL + ", o AS (SELECT s.* FROM s, bb WHERE txn_count < lower_bound OR txn_count > upper_bound) SELECT * FROM o"))
def q_outlier_filter(spark, d):
    """minutes outside the 3 x IQR bounds."""
    return ST.iqr_outlier_rows(minute_series(spark, d)).drop("lower_bound", "upper_bound")


@query("membership", w("SELECT *, (isodow(ts) - 1) IN (5, 6) AS is_weekend FROM s"))
def q_membership(spark, d):
    """day_of_week in (5, 6) as a boolean column."""
    s = minute_series(spark, d)
    return s.withColumn("is_weekend", F.weekday("ts").isin(list(CA.WEEKEND_DAYS)))


@query("positional_slice", w("SELECT s.* FROM s, (SELECT count(*) AS n FROM s) nn WHERE idx >= 1440 AND idx < floor(n / 2)"))
def q_positional_slice(spark, d):
    """rows [1440, n/2)."""
    s = minute_series(spark, d)
    n = SE.series_length(s)
    return SE.attach(s, n).where((F.col("idx") >= 1440) & (F.col("idx") < F.floor(F.col("n") / 2))).drop("n")


@query("rename_cast", w("SELECT ts, idx, CAST(txn_count AS DOUBLE) AS txn_count FROM s"))
def q_rename_cast(spark, d):
    """float counts."""
    return SE.rename_cast(minute_series(spark, d))


# ================================================================ 2.F scalars
@query("time_features_calendar", w(f"SELECT *, {CAL_SQL} FROM s"))
def q_time_features_calendar(spark, d):
    """Hour, Monday=0 day of week, 0/1 weekend flag."""
    return CA.add_time_features(minute_series(spark, d))


@query("time_features_profile", w("""SELECT ts, idx, txn_count, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, dayname(ts) AS day_name, CAST(ts AS DATE) AS date,
       isodow(ts) >= 6 AS is_weekend FROM s"""))
def q_time_features_profile(spark, d):
    """C1, C2, C4, C5 and the boolean C3."""
    return CA.add_time_features(minute_series(spark, d),
                                ("hour", "day_of_week", "day_name", "date", "is_weekend_bool"))


@query("time_features_cyclic", w("""SELECT ts, idx, CAST(txn_count AS DOUBLE) AS txn_count,
       sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
       avg(CAST(txn_count AS DOUBLE)) OVER (ORDER BY idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS txn_ma_5 FROM s"""))
def q_time_features_cyclic(spark, d):
    """C6 + R3: the grid script's feature bundle (hour dropped)."""
    s = SE.rename_cast(minute_series(spark, d))
    s = CA.add_time_features(s, ("hour_sin", "hour_cos"))
    return WI.moving_average(s, "txn_count", 5)


@query("abs_error_ape", REPLAY_H + """
SELECT idx, actual, predicted, abs(predicted - actual) AS abs_error,
       CASE WHEN actual > 0 THEN abs(predicted - actual) / actual * 100 ELSE 0.0 END AS ape_guarded FROM pr""")
def q_abs_error_ape(spark, d):
    """C7, C8 on the hourly replay."""
    p = hour_replay(spark, d)
    return p.select("idx", "actual", "predicted", MT.abs_error().alias("abs_error"), MT.ape_guarded().alias("ape_guarded"))


@query("round2", w(HOURLY_SQL + " SELECT hour, round_even(mean, 2) AS mean, round_even(std, 2) AS std, round_even(min, 2) AS min, round_even(max, 2) AS max FROM h"))
def q_round2(spark, d):
    """Hourly statistics rounded half-to-even to 2 places."""
    h = PT.hourly_stats(CA.add_time_features(minute_series(spark, d), ("hour",)))
    return h.select("hour", *[CA.round2(c).alias(c) for c in ("mean", "std", "min", "max")])


# ================================================================ 2.G patterns
def _feats(spark, d):
    return CA.add_time_features(minute_series(spark, d), ("hour",))


@query("hourly_stats", w(HOURLY_SQL + " SELECT * FROM h"))
def q_hourly_stats(spark, d):
    """G1."""
    return PT.hourly_stats(_feats(spark, d))


@query("peak_low_hour", w(HOURLY_SQL + """ SELECT CAST(arg_max(hour, (mean, -hour)) AS INTEGER) AS peak_hour, max(mean) AS peak_mean,
       CAST(arg_min(hour, (mean, hour)) AS INTEGER) AS low_hour, min(mean) AS low_mean FROM h"""))
def q_peak_low_hour(spark, d):
    """First hour on ties."""
    return PT.peak_low_hour(PT.hourly_stats(_feats(spark, d)))


@query("hourly_variation", w(HOURLY_SQL + " SELECT max(mean) - min(mean) AS hourly_range, (max(mean) - min(mean)) / avg(mean) * 100 AS hourly_range_pct FROM h"))
def q_hourly_variation(spark, d):
    """G3."""
    return PT.hourly_variation(PT.hourly_stats(_feats(spark, d)))


@query("weekday_stats", w(WEEKDAY_SQL + " SELECT * FROM wd"))
def q_weekday_stats(spark, d):
    """Monday..Sunday with null rows for absent days."""
    return PT.weekday_stats(minute_series(spark, d))


@query("busiest_quietest_day", w(WEEKDAY_SQL + """ SELECT arg_max(day_name, (mean, -day_of_week)) AS busiest_day,
       arg_min(day_name, (mean, day_of_week)) AS quietest_day, max(mean) - min(mean) AS weekly_range,
       (max(mean) - min(mean)) / avg(mean) * 100 AS weekly_range_pct FROM wd WHERE mean IS NOT NULL"""))
def q_busiest_quietest_day(spark, d):
    """G5."""
    return PT.busiest_quietest_day(PT.weekday_stats(minute_series(spark, d)))


@query("weekend_vs_weekday", w("""a AS (SELECT avg(CASE WHEN isodow(ts) < 6 THEN txn_count END) AS weekday_mean,
       avg(CASE WHEN isodow(ts) >= 6 THEN txn_count END) AS weekend_mean FROM s)
SELECT *, abs(weekend_mean - weekday_mean) AS difference, abs(weekend_mean - weekday_mean) / weekday_mean * 100 AS difference_pct FROM a"""))
def q_weekend_vs_weekday(spark, d):
    """G6."""
    return PT.weekend_vs_weekday(minute_series(spark, d))


# ================================================================ 2.H statistics
@query("acf_key_lags", w(ACF_SQL.format(lags=KEY_LAGS_SQL) + """
SELECT lag, acf, CASE WHEN lag >= 1440 THEN CAST(lag // 1440 AS VARCHAR) || ' day' WHEN lag >= 60 THEN CAST(lag // 60 AS VARCHAR) || ' hr'
                      ELSE CAST(lag AS VARCHAR) || ' min' END AS lag_label FROM ac"""))
def q_acf_key_lags(spark, d):
    """A1 + C10: ACF at 1, 5, 10, 15, 30, 60, 120, 1440 minutes."""
    return ST.acf_key_lags(minute_series(spark, d))


@query("acf_all_lags", w(ACF_SQL.format(lags=ALL_LAGS_SQL) + " SELECT lag, acf FROM ac"))
def q_acf_all_lags(spark, d):
    """A2: ACF for lags 0..100 (halo blocks, partial sums)."""
    return ST.acf(minute_series(spark, d), range(101))


ACF_LONG_SQL = w("""mu AS (SELECT avg(CAST(txn_count AS DOUBLE)) AS m, count(*) AS n FROM s),
x AS MATERIALIZED (SELECT list(txn_count - m ORDER BY idx) AS x FROM s, mu),
d AS (SELECT list_sum(list_transform(x, lambda v: v * v)) AS d FROM x)
SELECT CAST(lag AS INTEGER) AS lag, list_inner_product(x[lag + 1:], x[:len(x) - lag]) / d AS acf FROM x, d, (SELECT unnest(range(0, 1441)) AS lag)""")


@query("acf_long", ACF_LONG_SQL)
def q_acf_long(spark, d):
    """A2 for lags 0..1440 of the minute series (a Fourier transform for each halo block)."""
    return ST.acf(minute_series(spark, d), range(1441))


@query("acf_hourly", w(ACF_SQL.format(lags="range(0, 49)") + " SELECT lag, acf FROM ac", S_HOUR))
def q_acf_hourly(spark, d):
    """A2 on the hourly series, lags 0..48."""
    return ST.acf(hour_series(spark, d), range(49))


@query("recommended_lookback", w(ACF_SQL.format(lags=ALL_LAGS_SQL) + """,
r AS (SELECT max(lag) FILTER (WHERE lag < 100 AND abs(acf) > 0.2 AND NOT isnan(acf)) AS r FROM ac)
SELECT r AS max_significant_lag, r AS lookback_min, r * 2 AS lookback_recommended_max, least(r * 3, 1440) AS lookback_max,
       coalesce(r, 10) AS recommended_lookback FROM r"""))
def q_recommended_lookback(spark, d):
    """A3."""
    a = ST.acf(minute_series(spark, d), range(101))
    r = ST.recommended_lookback(a)
    return r.select(*[F.col(c).cast("int").alias(c) for c in r.columns])


@query("iqr_outliers", w(IQR_SQL + """, c AS (SELECT count(*) FILTER (WHERE txn_count < lower_bound OR txn_count > upper_bound) AS n_outliers,
       count(*) FILTER (WHERE txn_count < lower_bound OR txn_count > upper_bound) * 100.0::DOUBLE / count(*) AS outlier_pct FROM s, bb)
SELECT * FROM bb, c"""))
def q_iqr_outliers(spark, d):
    """A4 at minute grain (degenerate: Q1 = Q3 = 0)."""
    return ST.iqr_outliers(minute_series(spark, d))


@query("iqr_outliers_daily", w(IQR_SQL + """, c AS (SELECT count(*) FILTER (WHERE txn_count < lower_bound OR txn_count > upper_bound) AS n_outliers,
       count(*) FILTER (WHERE txn_count < lower_bound OR txn_count > upper_bound) * 100.0::DOUBLE / count(*) AS outlier_pct FROM s, bb)
SELECT * FROM bb, c""", Q.series_cte(86_400_000_000, "lineitem", "l_shipdate")))
def q_iqr_outliers_daily(spark, d):
    """A4 on daily lineitem ship dates."""
    return ST.iqr_outliers(SE.resample_count(table(spark, d, "lineitem"), ts="l_shipdate", freq="1 day"))


@query("iqr_outlier_stats", w(IQR_SQL + """ SELECT count(*) AS n_outliers, CAST(min(txn_count) AS DOUBLE) AS min_outlier,
       CAST(max(txn_count) AS DOUBLE) AS max_outlier, avg(txn_count) AS mean_outlier
FROM s, bb WHERE txn_count < lower_bound OR txn_count > upper_bound"""))
def q_iqr_outlier_stats(spark, d):
    """A5."""
    return ST.iqr_outlier_stats(minute_series(spark, d))


ZSQL = """st AS (SELECT avg(txn_count) AS mu, stddev_pop(txn_count) AS sd FROM s)
SELECT count(*) FILTER (WHERE sd > 0 AND abs(txn_count - mu) / sd > 3) AS n_outliers,
       count(*) FILTER (WHERE sd > 0 AND abs(txn_count - mu) / sd > 3) * 100.0::DOUBLE / count(*) AS outlier_pct FROM s, st"""


@query("zscore_outliers", w(ZSQL))
def q_zscore_outliers(spark, d):
    """A6 at minute grain."""
    return ST.zscore_outliers(minute_series(spark, d))


@query("zscore_outliers_hourly", w(ZSQL, S_HOUR))
def q_zscore_outliers_hourly(spark, d):
    """A6 at hour grain."""
    return ST.zscore_outliers(hour_series(spark, d))


SKEW_SQL = """SELECT skewness(txn_count) AS skewness,
       CASE WHEN abs(skewness(txn_count)) < 0.5 THEN 'symmetric' WHEN skewness(txn_count) > 0 THEN 'right-skewed' ELSE 'left-skewed' END AS skew_class FROM s"""
KURT_SQL = """SELECT kurtosis(txn_count) AS kurtosis,
       CASE WHEN abs(kurtosis(txn_count)) < 0.5 THEN 'mesokurtic' WHEN kurtosis(txn_count) > 0 THEN 'leptokurtic' ELSE 'platykurtic' END AS kurtosis_class FROM s"""


@query("skewness_class", w(SKEW_SQL))
def q_skewness_class(spark, d):
    """A7 (minute)."""
    return ST.skewness_class(minute_series(spark, d))


@query("skewness_class_hourly", w(SKEW_SQL, S_HOUR))
def q_skewness_class_hourly(spark, d):
    """A7 (hour)."""
    return ST.skewness_class(hour_series(spark, d))


@query("kurtosis_class", w(KURT_SQL))
def q_kurtosis_class(spark, d):
    """A8 (minute)."""
    return ST.kurtosis_class(minute_series(spark, d))


@query("kurtosis_class_hourly", w(KURT_SQL, S_HOUR))
def q_kurtosis_class_hourly(spark, d):
    """A8 (hour)."""
    return ST.kurtosis_class(hour_series(spark, d))


JB_SQL = """m AS (SELECT count(*) AS n, avg(txn_count) AS mu FROM s),
c AS (SELECT avg(power(txn_count - mu, 2)) AS m2, avg(power(txn_count - mu, 3)) AS m3, avg(power(txn_count - mu, 4)) AS m4 FROM s, m),
j AS (SELECT n, n / 6.0::DOUBLE * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4) AS jarque_bera FROM m, c)
SELECT n, jarque_bera, exp(-jarque_bera / 2) AS p_value, exp(-jarque_bera / 2) > 0.05 AS is_normal FROM j"""


@query("normality_test", w(JB_SQL, S_HOUR))
def q_normality_test(spark, d):
    """A9 (re-aimed): Jarque-Bera on the whole hourly series."""
    return ST.normality_test(hour_series(spark, d))


@query("normality_test_minute", w(JB_SQL))
def q_normality_test_minute(spark, d):
    """A9 at minute grain."""
    return ST.normality_test(minute_series(spark, d))


SF_SQL = f"""i AS (SELECT CAST(txn_count AS DOUBLE) AS x, row_number() OVER (ORDER BY txn_count) AS i, count(*) OVER () AS n, avg(txn_count) OVER () AS mu FROM s),
m AS (SELECT x - mu AS x, n, {NO.normal_quantile_sql("(i - 0.375) / (n + 0.25)")} AS m FROM i),
t AS (SELECT any_value(n) AS n, power(sum(m * x), 2) / (sum(m * m) * sum(x * x)) AS w_statistic FROM m),
z AS (SELECT *, -(ln(1 - w_statistic) - (-1.2725 + 1.0521 * (ln(ln(n)) - ln(n)))) / (1.0308 - 0.26758 * (ln(ln(n)) + 2 / ln(n))) AS z FROM t)
SELECT n, w_statistic, {Q.normal_cdf("z")} AS p_value, {Q.normal_cdf("z")} > 0.05 AS is_normal FROM z"""


@query("normality_shapiro_francia", w(SF_SQL, S_HOUR))
def q_normality_shapiro_francia(spark, d):
    """A9, order statistics: Shapiro-Francia on the whole hourly series."""
    return NO.shapiro_francia(hour_series(spark, d))


@query("normality_shapiro_francia_minute", w(SF_SQL))
def q_normality_shapiro_francia_minute(spark, d):
    """A9, order statistics, at minute grain (mostly ties)."""
    return NO.shapiro_francia(minute_series(spark, d))


def adf_sql(max_lag, step=S_HOUR, more="", src="s"):
    """The ADF row in SQL; ``max_lag`` is 12 (n / 100)^(1/4) rounded up for the given 30 days of events."""
    crit = ", ".join(f"({a}) + ({b}) / nobs + ({c}) / power(nobs, 2) + ({e}) / power(nobs, 3) AS crit_{k[:-1]}pct" for k, (a, b, c, e) in ST.CRIT.items())
    return w(more + Q.adf_ctes(max_lag, src) + f"""
SELECT adf_statistic, p_value, CAST(used_lag AS INTEGER) AS used_lag, nobs, {crit}, p_value < 0.05 AS is_stationary FROM adf""", step).replace("WITH", "WITH RECURSIVE", 1)


ADF_HOUR, ADF_MINUTE = 20, 55


@query("adf_test", adf_sql(ADF_HOUR))
def q_adf_test(spark, d):
    """A10: ADF with AIC lag choice on the hourly series."""
    return ST.adf_test(hour_series(spark, d))


@query("adf_test_minute", adf_sql(ADF_MINUTE, Q.series_cte()))
def q_adf_test_minute(spark, d):
    """A10 on the minute series."""
    return ST.adf_test(minute_series(spark, d))


@query("adf_test_max_lag_3", adf_sql(3))
def q_adf_test_max_lag_3(spark, d):
    """A10 with at most 3 lags."""
    return ST.adf_test(hour_series(spark, d), max_lag=3)


@query("adf_test_cumulative", adf_sql(ADF_HOUR, more="u AS (SELECT idx, sum(txn_count) OVER (ORDER BY idx) - 14 * idx AS txn_count FROM s),\n", src="u"))
def q_adf_test_cumulative(spark, d):
    """A10 on a series that is not stationary: events so far, less 14 an hour."""
    from ratecast.operators.blocks import running_sums
    run = running_sums(hour_series(spark, d), ["txn_count"]).select("idx", (F.col("cum_txn_count") - 14 * F.col("idx")).alias("txn_count"))
    return ST.adf_test(materialize(run))


@query("adf_lag0", w("""l AS (SELECT CAST(txn_count AS DOUBLE) AS y, CAST(lag(txn_count) OVER (ORDER BY idx) AS DOUBLE) AS ylag FROM s),
d AS (SELECT ylag, y - ylag AS dy FROM l WHERE ylag IS NOT NULL)
SELECT regr_count(dy, ylag) AS nobs, regr_slope(dy, ylag) AS slope,
       regr_slope(dy, ylag) / sqrt((regr_syy(dy, ylag) - regr_sxy(dy, ylag) * regr_sxy(dy, ylag) / regr_sxx(dy, ylag))
                                   / (regr_count(dy, ylag) - 2) / regr_sxx(dy, ylag)) AS df_statistic FROM d""", S_HOUR))
def q_adf_lag0(spark, d):
    """A10 fixed at lag 0: Dickey-Fuller t-statistic from regr_* aggregates."""
    return ST.adf_lag0(hour_series(spark, d))


REC_SQL = w(IQR_SQL + "," + HOURLY_SQL + "," + WEEKDAY_SQL + "," + ACF_SQL.format(lags=ALL_LAGS_SQL) + ",\n" + Q.adf_ctes(ADF_MINUTE) + """,
x AS (SELECT (SELECT stddev_samp(txn_count) / avg(txn_count) FROM s) AS cv,
             (SELECT count(*) FILTER (WHERE txn_count < lower_bound OR txn_count > upper_bound) * 100.0::DOUBLE / count(*) FROM s, bb) AS outlier_pct,
             (SELECT (max(mean) - min(mean)) / avg(mean) FROM h) AS h_ratio,
             (SELECT (max(mean) - min(mean)) / avg(mean) FROM wd WHERE mean IS NOT NULL) AS d_ratio,
             (SELECT max(lag) FILTER (WHERE lag < 100 AND abs(acf) > 0.2 AND NOT isnan(acf)) FROM ac) AS r)
SELECT 1 AS rule_id, 'normalization' AS rule, cv AS metric, NULL::DOUBLE AS metric2, 0.3::DOUBLE AS threshold, coalesce(cv > 0.3, false) AS triggered FROM x
UNION ALL SELECT 2, 'differencing', p_value, NULL, 0.05, coalesce(p_value >= 0.05, false) FROM adf
UNION ALL SELECT 3, 'outlier_handling', outlier_pct, NULL, 2.0, coalesce(outlier_pct > 2, false) FROM x
UNION ALL SELECT 4, 'feature_engineering', h_ratio, d_ratio, 0.2, coalesce(h_ratio > 0.2 OR d_ratio > 0.1, false) FROM x
UNION ALL SELECT 5, 'lookback_window', CAST(coalesce(r, 10) AS DOUBLE), CAST(r AS DOUBLE), 0.2, true FROM x
UNION ALL SELECT 6, 'temporal_split', NULL, NULL, 0.0, true FROM x""").replace(
    "WITH s_e AS (SELECT epoch_us(ts) AS us FROM events WHERE ts IS NOT NULL)",
    "WITH RECURSIVE dd AS (SELECT DISTINCT * FROM events), s_e AS (SELECT epoch_us(ts) AS us FROM dd WHERE ts IS NOT NULL)")


@query("recommendations", REC_SQL)
def q_recommendations(spark, d):
    """The rule table, all six rules."""
    return PRR.recommendations(events(spark, d), with_adf=True).withColumn("rule_id", F.col("rule_id").cast("int"))


@query("recommendations_full", REC_SQL)
def q_recommendations_full(spark, d):
    """A11, the name that it had before recommendations got the ADF rule."""
    return q_recommendations(spark, d)


# ================================================================ 2.I split / scale
import uuid  # noqa: E402

from ratecast.operators import leastsq as LS  # noqa: E402
from ratecast.operators import recurrent as RC  # noqa: E402
from ratecast.plans import experiments as XP  # noqa: E402
from ratecast.session import checkpoint_dir  # noqa: E402
from ratecast.sources import io as IO  # noqa: E402
from ratecast.sources import timeparse as TP  # noqa: E402


def scratch(spark, name: str) -> str:
    """A fresh table folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/ratecast-tables/{name}-{uuid.uuid4().hex}"


@query("split_features_target", w(f"""f AS (SELECT *, {CAL_SQL} FROM s), nn AS (SELECT count(*) AS n FROM s)
SELECT CASE WHEN idx < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split, idx, hour, day_of_week, is_weekend,
       txn_count AS y FROM f, nn"""))
def q_split_features_target(spark, d):
    """M2: X = hour, day_of_week, is_weekend; y = count; by side."""
    return PR.split_features_target(CA.add_time_features(minute_series(spark, d)))


@query("tail_split", w("""nn AS (SELECT count(*) AS n FROM s)
SELECT ts, idx - greatest(n - 300, 0) AS idx, txn_count FROM s, nn WHERE idx >= greatest(n - 300, 0)"""))
def q_tail_split(spark, d):
    """M3: the last 300 minutes, re-indexed."""
    return PR.tail_split(minute_series(spark, d), 300)


@query("validation_tail", w("""nn AS (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS nt FROM s),
t AS (SELECT idx, idx - 60 AS row, CAST(txn_count AS DOUBLE) AS y FROM s, nn WHERE idx >= 60 AND idx < nt),
m AS (SELECT max(row) + 1 AS m FROM t)
SELECT idx, row, y, row >= floor(m * (1 - 0.1::DOUBLE)) AS is_validation FROM t, m"""))
def q_validation_tail(spark, d):
    """M4: last 10 % of the training windows (L=60) flagged for validation."""
    s = PR.temporal_split(minute_series(spark, d), 0.8)
    win = WI.lookback_windows(s, lookback=60, split_col="split").where(F.col("split") == "train")
    return PR.validation_tail(win.select("idx", "row", "y"), 0.1)


MM_SQL = "mm AS (SELECT CAST(min(txn_count) AS DOUBLE) AS lo, CAST(max(txn_count) AS DOUBLE) AS hi FROM s{where})"
SCALE = "CASE WHEN hi = lo THEN txn_count - lo ELSE (txn_count - lo) / (hi - lo) END"


@query("minmax_fit_transform", w(MM_SQL.format(where="") + f" SELECT ts, idx, {SCALE} AS txn_count FROM s, mm"))
def q_minmax_fit_transform(spark, d):
    """M5: counts scaled to [0, 1], fitted on all rows (reference parity)."""
    return PR.minmax_fit_transform(minute_series(spark, d))


@query("minmax_transform_fitted", w(SPLIT80 + ", " + MM_SQL.format(where=" WHERE idx < (SELECT floor(n * 0.8::DOUBLE) FROM nn)")
                                    + f" SELECT ts, idx, {SCALE} AS txn_count FROM s, mm", S_HOUR))
def q_minmax_transform_fitted(spark, d):
    """M6: fit on the train side, apply the saved fit to every row."""
    s = PR.temporal_split(hour_series(spark, d), 0.8)
    sc = PR.minmax_fit(s, ["txn_count"], where=F.col("split") == "train")
    return PR.minmax_apply(s.select("ts", "idx", "txn_count"), sc, ["txn_count"])


GRID_FEATS_SQL = """f AS (SELECT ts, idx, CAST(txn_count AS DOUBLE) AS txn_count, sin(2 * pi() * hour(ts) / 24) AS hour_sin,
       cos(2 * pi() * hour(ts) / 24) AS hour_cos,
       avg(CAST(txn_count AS DOUBLE)) OVER (ORDER BY idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS txn_ma_5 FROM s)"""


def _mm(c):
    return f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN {c} - min({c}) OVER () ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END AS {c}"


@query("minmax_all_numeric", w(GRID_FEATS_SQL + " SELECT ts, idx, " + ", ".join(_mm(c) for c in ("txn_count", "hour_sin", "hour_cos", "txn_ma_5")) + " FROM f"))
def q_minmax_all_numeric(spark, d):
    """M7: every numeric feature of the grid script scaled on its own (idx excluded)."""
    return PR.minmax_all_numeric(q_time_features_cyclic(spark, d), exclude=["idx"])


@query("minmax_inverse", w("SELECT ts, idx, CAST(txn_count AS DOUBLE) AS txn_count FROM s"))
def q_minmax_inverse(spark, d):
    """M8: scale, then back to counts (round trip)."""
    s = minute_series(spark, d)
    sc = PR.minmax_fit(s, ["txn_count"])
    return PR.minmax_inverse(PR.minmax_apply(s, sc, ["txn_count"]), sc, ["txn_count"])


# ================================================================ 2.J forecasts
@query("forecast_naive_last", w("SELECT *, CAST(lag(txn_count) OVER (ORDER BY idx) AS DOUBLE) AS predicted FROM s"))
def q_forecast_naive_last(spark, d):
    """O2."""
    return FC.forecast_naive_last(minute_series(spark, d))


@query("forecast_ar1", w(SPLIT80 + """, l AS (SELECT *, CAST(lag(txn_count) OVER (ORDER BY idx) AS DOUBLE) AS ylag FROM sp),
fit AS (SELECT regr_intercept(txn_count, ylag) AS a, regr_slope(txn_count, ylag) AS b FROM l WHERE split = 'train')
SELECT ts, idx, txn_count, CAST(floor((SELECT n FROM nn) * 0.8::DOUBLE) AS BIGINT) AS n_train, split, a + b * ylag AS predicted FROM l, fit""", S_HOUR))
def q_forecast_ar1(spark, d):
    """O3: AR(1) fitted on the train side of the hourly series."""
    return FC.forecast_ar1(PR.temporal_split(hour_series(spark, d), 0.8))


@query("fit_predict_lagged", w(Q.linear_ctes(60) + "\nSELECT idx, row, actual, predicted FROM pred60").replace("WITH", "WITH RECURSIVE", 1))
def q_fit_predict_lagged(spark, d):
    """Least squares on L=60 lag windows of the train minutes, predictions of the test windows."""
    blocks, fits = XP.lagged_linear(minute_series(spark, d), (60,))
    return LS.lagged_predictions(blocks, fits).drop("lookback")


LOOKBACKS = (10, 30, 60)


@query("fit_lagged_linear", w(",\n".join(Q.linear_ctes(k) for k in LOOKBACKS) + "\n" + " UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS lookback, CAST(unnest(range(0, {k + 1})) AS INTEGER) AS lag, unnest(c) AS coef FROM fit{k}"
    for k in LOOKBACKS), S_HOUR).replace("WITH", "WITH RECURSIVE", 1))
def q_fit_lagged_linear(spark, d):
    """Coefficients (lag 0: intercept) of the least-squares fits for lookbacks 10, 30 and 60 from one merged factor."""
    fits = XP.lagged_linear(hour_series(spark, d), LOOKBACKS)[1]
    return fits.select("lookback", F.posexplode(F.concat(F.array("intercept"), "coefs")).alias("lag", "coef"))


GRID_LINEAR = " UNION ALL ".join(
    f"SELECT {i} AS o, {k} AS lookback, * FROM pred{k}" for i, k in enumerate(LOOKBACKS))


@query("experiment_grid_linear", w(",\n".join(Q.linear_ctes(k) for k in LOOKBACKS) + f""",
p AS ({GRID_LINEAR})
SELECT 'linear' AS model, CAST(o AS INTEGER) AS run_order, CAST(lookback AS INTEGER) AS lookback, CAST(batch_size AS INTEGER) AS batch_size, count(*) AS n,
       avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse, {Q.MAPE_EPS} AS mape,
       'linear_lb' || lookback || '_b' || batch_size AS run_name
FROM p, (VALUES (32), (64)) b(batch_size) GROUP BY ALL""", S_HOUR).replace("WITH", "WITH RECURSIVE", 1))
def q_experiment_grid_linear(spark, d):
    """The linear model x lookbacks 10/30/60 x batch 32/64 on the hourly series, all fits from one pass."""
    return XP.ml_grid(hour_series(spark, d), ("linear",), LOOKBACKS).drop("error", "seconds")


@query("fit_predict_lagged_gbt")
def q_fit_predict_lagged_gbt(spark, d):
    """Gradient-boosted trees on L=24 windows of the hourly series (rows only)."""
    pred, _ = XP.fit_predict_lagged(hour_series(spark, d), 24, "gbt")
    return pred


W10 = "ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING"


@query("batch_score", w(f"""x AS (SELECT idx, CAST(txn_count AS DOUBLE) AS y, count(*) OVER (ORDER BY idx {W10}) AS c,
                     avg(CAST(txn_count AS DOUBLE)) OVER (ORDER BY idx {W10}) AS predicted FROM s)
SELECT idx, idx - 10 AS row, y, predicted FROM x WHERE c = 10"""))
def q_batch_score(spark, d):
    """A user model (mean of the window) applied in Arrow batches to L=10 windows."""
    win = WI.lookback_windows(minute_series(spark, d), lookback=10)
    return FC.batch_score(win, FC.mean_of_window_model, 10).select("idx", "row", "y", "predicted")


@query("batch_score_fitted", w(Q.linear_ctes(10) + "\nSELECT idx, row, actual AS y, predicted FROM pred10").replace("WITH", "WITH RECURSIVE", 1))
def q_batch_score_fitted(spark, d):
    """O5 with a fitted model: least squares on 10 lags of the train minutes, applied as a user model to batches of test windows."""
    s = minute_series(spark, d)
    fit = XP.lagged_linear(s, (10,))[1].first()
    model = FC.linear_model(fit.intercept, fit.coefs)
    win = WI.lookback_windows(PR.temporal_split(s, 0.8), lookback=10, split_col="split").where(F.col("split") == "test")
    return FC.batch_score(win, lambda: model, 10).select("idx", "row", "y", "predicted")


@query("walk_forward_tail", w("""nn AS (SELECT count(*) AS n FROM s),
t AS (SELECT ts, idx - greatest(n - 300, 0) AS idx, txn_count FROM s, nn WHERE idx >= greatest(n - 300, 0)),
m AS (SELECT ts, idx, CAST(txn_count AS DOUBLE) AS actual, """ + Q.MA3 + " AS predicted FROM t " + Q.MA3_WINDOWS + """)
SELECT ts, idx, actual, predicted, abs(predicted - actual) AS error FROM m WHERE idx >= 10"""))
def q_walk_forward_tail(spark, d):
    """Dashboard replay over the last 300 minutes, lookback 10."""
    return FC.walk_forward_tail(minute_series(spark, d), 300, 10)


@query("model_fallback", w(f"""x AS (SELECT idx, CAST(txn_count AS DOUBLE) AS actual,
       CASE WHEN count(*) OVER (ORDER BY idx {W10}) = 10 THEN avg(CAST(txn_count AS DOUBLE)) OVER (ORDER BY idx {W10}) END AS model_pred,
       """ + Q.MA3 + " AS baseline FROM s " + Q.MA3_WINDOWS + """)
SELECT idx, actual, model_pred, baseline, coalesce(model_pred, actual) AS predicted FROM x"""))
def q_model_fallback(spark, d):
    """Model where its window is full, else the actual itself (console policy)."""
    return FC.model_fallback(_model_and_baseline(spark, d), policy="console")


def _model_and_baseline(spark, d):
    s = minute_series(spark, d)
    win = WI.lookback_windows(s, lookback=10)
    mp = FC.batch_score(win, FC.mean_of_window_model, 10, out="model_pred").select("idx", "model_pred")
    base = FC.forecast_moving_avg(s, out="baseline")
    return base.join(mp, "idx", "left").select("idx", F.col("txn_count").cast("double").alias("actual"), "model_pred", "baseline")


@query("model_fallback_dashboard", w(f"""x AS (SELECT idx, CAST(txn_count AS DOUBLE) AS actual,
       CASE WHEN count(*) OVER (ORDER BY idx {W10}) = 10 THEN avg(CAST(txn_count AS DOUBLE)) OVER (ORDER BY idx {W10}) END AS model_pred,
       """ + Q.MA3 + " AS baseline FROM s " + Q.MA3_WINDOWS + """)
SELECT idx, actual, model_pred, baseline, coalesce(model_pred, baseline) AS predicted FROM x"""))
def q_model_fallback_dashboard(spark, d):
    """O8, dashboard policy: model where its window is full, else the baseline."""
    return FC.model_fallback(_model_and_baseline(spark, d), policy="dashboard")


@query("experiment_grid", w(SPLIT80 + """, nt AS (SELECT CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS n_train FROM nn),
l AS (SELECT *, CAST(lag(txn_count) OVER (ORDER BY idx) AS DOUBLE) AS ylag FROM sp),
fit AS (SELECT regr_intercept(txn_count, ylag) AS a, regr_slope(txn_count, ylag) AS b FROM l WHERE split = 'train'),
ma AS (SELECT idx, """ + Q.MA3 + """ AS p FROM s """ + Q.MA3_WINDOWS + """),
p AS (SELECT 'moving_avg' AS model, 0 AS run_order, l.idx, CAST(l.txn_count AS DOUBLE) AS actual, ma.p AS predicted FROM l JOIN ma USING (idx)
      UNION ALL SELECT 'naive', 1, idx, CAST(txn_count AS DOUBLE), ylag FROM l
      UNION ALL SELECT 'ar1', 2, idx, CAST(txn_count AS DOUBLE), a + b * ylag FROM l, fit),
cfg AS (SELECT * FROM (VALUES (10, 32), (10, 64), (30, 32), (30, 64), (60, 32), (60, 64)) t(lookback, batch_size))
SELECT model, CAST(run_order AS INTEGER) AS run_order, CAST(lookback AS INTEGER) AS lookback, CAST(batch_size AS INTEGER) AS batch_size,
       count(*) AS n, avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
       """ + Q.MAPE_EPS + """ AS mape
FROM p, cfg, nt WHERE idx >= n_train + lookback GROUP BY ALL""", S_HOUR))
def q_experiment_grid(spark, d):
    """3 baselines x lookbacks 10/30/60 x batch 32/64 on the hourly series."""
    return XP.experiment_grid(hour_series(spark, d))


@query("experiment_grid_ml", w(",\n".join(Q.linear_ctes(k) for k in LOOKBACKS) + f""",
p AS ({GRID_LINEAR})
SELECT 'linear' AS model, CAST(o AS INTEGER) AS run_order, CAST(lookback AS INTEGER) AS lookback, CAST(batch_size AS INTEGER) AS batch_size, count(*) AS n,
       avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
       'linear_lb' || lookback || '_b' || batch_size AS run_name
FROM p, (VALUES (32), (64)) b(batch_size) GROUP BY ALL""").replace("WITH", "WITH RECURSIVE", 1))
def q_experiment_grid_ml(spark, d):
    """O9 at minute grain (without mape, which zero actuals blow up to 1e15, and the run's seconds)."""
    return XP.ml_grid(minute_series(spark, d), ("linear",), LOOKBACKS).drop("error", "seconds", "mape")


ALIGN_SQL = w(f"""nn AS (SELECT CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS nt FROM s),
t AS (SELECT idx - nt AS pos, ts, CAST(txn_count AS DOUBLE) AS actual,
             avg(CAST(txn_count AS DOUBLE)) OVER (ORDER BY idx {W10}) AS predicted FROM s, nn WHERE idx >= nt)
SELECT pos, ts, actual, predicted FROM t WHERE pos >= 10""")


def _aligned(spark, d):
    s = PR.temporal_split(minute_series(spark, d), 0.8)
    test = s.where(F.col("split") == "test")
    win = WI.lookback_windows(test, lookback=10)
    preds = FC.batch_score(win, FC.mean_of_window_model, 10)
    return FC.align_predictions(test, preds, 10)


@query("align_predictions", ALIGN_SQL)
def q_align_predictions(spark, d):
    """Predictions paired with actuals by index (test windows L=10)."""
    return _aligned(spark, d)


@query("zoom_first_100", ALIGN_SQL.replace("WHERE pos >= 10", "WHERE pos >= 10 AND pos < 110"))
def q_zoom_first_100(spark, d):
    """The first 100 aligned pairs."""
    return FC.zoom_first(_aligned(spark, d), 100, lookback=10)


# ================================================================ 2.K evaluation
@query("evaluate_metrics", REPLAY_H + f"""
SELECT model, count(*) AS n, avg(actual) AS avg_actual, avg(abs(predicted - actual)) AS mae,
       sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse, {Q.MAPE_RAW} AS mape_raw, {Q.MAPE_EPS} AS mape_eps,
       {Q.MAPE_NZ} AS mape_nonzero, {Q.WAPE} AS wape FROM pr GROUP BY model""")
def q_evaluate_metrics(spark, d):
    """E1-E5 on the hourly replay."""
    return EV.evaluate(hour_replay(spark, d))


@query("improvement_over_naive", REPLAY_H + """,
nv AS (SELECT idx, CAST(lag(txn_count) OVER (ORDER BY idx) AS DOUBLE) AS naive FROM s),
j AS (SELECT pr.actual, pr.predicted, nv.naive FROM pr JOIN nv USING (idx) WHERE nv.naive IS NOT NULL)
SELECT avg(abs(predicted - actual)) AS mae, avg(abs(naive - actual)) AS mae_naive,
       (avg(abs(naive - actual)) - avg(abs(predicted - actual))) / avg(abs(naive - actual)) * 100 AS improvement_pct FROM j""")
def q_improvement_over_naive(spark, d):
    """Moving average vs last value on the hourly replay."""
    s = hour_series(spark, d)
    ma = FC.walk_forward(s, "moving_avg")
    nv = FC.walk_forward(s, "naive")
    return EV.improvement_over_naive(ma, nv)


LB_SQL = w(SPLIT80.replace("0.8::DOUBLE", "(1 - 0.1::DOUBLE)") + """,
l AS (SELECT *, CAST(lag(txn_count) OVER (ORDER BY idx) AS DOUBLE) AS ylag FROM sp),
fit AS (SELECT regr_intercept(txn_count, ylag) AS a, regr_slope(txn_count, ylag) AS b FROM l WHERE split = 'train'),
ma AS (SELECT idx, """ + Q.MA3 + """ AS p FROM s """ + Q.MA3_WINDOWS + """),
p AS (SELECT 'Baseline (Moving Avg)' AS model, 0 AS run_order, l.idx, l.split, CAST(l.txn_count AS DOUBLE) AS actual, ma.p AS predicted FROM l JOIN ma USING (idx)
      UNION ALL SELECT 'Naive (last value)', 1, idx, split, CAST(txn_count AS DOUBLE), ylag FROM l
      UNION ALL SELECT 'AR(1)', 2, idx, split, CAST(txn_count AS DOUBLE), a + b * ylag FROM l, fit),
b AS (SELECT model, CAST(min(run_order) AS INTEGER) AS run_order, count(*) AS n, avg(actual) AS avg_actual, avg(abs(predicted - actual)) AS mae,
       sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse, """ + Q.MAPE_RAW.replace("\n", " ") + """ AS mape_raw,
       """ + Q.MAPE_EPS + " AS mape_eps, " + Q.MAPE_NZ + " AS mape_nonzero, " + Q.WAPE + """ AS wape
      FROM p WHERE split = 'test' GROUP BY model)""", S_HOUR)


def _board(spark, d):
    s = hour_series(spark, d)
    preds = None
    for i, m in enumerate(("moving_avg", "naive", "ar1")):
        p = FC.walk_forward(s, m).withColumn("run_order", F.lit(i))
        preds = p if preds is None else preds.unionByName(p)
    return EV.leaderboard(preds)


@query("leaderboard", LB_SQL + " SELECT * FROM b")
def q_leaderboard(spark, d):
    """One metric row per model (hourly replay of 3 baselines)."""
    return _board(spark, d)


@query("leaderboard_timed", LB_SQL + " SELECT model, run_order, n, mae, rmse, wape, true AS timed FROM b")
def q_leaderboard_timed(spark, d):
    """E8 with the time of each model (here only that there is one: seconds differ from run to run)."""
    s = hour_series(spark, d)
    board = EV.timed_leaderboard([(m, lambda m=m: FC.walk_forward(s, m)) for m in ("moving_avg", "naive", "ar1")])
    return board.select("model", "run_order", "n", "mae", "rmse", "wape", (F.col("seconds") > 0).alias("timed"))


@query("best_model", LB_SQL + " SELECT arg_min(model, (mae, run_order)) AS best_model, min(mae) AS best_mae FROM b")
def q_best_model(spark, d):
    """Lowest MAE, first in run order on ties."""
    return EV.best_model(_board(spark, d))


# ================================================================ 2.A sources / sinks
EV_COLS = "event_id, ts, user_id, event_type, value, props"


@query("read_events_csv", f"SELECT {EV_COLS} FROM events")
def q_read_events_csv(spark, d):
    """Events written as CSV (header) by Spark, scanned back with a schema."""
    ev = events(spark, d)
    path = scratch(spark, "events-csv")
    IO.write_table(ev, path, fmt="csv")
    return IO.read_table(spark, path, fmt="csv", schema=ev.schema)


@query("read_events_limit_small", "SELECT * FROM events ORDER BY event_id LIMIT 1000")
def q_read_events_limit_small(spark, d):
    """The first 1,000 events by id (the limit is the feature)."""
    return IO.first_rows_by(events(spark, d), 1000, "event_id")


def mixed_text():
    """Four text layouts of the event time, chosen by id (every row is kept)."""
    return F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")) \
        .when(F.col("event_id") % 4 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+02:00"))) \
        .when(F.col("event_id") % 4 == 2, F.date_format("ts", "MM/dd/yyyy HH:mm:ss")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))


@query("parse_timestamp_mixed", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts
       WHEN 2 THEN date_trunc('second', ts) ELSE CAST(date_trunc('day', ts) AS TIMESTAMP) END AS timestamp FROM events""")
def q_parse_timestamp_mixed(spark, d):
    """S3: four text layouts (ISO T/Z, offset, US date-time, date only) parsed per row."""
    t = events(spark, d).select("event_id", mixed_text().alias("timestamp"))
    return TP.parse_timestamp(t, "timestamp")


@query("parse_timestamp_iso", "SELECT event_id, ts AS timestamp FROM events")
def q_parse_timestamp_iso(spark, d):
    """Strict ISO-8601 text parsed back."""
    t = events(spark, d).select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))
    return TP.parse_timestamp_iso(t, "timestamp")


@query("strip_timezone", "SELECT event_id, ts AS timestamp FROM events")
def q_strip_timezone(spark, d):
    """Offsets dropped, wall clock kept."""
    off = F.when(F.col("event_id") % 2 == 0, F.lit("+02:00")).otherwise(F.lit("-05:30"))
    t = events(spark, d).select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), off).alias("timestamp"))
    return TP.parse_timestamp(t, "timestamp")


@query("write_predictions", REPLAY_M + "\nSELECT ts AS timestamp, actual AS actual_tps, predicted AS predicted_tps, error FROM pr")
def q_write_predictions(spark, d):
    """The replay's prediction table written to Parquet and read back."""
    p = minute_replay(spark, d).select(F.col("ts").alias("timestamp"), F.col("actual").alias("actual_tps"),
                                        F.col("predicted").alias("predicted_tps"), "error")
    return IO.write_and_read_back(p, scratch(spark, "predictions"))


@query("write_processed_series", w(f"""r AS (SELECT ts AS timestamp, txn_count AS tps, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, dayname(ts) AS day_name, CAST(ts AS DATE) AS date,
       isodow(ts) >= 6 AS is_weekend, {ROLL_SQL} FROM s {ROLL_W}) SELECT * FROM r"""))
def q_write_processed_series(spark, d):
    """The enriched series written partitioned by date, read back."""
    s = minute_series(spark, d)
    f = CA.add_time_features(s, ("hour", "day_of_week", "day_name", "date", "is_weekend_bool"))
    r = WI.rolling_mean_std(f)
    out = r.select(F.col("ts").alias("timestamp"), F.col("txn_count").alias("tps"), "hour", "day_of_week", "day_name",
                   "date", "is_weekend", "rolling_mean", "rolling_std")
    back = IO.write_and_read_back(out, scratch(spark, "processed"), partition_by=["date"])
    return back.select(*out.columns)


@query("write_profile_summary", PROFILE_SUMMARY_SQL)
def q_write_profile_summary(spark, d):
    """The summary row (all 13 fields) written as CSV and read back."""
    s = PRR.profile_summary(events(spark, d), with_adf=True)
    return IO.write_and_read_back(s, scratch(spark, "summary"), fmt="csv")


_grid = ORACLES["experiment_grid"]
_at = _grid.rindex("SELECT model, CAST(run_order")
RUN_LOG_SQL = _grid[:_at].rstrip() + ",\ngrid AS (" + _grid[_at:] + """),
k AS (SELECT count(*) || ':' || min(epoch_us(ts)) || ':' || max(epoch_us(ts)) AS input_key FROM events),
pa AS (SELECT left(sha256('Transaction_Load_Forecasting|' || input_key), 32) AS parent FROM k)
SELECT left(sha256(concat_ws('|', parent, model, lookback, batch_size)), 32) AS run_id, parent AS parent_run_id,
       concat_ws('_', model, lookback, batch_size) AS run_name, n::DOUBLE AS n, mae, rmse, mape, NULL::DOUBLE AS runs, true AS timed FROM grid, pa
UNION ALL SELECT parent, NULL, 'Transaction_Load_Forecasting', NULL, NULL, NULL, NULL, (SELECT count(*) FROM grid)::DOUBLE, true FROM pa"""


@query("run_log_append", RUN_LOG_SQL)
def q_run_log_append(spark, d):
    """Grid results in the run table under one parent, logged twice: the second time adds nothing."""
    import time
    path, ev = scratch(spark, "runs"), events(spark, d)
    t0 = time.time()
    grid = materialize(XP.experiment_grid(hour_series(spark, d)))
    grid = grid.withColumn("seconds", F.lit((time.time() - t0) / 18))                     # of each of the 18 runs
    for _ in range(2):
        IO.append_runs(IO.run_records(grid, IO.input_key(ev), "Transaction_Load_Forecasting", f"{d}/events.parquet",
                                      ["model", "lookback", "batch_size"], ["mae", "rmse", "mape", "n"]), path)
    r = IO.read_runs(spark, path)
    return r.select("run_id", "parent_run_id", "run_name", *[F.col("metrics")[c].alias(c) for c in ("n", "mae", "rmse", "mape", "runs")],
                    (F.col("seconds") > 0).alias("timed"))


@query("model_save_load", w(Q.linear_ctes(10) + """
SELECT idx, actual AS y, predicted, true AS same_as_before FROM pred10""").replace("WITH", "WITH RECURSIVE", 1))
def q_model_save_load(spark, d):
    """Fit, save with its lookbacks, reload, score the test windows, and compare with the scores before."""
    blocks, fits = XP.lagged_linear(minute_series(spark, d), (10,))
    path = scratch(spark, "model")
    IO.save_fits(fits, path)
    before = LS.lagged_predictions(blocks, fits).select("idx", F.col("predicted").alias("before"))
    after = LS.lagged_predictions(blocks, IO.load_fits(spark, path))
    return after.join(before, "idx").select("idx", F.col("actual").alias("y"), "predicted",
                                            (F.col("predicted") == F.col("before")).alias("same_as_before"))


@query("network_save_load")
def q_network_save_load(spark, d):
    """S10 for a recurrent network: saved with cell, lookback, columns and scaler, reloaded, test windows scored (no SQL: the
    equality with the scores before saving is a test)."""
    model, blocks = _network(spark, d)
    path = scratch(spark, "network")
    IO.save_network(spark, model, path)
    return RC.predict_recurrent(IO.load_network(spark, path), blocks)


NETWORK_COLS = ("txn_count", "hour_sin", "hour_cos", "txn_ma_5")


def _network(spark, d, cell="gru", epochs=3):
    s = CA.add_time_features(SE.rename_cast(minute_series(spark, d)), ("hour_sin", "hour_cos"))
    return RC.fit_recurrent(WI.moving_average(s, "txn_count", 5), NETWORK_COLS, lookback=30, cell=cell, units=8, epochs=epochs, rate=0.02)


@query("fit_predict_recurrent")
def q_fit_predict_recurrent(spark, d):
    """GRU on four scaled columns, L=30, trained data-parallel on all train windows of the minute series, with a validation tail;
    predictions of all test windows (no SQL; compared with one process in the tests)."""
    model, blocks = _network(spark, d)
    return RC.predict_recurrent(model, blocks)


@query("fit_recurrent_history")
def q_fit_recurrent_history(spark, d):
    """Loss, validation loss and step size of each epoch of an LSTM (no SQL)."""
    return RC.history_table(spark, _network(spark, d, "lstm")[0])


# ================================================================ 2.L streaming
from ratecast.streaming import live as LV  # noqa: E402

from ratecast.streaming import ledger as LG  # noqa: E402

STREAM_FC_SQL = w(f"""m AS (SELECT ts, CAST(txn_count AS DOUBLE) AS actual, {Q.MA3} AS predicted, idx FROM s {Q.MA3_WINDOWS}),
r AS (SELECT ts, actual, predicted, abs(predicted - actual) AS error, row_number() OVER o AS k,
             avg(abs(predicted - actual)) OVER o AS a1, sqrt(avg((predicted - actual) * (predicted - actual)) OVER o) AS a2,
             avg(CASE WHEN actual = 0 AND predicted - actual = 0 THEN 'NaN'::DOUBLE WHEN actual = 0 THEN 'Infinity'::DOUBLE
                      ELSE abs((predicted - actual) / actual) END) OVER o * 100 AS a3
      FROM m WINDOW o AS (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT ts, actual, predicted, error, CASE WHEN k > 1 THEN a1 END AS running_mae, CASE WHEN k > 1 THEN a2 END AS running_rmse,
       CASE WHEN k > 1 THEN a3 END AS running_mape FROM r""")
LIVE_COLS = ("ts", "actual", "predicted", "error", "running_mae", "running_rmse", "running_mape")
END = "end of feed"


def _live(spark, d, parts, keys=(), table="bins"):
    """The events as a live feed that arrives in ``parts`` (conditions on ``ts`` and ``m``, the middle of the log), each followed by a run
    that stops and, but for the first, goes on from the checkpoint; the last part brings the mark of the feed's end."""
    ev = events(spark, d)
    span = ev.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(
        (F.col("a") + (F.col("b") - F.col("a")) / 2).alias("m"), (F.date_trunc("minute", "b") + F.expr("INTERVAL 1 MINUTE")).alias("end"))
    src, out, ck = (scratch(spark, f"live-{x}") for x in ("src", "out", "ckpt"))
    feed = LG.Feed(out, tuple(keys), mark=f"event_type = '{END}'")
    for i, part in enumerate(parts):
        rows = ev.crossJoin(F.broadcast(span)).where(part).select(*ev.columns)
        rows.write.mode("append").parquet(src)
        if i == len(parts) - 1:
            _mark_row(span, ev).write.mode("append").parquet(src)
        LG.run_feed(LV.event_stream(spark, src, ev.schema), feed, ck)
    return LG.read_feed(spark, out, table)


def _mark_row(span, ev):
    """The end mark: a row of the feed's schema at ``end``, all else null but the event type."""
    known = {"ts": F.col("end"), "event_type": F.lit(END)}
    return span.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ev.schema.fields])


@query("stream_resample", "SELECT date_trunc('minute', ts) AS ts, count(*) AS txn_count FROM events GROUP BY 1")
def q_stream_resample(spark, d):
    """L1: the events as a live feed counted by minute (watermark 0 s). A mark row at the end of the last minute passes the watermark
    over it, so the last minute is returned too (the mark's own minute never closes)."""
    ev = events(spark, d)
    src, out, ck = scratch(spark, "l1-src"), scratch(spark, "l1-out"), scratch(spark, "l1-ckpt")
    span = ev.agg((F.date_trunc("minute", F.max("ts")) + F.expr("INTERVAL 1 MINUTE")).alias("end"))
    ev.write.mode("append").parquet(src)
    _mark_row(span, ev).write.mode("append").parquet(src)
    LV.run_to_table(LV.stream_resample(LV.event_stream(spark, src, ev.schema), "0 seconds"), out, ck)
    return spark.read.parquet(out)


@query("stream_forecast", STREAM_FC_SQL)
def q_stream_forecast(spark, d):
    """L2 + L3: every closed minute (empty ones too) with its one-step forecast and the running errors, of one series over many tasks."""
    return _live(spark, d, ["true", "false"]).select(*LIVE_COLS)


@query("stream_resume", STREAM_FC_SQL)
def q_stream_resume(spark, d):
    """L4: the feed arrives in two halves; the second run goes on from the checkpoint and the carried values (result
    equal to one uninterrupted run)."""
    return _live(spark, d, ["ts < m", "ts >= m"]).select(*LIVE_COLS)


@query("stream_late_events", """WITH m AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS m, max(date_trunc('minute', ts)) AS last FROM events)
SELECT event_id, ts, user_id, event_type, value FROM events, m WHERE ts < m AND date_trunc('minute', ts) < last""")
def q_stream_late_events(spark, d):
    """The second half of the feed arrives first; after a restart the first half comes too late, and its rows are kept in
    the table of late events, each once."""
    return _live(spark, d, ["ts >= m", "ts < m"], table="late").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value")


@query("stream_late_data", """WITH m AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS m FROM events)
SELECT count(*) AS input_rows, count(*) FILTER (WHERE ts < m) AS late_rows FROM events, m""")
def q_stream_late_data(spark, d):
    """The second half of the feed arrives first, then the first half arrives late and
    is dropped by the watermark: events read and late events dropped, over all micro-batches."""
    ev = events(spark, d)
    mid = ev.agg(F.min("ts").alias("a"), F.max("ts").alias("b")) \
        .select((F.col("a") + (F.col("b") - F.col("a")) / 2).alias("m"))
    src, out, ck = scratch(spark, "l5-src"), scratch(spark, "l5-out"), scratch(spark, "l5-ckpt")
    halves = ev.crossJoin(F.broadcast(mid))
    reports = []
    for late in (False, True):
        halves.where((F.col("ts") < F.col("m")) == F.lit(late)).drop("m").write.mode("append").parquet(src)
        minutes = LV.stream_resample(LV.event_stream(spark, src, ev.schema), "0 seconds", unique=["event_id"])
        reports += LV.dropped_by_watermark(LV.run_to_table(minutes, out, ck))
    total = [(sum(r[1] for r in reports), sum(r[2] for r in reports))]
    return spark.createDataFrame(total, "input_rows long, late_rows long")


# ================================================================ single-operator names (2.F, 2.K, 2.L)
def _with_col(name, col_fn):
    def fn(spark, d):
        s = minute_series(spark, d)
        return s.withColumn(name, col_fn())
    return fn


for _name, _sqlexpr, _fn in [
    ("feat_hour", "CAST(hour(ts) AS INTEGER)", lambda: CA.hour("ts")),
    ("feat_day_of_week", "CAST(isodow(ts) - 1 AS INTEGER)", lambda: CA.day_of_week("ts")),
    ("feat_is_weekend", "CAST(isodow(ts) >= 6 AS INTEGER)", lambda: CA.is_weekend("ts")),
    ("feat_day_name", "dayname(ts)", lambda: CA.day_name("ts")),
    ("feat_date", "CAST(ts AS DATE)", lambda: CA.calendar_date("ts")),
]:
    query(_name, w(f"SELECT *, {_sqlexpr} AS {_name[5:]} FROM s"))(_with_col(_name[5:], _fn))


@query("feat_hour_cyclic", w("SELECT ts, idx, txn_count, sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos FROM s"))
def q_feat_hour_cyclic(spark, d):
    """C6."""
    return CA.add_time_features(minute_series(spark, d), ("hour_sin", "hour_cos"))


@query("abs_error", REPLAY_H + "\nSELECT idx, actual, predicted, abs(predicted - actual) AS abs_error FROM pr")
def q_abs_error(spark, d):
    """C7."""
    return hour_replay(spark, d).select("idx", "actual", "predicted", MT.abs_error().alias("abs_error"))


@query("ape_guarded", REPLAY_M + "\nSELECT idx, actual, predicted, CASE WHEN actual > 0 THEN abs(predicted - actual) / actual * 100 ELSE 0.0 END AS ape_guarded FROM pr")
def q_ape_guarded(spark, d):
    """C8 (minute grain: zero actuals give 0)."""
    return minute_replay(spark, d).select("idx", "actual", "predicted", MT.ape_guarded().alias("ape_guarded"))


@query("lag_label", """SELECT lag, CASE WHEN lag >= 1440 THEN CAST(lag // 1440 AS VARCHAR) || ' day' WHEN lag >= 60 THEN CAST(lag // 60 AS VARCHAR) || ' hr'
       ELSE CAST(lag AS VARCHAR) || ' min' END AS lag_label
FROM (SELECT CAST(date_diff('minute', (SELECT min(date_trunc('minute', ts)) FROM events), date_trunc('minute', ts)) AS BIGINT) AS lag FROM events)""")
def q_lag_label(spark, d):
    """Every event's minute offset from the first minute, as a lag label."""
    from ratecast.functions.timecols import to_micros
    us = to_micros(F.col("ts"))
    ev = events(spark, d).select((us - F.pmod(us, F.lit(60_000_000))).alias("_m"))
    lo = ev.agg(F.min("_m").alias("_lo"))
    lag = ((F.col("_m") - F.col("_lo")) / 60_000_000).cast("long")
    return ev.crossJoin(F.broadcast(lo)).select(lag.alias("lag")).withColumn("lag_label", CA.lag_label("lag"))


for _name, _sql, _fn in [
    ("metric_mae", "avg(abs(predicted - actual))", MT.mae),
    ("metric_rmse", "sqrt(avg((predicted - actual) * (predicted - actual)))", MT.rmse),
    ("metric_mape_eps", Q.MAPE_EPS, MT.mape_eps),
    ("metric_mape_raw", Q.MAPE_RAW, MT.mape_raw),
    ("metric_wape", Q.WAPE, MT.wape),
]:
    query(_name, REPLAY_H + f"\nSELECT model, {_sql} AS {_name[7:]} FROM pr GROUP BY model")(
        (lambda f, nm: lambda spark, d: hour_replay(spark, d).groupBy("model").agg(f().alias(nm)))(_fn, _name[7:]))


@query("metric_mape_raw_minute", REPLAY_M + f"\nSELECT model, {Q.MAPE_RAW} AS mape_raw FROM pr GROUP BY model")
def q_metric_mape_raw_minute(spark, d):
    """E4 at minute grain: NaN (0/0 and x/0 both occur)."""
    return minute_replay(spark, d).groupBy("model").agg(MT.mape_raw().alias("mape_raw"))


@query("stream_running_metrics", STREAM_FC_SQL.replace("SELECT ts, actual, predicted, error, CASE", "SELECT ts, CASE"))
def q_stream_running_metrics(spark, d):
    """L3: the running metrics of the live forecaster."""
    return q_stream_forecast(spark, d).select("ts", "running_mae", "running_rmse", "running_mape")


# every type's series goes on with zeros to the end of the whole feed
STREAM_FC_KEYED_SQL = w(f"""m AS (SELECT event_type, ts, idx, CAST(txn_count AS DOUBLE) AS actual,
       CASE WHEN count(txn_count) OVER k3 = 3 THEN avg(CAST(txn_count AS DOUBLE)) OVER k3
            WHEN count(txn_count) OVER k3 > 0 THEN CAST(lag(txn_count) OVER ko AS DOUBLE) ELSE 0.0 END AS predicted
       FROM s WINDOW ko AS (PARTITION BY event_type ORDER BY idx),
                     k3 AS (PARTITION BY event_type ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
r AS (SELECT event_type, ts, actual, predicted, abs(predicted - actual) AS error, row_number() OVER o AS k,
             CAST(avg(CAST(abs(predicted - actual) AS DECIMAL(38, 18))) OVER o AS DOUBLE) AS a1,
             sqrt(CAST(avg(CAST((predicted - actual) * (predicted - actual) AS DECIMAL(38, 18))) OVER o AS DOUBLE)) AS a2,
             avg(CASE WHEN actual = 0 AND predicted - actual = 0 THEN 'NaN'::DOUBLE WHEN actual = 0 THEN 'Infinity'::DOUBLE
                      ELSE abs((predicted - actual) / actual) END) OVER o * 100 AS a3
      FROM m WINDOW o AS (PARTITION BY event_type ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_type, ts, actual, predicted, error, CASE WHEN k > 1 THEN round(a1, 9) END AS running_mae,
       CASE WHEN k > 1 THEN round(a2, 9) END AS running_rmse, CASE WHEN k > 1 THEN a3 END AS running_mape FROM r""",
    Q.series_cte(keys=("event_type",)).replace("max(b) AS hi FROM s_c", "(SELECT max(b) FROM s_c) AS hi FROM s_c"))


@query("stream_forecast_by_type", STREAM_FC_KEYED_SQL)
def q_stream_forecast_by_type(spark, d):
    """L2 + L3 with keys: a series for each event type, closed together by the feed's watermark (means of thirds are
    often ties in the sixth place, so both sides round to nine)."""
    live = _live(spark, d, ["ts < m", "ts >= m"], ("event_type",)).select("event_type", *LIVE_COLS)
    return live.withColumns({c: F.round(c, 9) for c in ("running_mae", "running_rmse")})


