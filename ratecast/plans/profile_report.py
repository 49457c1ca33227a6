"""The profile script's summary row (T11) and rule table (A11), as one-row joins of
one-row aggregates (broadcast nested-loop joins of single rows)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.functions.calendar import add_time_features
from ratecast.operators import patterns as PT
from ratecast.operators import stats as ST
from ratecast.operators.profile import drop_duplicates
from ratecast.operators.series import resample_count, series_stats, zero_bins
from ratecast.session import materialize


def _row(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.crossJoin(F.broadcast(d))
    return out


def profile_summary(events: DataFrame, freq: str = "1 minute", with_adf: bool = False,
                    ts: str = "ts") -> DataFrame:
    """total_records (after dedupe), total bins, mean/std/min/max of the count,
    zero bins, IQR outlier %, peak and low hour, recommended lookback; plus the ADF
    p-value and verdict with ``with_adf``."""
    dedup = drop_duplicates(events)
    series = materialize(resample_count(dedup, ts=ts, freq=freq).withColumnRenamed("txn_count", "tps"))
    feats = add_time_features(series, ("hour",))
    total = dedup.agg(F.count(F.lit(1)).alias("total_records"))
    st = series_stats(series, "tps").select(
        F.col("n_bins").alias("total_minutes"), F.col("mean").alias("mean_tps"), F.col("std").alias("std_tps"),
        F.col("min").alias("min_tps"), F.col("max").alias("max_tps"))
    zb = zero_bins(series, "tps").select(F.col("zero_bins").alias("zero_minutes"))
    out = ST.iqr_outliers(series, "tps").select(F.col("outlier_pct").alias("outliers_pct"))
    ph = PT.peak_low_hour(PT.hourly_stats(feats, "tps")).select("peak_hour", "low_hour")
    lb = ST.recommended_lookback(ST.acf(series, range(100), "tps")).select("recommended_lookback")
    parts = [total, st, zb, out, ph, lb]
    if with_adf:
        adf = ST.adf_test(series, "tps").select(F.col("p_value").alias("adf_pvalue"),
                                                 (F.col("p_value") < 0.05).alias("is_stationary"))
        parts.append(adf)
    return _row(*parts)


def recommendations(events: DataFrame, freq: str = "1 minute", with_adf: bool = False,
                    ts: str = "ts") -> DataFrame:
    """The rule table ``(rule_id, rule, metric, metric2, threshold, triggered)``."""
    series = materialize(resample_count(events.dropDuplicates(), ts=ts, freq=freq))
    feats = add_time_features(series, ("hour",))
    st = series_stats(series).select(F.col("cv"))
    out = ST.iqr_outliers(series).select("outlier_pct")
    hv = PT.hourly_variation(PT.hourly_stats(feats)).select((F.col("hourly_range_pct") / 100).alias("h_ratio"))
    wd = PT.busiest_quietest_day(PT.weekday_stats(series)).select((F.col("weekly_range_pct") / 100).alias("d_ratio"))
    lb = ST.recommended_lookback(ST.acf(series, range(100))).select("max_significant_lag", "recommended_lookback")
    parts = [st, out, hv, wd, lb]
    if with_adf:
        parts.append(ST.adf_test(series).select(F.col("p_value").alias("adf_p")))
    row = _row(*parts)
    rules = [
        (1, "normalization", F.col("cv"), F.lit(None).cast("double"), 0.3, F.col("cv") > 0.3),
        (3, "outlier_handling", F.col("outlier_pct"), F.lit(None).cast("double"), 2.0, F.col("outlier_pct") > 2),
        (4, "feature_engineering", F.col("h_ratio"), F.col("d_ratio"), 0.2,
         (F.col("h_ratio") > 0.2) | (F.col("d_ratio") > 0.1)),
        (5, "lookback_window", F.col("recommended_lookback").cast("double"),
         F.col("max_significant_lag").cast("double"), 0.2, F.lit(True)),
        (6, "temporal_split", F.lit(None).cast("double"), F.lit(None).cast("double"), 0.0, F.lit(True)),
    ]
    if with_adf:
        rules.insert(1, (2, "differencing", F.col("adf_p"), F.lit(None).cast("double"), 0.05, F.col("adf_p") >= 0.05))
    structs = [F.struct(F.lit(i).alias("rule_id"), F.lit(n).alias("rule"), m.cast("double").alias("metric"),
                        m2.alias("metric2"), F.lit(float(t)).alias("threshold"),
                        F.coalesce(c, F.lit(False)).alias("triggered")) for i, n, m, m2, t, c in rules]
    return row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
