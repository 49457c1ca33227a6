"""Statistical analytics.

ACF and the ADF regression are sums of lagged products, so each halo block emits only
partial sums (a few numbers per lag or per Gram-matrix cell) and Spark adds them up.
Small solves (the ADF normal equations, at most about 60 unknowns per key) run in
``applyInPandas`` grouped by key, not on the driver.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.functions.calendar import lag_label
from ratecast.operators.keyjoin import join_keys
from ratecast.operators import leastsq as LS
from ratecast.operators.blocks import MIN_BLOCK, with_halo
from ratecast.operators.series import attach, series_length

KEY_LAGS = (1, 5, 10, 15, 30, 60, 120, 1440)


# ----------------------------------------------------------------------------------
# autocorrelation
# ----------------------------------------------------------------------------------
FFT_LAGS = 64     # from so many lags on, products of a block are taken by Fourier transforms


def lagged_products(x: np.ndarray, h0: int, lags: Sequence[int]) -> list[float]:
    """``sum(x[i] * x[i - k] for i >= h0)`` for each k of ``lags``; terms before the first value count 0.

    Overlap-save: the own values (from ``h0`` on) are correlated with the block and its halo in segments of a power of
    two, so K lags of n values cost O(n log K). Integers up to 2**20 or so come out exact to 1e-9."""
    m = len(x)
    if len(lags) < FFT_LAGS:
        return [float(np.dot(x[max(h0, k):], x[max(h0, k) - k:m - k])) if max(h0, k) < m else 0.0 for k in lags]
    kmax = int(max(lags))
    size = 1 << max(10, int(np.ceil(np.log2(4 * (kmax + 1)))))
    step, total = size - kmax, np.zeros(kmax + 1)
    for a in range(h0, m, step):
        own = x[a:min(a + step, m)]
        lo = max(a - kmax, 0)
        seg = np.zeros(kmax + len(own))
        seg[kmax - (a - lo):] = x[lo:a + len(own)]                   # zeros before the first value
        # c[j] = sum_i own[i] * seg[i + j]; lag k is j = kmax - k, no index wraps as kmax + step <= size
        c = np.fft.irfft(np.fft.rfft(seg, size) * np.conj(np.fft.rfft(own, size)), size)
        total += c[kmax::-1][:kmax + 1]
    return [float(total[k]) for k in lags]


def _acf_block_fn(keys: list[str], lags: list[int]):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        x = pdf["_x"].to_numpy(dtype="float64")
        own = (pdf["_own"].to_numpy() == pdf["_blk"].to_numpy())
        h0 = int(np.argmax(own)) if own.any() else len(x)
        # own row i pairs with row i-k; the halo (>= max lag rows) keeps it in the block
        res = pd.DataFrame({"lag": lags, "sxy": lagged_products(x, h0, lags)})
        res["sxx"] = float(np.dot(x[h0:], x[h0:]))
        for c in keys:
            res[c] = pdf[c].iloc[0]
        return res[[*keys, "lag", "sxy", "sxx"]]
    return fn


def acf(series: DataFrame, lags: Sequence[int] = tuple(range(101)), col: str = "txn_count",
        keys: Sequence[str] = ()) -> DataFrame:
    """A1/A2: biased autocorrelation (full-series mean, lag-0 denominator) at each lag
    below the series length: ``keys.., lag, acf``. NaN for a constant series."""
    keys = list(keys)
    lags = sorted(set(int(l) for l in lags) | {0})
    kmax = max(lags)
    mean = series.groupBy(*keys).agg(F.avg(F.col(col).cast("double")).alias("_mu"),
                                     (F.max("idx") + 1).alias("_n"))
    x = attach(series, mean, keys).select(*keys, "idx", (F.col(col) - F.col("_mu")).alias("_x"))
    b = max(8 * kmax, MIN_BLOCK)
    h = with_halo(x, kmax, b)
    schema = ", ".join([f"{c} {series.schema[c].dataType.simpleString()}" for c in keys] +
                       ["lag int", "sxy double", "sxx double"])
    parts = h.groupBy(*keys, "_blk").applyInPandas(_acf_block_fn(keys, lags), schema)
    # each row also carries its block's lag-0 product, so one pass gives the denominator too
    sums = parts.groupBy(*keys, "lag").agg(F.sum("sxy").alias("sxy"), F.sum("sxx").alias("_den"))
    r = attach(sums, mean.select(*keys, "_n"), keys).where(F.col("lag") < F.col("_n"))
    val = F.when(F.col("_den") == 0, F.lit(float("nan"))).otherwise(F.col("sxy") / F.col("_den"))
    return r.select(*keys, "lag", val.alias("acf"))


def acf_key_lags(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (),
                 lags: Sequence[int] = KEY_LAGS) -> DataFrame:
    """A1 (+ C10): ACF at the key lags, with a readable label."""
    a = acf(series, lags, col, keys)
    return a.where(F.col("lag").isin(list(lags))).withColumn("lag_label", lag_label("lag"))


def recommended_lookback(acf_df: DataFrame, keys: Sequence[str] = (), below: int = 100,
                         threshold: float = 0.2, cap: int = 1440, default: int = 10) -> DataFrame:
    """A3: the largest lag below ``below`` with |acf| > ``threshold`` (lag 0 included,
    as in the reference), the suggested range r .. 2r, maximum min(3r, cap), and the
    lookback to use (``default`` when nothing qualifies)."""
    sig = F.when((F.col("lag") < below) & (F.abs(F.col("acf")) > threshold) & ~F.isnan("acf"), F.col("lag"))
    a = acf_df.groupBy(*keys).agg(F.max(sig).alias("max_significant_lag"))
    r = F.col("max_significant_lag")
    return a.select(*keys, "max_significant_lag", r.alias("lookback_min"), (r * 2).alias("lookback_recommended_max"),
                    F.least(r * 3, F.lit(cap)).alias("lookback_max"),
                    F.coalesce(r, F.lit(default)).alias("recommended_lookback"))


# ----------------------------------------------------------------------------------
# outliers and shape
# ----------------------------------------------------------------------------------
def iqr_bounds(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (), k: float = 3.0) -> DataFrame:
    """Q1, Q3, IQR and the bounds ``Q1 - k*IQR``, ``Q3 + k*IQR`` (linear quantiles)."""
    q = series.groupBy(*keys).agg(F.percentile(F.col(col), F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    q = q.select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    return q.withColumn("lower_bound", F.col("q1") - k * F.col("iqr")) \
        .withColumn("upper_bound", F.col("q3") + k * F.col("iqr"))


def iqr_outlier_rows(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (), k: float = 3.0) -> DataFrame:
    """rows outside the IQR bounds (bounds broadcast as a one-row table)."""
    b = iqr_bounds(series, col, keys, k)
    s = attach(series, b.select(*keys, "lower_bound", "upper_bound"), keys)
    return s.where((F.col(col) < F.col("lower_bound")) | (F.col(col) > F.col("upper_bound")))


def iqr_outliers(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (), k: float = 3.0) -> DataFrame:
    """A4: Q1, Q3, IQR, bounds, outlier count and share."""
    keys = list(keys)
    b = iqr_bounds(series, col, keys, k)
    s = attach(series, b.select(*keys, "lower_bound", "upper_bound"), keys)
    out = (F.col(col) < F.col("lower_bound")) | (F.col(col) > F.col("upper_bound"))
    c = s.groupBy(*keys).agg(F.count_if(out).alias("n_outliers"), F.count(F.lit(1)).alias("_n"))
    c = c.withColumn("outlier_pct", F.col("n_outliers") * 100.0 / F.col("_n")).drop("_n")
    return join_keys(b, c, keys) if keys else b.crossJoin(F.broadcast(c))


def iqr_outlier_stats(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (), k: float = 3.0) -> DataFrame:
    """A5: min, max and mean of the IQR outliers."""
    o = iqr_outlier_rows(series, col, keys, k)
    return o.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_outliers"),
                                F.min(col).cast("double").alias("min_outlier"),
                                F.max(col).cast("double").alias("max_outlier"),
                                F.avg(col).alias("mean_outlier"))


def zscore_outliers(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (), z: float = 3.0) -> DataFrame:
    """Rows with |x - mean| / std_pop > z (none for a constant series)."""
    keys = list(keys)
    st = series.groupBy(*keys).agg(F.avg(col).alias("_mu"), F.stddev_pop(col).alias("_sd"))
    s = attach(series, st, keys)
    zz = F.abs(F.col(col) - F.col("_mu")) / F.col("_sd")
    hit = F.when(F.col("_sd") > 0, zz > z).otherwise(F.lit(False))
    return s.groupBy(*keys).agg(F.count_if(hit).alias("n_outliers"), F.count(F.lit(1)).alias("_n")) \
        .withColumn("outlier_pct", F.col("n_outliers") * 100.0 / F.col("_n")).drop("_n")


def _moments(series: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    x = F.col(col).cast("double")
    return series.groupBy(*keys).agg(F.count(x).alias("n"), F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"))


def corrected_skew(n, g1):
    """Bias-corrected sample skewness (pandas/DuckDB): ``g1*sqrt(n(n-1))/(n-2)``; 0 for a
    constant series with n >= 3, NULL below."""
    n = n.cast("double")
    return F.when(n >= 3, F.coalesce(g1 * F.sqrt(n * (n - 1)) / (n - 2), F.lit(0.0)))


def corrected_kurt(n, g2):
    """Bias-corrected excess kurtosis: ``(n-1)/((n-2)(n-3)) * ((n+1)g2 + 6)``."""
    n = n.cast("double")
    return F.when(n >= 4, F.coalesce((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6), F.lit(0.0)))


def skewness_class(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """Corrected skewness and its label at |s| < 0.5."""
    m = _moments(series, col, keys)
    s = corrected_skew(F.col("n"), F.col("g1"))
    m = m.select(*keys, s.alias("skewness"))
    return m.withColumn("skew_class", F.when(F.abs("skewness") < 0.5, "symmetric")
                        .when(F.col("skewness") > 0, "right-skewed").otherwise("left-skewed"))


def kurtosis_class(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """Corrected excess kurtosis and its label at |k| < 0.5."""
    m = _moments(series, col, keys)
    k = corrected_kurt(F.col("n"), F.col("g2"))
    m = m.select(*keys, k.alias("kurtosis"))
    return m.withColumn("kurtosis_class", F.when(F.abs("kurtosis") < 0.5, "mesokurtic")
                        .when(F.col("kurtosis") > 0, "leptokurtic").otherwise("platykurtic"))


def normality_test(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (),
                   alpha: float = 0.05) -> DataFrame:
    """A9 (re-aimed from Shapiro-Wilk on a 5000-row sample): Jarque-Bera on the whole
    series, ``JB = n/6 (g1^2 + g2^2/4)``, ``p = exp(-JB/2)`` (chi-square, 2 df)."""
    m = _moments(series, col, keys)
    jb = F.col("n") / 6.0 * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / 4.0)
    m = m.select(*keys, "n", jb.alias("jarque_bera"))
    m = m.withColumn("p_value", F.exp(-F.col("jarque_bera") / 2))
    return m.withColumn("is_normal", F.col("p_value") > alpha)


# ----------------------------------------------------------------------------------
# Augmented Dickey-Fuller (constant, AIC lag choice)
# ----------------------------------------------------------------------------------
# Fixed values from MacKinnon (1994, 2010), constant-only case, one series:
# p-value polynomials (small / large statistic), their switch point and range,
# and the finite-sample critical value polynomials in 1/nobs for 1 %, 5 %, 10 %.
TAU_SMALLP = (2.1659, 1.4412, 0.038269)
TAU_LARGEP = (1.7339, 0.93202, -0.12745, -0.010368)
TAU_STAR, TAU_MIN, TAU_MAX = -1.61, -18.83, 2.74
CRIT = {"1%": (-3.43035, -6.5393, -16.786, -79.433),
        "5%": (-2.86154, -2.8903, -4.234, -40.04),
        "10%": (-2.56677, -1.5384, -2.809, 0.0)}


def adf_max_lag(n: int) -> int:
    """statsmodels default: ``ceil(12 (n/100)^(1/4))``, at most ``n//2 - 2``."""
    return min(n // 2 - 2, int(math.ceil(12.0 * (n / 100.0) ** 0.25)))


def mackinnon_p(t: float) -> float:
    if t is None or math.isnan(t):
        return float("nan")
    if t > TAU_MAX:
        return 1.0
    if t < TAU_MIN:
        return 0.0
    c = TAU_SMALLP if t <= TAU_STAR else TAU_LARGEP
    z = sum(ci * t ** i for i, ci in enumerate(c))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def mackinnon_crit(nobs: int) -> dict[str, float]:
    return {k: sum(ci / nobs ** i for i, ci in enumerate(c)) for k, c in CRIT.items()}


def _adf_final(keys: list[str], autolag: bool):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        r = LS._as_matrix(one["r"])
        head = np.frombuffer(one["head"]) - one["level"]
        t, lag, nobs = LS.adf_statistic(r, int(one["n"]), head, None if autolag else r.shape[0] - 3)
        pv, cv = mackinnon_p(t), mackinnon_crit(max(nobs, 1))
        out = pd.DataFrame({"adf_statistic": [t], "p_value": [pv], "used_lag": [lag], "nobs": [nobs],
                            "crit_1pct": [cv["1%"]], "crit_5pct": [cv["5%"]], "crit_10pct": [cv["10%"]],
                            "is_stationary": [bool(pv < 0.05)]})
        return pd.concat([pdf[keys].iloc[:1].reset_index(drop=True), out], axis=1) if keys else out
    return fn


def adf_test(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (),
             max_lag: int | None = None, autolag: bool = True) -> DataFrame:
    """A10: Augmented Dickey-Fuller with a constant; lag chosen by AIC over the common
    sample, then re-estimated on the longer sample of the chosen lag.

    One pass over halo blocks gives each block's R factor of the regression with the key's maximum lag; factors
    are merged in a tree (``leastsq``). All nested models, and the chosen one's longer sample, come from the merged
    factor and the first ``max_lag + 1`` values. One scalar action reads the longest series length to size the halo.
    """
    keys = list(keys)
    n_tbl = series_length(series, keys)
    n_max = n_tbl.agg(F.max("n")).first()[0]
    if n_max is None:
        raise ValueError("empty series")
    cap = adf_max_lag(int(n_max)) if max_lag is None else int(max_lag)
    if cap < 0:
        raise ValueError("sample size is too short to use selected regression component")
    halo = cap + 1
    b = LS.block_for(halo)
    y = series.select(*keys, "idx", F.col(col).cast("double").alias("_y"))
    if keys and max_lag is None:
        # per key: its own maximum lag (statsmodels rule on its own length)
        pk = F.greatest(F.lit(0), F.least(F.lit(cap), F.floor(F.col("n") / 2) - 2, F.ceil(12.0 * F.pow(F.col("n") / 100.0, 0.25))))
        y = attach(y, n_tbl.select(*keys, pk.cast("int").alias("_p")), keys)
    else:
        y = y.withColumn("_p", F.lit(cap))
    kt = [f"{c} {series.schema[c].dataType.simpleString()}" for c in keys]
    factors = with_halo(y, halo, b).groupBy(*keys, "_blk").applyInPandas(LS.adf_block(keys), ", ".join([*kt, LS.FACTOR]))
    # a copy of a block's last rows stands beyond the last block
    merged = LS.merge_tree(factors, n_max // b + 2, "adf", keys)
    fschema = ", ".join(kt + ["adf_statistic double", "p_value double", "used_lag int", "nobs long",
                              "crit_1pct double", "crit_5pct double", "crit_10pct double",
                              "is_stationary boolean"])
    groups = keys or [F.lit(0).alias("_all")]
    return merged.groupBy(*groups).applyInPandas(_adf_final(keys, autolag), fschema)


def adf_lag0(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = ()) -> DataFrame:
    """A10, fixed lag 0 (plain Dickey-Fuller with constant) in pure SQL aggregates:
    regress dy(t) on y(t-1) with ``regr_*``; the t-statistic of the slope."""
    from ratecast.operators.blocks import bounded_window
    keys = list(keys)
    y = F.col(col).cast("double")
    d = bounded_window(series, {"_ylag": lambda w: F.lag(y, 1).over(w)}, halo=1, keys=keys)
    d = d.where(F.col("_ylag").isNotNull()).withColumn("_dy", y - F.col("_ylag"))
    a = d.groupBy(*keys).agg(F.regr_slope("_dy", "_ylag").alias("slope"),
                             F.regr_count("_dy", "_ylag").alias("nobs"),
                             F.regr_sxx("_dy", "_ylag").alias("_sxx"),
                             F.regr_syy("_dy", "_ylag").alias("_syy"),
                             F.regr_sxy("_dy", "_ylag").alias("_sxy"))
    ssr = F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx")
    se = F.sqrt(ssr / (F.col("nobs") - 2) / F.col("_sxx"))
    return a.select(*keys, "nobs", "slope", (F.col("slope") / se).alias("df_statistic"))
