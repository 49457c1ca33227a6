"""A9, order-statistic form: the Shapiro-Francia test on the whole series from distributed ranks.

W' is the squared correlation of the ordered values with the normal scores of their ranks (Blom: ``(i - 3/8) / (n + 1/4)``). Values are
counted first (a value that fills a third of the rows is one row), the counts are range-partitioned, and each
partition knows its first rank from a table of one row a partition. Ranks are then dealt out again in chunks, so the ranks of
one value are shared by many tasks, and two sums over them give W'. The p-value is Royston's normal approximation
of ``ln(1 - W')`` (1993; fitted for n up to 5,000, extrapolated above).
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ratecast.operators.blocks import _value_ranks
from ratecast.operators.keyjoin import join_keys
from ratecast.operators.series import attach

CHUNK = 4096

# Wichura's algorithm AS 241 (1988) for the normal quantile; coefficients of the numerators and denominators (from the
# constant term up) for |p - 1/2| <= 0.425, then for r = sqrt(-ln min(p, 1 - p)) up to 5 (in r - 1.6) and above (in r - 5).
CENTRAL = ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
            4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
           (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
            2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
TAIL = ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
         1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
        (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
         1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
FAR_TAIL = ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
             2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
            (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
             7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def _poly(c, r):
    out = c[-1]
    for a in reversed(c[:-1]):
        out = out * r + a
    return out


def normal_quantile(p: Column) -> Column:
    """The normal quantile of a probability column, to full double precision, inside whole-stage code."""
    q = p - 0.5
    inner = F.lit(0.180625) - q * q
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    side = F.signum(q)
    part = lambda table, x: _poly([F.lit(a) for a in table[0]], x) / _poly([F.lit(a) for a in table[1]], x)
    return (F.when(F.abs(q) <= 0.425, q * part(CENTRAL, inner))
            .when(r <= 5, side * part(TAIL, r - 1.6)).otherwise(side * part(FAR_TAIL, r - 5.0)))


def normal_quantile_sql(p: str) -> str:
    """The same as a SQL expression (for the oracle)."""
    poly = lambda c, x: "(" + " + ".join(f"{a!r}::DOUBLE * pow({x}, {i})" for i, a in enumerate(c)) + ")"
    r = f"sqrt(-ln(least({p}, 1 - ({p}))))"
    part = lambda table, x: f"{poly(table[0], x)} / {poly(table[1], x)}"
    return (f"CASE WHEN abs(({p}) - 0.5) <= 0.425 THEN (({p}) - 0.5) * {part(CENTRAL, f'(0.180625 - pow(({p}) - 0.5, 2))')} "
            f"WHEN {r} <= 5 THEN sign(({p}) - 0.5) * {part(TAIL, f'({r} - 1.6)')} ELSE sign(({p}) - 0.5) * {part(FAR_TAIL, f'({r} - 5.0)')} END")


@F.pandas_udf(DoubleType())
def _upper_tail(z: pd.Series) -> pd.Series:
    return z.map(lambda v: 0.5 * math.erfc(v / math.sqrt(2.0)))


def shapiro_francia(series: DataFrame, col: str = "txn_count", keys: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """``keys.., n, w_statistic, p_value, is_normal``. Null below 5 values and for a constant series; null and NaN values are left out."""
    keys = list(keys)
    x = series.select(*keys, F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    spread = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("_x").alias("_mean"),
                                  (F.var_pop("_x") * F.count(F.lit(1))).alias("_ss"))
    counts, parts = _value_ranks(x, "_x", keys, None)
    upto = F.sum("_w").over(Window.partitionBy(*keys, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1))
    tied = join_keys(counts.withColumn("_in", F.coalesce(upto, F.lit(0))), parts.select(*keys, "_pid", "_poff"), keys, ["_pid"]) \
        .withColumn("_lo", F.col("_poff") + F.col("_in"))
    last = F.col("_lo") + F.col("_w")
    chunks = (tied.select(*keys, "_v", "_lo", last.alias("_end"))
              .withColumn("_from", F.explode(F.sequence("_lo", F.col("_end") - 1, F.lit(CHUNK).cast("bigint"))))
              .select(*keys, "_v", "_from", (F.least(F.col("_from") + CHUNK, "_end") - 1).alias("_to")))
    ranks = attach(chunks.repartition("_from"), spread.select(*keys, "n", "_mean"), keys) \
        .withColumn("_i", F.explode(F.sequence("_from", "_to")))
    m = normal_quantile((F.col("_i") + 0.625) / (F.col("n") + 0.25))
    sums = ranks.withColumn("_m", m).groupBy(*keys).agg(F.sum(F.col("_m") * (F.col("_v") - F.col("_mean"))).alias("_mx"),
                                                        F.sum(F.col("_m") * F.col("_m")).alias("_mm"))
    out = attach(spread, sums, keys)
    ok = (F.col("n") >= 5) & (F.col("_ss") > 0)
    w = F.when(ok, F.least(F.lit(1.0), F.try_divide(F.col("_mx") * F.col("_mx"), F.col("_mm") * F.col("_ss"))))
    u = F.log(F.col("n").cast("double"))
    v = F.log(u)
    z = (F.log(F.greatest(1 - F.col("w_statistic"), F.lit(1e-300))) - (F.lit(-1.2725) + 1.0521 * (v - u))) / (F.lit(1.0308) - 0.26758 * (v + 2 / u))
    out = out.select(*keys, "n", w.alias("w_statistic")).withColumn("p_value", F.when(F.col("w_statistic").isNotNull(), _upper_tail(z)))
    return out.withColumn("is_normal", F.col("p_value") > alpha)
