"""DuckDB SQL fragments for the oracle queries (independent formulations: global
windows, ``generate_series`` grids, ``quantile_cont``), used only for checking."""
from __future__ import annotations

DAY_US = 86_400_000_000


def series_cte(step_us: int = 60_000_000, src: str = "events", ts: str = "ts", keys: tuple = (),
               name: str = "s", count_col: str = "txn_count") -> str:
    """CTEs ending in ``<name>(keys.., ts, idx, <count_col>)``: zero-filled bins anchored
    at midnight of the first day."""
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    on_o = ("USING (" + k + ")") if keys else "ON TRUE"
    return f"""{name}_e AS (SELECT {kc}epoch_us({ts}) AS us FROM {src} WHERE {ts} IS NOT NULL),
{name}_o AS (SELECT {kc}min(us) - (min(us) % {DAY_US}) AS org FROM {name}_e {('GROUP BY ' + k) if keys else ''}),
{name}_c AS (SELECT {kc}us - ((us - org) % {step_us}) AS b, count(*) AS n
             FROM {name}_e JOIN {name}_o {on_o} GROUP BY ALL),
{name}_bd AS (SELECT {kc}min(b) AS lo, max(b) AS hi FROM {name}_c {('GROUP BY ' + k) if keys else ''}),
{name}_g AS (SELECT {kc}lo, unnest(generate_series(lo, hi, {step_us})) AS b FROM {name}_bd),
{name} AS (SELECT {('g.' + ', g.'.join(keys) + ', ') if keys else ''}make_timestamp(g.b) AS ts,
                  CAST((g.b - g.lo) // {step_us} AS BIGINT) AS idx,
                  CAST(coalesce(c.n, 0) AS BIGINT) AS {count_col}
           FROM {name}_g g LEFT JOIN {name}_c c USING ({kc}b))"""


MINUTE = 60_000_000
HOUR = 3_600_000_000


def with_series(body: str, step_us: int = MINUTE, src: str = "events", ts: str = "ts",
                keys: tuple = ()) -> str:
    return f"WITH {series_cte(step_us, src, ts, keys)},\n{body}"


MA3 = """CASE WHEN count(txn_count) OVER w3 = 3 THEN avg(CAST(txn_count AS DOUBLE)) OVER w3
              WHEN count(txn_count) OVER w3 > 0 THEN CAST(lag(txn_count) OVER wo AS DOUBLE)
              ELSE 0.0 END"""
MA3_WINDOWS = "WINDOW wo AS (ORDER BY idx), w3 AS (ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"


def replay_cte(step_us: int = MINUTE, test_frac_expr: str = "(1 - 0.1::DOUBLE)", src="events", ts="ts") -> str:
    """CTEs ending in ``pr(ts, idx, actual, predicted, error, model)``."""
    return f"""WITH {series_cte(step_us, src, ts)},
nn AS (SELECT count(*) AS n FROM s),
ma AS (SELECT ts, idx, txn_count, {MA3} AS predicted FROM s {MA3_WINDOWS}),
pr AS (SELECT ts, idx, CAST(txn_count AS DOUBLE) AS actual, predicted,
              abs(predicted - txn_count) AS error, 'Baseline (Moving Avg)' AS model
       FROM ma, nn WHERE idx >= floor(nn.n * {test_frac_expr}))"""


MAPE_RAW = """avg(CASE WHEN actual = 0 AND predicted - actual = 0 THEN 'NaN'::DOUBLE
                   WHEN actual = 0 THEN 'Infinity'::DOUBLE
                   ELSE abs((predicted - actual) / actual) END) * 100"""
MAPE_NZ = "avg(CASE WHEN actual <> 0 THEN abs((predicted - actual) / actual) END) * 100"
WAPE = "CASE WHEN avg(actual) > 0 THEN avg(abs(predicted - actual)) / avg(actual) * 100 ELSE 0.0 END"
MAPE_EPS = "avg(abs(predicted - actual) / greatest(abs(actual), 2.220446049250313e-16)) * 100"


def gram(cols: list[str], src: str, where: str = "true") -> str:
    """A row (m, nobs): the matrix of sums of products of ``cols``."""
    cell = lambda i, j: f"sum({cols[min(i, j)]} * {cols[max(i, j)]})::DOUBLE"
    rows = ", ".join("[" + ", ".join(cell(i, j) for j in range(len(cols))) + "]" for i in range(len(cols)))
    return f"SELECT [{rows}] AS m, count(*) AS nobs FROM {src} WHERE {where}"


def pivots(size: int, src: str, count: str, every_row: bool = False, extra: str = "") -> str:
    """Recursive term q, m: the matrix of ``src`` after q pivots (Gauss; Gauss-Jordan with ``every_row``)."""
    stay = "i = q + 1" if every_row else "i <= q + 1"
    return (f"SELECT q + 1, list_transform(range(1, {size + 1}), lambda i: CASE WHEN {stay} THEN m[i] ELSE list_transform(range(1, {size + 1}), "
            f"lambda j: m[i][j] - m[i][q + 1] * m[q + 1][j] / m[q + 1][q + 1]) END){extra} FROM {src} WHERE q < {count}")


def normal_cdf(z: str) -> str:
    """Phi(z) by its power series (100 terms), 0 or 1 beyond 8."""
    series = f"list_reduce(list_prepend({{'t': {z}, 's': {z}}}, list_transform(range(1, 100), lambda k_: {{'t': k_::DOUBLE, 's': 0.0::DOUBLE}})), " \
             f"lambda a_, k_: {{'t': a_.t * {z} * {z} / (2 * k_.t + 1), 's': a_.s + a_.t * {z} * {z} / (2 * k_.t + 1)}}).s"
    return f"CASE WHEN {z} < -8 THEN 0.0 WHEN {z} > 8 THEN 1.0 ELSE 0.5 + exp(-{z} * {z} / 2) / sqrt(2 * pi()) * {series} END"


def adf_ctes(max_lag: int, src: str = "s", col: str = "txn_count") -> str:
    """CTEs (under WITH RECURSIVE) ending in ``adf(adf_statistic, p_value, used_lag, nobs)``: the augmented Dickey-Fuller test with a
    constant by the normal equations. One elimination gives the squared errors of all lags; the chosen lag is fitted on its own rows."""
    p = max_lag
    lags = [f"d{k}" for k in range(1, p + 1)]
    first = ["1::BIGINT", "y1", *lags, "d0"]
    last = ["1::BIGINT", *lags, "y1", "d0"]
    y, t = p + 2, p + 3
    small = " + ".join(f"({c}) * power(adf_statistic, {i})" for i, c in enumerate((2.1659, 1.4412, 0.038269)))
    large = " + ".join(f"({c}) * power(adf_statistic, {i})" for i, c in enumerate((1.7339, 0.93202, -0.12745, -0.010368)))
    return f"""a_d AS (SELECT idx, {col}::BIGINT AS y, {col}::BIGINT - lag({col}) OVER (ORDER BY idx) AS d FROM {src}),
a_l AS MATERIALIZED (SELECT idx, lag(y) OVER o AS y1, d AS d0, {", ".join(f"coalesce(lag(d, {k}) OVER o, 0) AS d{k}" for k in range(1, p + 1))}
        FROM a_d WINDOW o AS (ORDER BY idx)),
a_g AS MATERIALIZED ({gram(first, "a_l", f"idx > {p}")}),
a_e(q, m) AS (SELECT 0, m FROM a_g UNION ALL {pivots(p + 3, "a_e", str(p + 2))}),
a_k AS MATERIALIZED (SELECT arg_min(q - 2, nobs * (ln(2 * pi()) + ln(a_e.m[{t}][{t}] / nobs) + 1) + 2 * q) AS k FROM a_e, a_g WHERE q >= 2),
a_h AS MATERIALIZED ({gram(last, "a_l, a_k", "idx > k")}),
a_f(q, m, k) AS (SELECT 0, m, k FROM a_h, a_k UNION ALL {pivots(p + 3, "a_f", "k + 1", extra=", k")}),
a_s AS (SELECT m[{y}][{t}] / m[{y}][{y}] / sqrt((m[{t}][{t}] - m[{y}][{t}] * m[{y}][{t}] / m[{y}][{y}])
               / ((SELECT nobs FROM a_h) - k - 2) / m[{y}][{y}]) AS adf_statistic, k, (SELECT nobs FROM a_h) AS nobs FROM a_f WHERE q = k + 1),
a_z AS (SELECT *, CASE WHEN adf_statistic <= -1.61 THEN {small} ELSE {large} END AS z FROM a_s),
adf AS (SELECT adf_statistic, CASE WHEN adf_statistic > 2.74 THEN 1.0 WHEN adf_statistic < -18.83 THEN 0.0 ELSE {normal_cdf("z")} END AS p_value,
               k AS used_lag, nobs FROM a_z)"""


def linear_ctes(lookback: int, src: str = "s", col: str = "txn_count", train: str = "0.8::DOUBLE") -> str:
    """CTEs (under WITH RECURSIVE) ending in ``fit<L>(c)``, the coefficients (intercept, lag 1 ..) of least squares on the train side by
    Gauss-Jordan, and ``pred<L>(idx, row, actual, predicted)`` for the windows of the test side."""
    k = lookback
    lags = [f"l{i}" for i in range(1, k + 1)]
    guess = " + ".join(["c[1]", *(f"c[{i + 1}] * l{i}" for i in range(1, k + 1))])
    return f"""n{k} AS (SELECT CAST(floor(count(*) * {train}) AS BIGINT) AS nt FROM {src}),
x{k} AS MATERIALIZED (SELECT idx, CAST({col} AS DOUBLE) AS y, {", ".join(f"CAST(lag({col}, {i}) OVER (ORDER BY idx) AS DOUBLE) AS l{i}" for i in range(1, k + 1))} FROM {src}),
g{k} AS MATERIALIZED ({gram(["1.0::DOUBLE", *lags, "y"], f"x{k}, n{k}", f"idx >= {k} AND idx < nt")}),
e{k}(q, m) AS (SELECT 0, m FROM g{k} UNION ALL {pivots(k + 2, f"e{k}", str(k + 1), every_row=True)}),
fit{k} AS MATERIALIZED (SELECT list_transform(range(1, {k + 2}), lambda i: m[i][{k + 2}] / m[i][i]) AS c FROM e{k} WHERE q = {k + 1}),
pred{k} AS (SELECT idx, idx - nt - {k} AS row, y AS actual, {guess} AS predicted FROM x{k}, n{k}, fit{k} WHERE idx >= nt + {k})"""
