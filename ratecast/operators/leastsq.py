"""Least squares on lagged values, from one pass: R factors of blocks, merged in a tree.

Every block of a series gives the triangular factor R of its own design rows (tree QR): ``R'R`` is the block's part of the normal equations, but
R keeps twice the digits. Factors are stacked and factored again, ``FAN`` neighbours at a time, until one is left. A block
works on values less a level of its own (its first value), and a merge moves the later factor to the earlier one's level by
adding a multiple of the ones column, so a series at 1e9 loses no digits.

Columns are in the order of the lags, so the factor of a model with fewer lags is a leading part of the same R, and the squared
errors of all nested models are sums over its last column. A model with fewer lags also has more rows: those at the head
of the series, which come along as raw values and are stacked below R when such a model is solved.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.operators.blocks import MIN_BLOCK
from ratecast.operators.recurrent import pack_blocks

FAN = 32
FACTOR = "blk bigint, n bigint, level double, r binary, head binary"


def ar_rows(y: np.ndarray, first: int, lags: int) -> np.ndarray:
    """Design rows ``1, y(t-1) .. y(t-lags), y(t)`` for t = first ..; ``first >= lags``."""
    t = np.arange(first, len(y))
    return np.column_stack([np.ones(len(t)), *(y[t - k] for k in range(1, lags + 1)), y[t]])


def adf_rows(y: np.ndarray, first: int, lags: int) -> np.ndarray:
    """Design rows ``1, y(t-1), dy(t-1) .. dy(t-lags), dy(t)`` for t = first ..; ``first > lags``."""
    t, dy = np.arange(first, len(y)), np.diff(y, prepend=np.nan)
    return np.column_stack([np.ones(len(t)), y[t - 1], *(dy[t - k] for k in range(1, lags + 1)), dy[t]])


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of ``rows``, square (zero rows at the end when there are fewer rows than columns)."""
    k = rows.shape[1]
    r = np.linalg.qr(rows, mode="r") if len(rows) else rows[:0]
    return np.vstack([r, np.zeros((k - len(r), k))]) if len(r) < k else r


def moved(r: np.ndarray, by: float, levels: slice) -> np.ndarray:
    """The factor of the same rows with ``by`` added to every column that holds a level of the series."""
    out = r.copy()
    out[:, levels] += by * r[:, :1]
    return out


#: columns that hold levels of the series, not differences
LEVELS = {"ar": slice(1, None), "adf": slice(1, 2)}


def _as_matrix(data: bytes) -> np.ndarray:
    flat = np.frombuffer(data)
    k = math.isqrt(len(flat))
    return flat.reshape(k, k)


def merge_factors(pdf: pd.DataFrame, kind: str) -> pd.DataFrame:
    """One factor of several, in the order of their blocks, at the level of the first."""
    pdf = pdf.sort_values("blk")
    level = float(pdf["level"].iloc[0])
    r = triangle(np.vstack([moved(_as_matrix(d), s - level, LEVELS[kind]) for d, s in zip(pdf["r"], pdf["level"])]))
    heads = [x for x in pdf["head"] if x is not None]
    return pd.DataFrame({"blk": [int(pdf["blk"].iloc[0]) // FAN], "n": [int(pdf["n"].sum())], "level": [level], "r": [r.tobytes()],
                         "head": [heads[0] if heads else None]})


def merge_tree(factors: DataFrame, blocks: int, kind: str, keys: Sequence[str] = ()) -> DataFrame:
    """``factors(keys.., blk, n, level, r, head)`` -> one row a key. ``blocks``: block numbers are below it."""
    keys = list(keys)
    schema = ", ".join([f"{c} {factors.schema[c].dataType.simpleString()}" for c in keys] + [FACTOR])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        out = merge_factors(pdf, kind)
        return pd.concat([pdf[keys].iloc[:1].reset_index(drop=True), out], axis=1) if keys else out

    rounds = max(1, math.ceil(math.log(max(blocks, 2), FAN) - 1e-9))
    for _ in range(rounds):
        factors = factors.groupBy(*keys, F.floor(F.col("blk") / FAN).alias("_up")).applyInPandas(merge, schema)
    return factors


def with_head(r: np.ndarray, cols: int, head_rows: np.ndarray) -> np.ndarray:
    """R of the model on the first ``cols`` columns, with more rows at the head."""
    part = np.column_stack([r[:, :cols], r[:, -1]])
    return triangle(np.vstack([part, head_rows]) if len(head_rows) else part)


def solve(r: np.ndarray) -> np.ndarray:
    """Coefficients from R of (design | target); of least norm where columns depend on each other."""
    return np.linalg.lstsq(r[:-1, :-1], r[:-1, -1], rcond=1e-12)[0]


# ----------------------------------------------------------------------------------
# Next-value regressions of several lookbacks from one factor
# ----------------------------------------------------------------------------------
def pack_series(split_series: DataFrame, lookbacks: Sequence[int], col: str = "txn_count", block: int | None = None) -> DataFrame:
    """The series with ``split, n_train`` in packed halo blocks of each side; see ``recurrent.pack_blocks``."""
    return pack_blocks(split_series, [col], max(lookbacks), block, least=min(lookbacks))


def lagged_fit(blocks: DataFrame, lookbacks: Sequence[int]) -> DataFrame:
    """Least-squares fits of y(t) on 1, y(t-1) .. y(t-L) over the windows of the train side, for every L of ``lookbacks`` from
    one factor: ``lookback, n, intercept, coefs`` (lag 1 first)."""
    lookbacks = sorted({int(k) for k in lookbacks})
    most = lookbacks[-1]

    def factors(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                y = np.frombuffer(r.data, "<f8")
                level = float(y[0])
                z = ar_rows(y - level, max(most, r.own), most) if len(y) > max(most, r.own) else np.zeros((0, most + 2))
                rows.append((r.blk, len(z), level, triangle(z).tobytes(), y[:most].tobytes() if r.idx == 0 else None))
            yield pd.DataFrame(rows, columns=["blk", "n", "level", "r", "head"])

    def fits(pdf: pd.DataFrame) -> pd.DataFrame:
        one, out = pdf.iloc[0], []
        r, level = _as_matrix(one["r"]), one["level"]
        head = np.frombuffer(one["head"]) - level
        for k in lookbacks:
            # rows t = k .. most - 1 of the head have k lags, though not all of them
            more = ar_rows(head, k, k) if len(head) > k else np.zeros((0, k + 2))
            n = int(one["n"]) + len(more)
            if not n:
                continue
            b = solve(with_head(r, k + 1, more))
            out.append((k, n, float(b[0] + level * (1 - b[1:].sum())), b[1:].tolist()))
        return pd.DataFrame(out, columns=["lookback", "n", "intercept", "coefs"])

    train = blocks.where("split = 'train'")
    count = train.agg(F.max("blk")).first()[0]
    schema = "lookback int, n bigint, intercept double, coefs array<double>"
    one = merge_tree(train.mapInPandas(factors, FACTOR), 1 if count is None else count + 1, "ar")
    return one.groupBy(F.lit(0).alias("_all")).applyInPandas(fits, schema)


def lagged_predictions(blocks: DataFrame, fits: DataFrame, split: str = "test") -> DataFrame:
    """``lookback, idx, row, actual, predicted`` for every window of one side and every fit (a row for each lookback: broadcast)."""
    packed = fits.agg(F.collect_list(F.struct("lookback", "intercept", "coefs")).alias("fits"))

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                y = np.frombuffer(r.data, "<f8")
                for f in r.fits:
                    k, first = f["lookback"], max(f["lookback"], r.own)
                    if first >= len(y):
                        continue
                    idx = r.idx + np.arange(first, len(y))
                    guess = f["intercept"] + np.convolve(y, [0.0, *f["coefs"]])[first:len(y)]
                    yield pd.DataFrame({"lookback": k, "idx": idx, "row": idx - (r.n_train if r.split == "test" else 0) - k,
                                        "actual": y[first:], "predicted": guess})

    return (blocks.where(F.col("split") == split).crossJoin(F.broadcast(packed))
            .mapInPandas(run, "lookback int, idx bigint, row bigint, actual double, predicted double"))


# ----------------------------------------------------------------------------------
# A10: the augmented Dickey-Fuller regression
# ----------------------------------------------------------------------------------
def adf_block(keys: Sequence[str]):
    """Factor of the rows t > p of one halo block (``_p``: the key's maximum lag)."""
    keys = list(keys)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        p, y, idx = int(pdf["_p"].iloc[0]), pdf["_y"].to_numpy("float64"), pdf["idx"].to_numpy()
        own = pdf["_own"].to_numpy() == pdf["_blk"].to_numpy()
        level = float(y[0])
        first = max(int(np.argmax(own)) if own.any() else len(y), p + 1)
        z = adf_rows(y - level, first, p) if first < len(y) else np.zeros((0, p + 3))
        out = pd.DataFrame({"blk": [int(pdf["_blk"].iloc[0])], "n": [len(z)], "level": [level], "r": [triangle(z).tobytes()],
                            "head": [y[:p + 1].tobytes() if idx[0] == 0 else None]})
        return pd.concat([pdf[keys].iloc[:1].reset_index(drop=True), out], axis=1) if keys else out
    return fn


def best_lag(r: np.ndarray, n: int) -> tuple[int, float]:
    """Lag of least AIC over the nested models on the common sample, and that AIC."""
    tail = np.cumsum((r[:, -1] ** 2)[::-1])[::-1]         # squared errors of the model on the first k columns at k
    best = (0, math.inf)
    for lag in range(r.shape[0] - 2):
        k = lag + 2
        ssr = float(tail[k])
        aic = n * (math.log(2 * math.pi) + math.log(ssr / n if ssr > 0 else 1e-300) + 1) + 2 * k
        if aic < best[1]:
            best = (lag, aic)
    return best


def adf_statistic(r: np.ndarray, n: int, head: np.ndarray, lag: int | None) -> tuple[float, int, int]:
    """t statistic of y(t-1), lag and rows; the chosen lag's model is solved on its own longer sample. ``lag`` None: by AIC.
    NaN where the regressors depend on each other (a constant series)."""
    p = r.shape[0] - 3
    if lag is None:
        lag = best_lag(r, n)[0] if n else 0
    more = adf_rows(head, lag + 1, lag) if len(head) > lag + 1 else np.zeros((0, lag + 3))
    rr, nobs, k = with_head(r, lag + 2, more), n + len(more), lag + 2
    size = np.sqrt((rr[:, :k] ** 2).sum(0))
    if nobs <= k or p < 0 or (np.abs(np.diag(rr)[:k]) <= 1e-12 * size).any():
        return math.nan, lag, nobs
    inverse = np.linalg.inv(rr[:k, :k])
    beta, s2 = inverse @ rr[:k, -1], rr[k, -1] ** 2 / (nobs - k)
    spread = math.sqrt(s2 * float((inverse[1] ** 2).sum()))
    return (float(beta[1] / spread) if spread > 0 else math.nan), lag, nobs


def block_for(halo: int) -> int:
    return max(32 * halo, MIN_BLOCK)
