"""Recurrent next-value regressors, trained data-parallel on look-back windows.

The feature table is packed once: a row per halo block of one split side, its feature matrix as one
binary value. A window is a slice of that matrix, so the ``lookback``-fold copy of R6 is never written. One
epoch is one Spark job: the weights (some thousand numbers) are broadcast, every block returns the sum of the squared errors
of its windows and their gradient (back-propagation through time in numpy, per block), and the
sums meet in two small grouped steps in the order of (block bucket, block), so a result does not depend on partitions or
on which executor ran a task. The driver keeps the weights and makes the Adam step.

Early stopping watches the loss of the validation windows (M4: the last tenth of the train windows), which the same job
returns; the best weights are restored, and a loss that stands still halves the step size.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.operators.blocks import with_halo
from ratecast.operators.prep import minmax_apply, minmax_fit, temporal_split
from ratecast.session import materialize

#: gates of a cell, in the order of its weight columns
GATES = {"rnn": 1, "gru": 3, "lstm": 4}
BUCKETS = 256


# ----------------------------------------------------------------------------------
# weights and cells: x (windows, lookback, features) -> one prediction a window
# ----------------------------------------------------------------------------------
def weight_shapes(cell: str, features: int, units: int) -> dict[str, tuple[int, ...]]:
    g = GATES[cell] * units
    return {"wx": (features, g), "wh": (units, g), "b": (g,), "v": (units,), "c": (1,)}


def unpack(flat: np.ndarray, shapes: dict[str, tuple[int, ...]]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes.items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def initial_weights(cell: str, features: int, units: int, seed: int) -> np.ndarray:
    """Glorot-uniform input weights, scaled normal recurrent weights, forget gate open."""
    rng = np.random.Generator(np.random.PCG64(seed))
    parts = []
    for name, shape in weight_shapes(cell, features, units).items():
        if name in ("wx", "v"):
            r = np.sqrt(6.0 / (shape[0] + (shape[1] if len(shape) > 1 else 1)))
            parts.append(rng.uniform(-r, r, shape))
        elif name == "wh":
            parts.append(rng.normal(0, 1 / np.sqrt(units), shape))
        else:
            b = np.zeros(shape)
            if name == "b" and cell == "lstm":
                b[units:2 * units] = 1
            parts.append(b)
    return np.concatenate([p.ravel() for p in parts])


def _sigmoid(a):
    return 0.5 * (np.tanh(0.5 * a) + 1)


def _forward(cell, w, x):
    """States of every step, with what the backward pass needs."""
    n, steps, _ = x.shape
    u = len(w["v"])
    h, c, kept = np.zeros((n, u)), np.zeros((n, u)), []
    for t in range(steps):
        a = x[:, t] @ w["wx"] + w["b"]
        if cell == "rnn":
            new = np.tanh(a + h @ w["wh"])
            kept.append((h, new))
        elif cell == "lstm":
            a += h @ w["wh"]
            i, f, o = (_sigmoid(a[:, k * u:(k + 1) * u]) for k in range(3))
            g = np.tanh(a[:, 3 * u:])
            c2 = f * c + i * g
            tc = np.tanh(c2)
            new = o * tc
            kept.append((h, c, i, f, o, g, tc))
            c = c2
        else:
            z, r = (_sigmoid(a[:, k * u:(k + 1) * u] + h @ w["wh"][:, k * u:(k + 1) * u]) for k in range(2))
            g = np.tanh(a[:, 2 * u:] + (r * h) @ w["wh"][:, 2 * u:])
            new = z * h + (1 - z) * g
            kept.append((h, z, r, g))
        h = new
    return h, kept


def predict(cell: str, flat: np.ndarray, units: int, x: np.ndarray) -> np.ndarray:
    w = unpack(flat, weight_shapes(cell, x.shape[2], units))
    return _forward(cell, w, x)[0] @ w["v"] + w["c"][0]


def loss_and_gradient(cell: str, flat: np.ndarray, units: int, x: np.ndarray, y: np.ndarray):
    """Sum of squared errors over the windows and its gradient (back-propagation through time)."""
    w = unpack(flat, weight_shapes(cell, x.shape[2], units))
    h, kept = _forward(cell, w, x)
    e = h @ w["v"] + w["c"][0] - y
    grad = {k: np.zeros_like(a) for k, a in w.items()}
    grad["v"], grad["c"] = 2 * h.T @ e, np.array([2 * e.sum()])
    dh, dc, u = 2 * np.outer(e, w["v"]), np.zeros_like(h), units
    for t in reversed(range(x.shape[1])):
        if cell == "rnn":
            before, new = kept[t]
            da = dh * (1 - new * new)
            grad["wh"] += before.T @ da
            dh = da @ w["wh"].T
        elif cell == "lstm":
            before, c, i, f, o, g, tc = kept[t]
            dc = dc + dh * o * (1 - tc * tc)
            da = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            grad["wh"] += before.T @ da
            dh, dc = da @ w["wh"].T, dc * f
        else:
            before, z, r, g = kept[t]
            dg = dh * (1 - z) * (1 - g * g)
            dz = dh * (before - g) * z * (1 - z)
            inner = dg @ w["wh"][:, 2 * u:].T
            dr = inner * before * r * (1 - r)
            grad["wh"][:, :u] += before.T @ dz
            grad["wh"][:, u:2 * u] += before.T @ dr
            grad["wh"][:, 2 * u:] += (r * before).T @ dg
            dh = dh * z + inner * r + dz @ w["wh"][:, :u].T + dr @ w["wh"][:, u:2 * u].T
            da = np.concatenate([dz, dr, dg], 1)
        grad["wx"] += x[:, t].T @ da
        grad["b"] += da.sum(0)
    return float(e @ e), np.concatenate([grad[k].ravel() for k in w])


class Adam:
    def __init__(self, size: int, rate: float):
        self.rate, self.steps, self.m, self.v = rate, 0, np.zeros(size), np.zeros(size)

    def step(self, flat: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.steps += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.999 * self.v + 0.001 * grad * grad
        m, v = self.m / (1 - 0.9 ** self.steps), self.v / (1 - 0.999 ** self.steps)
        return flat - self.rate * m / (np.sqrt(v) + 1e-7)


# ----------------------------------------------------------------------------------
# packed blocks
# ----------------------------------------------------------------------------------
def pack_blocks(features: DataFrame, cols: Sequence[str], lookback: int, block: int | None = None,
                least: int | None = None) -> DataFrame:
    """``features`` with ``idx, split, n_train`` -> one row for a block of one side: ``split, blk, idx`` (of the first row
    kept), ``own`` (rows before the block's own ones), ``n_train`` and ``data`` (rows x columns, float64). The target is column 0.
    Blocks without a window of ``least`` rows (by default ``lookback``) are left out."""
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    h = with_halo(features.select("idx", "split", "n_train", vec.alias("vec")), lookback, block)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        one = pdf.iloc[0]
        data = np.stack(pdf["vec"].to_numpy())
        return pd.DataFrame({"split": [one["split"]], "blk": [one["_blk"]], "idx": [one["idx"]],
                             "own": [int((pdf["_own"] < pdf["_blk"]).sum())], "n_train": [one["n_train"]],
                             "data": [np.ascontiguousarray(data, "<f8").tobytes()]})

    out = h.groupBy("split", "_blk").applyInPandas(
        pack, "split string, blk bigint, idx bigint, own bigint, n_train bigint, data binary")
    return out.where(F.octet_length("data") > 8 * len(cols) * F.greatest(F.lit(least or lookback), F.col("own")))


def block_windows(r, lookback: int, features: int):
    """Windows of a packed block: x (a view), y, the target rows' ``idx`` and their number within the side."""
    data = np.frombuffer(r.data, "<f8").reshape(-1, features)
    first = max(lookback, r.own)
    x = np.lib.stride_tricks.sliding_window_view(data, lookback, axis=0)[first - lookback:-1].transpose(0, 2, 1)
    idx = r.idx + np.arange(first, len(data))
    return x, data[first:, 0], idx, idx - (r.n_train if r.split == "test" else 0) - lookback


def validation_cut(n_train: int, lookback: int, val_frac: float) -> int:
    """M4: number of train windows before the validation tail."""
    return int(np.floor((n_train - lookback) * (1 - val_frac)))


def epoch_sums(blocks: DataFrame, cell: str, flat: np.ndarray, units: int, lookback: int, features: int, val_frac: float):
    """One job over the train blocks: (windows, squared errors, gradient; validation windows, their squared errors)."""
    weights = blocks.sparkSession.sparkContext.broadcast(flat)

    def sums(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                x, y, _, row = block_windows(r, lookback, features)
                fit = row < validation_cut(r.n_train, lookback, val_frac)
                loss, grad = loss_and_gradient(cell, weights.value, units, x[fit], y[fit])
                miss = predict(cell, weights.value, units, x[~fit]) - y[~fit]
                rows.append((r.blk, np.concatenate([[fit.sum(), loss, (~fit).sum(), miss @ miss], grad]).tobytes()))
            yield pd.DataFrame(rows, columns=["blk", "sums"])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(s) for s in pdf.sort_values("blk")["sums"]], axis=0)
        return pd.DataFrame({"blk": [int(pdf["blk"].min())], "sums": [total.tobytes()]})

    try:
        per_block = blocks.where("split = 'train'").mapInPandas(sums, "blk bigint, sums binary")
        some = per_block.groupBy((F.col("blk") % BUCKETS).alias("bucket")).applyInPandas(added, "blk bigint, sums binary")
        one = some.groupBy(F.lit(0).alias("all")).applyInPandas(added, "blk bigint, sums binary").collect()  # of <= BUCKETS rows
    finally:
        weights.destroy()
    if not one:
        raise ValueError(f"no train window of {lookback} rows")
    s = np.frombuffer(one[0].sums)
    return float(s[0]), float(s[1]), s[4:], float(s[2]), float(s[3])


@dataclass
class RecurrentModel:
    cell: str
    units: int
    lookback: int
    cols: tuple[str, ...]
    weights: np.ndarray
    low: float
    high: float
    history: list[dict] = field(default_factory=list)


def scaled_features(features: DataFrame, cols: Sequence[str], train_frac: float, fit_on: str = "all"):
    """M7 and M1: every column to [0, 1] (fitted on all rows as the reference does, or on the train side), and the split."""
    s = temporal_split(features, train_frac, col=cols[0])
    fit = minmax_fit(s, cols, where=None if fit_on == "all" else F.col("split") == "train")
    return minmax_apply(s, fit, cols), fit


def fit_recurrent(features: DataFrame, cols: Sequence[str], lookback: int = 60, cell: str = "lstm", units: int = 16, epochs: int = 100,
                  rate: float = 0.01, val_frac: float = 0.1, patience: int = 10, plateau: int = 5, train_frac: float = 0.8,
                  seed: int = 42, fit_on: str = "all", block: int | None = None):
    """Train on the windows of the train side. Returns ``(model, packed blocks)``; ``cols[0]`` is the target and
    also the first feature. Epochs are full-batch Adam steps; ``model.history`` has a row for each."""
    cols = tuple(cols)
    scaled, fit = scaled_features(features, cols, train_frac, fit_on)
    blocks = materialize(pack_blocks(scaled, cols, lookback, block))
    limits = fit.first()
    flat = initial_weights(cell, len(cols), units, seed)
    adam, best, best_flat, since, history = Adam(len(flat), rate), np.inf, flat, 0, []
    for epoch in range(epochs + 1):             # the last one only scores the weights of the last step
        n, loss, grad, n_val, val = epoch_sums(blocks, cell, flat, units, lookback, len(cols), val_frac)
        watched = val / n_val if n_val else loss / n
        better = watched < best
        if better:
            best, best_flat, since = watched, flat, 0
        else:
            since += 1
        history.append({"epoch": epoch, "n_windows": int(n), "loss": loss / n, "n_val": int(n_val), "val_loss": val / n_val if n_val else None,
                        "rate": adam.rate, "is_best": better})
        if epoch == epochs or since > patience:
            break
        if since and since % plateau == 0:
            adam.rate /= 2
        flat = adam.step(flat, grad / n)
    for h in history:
        h["is_best"] = h["epoch"] == max(x["epoch"] for x in history if x["is_best"])
    lo, hi = limits[f"{cols[0]}_min"], limits[f"{cols[0]}_max"]
    return RecurrentModel(cell, units, lookback, cols, best_flat, lo, hi, history), blocks


def predict_recurrent(model: RecurrentModel, blocks: DataFrame, split: str = "test") -> DataFrame:
    """``idx, row, actual, predicted`` in counts (M8) for every window of one side."""
    span = model.high - model.low
    flat, cell, units, lookback, features, low = model.weights, model.cell, model.units, model.lookback, len(model.cols), model.low
    scale = span or 1.0

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                x, y, idx, row = block_windows(r, lookback, features)
                yield pd.DataFrame({"idx": idx, "row": row, "actual": y * scale + low,
                                    "predicted": predict(cell, flat, units, x) * scale + low})

    return blocks.where(F.col("split") == split).mapInPandas(run, "idx bigint, row bigint, actual double, predicted double")


def history_table(spark, model: RecurrentModel) -> DataFrame:
    return spark.createDataFrame([tuple(h.values()) for h in model.history],
                                 "epoch int, n_windows bigint, loss double, n_val bigint, val_loss double, rate double, is_best boolean")
