"""O4 recurrent training: gradients, equality with one process, repeatability."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.operators import recurrent as RC

COLS = ("txn_count", "a", "b", "c")


def features(spark, n=420, parts=3):
    x = F.col("idx").cast("double")
    return spark.range(n).select(F.col("id").alias("idx")).select(
        "idx", (5 + 3 * F.sin(x / 7) + F.pmod(F.col("idx") * 37, F.lit(11)) / 4).alias("txn_count"), F.cos(x / 7).alias("a"),
        (x % 24).alias("b"), F.lit(2.0).alias("c")).repartition(parts)


@pytest.mark.parametrize("cell", ["rnn", "gru", "lstm"])
def test_gradient_is_that_of_finite_differences(cell):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(7, 5, 3)), rng.normal(size=7)
    flat = RC.initial_weights(cell, 3, 4, 2) + 0.05 * rng.normal(size=len(RC.initial_weights(cell, 3, 4, 2)))
    loss, grad = RC.loss_and_gradient(cell, flat, 4, x, y)
    assert loss == pytest.approx(((RC.predict(cell, flat, 4, x) - y) ** 2).sum())
    for k in range(len(flat)):
        step = np.zeros(len(flat))
        step[k] = 1e-6
        up, down = (((RC.predict(cell, flat + s, 4, x) - y) ** 2).sum() for s in (step, -step))
        assert grad[k] == pytest.approx((up - down) / 2e-6, rel=1e-5, abs=1e-6)


def plain_training(pdf, cell, units, lookback, epochs, rate, seed):
    """The same training in one process: all windows as one batch, no blocks."""
    pdf = pdf.sort_values("idx")
    data = pdf[list(COLS)].to_numpy(float)
    low, high = data.min(0), data.max(0)
    data = np.where(high > low, (data - low) / np.where(high > low, high - low, 1), data - low)
    train = data[:int(len(data) * 0.8)]
    x = np.stack([train[t - lookback:t] for t in range(lookback, len(train))])
    y = train[lookback:, 0]
    cut = int(len(y) * 0.9)
    w = RC.initial_weights(cell, len(COLS), units, seed)
    m = v = np.zeros(len(w))
    seen = []
    for k in range(epochs + 1):
        loss, grad = RC.loss_and_gradient(cell, w, units, x[:cut], y[:cut])
        val = np.mean((RC.predict(cell, w, units, x[cut:]) - y[cut:]) ** 2)
        seen.append((loss / cut, val, w))
        g = grad / cut
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** (k + 1))) / (np.sqrt(v / (1 - 0.999 ** (k + 1))) + 1e-7)
    return seen, x, y


@pytest.mark.parametrize("cell", ["rnn", "gru", "lstm"])
def test_three_epochs_equal_one_process(spark, cell):
    df = features(spark)
    model, blocks = RC.fit_recurrent(df, COLS, lookback=12, cell=cell, units=5, epochs=3, block=100, seed=3)
    seen, x, y = plain_training(df.toPandas(), cell, 5, 12, 3, 0.01, 3)
    assert [h["loss"] for h in model.history] == pytest.approx([s[0] for s in seen], rel=1e-10)
    assert [h["val_loss"] for h in model.history] == pytest.approx([s[1] for s in seen], rel=1e-10)
    best = min(range(len(seen)), key=lambda k: seen[k][1])
    assert [h["epoch"] for h in model.history if h["is_best"]] == [best]
    np.testing.assert_allclose(model.weights, seen[best][2], rtol=1e-9, atol=1e-12)
    assert model.history[0]["n_windows"] + model.history[0]["n_val"] == len(y) == 420 * 0.8 - 12
    got = RC.predict_recurrent(model, blocks, "train").orderBy("idx").toPandas()
    low, high = df.agg(F.min("txn_count"), F.max("txn_count")).first()
    np.testing.assert_allclose(got["predicted"], RC.predict(cell, model.weights, 5, x) * (high - low) + low, rtol=1e-9)
    test = RC.predict_recurrent(model, blocks).orderBy("idx").toPandas()
    assert test["row"].tolist() == list(range(84 - 12)) and test["idx"].iloc[0] == 336 + 12
    true = df.toPandas().set_index("idx")["txn_count"]
    np.testing.assert_allclose(test["actual"], true.loc[test["idx"]], rtol=1e-9)


def test_same_weights_for_any_partitions(spark):
    runs = [RC.fit_recurrent(features(spark, parts=p), COLS, lookback=8, cell="gru", units=3, epochs=2, block=64)[0] for p in (1, 7)]
    assert (runs[0].weights == runs[1].weights).all()
    assert runs[0].history == runs[1].history


def test_early_stop_restores_the_best_weights(spark):
    df = features(spark, 200)
    model, _ = RC.fit_recurrent(df, COLS, lookback=6, cell="rnn", units=4, epochs=40, rate=0.5, patience=3, plateau=2, block=64)
    losses = [h["val_loss"] for h in model.history]
    best = losses.index(min(losses))
    assert len(losses) == best + 1 + 4 and model.history[-1]["rate"] < 0.5
    again, _ = RC.fit_recurrent(df, COLS, lookback=6, cell="rnn", units=4, epochs=best or 1, rate=0.5, patience=99, plateau=2, block=64)
    if best:
        assert (again.weights == model.weights).all()


def test_training_learns(spark):
    model, _ = RC.fit_recurrent(features(spark), COLS, lookback=12, cell="lstm", units=6, epochs=30, rate=0.05, block=128)
    assert min(h["val_loss"] for h in model.history) < 0.5 * model.history[0]["val_loss"]


def test_too_short_series(spark):
    with pytest.raises(ValueError, match="no train window"):
        RC.fit_recurrent(features(spark, 20), COLS, lookback=30, cell="rnn", units=2, epochs=1)


def test_network_survives_a_save(spark, tmp_path):
    from ratecast.sources import io as IO
    model, blocks = RC.fit_recurrent(features(spark, 200), COLS, lookback=6, cell="gru", units=3, epochs=1, block=64)
    IO.save_network(spark, model, str(tmp_path / "net"))
    again = IO.load_network(spark, str(tmp_path / "net"))
    want = RC.predict_recurrent(model, blocks).orderBy("idx").collect()
    assert RC.predict_recurrent(again, blocks).orderBy("idx").collect() == want and len(want) == 40 - 6
