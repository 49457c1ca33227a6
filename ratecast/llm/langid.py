"""Language ID by multilingual mixture inference.

Training counts hashed character trigrams per language over all training documents in Spark (numpy per
Arrow batch, then a sum per language and gram); the model is a table of languages times 2**16
gram classes. A document's trigrams come from a mixture of languages: expectation-maximisation
estimates the proportions, and languages are added to the set one by one while the
log-likelihood grows by more than ``PENALTY`` * log(number of trigrams) / 2.
The predicted language has the largest proportion; the score is that proportion times the
posterior of the best single language against the others.

Defined results: ``und`` and score 0 for null texts, texts without letters, or without a trained
language; rows without lang are not trained on; a null doc_id is not held out; repeated rows count as
often as they occur; ties go to the language first by code point.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import trimmed, batch_with, kind_of

GRAM_BITS = 16
SMOOTHING = 0.1
PENALTY = 6.0
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LETTER = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def grams(text: str | None) -> np.ndarray:
    """Gram classes of a text: trigrams of lower-case letters, all else being a boundary;
    only trigrams whose middle is a letter."""
    if not text:
        return np.zeros(0, np.int64)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(_letters()[c], c, np.uint32(32))
    c = np.concatenate([[32], c, [32]]).astype(np.uint64)
    mid = c[1:-1] != 32
    h = ((c[:-2] * _K[0]) ^ (c[1:-1] * _K[1]) ^ (c[2:] * _K[2])) * _K[3]
    return (h[mid] >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray] | None:
    """(languages, log-probabilities [language, gram class]) from ``docs(text, lang)``."""
    size = 1 << GRAM_BITS

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, g in pdf.groupby("lang"):
                t = total.setdefault(lang, np.zeros(size, np.int64))
                waiting, n = [], 0
                for text in g["text"]:
                    waiting.append(grams(text))
                    n += len(waiting[-1])
                    if n > 1 << 20:
                        t += np.bincount(np.concatenate(waiting), minlength=size)
                        waiting, n = [], 0
                if waiting:
                    t += np.bincount(np.concatenate(waiting), minlength=size)
        for lang, t in total.items():
            at = np.flatnonzero(t)
            yield pd.DataFrame({"lang": lang, "gram": at, "n": t[at]})

    sums = (docs.filter("lang is not null and text is not null").select("text", "lang")
            .mapInPandas(trimmed(count), "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # at most languages * 2**16 rows, whatever the corpus
    pdf = sums.toPandas()
    if not len(pdf):
        return None
    langs = sorted(pdf["lang"].unique())
    table = np.zeros((len(langs), size))
    table[pdf["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(), pdf["gram"].to_numpy()] = pdf["n"]
    table += SMOOTHING
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def mixture(p: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """EM for the proportions of a mixture with component likelihoods ``p[language, gram]``."""
    w = np.full(len(p), 1 / len(p))
    for _ in range(steps):
        r = w[:, None] * p
        r /= r.sum(axis=0)
        new = r.mean(axis=1)
        done = np.abs(new - w).max() < 1e-4
        w = new
        if done:
            break
    return w, float(np.log(w @ p).sum())


def _gain(ratio: np.ndarray, steps: int = 12) -> float:
    """Log-likelihood won by mixing a second language in; ratio is its likelihood over the
    present mixture's, gram by gram."""
    w = 0.1
    for _ in range(steps):
        t = w * ratio
        t /= (1 - w) + t
        new = float(t.mean())
        if abs(new - w) < 1e-3:
            w = new
            break
        w = new
    return float(np.log1p(w * (ratio - 1)).sum())


def infer(table: np.ndarray, g: np.ndarray) -> tuple[int, float, dict[int, float]]:
    """(language, score, {language: proportion}) of a document's grams."""
    lp = table[:, g].astype(float)
    single = lp.sum(axis=1)
    first = int(np.argmax(single))
    post = 1 / np.exp(np.minimum(single - single[first], 0.0)).sum()
    p = np.exp(lp - lp.max(axis=0))
    chosen, weights, price = [first], np.ones(1), PENALTY * 0.5 * np.log(max(len(g), 2))
    while len(chosen) < len(table):
        now = weights @ p[chosen]
        gains = {j: _gain(p[j] / now) for j in range(len(table)) if j not in chosen}
        best = max(gains, key=gains.get)
        if not gains[best] > price:
            break
        chosen.append(best)
        weights, _ = mixture(p[chosen])
    k = int(np.argmax(weights))
    return chosen[k], float(weights[k] * (post if len(chosen) == 1 else 1.0)), dict(zip(chosen, weights.tolist()))


def predict(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages (all chosen ones, e.g. ``en:0.73,fr:0.27``)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        langs, t = shared.value if shared.value is not None else ([], None)
        for b in batches:
            preds, scores, mixes = [], [], []
            for text in b.column("text"):
                g = grams(text.as_py())
                k, s, mix = infer(t, g) if t is not None and len(g) else (-1, 0.0, {})
                preds.append(langs[k] if k >= 0 else "und")
                scores.append(min(1.0, max(0.0, s)))
                mixes.append(",".join(f"{langs[j]}:{w:.2f}" for j, w in sorted(mix.items(), key=lambda x: -x[1])))
            yield batch_with(b, ["doc_id", "held_out"], lang_pred=pa.array(preds, pa.string()),
                             score=pa.array(scores, pa.float64()), languages=pa.array(mixes, pa.string()))

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        trimmed(run), f"doc_id {kind_of(docs, 'doc_id')}, held_out boolean, lang_pred string, score double, languages string")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs.filter(~held_out())))
