"""Quality rules: two fixed rules, then gradient-boosted trees over document statistics.

The statistics of all documents are taken in one Arrow pass over whole texts (byte histograms and
word hashes, no per-word Python). The trees are fitted on at most ``TRAIN_ROWS`` labelled
documents (those with the smallest md5 of their doc_id), four fifths to fit and one fifth to set the threshold: it lies
half-way between the score below which ``MAX_LOSS`` of the good documents held back lie and the next bad one's. More symbols, repeated lines,
repeated words or capitals can never raise a document's score (monotonic constraints).

Defined results: a null text has no words and fails the base rule; documents without a label are
judged alike; null labels are ignored; without labels of both kinds only the base rules
judge; repeated rows are judged one by one; an empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trees
from .common import arrow_texts, batch_with, first_by_hash, kind_of, mix64, scratch_table, trimmed, word_hashes

TRAIN_ROWS = 20_000
MAX_LOSS = 0.001
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: statistic -> direction in which the score may move as it grows
STATS = {"log_words": 0, "mean_word": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "capitals": -1,
         "digits": -1, "marks": -1, "bars": -1, "distinct": 0, "line_words": 0, "stops": 0}


def _is(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[list(chars)] = 1
    return t


_CLASSES = np.stack([
    np.array([(b & 0xC0) != 0x80 for b in range(256)], np.int64),      # 0 code points
    _is(b" \t\n\x0b\x0c\r"), _is(b"#*$%&|<>"),                          # 1 white space, 2 symbols
    _is(bytes(range(65, 91))), _is(bytes(range(97, 123))),              # 3 capitals, 4 small letters
    _is(bytes(range(48, 58))), _is(b"!?"), _is(b"|"), _is(b"."), _is(b"\n")], 1)   # 5 .. 9


def _histogram(data: np.ndarray) -> np.ndarray:
    out = np.zeros(256, np.int64)
    for a in range(0, len(data), 1 << 20):
        out += np.bincount(data[a:a + (1 << 20)], minlength=256)
    return out


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def statistics(column) -> tuple[np.ndarray, np.ndarray]:
    """(base counts, statistics) of a column of texts, a row for each."""
    arr = arrow_texts(column)
    words, counts = word_hashes(arr)
    ends = np.cumsum(counts)
    base = np.zeros((len(arr), 5), np.int64)
    stats = np.zeros((len(arr), len(STATS)))
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    view = memoryview(raw) if raw is not None else memoryview(b"")
    for i in range(len(arr)):
        a, b = int(off[i]), int(off[i + 1])
        c = _histogram(data[a:b]) @ _CLASSES
        n = int(counts[i])
        w = words[ends[i] - n:ends[i]]
        repeat = 0
        if n >= 4:
            # sort the windows' hashes: equal neighbours are windows found twice or more
            tri = mix64(w[:-2] * np.uint64(3) + w[1:-1] * np.uint64(0x9E3779B97F4A7C15) + (w[2:] ^ (w[2:] >> np.uint64(7))))
            order = np.argsort(tri, kind="stable")
            same = tri[order][1:] == tri[order][:-1]
            if same.any():
                mark = np.zeros(n, bool)
                twice = np.zeros(n - 2, bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                for k in range(3):
                    mark[k:n - 2 + k] |= twice
                repeat = int(mark.sum())
        chars = int(c[0] - c[1])
        dup = _dup_lines(bytes(view[a:b])) if c[9] else 0
        base[i] = n, chars, c[2], dup, repeat
        k = max(n, 1)
        letters = max(int(c[3] + c[4]), 1)
        stats[i] = (np.log1p(n), chars / k, c[2] / k, dup / max(1, int(c[9]) + 1), repeat / k, c[3] / letters,
                    c[5] / max(chars, 1), c[6] / k, c[7] / k, len(np.unique(w)) / k, n / (int(c[9]) + 1), c[8] / k)
    return base, stats


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, base counts, statistics) of every row."""
    schema = ("doc_id " + kind_of(docs, "doc_id") + ", "
              + ", ".join(f"{c} bigint" for c in BASE) + ", " + ", ".join(f"{c} double" for c in STATS))

    def run(batches):
        for b in batches:
            base, stats = statistics(b.column("text"))
            yield batch_with(b, ["doc_id"], **{c: base[:, k] for k, c in enumerate(BASE)},
                             **{c: stats[:, k] for k, c in enumerate(STATS)})

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), schema)


def fit_model(stats: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict | None:
    """Trees and threshold from at most ``rows`` labelled documents; None without both labels."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    h = F.md5(F.col("doc_id").cast("string"))
    sample = first_by_hash(stats.select("doc_id", "n_words", "n_repeat_words", *STATS).join(known, "doc_id"),
                           F.conv(F.substring(h, 1, 12), 16, 10).cast("bigint"), 48, [h, "doc_id"], rows)
    failed = (sample["n_words"] < 50) | (100 * sample["n_repeat_words"] > 50 * sample["n_words"])
    sample = sample[~failed.to_numpy(bool)]
    x, y = sample[list(STATS)].to_numpy(float), (sample["quality"] > 0).to_numpy(float)
    if len(y) < 20 or y.min() == y.max():
        return None
    held = np.arange(len(y)) % 5 == 4
    model = trees.fit(x[~held], y[~held], np.array(list(STATS.values())))
    good, bad = (np.sort(trees.score(model, x[held & (y == k)])) for k in (1, 0))
    at = good[int(MAX_LOSS * len(good))] if len(good) else 1.0
    below = bad[bad < at].max(initial=0.0)
    return model | {"cut": float((at + below) / 2)}


def _accepts(model, base, stats):
    ok = ~base_failed(base)
    if model is not None:
        ok &= trees.score(model, stats) >= model["cut"]
    return ok


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five base counts, base_failed, kept, score."""
    stats = scratch_table(document_statistics(docs), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(fit_model(stats, labels))

    def run(batches):
        for b in batches:
            base, x = (np.stack([b.column(c).to_numpy() for c in names], 1) for names in (BASE, list(STATS)))
            p = trees.score(model.value, x) if model.value is not None else np.ones(len(x))
            yield batch_with(b, ["doc_id", *BASE], base_failed=base_failed(base),
                             kept=_accepts(model.value, base, x), score=p)

    schema = ("doc_id " + kind_of(docs, "doc_id") + ", "
              + ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, kept boolean, score double")
    return stats.mapInArrow(trimmed(run), schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    stats = scratch_table(document_statistics(docs), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(fit_model(stats, labels))

    def run(batches):
        for b in batches:
            base, x = statistics(b.column(b.schema.get_field_index("text")))
            yield b.filter(pa.array(_accepts(model.value, base, x)))

    return docs.mapInArrow(trimmed(run), docs.schema)
