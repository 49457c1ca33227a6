"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Each source partition fingerprints its rows (JVM ``xxhash64`` of the normalised text),
   sorts the distinct fingerprints and sends each owner (a range of the fingerprint space)
   one Golomb-Rice coded message.
2. An owner decodes its messages and returns a bitmap of the fingerprints that came more
   than once. The owners' bitmaps make one bitmap of fixed size (``common.BITMAP_BITS``).
3. The sources filter their rows by the bitmap; only the suspects' texts are shuffled, and
   they are grouped by their bytes, copies being counted map-side first. A false suspect
   (fingerprint or bitmap collision) ends up in a group of its own.

Defined results: a null text counts as empty; texts are equal when identical after each run
of white space became one space; a null doc_id is larger than any other; of rows with equal
text and equal doc_id one is kept; an empty table gives an empty result; further columns
are ignored, or kept as they are by ``exact_dedup``.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import trimmed, BITMAP_BITS, SPACES, broadcast_bitmap, marked_rows, scratch_table, sha_hex, text_or_empty

FP_BITS = 48          # bits of a fingerprint that are exchanged
ROWS_PER_OWNER = 1 << 20
MESSAGE_ROWS = 1 << 22    # fingerprints of one message round: 32 MB of a task's memory


def normalised(col="text") -> Column:
    return F.regexp_replace(text_or_empty(col), SPACES, " ")


def golomb_encode(sorted_values: np.ndarray, universe: int) -> bytes:
    """Golomb-Rice code of sorted non-negative integers: gaps with parameter 2**k, the
    unary quotients and the k-bit remainders in two streams after a 9-byte header."""
    n = len(sorted_values)
    gaps = np.diff(sorted_values.astype(np.int64), prepend=0)
    k = max(0, int(np.floor(np.log2(max(1.0, 0.69 * universe / max(n, 1))))))
    ends = np.cumsum((gaps >> k) + 1)
    unary = np.zeros(int(ends[-1]) if n else 0, np.uint8)
    unary[ends - 1] = 1
    rest = ((gaps[:, None] >> np.arange(k)[None, :]) & 1).astype(np.uint8)
    return (np.array([n], "<u8").tobytes() + bytes([k]) + np.array([len(unary)], "<u8").tobytes()
            + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes())


def golomb_decode(message: bytes) -> np.ndarray:
    n, k, bits = int(np.frombuffer(message, "<u8", 1)[0]), message[8], int(np.frombuffer(message, "<u8", 1, 9)[0])
    cut = 17 + (bits + 7) // 8
    unary = np.unpackbits(np.frombuffer(message[17:cut], np.uint8), count=bits)
    ends = np.flatnonzero(unary)
    quotient = np.diff(ends, prepend=-1) - 1
    rest = np.unpackbits(np.frombuffer(message[cut:], np.uint8), count=n * k).reshape(n, k).astype(np.int64)
    return np.cumsum((quotient.astype(np.int64) << k) + (rest << np.arange(k)[None, :]).sum(axis=1))


def messages(fps: DataFrame, owners: int) -> DataFrame:
    """(fp) -> (owner, message): per partition (of ``MESSAGE_ROWS`` rows, else several) and owner the sorted
    fingerprints, one that occurs again there being sent twice and no more often."""
    width = -(-(1 << FP_BITS) // owners)

    def sent(fps: list[np.ndarray]) -> pd.DataFrame:
        v, n = np.unique(np.concatenate(fps), return_counts=True)
        v = np.repeat(v.astype(np.int64), np.minimum(n, 2))
        cuts = np.searchsorted(v, np.arange(owners + 1, dtype=np.int64) * width)
        rows = [(o, golomb_encode(v[a:b] - o * width, width)) for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        return pd.DataFrame(rows, columns=["owner", "message"])

    def encode(batches):
        waiting, rows = [], 0
        for pdf in batches:
            waiting.append(pdf["fp"].to_numpy().view(np.uint64) >> np.uint64(64 - FP_BITS))
            rows += len(pdf)
            if rows >= MESSAGE_ROWS:
                yield sent(waiting)
                waiting, rows = [], 0
        if rows:
            yield sent(waiting)

    return fps.select("fp").mapInPandas(trimmed(encode), "owner int, message binary")


def duplicate_positions(sent: DataFrame, owners: int, bits: int = BITMAP_BITS) -> DataFrame:
    """Owner side: bitmap positions of the fingerprints that came at least twice."""
    width = -(-(1 << FP_BITS) // owners)

    def decode(key, pdf):
        v = np.sort(np.concatenate([golomb_decode(m) for m in pdf["message"]]))
        twice = np.unique(v[1:][v[1:] == v[:-1]]) + int(key[0]) * width
        return pd.DataFrame({"pos": twice >> (FP_BITS - bits)})

    return sent.groupBy("owner").applyInPandas(decode, "pos bigint")


def duplicate_bitmap(fps: DataFrame, rows: int):
    owners = max(1, -(-rows // ROWS_PER_OWNER))
    return broadcast_bitmap(duplicate_positions(messages(fps, owners), owners))


def suspects(docs: DataFrame, bitmap, suspect: bool = True) -> DataFrame:
    """The rows of ``docs(fp, ..)`` whose fingerprint the bitmap marks (or does not mark)."""
    return marked_rows(docs, bitmap, suspect, "fp")


def duplicate_groups(docs: DataFrame, bitmap) -> DataFrame:
    """(text_sha256, keep_id, group_size) of the texts that the suspects really share."""
    sus = suspects(docs.select("doc_id", normalised().alias("norm")).withColumn("fp", F.xxhash64("norm")), bitmap)
    return (sus.groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .filter("group_size > 1")
            .select(sha_hex(F.col("norm")).alias("text_sha256"), "keep_id", "group_size"))


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    light = scratch_table(
        docs.select("doc_id", normalised().alias("norm"))
        .select("doc_id", F.xxhash64("norm").alias("fp"), sha_hex(F.col("norm")).alias("text_sha256")), "fingerprints")
    bitmap = duplicate_bitmap(light, light.count())
    groups = duplicate_groups(docs, bitmap)
    alone = suspects(light, bitmap, suspect=False).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    counted = (suspects(light, bitmap).groupBy("text_sha256", "doc_id")
               .agg(F.count(F.lit(1)).alias("same")))
    shared = (counted.join(groups, "text_sha256", "left")
              .select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"), "text_sha256",
                      F.explode(F.sequence(F.lit(1).cast("bigint"), "same")).alias("copy"))
              .select("doc_id", "keep_id", "group_size",
                      (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256"))
    return alone.unionByName(shared)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows that the bitmap clears
    pass without a shuffle; of a group of equal texts the smallest doc_id stays."""
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    keyed = docs.select(row.alias("row"), normalised().alias("norm")).withColumn("fp", F.xxhash64("norm"))
    light = scratch_table(keyed.select("fp"), "fingerprints")
    bitmap = duplicate_bitmap(light, light.count())
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row"))
    if names[0] != "doc_id":
        order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("row"))
    held = suspects(keyed, bitmap).groupBy("norm").agg(F.min(order).alias("best")).select("best.row.*")
    return suspects(keyed.select("row", "fp"), bitmap, suspect=False).select("row.*").unionByName(held)
