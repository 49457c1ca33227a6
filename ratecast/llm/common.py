"""Helpers shared by the training-data operators: scratch tables, word and shingle hashes
computed with numpy over Arrow buffers, and fixed-size hash bitmaps.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``.
"""
from __future__ import annotations

import ctypes
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecast.session import checkpoint_dir

SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20
U64 = np.uint64


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: what follows
    sees the same rows however often it is computed, also after an executor is lost."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/ratecast-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def sha_hex(col: Column) -> Column:
    return F.sha2(F.encode(col, "UTF-8"), 256)


def batch_with(batch: pa.RecordBatch, keep: list[str], **more) -> pa.RecordBatch:
    """Columns of ``batch`` as they are (no trip through pandas, which turns integers with nulls
    into floats), and further ones."""
    cols = {c: batch.column(batch.schema.get_field_index(c)) for c in keep} | {
        k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in more.items()}
    return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def trimmed(run):
    """``run`` for mapInArrow or mapInPandas that gives freed memory back when it is done: a Python worker
    waits for its next task, and what its allocators keep would count against the executor meanwhile."""
    def wrapped(batches):
        yield from run(batches)
        release()
    return wrapped


def release() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):        # another C library: nothing to trim
        pass


def first_by_hash(df: DataFrame, place: Column, bits: int, order: list, rows: int) -> pd.DataFrame:
    """The first ``rows`` rows of ``df`` in ``order``, which starts with a hash; ``place`` is that hash's value in ``[0, 2**bits)`` in the
    same order. Only the hashes that hold about twice ``rows`` go to the driver's merge, however many partitions there are (a few
    repeated hashes can make that too few: then all take part)."""
    n = df.count()
    if n > 4 * rows:
        some = df.filter(place < F.lit(int(2 * rows / n * 2.0**bits))).orderBy(*order).limit(rows).toPandas()
        if len(some) == rows:
            return some
    return df.orderBy(*order).limit(rows).toPandas()


def kind_of(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


# ---------------------------------------------------------------- word hashes

def _rand(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**64 - 1, n, dtype=U64) | U64(1)


_BYTE = _rand(256, 11)
_BYTE[[32, *range(9, 14)]] = 0
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_STEP = U64(0x9E3779B97F4A7C15)
_SLOT = _rand(5, 12)
_PAD = U64(0x5851F42D4C957F2D)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, xor-shift)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def arrow_texts(column) -> pa.LargeStringArray:
    """One contiguous array of texts, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def _bytes_of(arr: pa.LargeStringArray):
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data, offsets


def _hash_slice(b: np.ndarray, doc_starts: np.ndarray):
    """Hashes and start offsets of the words in ``b``; a word never crosses a doc start."""
    space = _SPACE[b]
    first = ~space
    first[1:] &= space[:-1]
    inner = doc_starts[doc_starts < len(b)]
    first[inner] = ~space[inner]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, U64), starts
    seg = np.diff(np.append(starts, len(b)))
    pos = np.arange(starts[0], len(b)) - np.repeat(starts, seg)
    power = np.cumprod(np.full(int(seg.max()), _STEP, U64))
    v = _BYTE[b[starts[0]:]] * power[pos]
    return mix64(np.add.reduceat(v, starts - starts[0])), starts


def word_hashes(arr: pa.LargeStringArray):
    """64-bit hash of every word of every text, and the number of words of each text.
    Works through slices of about ``CHUNK_BYTES``; a longer text is cut at white space."""
    data, off = _bytes_of(arr)
    n = len(arr)
    counts = np.zeros(n, np.int64)
    parts = []
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + CHUNK_BYTES, "right")) - 1
        if j > i:                                   # whole texts i .. j-1
            j = min(j, n)
            lo = off[i]
            h, starts = _hash_slice(data[lo:off[j]], off[i:j] - lo)
            counts[i:j] = np.diff(np.searchsorted(starts, off[i:j + 1] - lo))
            parts.append(h)
            i = j
            continue
        lo, end = int(off[i]), int(off[i + 1])      # one long text
        while lo < end:
            hi = min(lo + CHUNK_BYTES, end)
            while hi < end and not _SPACE[data[hi]]:
                hi = min(hi + 4096, end)
                cut = np.flatnonzero(_SPACE[data[hi - 4096:hi]])
                if hi < end and len(cut):
                    hi = hi - 4096 + int(cut[-1])
                    break
            h, _ = _hash_slice(data[lo:hi], np.zeros(1, np.int64))
            counts[i] += len(h)
            parts.append(h)
            lo = hi
        i += 1
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), counts


def shingle_sets(words: np.ndarray, counts: np.ndarray, width: int = 5):
    """Per text the sorted distinct hashes of its ``width``-word windows. A text of
    1 .. width-1 words has one window, all its words; a text without words has none."""
    ends = np.cumsum(counts)
    for c, e in zip(counts.tolist(), ends.tolist()):
        if c == 0:
            yield np.zeros(0, U64)
            continue
        w = words[e - c:e]
        if c < width:
            w = np.concatenate([w, np.full(width - c, _PAD, U64)])
        s = w[:len(w) - width + 1] * _SLOT[0]
        for k in range(1, width):
            s = s + w[k:len(w) - width + 1 + k] * _SLOT[k]
        yield np.unique(mix64(s))


# ---------------------------------------------------------------- hash bitmaps

#: The bitmap covers hash values by their top ``BITMAP_BITS`` bits: 16 MB for ever, so its
#: broadcast is bounded. When it fills up, more rows pass the filter; none is lost, as
#: every use checks exactly afterwards.
BITMAP_BITS = 27
_OWNER_BITS = 17     # one bitmap row covers 2**17 positions


def broadcast_bitmap(positions: DataFrame, bits: int = BITMAP_BITS):
    """``positions(pos bigint)`` in ``[0, 2**bits)`` -> broadcast zlib-packed bitmap.
    The rows of one owner (a range of 2**17 positions) are aggregated in Spark to one
    16 KB binary; the driver only concatenates at most 2**bits / 8 bytes."""
    spark = positions.sparkSession

    def pack(batches):
        for pdf in batches:
            rows = []
            for owner, g in pdf.groupby("owner"):
                cells = np.zeros(1 << _OWNER_BITS, np.uint8)
                cells[g["pos"].to_numpy() & ((1 << _OWNER_BITS) - 1)] = 1
                rows.append((int(owner), zlib.compress(np.packbits(cells).tobytes(), 1)))
            yield pd.DataFrame(rows, columns=["owner", "cells"])

    owned = (positions.select("pos").distinct()
             .withColumn("owner", F.shiftright("pos", _OWNER_BITS)))
    owned = owned.repartition("owner").sortWithinPartitions("owner")
    out = np.zeros((1 << bits) // 8, np.uint8)
    step = (1 << _OWNER_BITS) // 8
    for row in owned.mapInPandas(pack, "owner bigint, cells binary").collect():
        out[row.owner * step:(row.owner + 1) * step] |= np.frombuffer(zlib.decompress(row.cells), np.uint8)
    return spark.sparkContext.broadcast(zlib.compress(out.tobytes(), 1))


class Bitmap:
    """Worker-side view of a broadcast bitmap."""

    def __init__(self, packed: bytes):
        self.cells = np.frombuffer(zlib.decompress(packed), np.uint8)

    def has(self, pos: np.ndarray) -> np.ndarray:
        return (self.cells[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8)) & 1 == 1


def marked_rows(df: DataFrame, bitmap, marked: bool, key: str = "key") -> DataFrame:
    """The rows of ``df`` whose 64-bit hash in column ``key`` the bitmap marks, or does not mark."""
    def narrow(batches):
        cells = Bitmap(bitmap.value)
        for b in batches:
            h = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False).view(np.uint64)
            yield b.filter(pa.array(cells.has((h >> U64(64 - BITMAP_BITS)).astype(np.int64)) == marked))

    return df.mapInArrow(trimmed(narrow), df.schema)


def top_bits(h: Column, bits: int) -> Column:
    """The top bits of a 64-bit hash as a non-negative number."""
    return F.shiftrightunsigned(h, 64 - bits)
