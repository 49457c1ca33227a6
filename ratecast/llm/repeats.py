"""Repeated passages over a corpus: bytes covered by a string of LENGTH bytes that also starts elsewhere.

A window is a string of LENGTH bytes of one text. Equal windows must meet, but a row for each byte is too many.
Each window is owned by one of its GRAM-byte strings, the one of the least hash (the first of equals): equal
windows have equal owners at the same offset. Consecutive windows of one owner are a run, some 130 windows
in plain text, and its bytes a segment. A corpus of n bytes has about n / 137 runs.

1. One scan finds the runs: a rolling hash, a sliding minimum over it, and a 128-bit digest of each segment. Segments that
   occur twice in a text are marked there, and go on once.
2. Runs whose owner occurs once are unique and leave. Equal segments (partial counts first) that occur twice or
   more are repeats as a whole, without a look at their bytes, however many copies there are.
3. What is left are owners with several different segments: ends of shared passages and edits in near copies. The bytes of one copy of
   each such segment are fetched, and all segments of an owner meet in one task as an enhanced suffix array: window suffixes in
   order with their common prefix lengths. A stack scan walks its interval tree; an interval of LENGTH bytes or more
   whose occurrences differ in the byte before them (or start a segment) is a maximal repeat, and
   all its occurrences are marked, not only neighbours.
4. An owner with more than BUCKET different segments (a common line in different surroundings) never meets as
   one group: its runs are cut into runs of at most 16 windows, which share a core of LENGTH - 15 bytes, and these are owners of their
   own; where that is too many again, into single windows. Nothing is dropped.
5. Marks go back to the texts by segment digest; each text is cut once.

Texts are told apart by the first 128 bits of their SHA-256, so a text's copies are worked on once. Fixed-size bitmaps (16 MB)
keep texts without marks out of the two joins with texts; when they fill up, more texts are shuffled and results stay.

Defined results: null text is empty; texts under LENGTH bytes have no window and stay whole; matches never cross texts, and
overlapping ones in a text count; repeated rows (also of one doc_id) are other texts; any bytes are data (no byte is a
separator); rows of null doc_id are returned like others; an empty table gives an empty result; further columns are ignored.
"""
from __future__ import annotations

from collections import Counter
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (BITMAP_BITS, U64, _rand, arrow_texts, broadcast_bitmap, marked_rows, mix64, scratch_table, sha_hex, text_or_empty,
                     top_bits, trimmed)

LENGTH = 400
GRAM = 128
BUCKET = 512
GRIDS = (16, 1)
SLICE = 1 << 20          # window starts looked at together
VOLUME = 1 << 18         # bytes of one suffix array, but whole owners

_BYTES = _rand(256, 21)
_BASE = U64(0x9E3779B97F4A7C15)
_BACK = U64(pow(int(_BASE), -1, 1 << 64))
_LOW = U64((1 << 21) - 1)


# ---------------------------------------------------------------- one text

def _powers(base, n: int) -> np.ndarray:
    p = np.full(n, base, U64)
    p[:1] = 1
    return np.cumprod(p)


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each string of GRAM bytes."""
    sums = np.zeros(len(b) + 1, U64)
    np.cumsum(_BYTES[b] * _powers(_BASE, len(b)), out=sums[1:])
    return mix64((sums[GRAM:] - sums[:-GRAM]) * _powers(_BACK, len(b) - GRAM + 1))


def runs_of(b: np.ndarray):
    """(first window, number of windows, owner's place, owner's hash) of each run of a text, in order."""
    width = LENGTH - GRAM + 1
    for lo in range(0, len(b) - LENGTH + 1, SLICE):
        h = gram_hashes(b[lo:lo + SLICE + LENGTH - 1])
        n = len(h) - width + 1
        # least hash of each window, places as low bits: the first of equals
        key = (h & ~_LOW) | np.arange(len(h), dtype=U64)
        cells = np.concatenate([key, np.full(-len(key) % width, ~U64(0), U64)]).reshape(-1, width)
        ahead = np.minimum.accumulate(cells, 1).ravel()
        back = np.minimum.accumulate(cells[:, ::-1], 1)[:, ::-1].ravel()
        own = np.minimum(back[:n], ahead[width - 1:width - 1 + n]) & _LOW
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        count = np.diff(np.append(first, n))
        place = own[first].astype(np.int64)
        yield from zip((first + lo).tolist(), count.tolist(), (place + lo).tolist(), h[place].view(np.int64).tolist())


def halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:16], "big", signed=True)


def digest_of(data) -> tuple[int, int]:
    return halves(blake2b(data, digest_size=16).digest())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of [start, end) spans, touching ones joined, in order."""
    out: list[list[int]] = []
    for a, e in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([a, e])
    return [tuple(x) for x in out]


def scan(text: bytes):
    """Runs of one text: (core, digest, copies, start, windows, lead); a segment that occurs again in the text goes on once with its
    copies, and all its places are rows without a core."""
    if len(text) < LENGTH:
        return
    view, seen, again = memoryview(text), {}, Counter()
    places = []
    for start, n, owner, core in runs_of(np.frombuffer(text, np.uint8)):
        key = (core, *digest_of(view[start:start + n + LENGTH - 1]))
        if key in seen:
            again[key] += 1
            places.append((start, start + n))
        else:
            seen[key] = (start, n, owner - start)
    places += [(seen[key][0], seen[key][0] + seen[key][1]) for key in again]
    for (core, d1, d2), at in seen.items():
        yield core, d1, d2, 1 + again[core, d1, d2], *at
    for a, e in merged(places):
        yield None, None, None, 0, a, e - a, 0


# ---------------------------------------------------------------- enhanced suffix array

def suffix_array(segs: list[bytes], length: int):
    """Window suffixes of all segments in order, their common prefix lengths (entry i: with i - 1), the text with its ends,
    and each text position's segment. Prefix doubling; common prefixes from the ranks of the doublings."""
    sizes = np.fromiter(map(len, segs), np.int64, len(segs))
    total = int(sizes.sum()) + len(segs)
    text = np.zeros(total, np.int64)                  # bytes + 1, and 0 behind each segment
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    owner = np.repeat(np.arange(len(segs)), sizes + 1)
    text[np.arange(total) - first[owner] < sizes[owner]] = np.frombuffer(b"".join(segs), np.uint8).astype(np.int64) + 1
    end = (first + sizes)[owner]
    starts = np.flatnonzero(end - np.arange(total) >= length)

    def at(a, h):
        return np.concatenate([a[h:], np.zeros(min(h, total), a.dtype)])

    key = np.zeros(total, np.int64)
    for j in range(7):
        key = key * 257 + at(text, j)
    ranks, h = [], 7
    while True:
        _, rank = np.unique(key, return_inverse=True)
        ranks.append((h, rank))
        if h >= int(sizes.max(initial=0)):
            break
        key = (rank + 1) * (total + 2) + np.concatenate([rank[h:] + 1, np.zeros(min(h, total), np.int64)])
        h *= 2
    order = starts[np.argsort(ranks[-1][1][starts], kind="stable")]
    i, j = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(i), np.int64)
    for h, rank in reversed(ranks):
        more = np.append(rank, [-1])
        same = more[np.minimum(i + lcp, total)] == more[np.minimum(j + lcp, total)]
        lcp += h * (same & (i + lcp < total) & (j + lcp < total))
    for _ in range(6):
        a, b = np.minimum(i + lcp, total - 1), np.minimum(j + lcp, total - 1)
        lcp += (text[a] == text[b]) & (text[a] > 0)
    lcp = np.minimum(lcp, np.minimum(end[i] - i, end[j] - j))     # not past the end of either
    return order, np.concatenate([[0], lcp])[:len(order)], text, first, owner


def maximal_repeats(segs: list[bytes], length: int):
    """(prefix length, text positions of all occurrences) of each maximal repeat of ``length`` bytes or more among the
    segments, and where each segment starts. Walks the interval tree of the suffix array with a stack; an interval counts when the
    bytes before its occurrences differ (the start of a segment differs from all)."""
    order, lcp, text, first, _ = suffix_array(segs, length)
    left = np.where(order > 0, text[order - 1], 0)                # 0: start of a segment
    deep = lcp >= length
    begin = np.flatnonzero(deep & ~np.concatenate([[False], deep[:-1]])) - 1 if len(deep) else []
    groups = []
    for lo in begin:
        hi = lo + 1
        while hi < len(order) and deep[hi]:
            hi += 1
        lefts = left[lo:hi]
        if lefts[0] and (lefts == lefts[0]).all():
            continue                                              # the same strings start one byte earlier
        stack: list[list[int]] = []                               # [prefix length, first entry, byte before all or 0]
        depth, before = lcp[lo + 1:hi].tolist() + [0], lefts.tolist()
        for k, d in enumerate(depth):
            entry, byte = k, before[k]
            while stack and stack[-1][0] > d:
                size, entry, same = stack.pop()
                byte = byte if byte == same else 0
                if not byte:
                    groups.append((size, order[lo + entry:lo + k + 1]))
            if d >= length:
                if stack and stack[-1][0] == d:
                    stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else 0
                else:
                    stack.append([d, entry, byte])
    return groups, first


def repeated_windows(segs: list[bytes], length: int):
    """(segment, first window, windows) of the windows that occur twice or more among the segments."""
    groups, first = maximal_repeats(segs, length)
    if not groups:
        return
    size = int(first[-1]) + len(segs[-1]) + 1
    marks = np.zeros(size + 1, np.int64)
    for n, at in groups:
        np.add.at(marks, at, 1)
        np.add.at(marks, at + (n - length + 1), -1)
    hit = np.concatenate([[False], np.cumsum(marks[:size]) > 0, [False]])
    edge = np.flatnonzero(hit[1:] != hit[:-1])
    owner = np.searchsorted(first, edge[::2], "right") - 1
    yield from zip(owner.tolist(), (edge[::2] - first[owner]).tolist(), (edge[1::2] - edge[::2]).tolist())


# ---------------------------------------------------------------- DataFrames

_SEG = "core bigint, d1 bigint, d2 bigint"
_AT = "t1 bigint, t2 bigint, start bigint, n bigint, lead bigint"
_MARK = "d1 bigint, d2 bigint, rel bigint, cnt bigint"


def _types(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.large_binary()}
    return pa.schema([(c, kinds[k]) for c, k in (x.split() for x in ddl.split(", "))])


def _batched(rows, ddl: str, size: int = 10_000, volume: int = 1 << 22):
    schema, kept, held = _types(ddl), [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)

    for r in rows:
        kept.append(r)
        held += sum(len(v) for v in r if isinstance(v, bytes))
        if len(kept) >= size or held >= volume:
            yield batch()
            kept, held = [], 0
    if kept:
        yield batch()


def _mapped(df: DataFrame, rows_of, ddl: str) -> DataFrame:
    """mapInArrow of a function from an iterator of row tuples to an iterator of row tuples."""
    names = df.columns

    def run(batches):
        def rows():
            for b in batches:
                yield from zip(*(_values(b, c) for c in names))
        return _batched(rows_of(rows()), ddl)

    return df.mapInArrow(trimmed(run), ddl.replace("large_binary", "binary"))


def _values(b: pa.RecordBatch, c: str):
    """One column's values; texts as bytes, one at a time."""
    col = b.column(b.schema.get_field_index(c))
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        return (v.as_buffer().to_pybytes() for v in arrow_texts(col))
    return col.to_pylist()


def _half(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("bigint")


def with_text_id(docs: DataFrame, *cols: str) -> DataFrame:
    return (docs.select(*cols, text_or_empty("text").alias("text")).withColumn("sha", sha_hex(F.col("text")))
            .withColumns({"t1": _half(F.col("sha"), 0), "t2": _half(F.col("sha"), 1)}))


def _marked_texts(docs: DataFrame, ids: DataFrame, marked: bool = True) -> DataFrame:
    """Rows of ``docs`` whose text id is (or is not) among ``ids``; some more are when the bitmap fills up."""
    bits = broadcast_bitmap(ids.select(top_bits(F.col("t1"), BITMAP_BITS).alias("pos")))
    return marked_rows(docs, bits, marked, "t1")


def corpus_runs(docs: DataFrame) -> DataFrame:
    """Runs of all texts that have a window."""
    def rows(texts):
        for (text,) in texts:
            if len(text) >= LENGTH:
                t1, t2 = halves(sha256(text).digest())
                for core, d1, d2, copies, *at in scan(text):
                    yield core, d1, d2, copies, t1, t2, *at

    return _mapped(docs.select(text_or_empty("text").alias("text")), rows, f"{_SEG}, copies bigint, {_AT}")


def _cut(text: bytes, start: int, n: int, lead: int, grid: int):
    """A run in pieces of at most ``grid`` windows whose offsets before the owner are of one grid cell:
    (core, d1, d2, start, windows, lead). The core is a digest of the bytes that all windows of the cell have."""
    owner, s = start + lead, start
    while s < start + n:
        cell = (owner - s) // grid
        stop = min(owner - cell * grid + 1, start + n)          # windows s .. stop - 1 have this cell
        core = text[owner - cell * grid:owner - (cell + 1) * grid + 1 + LENGTH]
        yield digest_of(core)[0], *digest_of(text[s:stop + LENGTH - 1]), s, stop - s, owner - s
        s = stop


def _bytes_for(need: DataFrame, docs: DataFrame, work, ddl: str) -> DataFrame:
    """``work(text, row)`` for each row of ``need`` (t1, t2 and others) with the text of that id."""
    cols = [c for c in need.columns if c not in ("t1", "t2")]
    wanted = need.groupBy("t1", "t2").agg(F.collect_list(F.struct(*cols)).alias("rows"))
    texts = _marked_texts(docs.select("t1", "t2", "text"), need).dropDuplicates(["t1", "t2"])

    def rows(joined):
        for text, wants in joined:
            for w in wants:
                yield from work(text, w)

    return _mapped(texts.join(wanted, ["t1", "t2"]).select("text", "rows"), rows, ddl)


def _marks_of_owners(segments: DataFrame) -> DataFrame:
    """``segments(core, d1, d2, data)`` -> marked windows of each, from the suffix array of its owner's segments."""
    def rows(sorted_rows):
        kept, held, last = [], 0, None
        for core, d1, d2, data in sorted_rows:
            if held >= VOLUME and core != last:
                yield from marks(kept)
                kept, held = [], 0
            kept.append((d1, d2, data))
            held, last = held + len(data), core
        if kept:
            yield from marks(kept)

    def marks(kept):
        for k, at, n in repeated_windows([x[2] for x in kept], LENGTH):
            yield kept[k][0], kept[k][1], at, n

    return _mapped(segments.repartition("core").sortWithinPartitions("core"), rows, _MARK)


def marked_windows(segs: DataFrame, docs: DataFrame, grids: tuple[int, ...]) -> DataFrame:
    """``segs(core, d1, d2, copies, t1, t2, start, n, lead)``, rows of equal digest being equal segments -> (d1, d2, rel, cnt): of the
    segment with this digest, ``cnt`` windows from the ``rel``-th on occur twice or more."""
    one = scratch_table(segs.groupBy("core", "d1", "d2").agg(F.sum("copies").alias("copies"),
                                                            F.min(F.struct("t1", "t2", "start", "n", "lead")).alias("at"))
                        .select("core", "d1", "d2", "copies", "at.*"), "segments")
    whole = one.filter("copies > 1").select("d1", "d2", F.lit(0).cast("bigint").alias("rel"), F.col("n").alias("cnt"))
    if not grids:
        return whole                                # windows alone: equal ones have equal digests
    shared = scratch_table(one.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("copies").alias("least"))
                           .filter("kinds > 1 and least = 1").select("core", "kinds"), "several")
    need = scratch_table(one.join(shared, "core"), "shared-owners")
    few, many = need.filter(F.col("kinds") <= BUCKET), need.filter(F.col("kinds") > BUCKET)
    data = _bytes_for(few.select("t1", "t2", "core", "d1", "d2", "start", "n"), docs,
                      lambda text, w: [(w["core"], w["d1"], w["d2"], text[w["start"]:w["start"] + w["n"] + LENGTH - 1])], f"{_SEG}, data binary")
    marks = whole.unionByName(_marks_of_owners(data))
    if many.isEmpty():
        return marks
    grid = grids[0]
    parts = scratch_table(_bytes_for(
        many.select("t1", "t2", "copies", "start", "n", "lead", "d1", "d2", F.col("t1").alias("x1"), F.col("t2").alias("x2")), docs,
        lambda text, w: [(w["d1"], w["d2"], s - w["start"], core, c1, c2, w["copies"], w["x1"], w["x2"], s, n, lead)
                         for core, c1, c2, s, n, lead in _cut(text, w["start"], w["n"], w["lead"], grid)],
        f"p1 bigint, p2 bigint, off bigint, {_SEG}, copies bigint, {_AT}"), "pieces")
    inner = marked_windows(parts.drop("p1", "p2", "off"), docs, grids[1:])
    return marks.unionByName(inner.join(parts.select("p1", "p2", "off", "d1", "d2"), ["d1", "d2"])
                             .select(F.col("p1").alias("d1"), F.col("p2").alias("d2"), (F.col("off") + F.col("rel")).alias("rel"), "cnt"))


def repeat_spans(docs: DataFrame) -> DataFrame:
    """(t1, t2, spans) for each text with a repeat: starts and numbers of its repeated windows, unordered."""
    texts = with_text_id(docs)
    runs = scratch_table(corpus_runs(docs), "runs")
    owned = runs.filter("core is not null")
    # written, so that the join below is one of two tables, which Spark can split where an owner is common
    twice = scratch_table(owned.groupBy("core").agg(F.sum("copies").alias("c")).filter("c > 1").select("core"), "owners")
    # equal texts have the same rows: one row with all copies, added up before anything meets by owner
    alike = owned.groupBy("core", "d1", "d2", "t1", "t2", "start", "n", "lead").agg(F.sum("copies").alias("copies"))
    segs = scratch_table(alike.join(twice, "core"), "owned")
    marks = marked_windows(segs, texts, GRIDS)
    found = marks.join(segs.select("d1", "d2", "t1", "t2", "start"), ["d1", "d2"]).select(
        "t1", "t2", (F.col("start") + F.col("rel")).alias("start"), "cnt")
    inside = runs.filter("core is null").select("t1", "t2", "start", F.col("n").alias("cnt"))
    return found.unionByName(inside).groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "cnt")).alias("spans"))


def strip_repeats(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = scratch_table(repeat_spans(docs), "spans")
    texts = with_text_id(docs, "doc_id")
    ids = spans.select("t1")
    size = F.octet_length("text").cast("bigint").alias("n_bytes")
    zero = F.lit(0).cast("bigint")
    whole = _marked_texts(texts.select("doc_id", "t1", size, F.col("sha").alias("kept_sha256")), ids, False).select(
        "doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256")
    hit = _marked_texts(texts.select("doc_id", "t1", "t2", "text"), ids).join(spans, ["t1", "t2"], "left").select("doc_id", "text", "spans")

    def cut(batches):
        for b in batches:
            rows = []
            for text, found in zip(_values(b, "text"), _values(b, "spans")):
                digest, at, gone = sha256(), 0, merged([(s["start"], s["start"] + s["cnt"] + LENGTH - 1) for s in found or ()])
                for a, e in gone:
                    digest.update(memoryview(text)[at:a])
                    at = e
                digest.update(memoryview(text)[at:])
                rows.append((len(text), sum(e - a for a, e in gone), len(gone), digest.hexdigest()))
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), *(pa.array(c, pa.int64()) for c in cols[:3]),
                                              pa.array(cols[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return whole.unionByName(hit.mapInArrow(trimmed(cut), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))
