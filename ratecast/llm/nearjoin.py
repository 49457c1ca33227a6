"""N-gram Jaccard join with Bayesian candidate pruning.

Sets are the five-word shingles of a text (64-bit hashes); texts link when their Jaccard similarity
is at least 0.8.

1. Texts with equal sets become one node (copies are counted, never paired).
2. Each node has 96 MinHash values; 24 bands of 4 give bucket keys: nodes that agree in a band share a bucket.
   A pair at similarity 0.8 shares no bucket with probability 3e-6. Buckets with the same nodes (told by their number and two
   hashes of 64 bits) count once: a group of near copies is compared once, not once a band.
3. Inside a bucket, pairs are compared in tiles of numpy arrays: MinHash values are
   compared 16 at a time, and a pair is dropped as soon as the posterior probability that its similarity reaches
   the threshold (uniform prior, binomial likelihood) falls below 1e-6. Texts that are linked only through chains of other
   texts are never compared. Only nodes that keep a partner go on, in the components of the kept pairs.
4. Their texts are fetched (a fixed-size bitmap filters the second scan, so only they are shuffled),
   and every kept pair is verified exactly on its shingle sets. Pairs are never rows: a
   tile gives each node's number of links and a spanning set of links.
5. Connected components of the verified links are the classes.

A bucket or component larger than a block is dealt out as pairs of blocks over many tasks, so no group
is collected into one task; the work on one group of m mutually linked, different texts is m^2/2
MinHash comparisons, which an exact number of links needs.

Defined results: a text with 1 to 4 words has one shingle, all its words; null and empty texts
have none, link to nothing and are classes of their own; texts with equal sets link; repeated rows count as
copies; class_id is the smallest doc_id of the class (null only if all are); an empty table gives
an empty result; further columns are ignored.
"""
from __future__ import annotations

from fractions import Fraction
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (trimmed, BITMAP_BITS, arrow_texts, batch_with, broadcast_bitmap, kind_of, marked_rows, mix64, scratch_table,
                     shingle_sets, text_or_empty, top_bits, word_hashes)
from .components import connected_components

WIDTH, THRESHOLD = 5, Fraction(4, 5)
BANDS, ROWS = 24, 4
VALUES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK_NODES, BLOCK_SHINGLES = 4096, 1_000_000
BUCKET_NODES = 1024       # nodes of one block of a bucket
TILE = 512
_SEEDS = np.random.Generator(np.random.PCG64(77)).integers(1, 2**64 - 1, (2, VALUES), dtype=np.uint64) | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (top 32 bits) of non-empty sets, a row for each."""
    out = np.empty((len(sets), VALUES), np.uint32)
    done = 0
    while done < len(sets):
        end, n = done, 0
        while end < len(sets) and (n == 0 or n + len(sets[end]) < 200_000):
            n += len(sets[end])
            end += 1
        flat = np.concatenate(sets[done:end])
        starts = np.cumsum([0] + [len(s) for s in sets[done:end - 1]])
        for k in range(VALUES):
            v = (flat ^ _SEEDS[0, k]) * _SEEDS[1, k]
            out[done:end, k] = np.minimum.reduceat(v, starts) >> np.uint64(32)
        done = end
    return out


def _sets(column) -> list[np.ndarray]:
    words, counts = word_hashes(arrow_texts(column))
    return list(shingle_sets(words, counts, WIDTH))


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, fp (hash of the text), d1, d2 (digest of the set), n (its size), sig; n = 0 without sig."""
    def run(batches):
        for b in batches:
            sets = _sets(b.column("text"))
            n = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(n)
            sig = np.zeros((len(sets), VALUES), np.uint32)
            if len(some):
                sig[some] = signatures([sets[i] for i in some])
            digest = np.array([[mix64(s ^ np.uint64(c)).sum(dtype=np.uint64) for c in (0xA5, 0x5A17)] for s in sets],
                              np.uint64).reshape(-1, 2).view(np.int64)
            yield batch_with(b, ["doc_id", "fp"], d1=digest[:, 0], d2=digest[:, 1], n=n,
                             sig=pa.array([x.astype(">u4").tobytes() if k else None for x, k in zip(sig, n)], pa.binary()))

    return docs.select("doc_id", F.xxhash64(text_or_empty()).alias("fp"), "text").mapInArrow(
        trimmed(run), f"doc_id {kind_of(docs, 'doc_id')}, fp bigint, d1 bigint, d2 bigint, n bigint, sig binary")


def least_matches(threshold: Fraction = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of compared values the fewest matches with which a pair goes on:
    P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m) under a uniform prior."""
    t, out = float(threshold), {}
    for n in range(STEP, VALUES + 1, STEP):
        below = 0.0
        for m in range(n + 1):
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= tolerance:
                out[n] = m
                break
    return out


def surviving_pairs(a: np.ndarray, b: np.ndarray, same: bool, least: dict[int, int]):
    """Index pairs (i, j) of two signature blocks that are not pruned, tile by tile."""
    for i0 in range(0, len(a), TILE):
        for j0 in range(i0 if same else 0, len(b), TILE):
            ta, tb = a[i0:i0 + TILE], b[j0:j0 + TILE]
            match = np.zeros((len(ta), len(tb)), np.uint8)
            for k in range(STEP):
                match += ta[:, k, None] == tb[None, :, k]
            keep = match >= least[STEP]
            if same and i0 == j0:
                keep = np.triu(keep, 1)
            i, j = np.nonzero(keep)
            got = match[i, j].astype(np.int16)
            for n in range(2 * STEP, VALUES + 1, STEP):
                if not len(i):
                    break
                got = got + (ta[i, n - STEP:n] == tb[j, n - STEP:n]).sum(axis=1)
                ok = got >= least[n]
                i, j, got = i[ok], j[ok], got[ok]
            if len(i):
                yield i + i0, j + j0


class _Union:
    """Union-find over the rows of one unit."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        # pairs of already joined rows drop out at once, so the loop runs at most once per row
        while len(i):
            ri, rj = self.roots(i), self.roots(j)
            apart = ri != rj
            if not apart.any():
                return
            i, j, ri, rj = i[apart], j[apart], ri[apart], rj[apart]
            hi, lo = np.maximum(ri, rj), np.minimum(ri, rj)
            order = np.argsort(hi, kind="stable")
            first = np.unique(hi[order], return_index=True)[1]
            self.up[hi[order][first]] = lo[order][first]

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.up[x]
        while True:
            s = self.up[r]
            if (s == r).all():
                return r
            r = s


def _units(nodes: DataFrame, comp: DataFrame, weight: str) -> DataFrame:
    """Deal the nodes of each component out to units: (unit, block, first, ...). A component of k blocks
    makes k * (k + 1) / 2 units, each of one or two blocks."""
    here = nodes.join(comp, F.col("nid") == F.col("node")).drop("node")
    sizes = nodes.select("nid", weight).join(comp, F.col("nid") == F.col("node")).groupBy("comp").agg(F.count(F.lit(1)).alias("c"), F.sum(weight).alias("w")).select(
        "comp", F.greatest(F.ceil(F.col("c") / BLOCK_NODES), F.ceil(F.col("w") / BLOCK_SHINGLES), F.lit(1)).alias("k"))
    return _dealt(here.join(sizes, "comp"))


def _bucket_units(nodes: DataFrame) -> DataFrame:
    """The nodes of each bucket that more than one node is in, dealt out to units; of buckets with the same nodes one."""
    bands = nodes.select("nid", F.posexplode(F.array(*[F.substring("sig", 4 * ROWS * b + 1, 4 * ROWS) for b in range(BANDS)]))
                         .alias("band", "part")).select("nid", F.xxhash64("band", "part").alias("key"))
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("nid")).alias("x"),
                                       F.bit_xor(F.xxhash64(F.lit(1), "nid")).alias("y")).filter("c > 1")
    chosen = buckets.groupBy("c", "x", "y").agg(F.min("key").alias("comp")).select("comp", F.ceil(F.col("c") / BUCKET_NODES).alias("k"))
    members = bands.join(chosen, F.col("key") == F.col("comp")).select("nid", "comp", "k")
    return _dealt(nodes.select("nid", "sig").join(members, "nid"))


def _dealt(here: DataFrame) -> DataFrame:
    """Rows with ``k`` blocks in their component -> a row for each unit that their block is in."""
    dealt = here.withColumn("block", F.pmod(F.xxhash64("nid"), "k"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1))
    dealt = dealt.withColumn("other", other)
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    return dealt.select("*", lo.alias("lo"), hi.alias("hi")).drop("other", "k")


def _by_unit(dealt: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work(rows of one unit)`` over all units: rows are shuffled by unit and sorted, by nid within it (so the
    root of linked rows is their smallest nid, and spanning links are stars at once), and each task goes through its units one after another (most components are small, so a task holds many)."""
    keys = ["comp", "lo", "hi"]

    def run(batches):
        waiting: list[pd.DataFrame] = []
        for pdf in batches:
            k = pdf[keys].to_numpy()
            cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            bounds = [0, *cuts.tolist(), len(pdf)]
            out = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                if waiting and tuple(waiting[0][keys].iloc[0]) != tuple(k[a]):
                    out.append(work(pd.concat(waiting, ignore_index=True) if len(waiting) > 1 else waiting[0]))
                    waiting = []
                waiting.append(pdf.iloc[a:b].reset_index(drop=True))
            out = [x for x in out if x is not None and len(x)]
            if out:
                yield pd.concat(out, ignore_index=True)
        if waiting:
            x = work(pd.concat(waiting, ignore_index=True))
            if x is not None and len(x):
                yield x

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "nid").mapInPandas(trimmed(run), schema)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), ">u4").reshape(len(column), VALUES).astype(np.uint32)


def _sides(pdf: pd.DataFrame):
    """Row numbers of the two blocks of a unit, and whether they are the same block."""
    same = pdf["lo"].iloc[0] == pdf["hi"].iloc[0]
    a = np.flatnonzero(pdf["block"].to_numpy() == pdf["lo"].iloc[0])
    return a, (a if same else np.flatnonzero(pdf["block"].to_numpy() == pdf["hi"].iloc[0])), same


def prune(dealt: DataFrame) -> DataFrame:
    """(a, b): a spanning set of the pairs that the Bayesian comparison keeps."""
    least = least_matches()

    def work(pdf):
        if len(pdf) < 2:
            return None
        sig, (a, b, same) = _matrix(pdf["sig"]), _sides(pdf)
        u = _Union(len(pdf))
        for i, j in surviving_pairs(sig[a], sig[b], same, least):
            u.link(a[i], b[j])
        root = u.roots(np.arange(len(pdf)))
        at = np.flatnonzero(root != np.arange(len(pdf)))
        nid = pdf["nid"].to_numpy()
        return pd.DataFrame({"a": nid[at], "b": nid[root[at]]})

    return _by_unit(dealt, work, "a bigint, b bigint")


class _Overlaps:
    """Exact intersection sizes of the sets of one unit. Hashes that only one set has cannot count;
    hashes in exactly the same sets are one column with a weight."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        _, col = np.unique(np.concatenate(sets), return_inverse=True)
        n = np.bincount(col)
        keep = n[col] > 1
        owner, col = owner[keep], col[keep]
        tag = mix64(np.arange(1, len(sets) + 1, dtype=np.uint64))
        order = np.argsort(col, kind="stable")
        owner, col = owner[order], col[order]
        starts = np.flatnonzero(np.diff(col, prepend=-1))
        marks = np.add.reduceat(tag[owner], starts) if len(starts) else np.zeros(0, np.uint64)
        _, first, group, weight = np.unique(marks, return_index=True, return_inverse=True, return_counts=True)
        lens = np.diff(np.append(starts, len(col)))
        stays = np.zeros(len(starts), bool)
        stays[first] = True
        entry = np.repeat(stays, lens)
        self.owner, self.col = owner[entry], np.repeat(group, lens)[entry]
        self.weight = weight
        by = np.argsort(self.owner, kind="stable")
        self.owner, self.col = self.owner[by], self.col[by]
        self.at = np.searchsorted(self.owner, np.arange(len(sets) + 1))

    def pairs(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """|set i & set j| for index pairs of one tile."""
        rows, ri = np.unique(i, return_inverse=True)
        cols, rj = np.unique(j, return_inverse=True)
        left, right = self._entries(rows), self._entries(cols)
        common = np.intersect1d(left[1], right[1])
        # seconds by either way: pair by pair, or as a product of 0/1 matrices
        size = np.diff(self.at)
        if len(i) * 3e-5 + (size[i] + size[j]).sum() * 4e-8 < len(common) * (len(rows) * len(cols) * 3e-10 + (len(rows) + len(cols)) * 4e-9):
            return np.array([self.weight[np.intersect1d(self.col[self.at[x]:self.at[x + 1]],
                                                        self.col[self.at[y]:self.at[y + 1]], assume_unique=True)].sum()
                             for x, y in zip(i.tolist(), j.tolist())], np.int64)
        total = np.zeros((len(rows), len(cols)))
        for c in range(0, len(common), 4096):
            part = common[c:c + 4096]
            total += (self._dense(left, part, len(rows)) * self.weight[part]) @ self._dense(right, part, len(cols)).T
        return np.rint(total[ri, rj]).astype(np.int64)

    def _entries(self, which):
        spans = [(k, self.at[x], self.at[x + 1]) for k, x in enumerate(which.tolist())]
        return (np.concatenate([np.full(b - a, k) for k, a, b in spans]),
                np.concatenate([self.col[a:b] for _, a, b in spans]))

    @staticmethod
    def _dense(entries, part, n):
        rows, cols = entries
        lo, hi = part[0], part[-1]
        near = (cols >= lo) & (cols <= hi)
        rows, cols = rows[near], cols[near]
        at = np.searchsorted(part, cols)
        ok = part[at] == cols
        out = np.zeros((n, len(part)))
        out[rows[ok], at[ok]] = 1
        return out


def verify(dealt: DataFrame) -> DataFrame:
    """Verified links of each unit: (kind 0, nid, copies linked, null) and spanning links (1, a, null, b)."""
    least, num, den = least_matches(), THRESHOLD.numerator, THRESHOLD.denominator

    def work(pdf):
        if len(pdf) < 2:
            return None
        sig, (a, b, same) = _matrix(pdf["sig"]), _sides(pdf)
        over = _Overlaps([np.frombuffer(x, "<u8") for x in pdf["shingles"]])
        copies, links, u = pdf["copies"].to_numpy(), np.zeros(len(pdf), np.int64), _Union(len(pdf))
        for i, j in surviving_pairs(sig[a], sig[b], same, least):
            i, j = a[i], b[j]
            shared = over.pairs(i, j)
            ok = shared * den >= num * (over.sizes[i] + over.sizes[j] - shared)
            i, j = i[ok], j[ok]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            u.link(i, j)
        root = u.roots(np.arange(len(pdf)))
        at = np.flatnonzero(root != np.arange(len(pdf)))
        got = np.flatnonzero(links)
        nid = pdf["nid"].to_numpy()
        return pd.concat([pd.DataFrame({"a": nid[got], "links": links[got], "b": -1}),
                          pd.DataFrame({"a": nid[at], "links": 0, "b": nid[root[at]]})], ignore_index=True)

    return _by_unit(dealt, work, "a bigint, links bigint, b bigint")


def _with_shingles(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(nid, shingles) for ``wanted(nid, fp)``: a second scan keeps the texts whose hash the bitmap
    of wanted hashes marks, one of each text, and joins them."""
    bitmap = broadcast_bitmap(wanted.select(top_bits(F.col("fp"), BITMAP_BITS).alias("pos")))
    keyed = docs.select(text_or_empty().alias("text")).withColumn("fp", F.xxhash64("text"))
    texts = marked_rows(keyed, bitmap, True, "fp").groupBy("fp").agg(F.max("text").alias("text"))

    def cut(batches):
        for b in batches:
            yield batch_with(b, ["nid"], shingles=pa.array([s.tobytes() for s in _sets(b.column("text"))], pa.binary()))

    return texts.join(wanted, "fp").select("nid", "text").mapInArrow(trimmed(cut), "nid bigint, shingles binary")


def _classes(docs: DataFrame) -> DataFrame:
    """doc_id, fp, class_size, n_links, rep (doc_id null?, doc_id, fp of the class's document that stays)."""
    rows = scratch_table(sketch(docs), "sketches")
    me = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "fp")
    nodes = scratch_table(
        rows.filter("n > 0").groupBy("d1", "d2").agg(F.min(me).alias("low"), F.count(F.lit(1)).alias("copies"),
                                                     F.max(F.struct("fp", "n", "sig")).alias("x"))
        .select(F.monotonically_increasing_id().alias("nid"), "d1", "d2", "low", "copies", "x.fp", "x.n", "x.sig"), "nodes")
    fine = connected_components(prune(_bucket_units(nodes)))
    wanted = nodes.join(fine, F.col("nid") == F.col("node")).select("nid", "fp")
    full = nodes.select("nid", "n", "sig", "copies").join(_with_shingles(docs, wanted), "nid")
    found = scratch_table(verify(_units(full, fine, "n")), "links")
    links = found.filter("b < 0").groupBy(F.col("a").alias("nid")).agg(F.sum("links").alias("links"))
    classes = connected_components(found.filter("b >= 0").select("a", "b"))
    member = scratch_table(
        nodes.select("nid", "d1", "d2", "low", "copies")
        .join(classes, F.col("nid") == F.col("node"), "left").join(links, "nid", "left")
        .withColumn("comp", F.coalesce("comp", "nid")), "members")
    ids = member.groupBy("comp").agg(F.min("low").alias("rep"), F.sum("copies").alias("class_size"))
    member = member.join(ids, "comp").select(
        "d1", "d2", "rep", "class_size", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    some = rows.filter("n > 0").select("doc_id", "fp", "d1", "d2").join(member, ["d1", "d2"]).select(
        "doc_id", "fp", "class_size", "n_links", "rep")
    none = rows.filter("n = 0").select("doc_id", "fp", F.lit(1).cast("bigint").alias("class_size"),
                                       F.lit(0).cast("bigint").alias("n_links"), me.alias("rep"))
    return some.unionByName(none)


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, n_links (other documents at similarity 0.8 or more) for every row."""
    return _classes(docs).select("doc_id", F.col("rep.doc_id").alias("class_id"), "class_size", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that represent their classes: of each class the smallest doc_id (null last),
    once; every document without shingles. Classes of one pass by the bitmap without a shuffle."""
    names = docs.columns
    found = scratch_table(_classes(docs).filter("class_size > 1"), "copies")
    key = F.xxhash64("doc_id", "fp")
    bitmap = broadcast_bitmap(found.select(top_bits(key, BITMAP_BITS).alias("pos")))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id",
                        F.xxhash64(text_or_empty()).alias("fp")).select("row", "doc_id", "fp", key.alias("key"))
    marked = marked_rows(keyed, bitmap, True)
    in_class = found.groupBy("doc_id", "fp").agg(F.max(F.col("rep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("rep.fp") == F.col("fp"))).alias("stays"))
    judged = marked.alias("m").join(in_class.alias("c"), F.col("m.doc_id").eqNullSafe(F.col("c.doc_id"))
                                    & (F.col("m.fp") == F.col("c.fp")), "left")
    alone = judged.filter("stays is null").select("m.row")
    held = judged.filter("stays").groupBy("m.doc_id", "m.fp").agg(F.min("m.row").alias("row")).select("row")
    return (marked_rows(keyed, bitmap, False).select("row").unionByName(alone).unionByName(held)).select("row.*")
