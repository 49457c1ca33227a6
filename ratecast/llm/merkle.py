"""Merkle manifest of a document table: one binary hash tree per language, and one over the languages.

H is the lowercase hex SHA-256 of its inputs, concatenated; digests enter as hex text. A leaf is H of doc_id,
source, lang, n_chars and text, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value.

1. One scan hashes every row to its leaf (in the JVM); only (lang, doc_id, leaf) goes on.
2. A range sort by (lang, doc_id) gives every leaf its place; the places of a partition are counted up from the
   rows of the partitions before it, so no language is numbered by one task.
3. A language's leaves are cut into superblocks of ``2**LEVELS`` consecutive leaves, however many rows one language
   has. A group of nodes is reduced to one node; these nodes form lists 2**LEVELS times shorter, which are cut and
   reduced in the same way until one node of each language is left, the subroot. The list of subroots is a tree alike.
4. Top down, the nodes of a superblock and the outer nodes that its proofs need (one row a superblock) are cogrouped:
   each node gets the outer nodes of its own superblock of the level below. At the last level the leaves and
   their outer nodes are cogrouped by superblock in one applyInPandas that finishes the local reduction, joins inner and outer
   siblings to each leaf's proof, and folds each leaf (tampered or original) up to a root.

A task holds one superblock and some 40 outer nodes. The ordered leaves and the nodes of each level are written to the
shared folder, so a lost executor cannot change places.

Defined results: null doc_ids come first in their language and are never tampered with; rows of one doc_id follow
by leaf; equal rows take neighbouring places, each with the proof of its own place; a null n_chars stays null under
tampering; null lang is a language of its own, first of all; one row alone is leaf, subroot and root with an empty
proof; an empty table gives an empty result; further columns are ignored.
"""
from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kind_of, scratch_table, sha_hex

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10
TAMPER = 7


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(**replaced: Column) -> Column:
    """The leaf of a row; ``replaced`` columns stand in for the row's own."""
    return sha_hex(F.concat(*[_field(replaced.get(f, F.col(f))) for f in FIELDS]))


def leaves_of(docs: DataFrame, tamper: int = TAMPER) -> DataFrame:
    """(lang, doc_id, leaf, bad): ``bad`` is the leaf after tampering, null where the row is left alone."""
    hit = (F.crc32(F.col("doc_id").cast("string")) % tamper == 0) & F.col("n_chars").isNotNull()
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    return docs.select("lang", "doc_id", leaf_hash().alias("leaf"),
                       F.when(hit, leaf_hash(n_chars=more)).alias("bad"))


def ranked(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with ``rank``, its place from 0 in the order of ``order`` (nulls first); rows equal in ``order`` are dealt
    to several tasks and take neighbouring places."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    at = F.monotonically_increasing_id()
    rows = scratch_table(df.withColumn("tie", F.rand(1)).repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie")
                         .drop("tie").withColumn("at", at), label)
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("size"))    # a row for each range partition
    before = F.sum("size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return (rows.withColumn("_part", part).join(F.broadcast(first), "_part")
            .withColumn("rank", F.col("_before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_part", "_before", "at"))


def grow(nodes: list[str], levels: int | None) -> list[list[str]]:
    """The levels above ``nodes``: ``levels`` of them, or up to a single node."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        low = out[-1]
        out.append([h(*low[i:i + 2]) for i in range(0, len(low), 2)])
    return out


def _tree(pdf: pd.DataFrame) -> list[list[str]]:
    """The levels of one superblock; the only superblock of a list ends in its root."""
    return grow(pdf.sort_values("pos")["node"].tolist(), None if pdf["n"].iloc[0] <= 1 << LEVELS else LEVELS)


def _sibling(level: list[str], i: int) -> str:
    """The other node of the run with its side, ``-`` if there is none."""
    j = i ^ 1
    return "-" if j >= len(level) else ("L" if j < i else "R") + level[j]


def fold(node: str, siblings: list[str]) -> str:
    for s in siblings:
        node = h(node) if s == "-" else h(s[1:], node) if s[0] == "L" else h(node, s[1:])
    return node


def _reduce(pdf: pd.DataFrame) -> pd.DataFrame:
    one = pdf.iloc[0]
    return pd.DataFrame({"tree": [one["tree"]], "pos": [one["pos"] >> LEVELS], "n": [-(-one["n"] >> LEVELS)],
                         "node": [_tree(pdf)[-1][0]]})


def build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``nodes(tree, pos, n, node)`` -> the lists of nodes from the leaves up, and the last of one node a tree."""
    lists = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        up = (lists[-1].select("tree", "pos", "n", "node").groupBy("tree", F.shiftright("pos", LEVELS).alias("block"))
              .applyInPandas(_reduce, "tree bigint, pos bigint, n bigint, node string"))
        lists.append(scratch_table(up, "merkle-nodes"))
        most = -(-most >> LEVELS)
    return lists[:-1] if len(lists) > 1 else lists, lists[-1]


def _outward(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Each node of a superblock with all siblings on its way to the top."""
    if nodes.empty:
        return pd.DataFrame(columns=["tree", "block", "path"])
    nodes = nodes.sort_values("pos")
    tree, above = _tree(nodes), outer["path"].iloc[0]
    paths = [" ".join([*(_sibling(lev, i >> k) for k, lev in enumerate(tree[:-1])), *above.split()]) for i in range(len(nodes))]
    return pd.DataFrame({"tree": nodes["tree"].to_numpy(), "block": nodes["pos"].to_numpy(), "path": paths})


def outer_nodes(lists: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, block, path): for each superblock of the lowest list the siblings from its node up to the root.
    ``tops(tree, path)`` holds those above each tree."""
    outer = tops.select(F.col("tree").alias("tree"), F.lit(0).cast("bigint").alias("block"), "path")
    for nodes in reversed(lists[1:]):
        outer = (nodes.groupBy("tree", F.shiftright("pos", LEVELS).alias("block")).cogroup(outer.groupBy("tree", "block"))
                 .applyInPandas(_outward, "tree bigint, block bigint, path string"))
    return outer


def _finish(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Reduction inside the superblock, proofs of its leaves and the fold of each leaf up to a root."""
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    if leaves.empty:
        return pd.DataFrame(columns=cols)
    leaves = leaves.sort_values("pos")
    tree, one = _tree(leaves), outer.iloc[0]
    above = one["path"].split()
    proofs = ["".join(s[1:] for s in above)]
    for lev in reversed(tree[:-1]):
        proofs = [_sibling(lev, i)[1:] + proofs[i >> 1] for i in range(len(lev))]
    known: dict[tuple, str] = {}

    def folded(node: str, k: int, i: int) -> str:
        """Root from a node at level k, place i; what is already folded from the same node there is not folded again."""
        if k == len(tree) - 1:
            return known.get((k, node)) or known.setdefault((k, node), fold(node, above))
        if (out := known.get((k, i, node))) is None:
            out = known[k, i, node] = folded(fold(node, [_sibling(tree[k], i)]), k + 1, i >> 1)
        return out

    nodes = leaves["node"].tolist()
    return pd.DataFrame({"doc_id": leaves["doc_id"].to_numpy(), "leaf": nodes, "subroot": one["subroot"], "root": one["root"],
                         "proof_sha256": [h(p) for p in proofs],
                         "folded_root": [folded(bad or leaf, 0, i) for i, (leaf, bad) in enumerate(zip(nodes, leaves["bad"]))]})


def manifest(docs: DataFrame, tamper: int = TAMPER) -> DataFrame:
    """One row a document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    placed = ranked(leaves_of(docs, tamper), ["lang", "doc_id", "leaf"], "merkle-leaves")
    langs = ranked(placed.groupBy("lang").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")), ["lang"],
                   "merkle-langs").withColumnRenamed("rank", "tree")
    leaves = (placed.alias("a").join(langs.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang")))
              .select("b.tree", (F.col("a.rank") - F.col("b.first")).alias("pos"), "b.n", F.col("a.leaf").alias("node"),
                      F.col("a.doc_id").cast("string").alias("doc_id"), "a.bad"))
    lists, subroots = build(leaves)
    # the tree over the languages: its list is in the order of the languages
    n_langs = langs.agg(F.count(F.lit(1)).alias("n"))
    tops = (subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "node")
            .crossJoin(F.broadcast(n_langs)))
    top_lists, root = build(tops)
    ends = F.broadcast(root.select("tree", F.lit("").alias("path")))             # one row
    over = (top_lists[0].groupBy("tree", F.shiftright("pos", LEVELS).alias("block"))
            .cogroup(outer_nodes(top_lists, ends).groupBy("tree", "block"))
            .applyInPandas(_outward, "tree bigint, block bigint, path string"))
    tops = (over.select(F.col("block").alias("tree"), "path").join(subroots.select("tree", F.col("node").alias("subroot")), "tree")
            .crossJoin(F.broadcast(root.select(F.col("node").alias("root")))))
    tops = scratch_table(tops, "merkle-tops")                                    # a row for each language
    outer = outer_nodes(lists, tops).join(tops.select("tree", "subroot", "root"), "tree")
    done = (leaves.groupBy("tree", F.shiftright("pos", LEVELS).alias("block")).cogroup(outer.groupBy("tree", "block"))
            .applyInPandas(_finish, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"))
    return (done.withColumn("doc_id", F.col("doc_id").cast(kind_of(docs, "doc_id")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
