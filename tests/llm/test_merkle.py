import zlib
from hashlib import sha256

import pytest

from ratecast.llm import merkle, queries

from .conftest import rows_of


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, add=0):
    doc_id, text, lang, source, n_chars = r
    return H(enc(doc_id), enc(source), enc(lang), enc(None if n_chars is None else n_chars + add), enc(text))


def reduce_list(nodes):
    """Root of a list, and for each place its siblings as (node, is left) or None, level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            j = i ^ 1
            ways[k].append((nodes[j], j < i) if j < len(nodes) else None)
        nodes, at = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)], [i >> 1 for i in at]
    return nodes[0], ways


def brute_manifest(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in order:
        docs = sorted(langs[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[x] = docs, *reduce_list([leaf_of(r) for r in docs])
    out = []
    if order:
        root, over = reduce_list([trees[x][1] for x in order])
    for x, up in zip(order, over if order else []):
        docs, subroot, ways = trees[x]
        for r, way in zip(docs, ways):
            way = way + up
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf_of(r, int(bad))
            for s in way:
                node = H(node) if s is None else H(s[0], node) if s[1] else H(node, s[0])
            out.append({"doc_id": r[0], "leaf": leaf_of(r), "subroot": subroot, "root": root,
                        "proof_sha256": H(*(s[0] for s in way if s)), "folded_root": node, "verified": node == root})
    return rows_of(out)


def some(n, langs=("en",), start=0):
    return [(start + k, f"tëxt {k}", langs[k % len(langs)], "s" if k % 3 else None, k if k % 5 else None) for k in range(n)]


TRICKY = [(None, "a", "en", "s", 1), (None, "a", "en", "s", 1), (None, None, None, None, None), (7, "", "", "", 0),
          (7, "", "", "", 0), (8, "x" * 300_000, "é", "s", 2**63 - 1), (9, "-", "zz", "1:a", -5), (10, "q", "\U0001f600", "s", 3),
          (10, "r", "\U0001f600", "s", 3), (11, "p", "￿", "s", 3)]


@pytest.mark.parametrize("rows", [[], some(1), some(2), some(3, ("a", "b", None)), some(41, ("en", "fr")) + TRICKY,
                                  some(37) + some(1, ("x",), 900) + some(300, tuple(f"l{k}" for k in range(19)), 1000)])
@pytest.mark.parametrize("levels", [2, 3])
def test_manifest_against_brute_force(docs_of, monkeypatch, rows, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)       # many superblocks and rounds on few rows
    df = docs_of(rows, tree=1, leaf="x", pos="p", n=2, root=None).repartition(3)
    assert rows_of(merkle.manifest(df).collect()) == brute_manifest(rows)


def test_manifest_many_copies_of_one_row(docs_of):
    rows = some(1) * 3000 + some(500, ("en", None))
    assert rows_of(merkle.manifest(docs_of(rows)).collect()) == brute_manifest(rows)


def test_manifest_oracle(spark, sf, oracle, documents):
    got = rows_of(queries.op12_merkle_manifest(spark, sf).collect())
    assert got == oracle(queries.ORACLES["op12_merkle_manifest"], documents=documents)
    assert got == brute_manifest([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in documents.collect()])
    assert {dict(r)["verified"] for r in got} == {True, False}
