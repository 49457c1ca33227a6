import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.llm import bpe, common, components, nearjoin, queries

from .conftest import rows_of

PATH = queries.tokenizer_path()
ODD = ["", "   \n", "Hello WORLD's don't I'LL 123.45", "a<|endoftext|>b <|startoftext|>", "naïve Ébauche ß İstanbul ΣΑΣ",
       "é ́x K ﬁ  nb sp　x\x85y\x1cz\x1f", "日本語 한국어 ไทย 🎉👩‍👩‍👧", "''s 's't'RE ''''", "x" * 70_000,
       "word " * 30_000, "!!!???...", "̀́ ą́", "tab\tvt\x0bff\x0ccr\r\nend", "J̌ ǰ ẞ"]


def brute_encode(rows):
    tok = bpe.load(PATH)
    out = []
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        out.append({"doc_id": doc_id, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    "decoded_sha256": hashlib.sha256(back.encode()).hexdigest()})
    return rows_of(out)


def test_bpe_odd_texts(docs_of):
    rows = list(enumerate(ODD)) + [(100, None), (None, "null id"), (2, ODD[2]), (2, ODD[2])]
    df = docs_of(rows, word="w", block="b", codes=1)
    assert rows_of(bpe.encode(df, PATH).collect()) == brute_encode(rows)


def test_bpe_small_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_DISTINCT", 5)
    rows = [(k, t) for k, t in enumerate(ODD * 3)]
    assert rows_of(bpe.encode(docs_of(rows).repartition(3, "doc_id").sortWithinPartitions("doc_id"), PATH).collect()) == brute_encode(rows)


def test_bpe_whole_table(spark, sf, documents):
    want = brute_encode([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])
    assert rows_of(queries.op2_bpe(spark, sf).collect()) == want


def test_bpe_ids_and_decode(spark, docs_of):
    rows = list(enumerate(ODD[:8]))
    got = bpe.encode(docs_of(rows), PATH, with_ids=True)
    tok = bpe.load(PATH)
    assert {r.doc_id: list(r.ids) for r in got.collect()} == {k: tok.encode(t, add_special_tokens=False).ids for k, t in rows}
    back = bpe.decode(got.select("doc_id", "ids"), bpe.piece_table(spark, PATH))
    assert {r.doc_id: r.text for r in back.collect()} == {
        k: tok.decode(tok.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for k, t in rows}


def test_bpe_empty(docs_of):
    assert bpe.encode(docs_of([]), PATH).collect() == []


# ------------------------------------------------------------------ near join

def brute_near(rows):
    def shingles(t):
        w = (t or "").encode().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and sets[i] and sets[j]
              and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            m = min([label[i]] + [label[j] for j in links[i]])
            if m != label[i]:
                label[i], changed = m, True
    out = []
    for i, (doc_id, _) in enumerate(rows):
        members = [rows[j][0] for j in range(n) if label[j] == label[i]]
        known = [m for m in members if m is not None]
        out.append({"doc_id": doc_id, "class_id": min(known) if known else None, "class_size": len(members), "n_links": len(links[i])})
    return rows_of(out)


def corpus(seed=3, groups=12):
    """Groups of near copies at mixed similarity, exact copies, short and long texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = [(None, None), (1, ""), (2, "  \n"), (3, "one two"), (4, "one  two"), (5, "one two three four"), (None, "one two")]
    k = 10
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([6, 40, 150, 600]))] + (passage if g % 3 == 0 else [])
        for _ in range(rng.choice([1, 2, 5, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, len(base) // 40])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((k, rng.choice([" ", "  ", "\n"]).join(copy)))
            k += 1
    rows += [(10, rows[8][1]), rows[9], rows[9]]
    rng.shuffle(rows)
    return rows


def unique_ids(rows):
    seen, out = set(), []
    for r in rows:
        if r[0] is not None and r[0] in seen:
            continue
        seen.add(r[0])
        out.append(r)
    return out


@pytest.mark.parametrize("tile", [4096, 7])
def test_near_brute_force(docs_of, monkeypatch, tile):
    # tile 7: components are dealt out over many units
    monkeypatch.setattr(nearjoin, "BLOCK_NODES", tile)
    monkeypatch.setattr(nearjoin, "BUCKET_NODES", tile)
    rows = corpus()
    df = docs_of(rows, nid=1, comp=2, sig="s", copies=0)
    assert rows_of(nearjoin.near_classes(df).collect()) == brute_near(rows)


def test_near_keeps_one(docs_of):
    rows = unique_ids(corpus(5)) + [(3, "one two")]
    df = docs_of(rows, rep="r", row=1, fp=2, key=3)
    kept = nearjoin.keep_one(df)
    assert kept.columns == df.columns
    best = {}
    for r in brute_near(unique_ids(rows)):
        d = dict(r)
        if d["class_size"] > 1:
            best[d["class_id"]] = d["class_id"]
    want = sorted([dict(r)["doc_id"] for r in brute_near(unique_ids(rows)) if dict(r)["class_size"] == 1 and dict(r)["doc_id"] is not None] + list(best))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want


def test_near_empty(docs_of):
    assert nearjoin.near_classes(docs_of([])).collect() == []
    assert nearjoin.keep_one(docs_of([])).collect() == []


def test_near_oracle(spark, sf, oracle, documents):
    assert rows_of(queries.op7_jaccard_join(spark, sf).collect()) == oracle(queries.ORACLES["op7_jaccard_join"], documents=documents)


def test_pruning_keeps_pairs_at_threshold():
    least, rng = nearjoin.least_matches(), np.random.default_rng(1)
    hits = np.cumsum(rng.random((200_000, nearjoin.VALUES)) < 0.8, axis=1)
    lost = np.zeros(len(hits), bool)
    for n, m in least.items():
        lost |= hits[:, n - 1] < m
    assert lost.mean() < 1e-4
    low = np.cumsum(rng.random((20_000, nearjoin.VALUES)) < 0.3, axis=1)
    assert (low[:, 47] >= least[48]).mean() < 0.01


def test_overlaps_both_ways(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 120)).astype(np.uint64)) for _ in range(40)]
    over = nearjoin._Overlaps(sets)
    i, j = np.triu_indices(40, 1)
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert over.pairs(i, j).tolist() == want
    assert over.pairs(i[:3], j[:3]).tolist() == want[:3]


def test_word_hashes_like_split(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(common, "CHUNK_BYTES", 50)
    texts = ["", " a", "a b\tc\x0bd ", "é ü", "long " * 100, "x" * 9000 + " y", None, "\n", "a", "b c", "z" * 60]
    h, n = common.word_hashes(common.arrow_texts(pa.array(texts)))
    assert n.tolist() == [len((t or "").encode().split()) for t in texts]
    flat = [w for t in texts for w in (t or "").encode().split()]
    assert len(set(flat)) == len(set(h.tolist())) and len({(w, x) for w, x in zip(flat, h.tolist())}) == len(set(flat))


def test_components(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(50)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r.node: r.comp for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 0 for k in range(301)) and all(got[1000 + k] == 1000 for k in range(50)) and got[5001] == 5000
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_chains_are_not_compared(docs_of, monkeypatch):
    """400 texts of which neighbours share half of their shingles: chained buckets, no link, few comparisons."""
    import numpy as np
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in rng.integers(0, 10**6, 400 * 12 + 40)]
    rows = [(k, " ".join(words[12 * k:12 * k + 36])) for k in range(400)]
    df = docs_of(rows).repartition(4)
    sig = nearjoin.sketch(df).select("doc_id", "sig").toPandas()
    units = nearjoin._bucket_units(df.sparkSession.createDataFrame(sig.rename(columns={"doc_id": "nid"}), "nid bigint, sig binary"))
    pairs = sum(n * (n - 1) // 2 for n in units.groupBy("comp", "lo", "hi").count().toPandas()["count"])
    assert pairs < 3 * 400 and len(sig) == 400
    got = nearjoin.near_classes(df).toPandas()
    assert (got["class_size"] == 1).all() and (got["n_links"] == 0).all()
