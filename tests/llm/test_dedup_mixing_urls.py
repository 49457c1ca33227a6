import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from ratecast.llm import dedup, mixing, queries, urlrules

from .conftest import PAGES, rows_of

TRICKY = [(1, "a  b\tc"), (2, "a b c"), (3, " a b c"), (4, None), (5, ""), (6, "x" * 200_000), (7, "x" * 200_000),
          (8, "é\u00a0b"), (9, "é b"), (None, "a b c"), (None, "only null id"), (2, "a b c"), (10, "a\x0bb\x1cc")]


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_golomb_round_trip(n):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, 1 << 40, n))
    v[n // 2:n // 2 + 2] = v[n // 2] if n > 2 else v[n // 2:n // 2 + 2]
    assert (dedup.golomb_decode(dedup.golomb_encode(v, 1 << 40)) == v).all()
    if n == 3000:
        assert len(dedup.golomb_encode(v, 1 << 40)) < 8 * n


def brute_dedup(rows):
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append((r[0] is None, r[0], k))
    out = []
    for text, g in groups.items():
        g.sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        for i, (_, doc_id, _) in enumerate(g):
            out.append({"doc_id": doc_id, "keep_id": g[0][1], "group_size": len(g), "kept": i == 0,
                        "text_sha256": hashlib.sha256(text.encode()).hexdigest()})
    return rows_of(out)


def test_dedup_tricky_rows(docs_of):
    df = docs_of(TRICKY, fp=1, norm="z", row="r")
    assert rows_of(dedup.dedup_report(df).collect()) == brute_dedup(TRICKY)
    kept = dedup.exact_dedup(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [
        (1, "a  b\tc"), (3, " a b c"), (4, None), (6, "x" * 200_000), (8, "é\u00a0b"), (9, "é b"), (10, "a\x0bb\x1cc")]


def test_dedup_empty(docs_of):
    assert dedup.dedup_report(docs_of([])).collect() == []
    assert dedup.exact_dedup(docs_of([])).collect() == []


def test_dedup_false_suspects_are_cleared(docs_of, monkeypatch):
    # a bitmap that marks everything: verification by bytes still gives the right groups
    real = dedup.duplicate_positions
    monkeypatch.setattr(dedup, "messages", lambda fps, owners: fps.unionAll(fps))
    monkeypatch.setattr(dedup, "duplicate_positions", lambda sent, owners: sent.selectExpr(
        "shiftrightunsigned(fp, 37) pos").distinct())
    assert real is not None
    assert rows_of(dedup.dedup_report(docs_of(TRICKY)).collect()) == brute_dedup(TRICKY)


def test_dedup_one_message_a_partition(docs_of, monkeypatch):
    fps = docs_of([(k, "x") for k in range(900)]).selectExpr("xxhash64(doc_id) fp").coalesce(1)
    spark = fps.sparkSession
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
        assert dedup.messages(fps, 3).count() == 3
        monkeypatch.setattr(dedup, "MESSAGE_ROWS", 300)
        assert dedup.messages(fps, 3).count() == 9
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_dedup_oracle(spark, sf, oracle, documents):
    got = rows_of(queries.op8_exact_dedup(spark, sf).collect())
    assert got == oracle(queries.ORACLES["op8_exact_dedup"], documents=documents)


def test_mixing_oracle(spark, sf, oracle, documents):
    got = rows_of(queries.op9_mixing(spark, sf).collect())
    assert got == oracle(queries.ORACLES["op9_mixing"], documents=documents)


def test_mixing_hits_targets(spark, sf):
    plan = mixing.mix_plan(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    total = plan["size"].sum()
    by = plan.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"), most=("size", "max"))
    assert abs(by["target"].sum() - 1.5 * total) < 1e-6 * total
    assert (by["target"] <= 2 * by["size"] + 1e-6).all()
    assert ((by["taken"] - by["target"]).abs() <= by["most"] / 2 + 1e-6).all()
    assert (plan["taken"] <= 2 * plan["size"]).all()


def test_mixing_edges(docs_of, oracle):
    rows = [(k, "w " * (k % 7), None, s) for k, s in enumerate(["b", "a", None, "é", "Z"] * 9)]
    rows += [(1, "w " * 3, None, "b"), (1, "w " * 3, None, "b"), (None, "x y", None, "a"), (99, None, None, "a"), (98, "", None, "empty")]
    df = docs_of(rows, size=3, rank=1, copies=7)
    plan = mixing.mix_plan(df)
    assert plan.count() == len(rows)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == plan.agg({"copies": "sum"}).first()[0]
    assert mixing.mix_plan(docs_of([])).collect() == []
    unique = [r for i, r in enumerate(rows) if r[0] != 1 or i == 1]
    assert (rows_of(mixing.mix_plan(docs_of(unique)).select("doc_id", "size", "source_size", "target", "taken").collect())
            == oracle(queries.ORACLES["op9_mixing"], documents=docs_of(unique)))


def test_mixing_cuts_equal_ranks_row_by_row(docs_of, oracle):
    rows = [(None, f"w{k} " * (3 + k % 4), None, "a") for k in range(400)]               # null as the hot key
    rows += [(7, "w " * 4, None, "b")] * 300 + [(k, "w " * 5, None, "b") for k in range(1000, 1020)]     # equal rows
    rows += [(None, f"v{k} v v", None, None) for k in range(101)] + [(k, "w w", None, "c") for k in range(2000, 2300)]
    df = docs_of(rows).repartition(5)
    plan = mixing.mix_plan(df)
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    assert rows_of(plan.select(cols).collect()) == oracle(queries.ORACLES["op9_mixing"], documents=docs_of(rows))
    by = plan.groupBy("source").agg({"taken": "sum", "target": "first", "size": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["first(target)"]) <= r["max(size)"] / 2 for r in by)
    one = [sorted((r.source or "", r.row.text) for r in mixing.mix_plan(docs_of(rows).repartition(n)).filter("copies > 1").collect())
           for n in (2, 7)]
    assert one[0] == one[1]


def test_mixing_unequal_odds(docs_of):
    from pyspark.sql import functions as F
    df = docs_of([(k, "w " * 10, None, "s") for k in range(2000)] + [(5000 + k, "w " * 10, None, "t") for k in range(200)])
    df = df.withColumn("odds", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    plan = mixing.mix_plan(df, odds="odds", share=0.5, weights=(1.0,)).filter("source = 's'").toPandas()
    even, odd = (plan[plan.doc_id % 2 == k]["taken"].sum() for k in (0, 1))
    assert even > 1.8 * odd
    assert abs(even + odd - plan["target"].iloc[0]) <= 5


def test_mixing_inclusion_by_size(docs_of):
    # sizes of 5, 40 and 700 words have odds 4, 6 and 10; half of the words are to be drawn
    rows = [(k, "w " * (5, 40, 700)[k % 3], None, "s") for k in range(6000)]
    plan = mixing.mix_plan(docs_of(rows), share=0.5, weights=(1.0,)).toPandas()
    size = np.array([5, 40, 700])
    odds = np.array([4, 6, 10])
    factor = 0.5 * size.sum() / (odds * size).sum()
    for n, p in zip(size, factor * odds):
        drawn = plan[plan["size"] == n]["taken"] > 0
        assert abs(drawn.mean() - p) < 0.04
    assert abs(plan["taken"].sum() - 0.5 * plan["size"].sum()) <= 350


def test_mixing_certain_documents(docs_of):
    # at 95 % of the words the long documents' p would be over 1: all of them are taken, the rest is shared anew
    rows = [(k, "w " * (2 if k % 2 else 600), None, "s") for k in range(400)] + [(1000 + k, "w " * 60, None, "s") for k in range(900)]
    plan = mixing.mix_plan(docs_of(rows), share=0.95, weights=(1.0,)).toPandas()
    assert (plan[plan["size"] == 600]["taken"] == 600).mean() > 0.99
    need = 0.95 * plan["size"].sum() - 200 * 600
    p60 = need / (400 / 2 * 2 * 4 + 900 * 60 * 6) * 6
    assert abs((plan[plan["size"] == 60]["taken"] > 0).mean() - p60) < 0.04


def brute_rule(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fit = [(len(h + p), len(h), v, h + p) for v, h, p in urlrules.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


URLS = ["http://Example.ORG/es/1", "http://example.org/en/12", "http://a.b.example.org/en/1", "http://xexample.org/en/1",
        "https://org/x", "https://org", "http://x.com/fr/", "http://x.com/de/a?b=/fr/", "http://com/de/", "http://x.com/frx",
        None, "", "no scheme", "http://", "http:///org/", "://org/?a://com/de/", "http://É.org/\nx", "http://x.org:80/", "a://b://org/",
        "http://.org/", "http://a..org/", "http://x.com/fr/1#y", "http://" + "a." * 300 + "org/" + "p" * 100_000, "http://" + "b." * 100_000 + "example.org/es/x"]


def test_urls(spark, oracle):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)] + [(None, URLS[0], None), (3, URLS[3], ""), (3, URLS[3], "")], PAGES)
    from pyspark.sql import functions as F
    got = urlrules.filter_urls(pages.withColumn("rule", F.lit("r")).withColumn("host", F.lit("h")), urlrules.default_rules(spark))
    want = [dict(zip(("page_id", "host", "path", "rule", "verdict"), (r.page_id, *brute_rule(r.url)))) for r in pages.collect()]
    assert rows_of(got.collect()) == rows_of(want)
    assert rows_of(want) == oracle(queries.ORACLES["op3_url_filter"], pages=pages)
    none = spark.createDataFrame([], "verdict string, host string, path string")
    assert urlrules.filter_urls(pages, none).filter("rule is not null or verdict <> 'allow'").count() == 0
    assert urlrules.filter_urls(pages.limit(0), urlrules.default_rules(spark)).collect() == []


def test_urls_without_python(spark, sf):
    plan = queries.op3_url_filter(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_urls_oracle(spark, sf, oracle):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert rows_of(queries.op3_url_filter(spark, sf).collect()) == oracle(queries.ORACLES["op3_url_filter"], pages=pages)
