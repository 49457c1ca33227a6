import hashlib
import re

from pyspark.sql import functions as F

import corpus_pipeline
from ratecast.llm import bpe, quality, queries
from ratecast.llm.common import table

from .test_bpe_near import brute_near


def test_stages_against_brute_force(spark, sf):
    """Every stage on its own input, each compared with a plain version."""
    docs = table(spark, sf, "documents")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), stage(spark, docs, sf).schema)
        after = docs.collect()
        if k < 4:
            assert docs.columns == names
        ids = sorted(r.doc_id for r in after)
        if k == 0:
            judged = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels")).filter("kept")
            assert ids == sorted(r.doc_id for r in judged.collect())
        if k == 1:
            first = {}
            for r in sorted(before, key=lambda r: r.doc_id):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r)
            assert sorted(after) == sorted(first.values())
        if k == 2:
            rows = [(r.doc_id, r.text) for r in before]
            assert ids == sorted({dict(x)["class_id"] for x in brute_near(rows)})
        if k == 3:
            words = {r.doc_id: len(r.text.encode().split()) for r in before}
            total = sum(words.values())
            assert abs(sum(words[i] for i in ids) - 1.5 * total) < 0.1 * total
            assert max(ids.count(i) for i in set(ids)) <= 2 and set(ids) <= set(words)
        if k == 4:
            tok = bpe.load(queries.tokenizer_path())
            want = sorted((r.doc_id, tok.encode(r.text, add_special_tokens=False).ids) for r in before)
            assert sorted((r.doc_id, list(r.ids)) for r in after) == want
            assert all(r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() for r in after)


def test_run(spark, sf):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, sf).count() > 0


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
GOOD = " ".join(f"word{k} stands beside other{k} here." for k in range(40))


def _run(spark, tmp_path, rows, extra=None):
    df = spark.createDataFrame(rows, DOCS)
    for c in extra or ():
        df = df.withColumn(c, F.lit(1))
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, None), (2, None, 0)], "doc_id bigint, quality bigint, toxic bigint").write.parquet(
        str(tmp_path / "labels.parquet"))
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_run_on_an_empty_table(spark, tmp_path):
    assert _run(spark, tmp_path, []) == []


def test_run_with_nulls_ties_and_clashing_columns(spark, tmp_path):
    rows = [(k, f"{GOOD} story {k} " + " ".join(f"own{k}x{j}" for j in range(60)), None, (None, "a", "b")[k % 3], None) for k in range(1, 40)]
    rows += [(1, rows[0][1], None, "b", 3)] * 3 + [(None, rows[1][1], None, None, None)] * 2 + [(50, None, None, None, None), (51, "", "en", "a", 0)]
    rows += [(60, "w" * 300_000, None, "a", None), (61, rows[5][1] + " one more", None, "c", None)]
    got = _run(spark, tmp_path, rows, ["fp", "norm", "row", "size", "rank", "odds", "copies", "block", "ids", "n_tokens", "sig", "hash"])
    ids = {r.doc_id for r in got}
    assert got and ids <= {r[0] for r in rows} and not ids & {50, 51}                # empty texts fail the base rules
    assert not {6, 61} <= ids and all(r.n_tokens == len(r.ids) for r in got)          # one of the near copies stays

