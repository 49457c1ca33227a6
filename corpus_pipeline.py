"""Corpus pipeline: quality rules, exact dedup, near-duplicate join, mixing to target weights, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet before the next
one reads it. All but the last return the columns of ``documents``; the last returns a row for each
document of the mixture with its token ids and digests. ``run`` writes the stages into
the shared folder of spark.checkpoint.dir.

The tree model of the first stage, the probabilistic comparison of the third and the tokenizer of the last
have no SQL form, so ORACLE_SQL is None; tests/llm compares every stage with a brute-force version.
"""
from __future__ import annotations

from ratecast.llm import bpe, dedup, mixing, nearjoin, quality
from ratecast.llm.common import scratch_table, table
from ratecast.llm.queries import tokenizer_path

ORACLE_SQL = None

#: Rows of an Arrow batch between Spark and a Python worker. Whole texts travel, and what a batch needs is kept by
#: allocators on both sides for as long as an executor lives, over all stages.
BATCH_ROWS = "2000"


def small_batches(stage):
    """``stage`` in a session that sends small batches; the plan it returns runs later, so the setting stays."""
    def run(spark, docs, sf_dir):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)
    return run


@small_batches
def quality_rules(spark, docs, sf_dir):
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@small_batches
def exact_dedup(spark, docs, sf_dir):
    return dedup.exact_dedup(docs)


@small_batches
def near_dedup(spark, docs, sf_dir):
    return nearjoin.keep_one(docs)


@small_batches
def mix_sources(spark, docs, sf_dir):
    return mixing.mix(docs)


@small_batches
def encode_bpe(spark, docs, sf_dir):
    return bpe.encode(docs, tokenizer_path(), with_ids=True)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("mixing to target weights", mix_sources), ("BPE encoding", encode_bpe)]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch_table(docs, f"stage{k}")
    return docs
