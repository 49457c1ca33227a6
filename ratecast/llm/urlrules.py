"""URL filters, DataFrame functions only.

Each distinct URL is expanded into its host suffixes of the label counts times its path prefixes of the lengths that
rules have; expressions and rules meet on the first 8 hex digits of their
SHA-256, the full digests are compared, and the longest rule wins (of equally long ones the one
with the longer host, then block). URLs are joined, not pages: repeated URLs are judged once.

The lists of label counts and path lengths are at most as long as the longest rule. The rules go through an
ordinary join: Spark broadcasts them while they are small and splits a hot rule otherwise.

Defined results: null URLs and URLs without ``://`` have empty host and path and get the default
verdict; an empty rule table gives null rules; repeated rows are judged one by one; further
columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path): fixed values of the query's contract.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
URL = r"(?s)://([^/?#]*)([^?#]*)"
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def digest(expression: Column) -> Column:
    return F.sha2(F.encode(expression, "UTF-8"), 256)


def judge_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path), distinct -> (host, path, rule, verdict) for those that a rule fits."""
    # a rule is spelled host + path: the first slash parts them, so an expression is unambiguous
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    labels = [r[0] for r in rules.select(F.size(F.split("host", r"\."))).distinct().collect()]
    parts = F.split("host", r"\.")
    suffixes = F.filter(F.transform(F.array(*[F.lit(n) for n in labels]).cast("array<int>"),
                                    lambda n: F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), "."))),
                        lambda x: x.isNotNull())
    prefixes = F.filter(F.transform(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"),
                                    lambda n: F.when(F.length("path") >= n, F.substring(F.col("path"), F.lit(1), n))),
                        lambda x: x.isNotNull())
    spelled = (urls.filter("host <> ''").select("host", "path", F.explode(suffixes).alias("suffix"))
               .select("host", "path", "suffix", F.explode(prefixes).alias("prefix"))
               .select("host", "path", digest(F.concat("suffix", F.lit("\n"), "prefix")).alias("url_digest")))
    spelled = spelled.withColumn("short", F.substring("url_digest", 1, PREFIX_DIGITS))
    listed = rules.select(F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"),
                          digest(F.concat("host", F.lit("\n"), "path")).alias("rule_digest"))
    listed = listed.withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    hits = spelled.join(listed, "short").filter(F.col("url_digest") == F.col("rule_digest"))
    best = F.max(F.struct(F.length("rule").alias("length"), "host_length", (F.col("verdict") == "block").alias("b"),
                          "rule", "verdict"))
    return hits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """key, host, path, rule, verdict for every row of ``pages(key, url)``."""
    rows = pages.select(key, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judge_urls(rows.select("host", "path").distinct(), rules)
    return rows.join(judged, ["host", "path"], "left").select(
        key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def default_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "verdict string, host string, path string")
