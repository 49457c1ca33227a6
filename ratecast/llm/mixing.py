"""Mixing sources to target weights by Pareto order sampling.

The sources, by code point and null last, weigh ``weights`` in turn and share ``share`` of
all sizes (words); no target exceeds ``most`` times its source's size, and what is cut is
shared anew by weight. A source whose target is r times its size takes floor(r) whole copies of
each document, certain; the rest is drawn: documents are ranked by the Pareto variable
[u / (1 - u)] / [p / (1 - p)], u uniform from a hash of seed and doc_id, p the inclusion
probability, and taken in that order until the source's missing words are reached
(the sample's size is fixed in words; the document at the border goes in if at least half
of it fits).

``p`` is proportional to the document's odds: by default the number of binary digits of its size, from 4 to 13, so a long
document is drawn up to 3.25 times as often as a short one; an ``odds`` column of positive numbers may be given instead. The factor is that at
which the expected words are the missing ones; where it would push a document's p over 1, that document is certain and the
rest is shared anew among the others (by sums per source and odds, a few rounds).

The cut needs no sort of a whole source: ranks are put into about sqrt(documents) buckets,
words are summed per bucket, and only the border bucket is put in order, by rank, doc_id and size with words summed for
each. Rows equal in these are cut row by row, by a hash of the whole row and a number, again from sums per key.

Defined results: null text: size 0; null doc_id is hashed as an empty string; rows of one doc_id
have equal ranks and are cut by size, hash of the row and number; a source without words has target 0; an empty table
gives an empty result; further columns are ignored (``mix`` keeps them).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORDS, scratch_table

SEED = "mix-1"
#: Up to this many sources their table is broadcast; beyond, Spark picks the join.
BROADCAST_SOURCES = 10_000


def size_of(col: str = "text") -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(col, F.lit(WORDS), F.lit(0))), F.lit(0)).cast("bigint")


def hashed_uniform(seed: str) -> Column:
    """Uniform in (0, 1) from 52 bits of md5(seed:doc_id); any SQL engine can repeat it."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sized: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, n_docs, target). The sources are ranked by a distributed sort
    and zipWithIndex; the driver only holds sums over sources."""
    spark = sized.sparkSession
    sums = (sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")))
    ranked = sums.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(
        lambda x: (x[0][0], x[0][1], x[0][2], float(weights[x[1] % len(weights)])))
    schema = T.StructType([sized.schema["source"], T.StructField("source_size", T.LongType()),
                           T.StructField("n_docs", T.LongType()), T.StructField("weight", T.DoubleType())])
    src = scratch_table(spark.createDataFrame(ranked, schema), "sources")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped = share * total, 0.0, -1
    while total:
        # water level: words per unit of weight among the sources that are not full
        over = F.lit(level) * F.col("weight") > F.lit(most) * F.col("source_size")
        s = src.agg(F.sum(F.when(over, most * F.col("source_size")).otherwise(0.0)),
                    F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.sum(over.cast("int"))).first()
        if s[2] == capped or not s[1]:
            break
        level, capped = (budget - s[0]) / s[1], s[2]
    return src.withColumn("target", F.least(F.lit(level) * F.col("weight"), F.lit(most) * F.col("source_size")))


def _border(rows: DataFrame, key: Column, words: str) -> DataFrame:
    """source, cut, before, rows, need: of each source the first key by which ``need`` words are reached,
    the words before it and the rows it has."""
    order = Window.partitionBy("source").orderBy("key")
    sums = (rows.withColumn("key", key).groupBy("source", "key")
            .agg(F.sum(words).alias("words"), F.count(F.lit(1)).alias("rows"), F.first("need").alias("need"))
            .withColumn("before", F.sum("words").over(order) - F.col("words")))
    return (sums.filter(F.col("before") + F.col("words") >= F.col("need"))
            .groupBy("source").agg(F.min(F.struct("key", "before", "rows", "need")).alias("b"))
            .select("source", F.col("b.key").alias("cut"), F.col("b.before").alias("before"),
                    F.col("b.rows").alias("rows"), F.col("b.need").alias("need")))


def _pick_tied(rows: DataFrame, with_cut) -> DataFrame:
    """``rows`` of one place in each source, of which ``fit`` are chosen: by a hash of the whole row, and equal rows by
    number. Each step counts per key (top bits of the hash, hash, partition, number) and goes on in the border key."""
    h = F.xxhash64(F.to_json("row"))
    t = scratch_table(rows.drop("chosen").withColumn("hash", h).withColumn("number", F.monotonically_increasing_id())
                      .withColumn("one", F.lit(1)), "tied")
    t = t.withColumn("need", F.col("fit").cast("double")).withColumn("chosen", F.lit(None).cast("boolean"))
    for key in (F.shiftright("hash", 48), F.col("hash"), F.shiftright("number", 33), F.col("number")):
        cuts = scratch_table(_border(t.filter("chosen IS NULL"), key, "one").select("source", "cut", "before"), "tie")
        t = (with_cut(t, cuts)
             .withColumn("chosen", F.coalesce("chosen", F.when(key < F.col("cut"), True).when(key > F.col("cut"), False)))
             .withColumn("need", F.col("need") - F.col("before")).drop("cut", "before"))
    return t.withColumn("chosen", F.coalesce("chosen", F.lit(True)))


def size_odds(size: str = "size") -> Column:
    """Default odds of a document: binary digits of its size, 4 to 13 (whole numbers, the same in any engine)."""
    return F.least(F.greatest(F.length(F.bin(F.col(size))), F.lit(4)), F.lit(13)).cast("double")


def inclusion_factors(light: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, factor): p = factor * odds, at most 1, adds up to the words that a source misses after its whole copies."""
    need = F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")
    wanted = targets.filter("source_size > 0").select("source", need.alias("need")).filter("need > 0")
    cells = light.filter("odds > 0").groupBy("source", "odds").agg(F.sum("size").alias("words"))
    cells = scratch_table(cells.alias("c").join(wanted.alias("w"), F.col("c.source").eqNullSafe(F.col("w.source")))
                          .select("c.*", "need", F.lit(0.0).alias("factor")), "odds")
    sure = -1
    while True:
        over = F.col("factor") * F.col("odds") > 1
        per = cells.groupBy("source").agg(F.max("need").alias("need"), F.sum(F.when(over, F.col("words")).otherwise(0)).alias("certain"),
                                          F.sum(F.when(over, 0.0).otherwise(F.col("odds") * F.col("words"))).alias("rest"),
                                          F.sum(over.cast("int")).alias("sure"), F.max("factor").alias("old"))
        # all certain, or nothing but empty texts left: the factor stays
        per = scratch_table(per.withColumn("factor", F.when(F.col("rest") > 0, (F.col("need") - F.col("certain")) / F.col("rest")).otherwise(F.col("old"))),
                            "factors")
        now = per.agg(F.sum("sure")).first()[0]
        if now is None or now == sure:
            return per.select("source", "factor")
        sure = now
        cells = scratch_table(cells.drop("factor").alias("c").join(per.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source")))
                              .select("c.*", "p.factor"), "odds")


def mix_plan(docs: DataFrame, seed: str = SEED, odds: str | None = None, **kw) -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken; the row as ``row``."""
    keep = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = docs.select("doc_id", "source", size_of().alias("size"),
                        (F.col(odds) if odds else F.lit(None)).cast("double").alias("odds"), keep.alias("row"))
    if not odds:
        sized = sized.withColumn("odds", size_odds())
    light = scratch_table(sized.select("doc_id", "source", "size", "odds"), "sizes")
    targets = source_targets(light, **kw)
    targets = scratch_table(
        targets.alias("t").join(inclusion_factors(light, targets).alias("f"), F.col("t.source").eqNullSafe(F.col("f.source")), "left")
        .select("t.*", F.coalesce("factor", F.lit(0.0)).alias("factor")), "targets")
    few = targets.count() <= BROADCAST_SOURCES
    small = F.broadcast(targets) if few else targets

    def with_rank(df: DataFrame) -> DataFrame:
        rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        joined = df.alias("d").join(small.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")), "inner").select(
            "d.*", "source_size", "n_docs", "target", "factor")
        joined = joined.withColumn("whole", F.floor(rate))
        p = F.least(F.greatest(F.col("factor") * F.coalesce(F.col("odds"), F.lit(0.0)), F.lit(1e-12)), F.lit(0.999999999))
        u = hashed_uniform(seed)
        q = (u / (1 - u)) / (p / (1 - p))
        joined = joined.withColumn("rank", q / (1 + q)).withColumn(
            "need", F.col("target") - F.col("whole") * F.col("source_size"))
        return joined.withColumn("bucket", F.floor(F.col("rank") * F.ceil(F.sqrt("n_docs"))))

    def hint(df):
        return F.broadcast(df) if few else df

    def with_cut(df, cuts):
        return df.alias("d").join(hint(cuts).alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")), "left").select(
            "d.*", *[f"b.{c}" for c in cuts.columns if c != "source"])

    place = F.struct("rank", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "size")
    ranked = with_rank(light)
    first = scratch_table(_border(ranked, F.col("bucket"), "size"), "borders").select(
        "source", F.col("cut").alias("bucket_cut"), F.col("before").alias("bucket_before"))
    inside = with_cut(ranked, first).filter("bucket = bucket_cut").withColumn("need", F.col("need") - F.col("bucket_before"))
    # rows of one place have one size: so many of them fit, the last if at least half of it does
    one = F.col("cut.size")
    fit = F.when(one > 0, F.floor((F.col("need") - F.col("before") - one / 2) / one) + 1).otherwise(F.col("rows"))
    last = scratch_table(
        _border(inside, place, "size").withColumn("fit", F.greatest(F.least(fit, F.col("rows")), F.lit(0)).cast("bigint"))
        .select("source", F.col("cut").alias("last"), "rows", "fit"), "cuts")
    full = with_cut(with_cut(with_rank(sized), first), last)
    tied = (F.col("need") > 0) & (F.col("bucket") == F.col("bucket_cut")) & (place == F.col("last")) & (
        F.col("fit") > 0) & (F.col("fit") < F.col("rows"))
    chosen = (F.col("need") > 0) & (F.col("bucket_cut").isNull() | (F.col("bucket") < F.col("bucket_cut"))
                                    | ((F.col("bucket") == F.col("bucket_cut")) & (
                                        (place < F.col("last")) | ((place == F.col("last")) & (F.col("fit") == F.col("rows"))))))
    full = full.withColumn("chosen", F.coalesce(chosen, F.lit(False)))
    if last.filter("fit > 0 AND fit < rows").limit(1).count():
        picked = _pick_tied(full.filter(tied), with_cut)
        full = full.filter(~F.coalesce(tied, F.lit(False))).unionByName(picked.select(full.columns))
    copies = (F.col("whole") + F.col("chosen").cast("int")).cast("bigint")
    return full.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"), "row")


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed documents: each row as often as it was taken."""
    return (mix_plan(docs, **kw).filter("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("row.*"))
