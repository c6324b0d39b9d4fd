"""Importance resampling of documents towards a target distribution, over hashed n-grams.

Every n-gram falls into one of ``buckets``; a bucket's gain is the logarithm of its share in the target
over its share in the documents, a document's weight the sum of its features' gains, and documents
are drawn without replacement by the largest weight plus Gumbel noise.

Long texts are skewed: their words are cut into chunks of CHUNK words which carry n - 1 words of the
next chunk, so that each n-gram stands whole in the chunk that owns its first word and in no other
as a start.  Chunks are dealt to tasks apart from each other, and a document's counts and weights are
sums over its chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, staged

#: Runs of letters, digits and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words that a chunk owns, and bytes of texts that are left whole.
CHUNK, WHOLE_BYTES = 4096, 32_768


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), F.lit(f"({WORD})"), F.lit(1))


def features(words_: str, own: str, n: int) -> str:
    """SQL for the runs of 1 to n of the words that begin at one of the first ``own``."""
    runs = [f"slice({words_}, 1, {own})" if k == 1 else f"transform(sequence(1, greatest(1, least({own}, size({words_}) - {k - 1}))), i -> array_join(slice({words_}, i, {k}), ' '))" for k in range(1, n + 1)]
    runs = [r if k == 1 else f"if(size({words_}) < {k}, array(), {r})" for k, r in enumerate(runs, 1)]
    return runs[0] if n == 1 else f"concat({', '.join(runs)})"


def chunked(docs: DataFrame, n: int, buckets: int, chunk: int = CHUNK) -> DataFrame:
    """key, doc_id, at (the chunk's first word), own (words that it owns), places (the buckets of the features that begin at these)."""
    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > WHOLE_BYTES

    def cut(part: DataFrame) -> DataFrame:
        w = part.select("key", "doc_id", words(F.col("text")).alias("words"))
        return w.select("key", "doc_id", F.explode(F.expr(f"transform(sequence(0, greatest(size(words) - 1, 0), {chunk}), s -> struct(s as at, slice(words, s + 1, {chunk + n - 1}) as words))")).alias("c")).select("key", "doc_id", "c.at", "c.words")

    tasks = docs.sparkSession.sparkContext.defaultParallelism * 4
    spread = cut(rows.where(long)).repartition(tasks, "key", "at")
    parts = cut(rows.where(~long)).unionByName(spread)
    return parts.select("key", "doc_id", "at", F.expr(f"least(size(words), {chunk})").alias("own"), F.expr(f"transform({features('words', str(chunk), n)}, f -> cast(crc32(cast(f as binary)) % {buckets} as int))").alias("places"))


def _counted(places: DataFrame) -> DataFrame:
    return places.select(F.explode("places").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """bucket, gain of all buckets, from the counts (bucket, n) of both sides."""
    total = lambda t: t.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    s, t = source.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    up, down = total(source) + buckets, total(target) + buckets
    all_ = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0)
    of = lambda c: (F.col(c) + 1).cast("double")
    return all_.select("bucket", F.floor(1000 * F.log(of("t") * F.lit(float(up)) / (of("s") * F.lit(float(down))))).cast("long").alias("gain"))


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u from the first 32 bits of a hash of seed and id; a null id is the empty string."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighted(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, least: int = 20, seed: int = 2024, chunk: int = CHUNK) -> DataFrame:
    """key, doc_id, n_words, n_features, weight, score, eligible: a row for each row of docs.

    Null, empty and wordless texts have no features and weight 0; a null doc_id draws its noise as the
    empty string; rows that repeat id and text have equal rows; an empty table gives none, an empty
    target gives gains towards the even distribution; other columns are ignored.
    """
    places = staged(chunked(docs, n, buckets, chunk), "resampling-chunks")
    found = gains(staged(_counted(places), "resampling-source"), staged(_counted(chunked(target.select(F.lit(None).alias("doc_id"), "text"), n, buckets, chunk)), "resampling-target"), buckets)
    found = staged(found, "resampling-gains")
    # A row that stands there several times is added up and divided.
    each = places.select("key", "doc_id", "at", "own", F.posexplode_outer("places").alias("pos", "bucket")).join(F.broadcast(found), "bucket", "left")
    head = F.coalesce("pos", F.lit(0)) == 0
    sums = each.groupBy("key", "doc_id").agg(
        F.sum(F.when(head, F.col("own")).otherwise(0)).alias("words"), F.count("bucket").alias("n"), F.coalesce(F.sum("gain"), F.lit(0)).alias("w"), F.count_if(head & (F.col("at") == 0)).alias("copies"),
    )
    rows = sums.withColumn("copy_", F.explode(F.expr("sequence(1L, copies)"))).select("key", "doc_id", *(F.expr(f"{c} div copies").alias(out) for c, out in (("words", "n_words"), ("n", "n_features"), ("w", "weight"))))
    return rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("eligible", F.col("n_words") >= least)


def ranked(rows: DataFrame, percent: int) -> DataFrame:
    """rows (key, doc_id, score, eligible, ...) with rank: 1, 2, 3 ... of the floor(percent N / 100) eligible rows
    with the highest scores, ties to the smaller doc_id (null last); null for the others.

    Rows are dealt to ranges of the order and numbered within; the ranges' counts run through."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("key")]
    dealt = staged(rows.where("eligible").repartitionByRange(*order).withColumn("part_", F.spark_partition_id()), "resampling-ranges")
    sizes = dealt.groupBy("part_").agg(F.count("*").alias("n_"), F.max("score").alias("top_"))
    before = sizes.select(F.col("part_").alias("of_"), (F.sum("n_").over(Window.orderBy("part_")) - F.col("n_")).alias("before_"))
    drawn = dealt.count() * percent // 100
    within = F.row_number().over(Window.partitionBy("part_").orderBy(*order))
    numbered = dealt.withColumn("rank", within).join(F.broadcast(before), F.col("part_") == F.col("of_")).withColumn("rank", F.col("before_") + F.col("rank")).drop("part_", "of_", "before_")
    none = F.lit(None).cast("long")
    numbered = numbered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return numbered.unionByName(rows.where("not eligible").withColumn("rank", none))


def drawn(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of docs (see weighted and ranked)."""
    rows = staged(weighted(docs, target, n, buckets, least, seed), "resampling-weights")
    return ranked(rows, percent).select("doc_id", "n_features", "weight", "score", "rank")
