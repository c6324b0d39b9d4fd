"""Sharding by a hypergeometric communication matrix, in DataFrame functions only.

Rows lie in logical partitions (a hash of the row).  A deck that holds every shard's label as
often as the shard has rows is permuted and dealt to the partitions; how often partition p gets
label s is one exact draw of the communication matrix, multivariate hypergeometric, with the
partitions' sizes as row sums and the shards' exact sizes as column sums (Sanders 1998).  Each
partition is permuted locally and cut by its row of the matrix, the pieces are exchanged, and each
shard is permuted again: a uniform shuffle in which shard sizes differ by one at most.

Scale.  The deck holds numbers only.  A window sees ROWS_PER_PART rows or so: shards of any size
are permuted in sub-ranges of the hash and numbered through by the sub-ranges' counts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, row_key, running
from .permutation import permuted

ROWS_PER_PART = 20_000
#: Partitions whose places on the deck one window runs through.
PARTS_PER_BUCKET = 1_000


def matrix(sizes: DataFrame, n: int, shards: int, seed: int) -> DataFrame:
    """From (part, rows) the drawn communication matrix: part, shard, n."""
    begun = running(sizes.withColumn("deck", F.lit(0)), "deck", F.floor(F.col("part") / PARTS_PER_BUCKET), [F.col("part")], F.col("rows"), "begin")
    deck = begun.select("part", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("rows") - 1)).alias("place"))
    # Label s is on floor(pi * shards / n) = s, which the n places take equally often but for one.
    label = F.floor(permuted("place", f"{n}L", f"{seed}") * shards / F.lit(n)).cast("int")
    return deck.select("part", label.alias("shard")).groupBy("part", "shard").agg(F.count("*").alias("n"))


def shard(docs: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """docs with ``shard`` (int, 0 .. shards - 1) and ``slot`` (long, gapless from 0 per shard).

    Shard sizes differ by one at most.  Columns of docs with these names are replaced.  doc_id and
    text decide where a row goes (with the seed), other columns never; rows equal in both share
    their places among them in any order.  Null ids and texts are values like others; an empty
    table stays empty; with fewer rows than shards, some shards are empty.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    docs = docs.drop("shard", "slot")
    n = docs.count()
    parts = max(1, math.ceil(n / ROWS_PER_PART))
    part, rank, first, key, draw = (fresh(docs, x) for x in ("part_", "rank_", "first_", "key_", "draw_"))
    rows = docs.withColumn(key, row_key()).withColumn(part, F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(parts)).cast("int"))
    sizes = rows.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("rows"))
    drawn = matrix(sizes, n, shards, seed)
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("shard"))
    cuts = drawn.withColumn("upto", upto).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("cuts")).select(F.col("part").alias(f"{part}2"), F.col("cuts").alias(draw))
    # Local permutation, then the cut by the partition's row of the matrix.
    local = rows.withColumn(rank, F.row_number().over(Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed), F.lit("local"), key), key)))
    sent = local.join(cuts, F.col(part) == F.col(f"{part}2")).withColumn("shard", F.expr(f"filter(`{draw}`, x -> x.upto >= `{rank}`)[0].shard")).drop(draw, part, f"{part}2", rank)
    # The exchange, and the second permutation within each shard.
    spread = max(1, math.ceil(n / shards / ROWS_PER_PART))
    again = F.xxhash64(F.lit(seed), F.lit("again"), key)
    return running(sent, "shard", F.pmod(again, F.lit(spread)).cast("int"), [F.xxhash64(F.lit(seed), F.lit("slot"), key), F.col(key)], F.lit(1), "slot").drop(key)


def placed(docs: DataFrame, shards: int) -> DataFrame:
    """The digest of shard(): doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), text.alias("text"),
    )
    # The row's key stands for its text, which need not travel.
    light = rows.select("doc_id", "size", "text_crc32", F.hex(row_key()).alias("text"))
    return shard(light, shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
