"""Market views over the driver's tables (events, orders, lineitem)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _as_trades(events: DataFrame) -> DataFrame:
    e = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.select(F.col("ts").alias("time"), F.col("event_type").alias("sym"), F.col("event_id").alias("tradeId"), F.col("value").alias("price"), (F.col("k") + 1).cast("double").alias("qty"), (F.col("k") % 2 == 1).alias("buyerIsMaker"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """time, sym, tradeId, price, qty, buyerIsMaker; the order key is tradeId."""
    return _as_trades(spark.read.parquet(f"{sf_dir}/events.parquet"))


def trade_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trades() as a stream: what is there when it starts, and files that come later."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return _as_trades(spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events.parquet}}"))  # a pattern, for a stream's plain path must be a folder


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    level = lambda i: (
        (F.col("value") - 0.01 * i).alias(f"bidPrice{i}"), (1 + (F.col("event_id") * 7 + i * 13) % 97).cast("double").alias(f"bidQty{i}"),
        (F.col("value") + 0.01 * i).alias(f"askPrice{i}"), (1 + (F.col("event_id") * 11 + i * 17) % 97).cast("double").alias(f"askQty{i}"),
    )
    return e.select(F.col("ts").alias("time"), F.col("event_type").alias("sym"), F.col("event_id").alias("fhSeqNo"), *(c for i in range(1, 6) for c in level(i)), (F.col("event_id") % 50 != 0).alias("isValid"))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as positions taken: one for each order, its symbol by key."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    names = F.array(*map(F.lit, ("click", "purchase", "signup", "view", "other")))
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("time"), F.get(names, (F.col("o_orderkey") % 5).cast("int")).alias("sym"), F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1).alias("side"), (1 + F.col("o_custkey") % 10).cast("double").alias("qty"), F.col("o_totalprice").alias("tradedPrice"))


def funding(spark: SparkSession, sf_dir: str, hours: int = 8) -> DataFrame:
    """A row for each symbol and boundary within its trades' time."""
    t = trades(spark, sf_dir)
    span = t.groupBy("sym").agg(F.date_trunc("day", F.min("time")).cast("timestamp_ntz").alias("lo"), F.max("time").alias("hi"))
    at = span.select("sym", F.explode(F.sequence("lo", "hi", F.expr(f"interval {hours} hours"))).alias("fundingTime"))
    return at.withColumn("fundingRate", ((F.hour("fundingTime") + F.length("sym")) % 7 - 3) / F.lit(10000.0))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health rows of handlers, one for each event."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(F.col("event_type").alias("handler"), F.col("ts").alias("time"), F.col("event_id").alias("msgsPublished"), (1 + F.col("event_id") % 977).alias("uptimeSec"), (F.col("ts") - F.expr("interval 3 seconds")).alias("lastMsgTimeUtc"))
