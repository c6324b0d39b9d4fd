"""Parsing of the exchange's JSON messages with Spark's JSON functions.

Rows that do not parse or lack a required field go to a second frame, with the reason, in place of
a counter in the handler.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _field(name: str, kind: str) -> Column:
    """A field of the message's data; names differ by case alone, so each is fetched by its path."""
    return F.get_json_object("value", f"$.data.{name}").try_cast(kind)


def stream_path(symbols: list[str], suffix: str, market: str = "spot") -> str:
    path = "/".join(s.lower() + suffix for s in symbols)
    return ("/market" if market == "futures" else "") + "/stream?streams=" + path


def levels(c: Column) -> Column:
    """[["price", "qty"], ...] as pairs of doubles; a level of the wrong shape is skipped, what
    stands after the first two elements is ignored."""
    pairs = F.transform(c, lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("price"), F.get(x, F.lit(1)).try_cast("double").alias("qty")))
    return F.filter(pairs, lambda p: p["price"].isNotNull() & p["qty"].isNotNull())


def _split(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    missing = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required)))
    marked = df.withColumn("missing", missing)
    return marked.where(F.size("missing") == 0).drop("missing", "value"), marked.where(F.size("missing") > 0).select("value", "missing")


def trades(messages: DataFrame, aggregated: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of messages (value: JSON text): price and quantity come as strings."""
    ids = {"aggTradeId": "a", "firstTradeId": "f", "lastTradeId": "l"} if aggregated else {"tradeId": "t"}
    rows = messages.select(
        "value", F.timestamp_millis(_field("E", "long")).alias("time"), _field("s", "string").alias("sym"), *(_field(v, "long").alias(k) for k, v in ids.items()), _field("p", "double").alias("price"), _field("q", "double").alias("qty"),
        _field("m", "boolean").alias("buyerIsMaker"), _field("E", "long").alias("exchEventTimeMs"), _field("T", "long").alias("exchTradeTimeMs"),
    )
    return _split(rows, ["sym", *ids, "price", "qty", "buyerIsMaker", "exchTradeTimeMs"])


def depth(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deltas, rejected): sym, kind, firstId, finalId, eventMs, bids, asks as the order book takes them."""
    as_lists = lambda c: F.transform(levels(F.from_json(F.get_json_object("value", f"$.data.{c}"), "array<array<string>>")), lambda x: F.array(x["price"], x["qty"]))
    rows = messages.select("value", _field("s", "string").alias("sym"), F.lit("delta").alias("kind"), _field("U", "long").alias("firstId"), _field("u", "long").alias("finalId"), _field("E", "long").alias("eventMs"), as_lists("b").alias("bids"), as_lists("a").alias("asks"))
    return _split(rows, ["sym", "firstId", "finalId", "bids", "asks"])
