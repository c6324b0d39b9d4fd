"""Getters over the analytics' tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.semantics import exact_sum, format_ago, format_count, format_duration
from ..operators.relational import keep_latest, price_series, since, spread_mid
from ..sources.adapters import funding, health, positions, quotes, trades

# Implied volatilities in percent, and the returns needed before a volatility is valid.
IMPLIED = {"BTCUSDT": 45.0, "ETHUSDT": 65.0, "SOLUSDT": 67.0}
TARGET = 120


def order_book(rows: DataFrame, sym: str | None = None, order: str = "fhSeqNo") -> DataFrame:
    """Each symbol's latest quote with spread and mid."""
    q = rows.where(F.col("sym") == sym) if sym else rows
    return spread_mid(keep_latest(q, ("sym",), order))


def latest(table: DataFrame, order: str, sym: str | None = None) -> DataFrame:
    """Each symbol's latest row, or one symbol's."""
    return keep_latest(table.where(F.col("sym") == sym) if sym else table, ("sym",), order)


def pnl_history(rows: DataFrame, interval: str, order: str = "tradeId") -> DataFrame:
    """bucket, pnl: what one unit of each symbol, bought at its first price, is up by bucket."""
    first = rows.groupBy("sym").agg(F.min_by("price", order).alias("first"))
    return price_series(rows, interval, order).join(first, "sym").groupBy("bucket").agg(exact_sum(F.col("price") - F.col("first")).alias("pnl"))


def prices(rows: DataFrame, order: str = "tradeId") -> DataFrame:
    """sym, price: the last of each symbol."""
    return rows.groupBy("sym").agg(F.max_by("price", order).alias("price"))


def latest_volatility(history: DataFrame) -> DataFrame:
    return keep_latest(history, ("sym",), "time")


def volatility_comparison(history: DataFrame, implied: dict[str, float] = IMPLIED) -> DataFrame:
    known = F.create_map(*(x for k, v in implied.items() for x in (F.lit(k), F.lit(v))))
    return latest_volatility(history).withColumn("impliedVol", F.try_element_at(known, F.col("sym"))).withColumn("difference", F.col("annualizedVol") - F.col("impliedVol"))


def history(table: DataFrame, now, minutes: float, sym: str | None = None) -> DataFrame:
    out = since(table, now, minutes)
    return out.where(F.col("sym") == sym) if sym else out


def get_volatility(volatility: DataFrame, symbol: str | None = None) -> dict:
    """The read-only tool: the latest volatilities, of one symbol (in any case) or of all."""
    wanted = volatility if symbol is None else volatility.where(F.upper("sym") == symbol.upper())
    found = latest_volatility(wanted).orderBy("sym").collect()  # a row for each symbol
    if not found:
        return {"data": [], "note": "no data yet: volatility is warming up" if symbol is None else f"no data for {symbol.upper()}"}
    data = [{"symbol": r.sym, "volatility": r.annualizedVol, "samples": r.samples, "valid": r.isValid} for r in found]
    return {"data": data, "note": f"annualised realized volatility in percent; valid from {TARGET} samples on"}


def handler_view(status: DataFrame) -> DataFrame:
    """relational.handler_status() as a dashboard shows it: Handler, State, Uptime, MsgsSec, Published, LastMsg."""
    return status.select(
        F.col("handler").alias("Handler"), F.col("connState").alias("State"), format_duration(F.col("uptimeSec")).alias("Uptime"), F.col("avgRate").alias("MsgsSec"),
        format_count(F.col("msgsPublished")).alias("Published"), format_ago(F.col("lastActivitySec")).alias("LastMsg"),
    )


def latency_view(latencies: DataFrame, by: tuple[str, ...] = ("sym",)) -> DataFrame:
    """Of relational.latency_percentiles() the latest bucket of each symbol (and handler, if given)."""
    shown = {"ParseP50": "parseP50", "ParseP95": "parseP95", "SendP50": "sendP50", "SendP95": "sendP95"}
    return keep_latest(latencies, by, "bucket").select(*(F.col(c).alias(c.capitalize()) for c in by), *(F.col(v).alias(k) for k, v in shown.items()))


def schema_status(spark: SparkSession, tables: dict[str, tuple[DataFrame, StructType]]) -> DataFrame:
    """By table whether rows were there to validate, whether it has every declared column in its declared type
    (a table without rows is valid), how many are declared, and which are amiss."""
    rows = []
    for name, (table, declared) in tables.items():
        has = {f.name: f.dataType for f in table.schema}
        amiss = [f.name for f in declared if has.get(f.name) != f.dataType]
        seen = not table.isEmpty()
        rows.append((name, seen, not (seen and amiss), len(declared), amiss))
    return spark.createDataFrame(rows, "table string, validated boolean, valid boolean, expectedFields int, amiss array<string>")


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Temporary views trades, quotes, positions, funding and health for queries in plain SQL."""
    tables = {"trades": trades, "quotes": quotes, "positions": positions, "funding": funding, "health": health}
    for name, make in tables.items():
        make(spark, sf_dir).createOrReplaceTempView(name)
    return list(tables)
