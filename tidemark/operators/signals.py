"""The cross-symbol RSI signal: boundary closes by as-of lookup, RSI, ranking, two positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import rsi
from .relational import asof, rank_extremes
from .scan import ordered_scan

BOUNDARIES = 15


def boundary_closes(trades: DataFrame, interval_s: int, order: str = "tradeId") -> DataFrame:
    """Each symbol's last prices at BOUNDARIES times, interval_s apart, up to its last trade."""
    end = trades.groupBy("sym").agg(F.max("time").alias("end"))
    steps = end.select("sym", F.explode(F.sequence(F.lit(0), F.lit(BOUNDARIES - 1))).alias("step"), "end")
    at = steps.select("sym", "step", (F.col("end") - F.expr(f"make_dt_interval(0, 0, 0, {interval_s} * ({BOUNDARIES - 1} - step))")).alias("boundary"))
    return asof(at, trades, "sym", "boundary", "time", "price", order)


def rsi_signal(trades: DataFrame, interval_s: int = 20, notional: float = 100_000.0) -> DataFrame:
    """sym, rsi, close, exposure, qty; no rows if any symbol lacks a close or an RSI, or with one symbol only."""
    closes = boundary_closes(trades, interval_s).withColumnRenamed("price", "close")
    scored = ordered_scan(closes.select("sym", "step", "close"), ["sym"], ["step"], rsi("close", BOUNDARIES - 1, "signal"), "sym string, step int, close double, rsi double").where(f"step = {BOUNDARIES - 1}")
    whole = scored.agg((F.count("*") >= 2).alias("many"), F.bool_and(F.col("rsi").isNotNull() & F.col("close").isNotNull()).alias("complete")).where("many and complete").select(F.lit(1).alias("one"))
    ranked = rank_extremes(scored.select("sym", "rsi", "close"), "rsi").withColumn("one", F.lit(1)).join(F.broadcast(whole), "one").drop("one")
    return ranked.withColumn("qty", F.when(F.col("exposure") != 0, F.lit(notional) / F.col("close")))
