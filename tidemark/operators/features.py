"""Bar features: a registry of window expressions over (sym, bn), and triple-barrier labels."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import div, filled, moving_average, round_half
from .kernels import BARRIER_SCHEMA, barriers, macd, rsi
from .scan import Kernel, chained, ordered_scan

Feature = Callable[[WindowSpec, int], Column]
REGISTRY: dict[str, Feature] = {}


def feature(name: str) -> Callable[[Feature], Feature]:
    """Registers a feature: a function of the symbol's window and n."""

    def add(f: Feature) -> Feature:
        REGISTRY[name] = f
        return f

    return add


def _ret(w: WindowSpec) -> Column:
    return F.ln(div(F.col("close"), F.lag("close").over(w)))


feature("logReturn")(lambda w, n: filled(F.col("ret"), w))
feature("momentum")(lambda w, n: filled(F.col("ratio"), w))
feature("meanReversion")(lambda w, n: div(F.col("close") - moving_average(F.col("close"), w, n), moving_average(F.col("close"), w, n)))
feature("realizedVol")(lambda w, n: F.sqrt(moving_average(F.col("ret") * F.col("ret"), w, n)))
feature("hlRange")(lambda w, n: div(F.col("high") - F.col("low"), F.col("low")))
feature("parkinson")(lambda w, n: F.sqrt(moving_average(F.pow(F.ln(div(F.col("high"), F.col("low"))), F.lit(2.0)), w, n) / (4 * math.log(2))))
feature("tradeImbalance")(lambda w, n: div(F.col("bqty") - F.col("sqty"), F.col("bqty") + F.col("sqty")))
feature("vpin")(lambda w, n: div(moving_average(F.abs(F.col("bqty") - F.col("sqty")), w, n), moving_average(F.col("bqty") + F.col("sqty"), w, n)))
feature("tradeIntensity")(lambda w, n: F.col("ticks") / F.greatest(F.lit(1), REGISTRY["duration"](w, n)))
feature("duration")(lambda w, n: round_half((F.unix_micros(F.col("barend").cast("timestamp")) - F.unix_micros(F.col("barstart").cast("timestamp"))) / 1e6))
feature("closePosition")(lambda w, n: F.when(F.col("high") == F.col("low"), 0.5).otherwise(div(F.col("close") - F.col("low"), F.col("high") - F.col("low"))))
feature("thetaNorm")(lambda w, n: div(F.col("theta"), F.col("dqty")))
feature("buyPct")(lambda w, n: div(F.col("bqty"), F.col("bqty") + F.col("sqty")))


#: Features that are recurrences: the kernels of one ordered scan, and the columns that each adds.
SCANS: dict[str, tuple[Callable[[], Kernel], tuple[str, ...]]] = {"rsi": (rsi, ("rsi",)), **dict.fromkeys(("macd", "macdSignal", "macdHist"), (macd, ("macd", "macdSignal", "macdHist")))}


def names() -> list[str]:
    return [*REGISTRY, *SCANS]


def build(bars: DataFrame, features: list[str], n: int = 10) -> DataFrame:
    """sym, bn, barstart, close and the named features, each symbol by itself.  RSI (14) and MACD
    (12, 26, 9) have fixed lengths, as n is that of the window features."""
    kernels = dict.fromkeys(SCANS[f] for f in features if f in SCANS)
    if kernels:
        made = [c for _, columns in kernels for c in columns]
        schema = T.StructType([*(f for f in bars.schema.fields if f.name not in made), *(T.StructField(c, T.DoubleType()) for c in made)])
        bars = ordered_scan(bars.drop(*made), ["sym"], ["bn"], chained(*(make() for make, _ in kernels)), schema)
    w = Window.partitionBy("sym").orderBy("bn")
    base = bars.withColumns({"ret": _ret(w), "ratio": div(F.col("close"), F.lag("close", n).over(w))})
    return base.select("sym", "bn", "barstart", "close", *((F.col(f) if f in SCANS else REGISTRY[f](w, n)).alias(f) for f in features))


def triple_barrier(bars: DataFrame, upper: float = 2.0, lower: float = 1.0, horizon: int = 50) -> DataFrame:
    """Labels of bars (sym, bn, high, low, close, sigma; sigma is null where there is none yet).

    The first of the next ``horizon`` bars that touches close (1 + upper sigma) or
    close (1 - lower sigma) decides; both in one bar give 0, none gives the sign at the last bar.
    One ordered scan, whatever the horizon.
    """
    priced = bars.select("sym", "bn", "high", "low", "close", "sigma", (F.col("close") * (1 + upper * F.col("sigma"))).alias("upperPx"), (F.col("close") * (1 - lower * F.col("sigma"))).alias("lowerPx"), F.lead("bn").over(Window.partitionBy("sym").orderBy("bn")).isNull().alias("end"))
    b = ordered_scan(priced, ["sym"], ["bn"], barriers(horizon), BARRIER_SCHEMA)
    reason = F.when(F.col("sigma").isNull(), "noSigma").when(F.col("lastBn").isNull(), "noFuture").when(F.col("hitBn").isNull(), "vertical").when(F.col("up") & F.col("dn"), "sameBar").when(F.col("up"), "upper").otherwise("lower")
    b = b.withColumn("reason", reason)
    drift = (F.col("lastClose") - F.col("close")) / F.col("close")
    of = lambda up_, dn_, same, vert: F.when(F.col("reason") == "upper", up_).when(F.col("reason") == "lower", dn_).when(F.col("reason") == "sameBar", same).when(F.col("reason") == "vertical", vert)
    return b.select(
        "sym", "bn", "close", "sigma", F.coalesce("hitBn", "lastBn").alias("endBn"), "upperPx", "lowerPx",
        of(F.lit(1), F.lit(-1), F.lit(0), F.signum(drift).cast("int")).cast("long").alias("label"), of(upper * F.col("sigma"), -lower * F.col("sigma"), F.lit(0.0), drift).alias("retAtTouch"), "reason",
    )


def label_distribution(labels: DataFrame) -> DataFrame:
    return labels.where(~F.col("reason").isin("noSigma", "noFuture")).groupBy("sym", "label").agg(F.count("*").alias("n"), div(F.sum(F.col("endBn") - F.col("bn")).cast("double"), F.count("*")).alias("avgHorizon"))


def label_summary(labels: DataFrame) -> DataFrame:
    kept = labels.where(~F.col("reason").isin("noSigma", "noFuture"))
    pct = lambda c: (100.0 * F.count_if(c) / F.count("*"))
    return kept.groupBy("sym").agg(F.count("*").alias("n"), pct(F.col("label") == 1).alias("upPct"), pct(F.col("label") == -1).alias("dnPct"), pct(F.col("reason") == "sameBar").alias("sameBarPct"), pct(F.col("reason") == "vertical").alias("verticalPct"))


def label_reasons(labels: DataFrame) -> DataFrame:
    """By symbol and reason how many labels, those without a verdict included."""
    return labels.groupBy("sym", "reason").agg(F.count("*").alias("n"))
