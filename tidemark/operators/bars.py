"""Data-driven bars: warm-up by calibrated constant thresholds, then adaptive thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.semantics import dib_threshold, div, drb_threshold, exact_sum, rw_threshold, trade_sign
from .carry import bucket, carried
from .kernels import MARKS, bar_marks
from .scan import kept, ordered_scan

#: The open bar after each tick, and the state that a warm-up hands on.
OPEN = "bn long, theta double, tib long, bib long, dib double"
STATE = ("et", "pb", "ed", "th", "anchor", "anchorprice", "bn", "theta", "tib", "bib", "dib")
TICKS = "sym string, time timestamp_ntz, tradeId long, price double, qty double, bt int, dvol double, sd double"


def ticks(trades: DataFrame, min_dollars: float = 50.0) -> DataFrame:
    """Trades of at least min_dollars with sign, dollars and signed dollars; all counts are over these."""
    t = trades.withColumn("dvol", F.col("price") * F.col("qty")).where(F.col("dvol") >= min_dollars).withColumn("bt", trade_sign(F.col("buyerIsMaker")))
    return t.select("sym", F.col("time").cast("timestamp_ntz").alias("time"), "tradeId", "price", "qty", F.col("bt").cast("int").alias("bt"), "dvol", (F.col("bt") * F.col("dvol")).alias("sd"))


def ohlcv(numbered: DataFrame) -> DataFrame:
    """One row per bar (sym, bn) of numbered ticks; theta is the sum of signed dollars."""
    of = lambda c, sign: exact_sum(F.when(F.col("bt") == sign, F.col(c)).otherwise(0.0))
    qty, dollars = exact_sum(F.col("qty")), exact_sum(F.col("dvol"))
    return numbered.groupBy("sym", "bn").agg(
        F.min("time").alias("barstart"), F.max("time").alias("barend"), F.min_by("price", "tradeId").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "tradeId").alias("close"),
        qty.alias("qty"), dollars.alias("dqty"), F.count("*").alias("ticks"), F.count_if(F.col("bt") > 0).alias("buys"), of("qty", 1).alias("bqty"), of("qty", -1).alias("sqty"), div(dollars, qty).alias("vwap"),
        exact_sum(F.col("sd")).alias("theta"),
    )


#: Lower than every trade id: the place of the row that starts a symbol's scan.
_FIRST = -(1 << 63)


def marks(trades_ticks: DataFrame, start: DataFrame | float, kind: str, span: int | None = None) -> DataFrame:
    """kernels.bar_marks over each symbol's ticks, from the row of ``start`` (sym, th, ...) of the symbol (those
    without one are passed over) or from one threshold for all.  A tick sends its id, day and signed
    dollars only, and what comes back is a row a bar."""
    fed = trades_ticks.select("sym", "tradeId", F.unix_date(F.to_date("time")).alias("day"), "sd", F.lit(None).cast("string").alias("start"))
    if isinstance(start, float):
        return ordered_scan(fed, ["sym"], ["tradeId"], bar_marks(kind, span, start), MARKS)
    known = F.to_json(F.struct(*(c for c in start.columns if c != "sym")))
    first = start.select("sym", F.lit(_FIRST).cast("long").alias("tradeId"), F.lit(0).alias("day"), F.lit(0.0).alias("sd"), known.alias("start"))
    return ordered_scan(fed.unionByName(first), ["sym"], ["tradeId"], bar_marks(kind, span), MARKS)


def numbered(trades_ticks: DataFrame, found: DataFrame, opens: bool, width: int | None = None) -> DataFrame:
    """The ticks with ``bn``.  Marks either open a bar (ticks before the first are bar 0) or close one (``closed_on``
    is the day of the close; ticks after the last have null).  They are carried over the ticks in
    buckets of ids, so one symbol's ticks are dealt to many tasks."""
    closes = found.where("closed").select("sym", "tradeId", F.struct("bn", "day").alias("mark_"), F.lit(1).alias("is_"))
    both = trades_ticks.withColumns({"is_": F.lit(0)}).unionByName(closes, allowMissingColumns=True)
    order = ["tradeId", "is_"] if not opens else ["tradeId", "not_"]
    both = both.withColumn("not_", 1 - F.col("is_"))
    out = carried(both, ["sym"], bucket(both, "tradeId", width), order, "mark_", "mark_", backwards=not opens).where("is_ = 0").drop("is_", "not_")
    bn = F.coalesce("mark_.bn", F.lit(0).cast("long")) if opens else F.col("mark_.bn")
    return out.withColumns({"bn": bn, "closed_on": F.col("mark_.day")}).drop("mark_")


def fixed(trades_ticks: DataFrame, kind: str, threshold: float) -> DataFrame:
    """Completed bars of a constant threshold; the unfinished last bar and an empty bar 0 are left out."""
    last = F.max("bn").over(Window.partitionBy("sym"))
    return ohlcv(numbered(trades_ticks, kept(marks(trades_ticks, float(threshold), kind)), opens=True)).withColumn("last", last).where("bn < last").drop("last")


def calibrate(trades_ticks: DataFrame, kind: str, target: float) -> DataFrame:
    """By symbol the state that a warm-up day gives: et, pb, ed, sigma, th, anchor, anchorprice."""
    c = trades_ticks.groupBy("sym").agg(
        F.count("*").alias("n"), div(F.count_if(F.col("bt") > 0).cast("double"), F.count("*")).alias("pb"), div(exact_sum(F.col("dvol")), F.count("*")).alias("ed"),
        F.sqrt(F.greatest(div(F.sum(F.col("sd").cast("decimal(18,4)") * F.col("sd").cast("decimal(18,4)")).cast("double"), F.count("*")) - F.pow(div(exact_sum(F.col("sd")), F.count("*")), F.lit(2.0)), F.lit(0.0))).alias("sigma"), div(exact_sum(F.col("price")), F.count("*")).alias("anchorprice"),
    ).withColumn("et", F.col("n") / F.lit(float(target)))
    th = {"dib": dib_threshold, "drb": drb_threshold}
    return c.withColumn("th", th[kind](F.col("et"), F.col("ed"), F.col("pb")) if kind in th else rw_threshold(F.col("sigma"), F.col("et"))).withColumn("anchor", F.col("th"))


def warmup(trades_ticks: DataFrame, kind: str, target: float = 200.0) -> tuple[DataFrame, DataFrame]:
    """(bars, state) of a warm-up day.  For rwdib a first pass counts the bars and corrects the
    threshold by the square root of bars over target before the second."""
    state = calibrate(trades_ticks, kind, target)
    if kind == "rwdib":
        made = _opened(marks(trades_ticks, state.select("sym", "th"), kind)).select("sym", F.col("bn").alias("made"))
        state = state.join(made, "sym").withColumn("th", F.col("th") * F.sqrt(F.greatest("made", F.lit(1)) / F.lit(float(target)))).withColumn("anchor", F.col("th")).drop("made")
    state = kept(state)
    found = kept(marks(trades_ticks, state.select("sym", "th"), kind))
    parts = ohlcv(numbered(trades_ticks, found, opens=True))
    state = state.join(_opened(found).select("sym", "bn", "theta", "tib", "bib", "dib"), "sym")
    if kind == "rwdib":
        state = state.withColumn("et", F.col("n") / F.greatest("bn", F.lit(1))).withColumns({c: F.lit(0.0) for c in ("pb", "ed")}).withColumn("bib", F.lit(0).cast("long"))
    last = state.select("sym", "et", "pb", "ed", "th", F.col("bn").alias("last"))
    return parts.join(last, "sym").where("bn < last").drop("last").withColumn("warmup", F.lit(True)), state


def _opened(found: DataFrame) -> DataFrame:
    """By symbol the bar that the scan leaves open: bn, th, theta, tib, bib, dib, et, pb, ed."""
    return found.where("not closed").groupBy("sym").agg(F.max_by(F.struct("bn", "th", "theta", "tib", "bib", "dib", "et", "pb", "ed"), "tradeId").alias("o")).select("sym", "o.*")


def adaptive(trades_ticks: DataFrame, state: DataFrame, kind: str, span: int = 20) -> DataFrame:
    """Bars with adaptive thresholds from a warm-up's state, day by day in one scan.

    The scan's state carries over midnight.  A bar belongs to the day on which it closes and holds
    that day's ticks only; one that is open at the end is not given.  et, pb and ed are those of the
    day's end (rwdib has only et), th is the threshold in force.  For rwdib the anchor of each day is
    the warm-up's, scaled by the day's mean price over the warm-up's.
    """
    return closed_bars(trades_ticks, adaptive_marks(trades_ticks, state, kind, span), kind)


def adaptive_marks(trades_ticks: DataFrame, state: DataFrame, kind: str, span: int = 20) -> DataFrame:
    """The closes of adaptive bars and what is open at the end (see kernels.bar_marks)."""
    start = state.select("sym", *(c for c in STATE if c not in ("anchor", "anchorprice")))
    if kind == "rwdib":
        prices = trades_ticks.groupBy("sym", F.unix_date(F.to_date("time")).alias("day")).agg(div(exact_sum(F.col("price")), F.count("*")).alias("mean"))
        anchors = prices.join(state.select("sym", "anchor", "anchorprice"), "sym").groupBy("sym").agg(F.map_from_entries(F.collect_list(F.struct(F.col("day").cast("string"), F.col("anchor") * div(F.col("mean"), F.col("anchorprice"))))).alias("anchors"))
        start = start.join(anchors, "sym", "left")
    return kept(marks(trades_ticks, start, kind, span))


def resumed(found: DataFrame, state: DataFrame) -> DataFrame:
    """The state from which adaptive_marks goes on after the ticks that gave ``found``: what their last bar left
    open, and the anchors of the state before.  Symbols without ticks keep theirs."""
    now = _opened(found).withColumnRenamed("sym", "sym_")
    keys = [c for c in STATE if c not in ("anchor", "anchorprice")]
    both = state.select("sym", *STATE).join(now.select("sym_", *(F.col(c).alias(f"{c}_") for c in keys)), F.col("sym") == F.col("sym_"), "left")
    return both.select("sym", *(F.coalesce(f"{c}_", c).alias(c) if c in keys else F.col(c) for c in STATE))


def save(bars: DataFrame, state: DataFrame, path: str) -> None:
    """Bars, by the date on which they end, and the state to go on from."""
    bars.withColumn("date", F.to_date("barend")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(f"{path}/bars")
    kept(state.select("sym", *STATE)).write.mode("overwrite").parquet(f"{path}/state")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(bars, state) that save() wrote."""
    return spark.read.parquet(f"{path}/bars").drop("date"), spark.read.parquet(f"{path}/state")


def closed_bars(trades_ticks: DataFrame, found: DataFrame, kind: str) -> DataFrame:
    """The bars that the marks close: of a bar its ticks of the day on which it closes."""
    ends = found.where("closed").withColumn("e", F.max_by(F.struct("et", "pb", "ed"), "bn").over(Window.partitionBy("sym", "day")))
    zero = F.lit(0.0)
    pb, ed = (zero, zero) if kind == "rwdib" else (F.col("e.pb"), F.col("e.ed"))
    ends = ends.select("sym", "bn", "th", "theta", F.col("e.et").alias("et"), pb.alias("pb"), ed.alias("ed"))
    held = numbered(trades_ticks, found, opens=False).where(F.unix_date(F.to_date("time")) == F.col("closed_on")).drop("closed_on")
    return ohlcv(held).drop("theta").join(ends, ["sym", "bn"]).withColumn("warmup", F.lit(False))


def run(trades_ticks: DataFrame, kind: str, warmup_date, first, last, target: float = 200.0, span: int = 20) -> DataFrame:
    """The warm-up day's bars and the adaptive bars of the days first .. last."""
    day = F.to_date("time")
    made, state = warmup(trades_ticks.where(day == F.lit(warmup_date).cast("date")), kind, target)
    days = adaptive(trades_ticks.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))), state, kind, span)
    return made.unionByName(days)


def clean(bars: DataFrame, per_symbol: bool = True) -> DataFrame:
    """Adaptive bars renumbered from 1, by symbol (or across all), without the threshold columns."""
    w = Window.partitionBy("sym").orderBy("bn") if per_symbol else Window.orderBy("sym", "bn")
    return bars.where(~F.col("warmup")).withColumn("bn", F.row_number().over(w).cast("long")).drop("et", "pb", "ed", "th", "warmup")


def stats(bars: DataFrame) -> DataFrame:
    """By symbol and phase: bars, average ticks and threshold, bounds of pb, first, last and largest
    threshold, and whether it exploded."""
    mean = lambda c: div(exact_sum(F.col(c)), F.count("*"))
    return bars.groupBy("sym", "warmup").agg(
        F.count("*").alias("n"), mean("ticks").alias("avgTicks"), mean("th").alias("avgTh"), F.min("pb").alias("minPb"), F.max("pb").alias("maxPb"),
        F.min_by("th", "bn").alias("th0"), F.max_by("th", "bn").alias("th1"), F.max("th").alias("thMax"), (F.max("th") > 10 * F.min_by("th", "bn")).alias("exploded"),
    )


def evolution(bars: DataFrame) -> DataFrame:
    """By symbol how the threshold went: bars, the first and the last, and the change in percent."""
    first, last = F.min_by("th", "bn"), F.max_by("th", "bn")
    return bars.groupBy("sym").agg(F.count("*").alias("n"), first.alias("th0"), last.alias("th1"), (100 * div(last - first, first)).alias("pct"))
