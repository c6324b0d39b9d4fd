"""Summaries, last-N, range queries and joins over trades, quotes and positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import div, exact_sum, nearest_ranks, round_half
from .carry import bucket, carried, running_sums


def trade_summary(trades: DataFrame, order: str = "tradeId") -> DataFrame:
    return trades.groupBy("sym").agg(
        F.count("*").alias("trades"), exact_sum(F.col("qty")).alias("volume"), exact_sum(F.col("price") * F.col("qty")).alias("dollarVol"),
        F.min("price").alias("minPrice"), F.max("price").alias("maxPrice"), F.max_by("price", order).alias("lastPrice"), F.min("time").alias("firstTime"), F.max("time").alias("lastTime"),
    )


def quote_summary(quotes: DataFrame, order: str = "fhSeqNo", valid_only: bool = False) -> DataFrame:
    """avgSpread is over all rows, invalid ones too, unless valid_only."""
    q = quotes.where("isValid") if valid_only else quotes
    return q.groupBy("sym").agg(
        F.count("*").alias("quotes"), F.count_if("isValid").alias("valid"), F.count_if(~F.col("isValid")).alias("invalid"),
        (exact_sum(F.col("askPrice1") - F.col("bidPrice1")) / F.count("*")).alias("avgSpread"), F.max_by("bidPrice1", order).alias("lastBid"), F.max_by("askPrice1", order).alias("lastAsk"), F.min("time").alias("firstTime"), F.max("time").alias("lastTime"),
    )


def last_n(df: DataFrame, n: int, order: str, by: str | None = "sym") -> DataFrame:
    """The last n rows of each ``by``, or of all: the latest, never the oldest n of a descending sort."""
    if by is None:
        return df.orderBy(F.desc(order)).limit(n)
    w = Window.partitionBy(by).orderBy(F.desc(order))
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")


def in_range(df: DataFrame, lo, hi, sym: str | None = None, column: str = "time") -> DataFrame:
    """lo <= column <= hi; a null or empty symbol stands for all."""
    out = df.where(F.col(column).between(F.lit(lo).cast(df.schema[column].dataType), F.lit(hi).cast(df.schema[column].dataType)))
    return out.where(F.col("sym") == sym) if sym else out


def on_days(df: DataFrame, first, last, column: str = "time") -> DataFrame:
    """The half-open range from the start of the first day to the end of the last: column >= first and < last + 1 day."""
    kind = df.schema[column].dataType
    at = lambda d, days: (F.lit(d).cast("date") + F.expr(f"interval {days} days")).cast(kind)
    return df.where((F.col(column) >= at(first, 0)) & (F.col(column) < at(last, 1)))


def since(df: DataFrame, now, minutes: float, column: str = "time") -> DataFrame:
    """column > now - minutes; now is given, so results can be repeated."""
    return df.where(F.col(column) > F.lit(now).cast(df.schema[column].dataType) - F.make_dt_interval(mins=F.lit(minutes).cast("int")))


def vwap(trades: DataFrame, order: str = "tradeId") -> DataFrame:
    notional, volume = exact_sum(F.col("price") * F.col("qty")), exact_sum(F.col("qty"))
    return trades.groupBy("sym").agg(div(notional, volume).alias("vwap"), F.max_by("price", order).alias("lastPrice"), volume.alias("volume"), F.count("*").alias("trades"))


def vwap_running(trades: DataFrame, order: str = "tradeId", by: tuple[str, ...] = ("sym",), width: int | None = None) -> DataFrame:
    """The volume-weighted price up to each trade; by (sym, date) it starts anew each day.  A symbol is
    dealt to buckets of ``width`` of the order column."""
    exact = lambda c: c.cast("decimal(28,6)")
    sums = {"notional_": exact(F.col("price") * F.col("qty")), "volume_": exact(F.col("qty"))}
    out = running_sums(trades, list(by), bucket(trades, order, width), [order], sums)
    return out.withColumn("vwap", div(*(F.col(c).cast("double") for c in sums))).drop(*sums)


def price_series(trades: DataFrame, interval: str, order: str = "tradeId") -> DataFrame:
    """The last price of each symbol and interval."""
    return trades.groupBy("sym", F.window("time", interval).start.alias("bucket")).agg(F.max_by("price", order).alias("price"))


def latency_percentiles(rows: DataFrame, parse: str, send: str, interval: str, by: tuple[str, ...] = ("sym",)) -> DataFrame:
    """Nearest-rank p50 and p95 and the maximum of two latency columns by event-time bucket."""
    at = rows.withColumn("bucket", F.window("time", interval).start)
    return nearest_ranks(at, (*by, "bucket"), {"parse": parse, "send": send}, {"P50": 0.5, "P95": 0.95})


def last_row(df: DataFrame, by: tuple[str, ...], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*by, "r.*")


def handler_status(health: DataFrame, now: Column) -> DataFrame:
    """The latest health row of each handler with its average rate and idle seconds."""
    last = last_row(health, ("handler",), "time")
    return last.withColumn("avgRate", round_half(div(F.col("msgsPublished").cast("double"), F.col("uptimeSec")))).withColumn("lastActivitySec", F.unix_timestamp(now) - F.unix_timestamp("lastMsgTimeUtc"))


def summary_join(vwaps: DataFrame, vols: DataFrame) -> DataFrame:
    return vwaps.join(vols, "sym", "left")


def asof(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, value: str, order: str, width: int | None = None) -> DataFrame:
    """left with the last right value at or before its time, null before the first.

    Both sides are interleaved and the value carried forward within buckets of ``width`` seconds and
    from bucket to bucket: a sort-merge of their sizes, with no nested loop and no task for a whole key.
    """
    cols = left.columns
    a = left.select(F.struct(*cols).alias("row"), F.col(on).alias("k"), F.col(left_time).alias("t"), F.lit(1).alias("kind"), F.lit(None).cast(right.schema[order].dataType).alias("o"), F.lit(None).cast(right.schema[value].dataType).alias("v"))
    b = right.select(F.lit(None).cast(a.schema["row"].dataType).alias("row"), F.col(on).alias("k"), F.col(right_time).alias("t"), F.lit(0).alias("kind"), F.col(order).alias("o"), F.col(value).alias("v"))
    both = a.unionByName(b)
    return carried(both, ["k"], bucket(both, "t", width), ["t", "kind", "o"], "v", value).where("kind = 1").select("row.*", value)


def events_between(trades: DataFrame, events: DataFrame, event_time: str, order: str = "tradeId", width: int | None = None) -> DataFrame:
    """Each event with the first trade of its symbol at or after it: the events in (previous trade,
    trade].  Both sides are interleaved and the trade carried backwards, as in asof()."""
    a = trades.select(F.col("sym"), F.col("time").alias("t"), F.lit(1).alias("kind"), F.col(order).alias("o"), F.lit(None).cast(_struct(events)).alias("event"))
    b = events.select("sym", F.col(event_time).alias("t"), F.lit(0).alias("kind"), F.lit(None).cast(trades.schema[order].dataType).alias("o"), F.struct(*events.columns).alias("event"))
    both = a.unionByName(b)
    return carried(both, ["sym"], bucket(both, "t", width), ["t", "kind", "o"], "o", "next_", backwards=True).where("kind = 0 and next_ is not null").select("event.*", F.col("next_").alias(order))


def _struct(df: DataFrame):
    return df.select(F.struct(*df.columns).alias("s")).schema["s"].dataType


def keep_latest(df: DataFrame, key: tuple[str, ...], order: str) -> DataFrame:
    """Keyed upsert of a log: the row of the greatest order for each key."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def merge_replay(replayed: DataFrame, live: DataFrame, cutoff: int, order: str = "tpSeqNo") -> DataFrame:
    """Replayed rows up to the cutoff and live rows after it, each sequence number once."""
    return replayed.where(F.col(order) <= cutoff).unionByName(live.where(F.col(order) > cutoff)).dropDuplicates([order])


def pnl(positions: DataFrame, prices: DataFrame) -> DataFrame:
    """positions with lastPrice and pnl = side (last - traded) qty; null without a price."""
    out = positions.join(prices, "sym", "left")
    return out.withColumn("pnl", F.col("side") * (F.col("lastPrice") - F.col("tradedPrice")) * F.col("qty"))


def pnl_by_symbol(positions: DataFrame, prices: DataFrame) -> DataFrame:
    return pnl(positions, prices).groupBy("sym").agg(F.count("*").alias("positions"), exact_sum(F.coalesce("pnl", F.lit(0.0))).alias("pnl"))


def range_stats(history: DataFrame, value: str) -> DataFrame:
    v = F.col(value)
    return history.agg(div(exact_sum(v), F.count(v)).alias("avg"), F.min(v).alias("min"), F.max(v).alias("max"), (F.max(v) - F.min(v)).alias("range"))


def spread_mid(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("spread", F.col("askPrice1") - F.col("bidPrice1")).withColumn("mid", 0.5 * (F.col("bidPrice1") + F.col("askPrice1")))


def rank_extremes(scores: DataFrame, value: str) -> DataFrame:
    """+1 for the highest, -1 for the lowest, 0 between; ties go by symbol."""
    w = Window.orderBy(F.desc(value), "sym")
    out = scores.withColumn("rank", F.row_number().over(w)).withColumn("of", F.count("*").over(Window.partitionBy()))
    return out.withColumn("exposure", F.when(F.col("rank") == 1, 1).when(F.col("rank") == F.col("of"), -1).otherwise(0)).drop("rank", "of")


def id_gaps(rows: DataFrame, id_column: str, order: str) -> DataFrame:
    """What the id validator logs (nothing is dropped): each row's kind against the row before it."""
    prev = F.lag(id_column).over(Window.partitionBy("sym").orderBy(order))
    kind = F.when(prev.isNull(), "first").when(F.col(id_column) == prev, "duplicate").when(F.col(id_column) < prev, "out_of_order").when(F.col(id_column) > prev + 1, "gap").otherwise("ok")
    return rows.withColumn("idCheck", kind)


def row_counts(rows: DataFrame, dates: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows by date (and by further columns); dates without rows count 0 if a list of dates is given."""
    counts = rows.groupBy("date", *by).agg(F.count("*").alias("rows"))
    return counts if dates is None else dates.join(counts, "date", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


def retained(df: DataFrame, now, minutes: float, column: str = "time") -> DataFrame:
    """What a retention of that many minutes leaves of a table: rows not before the cutoff.  Stored
    tables drop whole dates instead (sources.archives.clean_logs)."""
    kind = df.schema[column].dataType
    return df.where(F.col(column) >= F.lit(now).cast(kind) - F.make_dt_interval(mins=F.lit(minutes).cast("int")))


def stamped(order: tuple[str, ...], **tables: DataFrame) -> DataFrame:
    """The rows of several tables under one global sequence number tpSeqNo, from 1 in the given
    order (its first column a time): side (the table's name), the order columns, tpSeqNo.  Rows are
    numbered by minute and the minutes' counts run through, so no task sees all rows.  Health rows
    do not belong here."""
    rows = None
    for name, t in tables.items():
        part = t.select(F.lit(name).alias("side"), *order)
        rows = part if rows is None else rows.unionByName(part)
    numbered = rows.withColumn("minute", F.date_trunc("minute", order[0]))
    before = numbered.groupBy("minute").agg(F.count("*").alias("n"))
    before = before.select(F.col("minute").alias("of"), (F.sum("n").over(Window.orderBy("minute")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("minute").orderBy(*order, "side"))
    return numbered.withColumn("nth", within).join(before, F.col("minute").eqNullSafe(F.col("of"))).select("side", *order, (F.col("before") + F.col("nth")).alias("tpSeqNo"))


def unsubscribed(symbols: DataFrame, subscribed: DataFrame) -> DataFrame:
    """Set difference: symbols (one column) that are not subscribed."""
    return symbols.distinct().exceptAll(subscribed.distinct())


def online_bar_stats(online: DataFrame, kind: str) -> DataFrame:
    """By symbol of online imbalance (dib) or run (drb) bars: bars, average ticks and dollars, and of
    dib the average duration in seconds and share bought, of drb the bars by direction."""
    mean = lambda c: div(exact_sum(c), F.count("*"))
    micros = F.unix_micros(F.col("barend").cast("timestamp")) - F.unix_micros(F.col("barstart").cast("timestamp"))
    more = {"dib": [(mean(micros) / 1e6).alias("avgDurationSec"), mean(F.col("buyPct")).alias("avgBuyPct")], "drb": [F.count_if(F.col("direction") == 1).alias("buyRuns"), F.count_if(F.col("direction") == -1).alias("sellRuns")]}[kind]
    return online.where(F.col("kind") == kind).groupBy("sym").agg(F.count("*").alias("bars"), mean(F.col("ticks")).alias("avgTicks"), mean(F.col("dollars")).alias("avgDollarVol"), *more)


def bars_per_day(bars: DataFrame) -> DataFrame:
    return bars.groupBy("sym", F.to_date("barend").cast("string").alias("date")).agg(F.count("*").alias("n"), div(F.sum("ticks").cast("double"), F.count("*")).alias("avgTicks"))


def position_flips(online: DataFrame) -> DataFrame:
    """Of online bars (sym, bn, barend, position, ...) those at which the position changes; it starts at 0."""
    before = F.coalesce(F.lag("position").over(Window.partitionBy("sym").orderBy("bn")), F.lit(0))
    return online.withColumn("before", before).where("position <> before").select(F.col("barend").alias("time"), "sym", "bn", "position", F.col("close").alias("price"), "buyPct", "dollars", "ticks")


def position_stats(flips: DataFrame) -> DataFrame:
    return flips.groupBy("sym").agg(
        F.count("*").alias("changes"), F.count_if(F.col("position") == 1).alias("longs"), F.count_if(F.col("position") == -1).alias("shorts"),
        F.max_by("position", "bn").alias("lastPosition"), F.max_by("price", "bn").alias("lastPrice"), F.max_by("time", "bn").alias("lastTime"),
    )


def distinct_symbols(*tables: DataFrame) -> DataFrame:
    out = tables[0].select("sym")
    for t in tables[1:]:
        out = out.union(t.select("sym"))
    return out.distinct()


def drop_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)
