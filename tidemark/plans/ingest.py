"""Messages, archives, the date-partitioned store, logs and streams as registered queries.

Each writes the market views in the form that its source or sink takes (JSON messages, CSV archives, files by
date, a log) into the shared folder, takes them in again by the library's own way, and returns the rows
that came through."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..operators import bars as B
from ..operators import kernels as K
from ..operators import relational as R
from ..sources import adapters as A
from ..sources import archives, wire
from ..sources.shared import scratch
from ..streaming import pipelines, stateful
from . import queries as Q
from . import serving
from .queries import _TRADES
from .registry import SQL, query
from .research import _HEALTH, _adaptive

_MS = "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', {})"
_US = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {})"
_FIRST = "(SELECT CAST(min(time) AS DATE) FROM t)"


def _message(*fields):
    return F.to_json(F.struct(F.lit("x").alias("stream"), F.struct(*fields).alias("data"))).alias("value")


def _written(df, name):
    """Lines of text, written and read again."""
    path = scratch(df.sparkSession, name)
    df.write.text(path)
    return df.sparkSession.read.text(path)


def _trade_messages(spark, d):
    """All trades as messages; every 97th has a price that is none, every 89th is no JSON."""
    ms = F.expr(_MS.format("time"))
    price = F.when(F.col("tradeId") % 97 == 0, "x").otherwise(F.col("price").cast("string"))
    whole = _message(F.lit("trade").alias("e"), ms.alias("E"), F.col("sym").alias("s"), F.col("tradeId").alias("t"), price.alias("p"), F.col("qty").cast("string").alias("q"), (ms - 7).alias("T"), F.col("buyerIsMaker").alias("m"))
    return _written(A.trades(spark, d).select(F.when(F.col("tradeId") % 89 == 0, "{").otherwise(whole).alias("value")), "messages")


@query(f"WITH {_TRADES} SELECT sym, tradeId, price, qty, buyerIsMaker, epoch_us(time) // 1000 AS exchEventTimeMs, epoch_us(time) // 1000 - 7 AS exchTradeTimeMs FROM t WHERE tradeId % 97 <> 0 AND tradeId % 89 <> 0")
def json_trades(spark, d):
    return wire.trades(_trade_messages(spark, d))[0].drop("time")


@query(f"WITH {_TRADES}, r AS (SELECT unnest(CASE WHEN tradeId % 89 = 0 THEN ['sym', 'tradeId', 'price', 'qty', 'buyerIsMaker', 'exchTradeTimeMs'] ELSE ['price'] END) AS field FROM t WHERE tradeId % 97 = 0 OR tradeId % 89 = 0) SELECT field, count(*) AS n FROM r GROUP BY field")
def json_rejects(spark, d):
    """What the rejected messages lack, by field."""
    return wire.trades(_trade_messages(spark, d))[1].select(F.explode("missing").alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query(
    """WITH x AS (SELECT event_type AS sym, event_id AS firstId, event_id + 2 AS finalId, epoch_us(ts) // 1000 AS eventMs, value, unnest([1, 2, 3]) AS level, unnest([1, 2, 3]) AS j FROM events)
SELECT sym, firstId, finalId, eventMs, 'bid' AS side, level, value - 0.25::DOUBLE * j AS price, ((firstId + j) % 5)::DOUBLE AS qty FROM x UNION ALL SELECT sym, firstId, finalId, eventMs, 'ask', level, value + 0.25::DOUBLE * j, ((firstId + j) % 5)::DOUBLE FROM x"""
)
def json_depth(spark, d):
    """The levels of depth messages; each message also has a level that is none, which is skipped, and one
    with a third element, which is ignored."""
    e = spark.read.parquet(f"{d}/events.parquet")
    pair = lambda sign, j: F.array((F.col("value") + sign * 0.25 * j).cast("string"), ((F.col("event_id") + j) % 5).cast("string"), *([F.lit("x")] if j == 2 else []))
    side = lambda sign: F.array(pair(sign, 1), F.array(F.lit("q"), F.lit("1")), pair(sign, 2), F.array(F.lit("1")), pair(sign, 3))
    sent = e.select(_message(F.col("event_type").alias("s"), F.expr(_MS.format("ts")).alias("E"), F.col("event_id").alias("U"), (F.col("event_id") + 2).alias("u"), side(-1).alias("b"), side(1).alias("a")))
    rows = wire.depth(_written(sent, "depth"))[0]
    of = lambda name: F.transform(f"{name}s", lambda x, i: F.struct(F.lit(name).alias("side"), (i + 1).alias("level"), F.get(x, F.lit(0)).alias("price"), F.get(x, F.lit(1)).alias("qty")))
    return rows.select("sym", "firstId", "finalId", "eventMs", F.explode(F.concat(of("bid"), of("ask"))).alias("x")).select("sym", "firstId", "finalId", "eventMs", "x.*")


@query(
    f"""WITH {_TRADES} SELECT 'spot' AS kind, sym, tradeId AS id, price, qty, buyerIsMaker, epoch_us(time) AS exchTradeTimeMs FROM t
UNION ALL SELECT k, sym, tradeId, price, qty, buyerIsMaker, epoch_us(time) // 1000 FROM t, (VALUES ('agg'), ('fills')) v(k)"""
)
def csv_archives(spark, d):
    """All trades as CSV in each of the three layouts, in a folder for each symbol."""
    t, out = A.trades(spark, d), []
    ms, us, maker = F.expr(_MS.format("time")), F.expr(_US.format("time")), F.initcap(F.col("buyerIsMaker").cast("string"))
    quote = F.col("price") * F.col("qty")
    layouts = {
        "spot": [F.col("tradeId"), "price", "qty", quote.alias("quoteQty"), us.alias("t"), maker.alias("maker"), F.lit("True").alias("best")],
        "agg": [F.col("tradeId").alias("aggTradeId"), "price", "qty", F.col("tradeId").alias("firstTradeId"), F.col("tradeId").alias("lastTradeId"), ms.alias("t"), F.lower(maker).alias("maker")],
        "fills": [F.col("tradeId"), "price", "qty", quote.alias("quoteQty"), ms.alias("t"), F.lower(maker).alias("maker")],
    }
    for kind, columns in layouts.items():
        path = scratch(spark, f"csv-{kind}")
        t.select(*columns, "sym").write.option("header", kind != "spot").partitionBy("sym").csv(path)
        back = archives.read_csv(spark, path, kind)
        out.append(back.select(F.lit(kind).alias("kind"), "sym", F.col("aggTradeId" if kind == "agg" else "tradeId").alias("id"), "price", "qty", "buyerIsMaker", "exchTradeTimeMs"))
    return out[0].unionByName(out[1]).unionByName(out[2])


def _stored(spark, d) -> archives.Store:
    store = archives.Store(spark, scratch(spark, "store"))
    archives.write_dates(A.trades(spark, d), store.root, "trades", ts="time", order=("tradeId",))
    return store


@query(f"WITH {_TRADES} SELECT * FROM t WHERE CAST(time AS DATE) BETWEEN {_FIRST} + 3 AND {_FIRST} + 9 AND sym IN ('click', 'view')")
def store_load(spark, d):
    """All trades into the store, and a range of dates and two symbols out of it."""
    store = _stored(spark, d)
    first = date.fromisoformat(store.date_range("trades")[0])
    return store.load("trades", first + timedelta(days=3), first + timedelta(days=9), ["click", "view"]).drop("date")


@query(f"WITH {_TRADES} SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS date, sym, count(*) AS rows FROM t GROUP BY 1, 2")
def store_counts(spark, d):
    return _stored(spark, d).row_counts("trades", by_symbol=True).withColumn("date", F.col("date").cast("string"))


@query(f"WITH {_TRADES} SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS date, sym, count(*) AS n, true AS inOrder FROM t GROUP BY 1, 2")
def store_order(spark, d):
    """By date and symbol whether each file holds the symbol's trades in order of time and id, its symbols
    in order."""
    files = _stored(spark, d).load("trades").select("date", "sym", "time", "tradeId", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    w = Window.partitionBy("file", "at").orderBy("n")
    key = F.struct("sym", "time", "tradeId")
    follows = F.coalesce(F.lag(key).over(w) <= key, F.lit(True))
    return files.withColumn("ok", follows).groupBy(F.col("date").cast("string").alias("date"), "sym").agg(F.count("*").alias("n"), F.bool_and("ok").alias("inOrder"))


@query(f"WITH {_TRADES} SELECT time, sym, tradeId, price + CASE WHEN CAST(time AS DATE) = {_FIRST} + 1 THEN 1 ELSE 0 END AS price, qty, buyerIsMaker FROM t WHERE CAST(time AS DATE) BETWEEN {_FIRST} AND {_FIRST} + 3")
def load_dates(spark, d):
    """Four dates loaded one by one: the second is there already, with other prices, and stays; a fifth, before
    all trades, has no source and fails without stopping the rest."""
    t = A.trades(spark, d).withColumn("on", F.to_date("time"))
    store, first = archives.Store(spark, scratch(spark, "loaded")), t.agg(F.min("on")).first()[0]
    source = lambda day: t.where(F.col("on") == F.lit(day)).drop("on").withColumnRenamed("time", "exchTradeTs") if day >= first else None
    archives.load_date(store, "trades", first + timedelta(days=1), lambda day: source(day).withColumn("price", F.col("price") + 1), order=("tradeId",))
    done = archives.load_range(store, "trades", first - timedelta(days=1), first + timedelta(days=3), source, order=("tradeId",))
    if (len(done.loaded), len(done.skipped), len(done.failed)) != (3, 1, 1):
        raise RuntimeError(f"dates were not loaded as asked: {done}")
    return store.load("trades").drop("date").withColumnRenamed("exchTradeTs", "time")


@query(f"WITH {_TRADES} SELECT DISTINCT CAST(CAST(time AS DATE) AS VARCHAR) AS date, 'ok' AS state FROM t")
def log_check(spark, d):
    """The dates of a log and whether all their files can be read."""
    store = _stored(spark, d)
    return archives.logs(store, f"{store.root}/trades").select("date", "state")


@query(f"WITH {_TRADES} SELECT sym, tradeId, price, CAST(CAST(time AS DATE) AS VARCHAR) AS date FROM t")
def durable_log(spark, d):
    """All trades through a stream into a log by date, 16 files a batch; the stream is then started again and adds nothing."""
    store, log = _stored(spark, d), scratch(spark, "log")
    rows = pipelines.file_source(spark, f"{store.root}/trades", store.load("trades").schema, 16).drop("date")
    for _ in range(2):
        pipelines.durable_log(rows, f"{log}/rows", f"{log}/cp").awaitTermination()
    return spark.read.parquet(f"{log}/rows").select("sym", "tradeId", "price", F.col("date").cast("string"))


@query(f"WITH {_TRADES} SELECT sym, tradeId, row_number() OVER (ORDER BY time, tradeId) AS tpSeqNo FROM t")
def stamped_log(spark, d):
    """One sequence number over all rows of a stream."""
    path = scratch(spark, "stamped")
    pipelines.stamped_log(A.trade_stream(spark, d), path, f"{path}/cp", ("time", "tradeId")).awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("sym", "tradeId", "tpSeqNo")


@query(f"WITH {_TRADES}, u AS (SELECT 'trade' AS side, time, tradeId AS seq FROM t UNION ALL SELECT 'quote', ts, event_id FROM events), n AS (SELECT *, row_number() OVER (ORDER BY time, seq, side) AS tpSeqNo FROM u) SELECT side, max(tpSeqNo) AS tpSeqNo, max(seq) AS fhSeqNo FROM n GROUP BY side")
def recovered_sequence(spark, d):
    """What a restarted process goes on from: the last numbers of each side in the log of both; health rows pass it by."""
    path, s = scratch(spark, "sides"), A.trade_stream(spark, d)
    both = s.select("time", F.col("tradeId").alias("fhSeqNo"), F.explode(F.array(*map(F.lit, ("trade", "quote", "health")))).alias("side"))
    checked, _ = pipelines.routed(both, "side")
    pipelines.stamped_log(checked, path, f"{path}/cp", ("time", "fhSeqNo", "side")).awaitTermination()
    return pipelines.recovered_sequence(spark.read.parquet(f"{path}/rows"))


def _streamed(df, name):
    """A stream's result, written in append mode until its source is read up."""
    path = scratch(df.sparkSession, name)
    df.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.read.parquet(f"{path}/rows"), f"{path}/cp"


@query(f"WITH {_TRADES} SELECT sym, time_bucket(INTERVAL 1 HOUR, time) AS bucket, count(*) AS trades, sum(qty) AS volume, arg_max(price, tradeId) AS lastPrice FROM t GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, time) + INTERVAL 1 HOUR <= (SELECT max(time) FROM t) - INTERVAL 10 MINUTE")
def stream_windows(spark, d):
    """Windows of an hour that the watermark has closed."""
    return _streamed(pipelines.windowed_summary(A.trade_stream(spark, d), "1 hour"), "windows")[0].withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query(f"WITH {_TRADES} SELECT sym, tradeId, price FROM t")
def stream_distinct(spark, d):
    """A stream in which every third trade comes twice, each once."""
    s = A.trade_stream(spark, d)
    twice = s.withColumn("copy", F.explode(F.when(F.col("tradeId") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return _streamed(pipelines.deduplicated(twice, ["sym", "tradeId"]).select("sym", "tradeId", "price"), "distinct")[0]


@query(f"WITH {_TRADES} SELECT 'dear' AS sink, sym, tradeId FROM t WHERE price > 50 UNION ALL SELECT 'all', sym, tradeId FROM t")
def stream_fan_out(spark, d):
    """Each batch of a stream, read once, to two sinks."""
    path = scratch(spark, "sinks")
    sink = lambda name, rows: rows.select("sym", "tradeId").write.mode("append").parquet(f"{path}/sink={name}")
    sinks = {"all": lambda b, epoch: sink("all", b), "dear": lambda b, epoch: sink("dear", b.where("price > 50"))}
    pipelines.fan_out(A.trade_stream(spark, d), sinks, f"{path}-cp").awaitTermination()
    return spark.read.parquet(path)


_DAY_EMA = """s AS (SELECT *, CAST(time AS DATE) AS day, row_number() OVER (PARTITION BY sym, CAST(time AS DATE) ORDER BY tradeId) AS i FROM t),
r AS (SELECT sym, day, tradeId, i, price AS ema FROM s WHERE i = 1 UNION ALL SELECT s.sym, s.day, s.tradeId, s.i, (2.0::DOUBLE / 13) * s.price + (1 - 2.0::DOUBLE / 13) * r.ema FROM r JOIN s ON s.sym = r.sym AND s.day = r.day AND s.i = r.i + 1)"""


def _day_stream(spark, d):
    t = A.trade_stream(spark, d).select("sym", "tradeId", "price", "time")
    out = stateful.stream_days(t, ["sym"], ["tradeId"], K.ema("price", 12), "sym string, tradeId long, price double, time timestamp, ema double")
    return _streamed(out.drop("price", "time"), "days")


@query(f"WITH RECURSIVE {_TRADES}, {_DAY_EMA} SELECT sym, tradeId, ema FROM r")
def stream_days_ema(spark, d):
    """A moving average over a stream whose state begins anew each day."""
    return _day_stream(spark, d)[0]


@query(f"WITH {_TRADES} SELECT sym, CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS ticks FROM t WHERE CAST(time AS DATE) + INTERVAL 1 DAY > (SELECT max(time) FROM t) - INTERVAL 10 MINUTE GROUP BY 1, 2")
def stream_state(spark, d):
    """What the state store holds after the stream: the days that the watermark has not passed."""
    return stateful.day_states(spark, _day_stream(spark, d)[1]).select("sym", F.col("day").cast("string"), "ticks")


@query(f"WITH {_TRADES} SELECT CASE WHEN CAST(time AS DATE) < {_FIRST} + 3 THEN 'store' ELSE 'spool' END AS place, sym, tradeId FROM t")
def end_of_day(spark, d):
    """A spool of all days; those before the fourth are orphans and move to the store."""
    root = scratch(spark, "eod")
    store, spool = archives.Store(spark, f"{root}/store"), archives.Store(spark, f"{root}/spool")
    archives.write_dates(A.trades(spark, d).withColumn("tpSeqNo", F.col("tradeId")), spool.root, "trades", ts="time", order=("tradeId",))
    archives.recover_orphans(store, spool.root, "trades", spool.dates("trades")[3])
    return store.load("trades").select(F.lit("store").alias("place"), "sym", "tradeId").unionByName(spool.load("trades").select(F.lit("spool").alias("place"), "sym", "tradeId"))


@query(f"WITH {_TRADES} SELECT * FROM t WHERE time >= (SELECT max(time) FROM t) - INTERVAL 2880 MINUTE")
def retention(spark, d):
    """What is left of the store when all older than two days before the last trade is deleted."""
    store = _stored(spark, d)
    archives.retain(store, "trades", store.load("trades").agg(F.max("time")).first()[0], 2880)
    return store.load("trades").drop("date")


@query(
    """WITH x AS (SELECT o_orderkey AS id, (o_orderkey * 37) % 90000 AS s, (o_orderkey * o_custkey) % 3000000 AS n FROM orders),
y AS (SELECT *, floor((n + 5000) / 10000)::BIGINT AS m, floor((n + 50) / 100)::BIGINT AS k FROM x)
SELECT id, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS duration,
 CASE WHEN s < 60 THEN s || 's ago' WHEN s < 3600 THEN (s // 60) || 'm ago' ELSE (s // 3600) || 'h ago' END AS ago,
 CASE WHEN n >= 1000000 THEN (m // 100) || '.' || lpad((m % 100)::VARCHAR, 2, '0') || 'M' WHEN n >= 1000 THEN (k // 10) || '.' || (k % 10) || 'K' ELSE n::VARCHAR END AS count FROM y"""
)
def formatted(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    s, n = (F.col("o_orderkey") * 37) % 90000, (F.col("o_orderkey") * F.col("o_custkey")) % 3_000_000
    return o.select(F.col("o_orderkey").alias("id"), S.format_duration(s).alias("duration"), S.format_ago(s).alias("ago"), S.format_count(n).alias("count"))


@query(f"WITH RECURSIVE {_adaptive('rwdib')} SELECT sym, bn, barstart, barend, close, dqty, ticks, theta, th FROM ab")
def resumed_bars(spark, d):
    """Adaptive bars with a break: the state is saved and loaded after the warm-up."""
    first, rest = Q.halves(B.ticks(A.trades(spark, d)))
    path = scratch(spark, "bars")
    B.save(*B.warmup(first, "rwdib", 60.0), path)
    return B.adaptive(rest, B.load(spark, path)[1], "rwdib").select("sym", "bn", "barstart", "barend", "close", "dqty", "ticks", "theta", "th")


@query(
    f"""WITH {_HEALTH}, z AS (SELECT handler, uptimeSec AS u, msgsPublished AS n, floor(msgsPublished / uptimeSec::DOUBLE + 0.5)::BIGINT AS r, (floor(epoch((SELECT max(ts) FROM events))) - floor(epoch(lastMsgTimeUtc)))::BIGINT AS s FROM hl QUALIFY row_number() OVER (PARTITION BY handler ORDER BY time DESC) = 1),
y AS (SELECT *, floor((n + 5000) / 10000)::BIGINT AS m, floor((n + 50) / 100)::BIGINT AS k FROM z)
SELECT handler AS Handler, 'connected' AS State, CASE WHEN u >= 3600 THEN (u // 3600) || 'h ' || (u % 3600 // 60) || 'm' WHEN u >= 60 THEN (u // 60) || 'm ' || (u % 60) || 's' ELSE u || 's' END AS Uptime, r AS MsgsSec,
 CASE WHEN n >= 1000000 THEN (m // 100) || '.' || lpad((m % 100)::VARCHAR, 2, '0') || 'M' WHEN n >= 1000 THEN (k // 10) || '.' || (k % 10) || 'K' ELSE n::VARCHAR END AS Published,
 CASE WHEN s < 60 THEN s || 's ago' WHEN s < 3600 THEN (s // 60) || 'm ago' ELSE (s // 3600) || 'h ago' END AS LastMsg FROM y"""
)
def handler_view(spark, d):
    h = A.health(spark, d).withColumn("connState", F.lit("connected"))
    return serving.handler_view(R.handler_status(h, h.agg(F.max("time")).scalar().cast("timestamp")))


@query(f"SELECT sym AS Sym, parseP50 AS ParseP50, parseP95 AS ParseP95, sendP50 AS SendP50, sendP95 AS SendP95 FROM ({SQL['latency_percentiles']}) QUALIFY row_number() OVER (PARTITION BY sym ORDER BY bucket DESC) = 1")
def latency_view(spark, d):
    return serving.latency_view(R.latency_percentiles(A.trades(spark, d), "qty", "price", "1 day"))
