"""Registered queries over the driver's tables and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import features as X
from ..operators import kernels as K
from ..operators import relational as R
from ..operators.scan import ordered_scan
from ..operators.signals import rsi_signal
from ..sources import adapters as A
from .registry import query

# Views that the SQL of several queries begins with.
_TRADES = """t AS (SELECT ts AS time, event_type AS sym, event_id AS tradeId, value AS price, (k + 1)::DOUBLE AS qty, k % 2 = 1 AS buyerIsMaker
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events))"""
_QUOTES = "q AS (SELECT ts AS time, event_type AS sym, event_id AS fhSeqNo, value - 0.01::DOUBLE * 1 AS bidPrice1, value + 0.01::DOUBLE * 1 AS askPrice1, event_id % 50 <> 0 AS isValid FROM events)"
_DEC = "DECIMAL(28,6)"
_POSITIONS = "p AS (SELECT o_orderkey AS id, o_orderdate AS time, ['click', 'purchase', 'signup', 'view', 'other'][o_orderkey % 5 + 1] AS sym, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END AS side, (1 + o_custkey % 10)::DOUBLE AS qty, o_totalprice AS tradedPrice FROM orders)"
#: Dollar-imbalance bars of the constant threshold 20,000, as a recursive scan.
_DIB = f"""{_TRADES}, s AS (SELECT *, price * qty AS dvol, CASE WHEN buyerIsMaker THEN -1 ELSE 1 END AS bt, row_number() OVER (PARTITION BY sym ORDER BY tradeId) AS i FROM t WHERE price * qty >= 50),
r AS (SELECT sym, i, CASE WHEN abs(bt * dvol) >= 20000 THEN 0.0::DOUBLE ELSE bt * dvol END AS theta, CASE WHEN abs(bt * dvol) >= 20000 THEN 1 ELSE 0 END::BIGINT AS bn FROM s WHERE i = 1
  UNION ALL SELECT s.sym, s.i, CASE WHEN abs(r.theta + s.bt * s.dvol) >= 20000 THEN 0.0::DOUBLE ELSE r.theta + s.bt * s.dvol END, r.bn + CASE WHEN abs(r.theta + s.bt * s.dvol) >= 20000 THEN 1 ELSE 0 END
  FROM r JOIN s ON s.sym = r.sym AND s.i = r.i + 1),
n AS (SELECT s.*, r.bn FROM s JOIN r ON s.sym = r.sym AND s.i = r.i),
b AS (SELECT sym, bn, min(time) AS barstart, max(time) AS barend, arg_min(price, tradeId) AS open, max(price) AS high, min(price) AS low, arg_max(price, tradeId) AS close, sum(qty) AS qty, sum(dvol::{_DEC})::DOUBLE AS dqty, count(*) AS ticks, count(*) FILTER (WHERE bt > 0) AS buys,
  coalesce(sum(qty) FILTER (WHERE bt > 0), 0) AS bqty, coalesce(sum(qty) FILTER (WHERE bt < 0), 0) AS sqty, sum(dvol::{_DEC})::DOUBLE / sum(qty) AS vwap, sum((bt * dvol)::{_DEC})::DOUBLE AS theta FROM n GROUP BY sym, bn),
bars AS (SELECT * FROM b QUALIFY bn < max(bn) OVER (PARTITION BY sym))"""


@query(f"WITH RECURSIVE {_TRADES} SELECT sym, count(*) AS trades, sum(qty) AS volume, sum((price * qty)::{_DEC})::DOUBLE AS dollarVol, min(price) AS minPrice, max(price) AS maxPrice, arg_max(price, tradeId) AS lastPrice, min(time) AS firstTime, max(time) AS lastTime FROM t GROUP BY sym")
def trade_summary(spark, d):
    return R.trade_summary(A.trades(spark, d))


@query(f"WITH {_QUOTES} SELECT sym, count(*) AS quotes, count(*) FILTER (WHERE isValid) AS valid, count(*) FILTER (WHERE NOT isValid) AS invalid, sum((askPrice1 - bidPrice1)::{_DEC})::DOUBLE / count(*) AS avgSpread, arg_max(bidPrice1, fhSeqNo) AS lastBid, arg_max(askPrice1, fhSeqNo) AS lastAsk, min(time) AS firstTime, max(time) AS lastTime FROM q GROUP BY sym")
def quote_summary(spark, d):
    return R.quote_summary(A.quotes(spark, d))


@query(f"WITH {_TRADES} SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY sym ORDER BY tradeId DESC) <= 20")
def last_n_trades(spark, d):
    return R.last_n(A.trades(spark, d), 20, "tradeId")


@query(f"WITH {_TRADES}, b AS (SELECT min(time) + INTERVAL 3 DAY AS lo, min(time) + INTERVAL 7 DAY AS hi FROM t) SELECT t.* FROM t, b WHERE time BETWEEN lo AND hi AND sym = 'click'")
def trade_range(spark, d):
    t = A.trades(spark, d)
    after = lambda days: t.agg(F.expr(f"min(time) + interval {days} days")).scalar()
    return R.in_range(t, after(3), after(7), "click")


@query(f"WITH {_TRADES} SELECT * FROM t WHERE time > (SELECT max(time) FROM t) - INTERVAL 2880 MINUTE")
def trades_since(spark, d):
    t = A.trades(spark, d)
    return R.since(t, t.agg(F.max("time")).scalar(), 2880)


@query(f"WITH {_TRADES} SELECT sym, sum((price * qty)::{_DEC})::DOUBLE / sum(qty) AS vwap, arg_max(price, tradeId) AS lastPrice, sum(qty) AS volume, count(*) AS trades FROM t GROUP BY sym")
def vwap(spark, d):
    return R.vwap(A.trades(spark, d))


@query(f"WITH {_TRADES} SELECT sym, tradeId, sum((price * qty)::{_DEC}) OVER w::DOUBLE / sum(qty) OVER w AS vwap FROM t WINDOW w AS (PARTITION BY sym ORDER BY tradeId ROWS UNBOUNDED PRECEDING)")
def vwap_running(spark, d):
    return R.vwap_running(A.trades(spark, d)).select("sym", "tradeId", "vwap")


@query(f"WITH {_TRADES}, v AS (SELECT sym, sum((price * qty)::{_DEC})::DOUBLE / sum(qty) AS vwap, arg_max(price, tradeId) AS lastPrice, sum(qty) AS volume, count(*) AS trades FROM t GROUP BY sym) SELECT v.*, c.valid AS quotes FROM v LEFT JOIN (SELECT event_type AS sym, count(*) AS valid FROM events WHERE event_id % 50 <> 0 AND event_type <> 'view' GROUP BY 1) c ON v.sym = c.sym")
def summary_join(spark, d):
    valid = A.quotes(spark, d).where("isValid and sym <> 'view'").groupBy("sym").agg(F.count("*").alias("quotes"))
    return R.summary_join(R.vwap(A.trades(spark, d)), valid)


@query(f"WITH {_TRADES} SELECT sym, time_bucket(INTERVAL 1 DAY, time) AS bucket, arg_max(price, tradeId) AS price FROM t GROUP BY 1, 2")
def price_series(spark, d):
    return R.price_series(A.trades(spark, d), "1 day")


@query(f"WITH {_TRADES}, g AS (SELECT sym, time_bucket(INTERVAL 1 DAY, time) AS bucket, list_sort(list(qty)) AS a, list_sort(list(price)) AS b, count(*) AS cnt FROM t GROUP BY 1, 2) SELECT sym, bucket, a[floor(0.5 * (cnt - 1) + 0.5)::INT + 1] AS parseP50, a[floor(0.95::DOUBLE * (cnt - 1) + 0.5)::INT + 1] AS parseP95, a[-1] AS parseMax, b[floor(0.5 * (cnt - 1) + 0.5)::INT + 1] AS sendP50, b[floor(0.95::DOUBLE * (cnt - 1) + 0.5)::INT + 1] AS sendP95, b[-1] AS sendMax, cnt FROM g")
def latency_percentiles(spark, d):
    return R.latency_percentiles(A.trades(spark, d), "qty", "price", "1 day")


@query(f"WITH {_TRADES} SELECT sym, buyerIsMaker, arg_max(time, tradeId) AS time, max(tradeId) AS tradeId, arg_max(price, tradeId) AS price, arg_max(qty, tradeId) AS qty FROM t GROUP BY 1, 2")
def last_row_per_key(spark, d):
    return R.last_row(A.trades(spark, d), ("sym", "buyerIsMaker"), "tradeId")


@query(f"WITH {_QUOTES} SELECT sym, fhSeqNo, askPrice1 - bidPrice1 AS spread, 0.5::DOUBLE * (bidPrice1 + askPrice1) AS mid FROM q")
def spread_mid(spark, d):
    return R.spread_mid(A.quotes(spark, d)).select("sym", "fhSeqNo", "spread", "mid")


@query(f"WITH {_TRADES}, g AS (SELECT *, lag(tradeId) OVER (PARTITION BY sym ORDER BY time) AS prev FROM t) SELECT sym, tradeId, CASE WHEN prev IS NULL THEN 'first' WHEN tradeId = prev THEN 'duplicate' WHEN tradeId < prev THEN 'out_of_order' WHEN tradeId > prev + 1 THEN 'gap' ELSE 'ok' END AS idCheck FROM g")
def id_gaps(spark, d):
    return R.id_gaps(A.trades(spark, d), "tradeId", "time").select("sym", "tradeId", "idCheck")


@query(f"WITH {_TRADES}, {_POSITIONS}, l AS (SELECT sym, arg_max(price, tradeId) AS lastPrice FROM t GROUP BY sym) SELECT p.id, p.sym, lastPrice, side * (lastPrice - tradedPrice) * qty AS pnl FROM p LEFT JOIN l ON p.sym = l.sym")
def pnl_by_position(spark, d):
    return R.pnl(A.positions(spark, d), R.vwap(A.trades(spark, d)).select("sym", "lastPrice")).select("id", "sym", "lastPrice", "pnl")


@query(f"WITH {_TRADES}, {_POSITIONS}, l AS (SELECT sym, arg_max(price, tradeId) AS lastPrice FROM t GROUP BY sym) SELECT p.sym, count(*) AS positions, sum(coalesce(side * (lastPrice - tradedPrice) * qty, 0)::{_DEC})::DOUBLE AS pnl FROM p LEFT JOIN l ON p.sym = l.sym GROUP BY p.sym")
def pnl_by_symbol(spark, d):
    return R.pnl_by_symbol(A.positions(spark, d), R.vwap(A.trades(spark, d)).select("sym", "lastPrice"))


@query(f"WITH {_TRADES} SELECT (sum(price::{_DEC})::DOUBLE / count(*)) AS avg, min(price) AS min, max(price) AS max, max(price) - min(price) AS range FROM t")
def price_stats(spark, d):
    return R.range_stats(A.trades(spark, d), "price")


@query(f"WITH {_TRADES} SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS date, sym, count(*) AS rows FROM t GROUP BY 1, 2")
def row_counts(spark, d):
    return R.row_counts(A.trades(spark, d).withColumn("date", F.to_date("time").cast("string")), by=("sym",))


_FUNDING = """span AS (SELECT sym, date_trunc('day', min(time)) AS lo, max(time) AS hi FROM t GROUP BY sym),
f AS (SELECT sym, unnest(generate_series(lo, hi, INTERVAL 8 HOUR)) AS fundingTime FROM span), fr AS (SELECT sym, fundingTime, ((hour(fundingTime) + length(sym)) % 7 - 3) / 10000.0::DOUBLE AS fundingRate FROM f)"""


@query(f"WITH {_TRADES}, {_FUNDING} SELECT fr.*, t.price FROM fr ASOF LEFT JOIN t ON fr.sym = t.sym AND fr.fundingTime >= t.time")
def asof_price(spark, d):
    return R.asof(A.funding(spark, d), A.trades(spark, d), "sym", "fundingTime", "time", "price", "tradeId")


@query(f"WITH {_TRADES}, {_FUNDING}, g AS (SELECT *, lag(time) OVER (PARTITION BY sym ORDER BY tradeId) AS prev FROM t) SELECT fr.*, g.tradeId FROM fr JOIN g ON fr.sym = g.sym AND fr.fundingTime <= g.time AND (g.prev IS NULL OR fr.fundingTime > g.prev)")
def funding_range(spark, d):
    return R.events_between(A.trades(spark, d), A.funding(spark, d), "fundingTime")


@query(f"WITH {_POSITIONS} SELECT sym, qty, id, side FROM p QUALIFY row_number() OVER (PARTITION BY sym, qty ORDER BY id DESC) = 1")
def keyed_upsert(spark, d):
    return R.keep_latest(A.positions(spark, d), ("sym", "qty"), "id").select("sym", "qty", "id", "side")


@query(f"WITH {_TRADES} SELECT * FROM t WHERE tradeId <= 5000 UNION ALL SELECT * FROM t WHERE tradeId > 5000")
def merge_replay(spark, d):
    """The live half holds rows of the replayed one, and every third of its rows twice."""
    t = A.trades(spark, d)
    live = t.where("tradeId >= 4000")
    return R.merge_replay(t.where("tradeId <= 6000"), live.unionByName(live.where("tradeId % 3 = 0")), 5000, "tradeId")


@query(f"WITH {_TRADES}, {_POSITIONS} SELECT sym FROM t UNION SELECT sym FROM p")
def distinct_symbols(spark, d):
    return R.distinct_symbols(A.trades(spark, d), A.positions(spark, d))


@query(f"WITH {_TRADES} SELECT sym, tradeId, price * qty AS notional FROM t WHERE price * qty >= 50 AND sym IN ('click', 'view')")
def subscription_filter(spark, d):
    from ..streaming.subscribe import Subscription

    return Subscription(where="price * qty >= 50 and sym in ('click', 'view')", columns=["sym", "tradeId", "price * qty as notional"]).apply(A.trades(spark, d))


def fixed_dib(spark, d):
    return B.fixed(B.ticks(A.trades(spark, d)), "dib", 20_000.0)


@query(f"WITH RECURSIVE {_DIB} SELECT * FROM bars")
def bars_dib_fixed(spark, d):
    return fixed_dib(spark, d)


@query(
    f"""WITH RECURSIVE {_DIB}, x AS (SELECT *, lag(close) OVER w AS prev, lag(close, 10) OVER w AS prev10, avg(close) OVER (w ROWS 9 PRECEDING) AS unused FROM bars WINDOW w AS (PARTITION BY sym ORDER BY bn))
SELECT sym, bn, barstart, close, CASE WHEN prev10 IS NULL THEN NULL ELSE close / prev10 END AS momentum, (high - low) / low AS hlRange, (bqty - sqty) / (bqty + sqty) AS tradeImbalance,
 floor((epoch_us(barend) - epoch_us(barstart)) / 1e6 + 0.5)::BIGINT AS duration, ticks / greatest(1, floor((epoch_us(barend) - epoch_us(barstart)) / 1e6 + 0.5)::BIGINT)::DOUBLE AS tradeIntensity,
 CASE WHEN high = low THEN 0.5 ELSE (close - low) / (high - low) END::DOUBLE AS closePosition, theta / dqty AS thetaNorm, bqty / (bqty + sqty) AS buyPct FROM x"""
)
def features_exact(spark, d):
    return X.build(fixed_dib(spark, d), ["momentum", "hlRange", "tradeImbalance", "duration", "tradeIntensity", "closePosition", "thetaNorm", "buyPct"])


@query()
def features_windowed(spark, d):
    """The features with logarithms or means over several rows."""
    names = ["logReturn", "meanReversion", "realizedVol", "parkinson", "vpin"]
    return _rounded(X.build(fixed_dib(spark, d), names), *names)


@query(
    f"""WITH RECURSIVE {_TRADES}, s AS (SELECT *, row_number() OVER (PARTITION BY sym ORDER BY tradeId) AS i FROM t),
r AS (SELECT sym, tradeId, i, price AS ema FROM s WHERE i = 1 UNION ALL SELECT s.sym, s.tradeId, s.i, (2.0::DOUBLE / 13) * s.price + (1 - 2.0::DOUBLE / 13) * r.ema FROM r JOIN s ON s.sym = r.sym AND s.i = r.i + 1)
SELECT sym, tradeId, ema FROM r"""
)
def ema(spark, d):
    return ordered_scan(A.trades(spark, d).select("sym", "tradeId", "price"), ["sym"], ["tradeId"], K.ema("price", 12), "sym string, tradeId long, price double, ema double").drop("price")


@query(
    f"""WITH RECURSIVE {_DIB}, z AS (SELECT *, row_number() OVER (PARTITION BY sym ORDER BY bn) AS i FROM bars),
e AS (SELECT sym, bn, i, close AS f, close AS w, 0.0::DOUBLE AS g FROM z WHERE i = 1 UNION ALL
  SELECT sym, bn, i, f, w, (2.0::DOUBLE / 10) * (f - w) + (1 - 2.0::DOUBLE / 10) * g FROM (SELECT z.sym, z.bn, z.i, (2.0::DOUBLE / 13) * z.close + (1 - 2.0::DOUBLE / 13) * e.f AS f, (2.0::DOUBLE / 27) * z.close + (1 - 2.0::DOUBLE / 27) * e.w AS w, e.g FROM e JOIN z ON z.sym = e.sym AND z.i = e.i + 1))
SELECT sym, bn, f - w AS macd, g AS macdSignal, (f - w) - g AS macdHist FROM e"""
)
def macd(spark, d):
    return ordered_scan(fixed_dib(spark, d).select("sym", "bn", "close"), ["sym"], ["bn"], K.macd(), "sym string, bn long, close double, macd double, macdSignal double, macdHist double").drop("close")


@query()
def rsi_bars(spark, d):
    return ordered_scan(fixed_dib(spark, d).select("sym", "bn", "close"), ["sym"], ["bn"], K.rsi(), "sym string, bn long, close double, rsi double")


def labelled(spark, d):
    bars = ordered_scan(fixed_dib(spark, d).select("sym", "bn", "high", "low", "close"), ["sym"], ["bn"], K.label_sigma(), "sym string, bn long, high double, low double, close double, sigma double")
    return X.triple_barrier(bars, horizon=10)


def _rounded(df, *columns, places=9):
    """Logarithms differ in their last bits between engines."""
    return df.withColumns({c: F.round(c, places) for c in columns})


@query()
def triple_barrier(spark, d):
    return _rounded(labelled(spark, d), "sigma", "upperPx", "lowerPx", "retAtTouch")


@query()
def label_summary(spark, d):
    return X.label_summary(labelled(spark, d))


@query()
def label_distribution(spark, d):
    return X.label_distribution(labelled(spark, d))


def _sequence(spark, d):
    """All trades, numbered with a gap after every 11th, every 7th sent twice, and one restart."""
    seq = F.col("tradeId") + F.floor(F.col("tradeId") / 11)
    seq = F.when(F.col("tradeId") >= 7000, seq - 7636).otherwise(seq)
    return A.trades(spark, d).select(F.lit("trade").alias("side"), "tradeId", F.explode(F.when(F.col("tradeId") % 7 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"), seq.alias("seq"))


@query(
    """WITH RECURSIVE x AS (SELECT event_id AS tradeId, unnest(CASE WHEN event_id % 7 = 3 THEN [0, 1] ELSE [0] END) AS copy, event_id + event_id // 11 - CASE WHEN event_id >= 7000 THEN 7636 ELSE 0 END AS seq FROM events),
s AS (SELECT *, row_number() OVER (ORDER BY tradeId, copy) AS i FROM x),
r AS (SELECT i, seq AS last, 'accept' AS action, 0::BIGINT AS missed FROM s WHERE i = 1 UNION ALL
  SELECT s.i, CASE WHEN s.seq <= r.last AND r.last - s.seq < 1000 THEN r.last ELSE s.seq END, CASE WHEN s.seq <= r.last AND r.last - s.seq < 1000 THEN 'drop_duplicate' WHEN s.seq > r.last + 1 THEN 'accept_with_gap' ELSE 'accept' END, CASE WHEN s.seq > r.last + 1 THEN s.seq - r.last - 1 ELSE 0 END FROM r JOIN s ON s.i = r.i + 1)
SELECT action, count(*) AS n, sum(missed)::BIGINT AS missed FROM r GROUP BY action"""
)
def sequence_counters(spark, d):
    checked = ordered_scan(_sequence(spark, d), ["side"], ["tradeId", "copy"], K.sequence_check(), "side string, tradeId long, copy int, seq long, action string, missed long, restarted boolean")
    return checked.groupBy("action").agg(F.count("*").alias("n"), F.sum("missed").alias("missed"))


@query(
    f"""WITH RECURSIVE {_TRADES}, s AS (SELECT sym, tradeId, price * qty * CASE WHEN buyerIsMaker THEN -1 ELSE 1 END AS sd, row_number() OVER (PARTITION BY sym ORDER BY tradeId) AS i FROM t WHERE price * qty >= 50),
r AS (SELECT sym, tradeId, i, CASE WHEN abs(sd) >= 5000 THEN 0.0::DOUBLE ELSE sd END AS theta, CASE WHEN abs(sd) >= 5000 THEN 1 ELSE 0 END::BIGINT AS bn FROM s WHERE i = 1 UNION ALL
  SELECT sym, tradeId, i, CASE WHEN abs(x) >= 5000 THEN 0.0::DOUBLE ELSE x END, bn + CASE WHEN abs(x) >= 5000 THEN 1 ELSE 0 END FROM (SELECT s.sym, s.tradeId, s.i, r.bn, CASE WHEN (s.sd > 0) = (r.theta > 0) THEN r.theta + s.sd ELSE s.sd END AS x FROM r JOIN s ON s.sym = r.sym AND s.i = r.i + 1))
SELECT sym, tradeId, bn FROM r"""
)
def drb_numbers(spark, d):
    return ordered_scan(B.ticks(A.trades(spark, d)), ["sym"], ["tradeId"], K.fixed_bars("drb", 5_000.0), f"{B.TICKS}, {B.OPEN}").select("sym", "tradeId", "bn")


@query(f"WITH RECURSIVE {_DIB} SELECT sym, CAST(CAST(barend AS DATE) AS VARCHAR) AS date, count(*) AS n, sum(ticks)::DOUBLE / count(*) AS avgTicks FROM bars GROUP BY 1, 2")
def bars_per_day(spark, d):
    return R.bars_per_day(fixed_dib(spark, d))


@query(f"WITH {_TRADES}, {_FUNDING} SELECT sym, fundingTime, CASE WHEN sym = 'click' THEN fundingRate + 1 ELSE fundingRate END AS fundingRate FROM fr")
def funding_merge(spark, d):
    from ..sources.archives import merge_funding

    stored = A.funding(spark, d).withColumn("markPrice", F.lit(None).cast("double"))
    return merge_funding(stored, stored.where("sym = 'click'").withColumn("fundingRate", F.col("fundingRate") + 1)).drop("markPrice")


@query()
def position_flips(spark, d):
    return R.position_flips(online_bars(spark, d))


@query()
def position_stats(spark, d):
    return R.position_stats(R.position_flips(online_bars(spark, d)))


@query()
def bar_stats(spark, d):
    first, rest = halves(B.ticks(A.trades(spark, d)))
    return B.stats(B.adaptive(rest, B.warmup(first, "rwdib", 60.0)[1], "rwdib"))


@query()
def warmup_bars(spark, d):
    t = B.ticks(A.trades(spark, d))
    out = [B.warmup(t, kind, 60.0)[0].withColumn("kind", F.lit(kind)) for kind in ("dib", "drb", "rwdib")]
    return out[0].unionByName(out[1], True).unionByName(out[2], True)


@query()
def adaptive_bars(spark, d):
    t = B.ticks(A.trades(spark, d))
    first, rest = halves(t)
    out = [B.adaptive(rest, B.warmup(first, kind, 60.0)[1], kind).withColumn("kind", F.lit(kind)) for kind in ("dib", "drb", "rwdib")]
    return out[0].unionByName(out[1]).unionByName(out[2])


def halves(ticks):
    """A warm-up of five days, and what comes after it."""
    cut = ticks.agg(F.expr("date_trunc('day', min(time)) + interval 5 days").cast("timestamp_ntz")).scalar()
    return ticks.where(F.col("time") < cut), ticks.where(F.col("time") >= cut)


@query()
def online_bars(spark, d):
    return ordered_scan(A.trades(spark, d), ["sym"], ["tradeId"], K.online_bars(20_000.0), K.ONLINE_SCHEMA)


@query()
def order_book_imbalance(spark, d):
    qty = [f"{s}Qty{i}" for s in ("bid", "ask") for i in range(1, 6)]
    q = A.quotes(spark, d).select("sym", "fhSeqNo", *qty)
    return ordered_scan(q, ["sym"], ["fhSeqNo"], K.imbalance(), "sym string, fhSeqNo long, " + ", ".join(f"{c} double" for c in qty) + ", rawOBI double, smoothOBI double").select("sym", "fhSeqNo", "rawOBI", "smoothOBI")


@query()
def realized_volatility(spark, d):
    return _rounded(ordered_scan(A.trades(spark, d).select("sym", "time", "tradeId", "price"), ["sym"], ["tradeId"], K.sampled_volatility(3600, 3 * 86400, 10, 24, 3600), "sym string, time timestamp_ntz, annualizedVol double, samples long, isValid boolean"), "annualizedVol", places=6)


@query()
def rsi_ranking(spark, d):
    return rsi_signal(A.trades(spark, d), interval_s=3600)


@query()
def backtest_momentum(spark, d):
    from ..operators.backtest import Momentum, run

    return run(A.trades(spark, d), A.funding(spark, d).withColumn("markPrice", F.lit(None).cast("double")), {"fast8": Momentum(8, 21), "fast12": Momentum(12, 26)})


def _book_sql() -> str:
    """The book's states by recursion over each symbol's messages, and what of them is shown by a second one."""

    def merged(book: str, side: str) -> str:
        for j in (1, 2, 3):
            known = f"list_filter({book}, lambda x: x.p <> s.{side}p[{j}])"
            new = f"CASE WHEN s.q[{j}] <> 0 THEN [{{'p': s.{side}p[{j}], 'q': s.q[{j}]}}] ELSE [] END"
            book = f"list_sort(list_concat({known}, {new}), '{'DESC' if side == 'b' else 'ASC'}')[:5]"
        return book

    level = "STRUCT(p DOUBLE, q DOUBLE)[]"
    price = lambda sign: "[" + ", ".join(f"round(value {sign} 0.01::DOUBLE * {j}, 2) + 0.0::DOUBLE" for j in (1, 2, 3)) + "]"
    starts, fits, gap = "s.snap AND r.state = 'init'", "NOT s.snap AND r.state <> 'init' AND s.id <= r.last + 1", "NOT s.snap AND r.state <> 'init' AND s.id > r.last + 1"
    book = lambda side: f"CASE WHEN {starts} THEN {merged(f'CAST([] AS {level})', side)} WHEN {fits} THEN {merged(f'r.{side}', side)} WHEN {gap} THEN CAST([] AS {level}) ELSE r.{side} END"
    shown = [f"CASE WHEN valid THEN coalesce({of}[{i}].{x}, 0) ELSE 0 END::DOUBLE AS {side}{what}{i}" for side, of in (("bid", "b"), ("ask", "a")) for what, x in (("Price", "p"), ("Qty", "q")) for i in range(1, 6)]
    return f"""WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS i FROM events),
s AS (SELECT event_type AS sym, event_id AS ord, i, i % 200 = 10 AS snap, i + i // 997 AS id, epoch_us(ts) // 1000 AS ms, {price("-")} AS bp, {price("+")} AS ap, [((i * 8) % 5)::DOUBLE, ((i * 9) % 5)::DOUBLE, ((i * 10) % 5)::DOUBLE] AS q FROM e),
r AS (SELECT DISTINCT sym, 0::BIGINT AS i, 'init' AS state, 0::BIGINT AS last, CAST([] AS {level}) AS b, CAST([] AS {level}) AS a FROM s UNION ALL
  SELECT s.sym, s.i, CASE WHEN {starts} THEN 'syncing' WHEN {fits} THEN 'valid' WHEN {gap} THEN 'init' ELSE r.state END, CASE WHEN {starts} OR {fits} THEN s.id WHEN {gap} THEN 0 ELSE r.last END, {book("b")}, {book("a")} FROM r JOIN s ON s.sym = r.sym AND s.i = r.i + 1),
c AS (SELECT s.sym, s.ord, s.ms, r.state = 'valid' AS valid, r.b, r.a, row_number() OVER (PARTITION BY s.sym ORDER BY s.i) AS k FROM r JOIN s ON s.sym = r.sym AND s.i = r.i JOIN r p ON p.sym = r.sym AND p.i = r.i - 1 WHERE NOT s.snap AND p.state <> 'init'),
g AS (SELECT c.sym, c.k, p.k IS NULL OR p.valid <> c.valid OR (c.valid AND (p.b <> c.b OR p.a <> c.a)) AS news, c.valid, c.ms FROM c LEFT JOIN c p ON p.sym = c.sym AND p.k = c.k - 1),
o AS (SELECT sym, k, true AS show, ms AS at FROM g WHERE k = 1 UNION ALL SELECT g.sym, g.k, g.news OR (g.valid AND g.ms - o.at >= 50), CASE WHEN g.news OR (g.valid AND g.ms - o.at >= 50) THEN g.ms ELSE o.at END FROM o JOIN g ON g.sym = o.sym AND g.k = o.k + 1)
SELECT c.sym, c.ord, c.ms AS eventMs, valid AS isValid, {", ".join(shown)} FROM c JOIN o ON o.sym = c.sym AND o.k = c.k WHERE o.show"""


@query(_book_sql())
def book_replay(spark, d):
    """Deltas made of events, with a snapshot every 200th and gaps now and then, through the level-5 book."""
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("i", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")).cast("long"))
    side = lambda sign: F.array(*(F.array(F.round(F.col("value") + sign * 0.01 * j, 2), ((F.col("i") * (7 + j)) % 5).cast("double")) for j in range(1, 4)))
    rows = e.select(
        F.col("event_type").alias("sym"), F.col("event_id").alias("ord"), F.when(F.col("i") % 200 == 10, "snapshot").otherwise("delta").alias("kind"), (F.col("i") + F.floor(F.col("i") / 997)).alias("firstId"),
        (F.col("i") + F.floor(F.col("i") / 997)).alias("finalId"), F.unix_millis(F.col("ts").cast("timestamp")).alias("eventMs"), side(-1).alias("bids"), side(1).alias("asks"),
    )
    return ordered_scan(rows, ["sym"], ["ord"], K.order_book(), K.BOOK_SCHEMA)
