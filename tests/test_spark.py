"""Operators, sources, persistence and streams on small frames."""

import datetime as dt
import io
import random
import zipfile

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import features, kernels, relational
from tidemark.operators.scan import ordered_scan
from tidemark.plans import serving
from tidemark.schemas import AGG_TRADE, HEALTH, QUOTE, ROUTER_STAMPS, TRADE, extend
from tidemark.sources import archives, wire
from tidemark.streaming import pipelines, stateful
from tidemark.streaming.subscribe import Subscription

T = "time timestamp_ntz, sym string, tradeId long, price double, qty double, buyerIsMaker boolean"


def trades(spark, n=100):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(at + dt.timedelta(seconds=i), "AB"[i % 2], i, 100 + (i * 7 % 13) * 0.5, 1.0 + i % 3, i % 3 == 0) for i in range(n)], T)


def test_schemas():
    assert [len(s) for s in (TRADE, AGG_TRADE, QUOTE, HEALTH)] == [12, 14, 28, 10]
    assert extend(TRADE, *ROUTER_STAMPS).names[-2:] == ["tpRecvTimeUtcNs", "tpSeqNo"]
    assert TRADE.names.index("sym") == 1 and not TRADE["buyerIsMaker"].nullable


def test_summary_of_nothing_and_zero_volume(spark):
    assert relational.vwap(trades(spark, 0)).count() == 0
    zero = trades(spark, 2).withColumn("qty", F.lit(0.0))
    assert {r.vwap for r in relational.vwap(zero).collect()} == {None}


def test_asof_before_the_first_is_null(spark):
    at = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([("A", at - dt.timedelta(seconds=1)), ("A", at), ("A", at + dt.timedelta(seconds=3))], "sym string, t timestamp_ntz")
    got = relational.asof(left, trades(spark), "sym", "t", "time", "price", "tradeId").orderBy("t").collect()
    assert [r.price for r in got] == [None, 100.0, 100 + (14 % 13) * 0.5]


def test_nearest_ranks(spark):
    from tidemark.functions.semantics import nearest_ranks

    df = spark.range(1, 11).select(F.lit("a").alias("g"), F.col("id").alias("x"), F.when(F.col("id") > 5, F.lit(None)).otherwise(F.lit(7.0)).alias("y"))
    got = nearest_ranks(df.unionByName(df.where("false")), ("g",), {"x": "x", "y": "y"}, {"P50": 0.5, "P95": 0.95}).first()
    assert got.asDict() == {"g": "a", "xP50": 6, "xP95": 10, "xMax": 10, "yP50": 7.0, "yP95": 7.0, "yMax": 7.0, "cnt": 10}
    plan = nearest_ranks(df, ("g",), {"x": "x"}, {"P50": 0.5})._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def test_events_between_runs_one_way(spark):
    at = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([("A", at - dt.timedelta(seconds=1), 1), ("A", at, 2), ("A", at + dt.timedelta(seconds=1), 3), ("A", at + dt.timedelta(days=1), 4), ("C", at, 5)], "sym string, at timestamp_ntz, n int")
    out = relational.events_between(trades(spark), events, "at")
    assert sorted((r.n, r.tradeId) for r in out.collect()) == [(1, 0), (2, 0), (3, 2)]
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower().replace(" ", "")


def test_formats(spark):
    from tidemark.functions.semantics import format_count, format_duration

    df = spark.createDataFrame([(3725,), (184,), (5,), (None,)], "n long")
    assert [r[0] for r in df.select(format_duration(F.col("n"))).collect()] == ["1h 2m", "3m 4s", "5s", "--"]
    df = spark.createDataFrame([(1_230_000,), (4_500,), (7,)], "n long")
    assert [r[0] for r in df.select(format_count(F.col("n"))).collect()] == ["1.23M", "4.5K", "7"]


def test_labels(spark):
    close = [100, 100, 103, 99, 100, 100.5]
    rows = [("A", i, c + 0.1, c - 0.1, float(c), 0.01 if i else None) for i, c in enumerate(close)]
    bars = spark.createDataFrame(rows, "sym string, bn long, high double, low double, close double, sigma double")
    got = features.triple_barrier(bars, horizon=2).orderBy("bn").collect()
    assert [r.reason for r in got] == ["noSigma", "upper", "lower", "vertical", "vertical", "noFuture"]
    assert [r.label for r in got] == [None, 1, -1, 1, 1, None]
    assert all(0 < r.endBn - r.bn <= 2 for r in got if r.endBn is not None)


def test_feature_registry_is_open(spark):
    features.feature("twice")(lambda w, n: F.col("close") * 2)
    bars = spark.createDataFrame([("A", 1, dt.datetime(2024, 1, 1), 5.0)], "sym string, bn long, barstart timestamp_ntz, close double")
    assert features.build(bars, ["twice"]).first().twice == 10.0
    del features.REGISTRY["twice"]


def test_wire(spark):
    good = '{"stream":"x","data":{"e":"aggTrade","E":1717459199850,"s":"BTCUSDT","a":99999000,"p":"50100.25","q":"0.5","f":99999001,"l":99999004,"T":1717459199800,"m":false}}'
    df = spark.createDataFrame([(good,), ("{",), (good.replace('"50100.25"', '"x"'),)], "value string")
    ok, bad = wire.trades(df, aggregated=True)
    r = ok.first()
    assert (r.sym, r.aggTradeId, r.price, r.qty, r.buyerIsMaker) == ("BTCUSDT", 99999000, 50100.25, 0.5, False) and bad.count() == 2
    d = spark.createDataFrame([('{"stream":"x","data":{"s":"B","U":1,"u":2,"E":3,"b":[["1.5","2","x"],["q","1"],["1"]],"a":[]}}',)], "value string")
    assert wire.depth(d)[0].first().bids == [[1.5, 2.0]]
    assert wire.stream_path(["BTCUSDT", "ETHUSDT"], "@trade") == "/stream?streams=btcusdt@trade/ethusdt@trade"


def test_archives(spark, tmp_path):
    (tmp_path / "BTCUSDT-trades-2026-01-14.csv").write_text("1,100.5,2,201,1768348800000000,True,True\n2,101,1,101,1768348801000000,False,True\n")
    got = archives.read_csv(spark, str(tmp_path / "*.csv"), "spot").orderBy("tradeId").collect()
    assert got[0].sym == "BTCUSDT" and got[0].exchTradeTs == dt.datetime(2026, 1, 14) and got[0].buyerIsMaker and not got[1].buyerIsMaker
    with zipfile.ZipFile(tmp_path / "ETHUSDT-aggTrades-2026-01-14.zip", "w") as z:
        z.writestr("ETHUSDT-aggTrades-2026-01-14.csv", "agg_trade_id,price,quantity,first_trade_id,last_trade_id,transact_time,is_buyer_maker\n5,10,1,50,51,1768348800000,true\n")
    z = archives.read_zip(spark, str(tmp_path / "*.zip"), "agg").first()
    assert (z.sym, z.aggTradeId, z.exchTradeTs, z.buyerIsMaker) == ("ETHUSDT", 5, dt.datetime(2026, 1, 14), True)


def test_zip_members_are_read_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "LINES", 7)
    for day in range(3):
        with zipfile.ZipFile(tmp_path / f"BTCUSDT-trades-2026-01-1{day}.zip", "w", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED][day % 2]) as z:
            z.mkdir("part")
            z.writestr("empty.csv", "")
            for k in range(2):
                z.writestr(f"part/{k}.csv", "".join(f"{100 * day + 20 * k + i},1.5,2,3,{1768348800000000 + i},True,True\n" for i in range(20)))
    members = archives.zip_members(spark, str(tmp_path / "*.zip")).collect()
    assert sorted(m.member for m in members) == sorted(["empty.csv", "part/0.csv", "part/1.csv"] * 3) and {m.bytes for m in members if m.member == "empty.csv"} == {0}
    got = archives.read_zip(spark, str(tmp_path / "*.zip"), "spot")
    assert sorted(r.tradeId for r in got.select("tradeId").collect()) == sorted(100 * d + 20 * k + i for d in range(3) for k in range(2) for i in range(20))
    assert got.rdd.getNumPartitions() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan  # Spark lists the archives and reads none whole


def test_a_hot_symbols_day_has_many_files(spark, tmp_path):
    df = spark.range(40_000).select(F.timestamp_seconds(F.lit(1768348800) + F.col("id")).alias("exchTradeTs"), F.lit("BTCUSDT").alias("sym"), "id").where("id < 36000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archives.write_dates(df, str(tmp_path), "trade")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "trade").rglob("*.parquet"))
    assert len(files) > 1
    for f in files:
        at = spark.read.parquet(str(f)).select("id").toPandas()["id"]
        assert at.is_monotonic_increasing
    assert spark.read.parquet(str(tmp_path / "trade")).count() == 36_000


def test_range_loader_and_store(spark, tmp_path):
    store = archives.Store(spark, f"file:{tmp_path}/hdb")
    day = dt.date(2024, 1, 1)

    def source(d):
        if d == day + dt.timedelta(days=1):
            return None
        return trades(spark, 10).withColumn("exchTradeTs", F.lit(d).cast("timestamp"))

    got = archives.load_range(store, "trade", day, day + dt.timedelta(days=2), source)
    assert (len(got.loaded), len(got.failed), got.rows, got.exit_code) == (2, 1, 20, 2)
    again = archives.load_range(store, "trade", day, day, source)
    assert again.skipped == [day]
    assert store.tables() == ["trade"] and store.dates("trade") == ["2024-01-01", "2024-01-03"]
    assert store.load("trade", day, day, "A").count() == 5
    assert {r["rows"] for r in store.row_counts("trade").collect()} == {10}


def test_end_of_day(spark, tmp_path):
    spool, store = f"file:{tmp_path}/spool", archives.Store(spark, f"file:{tmp_path}/hdb")
    for d in ("2024-01-01", "2024-01-02"):
        trades(spark).withColumn("tpSeqNo", F.col("tradeId")).write.parquet(f"{spool}/trade/date={d}")
    assert archives.recover_orphans(store, spool, "trade", "2024-01-02") == ["2024-01-01"]
    assert store.load("trade").count() == 100 and not store.exists(f"{spool}/trade/date=2024-01-01")
    assert archives.end_of_day(store, spool, "trade", "2024-01-02") == 100
    with pytest.raises(FileExistsError):
        archives.end_of_day(store, spool, "trade", "2024-01-02")


def test_funding(spark):
    at = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([("B", at, 0.1, 1.0)], "sym string, fundingTime timestamp, fundingRate double, markPrice double")
    new = spark.createDataFrame([("B", at, 0.2, 1.0), ("C", at, 0.3, 1.0)], old.schema)
    assert {(r.sym, r.fundingRate) for r in archives.merge_funding(old, new).collect()} == {("B", 0.2), ("C", 0.3)}
    calls = []

    def fetch(since):
        calls.append(since)
        return [{"fundingTime": since + i} for i in range(3 if len(calls) < 3 else 1)]

    assert len(archives.pages(fetch, 0, limit=3)) == 7 and calls == [0, 3, 6]


def test_subscription(spark):
    sub = Subscription(["A"], "price > 101", ["sym", "price * qty as notional"])
    assert sub.apply(trades(spark)).columns == ["sym", "notional"]
    with pytest.raises(AnalysisException):
        Subscription(where="nothing > 1").check(trades(spark))


def test_stream_equals_batch(spark, tmp_path):
    t = trades(spark).select("sym", "tradeId", "price")
    for i in range(4):
        t.where(f"tradeId >= {25 * i} and tradeId < {25 * i + 25}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = "sym string, tradeId long, price double, ema double"
    batch = ordered_scan(t, ["sym"], ["tradeId"], kernels.ema("price", 5), schema)
    stream = stateful.stream_scan(pipelines.file_source(spark, str(tmp_path / "in"), t.schema, 1), ["sym"], ["tradeId"], kernels.ema("price", 5), schema)
    q = stream.writeStream.format("memory").queryName("scanned").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("scanned").collect()} == {tuple(r) for r in batch.collect()}


def test_windows_and_fan_out(spark, tmp_path):
    trades(spark).write.parquet(str(tmp_path / "in"))
    source = pipelines.file_source(spark, str(tmp_path / "in"), trades(spark).schema)
    q = pipelines.windowed_summary(source, "20 seconds").writeStream.format("memory").queryName("sums").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(r.trades for r in spark.table("sums").collect()) == 100
    seen = {}
    q = pipelines.fan_out(source, {"a": lambda b, e: seen.update(a=b.count()), "b": lambda b, e: seen.update(b=b.where("sym = 'A'").count())}, str(tmp_path / "cp"))
    q.awaitTermination()
    assert seen == {"a": 100, "b": 50}
    pipelines.durable_log(source, str(tmp_path / "log"), str(tmp_path / "cp2")).awaitTermination()
    pipelines.durable_log(source, str(tmp_path / "log"), str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "log")).count() == 100


def test_backtest(spark):
    from tidemark.operators.backtest import Momentum, report, run

    t = trades(spark, 200).withColumn("sym", F.lit("A"))
    funding = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 0, 2), 0.001, None)], "sym string, fundingTime timestamp_ntz, fundingRate double, markPrice double")
    audit = run(t, funding, {"x": Momentum(2, 5), "y": Momentum(3, 8)})
    assert {r.run for r in audit.select("run").distinct().collect()} == {"x", "y"}
    got = {r.run: r for r in report(audit).collect()}
    assert got["x"].fills > 2 and got["x"].fees > 0
    pd.testing.assert_frame_equal(audit.toPandas().sort_values(["run", "ord", "event"]).reset_index(drop=True), run(t, funding, {"x": Momentum(2, 5), "y": Momentum(3, 8)}).toPandas().sort_values(["run", "ord", "event"]).reset_index(drop=True))


def test_volatility_tool(spark):
    v = spark.createDataFrame([("BTCUSDT", dt.datetime(2024, 1, 1), 50.0, 130, True)], "sym string, time timestamp_ntz, annualizedVol double, samples long, isValid boolean")
    assert serving.get_volatility(v, "btcusdt")["data"][0]["volatility"] == 50.0
    assert serving.get_volatility(v, "xx")["data"] == []
    assert serving.volatility_comparison(v).first().difference == 5.0


def test_logs(spark, tmp_path):
    path, store = f"file:{tmp_path}/log", archives.Store(spark, f"file:{tmp_path}/hdb")
    for d in ("2024-01-01", "2024-01-09"):
        trades(spark, 5).coalesce(1).write.parquet(f"{path}/date={d}")
    (tmp_path / "log/date=2024-01-08").mkdir()
    (tmp_path / "log/date=2024-01-08/part-0.parquet").write_bytes(b"nothing")
    assert [(r.date, r.files, r.state) for r in archives.logs(store, path).orderBy("date").collect()] == [("2024-01-01", 1, "ok"), ("2024-01-08", 1, "corrupt"), ("2024-01-09", 1, "ok")]
    assert archives.clean_logs(store, path, dt.date(2024, 1, 10)) == ["2024-01-01"]
    assert archives.logs(store, path).count() == 2


def test_config():
    from tidemark.sources import config

    c = config.load('{"symbols": ["btcusdt"], "market": {"stream_suffix": "@aggTrade"}, "other": 1}')
    assert c.symbols == ["btcusdt"] and c.market.stream_suffix == "@aggTrade" and c.tickerplant.port == 5010 and c.reconnect.max_backoff_ms == 8000
    with pytest.raises(TypeError):
        config.load('{"tickerplant": {"port": "x"}}')


def test_pages_end_or_raise(spark):
    book = [{"symbol": "A", "fundingRate": "0.1", "fundingTime": i, "markPrice": "5"} for i in range(25)]
    fetch = lambda s, ms: [r for r in book if r["fundingTime"] >= ms][:10]
    assert len(archives.pages(lambda ms: fetch("A", ms), 0, 10)) == 25
    with pytest.raises(RuntimeError, match="go on from 20"):
        archives.pages(lambda ms: fetch("A", ms), 0, 10, most=2)
    stored = spark.createDataFrame([("A", dt.datetime(1970, 1, 1, 0, 0, 0, 20_000), 0.1, 5.0)], "sym string, fundingTime timestamp, fundingRate double, markPrice double")
    assert archives.fetch_new(stored, ["A"], fetch, spark).count() == 5
    assert archives.fetch_new(None, ["A"], lambda s, ms: [], spark).count() == 0


def test_store_sizes_and_logs(spark, tmp_path):
    store = archives.Store(spark, f"file:{tmp_path}")
    archives.write_dates(trades(spark).withColumn("exchTradeTs", F.col("time").cast("timestamp")), store.root, "t")
    size = store.sizes("t").first()
    assert store.date_range("t") == ("2024-01-01", "2024-01-01") and size.compressedMB > 0 and size.logicalMB > 0 and size.ratio > 0
    assert [r.state for r in archives.logs(store, f"{store.root}/t").collect()] == ["ok"]
    part = tmp_path / "t" / "date=2024-01-01"
    (part / "part-zz.parquet").write_bytes(b"PAR1 not a file PAR1")
    assert [(r.files > 1, r.state) for r in archives.logs(store, f"{store.root}/t").collect()] == [(True, "corrupt")]


def test_missing_operators(spark):
    t = trades(spark)
    assert relational.retained(t, "2024-01-01 00:01:39", 1).count() == 61
    got = relational.stamped(("time", "tradeId"), a=t, b=t.where("tradeId < 5")).orderBy("tpSeqNo").collect()
    assert [r.tpSeqNo for r in got] == list(range(1, 106)) and [r.side for r in got[:4]] == ["a", "b", "a", "b"]
    assert [r.sym for r in relational.unsubscribed(t.select("sym"), t.where("sym = 'A'").select("sym")).collect()] == ["B"]


def test_features_of_scans(spark):
    bars = spark.createDataFrame([("A", i, dt.datetime(2024, 1, 1), 100.0 + i % 7) for i in range(40)], "sym string, bn long, barstart timestamp_ntz, close double")
    got = features.build(bars, ["rsi", "macdHist", "macd"]).orderBy("bn").collect()
    assert got[0].rsi is None and 0 < got[-1].rsi < 100 and got[0].macd == 0.0 and set(features.names()) >= {"rsi", "macd", "macdSignal", "macdHist", "vpin"}


def test_adaptive_days(spark):
    """Two days at different price levels: the anchor follows the price, a bar holds the ticks of the day it closes on."""
    from tidemark.operators import bars

    at = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [(at[d] + dt.timedelta(seconds=60 * i), "A", 1000 * d + i, (100.0, 100.0, 200.0)[d], 1.0 + (i * 7 % 5), i % 3 == 0) for d in range(3) for i in range(400)]
    t = bars.ticks(spark.createDataFrame(rows, T))
    got = bars.run(t, "rwdib", "2024-01-01", "2024-01-02", "2024-01-03", 40.0)
    days = {r.d: r for r in got.where("not warmup").groupBy(F.to_date("barend").alias("d")).agg(F.max("th").alias("th"), F.count("*").alias("n"), F.countDistinct("et").alias("ets"), F.max(F.datediff("barend", "barstart")).alias("over")).collect()}
    assert days[at[2].date()].th > 1.2 * days[at[1].date()].th and all(r.ets == 1 and r.over == 0 for r in days.values())
    assert got.columns == bars.warmup(t, "rwdib")[0].select(*got.columns).columns
    cleaned = bars.clean(got).orderBy("bn").collect()
    assert [r.bn for r in cleaned] == list(range(1, len(cleaned) + 1))


def test_strategy_callbacks(spark):
    from tidemark.operators import backtest

    class Buyer:
        def init(self):
            return {"seen": [], "bought": False}

        def on_trade(self, state, sym, price, position):
            return (state, []) if state["bought"] else (state | {"bought": True}, [("buy", 1.0)])

        def on_fill(self, state, fill):
            return state | {"seen": [*state["seen"], ("fill", fill["qty"])]}

        def on_funding(self, state, event):
            return state | {"seen": [*state["seen"], ("funding", event["rate"])]}

        def on_timer(self, state, time):
            return state, [("flatten", 0.0, "A")] if ("funding", 0.5) in state["seen"] else []

    account = backtest.Account(Buyer(), None, 100_000.0, True, pd.Timedelta(seconds=10))
    start = pd.Timestamp("2024-01-01")
    row = lambda s, **k: {"run": "x", "ord": s, "time": start + pd.Timedelta(seconds=s), "sym": "A", "kind": 1, "price": 100.0, "rate": None, "mark": None} | k
    for r in (row(0), row(5), row(12, kind=0, rate=0.5, mark=100.0), row(15), row(31)):
        account.on_event(r)
    assert account.state["seen"] == [("fill", 1.0), ("funding", 0.5), ("fill", -1.0)]
    flat = [x for x in account.out if x[4] == "fill"][-1]
    assert flat[2] == start + pd.Timedelta(seconds=20) and flat[5] == -1.0
    assert isinstance(backtest.load_strategy("tidemark.operators.backtest:Momentum", {"fast": 3}), backtest.Momentum)
    assert backtest.parse_arguments(["-sym", "BTCUSDT", "-fast", "5", "-x", "1.0", "-y", "z"]) == ({"sym": "BTCUSDT"}, {"fast": 5, "x": 1.0, "y": "z"})
    with pytest.raises(ValueError, match="missing"):
        backtest.parse_arguments(["-fast"])


# One regression test for each trap of the reference that a rule here decides.


def test_trap_equity_subtracts_funding():
    from tidemark.operators.backtest import Position

    assert Position(qty=1.0, cost=100.0, fees=2.0, funding=3.0, mark=110.0).net == 5.0


def test_trap_full_reduction_keeps_the_cost_and_marks_at_the_fill():
    from tidemark.operators.backtest import Position

    p = Position()
    p.fill(2.0, 100.0, 0.0)
    p.fill(-2.0, 120.0, 0.0)
    assert (p.qty, p.cost, p.realized, p.mark) == (0.0, 100.0, 40.0, 120.0)
    p.fill(1.0, 90.0, 0.0)
    assert p.cost == 90.0


def test_trap_cap_binds_the_projected_position():
    from tidemark.operators.backtest import pretrade

    assert pretrade("buy", 5.0, -1.0, 1.0, False) == (2.0, "") and pretrade("sell", 5.0, 0.5, 1.0, False) == (-1.5, "")
    assert pretrade("buy", 0.1, 1.0, 1.0, False) == (0.0, "atCap") and pretrade("sell", 0.5, 1.0, None, False) == (0.0, "unknownSymbol")
    assert pretrade("flatten", 0.0, 1.0, None, True) == (-1.0, "") and pretrade("buy", 1.0, 0.0, 1.0, True) == (0.0, "killSwitch")


def test_trap_funding_before_the_first_trade_finds_no_position(spark):
    from tidemark.operators import backtest

    at = dt.datetime(2024, 1, 1)
    funding = spark.createDataFrame([("A", at - dt.timedelta(hours=1), 0.01, None)], "sym string, fundingTime timestamp_ntz, fundingRate double, markPrice double")
    got = backtest.run(trades(spark), funding, {"m": backtest.Momentum(2, 3)}, by_symbol=True)
    assert got.where("event = 'funding'").count() == 0


def test_trap_invalid_quotes_count_unless_asked(spark):
    rows = [("A", 1, 10.0, 12.0, True), ("A", 2, 0.0, 0.0, False)]
    q = spark.createDataFrame(rows, "sym string, fhSeqNo long, bidPrice1 double, askPrice1 double, isValid boolean").withColumn("time", F.lit(dt.datetime(2024, 1, 1)))
    assert relational.quote_summary(q).first().avgSpread == 1.0 and relational.quote_summary(q, valid_only=True).first().avgSpread == 2.0


def test_trap_event_time_buckets(spark):
    t = trades(spark, 20)
    got = relational.latency_percentiles(t, "qty", "price", "5 seconds").groupBy("bucket").agg(F.sum("cnt").alias("n")).orderBy("bucket").collect()
    assert [r.n for r in got] == [5, 5, 5, 5] and got[0].bucket.replace(tzinfo=None) == dt.datetime(2024, 1, 1)


def test_trap_zero_sigma_touches_at_once(spark):
    rows = [("A", i, 100.0 + 0.5, 100.0 - 0.5, 100.0, 0.0) for i in range(3)]
    bars = spark.createDataFrame(rows, "sym string, bn long, high double, low double, close double, sigma double")
    assert [r.reason for r in features.triple_barrier(bars, horizon=2).orderBy("bn").collect()] == ["sameBar", "sameBar", "noFuture"]


def test_trap_small_trades_go_before_anything_is_counted(spark):
    from tidemark.operators import bars

    t = bars.ticks(trades(spark), 150.0)
    assert t.count() == trades(spark).where("price * qty >= 150").count() and bars.calibrate(t, "dib", 10.0).agg(F.sum("n")).first()[0] == t.count()


def test_trap_restart_of_the_router(spark):
    """A stream that starts again from its checkpoint writes each row once, whatever its numbers do."""
    seq = pd.DataFrame({"seq": [5000, 5001, 1, 2, 2]})
    out, _ = kernels.sequence_check()(None, seq)
    assert out["action"].tolist() == ["accept", "accept", "accept", "accept", "drop_duplicate"] and out["restarted"].tolist() == [False, False, True, False, False]


def test_thinned_history_and_half_open_days(spark):
    t = trades(spark)
    got = ordered_scan(t, ["sym"], ["tradeId"], kernels.thinned(10), T)
    assert {r.sym: r.n for r in got.groupBy("sym").agg(F.count("*").alias("n")).collect()} == {"A": 10, "B": 10}
    assert relational.on_days(t, "2023-12-31", "2024-01-01").count() == 100 and relational.on_days(t, "2023-12-30", "2023-12-31").count() == 0
    log, health = pipelines.routed(t.select("*", F.when(F.col("tradeId") < 3, "health").otherwise("trade").alias("table")))
    assert (log.count(), health.count()) == (97, 3)


@pytest.mark.parametrize("by_symbol", [False, True])
def test_backtest_in_slices_equals_one_scan(spark, monkeypatch, by_symbol):
    """Accounts, timers, strategies' states and the kill switch go from slice to slice; a symbol that is absent
    from slices in the middle goes on; no sort of all events is left."""
    from tidemark.operators import scan
    from tidemark.operators.backtest import Momentum, run

    class Every:
        """Buys at each third trade of a symbol and sells out at each tenth; sells at timers after funding."""

        def init(self):
            return {"n": {}, "funded": False}

        def on_trade(self, state, sym, price, position):
            n = state["n"].get(sym, 0) + 1
            return state | {"n": state["n"] | {sym: n}}, [("flatten", 0.0)] if n % 10 == 0 else [("buy", 2.0)] if n % 3 == 0 else []

        def on_funding(self, state, event):
            return state | {"funded": True}

        def on_timer(self, state, time):
            return state, [("sell", 1.0, "A")] if state["funded"] else []

    at, rng = dt.datetime(2024, 1, 1), random.Random(5)
    data = [(at + dt.timedelta(seconds=i // 2), "B" if i in (3, 5, 290, 299) else "CD"[i % 2] if i % 5 == 0 else "A", i, 100 * (1 - i / 500) + rng.randrange(400) / 100) for i in range(300)]
    t = spark.createDataFrame(data, "time timestamp_ntz, sym string, tradeId long, price double")
    funding = spark.createDataFrame([(s, at + dt.timedelta(seconds=x), 0.001, m) for s, x, m in (("A", -9, None), ("A", 10, None), ("A", 22, 99.0), ("A", 40, None), ("B", 60, 99.0), ("C", 147, None))], "sym string, fundingTime timestamp_ntz, fundingRate double, markPrice double")
    backtest = lambda: run(t, funding, {"x": Momentum(2, 5), "y": Every()}, initial=1_000.0, timer=dt.timedelta(seconds=20), by_symbol=by_symbol)
    rows = lambda df: sorted(map(repr, df.collect()))
    want = rows(backtest())
    monkeypatch.setattr(scan, "SLICE", 40, raising=False)
    got = backtest()
    assert rows(got) == want and len(want) > 100
    assert {"killSwitch", "buy", "sell", "flatten"} <= {r.reason for r in got.collect()} and got.where("event = 'funding'").count() > 1
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
