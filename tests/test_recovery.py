"""Crashes, restarts, retention, live subscriptions, fetching in tasks, resumed bars, plans of hot symbols."""

import datetime as dt
import json
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import bars, relational
from tidemark.sources import archives
from tidemark.streaming import pipelines
from tidemark.streaming.subscribe import Desk

from .test_spark import trades


# hot symbols


def hot(spark, n=20_000):
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id"))
    return spark.range(n).select(at.cast("timestamp_ntz").alias("time"), F.lit("A").alias("sym"), F.col("id").alias("tradeId"), (100 + F.col("id") % 7).cast("double").alias("price"), (1 + F.col("id") % 3).cast("double").alias("qty"))


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def tasks_with_rows(df):
    return df.withColumn("task_", F.spark_partition_id()).select("task_").distinct().count()


def test_one_symbol_is_dealt_to_many_tasks(spark, uncoalesced):
    t = hot(spark)
    running = relational.vwap_running(t, width=500)
    assert tasks_with_rows(running) == 4
    got = {r.tradeId: r.vwap for r in running.collect()}
    p = v = 0
    for r in t.orderBy("tradeId").collect():
        p, v = p + r.price * r.qty, v + r.qty
        assert got[r.tradeId] == p / v
    asked = t.where("tradeId % 97 = 5").select("sym", (F.col("time") + F.expr("interval 5000 seconds")).alias("at"))
    joined = relational.asof(asked, t, "sym", "at", "time", "price", "tradeId", width=600)
    assert tasks_with_rows(joined) == 4
    assert all(r.price == 100 + min((r.at - dt.datetime(2024, 1, 1)).total_seconds(), 19_999) % 7 for r in joined.collect())
    between = relational.events_between(t.where("tradeId % 1000 = 0"), asked.withColumn("at", F.col("at") - F.expr("interval 5000 seconds")), "at", width=600)
    assert all(r.tradeId == -(-(r.at - dt.datetime(2024, 1, 1)).total_seconds() // 1000) * 1000 for r in between.collect()) and between.count() == 196


def test_carries_cross_empty_buckets_and_take_null_keys(spark):
    at = dt.datetime(2024, 1, 1)
    right = spark.createDataFrame([(None, at, 1, 5.0), ("A", at, 2, 7.0), ("A", at + dt.timedelta(hours=1), 3, None)], "sym string, time timestamp_ntz, o long, v double")
    left = spark.createDataFrame([(s, at + dt.timedelta(days=d)) for s in (None, "A", "B") for d in (-1, 0, 3)], "sym string, t timestamp_ntz")
    got = {(r.sym, (r.t - at).days): r.v for r in relational.asof(left, right, "sym", "t", "time", "v", "o").collect()}
    assert got == {(s, d): None if d < 0 or s == "B" else 5.0 if s is None else 7.0 for s in (None, "A", "B") for d in (-1, 0, 3)}


# stamps


def test_stamps_survive_a_crash_between_rows_and_block(spark, tmp_path, monkeypatch):
    for i in range(3):
        trades(spark, 10 + i).withColumn("fhSeqNo", F.col("tradeId") + 1000 * i).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = lambda: pipelines.file_source(spark, f"{tmp_path}/in/*", spark.read.parquet(f"{tmp_path}/in/0").schema, 1)
    run = lambda: pipelines.stamped_log(stream(), f"file:{tmp_path}/log", f"{tmp_path}/cp").awaitTermination()
    real, calls = spark.createDataFrame, []

    def fails(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*a, **k)

    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **k: fails(*a, **k))
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.undo()
    run()
    log = spark.read.parquet(f"{tmp_path}/log/rows")
    assert sorted(r.tpSeqNo for r in log.collect()) == list(range(1, 34))
    assert log.select("fhSeqNo").distinct().count() == 33 and log.where("tpRecvTime is null").count() == 0
    assert pipelines.reserved(spark, f"file:{tmp_path}/log", 99) == 33
    by_epoch = log.groupBy("epoch").agg(F.min("tpSeqNo").alias("lo"), F.max("tpSeqNo").alias("hi"), F.count("*").alias("n")).collect()
    assert all(r.hi - r.lo + 1 == r.n for r in by_epoch)


# end of day and retention


def test_end_of_day_goes_on_after_a_crash(spark, tmp_path, monkeypatch):
    store, spool = archives.Store(spark, f"file:{tmp_path}/hdb"), f"file:{tmp_path}/spool"
    for d in ("2024-01-01", "2024-01-02"):
        trades(spark, 10).withColumn("tpSeqNo", F.col("tradeId")).write.parquet(f"{spool}/trade/date={d}")
    real = archives.Store.delete

    def crash(self, path):
        raise OSError("crash")

    monkeypatch.setattr(archives.Store, "delete", crash)
    with pytest.raises(OSError, match="crash"):
        archives.end_of_day(store, spool, "trade", "2024-01-01")
    monkeypatch.setattr(archives.Store, "delete", real)
    assert archives.recover_orphans(store, spool, "trade", "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert store.load("trade").count() == 20 and not store.listed(f"{spool}/trade", "date=")
    trades(spark, 5).withColumn("tpSeqNo", F.col("tradeId")).write.parquet(f"{spool}/trade/date=2024-01-01")
    with pytest.raises(FileExistsError):
        archives.end_of_day(store, spool, "trade", "2024-01-01")


def test_retention_deletes(spark, tmp_path):
    store = archives.Store(spark, f"file:{tmp_path}/hdb")
    days = [trades(spark, 100).withColumn("time", F.col("time") + F.expr(f"interval {d} days")) for d in range(3)]
    for d in days:
        archives.write_dates(d, store.root, "trade", ts="time")
    assert archives.retain(store, "trade", dt.datetime(2024, 1, 2, 0, 1, 0), 0.5) == ["2024-01-01", "2024-01-02"]
    left = store.load("trade")
    assert store.dates("trade") == ["2024-01-02", "2024-01-03"] and left.count() == 70 + 100
    assert left.agg(F.min("time")).first()[0] == dt.datetime(2024, 1, 2, 0, 0, 30)


def test_files_are_read_by_range(spark, tmp_path):
    store = archives.Store(spark, f"file:{tmp_path}/hdb")
    archives.write_dates(trades(spark, 100), store.root, "trade", ts="time")
    plan = store.sizes("trade")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in re.search("ReadSchema: .*", plan)[0]
    assert store.sizes("trade").first().logicalMB > 0
    assert archives.logs(store, f"{store.root}/trade").first().state == "ok"


# subscriptions and health


def test_subscribers_come_and_go_between_batches(spark, tmp_path):
    desk = Desk(spark, f"file:{tmp_path}/desk", trades(spark, 1))
    desk.open("x", ["A"])
    with pytest.raises(AnalysisException):
        desk.open("bad", where="nothing > 1")
    listener, heard = pipelines.Health([], 0), []
    listener.calls.append(heard.append)
    spark.streams.addListener(listener)
    try:
        for i in range(3):
            trades(spark, 10).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
            stream = pipelines.file_source(spark, f"{tmp_path}/in/*", trades(spark, 1).schema)
            query = desk.start(stream, f"file:{tmp_path}/out", f"{tmp_path}/cp")
            query.awaitTermination()
            if i == 0:
                desk.open("y", where="price > 101 and sym = 'B'")
                desk.open("z", ["A", "B"])
            elif i == 1:
                desk.close("x")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    got = spark.read.parquet(f"{tmp_path}/out").groupBy("subscriber", "epoch").agg(F.count("*").alias("n"), F.count_if(F.col("sym") == "A").alias("a")).collect()
    many = trades(spark, 10).where("price > 101 and sym = 'B'").count()
    assert {(r.subscriber, r.epoch): (r.n, r.a) for r in got} == {("x", 0): (5, 5), ("x", 1): (5, 5), ("y", 1): (many, 0), ("y", 2): (many, 0), ("z", 1): (10, 5), ("z", 2): (10, 5)}
    (s,) = listener.seen.values()  # one query, started three times
    assert s["in"] == 30 == heard[-1]["msgsReceived"] and s["state"] == "disconnected" and heard[-1]["lastMsgTimeUtc"] is not None


# fetching


def test_pages_are_fetched_in_tasks(spark):
    def fetch(sym, at):
        import os

        first = max(at, 1_700_000_000_000)
        times = [t for t in range(first - first % 1000, 1_700_000_000_000 + 2_500_000, 1000) if t >= at][:1000]
        return [{"symbol": sym, "fundingRate": "0.0001", "fundingTime": t, "markPrice": os.getpid()} for t in times]

    symbols = [f"S{i}" for i in range(20)]
    got = archives.fetch_new(None, symbols, fetch, spark)
    assert got.rdd.getNumPartitions() >= 1 and {r.n for r in got.groupBy("sym").agg(F.count("*").alias("n")).collect()} == {2500}
    import os

    assert got.where(F.col("markPrice") == os.getpid()).count() == 0  # never on the driver
    stored = got.where("fundingTime < timestamp_millis(1700000001000)").persist()
    assert archives.fetch_new(stored, symbols, fetch, spark).count() == 20 * 2500


# bars


def test_saved_bars_go_on_where_they_stopped(spark, tmp_path):
    t = hot(spark, 30_000).withColumn("buyerIsMaker", F.pmod(F.xxhash64("tradeId"), F.lit(2)) == 0).withColumn("time", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, tradeId * 8)"))
    ticks = bars.ticks(t)
    on = lambda a, b: ticks.where(F.to_date("time").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
    for kind in ("dib", "rwdib"):
        _, state = bars.warmup(on("2024-01-01", "2024-01-01"), kind, 40.0)
        whole = bars.adaptive(on("2024-01-02", "2024-01-03"), state, kind)
        first = bars.adaptive_marks(on("2024-01-02", "2024-01-02"), state, kind)
        bars.save(bars.closed_bars(on("2024-01-02", "2024-01-02"), first, kind), bars.resumed(first, state), f"file:{tmp_path}/{kind}")
        made, state = bars.load(spark, f"file:{tmp_path}/{kind}")
        rest = bars.adaptive(on("2024-01-03", "2024-01-03"), state, kind)
        assert sorted(map(json.dumps, (r.asDict() for r in made.unionByName(rest).drop("barstart", "barend").collect()))) == sorted(map(json.dumps, (r.asDict() for r in whole.drop("barstart", "barend").select(*made.drop("barstart", "barend").columns).collect())))
        assert whole.count() > 10
