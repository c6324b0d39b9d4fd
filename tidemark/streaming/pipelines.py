"""Structured Streaming jobs: durable log, windows, deduplication, micro-batched fan-out."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from ..functions.semantics import exact_sum


def file_source(spark: SparkSession, path: str, schema: StructType, per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", per_trigger) if per_trigger else r).parquet(path)


def durable_log(stream: DataFrame, path: str, checkpoint: str, order: str = "tpSeqNo") -> StreamingQuery:
    """Appends the stream to a log by date; after a restart it goes on from its checkpoint, each
    row written once.  Health rows have their own stream and never come here."""
    out = stream.withColumn("date", F.to_date("time"))
    return out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("date").trigger(availableNow=True).start()


def recovered_sequence(log: DataFrame, side: str = "side") -> DataFrame:
    """By side the last sequence numbers that the log holds."""
    return log.groupBy(side).agg(F.max("tpSeqNo").alias("tpSeqNo"), F.max("fhSeqNo").alias("fhSeqNo"))


def stamped_log(stream: DataFrame, path: str, checkpoint: str, order: tuple[str, ...] = ("time", "fhSeqNo"), every: str | None = None) -> StreamingQuery:
    """Appends the stream to a log under one global sequence number tpSeqNo, from 1 without gaps, and
    tpRecvTime, the time of the batch.

    A batch takes a block of numbers: it begins after those of the batches before it, which path/blocks
    holds, and is written to path/rows/epoch=... with its block last.  A batch that is run again after a
    crash takes the same block and replaces what it wrote; blocks of later epochs never count.  Rows are
    numbered by minute and the minutes' counts run through, so no task sees all."""
    spark = stream.sparkSession

    def each(batch: DataFrame, epoch: int) -> None:
        rows, at = batch.withColumn("minute_", F.date_trunc("minute", F.col(order[0]))).persist(), datetime.now(UTC)
        sizes = rows.groupBy("minute_").agg(F.count("*").alias("n_"))
        base = reserved(spark, path, epoch)
        before = sizes.select(F.col("minute_").alias("of_"), (F.sum("n_").over(Window.orderBy("minute_")) - F.col("n_") + base).alias("before_"))
        nth = F.row_number().over(Window.partitionBy("minute_").orderBy(*order))
        out = rows.withColumn("nth_", nth).join(before, F.col("minute_").eqNullSafe(F.col("of_"))).withColumn("tpSeqNo", F.col("before_") + F.col("nth_")).withColumn("tpRecvTime", F.lit(at))
        out.drop("minute_", "of_", "before_", "nth_").write.mode("overwrite").parquet(f"{path}/rows/epoch={epoch}")
        spark.createDataFrame([(base, rows.count())], "base long, n long").write.mode("overwrite").parquet(f"{path}/blocks/epoch={epoch}")
        rows.unpersist()

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def reserved(spark: SparkSession, path: str, epoch: int) -> int:
    """The last number that the batches before ``epoch`` have taken, 0 if none has."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/blocks")
    fs = p.getFileSystem(conf)
    done = [int(s.getPath().getName().removeprefix("epoch=")) for s in fs.listStatus(p)] if fs.exists(p) else []
    last = max((e for e in done if e < epoch), default=None)
    if last is None:
        return 0
    block = spark.read.parquet(f"{path}/blocks/epoch={last}").first()
    return block.base + block.n


def deduplicated(stream: DataFrame, key: list[str], lateness: str = "10 minutes") -> DataFrame:
    return stream.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", lateness).dropDuplicatesWithinWatermark(key)


def windowed_summary(stream: DataFrame, interval: str, lateness: str = "10 minutes") -> DataFrame:
    """Trades, volume and last price by symbol and event-time window; rows later than the watermark
    are dropped.  ``time`` is cast to a zoned timestamp, which watermarks need."""
    t = stream.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", lateness)
    g = t.groupBy("sym", F.window("time", interval)).agg(F.count("*").alias("trades"), exact_sum(F.col("qty")).alias("volume"), F.max_by("price", "tradeId").alias("lastPrice"))
    return g.select("sym", F.col("window.start").alias("bucket"), "trades", "volume", "lastPrice")


def fan_out(stream: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Each micro-batch, read once, goes to all sinks."""

    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        for sink in sinks.values():
            sink(batch, epoch)
        batch.unpersist()

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


class Health(StreamingQueryListener):
    """Health rows (schemas.HEALTH) of queries from all their progress, counted as it comes, since Spark
    keeps the last reports only: messages read and written so far and the times of the last batches
    that had any.  ``calls`` get each query's row after a batch, at most once in ``every`` seconds."""

    def __init__(self, calls: list[Callable[[dict], None]] | None = None, every: float = 0.0) -> None:
        self.calls, self.every, self.seen = calls or [], every, {}

    def onQueryStarted(self, event) -> None:
        s = self.seen.setdefault(str(event.id), {"in": 0, "out": 0, "lastIn": None, "lastOut": None, "called": None})  # a restart goes on counting
        s |= {"start": datetime.now(UTC), "state": "connected", "name": event.name or str(event.id)}

    def onQueryProgress(self, event) -> None:
        p, s = event.progress, self.seen.get(str(event.progress.id))
        if s is None:
            return
        for got, n, at in ((p.numInputRows, "in", "lastIn"), (p.sink.numOutputRows, "out", "lastOut")):
            if got and got > 0:
                s[n], s[at] = s[n] + got, p.timestamp
        now = datetime.now(UTC)
        if self.calls and (s["called"] is None or (now - s["called"]).total_seconds() >= self.every):
            s["called"] = now
            for call in self.calls:
                call(self.row(str(p.id)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) in self.seen:
            self.seen[str(event.id)]["state"] = "degraded" if event.exception else "disconnected"

    def row(self, query_id: str, handler: str | None = None, symbols: int = 0) -> dict:
        s, at = self.seen[query_id], datetime.now(UTC)
        return {
            "time": at, "handler": handler or s["name"], "startTimeUtc": s["start"], "uptimeSec": int((at - s["start"]).total_seconds()), "msgsReceived": s["in"], "msgsPublished": s["out"],
            "lastMsgTimeUtc": s["lastIn"], "lastPubTimeUtc": s["lastOut"], "connState": s["state"], "symbolCount": symbols,
        }


def health(query: StreamingQuery, handler: str, started: datetime, symbols: int = 0) -> dict:
    """The health row (schemas.HEALTH) of a query from its progress: messages are rows read and
    written so far as progress is kept, times those of the batches that had any."""
    seen = query.recentProgress
    last = lambda n: max((p["timestamp"] for p in seen if (p.get(n) if n in p else p["sink"].get(n) or 0) > 0), default=None)
    at = datetime.now(UTC)
    return {
        "time": at, "handler": handler, "startTimeUtc": started, "uptimeSec": int((at - started).total_seconds()),
        "msgsReceived": sum(int(p.get("numInputRows") or 0) for p in seen), "msgsPublished": sum(max(0, int(p["sink"].get("numOutputRows") or 0)) for p in seen),
        "lastMsgTimeUtc": last("numInputRows"), "lastPubTimeUtc": last("numOutputRows"), "connState": "connected" if query.isActive else "degraded" if query.exception() else "disconnected", "symbolCount": symbols,
    }


def routed(stream: DataFrame, table: str = "table") -> tuple[DataFrame, DataFrame]:
    """(rows for the sequence check and the log, health rows, which pass both by)."""
    return stream.where(F.col(table) != "health"), stream.where(F.col(table) == "health")
