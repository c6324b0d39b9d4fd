"""Filtered subscriptions: symbols, a condition and a list of columns, checked before use; and a desk of
subscribers who come and go while a stream runs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Subscription:
    symbols: list[str] = field(default_factory=list)
    where: str | None = None
    columns: list[str] = field(default_factory=list)

    def apply(self, df: DataFrame) -> DataFrame:
        """The subscribed rows of a batch or stream; a condition or column that does not fit the
        schema raises an AnalysisException here."""
        out = df.where(F.col("sym").isin(self.symbols)) if self.symbols else df
        out = out.where(F.expr(self.where)) if self.where else out
        return out.selectExpr(*self.columns) if self.columns else out

    def check(self, df: DataFrame) -> None:
        self.apply(df.limit(0)).schema  # noqa: B018  analysis happens here

    def start(self, stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet"):
        return self.apply(stream).writeStream.format(fmt).option("checkpointLocation", checkpoint).option("path", sink).trigger(availableNow=True).start()


_ENTRY = "subscriber string, sym string, condition string, active boolean, seq long"


class Desk:
    """Subscribers of a running stream.  A log of who asked for which symbols (null for all) under which
    condition, and who closed, is read anew for each micro-batch and joined with it, so a subscriber
    who opens or closes does so from the next batch on.  The log is a control table of few rows."""

    def __init__(self, spark: SparkSession, path: str, sample: DataFrame) -> None:
        self.spark, self.path, self.sample = spark, path.rstrip("/"), sample.limit(0)
        self._put([], 0)

    def _put(self, rows: list[tuple], seq: int | None = None) -> None:
        seq = self.log().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0] + 1 if seq is None else seq
        self.spark.createDataFrame([(*r, seq) for r in rows], _ENTRY).coalesce(1).write.mode("append").parquet(self.path)

    def log(self) -> DataFrame:
        return self.spark.read.schema(_ENTRY).parquet(self.path)

    def open(self, subscriber: str, symbols: list[str] | None = None, where: str | None = None) -> None:
        """Takes the place of what the subscriber had; a condition that does not fit raises here."""
        Subscription(where=where).check(self.sample)
        self.close(subscriber)
        self._put([(subscriber, s, where, True) for s in (symbols or [None])])

    def close(self, subscriber: str) -> None:
        self._put([(subscriber, None, None, False)])

    def active(self) -> DataFrame:
        """subscriber, sym, condition in force."""
        log = self.log()
        closed = log.where("not active").groupBy("subscriber").agg(F.max("seq").alias("closed"))
        return log.where("active").join(F.broadcast(closed), "subscriber", "left").where("closed is null or seq > closed").select("subscriber", "sym", "condition")

    def routed(self, rows: DataFrame) -> DataFrame:
        """rows with ``subscriber``, once for each who gets them."""
        asked = self.active()
        conditions = [r.condition for r in asked.where("condition is not null").select("condition").distinct().collect()]
        name = lambda c: F.col("asked_").getField(c)
        met = rows.withColumn("sym_", F.col("sym")).join(F.broadcast(asked.select(F.struct("subscriber", "sym", "condition").alias("asked_"))), name("sym").isNull() | (name("sym") == F.col("sym_")))
        fits = name("condition").isNull()
        for c in conditions:
            fits = fits | ((name("condition") == c) & F.expr(f"({c})"))
        return met.where(fits).withColumn("subscriber", name("subscriber")).drop("asked_", "sym_").dropDuplicates()

    def start(self, stream: DataFrame, out: str, checkpoint: str, every: str | None = None):
        """Each micro-batch to out/subscriber=.../epoch=..., written anew if the batch runs again."""

        def each(batch: DataFrame, epoch: int) -> None:
            routed = self.routed(batch).withColumn("epoch", F.lit(epoch))
            routed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("subscriber", "epoch").parquet(out)

        w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
