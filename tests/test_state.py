"""State of streams: days that end, and reading the state of a running query."""

import datetime as dt
import pickle
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import kernels
from tidemark.operators.scan import ordered_scan
from tidemark.streaming import pipelines, stateful

T = "time timestamp_ntz, sym string, tradeId long, price double, qty double, buyerIsMaker boolean"


def trades(spark, day, first, n):
    rng = random.Random(first)
    at = dt.datetime(2024, 1, day, 9)
    return spark.createDataFrame([(at + dt.timedelta(seconds=20 * i), "AB"[i % 2], first + i, 100 + rng.randrange(50) / 10, 1.0 + rng.randrange(9), i % 3 == 0) for i in range(n)], T)


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    """Two days of trades in three files through online_bars by day: (output, checkpoint, trades)."""
    root = tmp_path_factory.mktemp("days")
    parts = [trades(spark, 1, 0, 300), trades(spark, 1, 300, 200).withColumn("time", F.col("time") + F.expr("interval 3 hours")), trades(spark, 2, 500, 400)]
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(f"{root}/in/{i}")
    files = pipelines.file_source(spark, f"{root}/in/*", parts[0].schema, 1)
    out = stateful.stream_days(files, ["sym"], ["tradeId"], kernels.online_bars(4000.0), kernels.ONLINE_SCHEMA)
    out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out"), f"{root}/cp", parts[0].unionByName(parts[1]).unionByName(parts[2])


def batch(t, day):
    one = t.where(F.to_date("time") == F.lit(f"2024-01-0{day}").cast("date"))
    return ordered_scan(one, ["sym"], ["tradeId"], kernels.online_bars(4000.0), kernels.ONLINE_SCHEMA)


def test_days_of_a_stream_equal_the_batch(streamed):
    out, _, t = streamed
    want = batch(t, 1).unionByName(batch(t, 2))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect())) and out.count() > 5


def test_state_ends_with_its_day_and_can_be_read(spark, streamed):
    _, checkpoint, t = streamed
    states = stateful.day_states(spark, checkpoint).collect()
    assert sorted((r.sym, r.day, r.ticks) for r in states) == [("A", dt.date(2024, 1, 2), 200), ("B", dt.date(2024, 1, 2), 200)]
    pdf = t.where("sym = 'A' and tradeId >= 500").orderBy("tradeId").toPandas()
    _, state = kernels.online_bars(4000.0)(None, pdf)
    got = stateful.online_status(spark, checkpoint).where("sym = 'A'").first()
    th = max(state["th"], 1000.0)
    assert (got.barTicks, got.theta, got.maxRun, got.position, got.imbalRatio) == (state["n"], state["theta"], state["run"], state["position"], state["ratio"])
    assert (got.threshold, got.pctToBar, got.runPct) == (th, 100 * abs(state["theta"]) / th, 100 * state["run"] / th)


def test_a_key_is_held_by_its_days_and_scanned_in_chunks(spark, tmp_path):
    """One symbol, two days of 12,000 rows in one batch: a kernel's call sees one day, in order, and at most
    CHUNK rows; a row without a time belongs to no day."""
    at = F.timestamp_seconds(F.lit(1_704_067_200) + (F.lit(23_999) - F.col("id")) * F.lit(7.2))
    t = spark.range(24_000).select(F.when(F.col("id") != 5, at).cast("timestamp_ntz").alias("time"), F.lit("A").alias("sym"), F.col("id").alias("tradeId"))
    t.coalesce(1).write.parquet(f"{tmp_path}/in")

    def calls(state, pdf):
        first = (state or {"last": -1})["last"] < pdf["tradeId"].iloc[0] and pdf["tradeId"].is_monotonic_increasing
        return pdf[["tradeId"]].assign(rows=len(pdf), days=pdf["time"].dt.date.nunique(), ordered=first), {"last": int(pdf["tradeId"].iloc[-1])}

    out = stateful.stream_days(pipelines.file_source(spark, f"{tmp_path}/in", t.schema), ["sym"], ["tradeId"], calls, "tradeId long, rows long, days long, ordered boolean")
    out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.tradeId for r in got.collect()) == [i for i in range(24_000) if i != 5]
    assert got.agg(F.max("rows"), F.max("days"), F.bool_and("ordered")).first() == (10_000, 1, True)
    assert [tuple(r)[:3] for r in stateful.day_states(spark, f"{tmp_path}/cp").collect()] == [("A", dt.date(2024, 1, 2), 11_999)]


@pytest.mark.parametrize("arrival", ["mixed", "in order", "backwards"])
def test_a_group_of_any_length_is_sorted_in_bounded_memory(monkeypatch, arrival):
    """30,000 rows where 2,500 are sorted at a time, with ties, nulls and texts: the rows of one stable sort, in
    calls of at most CHUNK, and never near all of them in memory."""
    for name, value in (("CHUNK", 700), ("RUN", 2_500), ("FAN", 4), ("PIECE", 500)):
        monkeypatch.setattr(stateful, name, value, raising=False)
    rng = np.random.default_rng(5)
    n = 30_000
    whole = pd.DataFrame({"at": pd.to_datetime(rng.integers(0, n // 20, n), unit="s", utc=True), "id": rng.integers(0, 30, n).astype(float), "nth": range(n), "name": rng.choice(["a", "b", None], n), "pay": rng.random(n)})
    whole.loc[rng.choice(n, 500, replace=False), "id"] = np.nan
    want = whole.sort_values(["at", "id"], kind="stable", ignore_index=True)
    if arrival != "mixed":
        whole = want if arrival == "in order" else want.iloc[::-1].reset_index(drop=True)
        want = whole.sort_values(["at", "id"], kind="stable", ignore_index=True)
    arrow = pa.Table.from_pandas(whole)
    tracemalloc.start()
    got = ((len(p), pickle.dumps(p["nth"].to_numpy())) for p in stateful._in_order((b.to_pandas() for b in arrow.to_batches(900)), ["at", "id"]))
    sizes, nth = zip(*got, strict=True)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert np.array_equal(np.concatenate([pickle.loads(x) for x in nth]), want["nth"]) and 0 < min(sizes) <= max(sizes) <= 700
    assert peak < whole.memory_usage(index=False).sum()
    parts = list(stateful._in_order((b.to_pandas() for b in arrow.to_batches(900)), ["at", "id"]))
    pd.testing.assert_frame_equal(pd.concat(parts, ignore_index=True), want)
    assert not list(stateful._in_order(iter([whole.head(0)]), ["at"])) and not list(stateful._in_order(iter([]), ["at"]))
