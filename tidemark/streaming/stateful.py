"""The ordered-scan kernels over streams: the same functions, state in Spark's state store.

stream_scan() keeps a key's state for good.  stream_days() keeps it by key and UTC day, in a value of the
state store that can be read from outside, and drops a day when the watermark has passed its midnight.
"""

from __future__ import annotations

import json
import pickle
import tempfile
from collections.abc import Iterator
from contextlib import suppress
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.kernels import ONLINE_STATE
from ..operators.scan import Kernel


#: Rows of a kernel's call; rows sorted in memory; sorted runs merged at a time, and rows read of one at a time.
CHUNK, RUN, FAN, PIECE = 10_000, 250_000, 25, 5_000


def _order_of(rows: pd.DataFrame, order: list[str]) -> np.ndarray:
    return rows[order].reset_index(drop=True).sort_values(order, kind="stable").index.to_numpy()


class _Run:
    """Sorted rows in a temporary file, which goes with the object; level: how often they were merged."""

    def __init__(self, level: int = 0) -> None:
        self.level, self.file, self.last = level, tempfile.TemporaryFile(), None

    def add(self, rows: pd.DataFrame) -> None:
        for i in range(0, len(rows), PIECE):
            pickle.dump(rows.iloc[i : i + PIECE], self.file, pickle.HIGHEST_PROTOCOL)
        self.last = rows.tail(1).copy()

    def __iter__(self) -> Iterator[pd.DataFrame]:
        self.file.seek(0)
        with suppress(EOFError):
            while True:
                yield pickle.load(self.file)


def _merged(runs: list[_Run], order: list[str]) -> Iterator[pd.DataFrame]:
    """The runs' rows in order, ties in the order of the runs.  What sorts up to the first of the last rows held
    of the runs goes out, since nothing that is still to be read comes before it."""
    parts = [iter(r) for r in runs]
    heads = [next(p) for p in parts]
    while True:
        heads = [pd.concat([h, *islice(p, 1)], ignore_index=True) if len(h) < PIECE else h for h, p in zip(heads, parts, strict=True)]
        parts, heads = [p for p, h in zip(parts, heads, strict=True) if len(h)], [h for h in heads if len(h)]
        if not parts:
            return
        whole, ends = pd.concat(heads, ignore_index=True), np.cumsum([len(h) for h in heads])
        at = _order_of(whole, order)
        place = np.empty_like(at)
        place[at] = np.arange(len(at))
        cut = place[ends - 1].min() + 1
        yield whole.take(at[:cut])
        rest = np.sort(at[cut:])
        heads = [whole.take(x) for x in np.split(rest, np.searchsorted(rest, ends[:-1]))]


def _join_last(runs: list[_Run], order: list[str]) -> None:
    one = _Run(runs[-1].level + 1)
    for block in _merged(runs[-FAN:], order):
        one.add(block)
    runs[-FAN:] = [one]


def _put(runs: list[_Run], held: list[pd.DataFrame], order: list[str]) -> None:
    """Sorts the frames and writes them behind the last run if they begin where it ends or later, else as a new
    run; the last FAN runs of one level become one of the next."""
    rows = pd.concat(held, ignore_index=True)
    rows = rows.take(_order_of(rows, order))
    if not runs or _order_of(pd.concat([runs[-1].last, rows.head(1)]), order)[0] == 1:
        while len(runs) >= FAN and runs[-FAN].level == runs[-1].level:
            _join_last(runs, order)
        runs.append(_Run())
    runs[-1].add(rows)


def _in_order(frames: Iterator[pd.DataFrame], order: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of all frames in order, at most CHUNK at a time.  Spark sorts a stream's rows by key but nothing
    within a key, so more than RUN rows are sorted in runs, written to temporary files and merged: however many
    there are, a few times RUN are held."""
    runs, held, n = [], [], 0
    for f in frames:
        held.append(f)
        n += len(f)
        if n >= RUN:
            _put(runs, held, order)
            held, n = [], 0
    if n and runs:
        _put(runs, held, order)
    elif n:
        whole = pd.concat([f for f in held if len(f)], ignore_index=True)
        runs = [[whole.take(_order_of(whole, order))]]
        del whole
    held.clear()
    while len(runs) > FAN:
        _join_last(runs, order)
    for block in runs[0] if len(runs) == 1 else _merged(runs, order) if runs else ():
        for i in range(0, len(block), CHUNK):
            yield block.iloc[i : i + CHUNK].reset_index(drop=True)


def stream_scan(stream: DataFrame, keys: list[str], order: list[str], kernel: Kernel, schema: str) -> DataFrame:
    """kernel over each key's rows of a stream.  Within a micro-batch rows are taken in ``order``;
    between batches in order of arrival, as a live process sees them.  The result must be written in
    append mode.  Key by (sym, date) for state that starts anew each day."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept, any_ = pickle.loads(state.get[0]) if state.exists else None, False
        for part in _in_order(frames, order):
            out, kept = kernel(kept, part)
            any_ = True
            yield out
        if any_:
            state.update((pickle.dumps(kept),))

    return stream.groupBy(*keys).applyInPandasWithState(run, schema, "state binary", "append", GroupStateTimeout.NoTimeout)


DAY, DAY_MS = "day_", 86_400_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Days(StatefulProcessor):
    """A kernel whose state begins anew each UTC day.  The key's last column is the day (days since 1970); its
    value is the state as JSON and the ticks so far, and a timer at the day's end removes it."""

    def __init__(self, kernel: Kernel, order: list[str]) -> None:
        self.kernel, self.order = kernel, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "state string, ticks long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.held.get() if self.held.exists() else None
        state, ticks = (json.loads(held[0]), held[1]) if held else (None, 0)
        for part in _in_order(rows, self.order):
            out, state = self.kernel(state, part.drop(columns=DAY))
            ticks += len(part)
            yield out
        if state is None:
            return
        if held is None:
            self.handle.registerTimer((int(key[-1]) + 1) * DAY_MS)
        self.held.update((json.dumps(state, default=lambda x: x.item()), ticks))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_days(stream: DataFrame, keys: list[str], order: list[str], kernel: Kernel, schema: str, lateness: str = "10 minutes", time: str = "time") -> DataFrame:
    """kernel over each key's rows of a stream, by UTC day.  Within a micro-batch rows are taken in ``order``.

    The day belongs to the key, so days of a hot key are dealt out; a day's length in a micro-batch needs disk
    (see _in_order), not memory.  A day's state goes when the watermark (``lateness`` behind the latest ``time``) has passed its midnight;
    later rows of that day are dropped as late.  The kernel's state must be JSON.  Sets the session's
    state store to RocksDB, which this needs.  The result is written in append mode."""
    stream.sparkSession.conf.set(_PROVIDER, _ROCKSDB)
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    timed = timed.withColumn(DAY, F.floor(F.unix_millis(F.col(time)) / DAY_MS)).where(F.col(DAY).isNotNull())
    return timed.groupBy(*keys, DAY).transformWithStateInPandas(_Days(kernel, order), schema, "Append", "EventTime")


def day_states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The key's columns, day, ticks and the state (JSON) that stream_days holds after its last batch, read
    from the query's checkpoint; nothing runs in the query for it."""
    raw = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "held").load()
    return raw.select("key.*", F.date_from_unix_date(F.col(f"key.{DAY}").cast("int")).alias("day"), "value.ticks", "value.state").drop(DAY)


def online_status(spark: SparkSession, checkpoint: str, floor: float = 1_000.0) -> DataFrame:
    """How far the open bars of online_bars under stream_days are: by key and day the ticks, dollars, imbalance,
    threshold in force, longest run, both in percent of the threshold, position, and what adapts."""
    s = day_states(spark, checkpoint).withColumn("s", F.from_json("state", ONLINE_STATE)).drop("state")
    th = F.greatest("s.th", F.lit(floor))
    return s.select(
        *[c for c in s.columns if c != "s"], F.col("s.n").alias("barTicks"), F.col("s.usd").alias("dollarVol"), F.col("s.theta").alias("theta"), F.abs("s.theta").alias("thetaAbs"), th.alias("threshold"),
        (100 * F.abs("s.theta") / th).alias("pctToBar"), F.col("s.run").alias("maxRun"), (100 * F.col("s.run") / th).alias("runPct"), F.col("s.position").alias("position"), F.col("s.ratio").alias("imbalRatio"),
    )
