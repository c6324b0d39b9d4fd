"""Mixing sources to target weights.

Words are packed, source by source, into blocks of fixed length.  Output shards hold a fixed
number of slots; each shard draws how many of its slots each source fills from the multinomial
distribution of the targets.  The j-th slot of a source takes block pi(j mod blocks), pi being a
pseudorandom permutation that the source and the pass name, and slots meet blocks by a join on the
block's index.  Draws beyond a source's quota are dealt on, slot by slot, to sources short of
theirs, so that sources meet their targets to a block and no block is taken more than twice.

Scale.  Documents are placed within their source by two-level running sums (no window over a whole
source).  Only the table of sources, of MAX_SOURCES rows at most, passes through the driver; a shard's
draw looks each of its slots up in the sources' running shares, so its cost grows with the slots.
"""

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType
from pyspark.sql.window import Window

from .common import fresh, matching, row_key, running, staged
from .permutation import permuted

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Words of a block, slots of an output shard; sources beyond MAX_SOURCES raise an error.
BLOCK, SLOTS, MAX_SOURCES = 128, 512, 1_000_000
ROWS_PER_BUCKET = 20_000
#: Slots that a task should permute.
SLOTS_PER_TASK = 50_000


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST) -> list[float]:
    """Shares total by weight; what lies above ``most`` times a source's size is shared again."""
    out, open_, left = [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n > 0], float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight >= most * sizes[i]]
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else left * weights[i] / weight
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _key() -> F.Column:
    """What decides a row's place: rows equal in id and text lie elsewhere if their source differs."""
    return F.xxhash64(row_key(), F.col("source").cast("string"), F.col("source").isNull())


def _sizes(batches):
    for b in batches:
        n = [len(t.split()) if t else 0 for t in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), b.column("row_key"), pa.array(n, pa.int64())], names=["doc_id", "source", "row_key", "size"])


def _plan(docs: DataFrame, seed: int) -> tuple[DataFrame, list[dict]]:
    """Documents with their source's number, target and their place (words before) in it; sources."""
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _key().alias("row_key"), F.col("text").cast("string").alias("text"))
    light = staged(light.mapInArrow(_sizes, "doc_id long, source string, row_key long, size long"), "mix-sizes")
    found = light.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found = sorted(found, key=lambda r: (r.source is None, r.source or ""))
    aims = targets([r["size"] for r in found], [WEIGHTS[i % len(WEIGHTS)] for i in range(len(found))], SHARE * sum(r["size"] for r in found))
    sources = []
    for i, (r, aim) in enumerate(zip(found, aims, strict=True)):
        blocks = -(-r["size"] // BLOCK)
        sources.append({"sid": i, "source": r.source, "source_size": r["size"], "target": aim, "blocks": blocks, "quota": min(MOST * blocks, round(aim * blocks / r["size"])) if blocks else 0, "buckets": -(-r["docs"] // ROWS_PER_BUCKET)})
    spark = docs.sparkSession
    table = spark.createDataFrame([tuple(s.values()) for s in sources], "sid int, source2 string, source_size long, target double, blocks long, quota long, buckets int")
    rows = light.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("source2"))).drop("source2")
    order = F.xxhash64(F.lit(seed), "row_key")
    placed = running(rows, "sid", F.pmod(F.xxhash64(F.lit(seed + 1), "row_key"), F.col("buckets")).cast("int"), [order, F.col("row_key")], F.col("size"), "start")
    return staged(placed, "mix-places"), sources


def _slots(docs: DataFrame, sources: list[dict], seed: int) -> DataFrame:
    """shard, sid, slot (0 .. quota - 1 of the source) of every slot of the output."""
    spark = docs.sparkSession
    quota = np.array([s["quota"] for s in sources], np.int64)
    total = int(quota.sum())
    shards, upto = -(-total // SLOTS), np.cumsum(quota)

    def draw(frames):
        for f in frames:
            for shard in f["id"]:
                # Independent slots are counted: the multinomial distribution of the quotas.
                slots = np.random.default_rng([seed, int(shard)]).integers(total, size=min(SLOTS, total - int(shard) * SLOTS))
                at, n = np.unique(np.searchsorted(upto, slots, side="right"), return_counts=True)
                yield pd.DataFrame({"shard": np.int64(shard), "sid": at.astype(np.int32), "n": n})

    drawn = staged(spark.range(shards).mapInPandas(draw, "shard long, sid int, n long"), "mix-draws")
    drawn = running(drawn, "sid", F.floor(F.col("shard") / ROWS_PER_BUCKET), [F.col("shard")], F.col("n"), "first")
    each = np.zeros(len(sources), np.int64)
    for r in drawn.groupBy("sid").agg(F.sum("n").alias("n")).collect():  # at most MAX_SOURCES rows
        each[r.sid] = r.n
    short = np.maximum(quota - each, 0)
    ends = np.cumsum(short)
    limits = spark.createDataFrame([(s["sid"], s["quota"]) for s in sources], "sid2 int, quota long")
    drawn = drawn.join(F.broadcast(limits), F.col("sid") == F.col("sid2")).drop("sid2")
    kept = drawn.withColumn("n", F.least("n", F.greatest(F.col("quota") - F.col("first"), F.lit(0)))).where("n > 0").select("shard", "sid", "first", "n")
    over = drawn.withColumn("n", F.col("n") - F.greatest(F.least("n", F.col("quota") - F.col("first")), F.lit(0).cast("long"))).where("n > 0").groupBy("shard").agg(F.sum("n").alias("n"))
    over = running(over.withColumn("all", F.lit(0)), "all", F.floor(F.col("shard") / ROWS_PER_BUCKET), [F.col("shard")], F.col("n"), "first").select("shard", "first", "n")

    def deal(frames):
        for f in frames:
            rows = []
            for shard, first, n in zip(f["shard"], f["first"], f["n"], strict=True):
                while n > 0:
                    sid = int(np.searchsorted(ends, first, side="right"))
                    m = min(n, int(ends[sid]) - first)
                    rows.append((shard, sid, int(quota[sid] - (ends[sid] - first)), m))
                    first, n = first + m, n - m
            yield pd.DataFrame(rows, columns=["shard", "sid", "first", "n"])

    # A run is a few hundred slots at most; they are dealt out evenly before they become rows.
    runs = kept.unionByName(over.mapInPandas(deal, "shard long, sid int, first long, n long")).repartition(max(1, -(-total // SLOTS_PER_TASK)), "shard", "sid")
    return runs.select("shard", "sid", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot"))


def takes(docs: DataFrame, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """The documents' places (see _plan) and, for each piece of a block that the mix takes: sid,
    start (together they name the document), pass, shard, and the words from .. to of the document."""
    places, sources = _plan(docs, seed)
    slots = _slots(docs, sources, seed)
    blocks = docs.sparkSession.createDataFrame([(s["sid"], s["blocks"]) for s in sources], "sid2 int, blocks long")
    slots = slots.join(F.broadcast(blocks), F.col("sid") == F.col("sid2")).select(F.col("shard"), F.col("sid"), F.expr("slot % blocks").alias("nth"), F.expr("slot div blocks").alias("pass"), "blocks")
    taken = slots.select("shard", "sid", "pass", permuted("nth", "blocks", f"{seed}, sid, pass").alias("block"))
    pieces = places.where("size > 0").select("sid", "start", "size", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}"))).alias("block"))
    met = pieces.join(taken, ["sid", "block"])
    at = F.col("block") * BLOCK - F.col("start")
    return places, met.select("sid", "start", "pass", "shard", F.greatest(at, F.lit(0)).alias("from"), F.least(at + BLOCK, F.col("size")).alias("to"))


def mixture(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, source, size, source_size, target and
    taken, the words that the mix takes of it with repeats.

    Sources sort by code point, null, a source of its own, last.  Null and blank texts have size 0
    and are never taken; a source of size 0 has target 0; repeated rows are placed one by one; an
    empty table gives no rows.
    """
    places, pieces = takes(docs)
    sums = pieces.groupBy("sid", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    out = places.join(sums.select(F.col("sid").alias("sid2"), F.col("start").alias("start2"), "taken"), (F.col("sid") == F.col("sid2")) & (F.col("start") == F.col("start2")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


_WORD = re.compile(rb"[^\x20\t-\r]+")


def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The words from .. to of each span with the white space that follows them, joined; a span's
    last white space goes where the text goes on elsewhere."""
    at = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    out: list[bytes] = []
    for a, b in spans:
        out.append(raw[at[a] : at[b]])
    return b"".join(x if x[-1:].isspace() or i == len(out) - 1 else x + b" " for i, x in enumerate(out)).rstrip() if out else b""


def mix(docs: DataFrame) -> DataFrame:
    """docs as the mix takes them: for each document a row for each pass that takes words of it,
    text cut to those words, n_chars (if docs has it) counted anew, all other columns as they were.
    Odd rows are as in mixture(); rows that repeat id, text and source share their places among
    them by their other columns."""
    key, nth, spans, go = (fresh(docs, x) for x in ("key_", "nth_", "spans_", "pass_"))
    places, pieces = takes(docs)
    runs = pieces.groupBy("sid", "start", "pass").agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias(spans))
    plan = places.where("size > 0").withColumn(nth, F.row_number().over(Window.partitionBy("row_key").orderBy("sid", "start"))).join(runs, ["sid", "start"]).select(F.col("row_key").alias(key), nth, F.col("pass").alias(go), spans)
    twice = staged(places.groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("row_key").alias(key)), "mix-repeated")
    keyed, first = docs.withColumn(key, _key()), F.lit(1)
    rows = matching(keyed, twice, key, "left_anti").withColumn(nth, first)
    if twice.limit(1).count():
        order = F.xxhash64(*(c.name for c in docs.schema.fields if not isinstance(c.dataType, (MapType, VariantType))))
        rows = rows.unionByName(matching(keyed, twice, key).withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(order))))
    rows = rows.join(plan, [key, nth])
    names = docs.columns

    def slices(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            parts = b.column(spans).to_pylist()
            new = [cut(t, [(s["from"], s["to"]) for s in p]).decode("utf-8", "replace") for t, p in zip(texts, parts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if c == "text" else b.column(c) for c in names], names=names)

    out = rows.select(*names, spans).mapInArrow(slices, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
