"""Finding repeated hashes with packed exchanges.

A map task gathers the (hash, row key, position) triples of a batch of rows, with a second hash to
check the first by where false repeats must not be, drops all but one of a hash's triples within the flush (the others are known to repeat at once) and sends one row of
packed arrays to each hash bucket.  A bucket so gets at most one triple per hash and batch, however
hot a hash is, sorts them in numpy and sends the triples of repeated hashes on to buckets of row
keys, where positions are put together per row.  Spark partitions, shuffles and retries all of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct

#: Triples that a bucket should hold, some 20 bytes each.
PER_BUCKET = 1_000_000
_ROW = "bucket int, hashes binary, keys binary, places binary, checks binary"
#: Gives of batches of rows their hashes, keys, positions (uint64, int64, int32) and second hashes
#: (uint64, or none at all: then equal hashes are repeats), as many at once as a flush should have.
Emit = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]


def repeats(order: np.ndarray) -> np.ndarray:
    """Of a sorted array: whether the neighbour on either side is equal."""
    same = np.zeros(len(order), bool)
    if len(order) > 1:
        eq = order[1:] == order[:-1]
        same[1:] |= eq
        same[:-1] |= eq
    return same


def _split(bucket: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    """Rows of packed arrays by bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate([[0], cuts]) if len(bucket) else np.empty(0, int)
    sorted_ = [a[order] for a in arrays]
    for i, s in enumerate(starts):
        e = cuts[i] if i < len(cuts) else len(bucket)
        yield (int(bucket[s]), *(a[s:e].tobytes() for a in sorted_))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["bucket", "hashes", "keys", "places", "checks"])


def _sorted(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (hash, second hash) stand together, and which of them equal the one before."""
    order = np.lexsort((g, h)) if len(g) else np.argsort(h, kind="stable")
    again = np.zeros(len(h), bool)
    again[1:] = h[order][1:] == h[order][:-1]
    if len(g):
        again[1:] &= g[order][1:] == g[order][:-1]
    return order, again


def _several(again: np.ndarray) -> np.ndarray:
    """Whether a neighbour on either side is equal."""
    return again | np.append(again[1:], False)


def _send(emit: Emit, buckets: int):
    def run(batches):
        for h, k, p, g in emit(batches):
            order, again = _sorted(h, g)
            known, first = _several(again), ~again
            h, k, p, g = h[order], k[order], p[order], g[order] if len(g) else g
            # One triple of a hash is sent; one that is known to repeat needs no answer (-1).
            sent = np.where(known, np.int32(-1), p)
            rows = list(_split((h[first] % np.uint64(buckets)).astype(np.int32), h[first], k[first], sent[first], *([g[first]] if len(g) else [])))
            rows = rows if len(g) else [(*r, b"") for r in rows]
            # The flush's own findings pass through whichever buckets.
            rows += [(r, b"", kk, pp, b"") for r, kk, pp in _split((k[known].view(np.uint64) % np.uint64(buckets)).astype(np.int32), k[known], p[known])]
            yield _table(rows)

    return run


def _find(buckets: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["hashes"].str.len() == 0]
        pdf = pdf[pdf["hashes"].str.len() > 0]
        join = lambda s, t: np.frombuffer(b"".join(s), t)
        h, k, p, g = join(pdf["hashes"], np.uint64), join(pdf["keys"], np.int64), join(pdf["places"], np.int32), join(pdf["checks"], np.uint64)
        order, again = _sorted(h, g)
        found = order[_several(again)]
        found = found[p[found] >= 0]
        k, p = np.concatenate([k[found], join(own["keys"], np.int64)]), np.concatenate([p[found], join(own["places"], np.int32)])
        return pd.DataFrame([(r, b"", kk, pp, b"") for r, kk, pp in _split((k.view(np.uint64) % np.uint64(buckets)).astype(np.int32), k, p)], columns=["bucket", "hashes", "keys", "places", "checks"])

    return run


def _gather(pdf: pd.DataFrame) -> pd.DataFrame:
    k, p = np.frombuffer(b"".join(pdf["keys"]), np.int64), np.frombuffer(b"".join(pdf["places"]), np.int32)
    order = np.lexsort((p, k))
    k, p = k[order], p[order]
    cuts = np.flatnonzero(np.diff(k)) + 1
    starts = np.concatenate([[0], cuts]).astype(int) if len(k) else np.empty(0, int)
    return pd.DataFrame({"key": k[starts], "places": [distinct(x).tobytes() for x in np.split(p, cuts)] if len(k) else []})


def repeated_places(rows: DataFrame, emit: Emit, triples: float) -> DataFrame:
    """key, places (packed sorted int32): where in each row a hash stands that occurs at least
    twice, in this row or any other.  ``triples``: about how many triples emit makes in all."""
    buckets = max(8, int(triples / PER_BUCKET) + 1)
    sent = rows.mapInArrow(_send(emit, buckets), _ROW)
    found = sent.groupBy("bucket").applyInPandas(_find(buckets), _ROW)
    return found.groupBy("bucket").applyInPandas(_gather, "key long, places binary")


def text_bytes(rows: DataFrame) -> int:
    return int(rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
