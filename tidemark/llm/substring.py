"""Substring dedup by level-wise doubling.

A level looks for windows of some length that repeat anywhere; only windows whose part repeats at one
level are extended to twice the length at the next, until the length of WORDS words is reached (9,
18, 35) or no candidates survive.  longest() goes on doubling from there until none survive.

Not every window needs to travel: of each WORDS-window the shortest part of least hash stands for it
(winnowing; Schleimer et al. 2003), and the parts of the next lengths begin where it begins, or as
late as they fit, so that equal windows choose equal parts at every level.

Repeats at the last level are equal in two independent 64-bit hashes of words and windows.

Scale.  All levels use packed exchanges (packed.py): a hot passage gives a bucket one entry per batch
of rows.  Texts travel only for documents with repeats at the level before.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Windows, distinct, hash_words, matching, row_key, staged
from .packed import repeated_places, text_bytes

WORDS = 35
#: Windows of one flush of a map task.
FLUSH = 1_000_000


def chosen(halves: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` half-windows the place of the least hash, leftmost of ties."""
    n = len(halves) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, width = np.arange(len(halves)), 1
    while 2 * width <= span:  # least over runs of doubling width
        a, b = best[: len(best) - width], best[width:]
        best = np.where(halves[b] < halves[a], b, a)
        width *= 2
    a, b = best[:n], best[span - width : span - width + n]
    return np.where(halves[b] < halves[a], b, a)


def _texts(b: pa.RecordBatch) -> list:
    return b.column("text").cast(pa.binary()).to_pylist()


def _flushing(emit):
    """Gathers what emit(row) gives until it is enough for one flush."""

    def run(batches):
        got, held = [], 0
        for b in batches:
            for h, key, p, g in emit(b):
                if len(h):
                    got.append((h, np.full(len(h), key, np.int64), p.astype(np.int32), g))
                    held += len(h)
                    if held >= FLUSH:
                        yield tuple(map(np.concatenate, zip(*got, strict=True)))
                        got, held = [], 0
        if got:
            yield tuple(map(np.concatenate, zip(*got, strict=True)))

    return run


_NO_CHECKS = np.empty(0, np.uint64)


def lengths(words: int, least: int = 8) -> list[int]:
    """The levels: words halved, halves rounded up, as long as ``least`` words are left."""
    out = [words]
    while -(-out[0] // 2) >= least:
        out.insert(0, -(-out[0] // 2))
    return out


def _part(at: np.ndarray, words: int, length: int) -> np.ndarray:
    """Where the windows' parts of ``length`` words begin, given where their shortest parts do."""
    return np.minimum(at, np.arange(len(at)) + words - length)


def _level(words: int, length: int, before: int | None, shortest: int):
    """Hashes of the parts of ``length`` words of those windows whose part at the level before repeats."""
    state: dict = {}

    def emit(b: pa.RecordBatch):
        hashes = state.setdefault("windows", Windows())
        places = b.column("places").to_pylist() if before else [None] * b.num_rows
        for key, t, known in zip(b.column("key").to_pylist(), _texts(b), places, strict=True):
            w = hash_words(t)
            if len(w) < words:
                continue
            at = chosen(hashes(w, shortest), words - shortest + 1)
            part = _part(at, words, length)
            if before:
                repeated = np.zeros(len(w), bool)
                repeated[np.frombuffer(known, np.int32)] = True
                part = part[repeated[_part(at, words, before)]]
            part = distinct(part)
            h = hashes(w, length)[part]
            yield h, key, part, hashes(hash_words(t, second=True), length)[part] if length == words else _NO_CHECKS

    return _flushing(emit)


def _doubled(words: int):
    state: dict = {}

    def emit(b: pa.RecordBatch):
        hashes = state.setdefault("windows", Windows())
        for key, t, places in zip(b.column("key").to_pylist(), _texts(b), b.column("places").to_pylist(), strict=True):
            w = hash_words(t)
            n = len(w) - 2 * words + 1
            if n > 0:
                known = np.zeros(len(w) + 1, bool)
                known[np.frombuffer(places, np.int32)] = True
                at = np.flatnonzero(known[:n] & known[words : words + n])
                yield hashes(w, 2 * words)[at], key, at, hashes(hash_words(t, second=True), 2 * words)[at]

    return _flushing(emit)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("key"))


def _with(rows: DataFrame, places: DataFrame) -> DataFrame:
    return matching(rows.select("key", "text"), places.select("key"), "key").join(places, "key")


def repeated_windows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """key (row_key), places: the starts of the windows of ``words`` words that start elsewhere too."""
    rows, levels, places = _keyed(docs), lengths(words), None
    size = text_bytes(rows)
    for before, length in zip([None, *levels], levels, strict=False):
        known = rows if before is None else _with(rows, places)
        # A word has some six bytes; winnowing keeps about two of the windows that it chooses from.
        triples = size / 12 if length == words else size / 3 / (words - levels[0] + 2)
        places = staged(repeated_places(known, _level(words, length, before, levels[0]), triples), f"substring-{length}")
    return places


def longest(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """key, words: the largest of words, 2 words, 4 words ... of which the document has a window
    that repeats; documents without any are left out.  Doubles until no candidates survive."""
    rows, places, out = _keyed(docs), repeated_windows(docs, words), None
    while places.limit(1).count():
        found = places.select("key", F.lit(words).alias("words"))
        out = found if out is None else out.unionByName(found)
        places = staged(repeated_places(_with(rows, places), _doubled(words), text_bytes(rows) / 20), "substring-doubled")
        words *= 2
    empty = places.select("key", F.lit(0).alias("words"))
    return (empty if out is None else out).groupBy("key").agg(F.max("words").alias("words"))


def covered(n: int, starts: np.ndarray, words: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of starts."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + words, n), -1)
    return np.cumsum(edge[:n]) > 0


def _removed(words: int):
    def run(batches):
        for b in batches:
            rows = []
            for t, places in zip(_texts(b), b.column("places").to_pylist(), strict=True):
                w = t.split() if t else []
                gone = covered(len(w), np.frombuffer(places or b"", np.int32), words)
                kept = b" ".join(x for x, g in zip(w, gone.tolist(), strict=True) if not g) if places else b" ".join(w)
                rows.append((len(w), int(gone.sum()), kept))
            n, m, kept = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return run


def dedup(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_removed, kept (the words left,
    joined by a space), kept_sha256.

    Words are what stands between ASCII white space; windows are equal if two independent 64-bit
    hashes of their words are.  All occurrences of a repeated window go, the first too.  Null text has no words; texts of fewer than ``words`` words
    keep all; repeated rows are documents of their own, so each repeats the other; other columns
    are ignored.
    """
    rows = _keyed(docs)
    places = repeated_windows(docs, words)
    touched = matching(rows, places.select("key"), "key").join(places, "key")
    clean = matching(rows, places.select("key"), "key", "left_anti").withColumn("places", F.lit(None).cast("binary"))
    out = [x.select("doc_id", "text", "places").mapInArrow(_removed(words), "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string") for x in (touched, clean)]
    return out[0].unionByName(out[1]).withColumn("kept", F.col("kept").cast("string"))
