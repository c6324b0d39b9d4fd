"""Phrases and their collocation scores from word suffix arrays.

A shard is some SHARD_WORDS words of a task's texts.  Its words get ids, its suffixes (which end with
their piece) are sorted by prefix doubling, and neighbours' common prefixes (LCP) cut the sorted
suffixes into intervals: an interval of common prefix m is an m-gram with its count.  Spark merges the
shards' counts by key.

Three passes over the texts, level by level.  The first counts words and pairs by 64-bit hashes, the
second triples of two frequent pairs; those in reach of the least count are marked in a bitmap of
fixed size.  The third counts n-grams whose words, pairs and triples are all marked by their exact
text: an n-gram is at most as frequent as what it holds, so none in reach is passed over, and a false
mark only costs work.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _BASE, _BYTES, mix, powers, staged
from .packed import PER_BUCKET, _split, text_bytes

LEAST, LONGEST, TOP = 100, 5, 2000
#: Words of one suffix array, bytes of text that are hashed at once, and bits of the bitmap of marks.
SHARD_WORDS, HASH_BYTES, MARKS = 800_000, 1 << 20, 1 << 25

#: A-Z become a-z; what ends a piece becomes \n, a tab a space.
_TABLE = bytearray(range(256))
_TABLE[65:91] = range(97, 123)
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 10
_TABLE[9] = 32
_TABLE = bytes(_TABLE)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


class Shard:
    """The words of some texts: starts and ends (bytes of ``raw``), rest (words to the end of the piece,
    itself included), hashes that differ by language, and each word's text."""

    def __init__(self, texts: list[bytes], langs: list[str]) -> None:
        self.langs = langs
        self.raw = b"\n".join(texts)
        b = np.frombuffer(self.raw, np.uint8)
        inside = np.zeros(len(b) + 2, bool)
        inside[1:-1] = (b != 32) & (b != 10)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        n = len(self.starts)
        stops = np.append(np.flatnonzero(b == 10), len(b))
        piece = np.searchsorted(stops, self.starts)
        last = np.append(np.flatnonzero(piece[1:] != piece[:-1]), n - 1)
        self.rest = np.repeat(last, np.diff(np.append(-1, last))) - np.arange(n) + 1 if n else np.empty(0, np.int64)
        texts_end = np.cumsum([len(t) + 1 for t in texts]) - 1 if texts else np.empty(0, np.int64)
        self.text = np.searchsorted(texts_end, self.starts)
        names, code = np.unique(np.array(langs, object), return_inverse=True) if langs else (np.empty(0, object), np.empty(0, int))
        salt = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in names], np.uint64)
        self.hashes = mix(_hashes(b, self.starts, self.ends) ^ salt[code[self.text]]) if n else np.empty(0, np.uint64)

    def __len__(self) -> int:
        return len(self.starts)

    def grams(self, m: int) -> np.ndarray:
        """A hash of the m words from each word on; without meaning where fewer are left of the piece."""
        out, n = self.hashes, len(self)
        for d in range(1, m):
            out = mix(out * _PAIR + np.concatenate([self.hashes[d:], np.zeros(min(d, n), np.uint64)]))
        return out

    def reach(self, bits: np.ndarray, known: int, longest: int) -> np.ndarray:
        """How many words from each word on, ``longest`` at most, are such that all runs of up to ``known`` of
        them are marked."""
        marked = [(self.rest >= m) & _marked(bits, self.grams(m)) for m in range(1, known + 1)]
        out, alive = marked[0].astype(np.int64), marked[0]
        for m in range(2, longest + 1):
            d = max(0, m - known)
            alive = alive & np.concatenate([marked[min(m, known) - 1][d:], np.zeros(min(d, len(self)), bool)])
            out += alive
        return out

    def phrase(self, at: int, m: int) -> bytes:
        out = self.raw[self.starts[at] : self.ends[at + m - 1]]
        return b" ".join(out.split()) if b"  " in out else out


def _hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the words, by running sums over blocks of whole words."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + HASH_BYTES)))
        lo, hi = int(starts[at]), int(ends[to - 1])
        up, down = powers(hi - lo, _BASE), powers(hi - lo, pow(_BASE, -1, 1 << 64))
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTES[b[lo:hi]] * up, dtype=np.uint64, out=run[1:])
        out[at:to] = mix((run[ends[at:to] - lo] - run[starts[at:to] - lo]) * down[starts[at:to] - lo])
        at = to
    return out


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks from 1, equal keys alike."""
    order = np.argsort(keys)
    new = np.ones(len(keys), np.int64)
    new[1:] = keys[order][1:] != keys[order][:-1]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new)
    return out


def suffix_array(ids: np.ndarray, rest: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): the positions in the order of their suffixes' first ``depth`` words or more, and the
    words that each has in common with the one before it, ``depth`` at most.  A suffix ends with its
    piece, which stands before every word."""
    n, rank, width = len(ids), ids, 1
    while width < depth:  # prefix doubling: ranks by 2 width words from ranks by width words
        after = np.zeros(n, np.int64)
        more = np.flatnonzero(rest > width)
        after[more] = rank[more + width]
        rank = _dense(rank * (n + 1) + after)
        width *= 2
    order = np.argsort(rank)
    lcp, same = np.zeros(n, np.int64), np.ones(max(n - 1, 0), bool)
    for d in range(depth):
        here = order[same.nonzero()[0] + 1], order[same.nonzero()[0]]
        longer = (rest[here[0]] > d) & (rest[here[1]] > d)
        longer[longer] = ids[here[0][longer] + d] == ids[here[1][longer] + d]
        same[same] = longer
        lcp[1:] += same
    return order, lcp


def intervals(order: np.ndarray, lcp: np.ndarray, reach: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) of the LCP intervals of m words: a position of each different m-gram and how often
    it occurs, of those whose positions ``reach`` m words."""
    first = np.flatnonzero(lcp < m)
    count = np.diff(np.append(first, len(order)))
    at = order[first]
    held = reach[at] >= m
    return at[held], count[held]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    texts, langs, held = [], [], 0
    for b in batches:
        for t, lang in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("lang").to_pylist(), strict=True):
            texts.append((t or b"").translate(_TABLE))
            langs.append(lang)
            held += len(texts[-1]) + 1
            if held >= 6 * SHARD_WORDS:
                yield Shard(texts, langs)
                texts, langs, held = [], [], 0
    if texts:
        yield Shard(texts, langs)


def frequent_hashes(rows: DataFrame, least: int, size: int, sizes: tuple[int, ...], bits=None) -> DataFrame:
    """The hashes of n-grams of the given sizes that occur ``least`` times, with their counts; with a bitmap
    (broadcast) only of those whose runs of one word less are marked."""
    buckets = max(8, int(size / 6 / PER_BUCKET) + 1)

    def count(batches):
        for s in _shards(batches):
            if not len(s):
                continue
            order, lcp = suffix_array(_dense(s.hashes), s.rest, sizes[-1])
            reach = s.rest if bits is None else s.reach(bits.value, sizes[0] - 1, sizes[-1])
            found = [(s.grams(m)[at], n) for m in sizes for at, n in [intervals(order, lcp, reach, m)]]
            if not sum(len(h) for h, _ in found):
                continue
            h, n = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]).astype(np.uint32)
            out = list(zip(*_split((h % np.uint64(buckets)).astype(np.int32), h, n), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names=["bucket", "hashes", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        h, n = np.frombuffer(b"".join(pdf["hashes"]), np.uint64), np.frombuffer(b"".join(pdf["counts"]), np.uint32)
        order = np.argsort(h)
        h = h[order]
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        total = np.add.reduceat(n[order].astype(np.int64), at)
        return pd.DataFrame({"hash": h[at][total >= least].view(np.int64), "n": total[total >= least]})

    return rows.mapInArrow(count, "bucket int, hashes binary, counts binary").groupBy("bucket").applyInPandas(add, "hash long, n long")


def marks(hashes: DataFrame) -> np.ndarray:
    """A bitmap of MARKS bits in which each hash has one: 64 bits a row, MARKS / 64 rows at most."""
    slot = F.shiftrightunsigned("hash", 6).bitwiseAND(MARKS // 64 - 1)
    rows = hashes.groupBy(slot.alias("slot")).agg(F.expr("bit_or(shiftleft(1L, cast(hash & 63 as int)))").alias("bits")).toPandas()
    out = np.zeros(MARKS // 64, np.int64)
    out[rows["slot"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return (bits[(hashes >> np.uint64(6)) & np.uint64(MARKS // 64 - 1)] >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def ngram_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, phrase, m (words), n (occurrences) of all n-grams of up to ``longest`` words with n >= least,
    and a row of m = 0 for each lang with all its words.

    Null lang is ``und``; null text has no words; repeated rows count as often as they stand there; other
    columns are ignored; an empty table gives none."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    size, sc = text_bytes(rows), docs.sparkSession.sparkContext
    found = staged(frequent_hashes(rows, least, size, (1, 2)), "phrases-frequent")
    if longest > 2:
        pairs = sc.broadcast(marks(found))
        found = found.unionByName(staged(frequent_hashes(rows, least, size, (3,), pairs), "phrases-triples"))
    bits = sc.broadcast(marks(found))

    buckets = max(8, int(size / 6 / PER_BUCKET) + 1)

    def count(batches):
        for s in _shards(batches):
            out: dict[tuple[int, str], tuple[list[bytes], list[int]]] = {(0, lang): ([b""], [n]) for lang, n in _per_lang(s)}
            if len(s):
                reach = s.reach(bits.value, min(longest, 3), longest)
                order, lcp = suffix_array(_dense(s.hashes), s.rest, longest)
                for m in range(1, longest + 1):
                    at, n = intervals(order, lcp, reach, m)
                    for i, t, c in zip(at.tolist(), s.text[at].tolist(), n.tolist(), strict=True):
                        p = s.phrase(i, m)
                        held = out.setdefault((zlib.crc32(p) % buckets, s.langs[t]), ([], []))
                        held[0].append(p)
                        held[1].append(c)
            packed = [(k, lang, b"\n".join(p), np.array(c, np.int64).tobytes()) for (k, lang), (p, c) in out.items()]
            cols = list(zip(*packed, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], names=["bucket", "lang", "phrases", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for lang, part in pdf.groupby("lang"):
            n = pd.Series(np.frombuffer(b"".join(part["counts"]), np.int64)).groupby(np.array(b"\n".join(part["phrases"]).split(b"\n"), object), sort=False).sum()
            n = n[(n >= least) | (n.index == b"")]
            texts = [p.decode() for p in n.index]
            parts.append(pd.DataFrame({"lang": lang, "phrase": texts, "m": [p.count(" ") + 1 if p else 0 for p in texts], "n": n.to_numpy()}))
        return pd.concat(parts)

    # A shard's phrases travel packed, by bucket of their hash and lang; no word holds a \n or a blank.
    counted = rows.mapInArrow(count, "bucket int, lang string, phrases binary, counts binary").groupBy("bucket").applyInPandas(add, "lang string, phrase string, m int, n long")
    return staged(counted, "phrases-counts")


def _per_lang(s: Shard) -> list[tuple[str, int]]:
    out: dict[str, int] = {}
    for lang, n in zip(s.langs, np.bincount(s.text, minlength=len(s.langs)).tolist(), strict=True):
        out[lang] = out.get(lang, 0) + n
    return list(out.items())


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases among counts that no longer one as frequent holds.

    The score is that of the weakest cut, floor(1000 a n / (l r)); ties go to the cut after fewer words.
    Products are decimals of 38 digits: exact below 10^15 occurrences of a phrase and 10^18 words."""
    total = counts.where("m = 0").select(F.col("lang").alias("lang_"), F.col("n").alias("words"))
    f = counts.where("m > 0")
    # A longer phrase as frequent as one in it is as frequent as all between them: one word more will do.
    longer = f.where("m > 2").select("lang", F.explode(F.array(F.expr("substring_index(phrase, ' ', m - 1)"), F.expr("substring_index(phrase, ' ', 1 - m)"))).alias("phrase"), "n")
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = f.where("m > 1").join(longer, ["lang", "phrase"], "left").where("longer is null or longer < n").select("lang", "phrase", "m", F.col("n").alias("a"))
    cuts = kept.withColumn("k", F.explode(F.expr("sequence(1, m - 1)"))).withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - m)")})
    of = lambda c, n: f.select(F.col("lang").alias(f"lang_{n}"), F.col("phrase").alias(c), F.col("n").alias(n))
    cuts = cuts.join(of("first", "l").withColumnRenamed("lang_l", "lang"), ["lang", "first"]).join(of("rest", "r").withColumnRenamed("lang_r", "lang"), ["lang", "rest"])
    cuts = cuts.join(total, F.col("lang") == F.col("lang_"))
    wide = lambda c, p: F.col(c).cast(f"decimal({p},0)")
    cuts = cuts.withColumn("over", F.lit(1000).cast("decimal(4,0)") * wide("a", 15) * wide("words", 18)).withColumn("under", wide("l", 15) * wide("r", 15)).withColumn("score", F.expr("over div under"))
    least = cuts.groupBy("lang", "phrase", "a", "words").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    return least.select("lang", "phrase", "a", "c.l", "c.r", F.col("words").alias("n"), "c.score")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each lang by score, a, phrase (in the order of their bytes): lang, rank,
    phrase, a, l, r, n, score.  For odd inputs see ngram_counts."""
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = scored(ngram_counts(docs, longest, least)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
