"""Line dedup over overlapping three-line windows, in DataFrame functions only.

Every three consecutive lines of a document are hashed (128 bits); a window that occurs more than
once anywhere keeps its first occurrence, by document and then line, and the lines that later
occurrences cover are removed, overlapping occurrences merged.

Scale.  Windows travel as two hashes and a position.  First positions are combined before the
shuffle; only windows that repeat come back, by a join whose hot keys adaptive execution splits.
Texts travel only for documents that lose lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, matching, row_key, staged

LINES = 3


def _windows(docs: DataFrame) -> DataFrame:
    """key, doc_id, at (0-based line), h1, h2 of each window that has a non-blank line."""
    lines = docs.select("doc_id", "text", "key").withColumn("lines", F.split("text", "\n", -1)).where(F.size("lines") >= LINES)
    shifted = ", ".join(f"slice(lines, {k + 1}, size(lines) - {LINES - 1})" for k in range(LINES))
    one = f"transform(arrays_zip({shifted}), (w, i) -> named_struct('at', i, 'h1', xxhash64(w.`0`, w.`1`, w.`2`), 'h2', xxhash64(w.`2`, 'second', w.`1`, w.`0`), 'blank', trim(concat(w.`0`, w.`1`, w.`2`)) = ''))"
    return lines.select("key", "doc_id", F.explode(F.expr(one)).alias("w")).where("not w.blank").select("key", "doc_id", "w.at", "w.h1", "w.h2")


def removed_windows(docs: DataFrame) -> DataFrame:
    """key, starts: the sorted first lines of the later occurrences in each document that has any."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("key"))
    all_ = _windows(keyed)
    place = F.struct("doc_id", "key", "at")
    repeated = all_.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "first")
    later = all_.join(repeated, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2"))).where((F.col("key") != F.col("first.key")) | (F.col("at") != F.col("first.at")))
    return later.select("key", "at").groupBy("key").agg(F.array_sort(F.collect_set("at")).alias("starts"))


def dedup(docs: DataFrame) -> DataFrame:
    """docs with ``text`` without the removed lines and, added, n_lines, n_removed (longs) and
    removed_spans (array of [from, to) line ranges, merged).  Columns of these names are replaced.

    The order of documents is by doc_id (null first), then by a hash of the row.  A row that
    repeats id and text is one document with its repetition: both get the same result and neither
    is the other's later occurrence.  Lines are separated by \\n and compare byte for byte; windows
    of blank lines only never count.  Null text has 0 lines and stays null, empty text one line.
    """
    docs = docs.drop("n_lines", "n_removed", "removed_spans")
    key, starts = fresh(docs, "key_"), fresh(docs, "starts_")
    hit = staged(removed_windows(docs), "lines-removed").select(F.col("key").alias(key), F.col("starts").alias(starts))
    keyed = docs.withColumn(key, row_key())
    lines = F.split(F.col("text"), "\n", -1)
    n_lines = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    n_lines = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    no_spans = F.expr("cast(array() as array<struct<from: int, to: int>>)")
    clean = matching(keyed, hit.select(key), key, "left_anti").drop(key).withColumns({"n_lines": n_lines, "n_removed": F.lit(0).cast("long"), "removed_spans": no_spans})
    touched = matching(keyed, hit.select(key), key).join(hit, key).drop(key)
    merge = f"""aggregate(`{starts}`, cast(array() as array<struct<from: int, to: int>>), (acc, s) ->
        if(size(acc) > 0 and acc[size(acc) - 1].to >= s,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('from', acc[size(acc) - 1].from, 'to', s + {LINES}))),
           concat(acc, array(named_struct('from', s, 'to', s + {LINES})))))"""
    parts, taken = fresh(docs, "lines_"), "aggregate(removed_spans, 0L, (n, s) -> n + s.to - s.from)"
    # What stands between the merged spans, cut out span by span.
    before = "if(k = 0, 0, removed_spans[k - 1].to)"
    kept = f"flatten(transform(sequence(0, size(removed_spans)), k -> slice(`{parts}`, {before} + 1, if(k = size(removed_spans), size(`{parts}`), removed_spans[k].from) - {before})))"
    touched = touched.withColumn("removed_spans", F.expr(merge)).withColumn(parts, lines)
    touched = touched.withColumns({"n_lines": n_lines, "n_removed": F.expr(taken), "text": F.array_join(F.expr(kept), "\n")}).drop(starts, parts)
    return clean.unionByName(touched)
