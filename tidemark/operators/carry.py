"""What a row carries from the rows before it in its key's order, without a window over a whole key.

Rows are dealt to buckets of the order column (ranges of time or of ids).  A first level gives each
bucket's own last value or sum, of which there are few; run through per key they give what each
bucket begins with, as a seed row before its rows.  The second level is a window over one bucket, so
a key that holds most of the rows is dealt to as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Seconds and ids of a bucket.
SECONDS, IDS = 3600, 100_000


def bucket(df: DataFrame, column: str, width: int | None = None) -> Column:
    """The bucket of a time (width in seconds) or a number; rises with the column."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.floor(F.unix_seconds(c) / (width or SECONDS))
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        day = F.unix_date(c.cast("date")).cast("long") * 86_400
        within = F.lit(0) if isinstance(kind, T.DateType) else F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
        return F.floor((day + within) / (width or SECONDS))
    return F.floor(c / (width or IDS))


def _seeded(rows: DataFrame, by: list[str], b: str, seeds: DataFrame, order: list[str], backwards: bool):
    """(rows and seeds, the window that runs through a bucket from its seed on, the seeds' mark)."""
    way = F.desc if backwards else F.asc
    both = rows.withColumn("seed_", F.lit(False)).unionByName(seeds.withColumn("seed_", F.lit(True)), allowMissingColumns=True)
    return both, Window.partitionBy(*by, b).orderBy(F.desc("seed_"), *map(way, order)).rowsBetween(Window.unboundedPreceding, 0)


def _earlier(by: list[str], b: str, backwards: bool):
    return Window.partitionBy(*by).orderBy((F.desc if backwards else F.asc)(b)).rowsBetween(Window.unboundedPreceding, -1)


def carried(rows: DataFrame, by: list[str], at: Column, order: list[str], value: str, out: str, backwards: bool = False) -> DataFrame:
    """rows with ``out``: the last value that is not null at or before each row in ``order``, or with
    ``backwards`` the first at or after it; null if there is none.  ``at`` is the row's bucket (see
    bucket), of the first of the order columns.  Null keys are a key."""
    rows = rows.withColumn("bucket_", at)
    place = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = rows.groupBy(*by, "bucket_").agg((F.min_by if backwards else F.max_by)(value, place).alias(value))
    seeds = ends.withColumn(value, F.last(value, ignorenulls=True).over(_earlier(by, "bucket_", backwards))).where(F.col(value).isNotNull())
    both, w = _seeded(rows, by, "bucket_", seeds, order, backwards)
    return both.withColumn(out, F.last(value, ignorenulls=True).over(w)).where(~F.col("seed_")).drop("seed_", "bucket_")


def running_sums(rows: DataFrame, by: list[str], at: Column, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """rows with the running sums of exact numbers (decimals or longs), each row's own included, under the
    names of ``sums``."""
    rows = rows.withColumns({"bucket_": at, **{f"{k}_": c for k, c in sums.items()}})
    parts = rows.groupBy(*by, "bucket_").agg(*(F.sum(f"{k}_").alias(f"{k}_") for k in sums))
    seeds = parts.withColumns({f"{k}_": F.sum(f"{k}_").over(_earlier(by, "bucket_", False)) for k in sums})
    both, w = _seeded(rows, by, "bucket_", seeds, order, False)
    return both.withColumns({k: F.sum(f"{k}_").over(w) for k in sums}).where(~F.col("seed_")).drop("seed_", "bucket_", *(f"{k}_" for k in sums))
