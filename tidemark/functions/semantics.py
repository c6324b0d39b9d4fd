"""Expression semantics that the operators share, each stated once.

Division by zero gives null, never an error.  Sums of doubles run in exact decimals, so that
neither partitioning nor retries change a bit.  Percentiles are nearest rank with halves rounded up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Cells for each factor e of values.
CELLS = 4096


def div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def exact_sum(x: Column) -> Column:
    return F.sum(x.cast("decimal(28,6)")).cast("double")


def round_half(x: Column) -> Column:
    """To long, halves up."""
    return F.floor(x + 0.5).cast("long")


def trade_sign(maker: Column) -> Column:
    """+1 where the buyer took, -1 where the buyer was the maker."""
    return F.when(maker, -1).otherwise(1)


def nearest_ranks(rows: DataFrame, by: tuple[str, ...], columns: dict[str, str], ranks: dict[str, float]) -> DataFrame:
    """By group, for each column (named by a prefix) the values at clamp(round(p (n - 1))) of its
    sorted values (suffixes name the p) and the maximum (suffix Max), and cnt, the rows.

    Ranks are found by selection: equal values are counted, counts summed by cells (a cell's values differ by
    one part in CELLS), and only the cells in which a rank falls are sorted, each by itself.  Nulls do not
    count.  Values pass as doubles."""
    kinds = {k: rows.schema[c].dataType for k, c in columns.items()}
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("of"), F.col(c).cast("double").alias("v")) for k, c in columns.items())))
    counted = rows.select(*by, each.alias("x")).groupBy(*by, F.col("x.of").alias("of"), F.col("x.v").alias("v")).agg(F.count("*").alias("rows"))
    counted = counted.withColumn("cell", F.floor(F.signum("v") * F.log1p(F.abs("v")) * CELLS))
    key = [*by, "of"]
    group = Window.partitionBy(*key)
    n, wholly = F.when(F.col("cell").isNotNull(), F.col("n")).otherwise(0), group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = counted.groupBy(*key, "cell").agg(F.sum("rows").alias("n"), F.max("v").alias("most"))
    cells = cells.withColumns({"upto": F.sum(n).over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum(n).over(wholly), "cnt": F.sum("n").over(wholly), "most": F.max("most").over(wholly)})
    cells = cells.withColumn("before", F.col("upto") - n).withColumn("wanted", F.array(*(F.floor(F.lit(p) * (F.col("all") - 1) + 0.5) for p in ranks.values())))
    chosen = cells.where(F.col("cell").isNull() | F.exists("wanted", lambda r: (r >= F.col("before")) & (r < F.col("upto"))))
    met = reduce(lambda x, y: x & y, (F.col(f"c.{c}").eqNullSafe(F.col(f"g.{c}")) for c in (*key, "cell")))
    inside = counted.alias("c").join(chosen.alias("g"), met).select("c.*", "g.before", "g.wanted", "g.most", "g.cnt")
    last = F.col("before") + F.sum("rows").over(Window.partitionBy(*key, "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    found = inside.withColumn("last", last).withColumn("first", F.col("last") - F.col("rows"))
    of = lambda k, c, when=True: F.max(F.when((F.col("of") == k) & when, F.col(c)))
    at = lambda k, i: of(k, "v", (F.col("wanted")[i] >= F.col("first")) & (F.col("wanted")[i] < F.col("last")))
    out = [x for k in columns for x in (*(at(k, i).cast(kinds[k]).alias(f"{k}{s}") for i, s in enumerate(ranks)), of(k, "most").cast(kinds[k]).alias(f"{k}Max"))]
    return found.groupBy(*by).agg(*out, of(next(iter(columns)), "cnt").alias("cnt"))


def last_n(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), Window.currentRow)


def moving_average(x: Column, w: WindowSpec, n: int) -> Column:
    """Over the last n rows, fewer at the start; nulls do not count."""
    return F.avg(x).over(last_n(w, n))


def filled(x: Column, w: WindowSpec) -> Column:
    """The last non-null value up to the row."""
    return F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def floor_to(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds)


def format_duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return (
        F.when(s.isNull(), "--").when(s >= 3600, F.concat(h.cast("string"), F.lit("h "), m.cast("string"), F.lit("m")))
        .when(s >= 60, F.concat(F.floor(s / 60).cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s"))).otherwise(F.concat(s.cast("string"), F.lit("s")))
    )


def format_ago(seconds: Column) -> Column:
    s = seconds.cast("long")
    of = lambda n, unit: F.concat(n.cast("long").cast("string"), F.lit(f"{unit} ago"))
    return F.when(s.isNull(), "--").when(s < 60, of(s, "s")).when(s < 3600, of(F.floor(s / 60), "m")).otherwise(of(F.floor(s / 3600), "h"))


def format_count(n: Column) -> Column:
    return F.when(n.isNull(), "--").when(n >= 1_000_000, F.format_string("%.2fM", n / 1e6)).when(n >= 1_000, F.format_string("%.1fK", n / 1e3)).otherwise(n.cast("string"))


def dib_threshold(et: Column, ed: Column, pb: Column) -> Column:
    return et * ed * F.abs(2 * pb - 1)


def drb_threshold(et: Column, ed: Column, pb: Column) -> Column:
    return et * ed * F.greatest(pb, 1 - pb)


def rw_threshold(sigma: Column, et: Column) -> Column:
    return sigma * F.sqrt(et)
