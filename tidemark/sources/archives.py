"""Archive files, funding records and the date-partitioned store.

All paths are Hadoop paths; files are listed and read by Spark only.
"""

from __future__ import annotations

import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.relational import keep_latest
from ..schemas import FUNDING

# Column layouts of the archives' CSV files.
SPOT_CSV = "tradeId long, price double, qty double, quoteQty double, t long, maker string, best string"
AGG_CSV = "aggTradeId long, price double, qty double, firstTradeId long, lastTradeId long, t long, maker string"
FILL_CSV = "tradeId long, price double, qty double, quoteQty double, t long, maker string"

#: Lines of a member that are parsed at once; tasks that members are dealt to at most.
LINES, TASKS = 50_000, 10_000


def _symbol(path: Column) -> Column:
    return F.regexp_extract(path, r"([A-Z0-9]+)-[^/]*$", 1)


def read_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """kind: spot (no header, times in microseconds), agg or fills (header, milliseconds).  The symbol
    begins the file's name, or is that of its folder sym=... ."""
    schema, header = {"spot": (SPOT_CSV, False), "agg": (AGG_CSV, True), "fills": (FILL_CSV, True)}[kind]
    raw = spark.read.schema(schema).option("header", header).csv(path)
    return shape(raw if "sym" in raw.columns else raw.withColumn("sym", _symbol(F.input_file_name())), kind)


def shape(raw: DataFrame, kind: str) -> DataFrame:
    """exchTradeTimeMs keeps the file's number: microseconds in spot archives."""
    ids = {"spot": ["tradeId"], "agg": ["aggTradeId", "firstTradeId", "lastTradeId"], "fills": ["tradeId"]}[kind]
    at = F.timestamp_micros("t") if kind == "spot" else F.timestamp_millis("t")
    quote = ["quoteQty"] if kind == "fills" else []
    return raw.select(at.alias("exchTradeTs"), F.col("t").alias("exchTradeTimeMs"), "sym", *ids, "price", "qty", *quote, (F.lower("maker") == "true").alias("buyerIsMaker"))


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """path, member, bytes (inflated) of the files inside zip archives.  Spark lists the archives; of
    each, tasks read the directory at its end by ranges."""

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name in f["path"]:
                with _opened(name) as source, zipfile.ZipFile(source) as z:
                    rows = [(name, m.filename, m.file_size) for m in z.infolist() if not m.is_dir()]
                yield pd.DataFrame(rows, columns=["path", "member", "bytes"])

    return spark.read.format("binaryFile").load(path).select("path").mapInPandas(listed, "path string, member string, bytes long")


def read_zip(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The CSV files inside zip archives, each in a task of its own (TASKS tasks at most), which
    reads its range of the archive and inflates it line by line in bounded batches: neither archive nor
    member is ever held whole.  Empty members have no rows; the symbol is the archive's."""
    schema, skip = {"spot": SPOT_CSV, "agg": AGG_CSV, "fills": FILL_CSV}[kind], kind != "spot"
    names = [c.split()[0] for c in schema.split(", ")]

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, member in zip(f["path"], f["member"], strict=True):
                with _opened(name) as source, zipfile.ZipFile(source) as z, z.open(member) as content:
                    for part in pd.read_csv(content, names=names, dtype=str, header=0 if skip else None, chunksize=LINES):
                        yield pd.DataFrame({"path": name, **{n: part[n] for n in names}})

    members = zip_members(spark, path).where("bytes > 0").select("path", "member")
    dealt = members.repartition(max(1, min(TASKS, members.count())))
    raw = dealt.mapInPandas(lines, "path string, " + ", ".join(f"{n} string" for n in names))
    typed = raw.select(_symbol(F.col("path")).alias("sym"), *(F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")))
    return shape(typed, kind)


def write_dates(df: DataFrame, root: str, table: str, ts: str = "exchTradeTs", order: tuple[str, ...] = ()) -> None:
    """Into root/table/date=..., sorted by symbol within files; dates that df has are replaced.
    Rows are dealt by ranges of (date, symbol, time), so that a hot symbol's day has many tasks and files."""
    out = df.withColumn("date", F.to_date(ts)).repartitionByRange("date", "sym", ts).sortWithinPartitions("date", "sym", ts, *order)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("date").parquet(f"{root}/{table}")


def _opened(path: str):
    """A file by its URI, read by ranges."""
    where, name = pafs.FileSystem.from_uri(path)
    return where.open_input_file(name)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """path, length of the Parquet files; Spark lists them and reads no content for it."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")


def _footers(batches):
    for b in batches:
        whole = []
        for path in b.column("path").to_pylist():
            with _opened(path) as f:
                meta = pq.read_metadata(f)
            whole.append(sum(meta.row_group(k).total_byte_size for k in range(meta.num_row_groups)))
        yield pa.RecordBatch.from_arrays([b.column("path"), b.column("length"), pa.array(whole, pa.int64())], names=["path", "compressed", "logical"])


class Store:
    """The date-partitioned tables below a root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def listed(self, path: str, prefix: str = "") -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith(prefix)) if fs.exists(p) else []

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def tables(self) -> list[str]:
        return [t for t in self.listed(self.root) if not t.startswith(("_", "."))]

    def dates(self, table: str) -> list[str]:
        return [d.removeprefix("date=") for d in self.listed(f"{self.root}/{table}", "date=")]

    def load(self, table: str, first: str | date | None = None, last: str | date | None = None, sym: str | list[str] | None = None) -> DataFrame:
        """Date bounds prune partitions; the symbol is pushed to the files."""
        out = self.spark.read.parquet(f"{self.root}/{table}")
        if first is not None:
            out = out.where(F.col("date") >= F.lit(str(first)).cast("date"))
        if last is not None:
            out = out.where(F.col("date") <= F.lit(str(last)).cast("date"))
        return out if sym is None else out.where(F.col("sym").isin([sym] if isinstance(sym, str) else sym))

    def row_counts(self, table: str, by_symbol: bool = False) -> DataFrame:
        return self.load(table).groupBy("date", *(["sym"] if by_symbol else [])).agg(F.count("*").alias("rows"))

    def date_range(self, table: str) -> tuple[str, str] | None:
        """The first and the last date."""
        dates = self.dates(table)
        return (dates[0], dates[-1]) if dates else None

    def sizes(self, table: str) -> DataFrame:
        """By date the megabytes of its files and of what their columns hold before compression, from
        the files' footers, and the ratio of both."""
        sized = _files(self.spark, f"{self.root}/{table}/date=*").mapInArrow(_footers, "path string, compressed long, logical long")
        sums = sized.groupBy(F.regexp_extract("path", "date=([^/]*)", 1).alias("date")).agg((F.sum("compressed") / 1e6).alias("compressedMB"), (F.sum("logical") / 1e6).alias("logicalMB"))
        return sums.withColumn("ratio", F.try_divide("logicalMB", "compressedMB"))

    def _statuses(self, path: str):
        fs, p = self._fs(path)
        return fs.listStatus(p)

    def move(self, source: str, target: str) -> None:
        """Renames a folder; refuses to replace one."""
        fs, p = self._fs(source)
        _, q = self._fs(target)
        if fs.exists(q):
            raise FileExistsError(target)
        fs.mkdirs(q.getParent())
        if not fs.rename(p, q):
            raise OSError(f"{source} could not be moved to {target}")

    def touch(self, path: str) -> None:
        """An empty file."""
        fs, p = self._fs(path)
        fs.create(p, True).close()

    def delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)


@dataclass
class LoadSummary:
    loaded: list[date] = field(default_factory=list)
    skipped: list[date] = field(default_factory=list)
    failed: list[date] = field(default_factory=list)
    reasons: dict[date, str] = field(default_factory=dict)
    rows: int = 0

    @property
    def exit_code(self) -> int:
        return 2 if self.failed else 0


def load_range(store: Store, table: str, first: date, last: date, source: Callable[[date], DataFrame | None], skip_existing: bool = True, order: tuple[str, ...] = ()) -> LoadSummary:
    """Loads date by date; a date whose source is missing or fails is counted and does not stop the rest."""
    out, day = LoadSummary(), first
    while day <= last:
        if skip_existing and store.exists(f"{store.root}/{table}/date={day}"):
            out.skipped.append(day)
        else:
            try:
                df = source(day)
                if df is None:
                    raise FileNotFoundError(str(day))
                write_dates(df, store.root, table, order=order)
                out.loaded.append(day)
                out.rows += store.load(table, day, day).count()
            except Exception as e:  # any source's failure counts as the date's
                out.failed.append(day)
                out.reasons[day] = f"{type(e).__name__}: {e}"[:500]
        day += timedelta(days=1)
    return out


def load_date(store: Store, table: str, day: date, source: Callable[[date], DataFrame | None], order: tuple[str, ...] = ()) -> int:
    """Loads one date, replacing it; gives its rows and raises what keeps it from being loaded."""
    df = source(day)
    if df is None:
        raise FileNotFoundError(str(day))
    write_dates(df, store.root, table, order=order)
    return store.load(table, day, day).count()


def pages(fetch: Callable[[int], list[dict]], since_ms: int, limit: int = 1000, most: int = 50) -> list[dict]:
    """All records from since_ms on of a paginated source: the cursor is the last time plus 1 ms."""
    out: list[dict] = []
    for _ in range(most):
        got = fetch(since_ms)
        out += got
        if len(got) < limit:
            return out
        since_ms = got[-1]["fundingTime"] + 1
    raise RuntimeError(f"more than {most} pages; go on from {since_ms}")


class _FundingReader(DataSourceReader):
    def __init__(self, fetch: Callable[[str, int], list[dict]], since: dict[str, int], limit: int) -> None:
        self.fetch, self.since, self.limit = fetch, since, limit

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(x) for x in sorted(self.since.items())]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        sym, at = partition.value
        while True:
            got = self.fetch(sym, at)
            for r in got:
                yield r["symbol"], str(r["fundingRate"]), int(r["fundingTime"]), str(r["markPrice"])
            if len(got) < self.limit:
                return
            at = int(got[-1]["fundingTime"]) + 1


def funding_pages(spark: SparkSession, fetch: Callable[[str, int], list[dict]], since: dict[str, int], limit: int = 1000) -> DataFrame:
    """All records of each symbol from its time (ms) on, as a data source: a partition, so a task, for each
    symbol, which follows the cursor (the last time plus 1 ms) page by page until one is short.  fetch
    runs in the tasks; a lost one begins its symbol anew."""

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "funding_pages"

        def schema(self) -> str:
            return _FUNDING_JSON

        def reader(self, schema) -> DataSourceReader:
            return _FundingReader(fetch, since, limit)

    spark.dataSource.register(Pages)
    return _shaped(spark.read.format("funding_pages").load())


def fetch_new(stored: DataFrame | None, symbols: list[str], fetch: Callable[[str, int], list[dict]], spark: SparkSession, first: str = "2019-01-01") -> DataFrame:
    """stored with what each symbol has after its last record (from ``first`` on without any); fetch
    gives the records of a symbol from a time in milliseconds on, a page at a time.  Only a time for
    each symbol passes through the driver."""
    start = int(datetime.fromisoformat(first).replace(tzinfo=UTC).timestamp() * 1000)
    since = dict.fromkeys(symbols, start)
    if stored is not None:
        since |= {r.sym: r.ms for r in stored.where(F.col("sym").isin(symbols)).groupBy("sym").agg((F.unix_millis(F.max("fundingTime").cast("timestamp")) + 1).alias("ms")).collect() if r.ms is not None}
    return merge_funding(stored, funding_pages(spark, fetch, since))


_FUNDING_JSON = "symbol string, fundingRate string, fundingTime long, markPrice string"


def funding_json(spark: SparkSession, path: str) -> DataFrame:
    return _shaped(spark.read.schema(_FUNDING_JSON).option("multiLine", True).json(path))


def _shaped(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("symbol").alias("sym"), F.timestamp_millis("fundingTime").alias("fundingTime"), F.col("fundingRate").try_cast("double").alias("fundingRate"), F.col("markPrice").try_cast("double").alias("markPrice"))


def merge_funding(stored: DataFrame | None, new: DataFrame) -> DataFrame:
    """Each (sym, fundingTime) once, the newer record winning."""
    new = new.select(*FUNDING.names).withColumn("load", F.lit(1))
    both = new if stored is None else stored.select(*FUNDING.names).withColumn("load", F.lit(0)).unionByName(new)
    return keep_latest(both, ("sym", "fundingTime"), "load").drop("load")


def funding_status(funding: DataFrame) -> DataFrame:
    return funding.groupBy("sym").agg(F.count("*").alias("rows"), F.min("fundingTime").alias("first"), F.max("fundingTime").alias("last"))


def watermarks(funding: DataFrame, first: str = "2019-01-01") -> DataFrame:
    """By symbol the time from which to fetch: one microsecond after the last record."""
    return funding.groupBy("sym").agg(F.coalesce(F.max("fundingTime") + F.expr("interval 1 microsecond"), F.lit(first).cast("timestamp")).alias("since"))


#: A file in a date that has come from the spool, until the spool's copy is gone.
_MOVED = "_moved_from_spool"


def end_of_day(store: Store, spool: str, table: str, day: str, order: str = "tpSeqNo") -> int:
    """Compacts spool/table/date=day into the store, sorted by symbol in arrival order: written
    beside the target first, then moved; a day that is there already is refused.

    What is moved holds a mark until the spool's copy is deleted, so a run that ended in between is
    finished by the next one and not refused."""
    source, target = f"{spool}/{table}/date={day}", f"{store.root}/{table}/date={day}"
    if store.exists(target) and not store.exists(f"{target}/{_MOVED}"):
        raise FileExistsError(target)
    if not store.exists(target):
        rows, part = store.spark.read.parquet(source), f"{store.root}/_moving/{table}/date={day}"
        rows.repartition("sym").sortWithinPartitions("sym", order).write.mode("overwrite").option("compression", "zstd").parquet(part)
        store.touch(f"{part}/{_MOVED}")
        store.move(part, target)
    if store.exists(source):
        store.delete(source)
    store.delete(f"{target}/{_MOVED}")
    return store.spark.read.parquet(target).count()


def recover_orphans(store: Store, spool: str, table: str, today: str) -> list[str]:
    """end_of_day() of all spooled days before today, oldest first, that the store lacks or has not
    finished, and of moved days whose mark was left."""
    target = lambda d: f"{store.root}/{table}/date={d}"
    days = [d.removeprefix("date=") for d in store.listed(f"{spool}/{table}", "date=")]
    left = [d for d in store.dates(table) if store.exists(f"{target(d)}/{_MOVED}")]
    done = sorted({d for d in days if d < today and not store.exists(target(d))} | {d for d in left if d < today})
    for d in done:
        end_of_day(store, spool, table, d)
    return done


def retain(store: Store, table: str, now: datetime, minutes: float, column: str = "time") -> list[str]:
    """Deletes what is older than ``minutes`` before now from a stored table and returns the dates it touched:
    whole dates go, and the date of the cutoff is written anew beside its place and put there."""
    cutoff, touched = now - timedelta(minutes=minutes), []
    for d in store.dates(table):
        path, part = f"{store.root}/{table}/date={d}", f"{store.root}/_moving/{table}/date={d}"
        if date.fromisoformat(d) > cutoff.date():
            continue
        rows = store.spark.read.parquet(path)
        kept = rows.where(F.col(column) >= F.lit(cutoff).cast(rows.schema[column].dataType))
        if date.fromisoformat(d) == cutoff.date() and kept.limit(1).count():
            kept.write.mode("overwrite").option("compression", "zstd").parquet(part)
            store.delete(path)
            store.move(part, path)
        else:
            store.delete(path)
        touched.append(d)
    return touched


def logs(store: Store, path: str) -> DataFrame:
    """By date of a durable log below path: files, megabytes and whether every file can be read,
    which tasks find out file by file."""
    rows, kind = [], "date string, files long, megabytes double"
    for day in (d.removeprefix("date=") for d in store.listed(path, "date=")):
        files = [s for s in store._statuses(f"{path}/date={day}") if s.getPath().getName().endswith(".parquet")]
        rows.append((day, len(files), sum(s.getLen() for s in files) / 1e6))
    days = store.spark.createDataFrame(rows, kind)
    if not rows:
        return days.withColumn("state", F.lit("ok"))
    found = _files(store.spark, f"{path}/date=*").mapInArrow(_verify, "path string, ok boolean")
    states = found.groupBy(F.regexp_extract("path", "date=([^/]*)", 1).alias("of")).agg(F.bool_and("ok").alias("ok"))
    return days.join(states, F.col("date") == F.col("of"), "left").select("date", "files", "megabytes", F.when(F.coalesce("ok", F.lit(True)), "ok").otherwise("corrupt").alias("state"))


def _verify(batches):
    """Whether all row groups of each Parquet file can be read, a row group at a time."""
    for b in batches:
        ok = []
        for path in b.column("path").to_pylist():
            try:
                with _opened(path) as file:
                    f = pq.ParquetFile(file)
                    for k in range(f.num_row_groups):
                        f.read_row_group(k)
                ok.append(True)
            except (pa.ArrowException, OSError):
                ok.append(False)
        yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(ok, pa.bool_())], names=["path", "ok"])


def clean_logs(store: Store, path: str, today: date, keep_days: int = 7) -> list[str]:
    """Deletes the log's dates older than keep_days and returns them."""
    old = [d for d in (x.removeprefix("date=") for x in store.listed(path, "date=")) if date.fromisoformat(d) < today - timedelta(days=keep_days)]
    for d in old:
        store.delete(f"{path}/date={d}")
    return old
