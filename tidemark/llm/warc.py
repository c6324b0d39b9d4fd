"""WARC archives: a writer with revisit records and a salvage reader.

write() lets Spark's text sink write the archives: a row is one gzip member that holds one record,
and the line separator is an empty gzip member, which every reader of multi-member gzip passes
over.  So files commit as any Spark output does, on any file system, and survive lost executors.
Pages are written by classes of size, each with so many records a file that no file exceeds
FILE_BYTES of payloads, but for single pages that are larger.

read() checks version line, header, lengths, CRC and digests of every record.  Where a check
fails it searches for the next gzip member that inflates, or in plain files for the next version
line, whose record passes, reads on from there and logs the bytes between as a quarantined gap.
The same search runs over what a member inflates to, and over what a bad member gave before it
broke, to the last byte.  A member whose deflate stream is whole but whose trailer is wrong ends
where its trailer does, and its records count if their own digests hold.
"""

import base64
import hashlib
import re
import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, staged

#: Payload bytes of a file at most; upper bounds of the classes of size (beyond the last, a file a page).
FILE_BYTES = 32 << 20
CLASSES = (16 << 10, 256 << 10, 4 << 20)
#: Bytes that are inflated at once; where a step breaks, its bytes are inflated one by one.
STEP = 4 << 10
_EMPTY = zlib.compressobj(9, zlib.DEFLATED, 31)
#: Twenty bytes, with the header field for the time zero: a gzip member of no content.
EMPTY_MEMBER = _EMPTY.compress(b"") + _EMPTY.flush()
MAGIC, VERSION, END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
RECORDS = "file string, offset long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, gap_end long, reason string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", uri)
    return int(m[1]) if m else None


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, first: int | None, revisit: bool) -> bytes:
    """One WARC record; of a revisit, the block is the HTTP header alone."""
    block = _HTTP % len(payload) + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_uri(first)}"]
    lines += [f"WARC-Payload-Digest: sha1:{payload_digest}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + END


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _digests(batches):
    for b in batches:
        texts = b.column("html").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array([t or b"" for t in texts], pa.binary()), pa.array([digest(t or b"") for t in texts])], names=["page_id", "url", "payload", "digest"])


def _records(compress: bool):
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                data = record(r["page_id"], r["url"], r["payload"], r["digest"], r["first"], r["revisit"])
                out.append(_member(data) if compress else data.removesuffix(END))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def write(pages: DataFrame, path: str, compress: bool = True, least: int = 0) -> None:
    """Writes a record for each row of pages (page_id, url, html) into folders below ``path``.

    Of rows with equal payloads of at least ``least`` bytes, that with the largest page_id is
    written as response, the rest as revisits of it; smaller payloads are all responses.  Null html
    is an empty payload; a null page_id is smaller than all others; rows that repeat payload and
    largest page_id are all responses; a null url has no target line; other columns are ignored.
    """
    light = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    rank = sum((F.when(size > most, 1).otherwise(0) for most in CLASSES), F.lit(0))
    digests = lambda df: df.mapInArrow(_digests, "page_id long, url string, payload binary, digest string")
    # Digests without payloads find the groups; sums are combined before they are dealt out.
    groups = digests(light.where(size >= least)).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("of"), "first")
    groups = staged(groups, "warc-groups")
    sep = EMPTY_MEMBER.decode("latin-1") if compress else END.decode()
    found = {r.rank for r in light.select(rank.alias("rank")).distinct().collect()}  # len(CLASSES) + 1 rows at most
    for k in sorted(found) or [0]:
        rows = digests(light.where(rank == k))
        known = rows.join(groups, F.col("digest") == F.col("of"), "left").withColumn("revisit", F.col("of").isNotNull() & (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))) & (F.length("payload") >= least))
        out = known.select("page_id", "url", "payload", "digest", "first", "revisit").mapInArrow(_records(compress), "record binary")
        most = FILE_BYTES // CLASSES[k] if k < len(CLASSES) else 1
        out.select(F.col("record").cast("string").alias("value")).write.option("lineSep", sep).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", most).text(f"{path}/class-{k}")


_CONTROL = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


class _Bad(ValueError):
    pass


def parse(data: bytes, at: int = 0, exact: bool = True) -> tuple[dict, int]:
    """The record that begins at ``at`` and its end; _Bad says which check failed."""
    if not data.startswith(VERSION, at):
        raise _Bad("no version line")
    end = data.find(END, at)
    if end < 0:
        raise _Bad("header not ended")
    if _CONTROL.search(data, at, end):
        raise _Bad("control byte in the header")
    head = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise _Bad("header line without a colon")
        head[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    try:
        length = int(head[b"content-length"])
    except (KeyError, ValueError):
        raise _Bad("no content length") from None
    block = data[end + 4 : end + 4 + length]
    stop = end + 4 + length + 4
    if len(block) < length or data[stop - 4 : stop] != END or exact and stop != len(data):
        raise _Bad("wrong length")
    if head.get(b"warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise _Bad("wrong block digest")
    kind = head.get(b"warc-type", "")
    split = block.find(END)
    http, payload = (block[:split], block[split + 4 :]) if split >= 0 and block.startswith(b"HTTP/") else (b"", block)
    known = head.get(b"warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and known and digest(payload) != known:
        raise _Bad("wrong payload digest")
    told = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    return {"page_id": _page(head.get(b"warc-record-id", "")), "url": head.get(b"warc-target-uri"), "record_type": kind, "refers_to": _page(head.get(b"warc-refers-to", "")), "payload_bytes": len(payload) if kind == "response" or not told else int(told[1]), "payload_digest": known or digest(payload), "payload": payload if kind == "response" else None}, stop


def _body(data: bytes, at: int) -> int | None:
    """Where the deflate stream of the gzip member at ``at`` begins."""
    flags, to = (data[at + 3], at + 10) if at + 10 <= len(data) else (0xFF, at)
    if flags & 0xE0:  # reserved
        return None
    if flags & 4:
        to += 2 + int.from_bytes(data[to : to + 2], "little")
    for text in (8, 16):  # name, comment
        if flags & text:
            to = data.find(b"\0", to) + 1
            if not to:
                return None
    to += 2 if flags & 2 else 0
    return to if to < len(data) else None


def _inflate(data: bytes, at: int, rescue: bool = True) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` inflates to, its end, and why it broke; a broken stream ends
    where it began, a whole one with a wrong trailer behind its trailer.  Without ``rescue`` the
    last step of a broken stream is left out."""
    begin = to = _body(data, at)
    if begin is None:
        return b"", at, "gzip: bad header"
    d, out, crc, n = zlib.decompressobj(-15), [], 0, 0
    try:
        while not d.eof and to < len(data):
            out.append(d.decompress(data[to : to + STEP]))
            crc, n = zlib.crc32(out[-1], crc), n + len(out[-1])
            to += STEP
    except zlib.error as e:
        if rescue:
            again = zlib.decompressobj(-15)
            again.decompress(data[begin:to])
            try:
                for k in range(to, min(to + STEP, len(data))):
                    out.append(again.decompress(data[k : k + 1]))
            except zlib.error:
                pass
        return b"".join(out), at, f"gzip: {e}"[:80]
    if not d.eof:
        return b"".join(out), at, "gzip member cut short"
    end = min(to, len(data)) - len(d.unused_data) + 8
    if end > len(data):
        return b"".join(out), at, "gzip member cut short"
    right = data[end - 8 : end] == struct.pack("<II", crc, n & 0xFFFFFFFF)
    return b"".join(out), end, None if right else "gzip: wrong checksum or length"


_LINE, _BEGIN = re.compile(re.escape(VERSION)), re.compile(b"|".join(map(re.escape, (MAGIC, VERSION))))


def _sound(data: bytes, at: int) -> bool:
    """Whether a member that inflates or gives a version line, or a record that passes, begins at ``at``."""
    if data.startswith(MAGIC, at):
        raw, _, why = _inflate(data, at, rescue=False)
        return why is None or raw.startswith(VERSION)
    try:
        return parse(data, at, exact=False)[1] > at
    except _Bad:
        return False


def _next(data: bytes, at: int, what: re.Pattern) -> int:
    """Where after ``at`` the next sound record or member begins."""
    return next((m.start() for m in what.finditer(data, at + 1) if _sound(data, m.start())), len(data))


def _plain(data: bytes):
    """salvage() of what a member inflates to."""
    at = 0
    while at < len(data):
        try:
            found, to = parse(data, at, exact=False)
            yield at, found, None, None
        except _Bad as e:
            to = _next(data, at, _LINE)
            yield at, None, to, str(e)
        at = to


def salvage(data: bytes):
    """Yields (offset, record, None, None) and, for quarantined bytes, (offset, None, end, reason).
    Records of a member have its offset; a gap inside a member spans the member, and its reason
    says which of the inflated bytes are meant."""
    at = 0
    while at < len(data):
        why = None
        if data.startswith(MAGIC, at):
            raw, to, why = _inflate(data, at)
            for a, found, e, inner in _plain(raw):
                if found is not None:
                    yield at, found, None, None
                elif why is None:
                    yield at, None, to, f"inflated bytes {a} to {e}: {inner}"
        else:
            try:
                found, to = parse(data, at, exact=False)
                yield at, found, None, None
            except _Bad as e:
                to, why = at, str(e)
        if why is not None:
            # A whole stream with a wrong trailer has an end, if something begins there.
            if to == at or to < len(data) and not data.startswith((MAGIC, VERSION), to):
                to = _next(data, at, _BEGIN)
            yield at, None, to, why
        at = to


def _read(batches):
    types = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), *types.items(), ("gap_end", pa.int64()), ("reason", pa.string())])
    for b in batches:
        for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
            rows, held = [], 0
            for at, rec, end, why in salvage(data):
                rows.append((rec or {}) | {"file": path, "offset": at, "gap_end": end, "reason": why})
                held += len((rec or {}).get("payload") or b"")
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records and gaps of the archives below ``path`` (columns RECORDS): a gap has null
    record columns, its first byte in ``offset``, the byte after it in ``gap_end`` and the failed
    check in ``reason``.  A task holds one file; write() bounds their bytes, and Spark refuses files
    of 2 GB and more with an error."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(_read, RECORDS)


def gaps(records: DataFrame) -> DataFrame:
    """The log of quarantined bytes: file, offset, gap_end, reason."""
    return records.where("reason is not null").select("file", "offset", "gap_end", "reason")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages as archives into the shared folder and returns what read() finds in them."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write(pages, path)
    return read(spark, path).where("reason is null").select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset")
