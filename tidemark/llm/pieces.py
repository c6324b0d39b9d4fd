"""Encoding with a SentencePiece model by a table of distinct chunks, and decoding.

Where no piece holds a whitespace marker after another character, the text between two markers is
segmented by itself: a chunk is a run of markers with what follows up to the next run.  Chunks are
counted over all texts; those that occur most, TABLE of them at most, are segmented once each in
Spark and their ids joined back to every position by a broadcast of that bounded size.  A chunk
beyond the table is rare; it is segmented where it stands, once for all its positions in a batch of
texts, since moving texts or positions to a table of all chunks and back costs more than it saves.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MODEL, MARK = "piece_bpe_32k.model", "▁"
#: Chunks of the broadcast table and the longest one in it (bytes); distinct chunks that a task counts before it passes them on.
TABLE, TABLE_BYTES, FLUSH = 150_000, 64, 300_000
_RUNS = re.compile(" *[^ ]+| +$")


def model_bytes(path: str | None = None) -> bytes:
    """A model file's content, by default that of the public model MODEL."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    with open(path, "rb") as f:
        return f.read()


def processor(model: bytes):
    """The library's processor, if chunks can be segmented apart with it."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece of this model crosses a whitespace marker")
    if "".join(sp.encode("  AÉ ﬁ  ", out_type=str)) != f"{MARK * 3}AÉ{MARK}ﬁ{MARK * 2}":
        raise ValueError("this model changes texts before it segments them")
    return sp


def chunks(text: str) -> list[str]:
    """A text's chunks in order, each without its first marker and with blanks for the others.  The library
    puts that marker before every text, and takes markers in a text for blanks."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [c[1:] for c in _RUNS.findall(f" {text}")]
    return text.split(" ")


def segment(sp, keys: list[str]) -> list[bytes]:
    """The ids of chunks, as packed ints.  A chunk of one marker alone is the empty key."""
    alone = [sp.piece_to_id(MARK)]
    return [np.array(ids if k else alone, np.int32).tobytes() for k, ids in zip(keys, sp.encode(keys, num_threads=1), strict=True)]


def chunk_counts(rows: DataFrame) -> DataFrame:
    """chunk, n over the column text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for t in b.column("text").to_pylist():
                held.update(chunks(t or ""))
                if len(held) >= FLUSH:
                    yield _pairs(held)
                    held = Counter()
        yield _pairs(held)

    return rows.mapInArrow(count, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def _pairs(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["chunk", "n"])


def chunk_table(rows: DataFrame, model, size: int = TABLE) -> DataFrame:
    """chunk, ids (packed ints): the most frequent chunks, each segmented once."""
    found = chunk_counts(rows).where((F.octet_length("chunk") <= TABLE_BYTES) & (F.col("n") > 1))
    found = staged(found.orderBy(F.desc("n"), "chunk").limit(size), "pieces-chunks")

    def run(batches):
        sp = processor(model.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("chunk"), pa.array(segment(sp, b.column("chunk").to_pylist()), pa.binary())], names=["chunk", "ids"])

    parts = max(1, size // 20_000)
    return staged(found.select("chunk").repartition(parts, "chunk").mapInArrow(run, "chunk string, ids binary"), "pieces-table")


def encode(docs: DataFrame, model: bytes | None = None, end: bool = True, table: int = TABLE) -> DataFrame:
    """doc_id, ids (array of int) of each row of docs, as the library's encode gives them, with the end id last if
    ``end``.  Null and empty texts have no pieces; repeated rows are encoded one by one; other columns are
    ignored; an empty table gives none."""
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast(model or model_bytes())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = sc.broadcast({r.chunk: bytes(r.ids) for r in chunk_table(rows.select("text"), held, table).collect()})

    def run(batches):
        sp = processor(held.value)
        last = np.array([sp.eos_id()] if end else [], np.int32).tobytes()
        for b in batches:
            texts = [chunks(t or "") for t in b.column("text").to_pylist()]
            rare = list({c for t in texts for c in t}.difference(known.value))
            local = dict(zip(rare, segment(sp, rare), strict=True))
            look = known.value
            ids = [b"".join([look[c] if c in look else local[c] for c in t]) + last for t in texts]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>")


class Surfaces:
    """ids to text, as the library's decode: pieces joined, markers as blanks but for the one that it puts
    before a text, byte pieces as bytes; what is no valid UTF-8 is left to the library."""

    def __init__(self, sp) -> None:
        self.sp = sp
        self.of = [self._surface(i) for i in range(sp.get_piece_size())]

    def _surface(self, i: int) -> bytes | None:
        if self.sp.is_byte(i):
            return bytes([int(self.sp.id_to_piece(i)[3:5], 16)])
        if self.sp.is_control(i):
            return b""
        return None if self.sp.is_unknown(i) else self.sp.id_to_piece(i).replace(MARK, " ").encode()

    def __call__(self, ids: list[int]) -> str:
        try:
            raw = b"".join([self.of[i] for i in ids])
            if raw[:1] == b" " and (first := next((i for i in ids if self.of[i]), None)) is not None and not self.sp.is_byte(first):
                raw = raw[1:]
            return raw.decode()
        except (TypeError, UnicodeDecodeError):
            return self.sp.decode(ids)


def decode(encoded: DataFrame, model: bytes | None = None) -> DataFrame:
    """doc_id, ids, text of rows (doc_id, ids); null ids have null text."""
    held = encoded.sparkSession.sparkContext.broadcast(model or model_bytes())

    def run(batches):
        of = Surfaces(processor(held.value))
        for b in batches:
            text = [None if x is None else of(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(text, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def digests(docs: DataFrame, model: bytes | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoding and decoding each row."""
    both = decode(encode(docs, model), model)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    out = both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
    return staged(out, "pieces-digests")
