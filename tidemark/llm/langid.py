"""Language identification with a byte convolutional network in numpy.

Bytes are embedded; filters of widths 2, 3 and 4 run over windows of WINDOW bytes, each filter's
maximum over the window goes into a softmax layer.  The network is trained by Adam on a bounded
sample of labelled texts (PER_LANGUAGE documents of each language).  For prediction, embeddings and
filters are multiplied out into tables over bytes and byte pairs, so that a filter's value is a
sum of two table rows; a text's distribution is the mean over all its windows.

Scale.  Only the sample reaches the driver; the network (some 10 MB as tables) is broadcast; every
text is read once, whole, with no shuffle.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import matching, row_key

#: The bounded sample: documents of a language, windows of a document.
PER_LANGUAGE, PER_DOCUMENT = 300, 4
WINDOW, EMBED, WIDTHS, FILTERS = 64, 10, (2, 3, 4), 16
EPOCHS, BATCH, RATE = 5, 64, 4e-3
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


class Network:
    def __init__(self, languages: list[str], seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"embed": rng.normal(0, 0.5, (256, EMBED))}
        for k in WIDTHS:
            self.p[f"w{k}"] = rng.normal(0, (k * EMBED) ** -0.5, (k * EMBED, FILTERS))
            self.p[f"b{k}"] = np.zeros(FILTERS)
        self.p["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages)))
        self.p["bias"] = np.zeros(len(languages))

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Cross entropy of windows x (uint8) and its gradient."""
        p, n = self.p, len(x)
        e = p["embed"][x]
        pooled, kept = [], []
        for k in WIDTHS:
            m = x.shape[1] - k + 1
            wide = np.concatenate([e[:, i : i + m] for i in range(k)], axis=2)
            z = wide @ p[f"w{k}"] + p[f"b{k}"]
            at = z.argmax(1)
            top = np.take_along_axis(z, at[:, None], 1)[:, 0]
            pooled.append(np.maximum(top, 0))
            kept.append((wide, at, top > 0))
        h = np.concatenate(pooled, 1)
        s = h @ p["out"] + p["bias"]
        s -= s.max(1, keepdims=True)
        q = np.exp(s)
        q /= q.sum(1, keepdims=True)
        loss = float(-np.log(q[np.arange(n), y] + 1e-12).mean())
        q[np.arange(n), y] -= 1
        q /= n
        g = {"out": h.T @ q, "bias": q.sum(0), "embed": np.zeros_like(p["embed"])}
        back = q @ p["out"].T
        for i, k in enumerate(WIDTHS):
            wide, at, on = kept[i]
            d = back[:, i * FILTERS : (i + 1) * FILTERS] * on
            rows = np.take_along_axis(wide, at[:, :, None], 1)  # window, filter, inputs
            g[f"w{k}"] = np.einsum("nfi,nf->if", rows, d)
            g[f"b{k}"] = d.sum(0)
            into = d[:, :, None] * p[f"w{k}"].T[None]  # window, filter, inputs
            for j in range(k):
                byte = np.take_along_axis(x, at + j, 1)
                np.add.at(g["embed"], byte, into[:, :, j * EMBED : (j + 1) * EMBED])
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 4) -> "Network":
        rng, m = np.random.default_rng(seed), {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for s in range(0, len(order), BATCH):
                _, g = self.loss(x[order[s : s + BATCH]], y[order[s : s + BATCH]])
                step += 1
                for k, v in g.items():
                    a, b = m[k]
                    a += 0.1 * (v - a)
                    b += 0.001 * (v * v - b)
                    self.p[k] -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        return self

    def tables(self) -> "Tables":
        return Tables(self)


class Tables:
    """The trained network as tables: of pairs for widths 2 and 4 (in two halves), of a pair and a byte for 3."""

    def __init__(self, net: Network) -> None:
        p, f = net.p, np.float32
        part = lambda k, j: p["embed"] @ p[f"w{k}"][j * EMBED : (j + 1) * EMBED]  # noqa: E731  256 x FILTERS
        pair = lambda k, j: (part(k, j)[:, None] + part(k, j + 1)[None]).reshape(65536, FILTERS)
        self.languages = net.languages
        # Side by side: width 2, the first pairs of 3 and 4; then the second pair of 4; then the last byte of 3.
        self.first = np.concatenate([pair(2, 0), pair(3, 0), pair(4, 0)], 1).astype(f)
        self.second, self.third = pair(4, 2).astype(f), part(3, 2).astype(f)
        self.bias = np.concatenate([p[f"b{k}"] for k in WIDTHS]).astype(f)
        self.out, self.out_bias = p["out"].astype(f), p["bias"].astype(f)

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each window (rows of WINDOW bytes)."""
        n, width = x.shape
        pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        z = self.first[pairs.ravel()].reshape(n, width - 1, 3 * FILTERS)
        f = FILTERS
        z[:, : width - 2, f : 2 * f] += self.third[x[:, 2:]]
        z[:, : width - 3, 2 * f :] += self.second[pairs[:, 2:]]
        h = np.concatenate([z[:, :, :f].max(1), z[:, : width - 2, f : 2 * f].max(1), z[:, : width - 3, 2 * f :].max(1)], 1)
        s = np.maximum(h + self.bias, 0) @ self.out + self.out_bias
        s = np.exp(s - s.max(1, keepdims=True))
        return s / s.sum(1, keepdims=True)


def cut(raw: bytes) -> np.ndarray:
    """The text's windows; the last is filled up with spaces."""
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b" "), np.uint8).reshape(n, WINDOW)


def has_letter(raw: bytes | None) -> bool:
    """Whether a character of Unicode's letter categories is in the text; \\p{L} means the same in train()."""
    return raw is not None and (_ASCII_LETTER.search(raw) is not None or any(map(str.isalpha, raw.decode("utf-8", "replace"))))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sampled(batches):
    """Up to PER_DOCUMENT windows of each text, from anywhere in it; of the last, filled-up window only if it is the only one."""
    for b in batches:
        rows = []
        for lang, key, t in zip(b.column("lang").to_pylist(), b.column("key").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
            w = cut(t)
            picks = np.random.default_rng(key & 0xFFFFFFFF).permutation(max(1, len(w) - 1))[:PER_DOCUMENT]
            rows += [(lang, key, w[i].tobytes()) for i in picks]
        cols = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], names=["lang", "key", "window"])


def train(docs: DataFrame) -> Network | None:
    """Fits a network on the documents that are not held out, have a language and a letter: of
    each language the PER_LANGUAGE with the least hashes, of each text up to PER_DOCUMENT windows.
    Repeated rows count once."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), row_key().alias("key"), held_out().alias("out")).where("not out and lang is not null and text is not null and text rlike '\\\\p{L}'")
    rows = rows.select("lang", "key", "text", F.xxhash64("lang", "key").alias("pick"))
    least = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    chosen = rows.select("lang", "key", "pick").distinct().withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= PER_LANGUAGE).select("pick")
    sample = matching(rows, chosen, "pick").dropDuplicates(["pick"]).select("lang", "key", "text").mapInArrow(_sampled, "lang string, key long, window binary").orderBy("lang", "key", "window").collect()
    languages = sorted({r.lang for r in sample})
    if not languages:
        return None
    x = np.array([np.frombuffer(r.window, np.uint8) for r in sample])
    y = np.array([languages.index(r.lang) for r in sample])
    return Network(languages).train(x, y)


def _predict(shared):
    def run(batches):
        net = shared.value
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            names, scores = [], []
            for t in texts:
                if net is None or not has_letter(t):
                    names.append("und")
                    scores.append(0.0)
                    continue
                w, total = cut(t), 0.0
                for s in range(0, len(w), 256):
                    total = total + net.windows(w[s : s + 256]).sum(0, dtype=np.float64)
                mean = total / len(w)
                best = int(mean.argmax())
                names.append(net.languages[best])
                scores.append(float(min(1.0, mean[best])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter are ``und`` with score 0, as are all where nothing could
    be learned; a null doc_id is never held out; repeated rows get equal results; an empty table
    gives none.  lang serves training only; other columns are ignored.
    """
    net = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(net.tables() if net else None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    return rows.mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")
