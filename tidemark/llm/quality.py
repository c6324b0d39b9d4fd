"""Quality rules: robust outlier rejection by minimum-covariance-determinant estimates.

Every document becomes a vector of five transformed statistics.  For each language and source
the regularised minimum-covariance-determinant (MCD) estimate is found by concentration steps
(Rousseeuw and Van Driessen 1999, deterministic starts as in Hubert et al. 2012), and documents
whose squared Mahalanobis distance from it exceeds a chi-square quantile are rejected.  Length
counts on one side only: a document is measured as of the best length up to its own.

Scale.  The text is read once.  A concentration step is one join of the statistics with the
groups' estimates and one aggregation by (group, start, distance bin): sums are combined before
the shuffle, a hot group is at most BINS rows per task, and no group meets in one task.  The
vectors are rounded to 1/256, so all sums are exact integers and reruns agree in every bit.  Distances
are binned by 1/64 of their logarithm, so a step takes the nearest share to a bin: the last bin
counts in part, by weight.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, staged

SYMBOLS = b"#*$%&|<>"
STATS = "n_words long, n_lines long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: Names of the transformed statistics, in the order of the vectors.
VECTOR = ("log_words", "log_word_length", "log_symbol_rate", "log_dup_line_rate", "log_repeat_rate")
DIM, UNIT, BINS = len(VECTOR), 256, 640
#: Variance added to each statistic: a source in which nearly all documents have the same value must
#: not reject the rest, and yet each statistic alone must be able to pass the cutoff.
FLOOR = (0.3**2, 0.1**2, 0.4**2, 0.35**2, 0.35**2)
#: Lines added to a document's when its share of repeated lines is taken: of few lines one says little.
PRIOR_LINES = 4
MIN_ROWS, SUBSET, STEPS = 60, 0.75, 4
CUTOFF = 0.9999
#: Groups whose estimates (some 400 bytes each) may be broadcast; beyond it the join shuffles.
BROADCAST_GROUPS = 50_000


def chi2_quantile(p: float, df: int) -> float:
    """Wilson and Hilferty's cube approximation."""
    from statistics import NormalDist

    return df * (1 - 2 / (9 * df) + NormalDist().inv_cdf(p) * math.sqrt(2 / (9 * df))) ** 3


def text_statistics(raw: bytes | None) -> tuple[int, int, int, int, int, int]:
    """Of one text: words, lines with a word, code points in words, symbols, repeated lines and
    words inside 3-word windows found at least twice."""
    raw = raw or b""
    words = raw.split()  # bytes.split() splits at exactly \x20 and \x09-\x0D
    seen: set[bytes] = set()
    lines = dup = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            dup += line in seen
            seen.add(line)
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    n, repeated = len(words), 0
    if n > 3:
        ids: dict[bytes, int] = {}
        w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
        k = (w[:-2] << 42) | (w[1:-1] << 21) | w[2:] if len(ids) < 1 << 21 else np.unique(np.stack([w[:-2], w[1:-1], w[2:]], 1), axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(k, kind="stable")
        same = k[order][1:] == k[order][:-1]
        hit = np.zeros(n - 2, bool)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        cover = np.zeros(n, bool)
        cover[:-2] |= hit
        cover[1:-1] |= hit
        cover[2:] |= hit
        repeated = int(cover.sum())
    return n, lines, chars, symbols, dup, repeated


def _statistics(batches):
    for b in batches:
        rows = [text_statistics(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
        cols = np.array(rows, np.int64).reshape(-1, 6).T
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "row_key", "lang", "source")), *(pa.array(c) for c in cols)], names=["doc_id", "row_key", "lang", "source", "n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


def _key() -> F.Column:
    """What decides a verdict: rows equal in id and text differ in it if language or source differ."""
    return F.xxhash64(row_key(), "lang", "source", F.col("lang").isNull(), F.col("source").isNull())


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row_key (of id, text, lang and source), lang, source and the base statistics."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("row_key"), "lang", "source", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_statistics, f"doc_id long, row_key long, lang string, source string, {STATS}")


def _vector() -> list[F.Column]:
    words, rate = F.col("n_words"), lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    raw = (
        F.log1p(words),
        F.log((F.col("word_chars") + 1) / (words + 1)),
        F.log1p(200 * rate("n_symbols", "word_chars")),
        F.log1p(20 * F.col("n_dup_lines") / (F.col("n_lines") + PRIOR_LINES)),
        F.log1p(20 * rate("n_repeat_words", "n_words")),
    )
    return [F.round(x * UNIT).cast("long") for x in raw]


def _groups(vectors: DataFrame) -> DataFrame:
    """Adds ``grp``: language and source; sources of fewer than MIN_ROWS documents pool within
    their language, languages with too few such documents pool with each other, and what then
    remains too small has null and gets no verdict."""
    tag = lambda *c: F.concat_ws("\x1f", *(F.concat(F.when(F.col(x).isNull(), "n").otherwise("v"), F.coalesce(F.col(x), F.lit(""))) for x in c))
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("grp", F.when(F.col("n") >= MIN_ROWS, tag("lang", "source")))
    small = sizes.where("grp is null")
    langs = small.groupBy("lang").agg(F.sum("n").alias("pool"))
    rest = langs.where(F.col("pool") < MIN_ROWS).agg(F.coalesce(F.sum("pool"), F.lit(0)).alias("rest"))
    langs = langs.crossJoin(F.broadcast(rest)).select(F.col("lang").alias("lang2"), F.when(F.col("pool") >= MIN_ROWS, tag("lang")).when(F.col("rest") >= MIN_ROWS, F.lit("*")).alias("pooled"))
    named = sizes.join(langs, F.col("lang").eqNullSafe(F.col("lang2")), "left").select(F.col("lang").alias("lang3"), F.col("source").alias("source3"), F.coalesce("grp", "pooled").alias("grp"))
    return vectors.join(named, F.col("lang").eqNullSafe(F.col("lang3")) & F.col("source").eqNullSafe(F.col("source3")), "left").drop("lang3", "source3")


_PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
_Q = [f"q{i}" for i in range(DIM)]
_PARAMS = "grp string, start int, center array<double>, precision array<double>, log_det double, scale double"


def _estimate(n: float, sums: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    mean = sums / n
    cov = np.empty((DIM, DIM))
    for (i, j), s in zip(_PAIRS, squares, strict=True):
        cov[i, j] = cov[j, i] = s / n - mean[i] * mean[j]
    cov = cov / UNIT**2 + np.diag(FLOOR)
    return mean / UNIT, np.linalg.inv(cov), float(np.linalg.slogdet(cov)[1])


def _concentrate(share: float | None):
    """From the sums by distance bin to the next estimate: of the nearest ``share`` of the rows,
    or (None) of all rows within the 97.5 % quantile of the scaled distances."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = pdf["n"].to_numpy(float)
        values = pdf[[f"s{i}" for i in range(DIM)] + [f"s{i}_{j}" for i, j in _PAIRS]].to_numpy(float)
        total, before = n.sum(), np.concatenate([[0], np.cumsum(n)[:-1]])
        half = int(np.searchsorted(before + n, total / 2))
        scale = max(_edge(pdf["bin"].iloc[half] + 0.5) / chi2_quantile(0.5, DIM), 1e-6)
        if share is None:
            weight = (_edge(pdf["bin"].to_numpy(float)) <= chi2_quantile(0.975, DIM) * scale).astype(float)
        else:
            weight = np.clip((share * total - before) / n, 0, 1)
        s = (values * weight[:, None]).sum(0)
        mean, prec, det = _estimate(float((n * weight).sum()), s[:DIM], s[DIM:])
        return pd.DataFrame({"grp": [key[0]], "start": [key[1]], "center": [mean.tolist()], "precision": [prec.ravel().tolist()], "log_det": [det], "scale": [scale]})

    return one


def _edge(b):
    """The squared distance at which bin b begins: bins are even in its logarithm."""
    return np.expm1(b / 64)


def _distance(one_sided: bool = False) -> F.Column:
    """The squared distance; one_sided, the least for any length from the centre's up to the document's own."""
    d = [f"(q{i} / {UNIT}D - center[{i}])" for i in range(DIM)]
    if one_sided:
        pull = " + ".join(f"precision[{j}] * {d[j]}" for j in range(1, DIM))
        d[0] = f"least({d[0]}, greatest(0D, -({pull}) / precision[0]))"
    return F.expr(" + ".join(f"{1 if i == j else 2} * precision[{i * DIM + j}] * {d[i]} * {d[j]}" for i, j in _PAIRS))


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("grp", "start", "bin").agg(F.count("*").alias("n"), *(F.sum(q).alias(f"s{i}") for i, q in enumerate(_Q)), *(F.sum(F.col(_Q[i]) * F.col(_Q[j])).alias(f"s{i}_{j}") for i, j in _PAIRS))


def _measured(vectors: DataFrame, params: DataFrame) -> DataFrame:
    return vectors.join(params, "grp").withColumn("d2", F.greatest(_distance(), F.lit(0.0)))


def estimates(vectors: DataFrame) -> DataFrame:
    """The MCD estimate of each group: grp, center, precision, scale (the consistency factor)."""
    used = vectors.where("grp is not null").select("grp", *_Q)
    bins = F.least(F.lit(BINS), F.floor(F.log1p("d2") * 64)).cast("int")
    # Starts: 0, all rows; 1, medians with the spread of the central half.
    whole = _sums(used.withColumn("start", F.lit(0)).withColumn("bin", F.lit(0))).groupBy("grp", "start").applyInPandas(_concentrate(1.0), _PARAMS)
    quart = used.groupBy("grp").agg(*(F.percentile_approx(q, F.array(*map(F.lit, (0.25, 0.5, 0.75))), 10_000).alias(q) for q in _Q))
    var = lambda i: F.pow((F.get(_Q[i], F.lit(2)) - F.get(_Q[i], F.lit(0))) / (1.349 * UNIT), 2) + FLOOR[i]
    middle = quart.select(
        "grp", F.lit(1).alias("start"), F.array(*((F.get(q, F.lit(1)) / UNIT).cast("double") for q in _Q)).alias("center"),
        F.array(*(1 / var(i) if i == j else F.lit(0.0) for i in range(DIM) for j in range(DIM))).alias("precision"), F.lit(0.0).alias("log_det"), F.lit(1.0).alias("scale"),
    )
    params = whole.unionByName(middle)
    for _ in range(STEPS):
        params = _sums(_measured(used, params).withColumn("bin", bins)).groupBy("grp", "start").applyInPandas(_concentrate(SUBSET), _PARAMS)
        params = staged(params, "quality-estimates")
    best = params.groupBy("grp").agg(F.min_by(F.struct("start", "center", "precision", "log_det", "scale"), F.struct("log_det", "start")).alias("b")).select("grp", "b.*")
    best = _sums(_measured(used, best).withColumn("bin", bins)).groupBy("grp", "start").applyInPandas(_concentrate(None), _PARAMS)
    best = staged(best, "quality-estimates")
    last = _sums(_measured(used, best).withColumn("bin", bins)).groupBy("grp", "start").applyInPandas(_concentrate(1.0), _PARAMS).select("grp", F.col("scale").alias("final"))
    return best.join(last, "grp").select("grp", "center", "precision", F.greatest("final", F.lit(1.0)).alias("scale"))


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text, lang, source; other columns are ignored): the base
    statistics, base_failed, distance (null without an estimate) and kept.

    Null text counts as empty and, having fewer than 50 words, fails the base rules; null lang or
    source is a value of its own; repeated rows get equal results; an empty table gives none.
    Groups below MIN_ROWS documents pool as in _groups and without any estimate pass the method.
    """
    stats = staged(statistics(docs).select("*", *(c.alias(q) for c, q in zip(_vector(), _Q, strict=True))), "quality-stats")
    vectors = staged(_groups(stats), "quality-groups")
    found = staged(estimates(vectors), "quality-estimates")
    found = F.broadcast(found) if found.count() <= BROADCAST_GROUPS else found
    scored = vectors.join(found, "grp", "left").withColumn("distance", F.greatest(_distance(one_sided=True), F.lit(0.0)) / F.col("scale"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    inside = F.coalesce(F.col("distance") <= chi2_quantile(CUTOFF, DIM), F.lit(True))
    return scored.select("doc_id", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & inside).alias("kept"), "distance")


def reject(docs: DataFrame) -> DataFrame:
    """docs without the rows that verdicts() rejects, with all columns of docs.  Odd rows are as there."""
    from .common import matching

    key = fresh(docs, "row_key_")
    bad = staged(verdicts(docs).where("not kept").select(F.col("row_key").alias(key)).distinct(), "quality-rejected")
    return matching(docs.withColumn(key, _key()), bad, key, "left_anti").drop(key)
