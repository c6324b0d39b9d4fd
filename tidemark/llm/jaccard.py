"""n-gram Jaccard join with token-combination prefixes (k-wise signatures, Wang et al. 2016).

A document is its set of five-word shingles.  Shingles in at least ``frequent`` documents form the
frequent class, ordered after all rare ones; within a class the order is that of the hashes.  If
two sets reach the threshold, at most n - ceil(0.75 n) = t of a set's n shingles are missing in the
other.  A prefix of t + 1 rare shingles then shares one with the other's prefix, so rare shingles
are indexed singly.  Where the prefix must be extended into the frequent class, that class is
dealt to sub-classes; k shingles of a sub-class count k - 1, since among them t mismatches leave
two shared ones only if k - 1 exceeds the mismatches there, and pairs within sub-classes are
indexed.  Whichever set's prefix ends first in the global order, what it shares lies in both
prefixes, so no pair is lost.  Candidates are verified on the whole sets.

Of a pair the smaller set shares at least 6/7 of its own shingles, so for the smaller one a prefix of
n - ceil(6/7 n) + 1 will do: it is marked ``index``, and a pair meets only where the smaller set's
entry is marked (both, if they are equally large).  Pages that share a template but differ in more
than a seventh therefore never meet in the template's shingles.

Equal sets are one node from the start.  A rare signature of up to FREQUENT nodes gives all their
pairs.  Any other signature may be hot: its nodes are first compared with two pivots only;
components are formed; and only signatures that still join several components give further pairs,
each between nodes not yet connected.  Before texts are read, every pair must pass a bitmap filter
(after Sandes et al. 2017): the parities of a set's hashes in BITS cells differ in no more cells than
the sets differ in shingles, so what differs in more cells than a link allows is no link.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Windows, distinct, fresh, hash_words, matching, mix, row_key, staged
from .components import components
from .packed import PER_BUCKET, _split, repeats, text_bytes

SHINGLE, PERCENT = 5, 75
#: Least document frequency of a frequent shingle; doubled until MAX_FREQUENT shingles (8 bytes each, broadcast) suffice.
FREQUENT, MAX_FREQUENT = 32, 1_000_000
PER_SUBCLASS = 4
#: Cells of the bitmap filter, in long columns; sets of over BITS / 2 shingles have a second, finer
#: bitmap of two cells a shingle or more.  Bytes of the texts of one group of pairs to verify.
BITS, PAIR_BYTES = 512, 24 << 20
CELLS = [f"c{i}" for i in range(BITS // 64)]


class Shingles:
    """Texts (bytes or None) to sorted distinct shingle hashes."""

    def __init__(self) -> None:
        self.windows = Windows()

    def __call__(self, raw: bytes | None) -> np.ndarray:
        w = hash_words(raw.lower() if raw else None)  # bytes.lower() lowers A-Z only
        return distinct(self.windows(w, min(SHINGLE, len(w)))) if len(w) else w


def node_of(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def _rows(b: pa.RecordBatch):
    return b.column("text").cast(pa.binary()).to_pylist()


def cells(s: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parities of the numbers of shingles in each of ``bits`` cells (a power of two), as longs.
    The first half of twice as many cells, xor the second, is the same."""
    at = (mix(s ^ np.uint64(0x2F)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def fine_cells(s: np.ndarray) -> bytes | None:
    return None if 2 * len(s) <= BITS else cells(s, 1 << (2 * len(s) - 1).bit_length()).tobytes()


def may_link(n: int, m: int, x: bytes, y: bytes) -> bool:
    """Whether fine cells of sets of n and m shingles allow a link."""
    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(p) > len(q):
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    while len(q) > len(p):
        q = q[: len(q) // 2] ^ q[len(q) // 2 :]
    return (100 + PERCENT) * int(np.bitwise_count(p ^ q).sum()) <= (100 - PERCENT) * (n + m)


_NODES = "doc_id long, key long, n long, bytes long, node long, fine binary, " + ", ".join(f"{c} long" for c in CELLS)


def _nodes(batches):
    make, empty = Shingles(), np.zeros(len(CELLS), np.int64)
    for b in batches:
        texts = _rows(b)
        sets = [make(t) for t in texts]
        drawn = np.array([cells(s) if len(s) else empty for s in sets], np.int64).reshape(-1, len(CELLS)).T
        cols = [pa.array([len(s) for s in sets], pa.int64()), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([fine_cells(s) for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), *cols, *(pa.array(c) for c in drawn)], names=["doc_id", "key", "n", "bytes", "node", "fine", *CELLS])


#: Shingles that a map task gathers before it passes them on.
FLUSH = 800_000


def _distinct_sets(batches):
    """Sets, once per flush for equal ones."""
    make, out, held = Shingles(), {}, 0
    for b in batches:
        for t in _rows(b):
            s = make(t)
            if len(s) and (node := node_of(s)) not in out:
                out[node] = s
                held += len(s)
                if held >= FLUSH:
                    yield out
                    out, held = {}, 0
    if out:
        yield out


def _short(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.uint64(buckets)
    return (h % r).astype(np.int32), ((h // r) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _join(s, t) -> np.ndarray:
    return np.frombuffer(b"".join(s), t)


def frequencies(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """token (a shingle's hash by bucket and 32 more bits), df of the shingles in FREQUENT documents or more."""
    buckets = max(8, int(size / 5.5 / 2 / PER_BUCKET) + 1)

    def count(batches):
        for sets in _distinct_sets(batches):
            h = np.sort(np.concatenate(list(sets.values())))
            at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            h, c = h[at], np.diff(np.append(at, len(h)))
            bucket, short = _short(h, buckets)
            got = list(zip(*_split(bucket, short, c.astype(np.uint32)), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.int32()), pa.array(got[1], pa.binary()), pa.array(got[2], pa.binary())], names=["bucket", "tokens", "counts"])

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t, c = _join(pdf["tokens"], np.uint32), _join(pdf["counts"], np.uint32).astype(np.int64)
        order = np.argsort(t, kind="stable")
        t, c = t[order], c[order]
        at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        n = np.add.reduceat(c, at)
        many = n >= FREQUENT
        return pd.DataFrame({"token": t[at][many].astype(np.int64) * buckets + key[0], "df": n[many]})

    return rows.mapInArrow(count, "bucket int, tokens binary, counts binary").groupBy("bucket").applyInPandas(add, "token long, df long"), buckets


def band(n: int) -> int:
    return int(np.log(n) / np.log(4 / 3) + 1e-9)


def signatures(s: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a set (sorted hashes) with its frequent shingles marked: the single signatures and which of them
    are of the index prefix, the pair signatures, which of these are of the next band and which of the
    index prefix.  Sets within the ratio are of one band, or one is of the band below the other's: a
    pair meets in the upper one's own band, never in two ``next`` ones, where the lower one is the
    smaller set."""
    n = len(s)
    need = n + (-PERCENT * n // 100) + 1  # n - ceil(0.75 n) + 1
    index = n + (-2 * PERCENT * n // (100 + PERCENT)) + 1  # n - ceil(6/7 n) + 1
    rare = s[~common]
    none = np.empty(0, bool)
    if len(rare) >= need:
        return mix(rare[:need] ^ np.uint64(0x5151)), np.arange(need) < index, np.empty(0, np.uint64), none, none
    freq, pairs, marks, own = s[common], [], [], 0
    for b in (band(n), band(n) + 1):
        m = max(1, int((4 / 3) ** b / PER_SUBCLASS))
        sub = (mix(freq ^ np.uint64(0xABCD)) % np.uint64(m)).astype(np.int64)
        order = np.argsort(sub, kind="stable")
        first = np.ones(len(freq), bool)
        first[order[1:]] = sub[order[1:]] != sub[order[:-1]]
        weight = np.cumsum(~first)
        upto = lambda want, weight=weight: int(np.searchsorted(weight, want - len(rare))) + 1 if want > len(rare) else 0
        short = upto(index)
        order = order[order < (upto(need) if b == band(n) else short)]
        t, g = freq[order], sub[order]
        for d in range(1, len(t)):
            same = g[d:] == g[:-d]
            if not same.any():
                break
            pairs.append(mix(t[:-d][same] * np.uint64(0x9E3779B97F4A7C15) + (t[d:][same] ^ np.uint64(b))))
            marks.append(np.maximum(order[:-d], order[d:])[same] < short)
        if b == band(n):
            own = sum(map(len, pairs))
    pairs_, marks_ = (np.concatenate(pairs), np.concatenate(marks)) if pairs else (np.empty(0, np.uint64), none)
    return mix(rare ^ np.uint64(0x5151)), np.arange(len(rare)) < index, pairs_, np.arange(len(pairs_)) >= own, marks_


_PACKED = "bucket int, sigs binary, nodes binary, sizes binary, indexed binary, frequent binary, low binary"


def _signatures(rows: DataFrame, common, short: int, buckets: int) -> DataFrame:
    """Packed rows of signatures: single ones by bucket, pair signatures in bucket -1."""

    def send(batches):
        known = common.value
        for sets in _distinct_sets(batches):
            single, pair = [], []
            for node, s in sets.items():
                bucket, token = _short(s, short)
                t = token.astype(np.int64) * short + bucket
                at = np.minimum(np.searchsorted(known, t), max(len(known) - 1, 0))
                marks = known[at] == t if len(known) else np.zeros(len(s), bool)
                a, i, b, low, j = signatures(s, marks)
                single.append((a, np.full(len(a), node, np.int64), np.full(len(a), len(s), np.int32), i))
                pair.append((b, np.full(len(b), node, np.int64), np.full(len(b), len(s), np.int32), j, np.full(len(b), int(marks.sum()), np.int32), low))
            h, k, n, i = (np.concatenate(x) for x in zip(*single, strict=True))
            out = [(*r, b"", b"") for r in _split((h % np.uint64(buckets)).astype(np.int32), h, k, n, i)]
            cols = [np.concatenate(x) for x in zip(*pair, strict=True)]
            out += [(-1, *(x[at : at + PAIR_ROWS].tobytes() for x in cols)) for at in range(0, len(cols[0]), PAIR_ROWS)]
            cols = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["bucket", "sigs", "nodes", "sizes", "indexed", "frequent", "low"])

    return staged(rows.mapInArrow(send, _PACKED), "jaccard-signatures")


def compatible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b).astype(np.int64) >= PERCENT * np.maximum(a, b).astype(np.int64)


def _counted(rows: np.ndarray) -> np.ndarray:
    """Rows (a, b, count) with equal (a, b) added up."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    at = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)]))
    return np.column_stack([rows[at, :2], np.add.reduceat(rows[:, 2], at)])


def _single_pairs(packed: DataFrame, buckets: int) -> DataFrame:
    """a < b, shared: nodes whose sizes allow a link and how many rare signatures they share; of
    signatures with more than FREQUENT nodes instead rows (a: signature, b: node, shared: twice the size,
    and one more if of the index prefix, hot).  A pair may meet in many buckets: what they find travels
    packed, and becomes one row."""

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        cols = [_join(pdf[c], t) for c, t in (("sigs", np.uint64), ("nodes", np.int64), ("sizes", np.int32), ("indexed", bool))]
        order = np.lexsort((cols[1], cols[0]))
        h, k, n, i = (c[order] for c in cols)
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])])  # a node is sent once by each task
        h, k, n, i = (c[new] for c in (h, k, n, i))
        new = repeats(h)
        h, k, n, i = (c[new] for c in (h, k, n, i))
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
        many = np.repeat(np.diff(np.append(first, len(h))) > FREQUENT, np.diff(np.append(first, len(h))))
        hot = np.stack([h[many].view(np.int64), k[many], 2 * n[many].astype(np.int64) + i[many]], 1)
        h, k, n, i = (c[~many] for c in (h, k, n, i))
        found = np.empty((0, 3), np.int64)
        for d in range(1, FREQUENT):
            same = h[d:] == h[:-d]
            if not same.any():
                break
            ok = same & compatible(n[d:], n[:-d]) & (i[:-d] | (n[d:] < n[:-d])) & (i[d:] | (n[:-d] < n[d:]))
            found = _counted(np.concatenate([found, np.stack([k[:-d][ok], k[d:][ok], np.ones(int(ok.sum()), np.int64)], 1)]))
        to = lambda rows: (rows[:, 0].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        out = [(*r, is_hot) for rows, is_hot in ((found, False), (hot, True)) for r in _split(to(rows), *rows.T)]
        return pd.DataFrame(out, columns=["bucket", "a", "b", "shared", "hot"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for is_hot, part in pdf.groupby("hot"):
            rows = np.column_stack([_join(part[c], np.int64) for c in ("a", "b", "shared")])
            parts.append(pd.DataFrame(rows if is_hot else _counted(rows), columns=["a", "b", "shared"]).assign(hot=bool(is_hot)))
        return pd.concat(parts)

    met = packed.where("bucket >= 0").groupBy("bucket").applyInPandas(meet, "bucket int, a binary, b binary, shared binary, hot boolean")
    return met.groupBy("bucket").applyInPandas(merge, "a long, b long, shared long, hot boolean")


#: Pair signatures in one packed row.
PAIR_ROWS = 50_000


def _pair_signatures(packed: DataFrame) -> DataFrame:
    def unpack(batches):
        for b in batches:
            cols = [np.frombuffer(b"".join(b.column(c).to_pylist()), t) for c, t in zip(("sigs", "nodes", "sizes", "frequent", "low", "indexed"), (np.int64, np.int64, np.int32, np.int32, bool, bool), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["sig", "node", "n", "f", "low", "indexed"])

    return packed.where("bucket = -1").mapInArrow(unpack, "sig long, node long, n int, f int, low boolean, indexed boolean")


#: Sets with pair signatures index all their rare shingles singly.  So two of them that meet in pair
#: signatures only share frequent shingles only, at most the smaller number f of them, which must be
#: PERCENT / (100 + PERCENT) of both sizes together.
_FIT = f"{100 + PERCENT}L * least(f, g) >= {PERCENT}L * (n + m)"


def _differ(a: str, b: str) -> str:
    """Whether two rows' cells and sizes (columns named by these patterns) allow a link: sets of sizes n
    and m that link differ in (100 - PERCENT) / (100 + PERCENT) of n + m shingles at most."""
    cells_ = " + ".join(f"bit_count({a.format(c)} ^ {b.format(c)})" for c in CELLS)
    return f"{100 + PERCENT}L * ({cells_}) <= {100 - PERCENT}L * ({a.format('n')} + {b.format('n')})"


def _plausible(pairs: DataFrame, classes: DataFrame, fine: DataFrame) -> DataFrame:
    """The pairs (a, b, shared) that pass the bitmap filter, with ``bytes`` of their texts."""
    of = lambda c: classes.select(*(F.col(x).alias(f"{x}_{c}") for x in ("node", "n", "bytes", *CELLS)))
    both = pairs.join(of("a"), F.col("a") == F.col("node_a")).join(of("b"), F.col("b") == F.col("node_b")).where(_differ("{}_a", "{}_b"))
    both = both.select("a", "b", "shared", (F.col("bytes_a") + F.col("bytes_b")).alias("bytes"), F.col("n_a").alias("n"), F.col("n_b").alias("m"))
    return _finer(staged(both, "jaccard-coarse"), fine)


def _finer(pairs: DataFrame, fine: DataFrame) -> DataFrame:
    """Of pairs (a, b, shared, bytes, n, m) those that pass the finer bitmaps, where both sets have one."""

    def check(batches):
        for b in batches:
            ok = [may_link(*r) for r in zip(*(b.column(c).to_pylist() for c in ("n", "m", "x", "y")), strict=True)]
            yield b.select(["a", "b", "shared", "bytes"]).filter(pa.array(ok, pa.bool_()))

    large = F.least("n", "m") * 2 > BITS
    of = lambda c, out: fine.select(F.col("node").alias(c), F.col("fine").alias(out))
    met = pairs.where(large).join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "shared", "bytes", "n", "m", "x", "y")
    return pairs.where(~large).select("a", "b", "shared", "bytes").unionByName(met.mapInArrow(check, "a long, b long, shared long, bytes long"))


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold.  A node's pairs are dealt to as many groups
    as PAIR_BYTES of texts make, and each group gets a text once."""
    total = F.sum("bytes")
    groups = int((pairs.agg(total).first()[0] or 0) // PAIR_BYTES) + 1
    spread = pairs.groupBy("a").agg(F.ceil(total / PAIR_BYTES).alias("parts"))
    dealt = pairs.join(spread, "a").select("a", "b", F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), "parts")), F.lit(groups)).cast("int").alias("grp"))
    dealt = staged(dealt, "jaccard-dealt")
    needed = dealt.select("grp", F.col("a").alias("node")).unionByName(dealt.select("grp", F.col("b").alias("node"))).distinct()
    needed = staged(classes.select("node", "key", "copies").join(needed, "node"), "jaccard-needed")
    wanted = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed
    texts = rows.join(wanted, "key").select("grp", "node", "copies", "text")
    if needed.where("copies > 1").limit(1).count():  # rows that repeat id and text: one of them is sent
        texts = texts.where("copies = 1").unionByName(texts.where("copies > 1").groupBy("grp", "node").agg(F.lit(1).cast("long").alias("copies"), F.first("text").alias("text")))
    sent = texts.select("grp", F.col("node").alias("a"), F.col("node").alias("b"), F.col("text").cast("binary").alias("text")).unionByName(dealt.select("grp", "a", "b", F.lit(None).cast("binary").alias("text")))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        make = Shingles()
        ab, held = pdf[["a", "b"]].to_numpy(), pdf["text"].notna().to_numpy()
        sets = {node: make(t) for node, t in zip(ab[held, 0].tolist(), pdf["text"].to_numpy()[held], strict=True)}
        ab = ab[~held]
        ok = np.zeros(len(ab), bool)
        for i, (a, b) in enumerate(ab.tolist()):
            both = np.sort(np.concatenate([sets[a], sets[b]]))
            shared = int((both[1:] == both[:-1]).sum())
            ok[i] = 100 * shared >= PERCENT * (len(both) - shared)
        return pd.DataFrame(ab[ok], columns=["a", "b"])

    return sent.groupBy("grp").applyInPandas(verify, "a long, b long")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes lie in different components."""
    of = lambda c: roots.select(F.col("node").alias(f"node_{c}"), F.col("root").alias(f"root_{c}"))
    both = pairs.join(of("a"), F.col("a") == F.col("node_a"), "left").join(of("b"), F.col("b") == F.col("node_b"), "left")
    return both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(*pairs.columns)


def linked_nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their node (doc_id, key, n, node; null for empty sets), and of all nodes that
    link with another the component (node, root)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("key"))
    nodes = staged(rows.mapInArrow(_nodes, _NODES), "jaccard-nodes")
    least = {x: F.min(x).alias(x) for x in ("n", "bytes", *CELLS)}
    keyed = nodes.where("node is not null").groupBy("node", "key").agg(F.count("*").alias("copies"), *least.values())
    classes = staged(keyed.groupBy("node").agg(*least.values(), F.min(F.struct("key", "copies")).alias("k")).select("node", *least, "k.key", "k.copies"), "jaccard-classes")
    fine = staged(nodes.where("fine is not null").groupBy("node").agg(F.first("fine").alias("fine")), "jaccard-cells")
    texts, size, sc = rows.select("text"), text_bytes(rows), docs.sparkSession.sparkContext
    found, short = frequencies(texts, size)
    found = staged(found, "jaccard-frequent")
    steps = {r.p: r.n for r in found.groupBy(F.floor(F.log2("df")).alias("p")).agg(F.count("*").alias("n")).collect()}
    bound = FREQUENT
    while sum(n for p, n in steps.items() if 2**p >= bound) > MAX_FREQUENT:
        bound *= 2
    tokens = np.sort(np.array([r.token for r in found.where(F.col("df") >= bound).select("token").collect()], np.int64))
    buckets = max(8, int(size / 5.5 / 2 / PER_BUCKET) + 1)
    packed = _signatures(texts, sc.broadcast(tokens), short, buckets)
    single = staged(_single_pairs(packed, buckets), "jaccard-single")
    size_ = F.expr("shared div 2").cast("int")
    hot = single.where("hot").select(F.col("a").alias("sig"), F.col("b").alias("node"), size_.alias("n"), size_.alias("f"), F.lit(False).alias("low"), (F.col("shared") % 2 == 1).alias("indexed"))
    shared = staged(_pair_signatures(packed).unionByName(hot).distinct(), "jaccard-pair-signatures")
    # Two pivots: the node with the largest share of frequent shingles, which an original has among
    # its edited copies, and one by hash, which differs from signature to signature.
    member, central = F.struct("node", "n", "f", "low"), F.struct(~F.col("low"), F.col("f") / F.col("n"), F.col("node"))
    pivots = shared.groupBy("sig").agg(F.array_distinct(F.array(F.max_by(member, central), F.min_by(member, F.struct("low", F.xxhash64("sig", "node"))))).alias("ps"), F.count("*").alias("c"), F.max("indexed").alias("any")).where("c > 1 and any")
    pivots = pivots.select("sig", F.explode("ps").alias("p")).where("not p.low").select("sig", F.col("p.node").alias("pivot"), F.col("p.n").alias("m"), F.col("p.f").alias("g"))
    starred = shared.join(pivots, "sig").where(f"node <> pivot and {_FIT}").groupBy(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).agg(F.count("*").alias("shared"))
    tried = single.where("not hot").drop("hot").unionByName(starred).groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    tried = staged(_plausible(tried, classes, fine), "jaccard-candidates")
    roots = _connected(tried, rows, classes, None)
    # What shares a pair signature but no component, was not compared yet and passes the bitmap filter:
    # entries of the index prefix meet those of larger sets.
    torn = staged(_torn(shared, roots, classes), "jaccard-torn")
    other = torn.select("sig", F.col("node").alias("node2"), F.col("root").alias("root2"), F.col("n").alias("m"), F.col("f").alias("g"), F.col("low").alias("low2"), F.col("indexed").alias("indexed2"), F.col("bytes").alias("bytes2"), *(F.col(c).alias(f"{c}_2") for c in CELLS))
    met = torn.where("indexed").join(other, "sig").where(f"(n < m or n = m and indexed2 and node < node2) and root <> root2 and not (low and low2) and {_FIT} and {_differ('{}', '{}_2').replace('n_2', 'm')}")
    rest = met.groupBy(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).agg(F.count("*").alias("shared"), F.min(F.col("bytes") + F.col("bytes2")).alias("bytes"), F.min(F.col("n").cast("long")).alias("n"), F.min(F.col("m").cast("long")).alias("m"))
    rest = _finer(staged(rest.join(tried.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-coarse"), fine)
    rest = staged(rest, "jaccard-candidates")
    return nodes, _connected(rest, rows, classes, roots) if rest.limit(1).count() else roots


def _torn(shared: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """The entries of signatures that still join several components and have one of the index prefix."""
    placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    torn = placed.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("indexed").alias("any")).where("lo <> hi and any").select("sig")
    torn = placed.join(torn, "sig", "left_semi").join(classes.select("node", "bytes", *CELLS), "node")
    return torn.select("sig", "node", "root", "n", "f", "low", "indexed", "bytes", *CELLS)


def _connected(pairs: DataFrame, rows: DataFrame, classes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """node, root of the components that the links among pairs make of the components so far: each
    node is compared with the one it shares most with, and then only pairs that are still apart."""
    best = pairs.groupBy("b").agg(F.max_by(F.struct("a", "bytes"), F.struct("shared", "a")).alias("p")).select("p.a", "b", "p.bytes")
    best = staged(best, "jaccard-first")
    roots = _joined(staged(_verified(best, rows, classes), "jaccard-links"), roots)
    later = staged(_apart(pairs.select("a", "b", "bytes").join(best.select("a", "b"), ["a", "b"], "left_anti"), roots), "jaccard-second")
    return _joined(staged(_verified(later, rows, classes), "jaccard-links"), roots)


def _joined(linked: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The components of the links and of the components so far, each of these a star around its root."""
    links_ = linked if roots is None else linked.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return staged(components(links_), "jaccard-roots") if roots is None or linked.limit(1).count() else roots


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, key, n, grp (the component's node; null for empty sets), component."""
    nodes, roots = linked_nodes(docs)
    classes = nodes.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    placed = staged(classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "jaccard-classes")
    least = placed.groupBy("root").agg(F.min("least").alias("component"), F.sum("copies").alias("members")).where("members > 1")
    named = placed.join(least.withColumnRenamed("root", "root2"), F.col("root") == F.col("root2")).select(F.col("node").alias("node2"), F.col("root2").alias("grp"), "component")
    return nodes.join(named, F.col("node") == F.col("node2"), "left").select("doc_id", "key", "n", F.coalesce("grp", "node").alias("grp"), F.coalesce("component", "doc_id").alias("component"))


def clusters(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id.

    Texts of fewer than five words are one shingle; null, empty and blank texts have none and link
    with nothing, so their component is their own id.  Null ids never name a component unless no
    other id is in it; repeated rows are copies of each other; other columns are ignored.
    """
    return _grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each component, that of the least doc_id, and all rows that link with
    nothing, empty ones included; all columns of docs."""
    key = fresh(docs, "row_key_")
    rows = staged(_grouped(docs).where("grp is not null").select("grp", "doc_id", "key"), "jaccard-groups")
    first = rows.groupBy("grp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("f"), F.count("*").alias("n")).where("n > 1")
    joined = rows.join(first.select(F.col("grp").alias("grp2"), F.col("f.key").alias("kept")), F.col("grp") == F.col("grp2"))
    losers = staged(joined.where("key <> kept").select(F.col("key").alias(key)).distinct(), "jaccard-losers")
    twice = staged(joined.where("key = kept").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias(key)), "jaccard-repeated")
    kept = matching(docs.withColumn(key, row_key()), losers, key, "left_anti")
    if not twice.limit(1).count():
        return kept.drop(key)
    return matching(kept, twice, key, "left_anti").unionByName(matching(kept, twice, key).dropDuplicates([key])).drop(key)
