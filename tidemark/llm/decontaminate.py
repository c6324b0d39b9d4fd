"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A benchmark item and every window of a document are embedded by the random walk of Chakraborty,
Goldenberg and Koucky (2016): at step j the walk writes the word under its pointer and moves on if
bit j of the word's random bits is set, so that few edits between two texts leave few differences
between their embeddings.  A repetition samples SAMPLED steps of a walk; where a window agrees
with an item in all of them the pair is a candidate.  Items are embedded from many offsets and
every other pair of repetitions samples short reaches, so that any few words left alone between two
edits can agree.  Repetitions are added until planted edits of the items are found at the target
recall in every length class; the items of classes that stay below it, and all too short to walk,
are searched exactly, by the one of EDITS + 1 pieces that no edit touches.  Candidates are verified by exact word edit distance
against the best-placed window.

Windows are embedded piece by piece: a walk from each offset of an item, and from each word of a
text, reaches at most STEPS words, since a walk over a whole window of many words would meet as many
edits as the bound allows and agree in nothing.

Scale.  Documents are read once per block of items (ITEMS different texts and ITEM_BYTES in a block,
so the broadcast tables are bounded, and a block's go before the next one's come); no document is
shuffled, and all windows of a text are tried.  What is found names an item by its text's hash; the
ids that share the text are joined to it afterwards.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Windows, distinct, fresh, hash_words, matching, mix, row_key, staged

#: A window of n words is a leak within n * EDIT_PERCENT // 100 word edits; items of fewer words than WALKED are searched exactly.
EDIT_PERCENT, WALKED = 15, 8
WALKS, STEPS, SAMPLED, MOST_REPETITIONS, RECALL = 2, 24, 6, 24, 0.95
#: Steps of a short reach (about five words); offsets of an item, about; planted edits of a length class at least.
REACH, OFFSETS, PLANTED = 10, 24, 200
ITEMS, ITEM_BYTES = 20_000, 64 << 20
#: Words of a chunk of windows, chosen to stay in a core's cache; bits of the first lookup.
CHUNK, BITS = 1 << 16, 20
_PUNCT = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LOWER = bytes(range(256)).lower()
MATCHES = "key long, item long, from_word long, n_words long, distance int"


def words(raw: bytes | None) -> np.ndarray:
    """The words' hashes (never 0); ASCII case and punctuation do not count."""
    return hash_words(raw.translate(_LOWER, _PUNCT) if raw else None) | np.uint64(1 << 63)


class Samplings:
    """Which steps each repetition samples of which walk, and the signatures of windows."""

    def __init__(self, repetitions: int, shortest: int, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.plan: list[tuple[int, np.ndarray]] = []
        for r in range(repetitions):
            # The first of each walk end within few words; every other pair reaches further.
            reach = min(shortest, REACH) if r // WALKS % 2 == 0 else STEPS
            self.plan.append((r % WALKS, np.sort(rng.choice(reach, SAMPLED, replace=False))))
        self.last = [int(s[-1]) for _, s in self.plan]

    def signatures(self, w: np.ndarray, start: int, stop: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of the windows that begin at start .. stop - 1 of w (0 ends each text): the repetitions'
        signatures, and where the pointer stood at each repetition's last sampled step."""
        out = [np.full(stop - start, r + 1, np.uint64) for r in range(len(self.plan))]
        ends: list[np.ndarray] = [np.empty(0)] * len(self.plan)
        for walk in range(WALKS):
            mine = [(r, set(s.tolist())) for r, (v, s) in enumerate(self.plan) if v == walk]
            if not mine:
                continue
            last = max(self.last[r] for r, _ in mine)
            p = np.arange(start, stop)
            for j in range(last + 1):
                g = w[p]
                for r, steps in mine:
                    if j in steps:
                        out[r] = (out[r] ^ g) * np.uint64(0x9E3779B97F4A7C15)
                        if j == self.last[r]:
                            ends[r] = p.copy()
                p += ((g >> np.uint64(2 * j + walk)) & np.uint64(1)).astype(np.int64)
        return [mix(s) for s in out], ends


def length_class(n: int) -> int:
    """Lengths whose recall is measured together: each by itself up to 64 words, then by powers of two."""
    return n if n < 64 else 1 << (n.bit_length() - 1)


class Table:
    """Hashes of places in items, for lookups of many hashes at once."""

    def __init__(self, keys: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.offset = keys[order], owner[order].astype(np.int32), offset[order].astype(np.int32)
        self.quick = np.zeros(1 << BITS, bool)
        self.quick[(self.keys >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def lookup(self, hashes: np.ndarray, start: int) -> np.ndarray:
        """Rows (item, place where the item would begin) for the hashes of places start, start + 1, ..."""
        hit = np.flatnonzero(self.quick[(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
        lo, hi = np.searchsorted(self.keys, hashes[hit]), np.searchsorted(self.keys, hashes[hit], side="right")
        many = hi - lo
        k = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.stack([self.owner[k].astype(np.int64), np.repeat(start + hit, many) - self.offset[k]], 1)


class Index:
    """The items' signatures by repetition; the items of the length classes ``exactly`` by their pieces."""

    def __init__(self, items: list[np.ndarray], repetitions: int, exactly: frozenset[int] = frozenset()) -> None:
        self.items = items
        searched = [i for i, w in enumerate(items) if len(w)]
        walked = [i for i in searched if len(items[i]) >= WALKED and length_class(len(items[i])) not in exactly]
        self.samplings = Samplings(repetitions if walked else 0, min((len(items[i]) for i in walked), default=WALKED))
        # The items in a row, a 0 after each, and of each place its item and its offset in it.
        ended = np.concatenate([np.append(items[i], np.uint64(0)) for i in walked] or [np.zeros(1, np.uint64)])
        sizes = np.array([len(items[i]) for i in walked], np.int64)
        begin = np.cumsum(sizes + 1) - sizes - 1
        owner, offset = np.repeat(np.array(walked, np.int64), sizes + 1), np.arange(len(ended) if walked else 0) - np.repeat(begin, sizes + 1)
        stop, stride = np.repeat(begin + sizes, sizes + 1), np.repeat(-(-sizes // OFFSETS), sizes + 1)
        sigs, ends = self.samplings.signatures(ended, 0, len(ended))
        self.tables = []
        for sig, end in zip(sigs, ends, strict=True):
            mine = (end < stop) & (offset % stride == 0)
            self.tables.append(Table(sig[mine], owner[mine], offset[mine]))
        # Of k + 1 pieces k edits leave one alone.
        self.pieces: dict[int, Table] = {}
        windows, by = Windows(), {}
        for i in sorted(set(searched) - set(walked)):
            k = len(items[i]) * EDIT_PERCENT // 100
            by.setdefault(len(items[i]) // (k + 1), []).append((i, k + 1))
        for n, mine in by.items():
            rows = [(h, i, j * n) for i, m in mine for j, h in enumerate(windows(items[i], n)[: m * n : n].tolist())]
            keys, owner, offset = zip(*rows, strict=True)
            self.pieces[n] = Table(np.array(keys, np.uint64), np.array(owner), np.array(offset))

    def candidates(self, w: np.ndarray) -> np.ndarray:
        """Distinct rows (item, place in w where the item would begin) of all windows of w that agree with an item."""
        windows, out = Windows(), [np.empty((0, 2), np.int64)]
        for start in range(0, len(w), CHUNK):
            stop = min(start + CHUNK, len(w))
            if self.tables:
                sigs, _ = self.samplings.signatures(w, start, stop)
                out += [t.lookup(s, start) for t, s in zip(self.tables, sigs, strict=True)]
            out += [t.lookup(windows(w[start : stop + n - 1], n), start) for n, t in self.pieces.items()]
        item, at = np.concatenate(out).T
        longest = max(map(len, self.items), default=0)
        pair = distinct(item * (len(w) + longest) + at + longest)
        return np.stack([pair // (len(w) + longest), pair % (len(w) + longest) - longest], 1)


def best_window(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least word edit distance of item to any window of text, and the window: (distance, from, to)."""
    n = len(item)
    # Row by row of the text; a match may begin anywhere (cost 0, remembered in ``begin``).
    cost, begin = np.arange(n + 1), np.zeros(n + 1, np.int64)
    steps = np.arange(n + 1)
    best = (int(cost[n]), 0, 0)
    for i, x in enumerate(text):
        up, diag = cost + 1, cost[:-1] + (item != x)
        new, since = up.copy(), begin.copy()
        new[0], since[0] = 0, i + 1
        better = diag <= new[1:]
        new[1:][better], since[1:][better] = diag[better], begin[:-1][better]
        # Words of the item left out: the least of new[k] + (j - k) over k <= j.
        flat = new - steps
        low = np.minimum.accumulate(flat)
        origin = np.maximum.accumulate(np.where(flat == low, steps, 0))
        cost, begin = low + steps, since[origin]
        if cost[n] < best[0]:
            best = (int(cost[n]), int(begin[n]), i + 1)
    return best


def _matches(index: Index, w: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """text, item, from, words, distance: for each text of w (a 0 ends each) and item its best window."""
    ends, lists = np.flatnonzero(w == 0), w.tolist()
    found = index.candidates(w)
    # The place may lie before the text; the item's middle decides which text is meant.
    middles = found[:, 1] + np.array([len(x) // 2 for x in index.items], np.int64)[found[:, 0]] if len(found) else found[:, 1]
    by: dict[tuple[int, int], list[int]] = {}
    for text, (item, at) in zip(np.searchsorted(ends, middles).tolist(), found.tolist(), strict=True):
        by.setdefault((text, item), []).append(at)
    known: dict[int, list[int]] = {}
    out = []
    for (text, item), places in sorted(by.items()):
        if text >= len(ends):
            continue
        first, last = (int(ends[text - 1]) + 1 if text else 0), int(ends[text])
        x = index.items[item]
        if item not in known:
            known[item] = x.tolist()
        n, k, xs = len(x), len(x) * EDIT_PERCENT // 100, known[item]
        best, spans = None, []
        for at in places:
            if first <= at and at + n <= last and lists[at : at + n] == xs:
                best = (0, at, n)
                break
        for at in places if best is None else ():
            # Places that differ by edits before them are one.
            if spans and at - spans[-1][1] <= k:
                spans[-1][1] = at
            else:
                spans.append([at, at])
        for lo, hi in spans:
            a, b = max(first, lo - k), min(last, hi + n + k)
            # Each edit spoils one word: n - k of the item's words at least stand in the window.
            if b - a < n - k or sum(map(set(lists[a:b]).__contains__, xs)) < n - k:
                continue
            d, s, e = best_window(x, w[a:b])
            if d <= k and (best is None or d < best[0]):
                best = (d, a + s, e - s)
        if best is not None:
            out.append((text, item, best[1] - first, best[2], best[0]))
    return out


def planted_recall(index: Index, seed: int = 3, copies: int = 4) -> dict[int, float]:
    """By length class the share of edited items (as many random edits as allowed, inside foreign
    words) that candidates() finds: all items in ``copies`` copies, and PLANTED a class at least."""
    rng, found, all_ = np.random.default_rng(seed), {}, {}
    by: dict[int, list[int]] = {}
    for i, w in enumerate(index.items):
        if len(w) >= WALKED:
            by.setdefault(length_class(len(w)), []).append(i)
    foreign = lambda n: rng.integers(1, 1 << 62, n).tolist()

    def measure(planted: list[tuple[int, int]], texts: list[int]) -> None:
        got: dict[int, list[int]] = {}
        for item, at in index.candidates(np.array(texts, np.uint64)).tolist():
            got.setdefault(item, []).append(at)
        for i, at in planted:
            n = len(index.items[i])
            c, places = length_class(n), np.array(got.get(i, []), np.int64)
            all_[c] = all_.get(c, 0) + 1
            found[c] = found.get(c, 0) + bool((np.abs(places - at) <= n * EDIT_PERCENT // 100).any())

    planted, texts = [], []
    for mine in by.values():
        for i in mine * max(copies, -(-PLANTED // len(mine))):
            w = index.items[i].tolist()
            for _ in range(len(w) * EDIT_PERCENT // 100):
                at, kind = int(rng.integers(len(w))), int(rng.integers(3))
                w[at : at + (kind != 1)] = foreign(1) if kind != 2 else []
            planted.append((i, len(texts) + 20))
            texts += [*foreign(20), *w, *foreign(20), 0]
            if len(texts) >= 8 * CHUNK:
                measure(planted, texts)
                planted, texts = [], []
    if planted:
        measure(planted, texts)
    return {c: found[c] / n for c, n in all_.items()}


def build(items: list[np.ndarray]) -> Index:
    """The index with as few repetitions as reach RECALL in every length class; classes that
    MOST_REPETITIONS do not bring there are searched exactly."""
    n = 4
    while True:
        index = Index(items, n)
        short = frozenset(c for c, share in planted_recall(index).items() if share < RECALL)
        if not short:
            return index
        if n >= MOST_REPETITIONS:
            return Index(items, n, short)
        n += 4


def _find(shared, ids: list):
    def run(batches):
        index = shared.value
        for b in batches:
            rows, held, keys, size = [], [], [], 0
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for i, (key, t) in enumerate(zip(b.column("key").to_pylist(), texts, strict=True)):
                ws = words(t)
                if len(ws):
                    held.append(np.append(ws, np.uint64(0)))
                    keys.append(key)
                    size += len(ws)
                if held and (size >= 8 * CHUNK or i == len(texts) - 1):
                    rows += [(keys[text], ids[item], at, n, d) for text, item, at, n, d in _matches(index, np.concatenate(held))]
                    held, keys, size = [], [], 0
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["key", "item", "from_word", "n_words", "distance"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """key (row_key of docs), item_id, from_word, n_words, distance: one row for each item (item_id,
    text) that a document holds within the edit bound, with its best window.

    Word positions count words with a letter, digit or non-ASCII character.  Null or blank texts on
    either side match nothing; an item of fewer than seven words matches where its words stand in
    order (leave out of ``benchmark`` what is too short to tell anything); items with equal ids or texts
    match each by itself, rows equal in both are one item; a null item_id is reported as null; other
    columns are ignored.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(row_key().alias("key"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    items = items.withColumn("of", F.xxhash64("text"))
    texts = staged(items.select("of", "text").dropDuplicates(["of"]), "leaks-items")
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.n // ITEMS), -(-size.bytes // ITEM_BYTES))
    out = None
    for block in range(blocks):  # a stated query set against all rows, in blocks of bounded size
        mine = texts.where(F.pmod(F.xxhash64("of"), F.lit(blocks)) == block).orderBy("of").collect()
        index = build([words(r.text.encode()) for r in mine])
        shared = sc.broadcast(index)
        found = staged(rows.mapInArrow(_find(shared, [r.of for r in mine]), MATCHES), "leaks")
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    named = items.select("item_id", F.col("of").alias("item")).distinct()
    return matching(out, named, "item", "inner").select("key", "item_id", "from_word", "n_words", "distance")


def leaked_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """leaks() with doc_id in place of the key: one row for each (document, item)."""
    found = leaks(docs, benchmark)
    keys = found.select("key").distinct()
    named = matching(docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key")), keys, "key").distinct()
    return found.join(named, "key").select("doc_id", "item_id", "from_word", "n_words", "distance")


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a benchmark item, with all columns of docs."""
    key = fresh(docs, "row_key_")
    bad = staged(leaks(docs, benchmark).select(F.col("key").alias(key)).distinct(), "leaks")
    return matching(docs.withColumn(key, row_key()), bad, key, "left_anti").drop(key)
