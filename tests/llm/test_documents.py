"""The operators over documents against brute-force versions, and on odd and empty tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, langid, linededup, mixing, quality, sharding, substring
from tidemark.llm.common import hash_words

from .conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_hash_words_tells_words_apart():
    assert len(hash_words(b"a b\x0bc\x0cd\n\re")) == 5 and len(hash_words(None)) == len(hash_words(b" \n")) == 0
    h = hash_words("ab ba ab a é".encode())
    assert h[0] == h[2] and len(set(h.tolist())) == 4
    assert len(hash_words("a b\x1cc".encode())) == 1  # only ASCII white space separates


# quality


def brute_statistics(text):
    w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    three = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = [any(three[tuple(w[j : j + 3])] > 1 for j in range(max(0, i - 2), min(i + 1, len(w) - 2))) for i in range(len(w))]
    return len(w), len(lines), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(hit)


def test_base_statistics():
    rng = random.Random(1)
    for text in ["", "a", "é é é é é", "a b c a b c", "x\nx\n\ny\nx # $", words(rng, 200, 5), words(rng, 300, 40)]:
        assert quality.text_statistics(text.encode()) == brute_statistics(text)
    assert quality.text_statistics(None) == (0, 0, 0, 0, 0, 0)


def brute_mcd(x, floor, share, steps):
    """Concentration on the exact rows from the two starts, weights of whole rows."""
    best = None
    for mean, cov in ((x.mean(0), np.cov(x.T, bias=True) + np.diag(floor)), (np.median(x, 0), np.diag(((np.quantile(x, 0.75, 0) - np.quantile(x, 0.25, 0)) / 1.349) ** 2 + floor))):
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            near = x[np.argsort(d, kind="stable")[: int(share * len(x))]]
            mean, cov = near.mean(0), np.cov(near.T, bias=True) + np.diag(floor)
        if best is None or np.linalg.slogdet(cov)[1] < best[0]:
            best = (np.linalg.slogdet(cov)[1], mean)
    return best[1]


def test_robust_estimates_ignore_outliers(spark):
    rng = np.random.default_rng(0)
    x = rng.normal([5, 1.5, 0, 0, 0.2], [0.8, 0.1, 0.2, 0.1, 0.3], (600, 5))
    x[:120] += [0, 0, 5, 0, 3]
    q = np.round(x * quality.UNIT).astype(int)
    df = spark.createDataFrame([("g", *map(int, r)) for r in q], "grp string, " + ", ".join(f"q{i} long" for i in range(5)))
    got = quality.estimates(df).first()
    assert np.allclose(got.center, brute_mcd(q / quality.UNIT, np.array(quality.FLOOR), quality.SUBSET, 30), atol=0.12)
    assert got.center[2] < 0.3 and got.scale >= 1


def test_quality_rejects_junk_only(frame):
    rng = random.Random(2)
    clean = [words(rng, rng.randrange(80, 400), 2000) for _ in range(150)]
    junk = [" ".join(w + "%%%" for w in words(rng, 200, 2000).split()) for _ in range(20)]
    docs = frame(clean + junk, source=lambda i: "s")
    got = {r.doc_id: r for r in quality.verdicts(docs).collect()}
    assert sum(got[i].kept for i in range(150)) >= 149 and not any(got[i].kept for i in range(150, 170))
    kept = quality.reject(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_quality_keeps_long_clean_documents(frame):
    rng = random.Random(21)
    texts = [words(rng, rng.randrange(80, 160), 40_000) for _ in range(150)] + [words(rng, 20_000, 40_000)]
    got = {r.doc_id: r for r in quality.verdicts(frame(texts, source=lambda i: "s")).collect()}
    assert got[150].kept and sum(got[i].kept for i in range(150)) >= 149


def brute_kept(x, n, failed):
    """The whole method on exact rows of one group: concentration, reweighting, one-sided length."""
    floor, quantile = np.diag(quality.FLOOR), quality.chi2_quantile
    distances = lambda e, cov: np.einsum("ij,jk,ik->i", e, np.linalg.inv(cov), e)
    best = None
    for mean, cov in ((x.mean(0), np.cov(x.T, bias=True) + floor), (np.median(x, 0), np.diag(((np.quantile(x, 0.75, 0) - np.quantile(x, 0.25, 0)) / 1.349) ** 2) + floor)):
        for _ in range(30):
            near = x[np.argsort(distances(x - mean, cov), kind="stable")[: int(quality.SUBSET * len(x))]]
            mean, cov = near.mean(0), np.cov(near.T, bias=True) + floor
        if best is None or np.linalg.slogdet(cov)[1] < best[0]:
            best = (np.linalg.slogdet(cov)[1], mean, cov)
    _, mean, cov = best
    d = distances(x - mean, cov)
    near = x[d <= quantile(0.975, 5) * np.median(d) / quantile(0.5, 5)]
    mean, cov = near.mean(0), np.cov(near.T, bias=True) + floor
    scale, e, p = max(1, np.median(distances(x - mean, cov)) / quantile(0.5, 5)), x - mean, np.linalg.inv(cov)
    e[:, 0] = np.minimum(e[:, 0], np.maximum(0, -(e[:, 1:] @ p[1:, 0]) / p[0, 0]))
    return distances(e, cov) / scale, ~failed & (distances(e, cov) / scale <= quantile(quality.CUTOFF, 5))


def test_quality_verdicts_against_brute_force(frame):
    rng = random.Random(23)
    texts = [words(rng, rng.randrange(60, 300), 3000) for _ in range(220)] + [" ".join(w + "#" * (i % 4) for w in words(rng, 120, 3000).split()) for i in range(30)] + [words(rng, 40, 3000)] * 10
    texts += ["\n".join([words(rng, 8, 3000)] * k + [words(rng, 8, 3000) for _ in range(20)]) for k in range(1, 20)]
    got = sorted(quality.verdicts(frame(texts, source=lambda i: "s")).collect())
    st = np.array([brute_statistics(t) for t in texts], float)
    n, lines, chars, symbols, dup, repeated = st.T
    x = np.stack([np.log1p(n), np.log((chars + 1) / (n + 1)), np.log1p(200 * symbols / chars), np.log1p(20 * dup / (lines + quality.PRIOR_LINES)), np.log1p(20 * repeated / n)], 1)
    distance_, kept = brute_kept(np.round(x * quality.UNIT) / quality.UNIT, n, (n < 50) | (100 * repeated > 50 * n))
    cutoff = quality.chi2_quantile(quality.CUTOFF, 5)
    clear = np.abs(np.log(distance_ / cutoff)) > 0.35  # binning moves distances a little
    assert clear.mean() > 0.9 and all(r.kept == k for r, k, c in zip(got, kept, clear, strict=True) if c)


@pytest.mark.parametrize("spoil", [
    lambda rng, t: " ".join(w * 9 for w in t.split()),
    lambda rng, t: " ".join(w + "|" for w in t.split()),
    lambda rng, t: "\n".join([t] + [x for k in range(12) for x in [words(rng, 9, 3000)] * 6]),
    lambda rng, t: t + " " + " ".join(words(rng, 200, 3000).split() * 3),
    lambda rng, t: " ".join(t.split()[:51]),
])
def test_each_statistic_alone_can_reject(frame, spoil):
    rng = random.Random(24)
    texts = [words(rng, rng.randrange(900, 1100), 3000) for _ in range(200)]
    bad = [spoil(rng, t) for t in texts[:5]]
    got = {r.doc_id: r for r in quality.verdicts(frame(texts + bad, source=lambda i: "s")).collect()}
    assert sum(got[i].kept for i in range(200)) >= 198
    assert not any(got[i].kept for i in range(200, 205))


def test_equal_rows_of_different_sources_have_their_own_verdicts(frame, spark):
    rng = random.Random(25)
    plain, symbols = [words(rng, 120, 3000) for _ in range(80)], [" ".join(w + "|" for w in words(rng, 120, 3000).split()) for _ in range(80)]
    docs = frame(plain + symbols, source=lambda i: "a" if i < 80 else "b")
    odd_one = docs.where("doc_id = 100")
    docs = docs.unionByName(odd_one.withColumn("source", F.lit("a")))
    kept = {(r.doc_id, r.source) for r in quality.reject(docs).collect()}
    assert (100, "b") in kept and (100, "a") not in kept


def test_quality_on_odd_tables(odd, empty):
    got = quality.verdicts(odd).collect()
    assert len(got) == odd.count() and {r.base_failed for r in got if r.n_words < 50} == {True}
    assert quality.verdicts(empty).count() == 0 and quality.reject(empty).columns == empty.columns
    assert quality.reject(odd).count() == sum(r.kept for r in got)


# mixing


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 450) == [200, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([10, 0, 10], [1, 1, 1], 60) == [20, 0, 20]
    assert mixing.targets([], [], 0) == []


def test_mixture(frame):
    rng = random.Random(3)
    docs = frame([words(rng, rng.randrange(1, 900)) for _ in range(200)], source=lambda i: [None, "b", "a"][i % 3])
    got = mixing.mixture(docs).collect()
    again = {(r.doc_id, r.taken) for r in mixing.mixture(docs).collect()}
    assert {(r.doc_id, r.taken) for r in got} == again and len(got) == 200
    total = sum(r["size"] for r in got)
    for source, weight in (("a", 5), ("b", 2), (None, 1)):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= mixing.BLOCK and mine[0].source_size == sum(r["size"] for r in mine)
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(1.5 * total)
    assert all(r.taken <= 2 * r["size"] for r in got)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    texts, sums = {r.doc_id: r.text for r in docs.collect()}, collections.Counter()
    for r in mixed.collect():
        sums[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text) and set(r.text.split()) <= set(texts[r.doc_id].split())
    assert all(sums[r.doc_id] == r.taken for r in got)


def test_mixture_against_slots_one_by_one(spark, frame):
    """Every slot followed by hand: its block by the permutation, the block's words to their documents."""
    from tidemark.llm.permutation import permuted

    rng = random.Random(33)
    docs = frame([words(rng, rng.randrange(1, 700)) for _ in range(60)], source=lambda i: ["a", "b", "c", None][i % 4])
    placed, sources = mixing._plan(docs, 11)
    slots = mixing._slots(docs, sources, 11).collect()
    assert collections.Counter(r.sid for r in slots) == {s["sid"]: s["quota"] for s in sources if s["quota"]}
    assert all(sorted(r.slot for r in slots if r.sid == s["sid"]) == list(range(s["quota"])) for s in sources)
    cells = [(s["sid"], p, i, s["blocks"]) for s in sources for p in range(2) for i in range(s["blocks"])]
    block = {(r.sid, r.p, r.i): r.b for r in spark.createDataFrame(cells, "sid int, p long, i long, n long").withColumnRenamed("p", "pass").select("sid", F.col("pass").alias("p"), "i", permuted("i", "n", "11, sid, pass").alias("b")).collect()}
    words_of = {}
    for r in placed.collect():
        for k in range(r["size"]):
            words_of[r.sid, r.start + k] = r.doc_id
    blocks, taken = {s["sid"]: s["blocks"] for s in sources}, collections.Counter()
    for r in slots:
        b = block[r.sid, r.slot // blocks[r.sid], r.slot % blocks[r.sid]]
        for w in range(b * mixing.BLOCK, (b + 1) * mixing.BLOCK):
            if (r.sid, w) in words_of:
                taken[words_of[r.sid, w]] += 1
    assert {r.doc_id: r.taken for r in mixing.mixture(docs).collect() if r.taken} == taken


def test_mix_tells_sources_of_equal_rows_apart(frame):
    rng = random.Random(34)
    docs = frame([words(rng, 200) for _ in range(30)], source=lambda i: "ab"[i % 2])
    both = docs.unionByName(docs.where("doc_id = 4").withColumn("source", F.lit("b"))).unionByName(docs.where("doc_id = 5"))
    want, got = collections.Counter(), collections.Counter()
    for r in mixing.mixture(both).collect():
        want[r.doc_id, r.source] += r.taken
    for r in mixing.mix(both).collect():
        got[r.doc_id, r.source] += len(r.text.split())
    assert got == +want


def test_mixture_on_odd_tables(odd, empty):
    got = mixing.mixture(odd).collect()
    assert len(got) == odd.count() and all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.mixture(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert mixing.mix(odd).columns == odd.columns


# line dedup


def brute_lines(docs):
    seen, gone = {}, collections.defaultdict(set)
    for i, text in sorted(docs.items()):
        lines = text.split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if "".join(w).strip(" ") and seen.setdefault(w, (i, k)) != (i, k):
                gone[i] |= {k, k + 1, k + 2}
    return {i: ("\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), len(gone[i])) for i, t in docs.items()}


def test_line_dedup(frame):
    rng = random.Random(4)
    texts = ["\n".join(f"line {rng.randrange(6)}" if rng.random() < 0.7 else "" for _ in range(rng.randrange(1, 30))) for _ in range(40)]
    got = {r.doc_id: (r.text, r.n_removed) for r in linededup.dedup(frame(texts)).collect()}
    assert got == brute_lines(dict(enumerate(texts)))


def test_line_dedup_on_odd_tables(odd, empty):
    got = linededup.dedup(odd)
    assert got.count() == odd.count() and got.where("text is null").count() == 2
    assert {r.n_lines for r in got.where("text is null").collect()} == {0}
    assert linededup.dedup(empty).count() == 0


# n-gram Jaccard join


def brute_components(docs):
    sets, root = {i: shingles(t) for i, t in docs}, {i: i for i, _ in docs}
    find = lambda x: x if root[x] == x else find(root[x])
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("frequent", [2, 4, 32])
def test_jaccard(frame, monkeypatch, frequent):
    rng = random.Random(5)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    passage, texts = words(rng, 60), []
    for _ in range(6):
        base = words(rng, rng.randrange(5, 120))
        texts += [edited(rng, base, rng.choice([0, 0.01, 0.03, 0.05, 0.1])) for _ in range(rng.randrange(2, 12))]
    texts += [passage + " " + words(rng, rng.randrange(3, 60)) for _ in range(25)] + ["a b", "A  B", "a b c", "c"] + [words(rng, 40) for _ in range(10)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.clusters(frame(texts)).collect()}
    assert got == brute_components(list(enumerate(texts)))


def test_signatures_lose_no_pair():
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(2, 60))
        x = np.sort(rng.choice(10**6, n, replace=False).astype(np.uint64))
        common = rng.random(10**6) < rng.random()
        drop = int(rng.integers(0, n // 4 + 1))
        y = np.sort(np.concatenate([rng.permutation(x)[drop:], rng.choice(np.arange(10**6, 2 * 10**6), int(rng.integers(0, max(1, n // 4))), replace=False).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        mark = lambda s: np.array([v < 10**6 and common[int(v)] for v in s], bool)
        x, y = sorted((x, y), key=len)
        (a, i, b, low, j), (c, i2, d, low2, j2) = jaccard.signatures(x, mark(x)), jaccard.signatures(y, mark(y))
        if len(x) == len(y):  # both by their index prefixes
            c, d, low2 = c[i2], d[j2], low2[j2]
        assert np.intersect1d(a[i], c).size or np.intersect1d(b[j], d[~low2]).size
        assert low[low].size == (low & j).sum()  # in the next band a set is the smaller one


def test_jaccard_of_unlinked_pages_of_one_template(frame, monkeypatch):
    """What the entries of a signature compare grows with the pages, not with their square."""
    compared, keep = {}, jaccard.staged

    def staged(df, name):
        out = keep(df, name)
        if name == "jaccard-torn":
            compared[n] = out.groupBy("sig").agg((F.count_if(F.col("indexed")) * F.count("*")).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return out

    monkeypatch.setattr(jaccard, "staged", staged)
    rng = random.Random(20)
    shared = words(rng, 100, 10**6)
    texts = [f"{shared} {words(rng, 20, 10**6)}" for _ in range(400)]
    for n in (200, 400):
        got = {r.doc_id: r.component_id for r in jaccard.clusters(frame(texts[:n])).collect()}
        assert got == {i: c for i, (_, c) in brute_components(list(enumerate(texts[:n]))).items()} and len(set(got.values())) == n
    assert compared[400] <= 2.5 * max(compared[200], 400)


def test_bitmap_filter_loses_no_pair():
    rng = np.random.default_rng(26)
    for n in (1, 5, 40, 300, 3000):
        x = rng.integers(0, 1 << 62, n).astype(np.uint64)
        for drop in {0, n // 8, n // 4}:
            y = np.concatenate([x[drop:], rng.integers(0, 1 << 62, drop // 2).astype(np.uint64)])
            differ = int(np.bitwise_count((jaccard.cells(x) ^ jaccard.cells(y)).view(np.uint64)).sum())
            assert differ <= len(np.setxor1d(x, y))
            link = 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y))
            if min(len(x), len(y)) > jaccard.BITS // 2 and link:
                assert jaccard.may_link(len(x), len(y), jaccard.fine_cells(x), jaccard.fine_cells(y))
    x, y = rng.integers(0, 1 << 62, (2, 5000)).astype(np.uint64)
    assert not jaccard.may_link(5000, 3000, jaccard.fine_cells(x), jaccard.fine_cells(np.append(x[:2000], y[:1000])))
    far = [int(np.bitwise_count((jaccard.cells(x) ^ jaccard.cells(rng.integers(0, 1 << 62, 150).astype(np.uint64))).view(np.uint64)).sum()) for x in rng.integers(0, 1 << 62, (50, 150)).astype(np.uint64)]
    assert 175 * min(far) > 25 * 300


def test_jaccard_of_a_large_group(frame, monkeypatch):
    """400 near copies of one text and 150 texts that share a passage: no join grows with the square."""
    rng, rows = random.Random(27), collections.Counter()
    monkeypatch.setattr(jaccard, "PAIR_BYTES", 5_000)
    keep = jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda df, name: rows.update({name: (out := keep(df, name)).count()}) or out)
    base, passage = words(rng, 120, 5000), words(rng, 60, 5000)
    texts = [edited(rng, base, rng.choice([0.01, 0.03, 0.05])) for _ in range(400)] + [passage + " " + words(rng, 40, 5000) for _ in range(150)] + [base] * 100
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.clusters(frame(texts)).collect()}
    assert got == brute_components(list(enumerate(texts)))
    assert all(n <= 20 * len(texts) for name, n in rows.items() if name in ("jaccard-single", "jaccard-candidates", "jaccard-first", "jaccard-second", "jaccard-links"))


def test_jaccard_on_odd_tables(odd, empty):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.clusters(odd).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 0, None), (5, 2, 5), (8, 2, 5), (7, 7919, 6)} <= got
    assert jaccard.clusters(empty).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id or 0) for r in kept.collect())
    assert ids == [0, 0, 1, 2, 3, 4, 5, 6]


# substring dedup


def brute_substrings(texts, n):
    split = [WORD.findall(t or "") for t in texts]
    c = collections.Counter(tuple(w[k : k + n]) for w in split for k in range(len(w) - n + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if c[tuple(w[k : k + n])] > 1:
                gone[k : k + n] = [True] * n
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return out


def test_substrings(frame):
    rng = random.Random(7)
    passage = words(rng, 60)
    texts = [words(rng, rng.randrange(0, 90)) + rng.choice(["", " " + passage, "\n" + passage[:200]]) + " " + words(rng, 20) for _ in range(60)]
    texts += ["z " * 50, "q " * 34, texts[0]]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup(frame(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_substrings(texts, 35)
    far = {r.words for r in substring.longest(frame([passage * 3, passage * 3, words(rng, 100)])).collect()}
    assert far == {140}


def test_substrings_on_odd_tables(odd, empty):
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed) for r in substring.dedup(odd).collect())
    assert got[(6, 60_000, 60_000)] == got[(7, 60_000, 60_000)] == 1 and got[(1, 0, 0)] == 1 and got[(5, 6, 0)] == 3
    assert substring.dedup(empty).count() == 0


# sharding


@pytest.mark.parametrize("n", [0, 3, 257])
def test_shards(frame, n, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 20)
    rng = random.Random(8)
    docs = frame([words(rng, 5) for _ in range(n)])
    got = sharding.placed(docs, 10).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by[s]) for s in range(10)]
    assert max(sizes) - min(sizes) <= 1
    assert {(r.doc_id, r.shard, r.slot) for r in got} == {(r.doc_id, r.shard, r.slot) for r in sharding.placed(docs, 10).collect()}
    assert sharding.shard(docs, 10).columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]


def test_pieces_follow_the_drawn_matrix(frame, monkeypatch):
    """Partition by partition, as many rows go to each shard as the matrix says."""
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 30)
    rng, drawn = random.Random(35), []
    matrix = sharding.matrix
    monkeypatch.setattr(sharding, "matrix", lambda *a: drawn.append(matrix(*a)) or drawn[-1])
    docs = frame([words(rng, 5) for _ in range(200)])
    out = sharding.shard(docs, 6, seed=3).drop("part", "row_key").withColumn("row_key", sharding.row_key()).withColumn("part", F.pmod(F.xxhash64("row_key", F.lit(3)), F.lit(7)).cast("int"))
    assert {(r.part, r.shard): r["count"] for r in out.groupBy("part", "shard").count().collect()} == {(r.part, r.shard): r.n for r in drawn[0].collect()}


def test_the_deck_is_uniform(spark):
    """Over many keys each place gets each label equally often, and a part's count of a label is hypergeometric."""
    from math import comb

    from tidemark.llm.permutation import permuted

    keys, n, shards = 4000, 12, 3
    deck = spark.range(keys * n).select(F.expr(f"id div {n}").alias("k"), F.expr(f"id % {n}").alias("at"), F.floor(permuted(f"id % {n}", f"{n}L", f"id div {n}") * shards / n).alias("label"))
    got = deck.groupBy("at", "label").count().collect()
    assert len(got) == n * shards and all(abs(r["count"] - keys / shards) < 5 * (keys / shards) ** 0.5 for r in got)
    first = collections.Counter(r.c for r in deck.where("at < 5").groupBy("k").agg(F.count_if(F.col("label") == 0).alias("c")).collect())
    law = [comb(4, c) * comb(8, 5 - c) / comb(12, 5) for c in range(5)]
    assert sum((first[c] - keys * p) ** 2 / (keys * p) for c, p in enumerate(law)) < 18.5  # chi square of 4 degrees, 0.1 %


def test_matrix_has_its_margins(spark):
    sizes = spark.createDataFrame([(0, 50), (1, 7), (2, 44)], "part int, rows long")
    m = sharding.matrix(sizes, 101, 4, 1).collect()
    rows, cols = collections.Counter(), collections.Counter()
    for r in m:
        rows[r.part] += r.n
        cols[r.shard] += r.n
    assert rows == {0: 50, 1: 7, 2: 44} and sorted(cols.values()) == [25, 25, 25, 26]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 12, 97, 1000])
def test_permutation(spark, n):
    from tidemark.llm.permutation import permuted

    got = [r.p for r in spark.range(n).select(permuted("id", f"{n}L", "7").alias("p")).collect()]
    assert sorted(got) == list(range(n)) and (n < 12 or got != sorted(got))


def test_shards_of_odd_tables(odd):
    got = sharding.placed(odd, 3).collect()
    assert len(got) == odd.count() and {r["size"] for r in got if r.doc_id == 1} == {16}
    assert {r.text_crc32 for r in got if r.doc_id == 4} == {zlib.crc32(b"one")}


# language identification


def test_network_gradient():
    net = langid.Network(["a", "b", "c"])
    rng = np.random.default_rng(9)
    x, y = rng.integers(97, 110, (4, 16)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, g = net.loss(x, y)
    for name in net.p:
        flat, grad = net.p[name].reshape(-1), g[name].reshape(-1)
        for i in np.argsort(-np.abs(grad))[:3]:
            old = flat[i]
            flat[i] = old + 1e-5
            up = net.loss(x, y)[0]
            flat[i] = old - 1e-5
            down = net.loss(x, y)[0]
            flat[i] = old
            assert (up - down) / 2e-5 == pytest.approx(grad[i], rel=1e-3, abs=1e-7)


def test_tables_equal_the_network():
    net = langid.Network(["a", "b"])
    x = np.random.default_rng(1).integers(0, 256, (5, 64)).astype(np.uint8)
    losses = [net.loss(x[i : i + 1], np.array([0]))[0] for i in range(5)]
    assert np.allclose(-np.log(net.tables().windows(x)[:, 0]), losses, atol=1e-4)


def test_language_held_out_accuracy(spark):
    rng, letters = random.Random(10), {"xx": "aeioumn", "yy": "stkrzöü", "zz": "bcdlpéè"}
    make = lambda lang: " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(40))
    data = [(i, make(lang), lang) for i in range(240) for lang in [list(letters)[i % 3]]]
    docs = spark.createDataFrame([*data, (900, None, "xx"), (901, "12 !!", "xx"), (902, "", None), (None, make("yy"), None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [i for i in range(240) if got[i].held_out] == held
    assert np.mean([got[i].lang_pred == data[i][2] for i in held]) >= 0.95
    assert {got[i].lang_pred for i in (900, 901, 902)} == {"und"} and got[None].lang_pred == "yy"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_sample_of_repeated_rows(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(langid.Network, "train", lambda self, x, y: taken.append((len(x), np.bincount(y).tolist())) or self)
    once = [(i, f"text number {i} " * 40, "xx") for i in (1, 2, 4)]
    many = spark.range(20_000).select(F.lit(3).cast("long").alias("doc_id"), F.lit("the same row " * 30).alias("text"), F.lit("yy").alias("lang"))
    both = spark.createDataFrame([(3, "the same row " * 30, "xx")], many.schema)
    langid.train(spark.createDataFrame([*once, *once], many.schema).unionByName(many).unionByName(both))
    n = langid.PER_DOCUMENT
    assert taken == [(len([1, 2, 4]) * n + 2 * n, [4 * n, n])]


def test_predictions_against_plain_convolution(spark):
    rng, letters = random.Random(36), {"xx": "aeioumn", "yy": "stkrzöü"}
    make = lambda lang, n: " ".join("".join(rng.choice(letters[lang]) for _ in range(4)) for _ in range(n))
    data = [(i, make(lang, rng.randrange(1, 60)), lang) for i in range(60) for lang in [list(letters)[i % 2]]] + [(70, "², ½ Ⅷ 12", "xx"), (71, "ª", "xx")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    net = langid.train(docs)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}

    def brute(text):
        total = np.zeros(len(net.languages))
        for x in langid.cut(text.encode()):
            e, pooled = net.p["embed"][x], []
            for k in langid.WIDTHS:
                z = [sum(e[i + j] @ net.p[f"w{k}"][j * langid.EMBED : (j + 1) * langid.EMBED] for j in range(k)) + net.p[f"b{k}"] for i in range(len(x) - k + 1)]
                pooled.append(np.maximum(np.max(z, 0), 0))
            s = np.exp(np.concatenate(pooled) @ net.p["out"] + net.p["bias"])
            total += s / s.sum()
        return total / len(langid.cut(text.encode()))

    for i, text, _ in data[:60]:
        p = brute(text)
        assert got[i].lang_pred == net.languages[int(p.argmax())] and got[i].score == pytest.approx(p.max(), abs=1e-4)
    assert got[70].lang_pred == "und" and got[71].lang_pred != "und"


def test_language_without_labels(spark, odd, empty):
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(empty).count() == 0


# decontamination


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
    return row[-1]


def test_best_window():
    rng = np.random.default_rng(11)
    for _ in range(60):
        item, text = rng.integers(0, 5, rng.integers(1, 8)).astype(np.uint64), rng.integers(0, 5, rng.integers(1, 14)).astype(np.uint64)
        d, a, b = decontaminate.best_window(item, text)
        brute = min(distance(item.tolist(), text[i:j].tolist()) for i in range(len(text) + 1) for j in range(i, len(text) + 1))
        assert d == brute == distance(item.tolist(), text[a:b].tolist())


def test_leaks(spark, frame):
    rng = random.Random(12)
    items = [words(rng, rng.randrange(8, 60), 5000) for _ in range(30)]
    texts, expected = [], set()
    for i in range(90):
        item, kind = items[i % 30].split(), i % 3
        if kind == 0:
            expected.add((i, i % 30))
        if kind == 1:  # within the bound, at random places
            for at in rng.sample(range(len(item)), len(item) * decontaminate.EDIT_PERCENT // 100):
                item[at] = "changed"
            expected.add((i, i % 30))
        if kind == 2:  # far beyond it
            item = item[: len(item) // 2]
        texts.append(words(rng, 50, 5000) + "\n" + " ".join(item).upper() + "!!! " + words(rng, 30, 5000))
    benchmark = spark.createDataFrame([*enumerate(items), (98, None), (99, "nowhere found")], "item_id long, text string")
    docs = frame(texts)
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaked_documents(docs, benchmark).collect()}
    assert got <= expected and len(got) >= 0.95 * len(expected)
    left = decontaminate.remove(docs, benchmark)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(range(90)) - {i for i, _ in got}


@pytest.mark.parametrize("most", [24, 4])
def test_leaks_of_short_items_among_long_ones(monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MOST_REPETITIONS", most)
    if most == 4:  # no class reaches this: all are searched by their pieces
        monkeypatch.setattr(decontaminate, "RECALL", 1.1)
    rng = np.random.default_rng(13)
    draw = lambda n: rng.integers(1 << 63, (1 << 64) - 1, n, dtype=np.uint64)
    items = [draw(n) for n in [*[15, 16] * 10, *range(40, 60), *range(40, 60), *range(40, 60)]]
    index = decontaminate.build(items)
    found = tried = 0
    for i, item in enumerate(items[:20]):
        for _ in range(15):
            w = item.copy()
            w[rng.choice(len(w), 2, replace=False)] = draw(2)
            got = decontaminate._matches(index, np.concatenate([draw(20), w, draw(20), np.zeros(1, np.uint64)]))
            assert all((text, j, d) == (0, i, 2) for text, j, _, _, d in got)
            found, tried = found + len(got), tried + 1
    assert found >= (0.95 if most > 4 else 1) * tried


def test_every_length_class_reaches_the_recall():
    rng = np.random.default_rng(14)
    draw = lambda n: rng.integers(1 << 63, (1 << 64) - 1, n, dtype=np.uint64)
    items = [draw(n) for n in [*range(1, 21), *range(1, 21), *range(1, 21), 30, 45, 60, 100, 150]]
    index = decontaminate.build(items)
    assert min(decontaminate.planted_recall(index, seed=77).values()) >= 0.9
    tried, found = collections.Counter(), collections.Counter()
    for i, item in enumerate(items):
        for _ in range(10):
            w, n = item.tolist(), len(item)
            for _ in range(n * decontaminate.EDIT_PERCENT // 100):
                at, kind = int(rng.integers(len(w))), int(rng.integers(3))
                w[at : at + (kind != 1)] = draw(1).tolist() if kind != 2 else []
            got = decontaminate._matches(index, np.concatenate([draw(15), np.array(w, np.uint64), draw(15), np.zeros(1, np.uint64)]))
            tried[n] += 1
            found[n] += any(j == i for _, j, *_ in got)
    assert all(found[n] >= 0.9 * tried[n] for n in tried if n >= decontaminate.WALKED) and all(found[n] == tried[n] for n in tried if n < decontaminate.WALKED)
    assert sum(found.values()) >= 0.97 * sum(tried.values())


def test_leaks_against_all_windows(spark, frame):
    """Short texts, small vocabulary: what is found is within the bound, and hardly any pair is missed."""
    rng = random.Random(15)
    items = [words(rng, n, 60) for n in [1, 2, 3, 5, 6, 7, 8, 9, 10, 12, 14, 16, 20, 24]]
    texts = [words(rng, rng.randrange(0, 30), 60) + " " + edited(rng, items[i % 14], rng.choice([0, 0.05, 0.1])) + " " + words(rng, 5, 60) for i in range(56)]
    docs, benchmark = frame(texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    expected = {}
    for i, t in enumerate(texts):
        w = t.split()
        for j, item in enumerate(items):
            x = item.split()
            best = min((distance(x, w[a:b]) for a in range(len(w)) for b in range(max(a, a + len(x) - 3), min(len(w), a + len(x) + 3) + 1)), default=99)
            if best <= len(x) * decontaminate.EDIT_PERCENT // 100:
                expected[i, j] = best
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaked_documents(docs, benchmark).collect()}
    assert got.items() <= expected.items() and len(got) >= 0.95 * len(expected)


def test_blocks_of_items(spark, frame, monkeypatch):
    rng = random.Random(16)
    items = [words(rng, 20, 5000) for _ in range(30)]
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    docs, benchmark = frame([words(rng, 9, 5000) + " " + x for x in items]), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaked_documents(docs, benchmark).collect()} == {(i, i) for i in range(30)}


def test_repeated_items(spark, frame):
    """Equal texts under several ids are each found; a text stands in the index once, however often it repeats."""
    rng = random.Random(18)
    text, other = words(rng, 20, 5000), words(rng, 20, 5000)
    docs = frame(["before " + text + " after", words(rng, 30, 5000), other])
    many = spark.range(20_000).select((F.col("id") % 3).alias("item_id"), F.lit(text).alias("text"))
    benchmark = many.unionByName(spark.createDataFrame([(7, other), (7, other), (None, other)], many.schema))
    got = sorted((r.doc_id, -1 if r.item_id is None else r.item_id) for r in decontaminate.leaked_documents(docs, benchmark).collect())
    assert got == [(0, 0), (0, 1), (0, 2), (2, -1), (2, 7)]


def test_items_in_blocks_of_bytes(spark, frame, monkeypatch):
    rng = random.Random(19)
    items = [words(rng, 20, 5000) for _ in range(12)]
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 400)
    docs, benchmark = frame(items), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaked_documents(docs, benchmark).collect()} == {(i, i) for i in range(12)}


def test_leaks_on_odd_tables(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (None, None)], "item_id long, text string")
    assert decontaminate.leaked_documents(odd, benchmark).count() == 0
    assert decontaminate.leaked_documents(empty, benchmark).count() == 0
    assert decontaminate.remove(odd, benchmark.limit(0)).count() == odd.count()
