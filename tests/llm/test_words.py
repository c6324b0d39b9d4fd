"""Phrases, resampling and encoding against brute-force versions and the library."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import phrases, pieces, resampling

from .conftest import words


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# phrases


def brute_ngrams(docs, longest, least):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    return {k: c for k, c in f.items() if c >= least}, n


def brute_collocations(docs, longest, least, top):
    f, n = brute_ngrams(docs, longest, least)
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        inside = any(la == lang and len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (la, q), c in f.items())
        if len(p) > 1 and not inside:
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -score) for lang, rows in out.items() for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)}


def test_suffix_array_and_intervals():
    rng = np.random.default_rng(3)
    for n, kinds, depth in ((1, 1, 5), (40, 2, 5), (300, 3, 4), (500, 9, 3)):
        ids = rng.integers(1, kinds + 1, n)
        cut = rng.random(n) < 0.1
        cut[-1] = True
        ends = np.flatnonzero(cut)
        rest = np.repeat(ends, np.diff(np.append(-1, ends))) - np.arange(n) + 1
        order, lcp = phrases.suffix_array(ids, rest, depth)
        suffix = [tuple(ids[i : i + rest[i]].tolist()) for i in range(n)]
        assert sorted(order.tolist()) == list(range(n))
        assert [suffix[i][:depth] for i in order] == sorted(s[:depth] for s in suffix)
        for m in range(1, depth + 1):
            at, count = phrases.intervals(order, lcp, rest, m)
            want = collections.Counter(s[:m] for s in suffix if len(s) >= m)
            assert {suffix[i][:m]: c for i, c in zip(at.tolist(), count.tolist(), strict=True)} == want


@pytest.mark.parametrize("shard", [60, phrases.SHARD_WORDS])
def test_collocations(spark, monkeypatch, shard):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    rng = random.Random(5)
    docs = []
    for i in range(120):
        w = [rng.choice("ab A é the of x1 -".split()) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w) + 1) : 0] = rng.choice(["Old harbour light", "salt  of\tthe", "a, b. c", "z z z z z z z"]).split(" ")
        docs.append((rng.choice(["en", "fr", None, "und"]), rng.choice([" ", "  ", "\t"]).join(w) + rng.choice(["", "\n", "!"])))
    docs += [("en", None), ("en", ""), ("xx", " \n. "), docs[0], docs[0]]
    df = spark.createDataFrame([(i, la, t, "k") for i, (la, t) in enumerate(docs)], "doc_id long, lang string, text string, phrase string").repartition(3)
    got = {tuple(r) for r in phrases.collocations(df, 5, 6, 25).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == brute_collocations(docs, 5, 6, 25) and len(got) > 40


def test_collocations_of_great_counts(spark):
    rows = [("en", "", 0, 10**16), ("en", "a", 1, 10**13), ("en", "b", 1, 10**12 + 1), ("en", "a b", 2, 10**12)]
    r = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, m int, n long")).first()
    assert (r.a, r.score) == (10**12, 1000 * 10**12 * 10**16 // (10**13 * (10**12 + 1)))


def test_collocations_of_odd_tables(odd, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(odd, least=10**6).count() == 0
    short = odd.where("text is null or length(text) < 100")
    want = brute_collocations([(r.lang, r.text) for r in short.collect()], 5, 3, 9)
    assert {tuple(r) for r in phrases.collocations(short, least=3, top=9).collect()} == want and len(want) == 2
    assert phrases.collocations(odd, least=16).count() == 2000


# resampling


def brute_draw(docs, target, n, buckets, percent, least, seed):
    feats = lambda t: [" ".join(w[i : i + k]) for w in [re.findall(resampling.WORD, lowered(t))] for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(place(f) for x in side for f in feats(x)) for side in ([d[1] for d in docs], target))
    up, down = sum(t.values()) + buckets, sum(s.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * down / ((s[b] + 1) * up))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        f = feats(text)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[place(x)] for x in f)
        rows.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(re.findall(resampling.WORD, lowered(text)))))
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    rank = {id(r): k for k, r in enumerate(fit[: percent * len(fit) // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_resampling(spark, monkeypatch, n):
    monkeypatch.setattr(resampling, "WHOLE_BYTES", 600)
    monkeypatch.setattr(resampling, "CHUNK", 17)
    rng = random.Random(n)
    docs = [(i, rng.choice([" ", ", ", "--"]).join(rng.choice(["Tide", "é", "x9", f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(200)))) for i in range(80)]
    docs += [(90, None), (91, ""), (92, "?? \n"), (None, words(rng, 30)), (93, words(rng, 17)), (94, words(rng, 34)), (95, "one")]
    target = [words(rng, 40), None, "Tide w1 w2"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, places string, at int")
    tf = spark.createDataFrame([(t, 1) for t in target], "text string, item_id int")
    rows = resampling.weighted(df, tf, n, 97, 20, 7, chunk=17)
    got = resampling.ranked(rows, 25).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_draw(docs, target, n, 97, 25, 20, 7)


def test_resampling_of_odd_tables(odd, empty, frame):
    target = odd.select("doc_id", "text")
    assert resampling.drawn(empty, target).count() == 0
    rows = resampling.drawn(odd, target.limit(0)).collect()
    assert len(rows) == odd.count() and sum(r.n_features == 60_000 for r in rows) == 2
    same = [r for r in rows if r.doc_id == 5]
    assert len(same) == 3 and len(set(same)) == 1
    many = frame([f"w{i} " * 30 for i in (1, 2, 3) for _ in range(40)], [i for i in (1, 2, 3) for _ in range(40)])
    drawn = resampling.drawn(many, target)
    assert sorted(r["rank"] for r in drawn.where("rank is not null").collect()) == list(range(1, 13))


# pieces


@pytest.fixture(scope="module")
def model():
    return pieces.model_bytes()


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "  a\tb\nc  d ", "▁a▁▁b", "a▁ ▁b▁", "ﬁ é①▁x y\0z", "<s> </s> <unk> <0x41>", "日本語のテキスト です", "🙂🙂 x", "a" * 500, "\n\n  \n", "The quick brown fox. " * 30, "   ", "don't  stop"]


def test_encoding_is_the_librarys(spark, model):
    sp = pieces.processor(model)
    rng = random.Random(8)
    texts = TEXTS + ["".join(rng.choice(["ab", " ", "  ", "▁", "é", "\n", "tion", "the ", "퟿", "1"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, None, texts[3]])], "doc_id long, text string, chunk string").repartition(3)
    for table in (0, 5, pieces.TABLE):
        got = {r.doc_id: r for r in pieces.decode(pieces.encode(df, model, table=table), model).collect()}
        for i, t in enumerate([*texts, "", texts[3]]):
            ids = [*sp.encode(t), 2]
            assert got[i].ids == ids and got[i].text == sp.decode(ids), (table, t)


def test_decoding_of_any_ids(model):
    sp = pieces.processor(model)
    of, rng = pieces.Surfaces(sp), random.Random(4)
    marked = [i for i in range(300, 32000) if sp.id_to_piece(i).startswith("▁")]
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300), rng.choice(marked), 35]) for _ in range(rng.randrange(8))]
        assert of(ids) == sp.decode(ids), ids


def test_encoding_of_odd_tables(odd, empty, model):
    assert pieces.digests(empty, model).count() == 0
    sp = pieces.processor(model)
    want = []
    for r in odd.collect():
        ids = [*sp.encode(r.text or ""), 2]
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, pieces.digests(odd, model).collect()), key=repr) == sorted(want, key=repr)


def test_encoding_refuses_models_whose_pieces_cross_markers(monkeypatch):
    class Crossing:
        def __init__(self, **_):
            pass

        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "of▁the"

    import sentencepiece

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Crossing)
    with pytest.raises(ValueError, match="crosses"):
        pieces.processor(b"")


def test_queries_of_the_new_operators_have_their_columns(spark):
    from tidemark.llm.queries import QUERIES

    want = {"op11_phrase_suffixes": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"], "op12_resample_chunks": ["doc_id", "n_features", "weight", "score", "rank"], "op13_piece_chunks": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]}
    for name, columns in want.items():
        out = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert out.columns == columns and out.where(F.col(columns[1]).isNotNull()).count() == out.count()
