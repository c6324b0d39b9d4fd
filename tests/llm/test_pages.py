"""WARC archives and main texts."""

import gzip
import random
from html import escape

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html, warc

PAGE = '<html><head><title>T</title></head><body><nav><a href="/">Home</a></nav><div class="ad">Buy</div><article><h1>Head &amp; tail</h1><p>One\n two<br>three</p><p><b>Four<br><p>five &lt;six&gt; {more}</p><div class="comments"><p>First!</p></div></article><aside>side</aside><script>var x = "<p>";</script><footer>foot</footer></body></html>'


def pages(spark, n=12):
    data = [(i, f"http://h{i % 2}.example.org/{i}", PAGE.replace("{more}", "text " * (3 + i))) for i in range(n)]
    return spark.createDataFrame([*data, (n, "http://h0.example.org/x", None), (n + 1, None, ""), (n + 2, "odd\nurl", data[0][2]), (None, None, data[1][2])], "page_id long, url string, html string")


def test_extraction():
    p = html.parse(PAGE.replace("{more}", "x"))
    assert html.best_path(p) == "/html/body/article"
    assert html.below(p, "/html/body/article") == ["Head & tail", "One two three", "Four", "five <six> x"]
    assert html.below(html.parse("<div>plain <i>text</i> &eacute;"), "/div") == ["plain text é"]


@pytest.mark.parametrize(("body", "blocks"), [
    ("<p>A <math>x</math> b <button>no</button>c<svg><text>no</text></svg> d</p>", ["A x b c d"]),
    ("<article><h1 class='header'>H</h1><p class='share'>kept</p><div class='share-buttons'>no</div><div class='entry-header'><h2>sub</h2></div></article>", ["H", "kept", "sub"]),
    ("<div class='post has-comments'><h1>T</h1><p>long text of the post</p><div class='comments'><p>First!</p></div></div>", ["T", "long text of the post"]),
    ("<nav><a href='/'>Home</a><article><p>left open above</p></article>", ["left open above"]),
    ("<p>one<select><option>no</p><p>two</p>", ["one", "two"]),
    ("<div>a&nbsp;b \t\n c</div>", ["a\u00a0b c"]),
    ("<main>" + "<div>" * 3000 + "deep", ["deep"]),
    ("<h1>H</h1><p>beside every container</p>", ["H", "beside every container"]),
    ("<h1>T</h1><div class='post has-comments'><p>long text of the post</p></div>", ["T", "long text of the post"]),
    ("<div class='widget-content'><p>the text of a page builder</p></div><div class='widget'>no</div>", ["the text of a page builder"]),
    ("<main><div class='hidden-gems'><p>gems that are easily missed</p></div></main>", ["gems that are easily missed"]),
    ("<h1>T</h1><div class='content'><p>one two three</p><p>four five six</p></div><div class='cookie-banner'>We use cookies</div>", ["T", "one two three", "four five six"]),
    ("<div class='post'><p>a post</p></div><div class='comments-area'><p>comments are longer than their post</p></div>", ["a post"]),
    ("<div id='comments'><p>comments are longer than their post</p></div><div class='post'><h1>T</h1></div>", ["T"]),
])
def test_what_counts_as_text(body, blocks):
    for head in ("<html><head><title>t</title></head><body>", "<html><head><title>t</title><body>", "<html>", "<!doctype html><title>x</title>", ""):
        page = html.parse(head + body)
        assert [t for t, _, _ in page.blocks] == blocks
        assert html.below(page, html.best_path(page)) == blocks


def test_headline_beside_the_container():
    text = lambda body: (lambda p: html.below(p, html.best_path(p)))(html.parse(body))
    long_ = "<div class='content'>" + "<p>a long text</p>" * 40 + "</div>"
    assert text(f"<div class='page'><h1>T</h1>{long_}</div>")[:2] == ["T", "a long text"]
    assert text(f"<div class='top'><h1>Site</h1></div>{long_}")[0] == "a long text"  # of another element
    assert text(f"<div>{long_}<h1>T</h1></div>").count("T") <= 1


def page_of(rng, i):
    """A page of known main text: its html and the text."""
    vocabulary = ["alpha", "b&b", "çé", "x<y", "word", "7", "\u00a0", "\U0001f600"]
    blocks = [" ".join(rng.choices(vocabulary[:6], k=rng.randrange(3, 40))) for _ in range(rng.randrange(1, 12))]
    esc = lambda t: "".join(rng.choice([escape(c), f"&#{ord(c)};", f"&#x{ord(c):x};"]) if c in "&<" else c for c in t)
    inline = lambda t: rng.choice(["{}", "<b>{}</b>", "<p><i>{}<br></i>", "\n {} \t", "<span class=ad-word>{}</span>"]).format(esc(t).replace(" ", rng.choice([" ", "  ", "\n"])))
    parts = [f"<{tag}>{inline(t)}</{tag}>" for t, tag in zip(blocks, rng.choices(["p", "h2", "li", "div", "blockquote", "td"], k=len(blocks)), strict=True)]
    noise = ["<nav><ul><li><a href=/>Home</a></ul></nav>", "<div class='ad'>Buy this now</div>", "<div id='cookie-banner'><p>Cookies!</p></div>", "<form>Mail <input> <button>Send</button></form>", "<aside><p>Related things</p></aside>", "<footer>&copy; us</footer>", "<script>var a='</p>'</script>", "<section class='comments'><p>Nice words</p></section>", "<!-- no -->"]
    rng.shuffle(noise)
    k = rng.randrange(len(noise))
    return f"<html><head><title>T{i}</title></head><body>{''.join(noise[:k])}<article class='post{i}'>{''.join(parts)}</article>{''.join(noise[k:])}</body></html>", "\n".join(blocks)


def test_extract_against_known_texts(spark):
    rng = random.Random(4)
    made = [page_of(rng, i) for i in range(300)]
    long_, text = page_of(rng, 1)
    made.append((long_.replace("</article>", "<p>very long</p>" * 100_000 + "</article>"), text + "\nvery long" * 100_000))
    df = spark.createDataFrame([(i, f"https://h{i % 7}.example.org/{i}", h, "k", "w", 1) for i, (h, _) in enumerate(made)], "page_id long, url string, html string, key string, own string, host int")
    got = {r.page_id: r for r in html.extract(df).collect()}
    assert [got[i].text for i in range(len(made))] == [t for _, t in made]
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_ties_of_paths_and_copies(spark):
    a, b = "<body><div class='x'><p>one two</p></div></body>", "<body><div class='y'><p>one two</p></div></body>"
    rows = [(1, "http://h/1", a), (2, "http://h/2", b), (2, "http://h/2", b), (3, "http://h/3", a + "<p>zz</p>"), (4, "http://h/4", "<div class='y'>no</div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html.host_paths(html.own_texts(df).withColumn("size", F.length("text"))).collect()[0].path == "/body/div.x"
    assert sorted((r.page_id, r.text) for r in html.extract(df).collect())[:4] == [(1, "one two"), (2, "one two"), (2, "one two"), (3, "one two")]


def test_hosts_agree_on_a_path(spark):
    a = '<body><div class="main1"><p>{}</p></div><div class="more"><p>{}</p></div></body>'
    rows = [(i, "http://h.example.org/p", a.format("content " * 30, "other")) for i in range(5)] + [(9, "http://h.example.org/q", a.format("short", "other " * 40))]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "short" and got[0].startswith("content")


def plain_consensus(rows):
    """extract() by loops over (page_id, url, html): votes by host, each page below its host's winner."""
    own, votes, text = [], {}, {}
    for _, url, h in rows:
        page = html.parse(h)
        path = html.best_path(page)
        host = url.split("/")[2]
        own.append((page, path, host))
        if path is not None:
            n, size = votes.setdefault(host, {}).get(path, (0, 0))
            votes[host][path] = (n + 1, size + len("\n".join(html.below(page, path))))
    for (i, _, _), (page, path, host) in zip(rows, own, strict=True):
        won = min(votes.get(host, {}), key=lambda p: (*(-x for x in votes[host][p]), p), default=None)
        text[i] = "\n".join((html.below(page, won) if won else []) or (html.below(page, path) if path else []))
    return text


def test_consensus_against_loops(spark):
    rng = random.Random(12)
    part = lambda: rng.choice(["<div class='{}'>{}</div>", "<article>{1}</article>", "<section class='{}'><div>{}</div></section>", "{1}"]).format(rng.choice(["a", "b1", "b2", "widget-content", "has-comments"]), "".join(f"<p>{'w ' * rng.randrange(1, 30)}</p>" for _ in range(rng.randrange(4))))
    rows = [(i, f"http://h{rng.randrange(6)}.org/{i}", rng.choice(["<body>", "<html><body>", ""]) + "".join(part() for _ in range(rng.randrange(4)))) for i in range(240)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert got == plain_consensus(rows)


def test_extract_on_odd_tables(spark):
    df = pages(spark)
    got = html.extract(df).collect()
    assert len(got) == df.count() and {r.text for r in got if r.page_id in (12, 13)} == {""}
    assert all(r.n_chars == len(r.text) for r in got)
    assert html.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, tmp_path, compress):
    df = pages(spark)
    warc.write(df, f"file:{tmp_path}/w", compress)
    found = warc.read(spark, f"file:{tmp_path}/w")
    assert warc.gaps(found).count() == 0
    got = {r.page_id: r for r in found.collect()}
    source = {r.page_id: (r.html or "").encode() for r in df.collect()}
    assert got.keys() == source.keys()
    for i, r in got.items():
        assert (r.payload_bytes, r.payload_digest) == (len(source[i]), warc.digest(source[i]))
        if r.record_type == "response":
            assert r.payload == source[i]
    assert (got[0].record_type, got[0].refers_to) == ("revisit", 14) and got[14].record_type == "response"
    assert (got[None].record_type, got[None].refers_to) == ("revisit", 1)
    assert (got[12].refers_to, got[13].record_type) == (13, "response")
    assert got[14].url == "odd%0Aurl"
    if compress:
        names = list((tmp_path / "w").rglob("part-*"))
        assert sum(gzip.decompress(p.read_bytes()).count(b"WARC/1.1\r\n") for p in names) == df.count()


@pytest.mark.parametrize("compress", [True, False])
def test_salvage(compress):
    make = lambda i: warc.record(i, None, b"payload %d" % i * 99, warc.digest(b"payload %d" % i * 99), None, False)
    parts = [warc._member(make(i)) if compress else make(i) for i in range(5)]
    whole = list(warc.salvage(b"".join(parts)))
    assert [r["page_id"] for _, r, _, _ in whole] == [0, 1, 2, 3, 4]
    for damage in (lambda b: b[:30] + b"\0\0\0" + b[33:], lambda b: b[:40], lambda b: b"junk", lambda b: b[3:]):
        broken = damage(parts[2])
        data = b"".join([*parts[:2], broken, *parts[3:]])
        got = list(warc.salvage(data))
        assert [r["page_id"] for _, r, _, _ in got if r] == [0, 1, 3, 4]
        lost = [(a, e) for a, r, e, _ in got if r is None]
        start = len(parts[0]) + len(parts[1])
        assert lost[0][0] == start and lost[-1][1] == start + len(broken) and all(why for _, r, _, why in got if r is None)
    assert list(warc.salvage(b"")) == [] and len(list(warc.salvage(b"\x1f\x8b\x08 nothing"))) == 1


def test_salvage_inside_members():
    make = lambda i: warc.record(i, None, b"%d" % i * 20_000, warc.digest(b"%d" % i * 20_000), None, False)
    ids = lambda data: [r["page_id"] for _, r, _, _ in warc.salvage(data) if r]
    bad = b"WARC/1.1\r\nbroken header\r\n\r\n"
    data = warc._member(make(1) + bad + make(2) + make(3)) + warc._member(make(4))
    assert ids(data) == [1, 2, 3, 4]
    gaps = [(a, e, why) for a, r, e, why in warc.salvage(data) if r is None]
    assert len(gaps) == 1 and gaps[0][2].startswith(f"inflated bytes {len(make(1))} to {len(make(1) + bad)}:")
    rng = random.Random(8)
    noise = warc.record(7, None, (x := rng.randbytes(90_000)), warc.digest(x), None, False)
    cut = warc._member(make(5) + noise)[:-30_000]  # what came before the cut is kept
    assert ids(cut + warc._member(make(6))) == [5, 6]


def test_members_with_wrong_trailers():
    make = lambda i: warc.record(i, None, b"payload %d " % i * 9, warc.digest(b"payload %d " % i * 9), None, False)
    spoil = lambda b, k: b[:k] + bytes([b[k] ^ 0x55]) + b[len(b) + k + 1 :]
    members = [warc._member(make(i)) for i in range(80)]
    for k in (-8, -1):  # checksum, length
        data = warc.EMPTY_MEMBER.join(spoil(m, k) if i != 40 else m for i, m in enumerate(members))
        got = list(warc.salvage(data))
        assert [r["page_id"] for _, r, _, _ in got if r] == list(range(80))
        lost = [(a, e, why) for a, r, e, why in got if r is None]
        assert len(lost) == 79 and all("checksum" in why for _, _, why in lost)
        assert all(e - a == len(m) for (a, e, _), m in zip(lost, (m for i, m in enumerate(members) if i != 40), strict=True))
    # A missing trailer ends the member where the next begins.
    got = list(warc.salvage(members[0][:-8] + members[1] + members[2][:-8]))
    assert [r["page_id"] for _, r, _, _ in got if r] == [0, 1, 2]


def test_a_broken_stream_gives_all_before_the_fault():
    rng = random.Random(2)
    body = rng.randbytes(3_000)
    first, second = (warc.record(i, None, x, warc.digest(x), None, False) for i, x in ((1, b"short"), (2, body)))
    member = warc._member(first + second)
    for at in (len(member) - 1_000, len(member) - 300):
        broken = member[:at] + b"\xff" * 60 + member[at + 60 :]
        got = list(warc.salvage(broken + warc._member(warc.record(3, None, b"x", warc.digest(b"x"), None, False))))
        assert [r["page_id"] for _, r, _, _ in got if r] == [1, 3]
    extra = b"\x1f\x8b\x08\x1e" + bytes(6) + b"\x03\x00abc" + b"name\0" + b"comment\0" + b"\0\0"
    assert [r["page_id"] for _, r, _, _ in warc.salvage(extra + warc._member(first)[10:])] == [1]


def test_runs_of_bad_members_are_gaps_of_their_own():
    rng = random.Random(6)
    members = [warc._member(warc.record(i, None, x, warc.digest(x), None, False)) for i in range(6) if (x := rng.randbytes(2_000))]
    broken = [m[:900] + b"\xff" * 80 + m[980:] if i in (2, 3) else m for i, m in enumerate(members)]
    got = list(warc.salvage(b"".join(broken)))
    assert [r["page_id"] for _, r, _, _ in got if r] == [0, 1, 4, 5]
    begin = len(members[0]) + len(members[1])
    gaps = [(a, e) for a, r, e, _ in got if r is None]
    assert gaps[0][0] == begin and gaps[-1][1] == begin + len(members[2]) + len(members[3]) and all(x[1] == y[0] for x, y in zip(gaps, gaps[1:], strict=False))


def test_archives_go_with_the_stages(spark):
    from tidemark.llm.common import scratch

    name = warc.round_trip(pages(spark)).first().file
    assert scratch(spark, "x").rsplit("/", 1)[0].removeprefix("file:") in name


def test_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4_000)
    monkeypatch.setattr(warc, "CLASSES", (100, 1_000))
    rng = random.Random(3)
    rows = [(i, None, "".join(rng.choices("abcdefgh", k=rng.choice([0, 90, 100, 101, 900, 5_000, 40_000]))), i, "x") for i in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, rank int, payload string").repartition(2)
    warc.write(df, f"file:{tmp_path}/w")
    found = warc.read(spark, f"file:{tmp_path}/w").collect()
    assert {r.page_id: r.payload_bytes for r in found} == {i: len(h) for i, _, h, _, _ in rows}
    by = {}
    for r in found:
        by.setdefault(r.file, []).append(r.payload_bytes)
    assert all(sum(b) <= 4_000 or len(b) == 1 for b in by.values())


def test_small_payloads_are_never_revisits(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "ab"), (2, None, "ab"), (3, None, "abcdef"), (4, None, "abcdef"), (4, None, "abcdef")], "page_id long, url string, html string")
    warc.write(df, f"file:{tmp_path}/w", least=4)
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read(spark, f"file:{tmp_path}/w").collect())
    assert [x[:2] for x in got] == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response"), (4, "response")] and got[2][2] == 4


def test_empty_table(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0
