"""Main text of web pages by consensus host paths.

Each page's containers are scored by the text they hold outside boilerplate and links, a page
votes for its best container's generalised path (tags with their classes, digits and order
dropped), Spark sums the votes per host, and every page is extracted again below the winning path
of its host; a page without that path falls back on its own best container.  The page itself is
the outermost container, so that text outside every element is not lost.

Scale.  A vote is a host, a path and a number: votes combine before they are dealt out.  Winners
meet (key, host, path) rows by a join on the host, in which adaptive execution splits hot hosts;
no text takes part in it.  Only pages whose path lost are read and parsed a second time.
"""

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import identity, matching, staged

# Element names by their role.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article body div main section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("aside dialog footer form head header menu nav".split())
#: Dropped, but standing inside a line of text: they end no block.
MUTED = frozenset("button iframe noscript script select style svg template textarea title".split())
FORMATTING = frozenset("a b big code em font i small span strong tt u".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Where they are left open, the elements on the right end as one on the left begins.
ENDS = {
    "body": frozenset(["head"]),
    "article": frozenset("nav menu head".split()),
    "main": frozenset("nav menu head".split()),
    **dict.fromkeys("blockquote h1 h2 h3 h4 h5 h6 ol p pre section table ul".split(), frozenset("button select title".split())),
}
# Words of class names and ids that label boilerplate, whole or as a beginning.
NOISE = frozenset("ad ads banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus discussion footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice pager pagination popup related replies reply respond share sharing sidebar signup skip social subscribe tags toolbar widget".split())
NOISY = ("advert", "promo", "sponsor")
# Words that take a label back ("has-comments" labels an article), and those of readers' comments.
WITHOUT = frozenset("has have is no not show with without".split())
COMMENTS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_SPACE, _PART = re.compile(r"[\x20\t-\r]+"), re.compile(r"[_-]+")
#: A container's share in text fades by this for each container between; what is below LEAST does not count.
FADE, LEAST = 0.9, 1e-12


class Node:
    __slots__ = ("tag", "parent", "path", "box", "noise", "muted", "label", "titled", "story", "link", "size", "outer")

    def __init__(self, tag: str, parent: "Node | None", path: int) -> None:
        self.tag, self.parent, self.path = tag, parent, path
        self.noise = self.muted = self.story = self.link = False
        if parent is not None:
            self.noise, self.muted, self.story, self.link = parent.noise, parent.muted, parent.story, parent.link
        self.label, self.titled, self.size = 0, tag == "main", 0
        # The next block element around it.
        self.outer: Node | None = parent if parent is None or parent.parent is None or parent.tag in BLOCKS else parent.outer
        self.box: Node = self if parent is None or tag in CONTAINERS else parent.box


#: How surely a label tells boilerplate: the whole of a class name or id does, a word in a longer one may.
MAYBE, SURELY = 1, 2


def labelled(label: str, story: bool) -> int:
    """What the class names and the id of an element say; ``story``, whether it stands in an article."""
    most = 0
    for token in label.lower().split():
        words = [w for w in _PART.split(token) if w]
        if not words or words[0] in WITHOUT:
            continue
        told = {w for w in words if w in NOISE and not (w == "header" and story) or w.startswith(NOISY)}
        if told:
            most = max(most, SURELY if len(words) == 1 or told & COMMENTS else MAYBE)
    return most


class Page(HTMLParser):
    """One pass over the page: text blocks in order, each with the element it lies in."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.kinds: dict[tuple[int, str], int] = {}  # a path is its parent's number and its last step
        self.steps: list[tuple[int, str]] = [(0, "")]
        self.root = Node("", None, 0)
        self.nodes, self.stack, self.at = [self.root], [self.root], self.root
        self.blocks: list[tuple[str, Node, int]] = []  # text, innermost block element, characters in links
        self.text: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        t = _SPACE.sub(" ", "".join(self.text)).strip(" ")
        if t and not self.at.noise:
            self.blocks.append((t, self.at, self.linked))
        self.text, self.linked = [], 0

    def step(self, parent: int, kind: str) -> int:
        n = self.kinds.setdefault((parent, kind), len(self.steps))
        if n == len(self.steps):
            self.steps.append((parent, kind))
        return n

    def path_of(self, n: int) -> str:
        out = []
        while n:
            n, kind = self.steps[n]
            out.append(kind)
        return "/" + "/".join(reversed(out))

    def number_of(self, path: str) -> int | None:
        n = 0
        for kind in path[1:].split("/") if path != "/" else ():
            if (n := self.kinds.get((n, kind))) is None:
                return None
        return n

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br" and not self.stack[-1].muted:
                self.text.append(" ")
            return
        block = tag in BLOCKS
        if block:
            if not self.stack[-1].muted:
                self.flush()
            self.close(lambda n: n.tag == "p", lambda n: n.tag in CONTAINERS or n.tag in ("li", "blockquote"))
            if tag == "li":
                self.close(lambda n: n.tag == "li", lambda n: n.tag in ("ul", "ol", "menu"))
            if tag in ENDS:
                self.close(lambda n: n.tag in ENDS[tag], lambda n: n.tag in CONTAINERS)
            elif tag not in DROPPED:
                self.close(lambda n: n.tag == "head", lambda n: n.tag in CONTAINERS)
        known, top = dict(attrs), self.stack[-1]
        node = top
        if block:
            kind = re.sub(r"\d+", "", ".".join([tag, *sorted(str(known.get("class") or "").lower().replace("/", "|").split())]))
            node = Node(tag, top, self.step(top.path, kind))
        else:
            node = Node(tag, top, top.path)
        node.story |= tag in ("article", "main")
        node.link |= tag == "a"
        node.muted |= tag in MUTED
        label = " ".join(str(known.get(k) or "") for k in ("class", "id"))
        node.noise |= tag in DROPPED and not (tag == "header" and top.story) or "hidden" in known or known.get("aria-hidden") == "true" or str(known.get("role") or "").lower() in ROLES or bool(re.search(r"display\s*:\s*none", str(known.get("style") or "")))
        if block and label != " " and tag not in ("html", "body", "main") and not (top.story and (tag in HEADINGS or tag == "p")):
            node.label = labelled(label, top.story)
        if tag == "h1":
            up = node
            while up is not None and not up.titled:
                up.titled, up = True, up.parent
        self.stack.append(node)
        if block:
            self.nodes.append(node)
            self.at = node

    def close(self, what, until) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if what(self.stack[k]):
                del self.stack[k:]
                self.at = next(n for n in reversed(self.stack) if n.tag in BLOCKS or n is self.root)
                return
            if until(self.stack[k]):
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS and not self.stack[-1].muted:
            self.flush()
        if tag in FORMATTING:
            self.close(lambda n: n.tag == tag, lambda n: n.tag in BLOCKS and n.tag != "p")
        elif tag not in VOID:
            self.close(lambda n: n.tag == tag, lambda n: n.tag in CONTAINERS and tag not in CONTAINERS and tag != "html")

    def handle_data(self, data: str) -> None:
        top = self.stack[-1]
        if not top.muted:
            self.text.append(data)
            self.linked += len(data) if top.link else 0

    def finish(self) -> None:
        """Ends the page and takes away the blocks below elements with a label of noise.  Such an
        element stays where it holds most of the text and the page's title; if the label is a word
        of a longer name, most of the text is enough."""
        self.flush()
        for label in (SURELY, MAYBE):
            for node in self.nodes:
                node.size = 0
            for text, node, _ in self.blocks:
                node.size += len(text)
            for node in reversed(self.nodes[1:]):
                node.outer.size += node.size
            for node in self.nodes[1:]:
                most = 2 * node.size > self.root.size
                node.noise |= node.label == label and not (most and (node.titled or label == MAYBE)) or node.outer.noise
            self.blocks = [b for b in self.blocks if not b[1].noise]


def parse(html: str) -> Page:
    page = Page()
    page.feed(html)
    # What a cut tag at the end leaves is markup, what a cut reference leaves is text.
    rest = page.rawdata
    if rest and "<" not in rest:
        page.handle_data(unescape(rest))
    page.rawdata = ""
    page.finish()
    return page


def _score(page: Page) -> dict[int, float]:
    """By path: what its containers hold, nearer blocks counting more, links against."""
    out: dict[int, float] = {}
    for text, node, linked in page.blocks:
        worth, share, box = max(0, len(text) - 2 * linked), 1.0, node.box
        while box is not None and share > LEAST:
            out[box.path] = out.get(box.path, 0.0) + worth * share * (1.5 if box.tag in ("article", "main") else 1.0)
            # A body is the page; what stands outside it is no part of what it holds.
            share, box = share * FADE, box.parent.box if box.parent is not None and box.tag != "body" else None
    return out


def best_path(page: Page) -> str | None:
    scores = _score(page)
    if not scores:
        return None
    most = max(scores.values())
    return max(page.path_of(n) for n, s in scores.items() if s == most)


def below(page: Page, path: str) -> list[str]:
    """The blocks that stand in or below elements of that path.  Where the page's only h1 stands
    before them, in an element around them, it is their headline and comes first."""
    found = page.number_of(path)
    inside = [found == 0]
    for n, (parent, _) in enumerate(page.steps[1:], 1):  # a step's parent stands before it
        inside.append(inside[parent] or n == found)
    kept = [b for b in page.blocks if inside[b[1].path]]
    titles = [b for b in page.blocks if b[1].tag == "h1"]
    if kept and len({id(b[1]) for b in titles}) == 1 and not inside[titles[0][1].path]:
        around, node = titles[0][1].parent.box, kept[0][1]
        while node is not None and node is not around:
            node = node.parent
        first = next(i for i, b in enumerate(page.blocks) if b is kept[0])
        if node is not None and any(b is titles[0] for b in page.blocks[:first]):
            kept = [*titles, *kept]
    return [t for t, _, _ in kept]


def _first(batches):
    for b in batches:
        paths, texts = [], []
        for html in b.column("html").to_pylist():
            page = parse(html or "")
            path = best_path(page)
            paths.append(path)
            texts.append("\n".join(below(page, path)) if path is not None else "")
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "page_id", "url", "host")), pa.array(paths, pa.string()), pa.array(texts, pa.string())], names=["key", "page_id", "url", "host", "own", "text"])


def _again(batches):
    for b in batches:
        texts = []
        for html, path, own in zip(*(b.column(c).to_pylist() for c in ("html", "path", "own")), strict=True):
            page = parse(html or "")
            texts.append("\n".join(below(page, path) or below(page, own)))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.withColumn("host", host).withColumn("key", identity("page_id", "url", "html"))


def own_texts(pages: DataFrame) -> DataFrame:
    """key, page_id, url, host, own (the page's best path), text (what stands below it)."""
    return _hosted(pages).select("key", "page_id", "url", "host", "html").mapInArrow(_first, "key string, page_id long, url string, host string, own string, text string")


def host_paths(own: DataFrame) -> DataFrame:
    """The winning path of each host: of, path.  A page's vote counts once; ties go to the path
    with more text, then to the one that sorts first."""
    sums = own.where("own is not null").groupBy("host", "own").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    return sums.groupBy("host").agg(F.min_by("own", F.struct(-F.col("n"), -F.col("w"), "own")).alias("path")).select(F.col("host").alias("of"), "path")


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages (page_id, url, html): page_id, url, text, n_chars.

    Pages whose own best path is their host's have their text already; the others are extracted
    again below the host's path, and keep their own text if they have nothing there.  Null html is
    empty and has the empty text; a null or odd url belongs to the host of no name; repeated rows
    get equal texts; other columns are ignored.
    """
    own = staged(own_texts(pages), "html-own")
    light = own.select("key", "host", "own", F.length("text").alias("size"))
    voted = light.join(host_paths(light), F.col("host") == F.col("of"))
    other = staged(voted.where("own <> path").select("key", "path", "own").dropDuplicates(["key"]), "html-other")
    again = matching(_hosted(pages).select("key", "page_id", "url", "html"), other, "key", "inner")
    again = again.select("page_id", "url", "html", "path", "own").mapInArrow(_again, "page_id long, url string, text string")
    out = matching(own, other.select("key"), "key", "left_anti").select("page_id", "url", "text").unionByName(again)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
