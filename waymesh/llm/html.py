"""HTML extraction by a site style tree.

Pages of one host are merged into one tree: a style node is the chain of tag and class names down
to an element. For each style node the pages give two distributions: the child tags it was seen
with (presentation) and the texts it held (content). Over the M pages of a node, and `UNSEEN` more
that are taken to differ from all others (so that a few pages alike prove little),

    presentation importance = 1 - sum k_i log k_i / (M' log M') over child sequences, k_i the pages with one, M' = M + UNSEEN,
    content importance      = 1 - mean(log k) / log M' over texts, k the pages that share the text,

and a node's own importance is that of its content where it holds text, else of its presentation.

What sites copy from the same pools (menu words, adverts, the sentences of a footer) is seen by all pages
together: nodes of one path are pooled over all hosts, and with the sentences of their texts as features

    pooled importance       = 1 - mean(log k) / log (M + UNSEEN_POOLED) over the sentences of the M pages with the node,

k the pages with the sentence there. A text node is as important as the lesser of the two says.

A branch is as important as the most important of its node and the text nodes under it. A branch is low
if that is less than `least` times the importance of the host's most important text node, so that a
host whose pages are often copied keeps its texts. Low branches are removed from each page; as the text
nodes under a low branch are low branches too, that comes to dropping the texts of low text nodes.

The tree sees all elements, with no knowledge of their names. Names weigh in after it, as importance
0 or 1, for what entropy can't tell (menus that differ from page to page, hosts with one page):
landmarks (nav, footer, aside, form, script...) and telling class names count 0, article and main
count 1; names that tell less (header in an article, related, share, widget...) count 0 only where
most of the text is in links. Plain text elements (p, h1, li, article... without a class) belong to the
nearest other element above them; what belongs to none (node 0) is removed by names only.

The low nodes of all hosts are sent to all tasks if they are few by count; otherwise they are joined
to the pages by host, and a host with a third of all pages is split by a salt.

Defined cases: null or empty html gives an empty text; a null url is a host of its own; a tag or
comment that the end of the page cuts off is dropped; unclosed elements end with their parent; a page
whose only texts are low (a copied article, say) keeps what names leave; very long or deep pages are scanned
once a step (paths are hashes, not strings); repeated rows count as pages; input
columns of any name pass through, but for those named main_text or n_chars, which are replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import appended, written

# Element names of the HTML standard by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp")
UNSEEN = 2
#: Of the pooled nodes: a text on two or three hosts may be a shared article.
UNSEEN_POOLED = 200
NOISE = frozenset("nav footer header aside form script style noscript template iframe svg math button select option textarea dialog menu head title object canvas audio video label fieldset datalist".split())
MAIN = frozenset("article main".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote table tbody thead tr td th figure figcaption article main body html section".split())
NOISE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|sponsor(?:ed)?|promos?|banners?|sidebars?|menus?|nav|navbar|navigation|breadcrumbs?|footer|masthead"
    r"|cookies?|consent|notices?|alerts?|popups?|modal|newsletter|subscribe|signup|login|comments?|disqus|replies|pagination|pager|toolbar)(?:$|[\s_-])",
    re.I,
)
#: Names that are noise where most of the text is in links, or, for a header, outside an article.
HINT_NAMES = re.compile(r"(?:^|[\s_-])(?:share|sharing|social|related|recommended|widget|skip)(?:$|[\s_-])", re.I)
HEADER_NAMES = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split())

_TOKEN = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|/[^>]*+(?:>|\Z))""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


@lru_cache(1 << 14)
def _style(tag: str, names: str, parent: int) -> tuple[int, int]:
    """(name of an element, its style node under a parent's)."""
    return xxhash.xxh64_intdigest(tag + names), xxhash.xxh64_intdigest(tag + names, seed=parent) >> 1


class Node:
    __slots__ = ("tag", "path", "noise", "main", "kids", "owner", "depth", "hint", "link", "since")

    def __init__(self, tag: str, path: int, noise: bool, main: bool, owner: int, depth: int, hint: bool, link: bool, since: int):
        self.tag, self.path, self.noise, self.main = tag, path, noise, main
        self.owner, self.depth, self.hint, self.link, self.since = owner, depth, hint, link, since
        self.kids: list[int] = []


class Block:
    """A text, its removable style node (0: none), and whether names count it as noise or main text."""

    __slots__ = ("text", "owner", "noise", "main", "linked")

    def __init__(self, text: str, owner: int, noise: bool, main: bool, linked: int):
        self.text, self.owner, self.noise, self.main, self.linked = text, owner, noise, main, linked


def parse(page: str) -> tuple[list[Block], list[tuple[int, int, tuple[int, ...]]]]:
    """(blocks, elements) of a page in one scan. An element: style node, the removable one above it, the distinct run of its child names."""
    blocks: list[Block] = []
    elements: list[tuple[int, int, tuple[int, ...]]] = []
    stack = [Node("", 0, False, False, 0, 0, False, False, 0)]
    text: list[str] = []
    linked = 0  # characters of `text` that stand in links
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if text:
            # references are decoded run by run already; white space becomes one space
            if words := "".join(text).split():
                top = next(k for k in range(len(stack) - 1, -1, -1) if stack[k].tag not in INLINE)
                blocks.append(Block(" ".join(words), stack[top].owner, stack[-1].noise, stack[-1].main, linked))
            text.clear()
        linked = 0

    def pop() -> None:
        node = stack.pop()
        elements.append((node.path, stack[-1].owner, tuple(node.kids)))
        if node.hint:
            own = blocks[node.since :]
            if 2 * sum(x.linked for x in own) > sum(len(x.text) for x in own):
                for x in own:
                    x.noise = True

    def say(run: str) -> None:
        nonlocal linked
        text.append(entities.unescape(run) if "&" in run else run)
        if stack[-1].link:
            linked += len(text[-1].strip())

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag == "br" or tag == "wbr":
            text.append(" " if tag == "br" else "")
            continue
        if tag not in INLINE:
            flush()
        if closing:
            if any(x.tag == tag for x in stack[1:]):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else n
            if end:
                close = page.find(">", at)
                at = close + 1 if close >= 0 else n
            continue
        if tag not in INLINE and any(x.tag == "p" for x in stack[1:]):
            while stack[-1].tag != "p":
                pop()
            pop()
        if tag in ("li", "tr", "td", "th", "dt", "dd", "option") and stack[-1].tag == tag:
            pop()
        if tag in VOID:
            continue
        parent = stack[-1]
        names, hint, main = "", False, tag in MAIN
        noise = tag in NOISE and not (tag == "header" and parent.main)
        if attrs and attrs != "/":
            for k, v in _NAMES.findall(attrs):
                v, k = v.strip("\"'"), k.lower()
                if k == "role":
                    noise, main = noise or v.lower() in NOISE_ROLES, main or v.lower() == "main"
                elif k == "hidden":
                    noise = True
                else:
                    names += "." + v if k == "class" else ""
                    if tag not in ("html", "body"):
                        noise = noise or bool(NOISE_NAMES.search(v)) or not parent.main and bool(HEADER_NAMES.search(v))
                        hint = hint or bool(HINT_NAMES.search(v))
        sign, path = _style(tag, names, parent.path)
        if not parent.kids or parent.kids[-1] != sign:
            parent.kids.append(sign)
        plain = tag in INLINE or tag in PLAIN and not names
        owner = parent.owner if plain else path
        stack.append(Node(tag, path, parent.noise or noise, parent.main or main, owner, len(stack), hint, parent.link or tag == "a", len(blocks)))
    flush()
    while len(stack) > 1:
        pop()
    elements.append((0, 0, tuple(stack[0].kids)))
    return blocks, elements


SHAPE, TEXT, ABOVE, SENTENCE = range(4)
_SENTENCE = re.compile(r"(?<=[.!?:;])\s+|\s[·|»•–—-]\s")


def facts(page: str | None) -> set[tuple[int, int, int]]:
    """(style node, kind, feature) of a page, each once: child names, texts, their sentences, and the removable node above."""
    blocks, elements = parse(page or "")
    out = {(path, SHAPE, xxhash.xxh64_intdigest(repr(kids)) >> 1) for path, _, kids in elements}
    out.update((path, ABOVE, above) for path, above, _ in elements)
    out.update((x.owner, TEXT, xxhash.xxh64_intdigest(x.text) >> 1) for x in blocks)
    out.update((x.owner, SENTENCE, xxhash.xxh64_intdigest(y) >> 1) for x in blocks for y in _SENTENCE.split(x.text) if y)
    return out


def main_text(page: str | None, low: frozenset[int] = frozenset(), names: bool = True) -> str:
    """The page's text without that of low style nodes and, with names, without noise roles and inside article or main if there is one."""
    kept = [x for x in parse(page or "")[0] if x.owner not in low and not (names and x.noise)]
    inside = names and any(x.main for x in kept)
    return "\n\n".join(x.text for x in kept if x.main or not inside)


def style_nodes(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """host_key, path, above, pages, texts, own, pooled: the nodes of each host's tree with their own and pooled importance. pages has a host_key column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple, int] = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for fact in facts(page.as_py()):
                    key = (0 if fact[1] == SENTENCE else host, *fact)  # sentences are counted over all hosts
                    rows[key] = rows.get(key, 0) + 1
            cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), pa.array(list(rows.values()), pa.int64())], names=["host_key", "path", "kind", "feature", "k"])

    seen = pages.select("host_key", F.col(html_col).cast("string").alias("html")).mapInArrow(run, "host_key long, path long, kind int, feature long, k long")
    shared = seen.groupBy("host_key", "path", "kind", "feature").agg(F.sum("k").alias("k"))
    k, shape, words = F.col("k").cast("double"), F.col("kind") == SHAPE, F.col("kind") == TEXT
    sums = shared.groupBy("host_key", "path", (F.col("kind") == SENTENCE).alias("all_hosts")).agg(
        F.max(F.when(F.col("kind") == ABOVE, F.col("feature"))).alias("above"),
        F.sum(F.when(shape, F.col("k"))).alias("pages"),
        F.sum(F.when(shape, k * F.log(k))).alias("klogk"),
        F.count(F.when(words, 1)).alias("texts"),
        F.avg(F.when(words, F.log(k))).alias("shared"),
        (F.sum(k * F.log(k)) / F.sum(k)).alias("pooled"),
    )
    sums = written(sums)
    seen_on = sums.filter("NOT all_hosts").groupBy("path").agg(F.sum("pages").alias("all_pages"))
    pool = sums.filter("all_hosts").join(seen_on, "path").select("path", (1 - F.col("pooled") / F.log(F.col("all_pages") + UNSEEN_POOLED)).alias("pooled"))
    sums = sums.filter("NOT all_hosts").drop("pooled").join(pool, "path", "left")
    m = (F.col("pages") + UNSEEN).cast("double")
    presentation = 1 - F.col("klogk") / (m * F.log(m))
    # a text that stands twice in a node of one page counts once, so that k is not above the pages
    content = 1 - F.col("shared") / F.log(m)
    own = F.when(F.col("texts") > 0, content).otherwise(presentation)
    return sums.filter("pages IS NOT NULL").select("host_key", "path", "above", "pages", "texts", own.alias("own"), "pooled")


def style_tree(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """style_nodes() with importance: that of the branch, the largest of its node and the text nodes under it.

    Importance climbs the tree by doubling: in round r every node hands what it has to the node 2^r
    levels above, so that the rounds are the logarithm of the depth.
    """
    nodes = written(style_nodes(pages, html_col))
    climb = nodes.select("host_key", "path", F.col("above").alias("up"), F.when(F.col("texts") > 0, F.col("own")).alias("best"))
    while not climb.filter("up <> 0").isEmpty():
        handed = climb.filter("up <> 0").groupBy("host_key", F.col("up").alias("path")).agg(F.max("best").alias("handed"))
        next_up = climb.select("host_key", F.col("path").alias("up"), F.col("up").alias("further"))
        climb = climb.join(handed, ["host_key", "path"], "left").withColumn("best", F.greatest("best", "handed")).drop("handed")
        climb = written(climb.join(next_up, ["host_key", "up"], "left").select("host_key", "path", F.coalesce("further", F.lit(0)).alias("up"), "best"))
    return nodes.join(climb.select("host_key", "path", "best"), ["host_key", "path"]).withColumn("importance", F.greatest("own", "best")).drop("best")


def extract(
    pages: DataFrame, html_col: str = "html", url_col: str = "url", least: float = 0.8, names: bool = True, most_broadcast: int = 100_000, salts: int = 32
) -> DataFrame:
    """pages with main_text and n_chars (code points) added. names: whether landmarks and class names weigh in."""
    labels = pages.columns
    inner = pages.toDF(*[f"in{i}" for i in range(len(labels))])
    url, body = (f"in{labels.index(c)}" for c in (url_col, html_col))
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1))
    keyed = inner.withColumn("host_key", F.xxhash64(host))
    nodes = written(style_nodes(keyed.select("host_key", body), body).filter("texts > 0").select("host_key", "path", F.least("own", "pooled").alias("own")))
    best = nodes.groupBy("host_key").agg(F.max("own").alias("best"))
    low = written(nodes.join(best, "host_key").filter((F.col("path") != 0) & (F.col("own") < least * F.col("best"))).select("host_key", "path"))
    few = low.limit(most_broadcast + 1).count() <= most_broadcast
    shared = None
    if few:  # sent once, whatever the number of pages of a host
        got = low.toArrow()
        by_host: dict[int, list[int]] = {}
        for h, path in zip(got["host_key"].to_pylist(), got["path"].to_pylist(), strict=True):
            by_host.setdefault(h, []).append(path)
        shared = pages.sparkSession.sparkContext.broadcast(by_host)
        joined = keyed.withColumn("low", F.lit(None).cast("array<bigint>"))
    else:
        per_host = low.groupBy("host_key").agg(F.collect_set("path").alias("low"))
        dealt = per_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = keyed.withColumn("salt", F.pmod(F.xxhash64(url, body), F.lit(salts)).cast("int")).join(dealt, ["host_key", "salt"], "left").drop("salt")

    def kernel(htmls: pa.Array, hosts: pa.Array, lows: pa.Array) -> list[pa.Array]:
        sets: dict[int, frozenset[int]] = {}
        texts = []
        for i, page in enumerate(htmls):
            h = hosts[i].as_py()
            if h not in sets:
                sets[h] = frozenset(shared.value.get(h, ()) if shared is not None else lows[i].as_py() or ())
            texts.append(main_text(page.as_py(), sets[h], names) or main_text(page.as_py(), names=names))
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    out = appended(joined, [("main_text", "string"), ("n_chars", "bigint")], kernel, body, "host_key", "low")
    kept = [i for i, c in enumerate(labels) if c not in ("main_text", "n_chars")]
    return out.select(*[f"in{i}" for i in kept], "main_text", "n_chars").toDF(*[labels[i] for i in kept], "main_text", "n_chars")
