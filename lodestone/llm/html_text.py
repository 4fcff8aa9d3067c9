"""Main text of web pages by consensus: pages score their containers and vote, each host's winning paths are then read out.

A page is parsed into containers (elements that hold blocks of text), each known by its generalised path: tags with their
classes from the body down, numbers in them written as #. A container is scored by the text outside of links and
boilerplate below it. Each page votes for the path of its best one; Spark counts the votes of a host. Then every page is read
again with its host's winners: the one with most votes of those that occur on it. Where none does, its own best container
is read. So a page with next to no text, or with a long notice, is read where the others of its host are.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import fresh, heavy_keys, spread_join, stored, tidy
from .url_filter import split_url

#: A comment, a declaration, or a tag; quoted values of attributes may hold >.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# What HTML's elements are.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base basefont br col embed frame hr img input keygen link meta param source track wbr".split())
#: Their contents are no text of the page.
SKIPPED = frozenset("script style noscript template textarea iframe title svg math canvas object audio video select button datalist noembed noframes xmp".split())
#: An element that ends when another of its kind begins, and where the search for it ends.
ENDS_BEFORE = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold text, but no other blocks that count as containers.
LEAVES = HEADINGS | frozenset("p li ul ol dl dt dd pre blockquote figure figcaption table thead tbody tfoot tr td th caption address hr summary".split())
#: Boilerplate by its tag, by its role, and by words in its class or id; words that say nothing beside them, and words before them that say "this page has".
ASIDE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
ASIDE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright cta discussion disqus disclaimer donate footer foot footnav gdpr header "
    "headerbar login masthead menu menus modal nav navbar navigation newsletter notice notices notification notifications overlay pager pagination paywall popup privacy promo promoted promotion promotions recommended recommendations register related "
    "replies reply respond search share sharing shares sidebar sidebars signin signup skip social sponsor sponsored sponsors subscribe subscription teaser teasers toolbar topbar trending widget widgets".split()
)
NEUTRAL_WORDS = frozenset("a an the and box bar wrap wrapper container inner outer list area block section row column col group panel region slot unit item items site page web global main top bottom left right primary secondary first last small large mobile desktop holder frame zone links link text content body post entry article js id div module component form user users reader readers rail side sticky fixed inline".split())
_SAYS_HAS = frozenset("has have with without no is show shows hide hides hidden layout can allow enable enabled disable disabled open closed".split())
_CONTENT_WORDS = frozenset("post entry article story content body text".split())
#: Most that a container may hold beside its own text before one within it is taken instead, as a share; weight of a container that says it is the article.
LOOSE, NAMED = 0.2, 1.25
#: Votes that a path needs, as a share of its host's: so a host has twenty winners at most.
LEAST_SHARE = 0.05
#: Letters of a path from which on what lies further up is written as a hash: pages may be nested very deep.
LONG_PATH = 2_000
#: Winners' bytes up to which they are broadcast.
BROADCAST_BYTES = 16 << 20


@dataclass(slots=True)
class Node:
    """An element. ``box`` is the container it lies in, itself if it is one."""

    tag: str
    path: str
    parent: Node | None
    box: Node | None = None
    #: Boilerplate for sure; perhaps; named as the article; within an article.
    aside: bool = False
    doubtful: bool = False
    named: bool = False
    within: bool = False
    #: Letters outside of links, and in them, in itself and below; is a title, or an article, below?
    good: int = 0
    links: int = 0
    titled: bool = False
    holds: bool = False
    inside: bool = False
    children: list[Node] = field(default_factory=list)


@dataclass(slots=True)
class Block:
    node: Node
    text: str
    links: int


def _words(name: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(name)]


def _judged(tag: str, attrs: dict[str, str], names: list[str], within: bool) -> tuple[bool, bool, bool]:
    """(boilerplate, perhaps boilerplate, named as the article) of an element; within: of an article."""
    if tag in ("html", "body"):
        return False, False, False
    told = tag in ("article", "main") or attrs.get("role", "").lower() in ("main", "article") or "articleBody" in attrs.get("itemprop", "")
    if "hidden" in attrs or tag in ASIDE_TAGS or (tag == "header" and not within) or attrs.get("role", "").lower() in ASIDE_ROLES or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True, False, False
    sure = maybe = False
    for name in names:
        words = _words(name)
        bad = [w for w in words if w in ASIDE_WORDS]
        if not bad or _SAYS_HAS & set(words):
            continue
        if set(bad) == {"header"} and (within or _CONTENT_WORDS & set(words)):
            continue  # the article's own head
        rest = set(words) - ASIDE_WORDS
        if told and rest:
            continue
        if rest <= NEUTRAL_WORDS:
            sure = True
        else:
            maybe = True
    content = told or any(w in ("article", "story", "post", "entry") for name in names for w in _words(name)) or any(" ".join(_words(n)) in ("content", "main content", "page content", "main") for n in names)
    return sure, maybe and not sure, content and not sure


class Page:
    """Containers and blocks of a page's HTML."""

    def __init__(self, html: str) -> None:
        self.root = Node("body", "body", None)
        self.root.box = self.root
        self.blocks: list[Block] = []
        self.nodes: list[Node] = [self.root]  # parents before children
        self._read(html)
        self.containers = [n for n in self.nodes if n.box is n]
        self._settle()

    def _read(self, html: str) -> None:
        stack, buffer, link, link_chars, at, size = [self.root], [], False, 0, 0, len(html)
        standing: Counter[str] = Counter()  # open elements by tag

        def close(i: int) -> None:
            standing.subtract(n.tag for n in stack[i:])
            del stack[i:]

        def nearest(tags: set[str], until: set[str] = frozenset()) -> int:
            """Where in the stack the innermost open element of these lies; 0 if there is none before one of ``until``."""
            if any(standing[t] > 0 for t in tags):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in tags:
                        return i
                    if stack[i].tag in until:
                        break
            return 0

        def flush() -> None:
            nonlocal link_chars
            if buffer:
                text = " ".join(entities.unescape("".join(buffer)).split())
                if text:
                    self.blocks.append(Block(stack[-1], text, min(link_chars, len(text))))
                buffer.clear()
            link_chars = 0

        def say(text: str) -> None:
            nonlocal link_chars
            if text:
                buffer.append(text)
                if link:
                    link_chars += len(text)

        while at < size:
            m = _TOKEN.search(html, at)
            if m is None:
                say(html[at:])
                break
            say(html[at : m.start()])
            at, tag = m.end(), (m["tag"] or m["tag2"] or "").lower()
            if not tag:  # a comment
                continue
            if m["end"] or m["end2"]:
                if tag == "a":
                    link = False
                elif tag not in INLINE:
                    flush()
                    if i := nearest({tag}):
                        close(i)
                continue
            if tag == "br":
                say(" ")
                continue
            if tag in SKIPPED:
                if not (m["attrs"] or "").endswith("/"):
                    end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
                    at = end.end() if end else size
                if tag not in ("script", "style", "noscript", "template"):
                    say(" ")
                continue
            if tag in INLINE:
                link = tag == "a" or link
                continue
            if tag in ("html", "body", "head"):
                continue
            flush()
            if tag in VOID:
                continue
            while len(stack) > 1 and (stack[-1].tag == "p" or stack[-1].tag in HEADINGS and tag in HEADINGS):
                close(len(stack) - 1)
            if tag in ENDS_BEFORE and (i := nearest(*ENDS_BEFORE[tag])):
                close(i)
            node = self._opened(tag, m["attrs"] or m["attrs2"] or "", stack[-1])
            if not (m["attrs"] or "").endswith("/"):  # <x/> is taken for an empty element
                stack.append(node)
                standing[tag] += 1
        flush()

    def _opened(self, tag: str, attrs: str, parent: Node) -> Node:
        found: dict[str, str] = {}
        if attrs:
            for k, v in _ATTR.findall(attrs):
                found.setdefault(k.lower(), entities.unescape(v.strip("\"'")))
        names = found.get("class", "").split() + found.get("id", "").split()
        sure, maybe, named = _judged(tag, found, names, parent.within)
        node = Node(tag, parent.path, parent, parent.box, aside=sure or parent.aside, doubtful=maybe, named=named, within=parent.within or tag in ("article", "main"))
        if tag not in LEAVES:
            own = found.get("class", "").split() or [f"#{x}" for x in found.get("id", "").split()]
            label = ".".join([tag, *sorted({re.sub(r"\d+", "#", x) for x in own})])
            above = parent.path if len(parent.path) < LONG_PATH else "~" + hashlib.blake2b(parent.path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
            node.path, node.box = f"{above}>{label}", node
            parent.box.children.append(node)
        self.nodes.append(node)
        return node

    def _settle(self) -> None:
        """Clears doubts of what holds an article or most of the page's text, then sums up texts."""
        for b in self.blocks:
            b.node.good += max(0, len(b.text) - b.links)
            b.node.links += b.links
        every = sum(len(b.text) for b in self.blocks if not b.node.aside)
        texts = {id(n): n.good + n.links for n in self.nodes}
        for n in reversed(self.nodes):
            n.holds |= n.named
            if n.parent is not None:
                texts[id(n.parent)] += texts[id(n)] if not n.aside else 0
                n.parent.holds |= n.holds
        for n in self.nodes:
            n.aside |= n.parent is not None and n.parent.aside or n.doubtful and not n.holds and 2 * texts[id(n)] <= every
            n.titled = n.tag == "h1" and not n.aside
            if n.aside:
                n.good = n.links = 0
        for n in reversed(self.nodes):
            if n.parent is not None:
                n.parent.good += n.good
                n.parent.links += n.links
                n.parent.titled |= n.titled

    def best(self) -> Node | None:
        """The container with the best score, or the one within it that holds nearly all of it; None without text."""
        open_ones = [n for n in self.containers if not n.aside and n.good]
        if not open_ones:
            return None
        named = [n for n in open_ones if n.named and NAMED * n.good > self.root.good * (1 - LOOSE)]
        node = max(named, key=lambda n: (n.good, -n.path.count(">"))) if named else self.root
        while True:
            inner = [c for c in node.children if not c.aside and c.good >= (1 - LOOSE) * node.good]
            inner = [c for c in inner if c.titled or not node.titled]
            if not inner or (node.tag == "article" and not any(c.named for c in inner)):
                return node
            if node.named and not any(c.named for c in inner) and inner[0].good < node.good:
                return node
            node = inner[0]

    def read(self, path: str) -> str:
        """The text of the containers with this path: of several, those that are more than links."""
        own = [n for n in self.containers if n.path == path and not n.aside]
        if len(own) > 1:
            own = [n for n in own if n.good > n.links] or own[:1]
        picked = {id(n) for n in own}
        for n in self.nodes:
            n.inside = id(n) in picked or n.parent is not None and n.parent.inside
        return "\n".join(b.text for b in self.blocks if b.node.inside and not b.node.aside)


def own_path(html: str | None) -> str:
    """The path that a page votes for; empty for a page without text."""
    node = Page(html or "").best()
    return node.path if node else ""


def main_text(html: str | None, winners: str | None) -> str:
    """winners: paths, a line each, the one with most votes first.

    Of those with text on the page the first is read; but where the page's own best path is one of them, too, and lies within the first, that.
    """
    page, there = Page(html or ""), {}
    best = page.best()
    for n in page.containers:
        if not n.aside:
            there[n.path] = there.get(n.path, 0) + n.good
    won = [p for p in (winners or "").split("\n") if p in there]
    chosen = next((p for p in won if there[p]), next(iter(won), None))
    if chosen is None or best is not None and best.path in won and _lies_within(best, chosen):
        chosen = best.path if best else None
    return page.read(chosen) if chosen else ""


def _lies_within(node: Node, path: str) -> bool:
    above = node.parent
    while above is not None and above.path != path:
        above = above.parent
    return above is not None


def host_winners(votes: DataFrame) -> DataFrame:
    """(host, path, n) -> host, winners: of every host the paths with a share of LEAST_SHARE or more of its votes, most votes first, ties by the path; as main_text() takes them."""
    totals = votes.groupBy("host").agg(F.sum("n").alias("total"))
    given = votes.where("path != ''")
    shares = spread_join(given, totals, "host", heavy_keys(given, "host")).select("host", "path", (F.col("n") / F.col("total")).alias("share"))
    best = shares.where(F.col("share") >= LEAST_SHARE).groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("less"), "path"))).alias("best"))
    lines = F.array_join(F.transform("best", lambda x: x["path"]), "\n")
    return totals.select("host").join(best.select("host", lines.alias("winners")), "host", "left")


@F.pandas_udf(StringType())
def _votes_for(html: pd.Series) -> pd.Series:
    out = pd.Series([own_path(h) for h in html], dtype=object)
    tidy()
    return out


@F.pandas_udf(StringType())
def _read_out(html: pd.Series, winners: pd.Series) -> pd.Series:
    out = pd.Series([main_text(h, w) for h, w in zip(html, winners, strict=True)], dtype=object)
    tidy()
    return out


def extract(pages: DataFrame, text: str = "text") -> DataFrame:
    """(url, html, ...) -> every row with all its columns, whatever these are called, and a new one, ``text``: the page's main text.

    White space within a block becomes one space, blocks are joined by newlines, character references are decoded. Null
    and empty html gives an empty text. Pages without a usable url are one host. Rows that repeat are voters and results of
    their own; an empty table gives none. Pages of any length are read whole. A column called as ``text`` is replaced.
    Hosts of very many pages are joined by broadcast, and all hosts where the winners' size, which is measured, is small.
    """
    host, won = fresh(pages.columns, "host", "winners")
    rows = pages.withColumn(host, split_url(F.col("url"))[0])
    votes = rows.select(F.col(host).alias("host"), _votes_for("html").alias("path")).groupBy("host", "path").agg(F.count("*").alias("n"))
    votes = stored(votes, "votes")
    winners = stored(host_winners(votes).select(F.col("host").alias(host), F.col("winners").alias(won)), "winners")
    bytes_, = winners.agg(F.sum(F.length(host) + F.coalesce(F.length(won), F.lit(0)) + 100)).first()
    if (bytes_ or 0) <= BROADCAST_BYTES:
        met = rows.join(F.broadcast(winners), host)
    else:
        heavy = votes.groupBy("host").agg(F.sum("n").alias("n"))
        total = votes.agg(F.sum("n")).first()[0]
        met = spread_join(rows, winners, host, heavy.where(F.col("n") > max(10_000, total // 1_000)).select(F.col("host").alias(host)))
    kept = [f"`{c}`" for c in pages.columns if c.lower() != text.lower()]
    return met.select(*kept, _read_out(F.col("html"), F.col(won)).alias(text))
