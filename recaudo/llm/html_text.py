"""Main text of web pages by consensus host paths.

Pages of one host share templates, so they tell together where the article
stands:

1. Each page is read into containers and blocks. A block is a stretch of text
   between the bounds of paragraphs, headings, list items, rows and the like;
   inline tags and line breaks don't end it. A block's worth is its length
   less ``LINK`` times the length of its links; a container gets the worth of
   its own blocks and half of what its inner containers have, doubled for
   names of articles. The page votes for the generalised path of its best
   container: tags with their classes and ids, without digits.
2. Votes are counted per (host, path) with partial sums. The paths with at
   least one in ``WINNERS`` of a host's votes win, by votes, then worth, then
   name, so a host has at most ``WINNERS`` of them.
3. Every page is read again. Of its host's winning paths the first that leads
   to text gives the text; where a path leads to several containers, those
   with at least a fifth of the best one's worth do, in page order. A page
   that no winning path leads anywhere gives its own best container.

What is never text: comments, scripts, styles, forms, menus, footers, asides,
hidden elements, and elements whose class, id or role names an advert, a
notice, a sidebar, sharing or reader comments, unless a class or id so named
holds the page's main heading (a whole page laid out "with-sidebar"). Of a
page header only headings inside the article stay. Character references are
decoded, white space (as Python's ``str.split`` sees it, no-break spaces too)
becomes one space inside a block, blocks are trimmed and joined by a line feed.

The votes of a hot host are added up before they shuffle. A page is joined
with its host's one row of winners; that join is planned as a shuffle with the
winners as the hashed side, so AQE splits a hot host over many tasks, and
pages without a host, which nobody votes for, are spread by their id.

Null html counts as empty, and a page without text gives the empty text.
Truncated pages, unclosed tags and quotes are read as far as they go, in time
linear in the page. Null urls and urls without a host vote for nobody.
Repeated rows vote and are answered each; an empty table gives an empty
result. Only the id, url and html columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import read_table, written
from .registry import register

WINNERS = 20
LINK = 3
#: HTML's own vocabulary (fixed values).
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CONTAINERS = frozenset("html body div section article main aside nav header footer form ul ol dl table tbody thead tfoot tr td th "
                       "blockquote figure details center fieldset dialog menu search".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption caption summary address legend hr option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset(("td", "th"))
#: Open elements that an element of this kind ends.
IMPLIED = {"li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")),
           "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(("option",))}
#: What may stand in a head, and elements of whose inside nothing is read.
IN_HEAD = frozenset("meta link base title script style noscript template".split())
SKIPPED = RAW | frozenset("head noscript template svg math select object canvas audio video".split())
#: Elements that are never part of the text, and names that say so (class, id or role).
NEVER = frozenset("head nav footer aside form script style noscript template iframe svg math button select textarea object canvas audio video dialog menu search".split())
NAMES = frozenset("ad ads adv advert adverts advertisement adsbox adslot adsense banner sponsor sponsored promo promotion popup modal cookie cookies consent gdpr notice notices alert "
                  "sidebar sidebars rail widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer foot masthead topbar toolbar "
                  "comment comments disqus replies reply respond discussion share sharing social related recommended newsletter subscribe subscription signup login search "
                  "skip outbrain taboola complementary contentinfo form".split())
ON_ARTICLES = frozenset("comment comments reply replies ad ads advert advertisement sponsored promo related".split())
GOOD = frozenset("article content entry main post story text body".split())
HEADER = frozenset("header head banner masthead".split())

_OPEN = re.compile(r"(?s)<(?:(?P<note>!--)|(?P<mark>[!?])|(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>=]|=(?:\s*+(?:\"[^\"]*+\"|'[^']*+'))?+)*+)>)")
_LOOSE = re.compile(r"(?s)<(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>[^>]*+)>")
_ATTR = re.compile(r"(?s)([^\s=\"'/]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): ("text", text, ""), ("open" or "end", tag, attributes)."""
    at, size, last = 0, len(html), html.rfind(">")
    strict = True
    while at < size:
        low = html.find("<", at)
        if low < 0:
            break
        m = _OPEN.match(html, low) if strict else None
        if m is None:
            follows = html[low + 1:low + 3]
            if strict and low < last and (follows[:1].isalpha() or follows[:1] == "/" and follows[1:].isalpha()):
                strict = False                      # an open quote: from here on a tag ends at the first >
            if not strict:
                m = _OPEN.match(html, low) if follows[:1] in "!?" else _LOOSE.match(html, low) if low < last else None
        if m is None:
            if low > last and (html[low + 1:low + 2].isalpha() or html[low + 1:low + 2] == "/"):
                if low > at:
                    yield "text", html[at:low], ""
                return                              # the page ends inside a tag
            yield "text", html[at:low + 1], ""
            at = low + 1
            continue
        if low > at:
            yield "text", html[at:low], ""
        kind = m.groupdict()
        if kind.get("note"):
            at = html.find("-->", low + 2)          # <!--> is a whole comment
            at = size if at < 0 else at + 3
        elif kind.get("mark"):
            at = html.find(">", low) + 1 or size
        else:
            tag, at = kind["tag"].lower(), m.end()
            yield "end" if kind["end"] else "open", tag, kind["attrs"]
            if tag in RAW and not kind["end"]:
                close = re.compile(rf"(?i)</{tag}(?=[\s/>]|\Z)").search(html, at)
                at = close.start() if close else size
    if at < size:
        yield "text", html[at:], ""


class _Node:
    """An element of the page; ``box`` is the container it belongs to."""
    __slots__ = ("tag", "name", "key", "parent", "box", "depth", "never", "doubt", "header", "good", "holds_title", "worth", "order", "last", "barred", "headed")

    def __init__(self, tag: str, name: str, parent: "_Node | None"):
        self.tag, self.name, self.parent, self.box = tag, name, parent, self
        self.depth = parent.depth + 1 if parent else 0
        self.key = ""
        self.never = self.doubt = self.header = self.good = self.holds_title = False
        self.worth, self.order, self.last = 0.0, 0, 0
        self.barred = self.headed = -1              # depths of the nearest elements that are no text, or a page header


def _attributes(rest: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(rest):
        out.setdefault(name.lower(), a or b or c)
    return out


def _named(text: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(text)}


def _node(tag: str, rest: str, parent: _Node) -> _Node:
    node = _Node(tag, tag, parent)
    node.never, node.header, node.good = tag in NEVER, tag == "header", tag in ("article", "main")
    if rest.strip(" /"):
        known = _attributes(rest)
        cls, ident, role = unescape(known.get("class", "")), unescape(known.get("id", "")), known.get("role", "").lower()
        words = sorted({re.sub(r"\d+", "", c) for c in cls.split()} - {""})
        node.name = tag + "".join("." + c for c in words) + ("#" + re.sub(r"\d+", "", ident) if ident else "")
        names = _named(cls) | _named(ident) | _named(role)
        hidden = "hidden" in known or known.get("aria-hidden", "").lower() == "true" or re.search(r"(?i)display\s*:\s*none", known.get("style", "")) is not None
        node.never |= hidden or role in ("navigation", "complementary", "contentinfo", "search", "alert", "dialog", "menu", "form")
        node.header |= tag in ("div", "section") and bool(names & HEADER)
        if tag not in ("html", "body", "main"):
            node.doubt = bool(names & (ON_ARTICLES if tag == "article" else NAMES)) and not node.header
        node.good |= role in ("main", "article") or tag in CONTAINERS and bool(names & GOOD)
    return node


class Page:
    """Containers and blocks of a page, both in page order. A block is its
    element, text, characters in links, and whether it is a heading."""

    def __init__(self, html: str):
        self.elements: list[_Node] = []
        self.boxes: list[_Node] = []
        self.blocks: list[tuple[_Node, str, int, bool]] = []
        self._read(html)
        self._judge()

    def _push(self, stack: list[_Node], opened: Counter, tag: str, rest: str) -> _Node:
        around = stack[-1]
        node = _node(tag, rest, around)
        if tag in CONTAINERS and tag not in CELLS and tag != "tr":
            node.order = node.last = len(self.boxes)
            node.key = xxhash.xxh3_128_hexdigest(around.box.key + ">" + node.name)
            self.boxes.append(node)
        else:                                       # blocks, rows and cells belong to the container around them
            node.box = around.box
        if tag in ("h1", "main"):
            up: _Node | None = around
            while up is not None and not up.holds_title:
                up.holds_title = True
                up = up.parent
        self.elements.append(node)
        stack.append(node)
        opened[tag] += 1
        return node

    def _read(self, html: str) -> None:
        root = _Node("", "", None)
        self.elements.append(root)
        self.boxes.append(root)
        stack, opened = [root], Counter()           # open containers and blocks, and how many of each tag
        parts: list[str] = []
        links = skip = 0
        in_link, skip_tag = False, ""

        def flush() -> None:
            nonlocal links, in_link
            text = " ".join(unescape("".join(parts)).split()) if parts else ""
            if text:
                top = stack[-1]
                self.blocks.append((top, text, links, top.tag in HEADINGS or top.parent is not None and top.parent.tag in HEADINGS))
            parts.clear()
            links, in_link = 0, False

        def close_to(k: int) -> None:
            for node in stack[k:]:
                opened[node.tag] -= 1
                node.box.last = len(self.boxes) - 1 if node.box is node else node.box.last
            del stack[k:]

        for kind, tag, rest in tokens(html):
            if skip:                                # inside svg, head and the like: only its own tags count
                if skip_tag == "head" and kind == "open" and tag not in IN_HEAD:
                    skip = 0                        # what can't stand in a head ends it
                else:
                    if kind != "text" and tag == skip_tag:
                        skip += 1 if kind == "open" and not rest.endswith("/") else -1
                    continue
            if kind == "text":
                parts.append(tag)
                if in_link:
                    links += len(" ".join(tag.split()))
            elif tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = kind == "open"
            elif kind == "open" and tag in SKIPPED:
                if not rest.endswith("/"):
                    skip, skip_tag = 1, tag
            elif tag not in CONTAINERS and tag not in BLOCKS:
                continue
            elif kind == "open":
                if tag in ("html", "body") and (opened[tag] or tag == "html" and len(stack) > 1):
                    continue
                if tag not in CELLS:
                    flush()
                if stack[-1].tag == "p" or stack[-1].tag in HEADINGS and tag not in ("p", "pre", "li"):
                    close_to(len(stack) - 1)        # a block ends an open paragraph
                while stack[-1].tag in IMPLIED.get(tag, ()):
                    close_to(len(stack) - 1)
                if tag == "hr":
                    continue
                if tag in CELLS:                    # a row is a block, its cells are parted by a space
                    parts.append(" ")
                    cell = self._push(stack, opened, tag, rest)
                    if cell.never or cell.doubt:
                        stack.pop()
                        flush()
                        stack.append(cell)
                else:
                    self._push(stack, opened, tag, rest)
            elif opened[tag]:
                if tag not in CELLS:
                    flush()
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                if stack[k].never or stack[k].doubt:
                    flush()
                close_to(k)
        flush()
        close_to(0)

    def _judge(self) -> None:
        """What bars each element, and the worth of every container."""
        for node in self.elements:
            up = node.parent
            node.barred = node.depth if node.never or node.doubt and not node.holds_title else up.barred if up else -1
            node.headed = node.depth if node.header else up.headed if up else -1
        for node, text, links, _ in self.blocks:
            if node.barred < 0 and node.headed < 0:
                node.box.worth += max(0, len(text) - LINK * links)
        for box in reversed(self.boxes):            # inner ones stand behind their outer ones
            if box.parent is not None:
                box.parent.box.worth += box.worth / 2
        for box in self.boxes:
            if box.good:
                box.worth *= 2

    def best(self) -> _Node | None:
        """The container of the highest worth, the outer one of equals."""
        best = max(self.boxes, key=lambda n: n.worth)
        return best if best.worth > 0 else None

    def text_under(self, tops: list[_Node]) -> str:
        """The text of containers of one depth, seen from inside them: what bars them as a whole doesn't count."""
        begin, lines = [t.order for t in tops], []
        for node, text, _, heading in self.blocks:
            k = bisect_right(begin, node.box.order) - 1
            if k < 0 or node.box.order > tops[k].last:
                continue
            # a heading in a page header counts inside an article only
            heading = heading and tops[k].tag not in ("", "html", "body")
            if node.barred <= tops[k].depth and (heading or node.headed <= tops[k].depth):
                lines.append(text)
        return "\n".join(lines)


def path_of(node: _Node) -> str:
    names = []
    up: _Node | None = node
    while up is not None and up.name:
        names.append(up.name)
        up = up.parent.box if up.parent else None
    return ">".join(reversed(names))


def extract(html: str | None, winners: list[str] | None) -> str:
    """The text of one page, by the keys of the winning paths of its host."""
    page = Page(html or "")
    for key in winners or []:
        found = [n for n in page.boxes if n.key == key and n.barred < 0]
        most = max((n.worth for n in found), default=0.0)
        text = page.text_under([n for n in found if n.worth >= most / 5]) if most > 0 else ""
        if text:
            return text
    best = page.best()
    return page.text_under([best]) if best else ""


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def page_votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, key and path of its best container, worth: the vote of every page that has a host and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = []
            for host, html in zip(batch.column(0), batch.column(1)):
                best = Page(html.as_py() or "").best()
                if best is not None and best.key:
                    votes.append((host.as_py(), best.key, path_of(best), int(best.worth)))
            columns = [pa.array([v[k] for v in votes], t) for k, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "key", "path", "worth"])
    return (pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")).filter("host is not null")
            .mapInArrow(run, "host string, key string, path string, worth long"))


def winning_paths(votes: DataFrame) -> DataFrame:
    """host, winners (array of key, path and votes, best first; at most WINNERS)."""
    counted = written(votes.groupBy("host", "key").agg(F.count("*").alias("n"), F.sum("worth").alias("worth"), F.min("path").alias("path")), "host-votes")
    total = counted.groupBy("host").agg(F.sum("n").alias("total"))
    won = counted.join(total, "host").filter(F.col("n") * WINNERS >= F.col("total"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), (-F.col("worth")).alias("worth"), "path", "key")))
    return won.groupBy("host").agg(F.transform(order, lambda w: F.struct(w["key"].alias("key"), w["path"].alias("path"), (-w["n"]).alias("votes"))).alias("winners"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    winners = written(winning_paths(page_votes(pages, url_col, html_col)), "host-winners")
    host = host_of(F.col(url_col))
    # a key that matches nothing, for pages without a host
    spread = F.concat(F.lit("\u0000"), F.xxhash64(F.col(id_col), F.col(url_col)).cast("string"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"),
                        F.coalesce(host, spread).alias("__host"))
    joined = rows.join(winners.select(F.col("host").alias("__host"), F.col("winners.key").alias("winners")).hint("shuffle_hash"), "__host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [extract(h.as_py(), w.as_py()) for h, w in zip(part.column(2), part.column(3))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])
    return joined.select("page_id", "url", "html", "winners").mapInArrow(run, "page_id long, url string, text string, n_chars long")


@register("op11_html_text")
def op11_html_text(spark, sf_dir):
    return extract_text(read_table(spark, sf_dir, "pages"))
