"""Main text of web pages by composite text density (Sun, Song and Liao, 2011).

A page becomes a tree of nodes. Of each node, characters and tags are counted, all and those in links, and give its
link-adjusted characters per tag. A node's density sum is the sum of its children's densities. The node of
the greatest sum lies in the article; the least density on its path to the body is the threshold. From the body
down, nodes at or above the threshold pass, and in each the subtree of the greatest sum is content. Content
that lies in an ``article`` or ``main`` element extends to the whole of it, and headings beside the path to it belong to it, so that
titles and short paragraphs stay.

Before counting, what is never part of the article is left out: scripts, styles, menus, page headers and footers,
asides, hidden elements. Forms and elements whose class, id or role names a sidebar, an advert, a notice, comments and
the like only become candidates, as such names also stand on wrappers of whole pages. A candidate stays if it

* is around the ``article`` or ``main`` element with the most text of its own, or
* holds (inside that element, if there is one) a greater density sum than all that is no candidate. Comments, adverts and
  consent notices, which can be longer than the article, must be all the text there is.
* is inside that element, has a name that is no part's of its own (``share-price``, ``related-work``), and half of its text at
  least is in no link.

The other candidates go, also those inside one that stays.

Character references are decoded; white space inside a block becomes one space; blocks are joined by one space in
page order. A null or empty page, or one without text, gives an empty text. Pages are parsed one at a time and only as
tags and text, so malformed markup cannot fail. Columns besides id, url and html are ignored; rows that repeat are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.words import slices

RAW = r"script|style|textarea|title|noscript|template|iframe|noframes|svg|math"
#: Up to the end of a tag; a new tag's "<" ends it too, so that no broken tag makes the search go on to the end of the page.
REST = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
TOKEN = re.compile(
    r"<!--(?:-?>|(?P<comment>.*?)(?:--!?>|\Z))"
    rf"|<(?P<empty>svg|math)(?=[\s/>]){REST}(?<=/)>"
    rf"|<(?P<raw>{RAW})(?P<rawattrs>(?=[\s/>]){REST})>(?P<inside>.*?)(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attrs>{REST})>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/<>]*)(?P<attrs2>[^<>]*)>"
    r"|<[!?/][^<>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

#: Fixed values of HTML: elements without content, blocks, and what an opening tag closes.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CLOSE_P = BLOCK - {"br", "body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "legend"}
P_SCOPE = {"td", "th", "table", "button", "body", "html"}

#: Elements that are never article text.
NEVER = set("head nav footer aside script style noscript template iframe noframes button select input svg math dialog menu object canvas".split())
#: Words in class, id or role of elements that may be no article text.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adbox|banner|sponsor(?:ed)?|promo(?:tion)?s?|side-?bar|cookies?|consent|gdpr|notice|notification"
    r"|comments?|commentlist|disqus|replies|menu|nav|navbar|navigation|breadcrumbs?|footer|site-?header|page-?header|masthead|share|sharing|social"
    r"|newsletter|subscribe|subscription|signup|login|related|recommend(?:ed|ations)?|popup|modal|overlay|widget|toolbar|pagination|pager|skip-?link|complementary|contentinfo|search)"
    r"(?:$|[\s_-])",
    re.I,
)
#: Whole names of elements that are no wrappers, however much text they hold.
APART = re.compile(
    r"(?:^|\s)(?:ads?|adverts?|advertisements?|adbox|sponsor(?:ed)?|cookies?|consent|gdpr|comments?|comment-?list|disqus|replies|newsletter)"
    r"(?:[_-](?:area|banner|bar|box|consent|form|list|message|notice|popup|section|thread))*(?:$|\s)",
    re.I,
)
#: Whole names of parts that are no article text either where they stand inside the article; of others its links decide.
PARTS = re.compile(
    r"(?:^|\s)(?:side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|site-?header|page-?header|masthead|popup|modal|overlay|widget"
    r"|toolbar|pagination|pager|skip-?link|complementary|contentinfo)(?:$|\s)",
    re.I,
)
#: Elements that may stand in the head, which anything else ends.
IN_HEAD = set("base basefont bgsound link meta noscript script style template title".split())
BARRIER = ("td", "th", "article", "main", "section", "div", "table")
STAYS, NAMED, CANDIDATE, LAST, GOES = range(5)


def _verdict(tag: str, attrs: str, inside_article: bool) -> int:
    if tag in NEVER or tag == "header" and not inside_article:
        return GOES
    found = CANDIDATE if tag == "form" else STAYS
    if not attrs or tag in ("body", "html", "article", "main") and "comment" not in attrs.lower():
        return found
    for name, value in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return GOES
        if name in ("class", "id", "role") and BOILERPLATE.search(value):
            found = max(found, LAST if APART.search(value) else CANDIDATE if PARTS.search(value) else NAMED)
        if name == "role" and value.lower() in ("banner", "navigation", "search", "form", "alert", "dialog"):
            found = max(found, CANDIDATE)
    return found


class Open:
    """The open elements, with the places of each tag, so that finding one takes no walk."""

    def __init__(self):
        self.nodes, self.tags = [0], ["body"]
        self.at: dict[str, list[int]] = {}

    def __len__(self) -> int:
        return len(self.nodes)

    def push(self, node: int, tag: str) -> None:
        self.at.setdefault(tag, []).append(len(self.nodes))
        self.nodes.append(node)
        self.tags.append(tag)

    def cut(self, depth: int) -> None:
        while len(self.nodes) > depth:
            self.nodes.pop()
            self.at[self.tags.pop()].pop()

    def last(self, tags: Iterable[str]) -> int:
        """The depth of the innermost open element with one of these tags, or 0."""
        return max((own[-1] for tag in tags if (own := self.at.get(tag))), default=0)

    def close(self, tag: str) -> None:
        """A stray closing tag of an inline element closes no block around it."""
        k = self.last((tag,))
        if k and (tag in BLOCK or k > self.last(BARRIER)):
            self.cut(k)

    def imply(self, tags: set[str], stop: set[str]) -> None:
        """Close the innermost of ``tags``, unless one of ``stop`` is nearer."""
        k = self.last(tags)
        if k and k > self.last(stop):
            self.cut(k)


class Page:
    """Nodes in page order: parent, tag, own texts; texts also know the block they are in."""

    def __init__(self, html: str):
        self.tag, self.parent = ["body"], [-1]
        self.marks: dict[int, int] = {}  # candidates that are still open: NAMED, CANDIDATE or LAST
        self.texts: list[tuple[int, int, str]] = []  # node, block, text
        self.block = 0
        stack, skip, at = Open(), None, 0  # skip: depth of the stack at which an element left out began
        for token in TOKEN.finditer(html):
            if token.start() > at:
                skip = self._head_ends(stack, skip, html[at : token.start()])
                if skip is None:
                    self._text(stack.nodes[-1], html[at : token.start()])
            at = token.end()
            tag, close, attrs = token["tag"] or token["tag2"], token["close"] or token["close2"], token["attrs"] or token["attrs2"]
            if not tag:
                continue
            tag = tag.lower()
            if not close and tag not in IN_HEAD:
                skip = self._head_ends(stack, skip, tag)
            if tag in BLOCK:
                self.block += 1
            if close:
                stack.close(tag)
            elif tag in ("html", "body"):
                continue
            elif tag in VOID:
                if skip is None:
                    self._node(tag, stack.nodes[-1])
                continue
            else:
                if tag in CLOSE_P:
                    stack.imply({"p"}, P_SCOPE)
                if tag in CLOSES:
                    stack.imply(*CLOSES[tag])
                if skip is not None and len(stack) < skip:
                    skip = None
                in_article = bool(stack.last(("article", "main")))
                stack.push(self._node(tag, stack.nodes[-1]), tag)
                verdict = STAYS if skip is not None else _verdict(tag, attrs, in_article)
                if verdict == GOES:
                    skip = len(stack)
                elif verdict:
                    self.marks[stack.nodes[-1]] = verdict
            if skip is not None and len(stack) < skip:
                skip = None
        if at < len(html) and self._head_ends(stack, skip, html[at:]) is None:
            self._text(stack.nodes[-1], html[at:])
        self.gone = self._within(NAMED) if self.marks else [False] * len(self.tag)
        if self.marks:
            self._spare()

    @staticmethod
    def _head_ends(stack: Open, skip: int | None, what: str) -> int | None:
        """Text, or an element that no head can hold, ends a head whose closing tag is missing; what is still left out then."""
        if stack.tags[-1] != "head" or not what.strip():
            return skip
        stack.cut(len(stack) - 1)
        return None if skip is not None and len(stack) < skip else skip

    def _within(self, least: int) -> list[bool]:
        """Nodes in candidates of at least this kind."""
        gone = [False] * len(self.tag)
        for k in range(1, len(gone)):
            gone[k] = gone[self.parent[k]] or self.marks.get(k, STAYS) >= least
        return gone

    def _keep(self, k: int) -> None:
        """No candidate around a node goes."""
        while k > 0:
            self.marks.pop(k, None)
            k = self.parent[k]

    def _article(self) -> int:
        """The article or main element with the most text that is in no deeper one and no candidate; 0 if there is none."""
        n = len(self.tag)
        home, linked = [0] * n, [False] * n
        own, total = [0] * n, [0] * n
        is_article = [self.tag[k] in ("article", "main") and self.marks.get(k) != LAST for k in range(n)]
        for k in range(1, n):
            home[k] = k if is_article[k] else -1 if k in self.marks else home[self.parent[k]]
            linked[k] = linked[self.parent[k]] or self.tag[k] == "a"
        for node, _, text in self.texts:
            size = sum(map(len, text.split())) * (not linked[node])
            total[node] += size
            if home[node] > 0:
                own[home[node]] += size
        for k in range(n - 1, 0, -1):
            total[self.parent[k]] += total[k]
        return max((k for k in range(1, n) if is_article[k] and total[k]), key=lambda k: (own[k], total[k], -k), default=0)

    def _spare(self) -> None:
        """Take the marks from candidates that are wrappers of the article."""
        root = self._article()
        self._keep(root)
        inside = [root == 0] * len(self.tag)
        for k in range(max(root, 1), len(inside)):
            inside[k] = inside[k] or k == root or inside[self.parent[k]]
        if root:
            chars, _, link_chars, _ = self._counts([False] * len(self.tag))
            for k in [k for k, kind in self.marks.items() if kind == NAMED and inside[k]]:
                if 2 * link_chars[k] < chars[k]:  # a name alone takes nothing out of the article
                    del self.marks[k]
        while True:
            self.gone = self._within(NAMED)
            if not any(inside[k] for k in self.marks):
                return

            def best(hidden: list[bool], among: list[bool]) -> tuple[float, int]:
                density, total = self.densities(hidden)
                return max(((max(total[k], density[k]), k) for k in range(len(among)) if among[k] and inside[k]), default=(0.0, 0))

            free, _ = best(self.gone, [not g for g in self.gone])
            last = self._within(LAST)
            value, k = best(last, [g and not x for g, x in zip(self.gone, last)])
            if not free and not value:
                value, k = best([False] * len(self.gone), self.gone)
            if value <= free:
                return
            self._keep(k)

    def _node(self, tag: str, parent: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        return len(self.tag) - 1

    def _text(self, node: int, text: str) -> None:
        self.texts.append((node, self.block, unescape(text)))

    def densities(self, gone: list[bool]) -> tuple[list[float], list[float]]:
        """Composite text density of each node, and the sum over its children, without the text of nodes that are gone."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = self._counts(gone)
        ratio = link_chars[0] / max(chars[0], 1)
        density, total = [0.0] * n, [0.0] * n
        for k in range(n - 1, -1, -1):
            if chars[k]:
                base = math.log(chars[k] / max(chars[k] - link_chars[k], 1) * link_chars[k] + ratio * chars[k] + math.e)
                value = chars[k] / max(link_chars[k], 1) * max(tags[k], 1) / max(link_tags[k], 1)
                density[k] = chars[k] / max(tags[k], 1) * max(math.log(value), 0) / base
            if k:
                total[self.parent[k]] += density[k]
        return density, total

    def _counts(self, gone: list[bool]) -> tuple[list[int], list[int], list[int], list[int]]:
        """Characters and tags of each subtree, all and those in links."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for k in range(1, n):
            in_link[k] = in_link[self.parent[k]] or self.tag[k] == "a"
        for node, _, text in self.texts:
            size = 0 if gone[node] else sum(map(len, text.split()))
            chars[node] += size
            link_chars[node] += size * in_link[node]
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            chars[up] += chars[k]
            link_chars[up] += link_chars[k]
            counts = not (gone[k] and self.tag[k] in VOID)
            tags[up] += tags[k] + counts
            link_tags[up] += link_tags[k] + (in_link[k] and counts)
        return chars, tags, link_chars, link_tags

    def main_text(self) -> str:
        self.texts = [t for t in self.texts if not self.gone[t[0]]]
        if not any(text.strip() for _, _, text in self.texts):
            return ""
        density, total = self.densities(self.gone)
        n = len(self.tag)
        end = list(range(1, n + 1))  # nodes are in page order: a subtree is a range
        for k in range(n - 1, 0, -1):
            end[self.parent[k]] = max(end[self.parent[k]], end[k])
        top = list(range(n))  # the node of the greatest sum in each subtree, the first of equal ones
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            if (total[top[k]], -top[k]) > (total[top[up]], -top[up]):
                top[up] = top[k]
        best = top[0]
        path, k = [], best
        while k >= 0:
            path.append(density[k])
            k = self.parent[k]
        least = min(path)
        content = [False] * n

        outermost = [0] * n  # the outermost article or main element around each node
        for k in range(1, n):
            outermost[k] = outermost[self.parent[k]] or (k if self.tag[k] in ("article", "main") else 0)

        def mark(root: int) -> None:
            root = outermost[root] or root
            if not content[root]:
                content[root : end[root]] = [True] * (end[root] - root)

        mark(best)
        around, k = set(), best
        while k >= 0:
            around.add(k)
            k = self.parent[k]
        for k in range(1, n):  # headings beside the path to the article
            if self.tag[k] in HEADINGS and self.parent[k] in around:
                content[k : end[k]] = [True] * (end[k] - k)
        k = 1
        while k < n:
            if content[k] or density[k] < least or not density[k]:
                k = end[k] if not content[k] else k + 1
                continue
            mark(top[k] if total[top[k]] > 0 else k)
            k += 1
        blocks: dict[int, list[str]] = {}
        for node, block, text in self.texts:
            if content[node]:
                blocks.setdefault(block, []).append(text)
        return " ".join(x for x in (" ".join("".join(parts).split()) for parts in blocks.values()) if x)


def extract(html: str) -> str:
    return Page(html).main_text() if html else ""


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "_html"):
        texts = [extract(h or "") for h in part.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            ["_id", "url", "text", "n_chars"],
        )


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each page."""
    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("_html"))
    kind = pages.schema[id_col].dataType.simpleString()
    return source.mapInArrow(_run, f"_id {kind}, url string, text string, n_chars long").withColumnRenamed("_id", id_col)
