import html
import math
import random
import re
import time

import pytest

from logtide.llm.textdensity import extract, main_texts

LONG = "This is a paragraph of the article that goes on for quite a while, as paragraphs do."


def between_tags(page):
    """Text of the article element of the generated pages, block by block."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|br|h1)>", article)
    parts = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks)
    return " ".join(p for p in parts if p)


def test_all_generated_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in main_texts(spark.createDataFrame(rows)).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == between_tags(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


@pytest.mark.parametrize("around", [
    '<div class="sidebar"><p>{x}</p></div>', "<aside><p>{x}</p></aside>", '<section id="comments"><p>{x}</p><p>{x}</p></section>',
    '<div class="cookie-notice"><p>{x}</p></div>', "<form><p>{x}</p><input></form>", "<script>var a = '{x}</p>';</script>", "<header><h2>{x}</h2></header>",
    "<style>p {{ }} {x}</style>", '<div role="navigation">{x}</div>', "<!-- {x} -->", '<div class="ad">{x}</div>', "<footer>{x}</footer>", "<nav><ul><li><a href='#'>{x}</a></ul></nav>",
])
def test_what_is_not_the_article_goes(around):
    other = around.format(x="Something else entirely that is long enough to matter here")
    for wrap in ("article", "div"):
        page = f"<html><body>{other}<{wrap}><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></{wrap}>{other}</body></html>"
        assert extract(page) == f"Title {LONG} Short. {LONG}", page


WRAPPERS = [
    "<div class='site has-sidebar'>{x}</div>", "<div class='content with-sidebar'>{x}</div>", "<div id=search-results>{x}</div>", "<div class='comments-open'>{x}</div>",
    "<form action='/'>{x}</form>", "<div role=search>{x}</div>", "<div class='widget Blog'>{x}</div>", "<form><div class='has-sidebar'><div class='search-results'>{x}</div></div></form>",
    "<form><div class='has-sidebar'>{x}</div><div>More</div></form>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["article", "main", "div", "section"])
def test_wrappers_of_the_article_stay(wrapper, inner):
    side = "<div class='sidebar'><p>Something else that stands beside it</p></div>"
    article = f"<{inner}><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></{inner}>"
    for page in (wrapper.format(x=article), wrapper.format(x=side + article + side), f"<nav>Menu</nav><div>Above</div>{side}{wrapper.format(x=article)}"):
        got = extract(f"<html><body>{page}</body></html>")
        assert f"Title {LONG} Short. {LONG}" in got and "Something else" not in got and "Menu" not in got, page


def test_wrappers_of_text_alone_stay():
    for wrapper in WRAPPERS:
        page = wrapper.format(x=f"<p>{LONG}</p>")
        assert LONG in extract(f"<body>{page}<div>Footer</div></body>") and LONG in extract(f"<main>{page}</main>"), page
    assert extract(f"<article class='post comments-open'><p>{LONG}</p></article>") == LONG
    assert extract(f"<div id=comments><article><p>{LONG}</p></article></div>") == LONG


@pytest.mark.parametrize("around", [
    '<div id="comments" class="comments-area">{x}</div>', '<ol class="comment-list">{x}</ol>', '<div class="cookie-notice">{x}</div>', '<div class="ad">{x}</div>',
])
def test_long_comments_and_notices_go(around):
    other = around.format(x="<p>Something else entirely that is long enough to matter here, and goes on and on.</p>" * 30)
    for wrap in ("article", "div", "form"):
        assert extract(f"<body><{wrap}><p>{LONG}</p><p>{LONG}</p></{wrap}>{other}</body>") == f"{LONG} {LONG}"
        assert extract(f"<body><div class='has-sidebar'><{wrap}><p>{LONG}</p><p>{LONG}</p></{wrap}>{other}</div></body>") == f"{LONG} {LONG}"
    assert extract(f"<article><p>{LONG}</p></article><div class='related'><article><p>Teaser</p></article></div>") == LONG


def test_references_and_white_space():
    assert extract(f"<article><p>a &amp; b &lt;c&gt; &#233;\n\t x<b>y</b>z<br>w&nbsp;v</p>{LONG}</article>") == f"a & b <c> é xyz w v {LONG}"


def test_malformed_and_empty():
    assert extract("") == "" and extract("<p>") == "" and extract("<br><img>") == ""
    assert extract("just text") == "just text"
    assert extract("a < b and c > d") == "a < b and c > d"
    assert extract(f'<article><p class="x>{LONG}</p><p>{LONG}') .endswith(LONG)
    assert extract("<div>" * 3000 + LONG) == LONG
    assert extract("<script>never closed") == ""


def test_rows(spark):
    rows = [(1, "u", None, 9), (1, "u", None, 9), (2, None, "", 9), (None, "u", f"<p>{LONG}</p>" * 5000, 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = {r.page_id: r for r in main_texts(df).collect()}
    assert got[1].text == got[2].text == "" and got[None].n_chars == 5000 * (len(LONG) + 1) - 1
    assert main_texts(df).count() == 4 and main_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<html><head><title>t</title><meta name=a><body>{a}</body></html>",  # no </head>
    "<head><meta name=a><p>{p}</p><p>{p}</p>", "<html><head><link rel=x><div>{a}</div>", "<head><meta name=x>{p} {p}",
    "<div aria-hidden='false'>{a}</div>", "<div data-hidden='0'>{a}</div>", "<div title='the hidden gem'>{a}</div>",
    "<div data-style='display:none'>{a}</div>", "<div data-class='comments'>{a}</div>", "<div data-role=navigation>{a}</div>",
    "<svg class='i'/>{a}", "<p>{p}<math/></p><p>{p}</p>", "<!-->{a}", "<!--->{a}", "<!-- x --!>{a}",
    "<article><p class='social'>{p}</p><p>{p}</p></article>", "<article><p>{p}</p><p class='share-price'>{p}</p></article>",
    "<main><p>{p}</p><section class='related-work'><p>{p}</p></section></main>",
])
def test_valid_pages_keep_their_article(page):
    got = extract(page.format(a=f"<p>{LONG}</p><p>{LONG}</p>", p=LONG))
    assert got == f"{LONG} {LONG}", page


def test_parts_inside_the_article_go():
    share = "<div class='share'><a href=x>Tweet this text</a> <a href=y>Send it to a friend</a></div>"
    for part in (share, "<div class='sidebar'><p>Beside</p></div>", "<form><label>Your mail</label></form>", "<div hidden>Not shown</div>", "<p style='display: none'>Not shown</p>"):
        assert extract(f"<article><p>{LONG}</p>{part}<p>{LONG}</p></article>") == f"{LONG} {LONG}", part


@pytest.mark.parametrize("page", [
    "<div>" * 20_000 + LONG, "<p><table>" + "<div>" * 20_000 + LONG, "<a " * 20_000 + LONG, "<a x='" + "<b " * 20_000 + LONG,
    "<li>" * 20_000 + LONG, "<b>" * 20_000 + "</i>" * 20_000 + LONG, "<div class='sidebar'>" * 5_000 + LONG, "<!" * 20_000 + LONG,
], ids=str.__len__)
def test_time_does_not_explode(page):
    begin = time.process_time()
    extract(page)
    assert time.process_time() - begin < 3


class Node:
    """A node of the counterpart: tag, and texts and nodes in order."""

    def __init__(self, tag, parts):
        self.tag, self.parts = tag, parts

    def nodes(self):
        return [p for p in self.parts if isinstance(p, Node)]

    def every(self):
        return [self, *(x for c in self.nodes() for x in c.every())]

    def chars(self, linked=False):
        inside = linked or self.tag == "a"
        own = sum(len("".join(p.split())) for p in self.parts if isinstance(p, str))
        below = [c.chars(inside) for c in self.nodes()]
        return own + sum(c for c, _ in below), own * inside + sum(l for _, l in below)

    def tags(self, linked=False):
        inside = linked or self.tag == "a"
        below = [c.tags(inside) for c in self.nodes()]
        return sum(1 + t for t, _ in below), sum((inside or c.tag == "a") + l for c, (_, l) in zip(self.nodes(), below))

    def density(self, linked, ratio):
        c, lc = self.chars(linked)
        t, lt = self.tags(linked)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
        return c / max(t, 1) * max(math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)), 0) / base

    def html(self):
        inner = "".join(p if isinstance(p, str) else p.html() for p in self.parts)
        return inner if self.tag == "body" else f"<{self.tag}>{inner}</{self.tag}>"


def by_definition(body):
    """The main text of a tree of div, a and b elements, by the plain definitions."""
    c, lc = body.chars()
    ratio = lc / max(c, 1)
    density, total, up = {}, {}, {}

    def visit(node, linked):
        inside = linked or node.tag == "a"
        density[node] = node.density(linked, ratio)
        for child in node.nodes():
            up[child] = node
            visit(child, inside)
        total[node] = sum(density[child] for child in node.nodes())

    visit(body, False)
    order = body.every()
    greatest = lambda among: max(among, key=lambda n: (total[n], -order.index(n)))
    node = best = greatest(order)
    path = [density[node]]
    while node in up:
        node = up[node]
        path.append(density[node])
    content = set(best.every())

    def down(node):
        for child in node.nodes():
            if child in content:
                down(child)
            elif density[child] >= min(path) and density[child]:
                top = greatest(child.every())
                content.update(top.every() if total[top] > 0 else child.every())
                down(child)

    down(body)
    blocks, block = {}, [0]

    def read(node):
        if node.tag == "div":
            block[0] += 1
        for part in node.parts:
            if isinstance(part, Node):
                read(part)
            elif node in content:
                blocks.setdefault(block[0], []).append(part)
        if node.tag == "div":
            block[0] += 1

    read(body)
    return " ".join(x for x in (" ".join("".join(b).split()) for b in blocks.values()) if x)


def random_tree(rng, depth, linked=False):
    parts = []
    for _ in range(rng.randrange(1, 5)):
        if depth and rng.random() < 0.6:
            tag = rng.choice(["div", "div", "div", "b"] + ["a"] * (not linked))
            parts.append(Node(tag, random_tree(rng, depth - 1, linked or tag == "a").parts))
        elif not parts or isinstance(parts[-1], Node):
            parts.append(" ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(0, 30))) + rng.choice(["", " "]))
    return Node("body", parts)


@pytest.mark.parametrize("seed", range(150))
def test_equals_the_plain_definitions(seed):
    tree = random_tree(random.Random(seed), 4)
    assert extract(tree.html()) == by_definition(tree), tree.html()
