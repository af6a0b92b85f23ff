"""Main text of pages: known layouts, the test pages, and broken markup."""

import random
import re
from html import unescape

import numpy as np
import pytest

from millrace.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{}</style></head><body>
<div class="cookie-notice"><p>We use small files here. Agree?</p><button>OK</button></div>
<header class="site-header"><a href="/">Home of words</a></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="ad">Buy a thing now, it is good.</div>
<article><h1>A title &amp; more</h1><p>First   paragraph, with <b>bold</b> and a <a href="/x">link</a>. It goes on for some words, and then it ends here.</p>
<p>Second paragraph<br>with a break &mdash; and it has enough words to count as text, too.<div class="advert">Buy another thing.</div>
<ul><li>An item of the list</li><li>Another item of it</li></ul></article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/c">Other page</a></li></ul></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I read this and it was good, thank you for it.</p></div></section>
<form><label>Search</label><input name=q></form>
<footer>&copy; 2024 Someone &middot; All rights.</footer></body></html>"""

TEXT = (
    "A title & more\nFirst paragraph, with bold and a link. It goes on for some words, and then it ends here.\n"
    "Second paragraph with a break — and it has enough words to count as text, too.\nAn item of the list\nAnother item of it"
)


@pytest.fixture(scope="module")
def model(spark, sf):
    return html.train(spark.read.parquet(f"{sf}/pages.parquet"))


def test_a_page_with_everything(model):
    assert html.extract([PAGE], model) == [TEXT]


def article(page):
    """The blocks inside <article>, by plain patterns."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)\b[^>]*>", re.sub(r"<!--.*?-->", "", inner, flags=re.S))
    blocks = [" ".join(unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_the_test_pages(spark, model, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = html.main_text(pages, model).select("row.html", "text").collect()
    assert len(got) == pages.count()
    assert all(r["text"] == article(r["html"]) for r in got)


def test_fresh_layouts(model):
    """Held-out accuracy on layouts the trees have not seen."""
    made = html.Layouts(["Some words stand here, and more of them follow.", "Another line of text ends there.", "It was so, and they said it."], 99)
    pages = [made.page() for _ in range(200)]
    right = wrong = missed = 0
    for page, got in zip(pages, html.extract(pages, model)):
        want = [t for t in html.parse(page).text if t.startswith(html.MARK)]
        found = got.split("\n") if got else []
        hit = sum(t.startswith(html.MARK) for t in found)
        right, wrong, missed = right + hit, wrong + len(found) - hit, missed + len(want) - hit
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def test_no_block_is_taken_below_a_cut_one(model):
    page = html.parse(PAGE)
    rng = np.random.default_rng(0)
    for _ in range(50):
        gain = rng.normal(size=len(page.kind))
        text = html.decode(page, gain)
        best = brute_choice(page, gain)
        taken = [i for i in best if page.text[i]]
        assert text == "\n".join(page.text[i] for i in taken)


def brute_choice(page, gain):
    children = {}
    for i, p in enumerate(page.parent):
        children.setdefault(p, []).append(i)

    def best(i):
        parts = [best(c) for c in children.get(i, [])]
        parts = [x for x in parts if x[0] > 0]
        return gain[i] + sum(x[0] for x in parts), [i, *(n for x in parts for n in x[1])]

    return sorted(best(0)[1])


@pytest.mark.parametrize(
    "page",
    ["", "<", "<p", "no tags at all, only words", "<a><a><b></i></a>x", "<script>x", "<!-- open", "</p></div></html>", "<p>" * 3000 + "deep", "<div>" * 3000 + "deep",
     "<table><tr><td>a<td>b<tr><td>c</table>", "<li>x<li>y", "&#0;&#xD800;&bogus;&amp", "<div class=>x</div>", "\x00<\x00>", "<p hidden>no</p><p>yes"],
)
def test_broken_markup(model, page):
    assert len(html.extract([page, PAGE], model)) == 2


@pytest.mark.parametrize(
    "attributes, hidden",
    [("hidden", True), ('hidden=""', True), ("class=a hidden", True), ('HIDDEN="hidden" id=x', True), ('aria-hidden="true"', True), ("aria-hidden=TRUE", True),
     ('style="display:none"', True), ("style='color:red; DISPLAY : none !important;display:block'", True), ('style="display:none;display:block"', False),
     ('style="overflow:hidden"', False), ('class="overflow-hidden"', False), ('class="hidden-xs hidden"', False), ('aria-hidden="false"', False), ('data-hidden="0"', False),
     ('data-hidden="true"', False), ('title="The hidden valley"', False), ('title="display:none"', False), ('hidden="until-found"', False), ("hidden=until-found", False), ('style="--display:none"', False)],
)
def test_hidden_by_the_attribute_of_that_name(model, attributes, hidden):
    assert html.hides(" " + attributes) == hidden
    got = html.parse(f"<main>before it <div {attributes}><p>inside it</p></div>behind it</main>").text
    assert [t for t in got if t] == (["before it behind it"] if hidden else ["before it", "inside it", "behind it"])
    page = PAGE.replace("<article>", f"<article {attributes}>")
    assert (TEXT.split("\n")[1] in html.extract([page], model)[0]) != hidden


@pytest.mark.parametrize(
    "page, texts",
    [("<p hidden>x<p>y<p>z", "y z"), ("<p hidden>x<div>y</div>", "y"), ("<ul><li>w<li hidden>x<ul><li>no</ul><li>y</ul>z", "w y z"), ("<div><p hidden>x</div>y", "y"),
     ("<table><tr><td hidden>x<td>y<tr hidden><td>no<td>no<tr><td>z</table>", "y z"), ("<dl><dt hidden>x<dd>y<dt>z</dl>", "y z"), ("<dl><dt>w<dd hidden>x<dd>y</dl>", "w y"),
     ("<div><option hidden>x<option>no</div><p>y", "y"), ("<div hidden><div>x</div>no</div>y", "y"), ("<span hidden>x<b>no</b></span>y", "y"), ("<p>w <span hidden>x<p>y", "w y"),
     ("<table><tbody hidden><tr><td><table><tbody><tr><td>no</table>no<tbody><tr><td>y</table>", "y"), ("<div hidden><hr>x<script>no</script></p>no<br></div>y", "y")],
)
def test_hidden_elements_end_where_others_do(page, texts):
    assert [t for t in html.parse(page).text if t] == texts.split()


def test_rows(spark, model):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "", ""), (3, "w", "<article><p>" + "long words go on, " * 60_000 + "</p></article>", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    got = {(r["page_id"], len(r["text"])) for r in html.main_text(pages, model).select("row.page_id", "text").collect()}
    assert got == {(1, len(TEXT)), (None, 0), (2, 0), (3, 60_000 * 18 - 1)}
    empty = spark.createDataFrame([], pages.schema)
    assert html.main_text(empty, html.train(empty, layouts=30, trees=3)).count() == 0


def test_tag_ends_as_one_pattern_finds_them():
    """With quotes open, crossed and never closed, from every place."""
    import re

    whole = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")
    draw = random.Random(8)
    for _ in range(3000):
        text = "".join(draw.choices("ab>\"' ", k=draw.randint(0, 14)))
        ends = html.TagEnds(text)
        for at in (*range(len(text) + 1), 0):
            m = whole.match(text, at)
            assert ends.find(at) == (m and m.end())


@pytest.mark.parametrize(
    "page", [lambda n: '<a "' * n, lambda n: "<div>x" * n, lambda n: "<div><li>" * n, lambda n: "<b>" * n + "<p>x</p>" * n,
             lambda n: "<script>" + "</script " * n, lambda n: "<p hidden>" * n, lambda n: "<!" * n, lambda n: "&amp;" * n],
)
def test_odd_pages_take_time_in_proportion(page):
    import time

    def seconds(n):
        start = time.process_time()
        html.features([html.parse(page(n))])
        return time.process_time() - start

    seconds(100)
    assert seconds(160_000) < 16 * min(seconds(20_000) for _ in range(2)) + 1  # eight times the page


def test_deep_nodes_know_their_ancestors():
    page = html.parse("<nav class=menu>" + "<div>" * 1000 + "deep" + "</div>" * 1000 + "</nav><p>flat</p>")
    inside = html.features([page, html.parse("<p>other</p>")])[0]
    deep, flat = (page.text.index(t) for t in ("deep", "flat"))
    assert not (inside[deep] == inside[flat]).all()
    assert html.parse("<p>x" * 3).kind == ["html", "p", "#text", "p", "#text", "p", "#text"]


def test_pages_without_any_node():
    assert html.features([html.parse(""), html.parse("<!-- x -->")])[0].shape[0] == 2


def test_decode_against_all_consistent_choices():
    draw = random.Random(12)
    for _ in range(60):
        n = draw.randint(1, 11)
        page = html.Page()
        for i in range(n):
            page.add("#text", draw.randrange(i) if i else -1, 0, f"t{i}")
        gain = np.array([draw.choice([-3, -2, -1, 1, 2, 4]) + i / 64 for i in range(n)])
        best = None
        for chosen in range(1 << n):
            taken = [i for i in range(n) if chosen >> i & 1]
            if 0 in taken and all(i == 0 or page.parent[i] in taken for i in taken):
                total = sum(gain[i] for i in taken)
                if best is None or total > best[0]:
                    best = total, taken
        assert html.decode(page, gain) == "\n".join(f"t{i}" for i in best[1])
