"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree."""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of
from millrace.llm.trees import Boosted, fit

CHUNK = 1 << 20  # bytes of html whose nodes are scored together

# Element kinds of the HTML standard; fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math xmp noembed noframes select button datalist object".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: An opening tag that ends the open elements of these kinds, up to the nearest element that bounds them.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"), "body": ("head",),
    "option": ("option",), "rt": ("rt", "rp"), "rp": ("rt", "rp"),
}
BOUNDS = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
    "tbody": ("table",), "tfoot": ("table",), "rt": ("ruby",), "rp": ("ruby",),
}

#: Words of class, id, role and label attributes, by what they hint at.
HINTS = {
    "text": "article content entry post story main body text blog news page-content prose richtext markdown",
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs pager pagination tabs toolbar skip sitemap links topics",
    "head": "header masthead banner top topbar logo brand branding hero site-header",
    "foot": "footer foot copyright legal bottom colophon imprint credits site-footer contentinfo",
    "side": "sidebar side aside widget widgets rail related recommended recommendations trending popular more teaser teasers complementary",
    "sell": "ad ads adv advert advertisement advertising sponsor sponsored promo promoted promotion dfp adsense commercial partner shop",
    "talk": "comment comments commentlist disqus discussion reply replies respond responses thread feedback review reviews guestbook reader",
    "note": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup paywall message toast dialog privacy",
    "form": "form search login register contact field input fieldset",
    "talk2": "share sharing social follow tags byline author meta rating print toolbox",
}
HINT_OF = {w: i for i, words in enumerate(HINTS.values()) for w in words.split()}
KINDS = (
    "article main section div p h1 h2 h3 ul li a span b table td header footer nav aside form blockquote pre figure #text body html".split()
)
KIND_OF = {k: i for i, k in enumerate(KINDS)}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_TAG_END = re.compile(r"(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
_MARKS = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_MAY_HIDE = re.compile(r"hidden|style", re.I)
_NAMED = re.compile(r"([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Page:
    """Nodes in document order: elements and blocks of text (kind #text, with the text)."""

    kind: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)  # one past the last node below
    hints: list[int] = field(default_factory=list)  # a bit per kind of hint
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters of a block that are inside links
    pieces: list[int] = field(default_factory=list)  # inline elements in a block

    def add(self, kind: str, parent: int, hints: int = 0, text: str = "", linked: int = 0, pieces: int = 0) -> int:
        self.kind.append(kind)
        self.parent.append(parent)
        self.end.append(len(self.kind))
        self.hints.append(hints)
        self.text.append(text)
        self.linked.append(linked)
        self.pieces.append(pieces)
        return len(self.kind) - 1


def hints_of(attributes: str) -> int:
    bits = 0
    if "=" in attributes:
        for groups in _ATTRIBUTE.findall(attributes):
            for w in _WORDS.findall("".join(groups)):
                if (i := HINT_OF.get(w.lower())) is not None:
                    bits |= 1 << i
    return bits


def hides(attributes: str) -> bool:
    """Whether an element's attributes hide it: hidden (but not until-found), aria-hidden true, or display none in its style.

    As in browsers, the first attribute of a name counts, and of a style the last display, important ones first.
    """
    if not _MAY_HIDE.search(attributes):
        return False
    values: dict[str, str] = {}
    for name, *value in _NAMED.findall(attributes):
        values.setdefault(name.lower(), unescape("".join(value)).strip().lower())
    if values.get("hidden", "until-found") != "until-found" or values.get("aria-hidden") == "true":
        return True
    shown, important = "", False
    for declaration in _COMMENT.sub(" ", values.get("style", "")).split(";"):
        name, _, value = declaration.partition(":")
        value, mark, _ = value.partition("!")
        if name.strip() == "display" and (mark or not important):
            shown, important = value.strip(), bool(mark)
    return shown == "none"


class TagEnds:
    """Where tags end: at the first > that is in no quotes.

    A page may hold a quote that is never closed, and many tags before it.  The first time no end is found,
    the ends from every mark are worked out once, from the back, so that no stretch is read again and again.
    """

    def __init__(self, html: str):
        self.html, self.marks, self.ends = html, None, []

    def find(self, at: int) -> int | None:
        """One past the > that ends a tag whose attributes start at `at`; None if there is none."""
        if self.marks is None:
            m = _TAG_END.match(self.html, at)
            if m:
                return m.end()
            self.marks = [m.start() for m in _MARKS.finditer(self.html)]
            self.ends = [None] * (len(self.marks) + 1)
            later: dict[str, int] = {}  # the next mark of each kind
            for i in range(len(self.marks) - 1, -1, -1):
                mark = self.html[self.marks[i]]
                if mark == ">":
                    self.ends[i] = self.marks[i] + 1
                elif mark in later:
                    self.ends[i] = self.ends[later[mark] + 1]
                later[mark] = i
        return self.ends[bisect_left(self.marks, at)]


def parse(html: str) -> Page:
    """A page's block elements and its blocks of text.

    Inline elements join their neighbours' block, a line break is white space in it; block elements start
    and end blocks.  Character references are decoded and white space becomes one space.  What is never
    text (scripts, styles, buttons, options, hidden elements, the head) is left out.  Unclosed, misnested and
    unknown elements are taken as browsers take them, roughly; a hidden element ends where it would end
    if it were shown.  The whole page (html, body) is never taken as hidden, as its scripts would show it.
    """
    page = Page()
    page.add("html", -1)
    # Open elements (name, node, whether it hides what is below); inline ones have node -1, blocks in a hidden one -2.
    stack: list[tuple[str, int, bool]] = [("html", 0, False)]
    block: list[str] = []
    state = [0, 0]  # linked characters and inline elements of the block
    nodes = [0]  # the nodes of the stack
    opened: Counter[str] = Counter()  # how often each name is open
    tags = TagEnds(html)
    links = hidden = 0  # how many open elements are links, and how many hide

    def flush() -> None:
        text = " ".join("".join(block).split())
        if text:
            page.add("#text", nodes[-1], 0, text, state[0], state[1])
        block.clear()
        state[0] = state[1] = 0

    def close(depth: int) -> None:
        nonlocal links, hidden
        for name, node, hiding in reversed(stack[depth:]):
            if node >= 0:
                flush()
                page.end[node] = len(page.kind)
                nodes.pop()
            opened[name] -= 1
            links -= name == "a"
            hidden -= hiding
        del stack[depth:]

    def innermost(name: str) -> int:
        """The place of the last open element of a name, 0 if there is none."""
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name) if opened[name] else 0

    def push(name: str, node: int, hiding: bool) -> None:
        stack.append((name, node, hiding))
        opened[name] += 1
        if node >= 0:
            nodes.append(node)

    def put(raw: str) -> None:
        if raw and not hidden:
            text = unescape(raw) if "&" in raw else raw
            block.append(text)
            if links:
                state[0] += len(text)

    at = done = 0  # where to look on, and how far the page has been taken
    while True:
        m = _TOKEN.search(html, at)
        end = m and (tags.find(m.end()) if m[2] else m.end())
        if m and end is None:  # a tag without an end is text
            at = m.end()
            continue
        put(html[done : m.start() if m else len(html)])
        if not m:
            break
        at = done = end
        name = m[2] and m[2].lower()
        if not name:
            continue
        if m[1]:
            where = innermost(name)
            if where and not (name not in BLOCK and any(n != -1 for _, n, _ in stack[where:])):
                close(where)
            elif where:  # an inline element across blocks ends without ending them
                links -= name == "a"
                hidden -= stack[where][2]
                opened[name] -= 1
                opened[""] += 1
                stack[where] = ("", -1, False)
            elif name == "p" and not hidden:
                flush()
            continue
        attributes = html[m.end() : end - 1]
        if name in RAW and not attributes.endswith("/"):
            at = done = _skip(html, at, name)
            block.append(" ")
            continue
        if name in VOID:
            if name == "hr" and not hidden:
                flush()
            elif name in ("br", "img", "input"):
                block.append(" ")
            continue
        hiding = name == "option" or hides(attributes) and not attributes.endswith("/") and name != "body"
        if name in BLOCK:
            if name in ("html", "body") and opened[name]:
                continue
            if name == "html":
                page.hints[0] |= hints_of(attributes)
                continue
            where = innermost("p")
            if where:  # any block element ends an open paragraph
                close(where)
        if name in CLOSES:
            where, left = 0, sum(opened[x] for x in CLOSES[name])
            for i in range(len(stack) - 1, 0, -1):
                if not left:
                    break
                if stack[i][0] in CLOSES[name]:
                    where, left = i, left - 1
                elif stack[i][0] in BOUNDS.get(name, ()):
                    break
            if where:
                close(where)
        if hiding or hidden:
            block.append(" ")
            push(name, -2 if name in BLOCK else -1, hiding)
            hidden += hiding
            links += name == "a"
        elif name in BLOCK:
            flush()
            push(name, -1 if name == "head" else page.add(name, nodes[-1], hints_of(attributes)), False)
        else:
            push(name, -1, False)
            links += name == "a"
            state[1] += 1
    close(1)
    flush()
    page.end[0] = len(page.kind)
    return page


_ENDS: dict[str, re.Pattern] = {}


def _skip(html: str, at: int, name: str) -> int:
    """The place behind the end tag that belongs to an element whose content is no text."""
    if name not in _ENDS:
        _ENDS[name] = re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])", re.I)
    depth = 1
    nests = name not in ("script", "style", "textarea", "title", "xmp")
    while m := _ENDS[name].search(html, at):
        at = html.find(">", m.end()) + 1
        if not at:
            break
        depth += -1 if m[1] else int(nests and html[at - 2] != "/")
        if depth == 0:
            return at
    return len(html)


# Features ----------------------------------------------------------------------------------------


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of numbers per node, first node of every page).

    Subtree sums are differences of running sums, as nodes come in document order.
    """
    size = np.array([len(p.kind) for p in pages])
    first = np.cumsum(size) - size
    shift = np.repeat(first, size)
    kind = np.array([KIND_OF.get(k, len(KINDS)) for p in pages for k in p.kind])
    parent = np.array([x for p in pages for x in p.parent]) + shift
    root = np.array([x for p in pages for x in p.parent]) < 0
    parent[root] = np.flatnonzero(root)
    end = np.array([x for p in pages for x in p.end]) + shift
    hints = np.array([x for p in pages for x in p.hints])
    texts = [t for p in pages for t in p.text]
    chars = np.array([len(t) for t in texts], float)
    stops = np.array([t.count(".") + t.count(",") + t.count("!") + t.count("?") for t in texts], float)
    words = np.array([t.count(" ") + 1 if t else 0 for t in texts], float)
    signs = np.array([("©" in t) + t.count("|") + t.count("·") + t.count("@") for t in texts], float)
    linked = np.array([x for p in pages for x in p.linked], float)
    pieces = np.array([x for p in pages for x in p.pieces], float)
    is_text = chars > 0
    at = np.arange(len(kind))

    def below(x: np.ndarray) -> np.ndarray:
        s = np.concatenate([[0.0], np.cumsum(x)])
        return s[end] - s[at]

    sub_chars, sub_links, sub_stops, sub_words, sub_signs = map(below, (chars, linked, stops, words, signs))
    nodes = (end - at).astype(float)
    blocks = below(is_text.astype(float))
    longest = below(np.where(chars > 80, chars, 0.0))
    heads = below(np.isin(kind, [KIND_OF["h1"], KIND_OF["h2"], KIND_OF["h3"]]).astype(float))
    lists = below((kind == KIND_OF["li"]).astype(float))
    paragraphs = below((kind == KIND_OF["p"]).astype(float))

    own_kind = [np.isin(kind, [KIND_OF[k] for k in g.split()]) for g in ("nav", "aside", "header", "footer", "form", "article main")]
    own_kind = np.stack(own_kind, axis=1)
    # Over all ancestors: those of the first 1, 2, 4, ... levels above, until every path has reached its root.
    depth = (~root).astype(float)
    above = hints.copy()
    above_kind = own_kind[parent] & ~root[:, None]  # inside nav, aside, header, footer, form, article or main
    up = parent
    while depth[up].any():
        depth, above, above_kind = depth + depth[up], above | above[up], above_kind | above_kind[up]
        up = up[up]
    above |= above[up]

    # Siblings: place among the parent's children, and the one before and after.
    order = np.lexsort((at, parent, root))
    kids = order[~root[order]]
    same = np.r_[False, parent[kids][1:] == parent[kids][:-1]][: len(kids)]
    start = np.flatnonzero(~same)
    place, count = np.zeros(len(kind)), np.ones(len(kind))
    if len(kids):
        run = np.diff(np.r_[start, len(kids)])
        place[kids] = np.arange(len(kids)) - np.repeat(start, run)
        count[kids] = np.repeat(run, run)
    before, after = np.full(len(kind), -1), np.full(len(kind), -1)
    before[kids[same]] = kids[np.flatnonzero(same) - 1]
    after[kids[np.flatnonzero(same) - 1]] = kids[same]

    page = np.repeat(first, size)
    total = np.maximum(sub_chars[page], 1)
    ahead = np.concatenate([[0.0], np.cumsum(chars)])
    ahead = (ahead[at] - ahead[page]) / total
    link_share = sub_links / np.maximum(sub_chars, 1)
    stop_share = sub_stops / np.maximum(sub_words, 1)
    density = np.log1p(sub_chars / nodes)

    def beside(x: np.ndarray, who: np.ndarray) -> np.ndarray:
        return np.where(who >= 0, x[np.maximum(who, 0)], -1.0)

    columns = [
        np.log1p(sub_chars), np.log1p(sub_words), np.log1p(nodes), density, link_share, stop_share, sub_signs / np.maximum(blocks, 1),
        sub_chars / total, longest / np.maximum(sub_chars, 1), sub_chars / np.maximum(sub_chars[parent], 1), ahead, depth, place,
        place / count, count, np.log1p(blocks), np.log1p(heads), np.log1p(lists), np.log1p(paragraphs), pieces, np.log1p(sub_words / np.maximum(blocks, 1)),
        beside(np.log1p(sub_chars), before), beside(np.log1p(sub_chars), after), beside(link_share, before), beside(link_share, after),
        link_share[parent], density[parent], is_text.astype(float),
    ]
    columns += [(kind == i).astype(float) for i in range(len(KINDS))]
    columns += [(kind[parent] == i).astype(float) for i in range(len(KINDS))]
    for bits in (hints, np.where(root, 0, above[parent])):
        columns += [((bits >> i) & 1).astype(float) for i in range(len(HINTS))]
    columns += [above_kind[:, i].astype(float) for i in range(6)]
    columns += [own_kind[:, i].astype(float) for i in range(6)]
    return np.stack(columns, axis=1), first


def decode(page: Page, gain: np.ndarray) -> str:
    """The blocks of the best consistent choice.

    A node may only be taken if its parent is; among all such choices the one with the highest sum of log
    odds is found from the leaves up: a subtree is worth its own odds and what its children add, where a
    child that would cost is cut with all that is below it.
    """
    worth = gain.tolist()
    parent = page.parent
    for i in range(len(worth) - 1, 0, -1):
        if worth[i] > 0:
            worth[parent[i]] += worth[i]
    taken = [False] * len(worth)
    out = []
    for i, w in enumerate(worth):
        taken[i] = i == 0 or (w > 0 and taken[parent[i]])
        if taken[i] and page.text[i]:
            out.append(page.text[i])
    return "\n".join(out)


# Training pages ----------------------------------------------------------------------------------

MARK = ""  # marks main text in training pages


class Layouts:
    """Pages with random layouts around given sentences, main text marked."""

    def __init__(self, sentences: list[str], seed: int):
        self.r, self.sentences = random.Random(seed), sentences

    def words(self, low: int, high: int) -> str:
        s = self.r.choice(self.sentences).split()
        while len(s) < high:
            s += self.r.choice(self.sentences).split()
        return escape(" ".join(s[: self.r.randint(low, high)]))

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(escape(self.r.choice(self.sentences)) for _ in range(self.r.randint(low, high)))

    def names(self, *groups: str) -> str:
        """Class or id attributes with words of some groups, or with none that tell."""
        r = self.r
        if r.random() < 0.15:
            return ""
        pool = [w for g in groups for w in HINTS[g].split()]
        if r.random() < 0.12 or not pool:
            pool = ["c1", "box", "wrap", "row", "col", "x9f", "inner", "container", "block", "panel"]
        name = r.choice(pool)
        name = r.choice([name, f"{name}-{r.choice(['box', 'wrap', 'list', 'area', '1'])}", f"{r.choice(['site', 'page', 'js', 'm'])}-{name}"])
        return f' {r.choice(["class", "class", "class", "id"])}="{name}"'

    def tag(self, names: tuple[str, ...], inner: str, *groups: str) -> str:
        name = self.r.choice(names)
        plain = name not in ("div", "section", "ul", "p") and self.r.random() < 0.6
        return f"<{name}{'' if plain else self.names(*groups)}>{inner}</{name}>"

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.r.randint(1, 999)}">{self.words(low, high)}</a>'

    def links(self, low: int = 3, high: int = 9) -> str:
        items = [self.link() for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice([" ", " | ", " &middot; "]).join(items)

    def menu(self) -> str:
        return self.tag(("nav", "nav", "div", "ul"), self.links(), "menu")

    def head(self) -> str:
        inner = self.r.choice(["", self.link(1, 3), f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.words(2, 8)}</p>"])
        return self.tag(("header", "div"), inner + (self.menu() if self.r.random() < 0.5 else self.form() if self.r.random() < 0.3 else ""), "head")

    def foot(self) -> str:
        r = self.r
        inner = f"&copy; {r.choice(['', str(r.randint(1999, 2026)), 'www.example.org'])} {r.choice(['&middot; ', '| ', ''])}{self.words(2, 18)}"
        inner = r.choice([inner, f"<p>{inner}</p>", f"<p>{self.prose(1, 2)}</p>", inner + self.links(2, 6), f"<div>{self.links(2, 8)}</div><p>{inner}</p>"])
        return self.tag(("footer", "footer", "div"), inner, "foot")

    def side(self) -> str:
        inner = self.r.choice([f"<h3>{self.words(1, 3)}</h3>", "", f"<h2>{self.words(1, 4)}</h2>"])
        inner += self.r.choice([self.links(), f"<p>{self.prose(1, 2)}</p>", "".join(f"<p>{self.link(3, 9)}</p>" for _ in range(4)), f"<ul><li>{self.words(3, 9)}</li><li>{self.words(3, 9)}</li></ul>"])
        return self.tag(("aside", "aside", "div", "section"), inner, "side")

    def sell(self) -> str:
        inner = self.r.choice([self.prose(1, 2), f"<p>{self.prose(1, 3)}</p>", f"<a href='/x'>{self.words(3, 12)}</a>", f"<b>{self.words(1, 3)}</b> {self.words(3, 9)}"])
        return f'<div class="{self.r.choice(HINTS["sell"].split())}{self.r.choice(["", "", "-slot", " box", "-1"])}">{inner}</div>'

    def note(self) -> str:
        inner = self.r.choice([f"<p>{self.prose(1, 2)}</p><button>{self.words(1, 2)}</button>", self.prose(1, 2), f"<p>{self.words(5, 25)} {self.link()}</p>"])
        return f'<{(n := self.r.choice(["div", "div", "section", "aside"]))} class="{self.r.choice(HINTS["note"].split())}{self.r.choice(["", "-bar", "-box"])}">{inner}</{n}>'

    def form(self) -> str:
        inner = f"<label>{self.words(1, 4)}</label><input name=q><p>{self.words(2, 20)}</p>" if self.r.random() < 0.6 else f"{self.words(1, 8)} <input><button>{self.words(1, 2)}</button>"
        return f"<form action='/s'{self.names('form')}>{inner}</form>"

    def talk(self) -> str:
        r = self.r
        one = [f"<p>{self.prose(1, 4)}</p>", f"<b>{self.words(1, 2)}</b><p>{self.prose(1, 3)}</p>", f"<span>{self.words(1, 2)}: </span>{self.prose(1, 3)}"]
        item = r.choice(["div", "li", "article", "p"])
        parts = "".join(f"<{item}{self.names('talk')}>{r.choice(one) if item != 'p' else self.prose(1, 3)}</{item}>" for _ in range(r.randint(1, 6)))
        parts = f"<ul>{parts}</ul>" if item == "li" else parts
        head = r.choice(["", f"<h2>{self.words(1, 3)}</h2>", f"<h3>{self.words(1, 3)}</h3>"])
        name = r.choice(["section", "div", "aside"])
        return f'<{name} {r.choice(["class", "id"])}="{r.choice(HINTS["talk"].split())}">{head}{parts}{self.form() if r.random() < 0.2 else ""}</{name}>'

    def share(self) -> str:
        return f'<div class="{self.r.choice(["share", "social", "sharing", "follow", "tags", "toolbox"])}">{self.links(2, 5)}</div>'

    def body(self) -> str:
        """Main text; every block of it carries the mark."""
        r, out = self.r, []
        if r.random() < 0.85:
            out.append(f"<h1>{MARK}{self.words(2, 12)}</h1>")
        elif r.random() < 0.5:
            out.append(f"<header><h1>{MARK}{self.words(2, 12)}</h1></header>")
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            k = r.random()
            if k < 0.72:
                text = self.prose(1, r.choice([1, 3, 8, 20]))
                if r.random() < 0.25:
                    text = f"<b>{text}<br>" if r.random() < 0.5 else f"{self.words(2, 9)} <a href='/y'>{self.words(1, 4)}</a> {text} <em>{self.words(1, 5)}</em>"
                if r.random() < 0.12:
                    text = self.words(1, 9)
                out.append(f"<p>{MARK}{text}" + ("" if r.random() < 0.12 else "</p>"))
            elif k < 0.80:
                out.append(f"<h{(n := r.randint(2, 4))}>{MARK}{self.words(1, 8)}</h{n}>")
            elif k < 0.86:
                out.append("<ul>" + "".join(f"<li>{MARK}{self.words(2, 25)}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif k < 0.90:
                out.append(f"<blockquote>{r.choice(['<p>', ''])}{MARK}{self.prose(1, 4)}</blockquote>")
            elif k < 0.93:
                out.append(f"<pre>{MARK}{self.words(4, 30)}</pre>")
            elif k < 0.96:
                rows = "".join(f"<tr><td>{MARK}{self.words(1, 4)}</td><td>{MARK}{self.words(1, 6)}</td></tr>" for _ in range(r.randint(2, 5)))
                out.append(f"<table>{rows}</table>")
            else:
                out.append(f"<figure><img src=a.jpg><figcaption>{MARK}{self.words(3, 15)}</figcaption></figure>")
            if r.random() < 0.06:
                out.append(r.choice([self.sell, self.share, self.note, self.side])())
        if r.random() < 0.15:
            out.append(self.share())
        if r.random() < 0.1:
            out.append(self.talk())
        return "".join(out)

    def page(self) -> str:
        r = self.r
        main = self.body()
        kind = r.random()
        if kind < 0.75:
            main = self.tag(("article", "article", "main", "div", "section"), main, "text")
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            main = self.tag(("div", "main", "section"), main, *r.choice([("text",), ()]))
        if kind > 0.95:
            return f"<html><body>{main}</body></html>"
        ahead = [f for f, p in ((self.note, 0.2), (self.head, 0.5), (self.menu, 0.7), (self.sell, 0.4), (self.side, 0.15), (self.form, 0.1)) if r.random() < p]
        behind = [f for f, p in ((self.talk, 0.35), (self.sell, 0.15), (self.side, 0.35), (self.menu, 0.1), (self.form, 0.15), (self.note, 0.15)) if r.random() < p]
        r.shuffle(behind)
        middle = "".join(f() for f in ahead) + main + "".join(f() for f in behind) + (self.foot() if r.random() < 0.85 else "")
        if r.random() < 0.3:
            middle = f"<div{self.names()}>{middle}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title><script>var t='</p>';</script></head><body>{middle}</body></html>"


def train(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample: int = 200, chars: int = 20_000,
          layouts: int = 700, seed: int = 11, **options) -> Boosted:
    """Trees fitted on `layouts` pages whose layout is drawn at random around sentences of the table.

    The table has no labels, so the labelled pages are made: sentences from at most `sample` pages (those
    whose ids hash lowest, `chars` characters of each) fill known layouts.  Both bounds hold for the fit
    only; extraction reads every page whole.
    """
    ids = pages.where(F.col(html_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"))
    # Ids first, so that no task sends more than ids; at most `sample` of them.
    chosen = ids.distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = pages.select(F.col(id_col).alias("id"), F.substring(F.col(html_col), 1, chars).alias("html"))
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("html").alias("html")).where("html is not null")
    texts = [t for r in sorted(rows.collect()) for t in parse(r["html"]).text if t]
    sentences = sorted({s.strip() for t in texts for s in re.split(r"(?<=[.!?])\s+", t) if 3 <= len(s.split()) <= 40})
    sentences = sentences or ["Some words stand here.", "More of them follow, and end."]
    made = Layouts(sentences, seed)
    parsed = [parse(made.page()) for _ in range(layouts)]
    x, _ = features(parsed)
    marks = np.array([t.startswith(MARK) for p in parsed for t in p.text], float)
    shift = np.repeat(np.cumsum([0, *(len(p.end) for p in parsed)])[:-1], [len(p.end) for p in parsed])
    ends = np.concatenate([p.end for p in parsed]) + shift
    total = np.concatenate([[0.0], np.cumsum(marks)])
    return fit(x, (total[ends] > total[np.arange(len(ends))]).astype(float), **options)


def extract(htmls: list[str], model: Boosted) -> list[str]:
    pages = [parse(h) for h in htmls]
    x, first = features(pages)
    gain = model.log_odds(x)
    return [decode(p, gain[a : a + len(p.kind)]) for p, a in zip(pages, first)]


def main_text(pages: DataFrame, model: Boosted, html_col: str = "html") -> DataFrame:
    """(row, text): every input row as a struct, whatever its columns, and the main text of its whole html.

    Blocks are joined by one line feed in page order.  Null or empty html, and pages without text, give an
    empty text; repeated rows come as often as they are there.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in pieces_of(batches, "html", CHUNK):
            texts = extract([h or "" for h in part["html"].to_pylist()], shared.value)
            yield pa.record_batch([part["row"], pa.array(texts, pa.string())], names=["row", "text"])

    rows = pages.select(F.struct("*").alias("row"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string")
