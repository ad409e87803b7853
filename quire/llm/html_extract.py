"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A page is parsed to a tree (with implied end tags; scripts, styles, forms' controls and comments
never become text). Each element has features of its subtree (text, tags, links, paragraphs), of
its tag and attribute tokens, of its depth, ancestors and siblings. What a tag or a token of a class, id or role
says is learned too: its log odds of main text, counted over elements of other training pages than the trees'. Boosted trees give the log
odds that an element belongs to the main text. A dynamic programme over the tree then picks the likeliest
labelling in which nothing below a dropped element is kept, so ancestors and descendants never
contradict each other. Kept text is cut into blocks at block elements and line breaks.

There are no labelled pages, so all is trained here, once per call, on pages that
:func:`sample_pages` composes: layouts of several kinds whose parts are known to be main text or not, some without any
telling class, some with a misleading one.

Defined cases: null and empty html give an empty text; a page of bare text is all main text; a
tag cut off at the end is dropped. Hidden elements are elements like others. Rows are extracted one by one, so repeated rows give repeated results, and
other columns are ignored.
"""

from __future__ import annotations

import functools
import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm._common import small_batches, texts

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)[^>]*(>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NO_TEXT = RAW | {"head", "svg", "math", "select", "button", "object", "canvas", "audio", "video", "datalist", "map"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul", "center", "dir",
}
#: An opening tag ends an open element of these, up to the bound.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"}),
}
class Node:
    __slots__ = ("tag", "tokens", "children", "parent", "depth", "chars", "links", "tags", "paras", "stops", "index", "keep", "spot", "around")

    def __init__(self, tag: str, tokens: tuple[str, ...], parent: Node | None):
        self.tag, self.tokens, self.parent = tag, tokens, parent
        self.children: list[Node | str] = []
        self.depth = parent.depth + 1 if parent else 0


def attribute_tokens(source: str) -> tuple[str, ...]:
    """Tokens of class, id, role and itemprop, in lower case."""
    tokens = []
    for m in _ATTRIBUTE.finditer(source):
        name = m[1].lower()
        if name in ("class", "id", "role", "itemprop"):
            tokens += [t.lower() for t in _TOKEN.findall(html.unescape(m[2] or m[3] or m[4] or ""))]
        if name == "data-main":
            tokens.append("@main")
    return tuple(tokens)


def parse(source: str) -> Node:
    root = here = Node("#root", (), None)
    open_ = Counter()  # tags around what comes next, so that no search for one that isn't there climbs the tree
    at, n = 0, len(source)
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            here.children.append(html.unescape(source[at:lt]))
        if lt == n:
            break
        m = _TAG.match(source, lt)
        if not m:
            if re.match(r"</?[a-zA-Z]", source[lt : lt + 3]):
                break  # a tag cut off
            here.children.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag = (m[2] or m[6] or "").lower()
        if not tag or m[4] == "" or m[7] == "":
            continue  # a comment, a declaration, or a tag cut off
        if m[1] or m[5]:
            up = here if open_[tag] > 0 else root
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                # an inline element's end doesn't close blocks around it
                if tag not in INLINE or all(x.tag in INLINE for x in _between(here, up)):
                    here = _leave(here, up.parent, open_)
            elif tag in ("p", "br"):
                here.children.append(Node("br", (), here))
            continue
        if tag in CLOSES_P and open_["p"] > 0:
            up = here
            while up is not root and up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                here = _leave(here, up.parent, open_)
        if tag in ENDS and any(open_[x] > 0 for x in ENDS[tag][0]):
            ends, bound = ENDS[tag]
            up, last = here, None
            while up is not root and up.tag not in bound:
                if up.tag in ends:
                    last = up
                up = up.parent
            if last is not None:
                here = _leave(here, last.parent, open_)
        attributes = m[3] or ""
        node = Node(tag, attribute_tokens(attributes) if attributes else (), here)
        here.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(source, at)
            at = n if not end else (source.find(">", end.start()) + 1 or n)
        elif tag not in VOID and not attributes.endswith("/"):
            here = node
            open_[tag] += 1
    return root


def _leave(here: Node, to: Node, open_: Counter) -> Node:
    for x in _between(here, to):
        open_[x.tag] -= 1
    return to


def _between(low: Node, high: Node) -> Iterator[Node]:
    while low is not high:
        yield low
        low = low.parent


def elements(root: Node) -> list[Node]:
    """Elements that may have text, parents first, with the sums over their subtrees."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if type(c) is Node and c.tag not in NO_TEXT]
    for node in out:
        node.chars = node.links = node.tags = node.paras = node.stops = 0
    for node in reversed(out):
        for c in node.children:
            if type(c) is str:
                k = len(c) - c.count(" ") - c.count("\n")
                node.chars += k
                node.stops += c.count(". ") + c.count(", ") + c.endswith(".")
        if node.tag == "a":
            node.links = node.chars
        if p := node.parent:
            p.chars += node.chars
            p.links += node.links
            p.tags += node.tags + 1
            p.paras += node.paras + (node.tag == "p")
            p.stops += node.stops
    return out


def known_tokens(pages: Iterable[Node], prior: float = 4.0) -> dict[str, float]:
    """Log odds of main text of the elements with a tag (``<tag``) or an attribute token, shrunk towards 0."""
    main, other = Counter(), Counter()
    for root in pages:
        for node in elements(root)[1:]:
            (main if is_main(node) else other).update({"<" + node.tag, *node.tokens} - {"@main"})
    share = main.total() / max(1, main.total() + other.total())
    return {t: math.log((main[t] / max(share, 1e-9) + prior) / (other[t] / max(1 - share, 1e-9) + prior)) for t in {*main, *other}}


def features(nodes: list[Node], known: dict[str, float]) -> np.ndarray:
    total = max(1, nodes[0].chars)
    most = max((n.chars for n in nodes if n.tag in ("article", "main")), default=0)
    nodes[0].spot, siblings = 0, {None: (1, {nodes[0].tag: 1}, nodes[0].chars)}
    rows = []
    for node in nodes:
        p = node.parent
        kids = [c for c in node.children if type(c) is Node]
        tags: dict[str, int] = {}
        for i, c in enumerate(kids):
            c.spot = i
            tags[c.tag] = tags.get(c.tag, 0) + 1
        siblings[node] = (len(kids), tags, max((c.chars for c in kids if c.tag not in NO_TEXT), default=0))
        said, of_tag = [known.get(t, 0.0) for t in node.tokens if t != "@main"], known.get("<" + node.tag, 0.0)
        low, high = min(said, default=0.0), max(said, default=0.0)
        up_low, up_high, up_tag_low, up_tag_high = p.around if p else (0.0, 0.0, 0.0, 0.0)
        node.around = (min(up_low, low), max(up_high, high), min(up_tag_low, of_tag), max(up_tag_high, of_tag))
        n_kids, tags, largest = siblings[p]
        chars = node.chars
        rows.append((
            math.log1p(chars), chars / (1 + node.tags), node.links / max(1, chars), chars / total, min(node.depth, 30), node.spot / n_kids,
            math.log1p(n_kids), tags[node.tag] / n_kids, math.log1p(node.paras), node.stops / max(1, chars), low, high, len(said), of_tag, up_low, up_high, up_tag_low, up_tag_high,
            chars / max(1, largest), node.tag in ("ul", "ol", "li", "dl"), node.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "table", "tr", "td", "th"), node.tag in ("div", "section", "span"),
            most / total, node.tag in INLINE, p.chars / total if p else 1.0, (p.links / max(1, p.chars)) if p else 0.0, n_kids - 1 - node.spot, math.log1p(p.paras) if p else 0.0,
        ))
    return np.array(rows, dtype=np.float32)


class Trees:
    """Boosted regression trees of fixed depth on quantile bins, with logistic loss."""

    def __init__(self, depth: int = 3, trees: int = 60, rate: float = 0.2, bins: int = 32, l2: float = 2.0):
        self.depth, self.n_trees, self.rate, self.bins, self.l2 = depth, trees, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        n, f = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(f)]
        codes = np.stack([np.searchsorted(edges[j], x[:, j], side="right") for j in range(f)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(n, self.base)
        inner = (1 << self.depth) - 1
        self.feature, self.cut = np.zeros((self.n_trees, inner), np.int64), np.full((self.n_trees, inner), np.inf)
        self.leaf = np.zeros((self.n_trees, 1 << self.depth))
        wide = codes + np.arange(f) * self.bins
        for t in range(self.n_trees):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p) + 1e-9
            at = np.zeros(n, np.int64)
            for level in range(self.depth):
                k = 1 << level
                key = (at[:, None] * (f * self.bins) + wide).ravel()
                gs = np.bincount(key, np.repeat(g, f), k * f * self.bins).reshape(k, f, self.bins).cumsum(axis=2)
                hs = np.bincount(key, np.repeat(h, f), k * f * self.bins).reshape(k, f, self.bins).cumsum(axis=2)
                g_all, h_all = gs[:, :1, -1:], hs[:, :1, -1:]
                gain = gs**2 / (hs + self.l2) + (g_all - gs) ** 2 / (h_all - hs + self.l2)
                gain[(hs < 1.0) | (h_all - hs < 1.0)] = -1
                below = np.zeros(n, np.int64)
                best = gain[:, :, :-1].reshape(k, -1).argmax(axis=1)
                j, b = best // (self.bins - 1), best % (self.bins - 1)
                for i in range(k):
                    slot = k - 1 + i
                    if b[i] < len(edges[j[i]]) and gain[i, j[i], b[i]] > 0:
                        self.feature[t, slot], self.cut[t, slot] = j[i], edges[j[i]][b[i]]
                    own = at == i
                    below[own] = i * 2 + (x[own, self.feature[t, slot]] >= self.cut[t, slot])
                at = below
            gl, hl = np.bincount(at, g, 1 << self.depth), np.bincount(at, h, 1 << self.depth)
            self.leaf[t] = -self.rate * gl / (hl + self.l2)
            score += self.leaf[t][at]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        rows, trees = np.arange(len(x))[:, None], np.arange(self.n_trees)[None, :]
        at = np.zeros((len(x), self.n_trees), np.int64)
        for level in range(self.depth):
            slot = (1 << level) - 1 + at
            at = at * 2 + (x[rows, self.feature[trees, slot]] >= self.cut[trees, slot])
        return self.base + self.leaf[trees, at].sum(axis=1)


def _flows(nodes: list[Node]) -> set[Node]:
    """Inline elements without block elements in them: parts of a run of text."""
    holds_block = set()
    for node in reversed(nodes):
        if node.parent and (node.tag not in INLINE or node in holds_block):
            holds_block.add(node.parent)
    return {n for n in nodes if n.tag in INLINE and n not in holds_block}


def _own(node: Node) -> int:
    return sum(len(c) for c in node.children if type(c) is str and not c.isspace())


def _runs(node: Node, flows: set[Node]) -> Iterator[list[Node | str]]:
    """What stands between two block elements or breaks, of an element's children."""
    run: list[Node | str] = []
    for c in node.children:
        if type(c) is str or c in flows:
            run.append(c)
        elif c.tag not in NO_TEXT or c.tag not in INLINE:
            yield run
            run = []
    yield run


def decode(nodes: list[Node], odds: np.ndarray) -> None:
    """Marks the elements that are kept, each only if all around it are. Odds count by the text an element has itself, in part.

    Inline elements share a decision: that of their block, if it has text of its own beside them or no blocks in it; else all inline
    elements that stand together between two blocks are kept, or none.
    """
    flows = _flows(nodes)
    own: dict[Node, int] = {}
    gain: dict[Node, float] = {}
    for node, o in zip(reversed(nodes), odds[::-1], strict=True):
        own[node] = _own(node) + sum(own[c] for c in node.children if c in flows)
        gain[node] = float(o) * (1 + math.log1p(own[node]))
        if node in flows:  # the sum over what is inline in it
            gain[node] += sum(gain[c] for c in node.children if c in flows)
        node.index = 0.0  # gain of the best labelling below, if the node is kept
    below: dict[Node, float] = {}
    for node in reversed(nodes):
        if node in flows:
            continue
        node.index += gain[node]
        if any(type(c) is Node and c not in flows and c.tag not in VOID and c.tag not in NO_TEXT for c in node.children):
            for run in _runs(node, flows):
                apart = [c for c in run if type(c) is Node]
                if apart and all(type(c) is Node or c.isspace() for c in run):
                    together = sum(gain[c] for c in apart)
                    below.update((c, together) for c in apart)
                    node.index += max(0.0, together)
        node.keep = node.index > 0
        if node.parent and node.keep:
            node.parent.index += node.index
    nodes[0].keep = True
    for node in nodes[1:]:
        node.keep = node.parent.keep and (below.get(node, 1.0) > 0 if node in flows else node.keep)


def blocks(root: Node, all_text: bool = False) -> list[str]:
    """Texts of the blocks of kept elements, in page order."""
    out, run, stack = [], [], [root]

    def close() -> None:
        if text := " ".join("".join(run).split()):
            out.append(text)
        run.clear()

    while stack:
        x = stack.pop()
        if x is None:
            close()
        elif type(x) is str:
            run.append(x)
        elif x.tag in ("br", "hr"):
            close()
        elif x.tag not in NO_TEXT and (all_text or x.keep):
            inline = x.tag in INLINE
            if not inline:
                close()
                stack.append(None)
            stack += reversed(x.children)
        elif x.tag not in INLINE:
            close()
    close()
    return out


def main_text(source: str | None, model: tuple[dict[str, float], Trees]) -> str:
    if not source:
        return ""
    known, trees = model
    root = parse(source)
    nodes = elements(root)
    decode(nodes, trees.predict(features(nodes, known)))
    return "\n".join(blocks(root))


def sample_pages(n: int, seed: int = 53) -> Iterator[Node]:
    """Parsed pages whose elements of main text have the token ``@main`` (no feature sees it)."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ten", "ra", "su", "vel", "or", "in", "da", "the", "un", "el", "der", "que", "st"]

    def words(a: int, b: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(a, b)))

    def sentence(a: int, b: int) -> str:
        return words(a, b).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 2)}</a></li>' for i in range(k))

    def paragraph() -> str:
        kind = rng.random()
        body = " ".join(sentence(1, 14) + ("," if rng.random() < 0.2 else "") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 15])))
        if kind < 0.08:
            body = sentence(1, 2)
        elif kind < 0.14:
            body += f' <a href="/x">{words(1, 3)}</a> ' + sentence(3, 9)
        elif kind < 0.18:
            body = f'<a href="/x">{words(1, 6)}</a>'
        elif kind < 0.24:
            body = f"<b>{sentence(1, 4)}</b> " + body
        elif kind < 0.28:
            body = " | ".join(words(1, 1) for _ in range(rng.randint(3, 30)))
        return body

    telling = ["more", "top", "legal", "notice", "header", "side", "menu", "share", "tags", "search", "bottom", "ad", "lead", "intro", "note", "first", "post", "text", "wide", "box", "row", "related", "comment"]

    def odd() -> str:
        """A class that says nothing, or the wrong thing."""
        return f' class="{rng.choice([rng.choice(telling), words(1, 1), words(1, 1) + "-" + rng.choice(telling)])}"' if rng.random() < 0.12 else ""

    def main(rich: bool) -> str:
        out = []
        if rng.random() < 0.8:
            out.append(f"<h1 data-main>{sentence(1, 10)}</h1>")
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9, 20])):
            kind = rng.random() if rich else 0
            if kind < 0.72:
                open_b = "<b>" if rng.random() < 0.15 else ""
                out.append(f"<p data-main{odd()}>{open_b}{paragraph()}{rng.choice(['', '<br>']) if open_b else ''}" + rng.choice(["</p>", "</p>", "</p>", ""]))
            elif kind < 0.78 or not out and rich and kind < 0.8:
                level = rng.choice([2, 2, 3, 3, 4, 5, 6])
                out.append(f"<h{level} data-main{odd()}>{words(1, 7)}</h{level}>")
            elif kind < 0.84:
                out.append(f"<ul data-main{odd()}>{''.join(f'<li data-main>{sentence(1, 12)}</li>' for _ in range(rng.randint(1, 6)))}</ul>")
            elif kind < 0.88:
                out.append(f"<blockquote data-main><p data-main>{paragraph()}</p></blockquote>")
            elif kind < 0.91:
                out.append(f"<table data-main{odd()}>{''.join(f'<tr data-main><td data-main>{words(1, 3)}</td><td data-main>{words(1, 3)}</td></tr>' for _ in range(rng.randint(1, 5)))}</table>")
            elif kind < 0.93:
                out.append(f"<pre data-main>{words(3, 30)}</pre>")
            elif kind < 0.95:
                out.append(f"<div data-main{odd()}><p data-main>{paragraph()}</p>{f'<p data-main>{paragraph()}</p>' * rng.randint(0, 1)}</div>")
            else:
                out.append(inner())
        return "".join(out)

    def inner() -> str:
        return rng.choice([
            lambda: f'<div class="{rng.choice(["ad", "ads", "advert", "sponsored promo", "ad-slot"])}">{sentence(2, 15)}</div>',
            lambda: f'<div class="{rng.choice(["share", "social-share", "sharing"])}"><a href="#">{words(1, 2)}</a> <a href="#">{words(1, 2)}</a></div>',
            lambda: f'<aside class="{rng.choice(["related", "pullquote", "promo", ""])}"><p>{sentence(4, 20)}</p></aside>',
            lambda: f'<div class="{rng.choice(["related", "related-posts", "recommended", "more-stories"])}"><ul>{links(rng.randint(2, 5))}</ul></div>',
            lambda: f'<form class="{rng.choice(["newsletter", "subscribe", "signup"])}"><p>{sentence(3, 12)}</p><label>{words(1, 2)}</label></form>',
        ])()

    def part() -> str:
        return rng.choice([
            lambda: f"<nav{rng.choice(['', ' class=menu', ' id=nav'])}><ul>{links(rng.randint(2, 12))}</ul></nav>",
            lambda: f'<div class="{rng.choice(["nav", "menu", "top-menu", "navbar", "breadcrumbs", "navigation"])}"><ul>{links(rng.randint(2, 9))}</ul></div>',
            lambda: f'<header{rng.choice(["", " class=site-header", " role=banner"])}>{rng.choice(["<h1>", "<p>", "<div>"])}{words(1, 5)}</header>',
            lambda: f'<div class="{rng.choice(["header", "masthead", "site-header"])}"><span>{words(1, 6)}</span></div>',
            lambda: f'<div class="{rng.choice(["ad", "ads", "advert", "banner-ad", "sponsor", "promo"])}">{" ".join(sentence(1, 12) for _ in range(rng.randint(1, 4)))}</div>',
            lambda: f'<aside class="{rng.choice(["", "sidebar", "widget"])}"><h3>{words(1, 3)}</h3><p>{" ".join(sentence(2, 14) for _ in range(rng.randint(1, 4)))}</p></aside>',
            lambda: f'<div class="{rng.choice(["sidebar", "side-bar", "right-sidebar widget"])}"><h3>{words(1, 3)}</h3><ul>{links(rng.randint(2, 8))}</ul><p>{sentence(3, 20)}</p></div>',
            lambda: f'<div {rng.choice(["id", "class"])}="{rng.choice(["cookie", "cookie-notice", "consent", "gdpr-banner", "notice", "alert"])}"><p>{" ".join(sentence(4, 16) for _ in range(rng.randint(1, 3)))}</p></div>',
            lambda: f'<form action="/s"><label>{words(1, 3)}</label><p>{sentence(2, 9)}</p></form>',
            lambda: f'<div{rng.choice(["", "", odd()])}>{" ".join(f"<a href=/{i}>{words(1, 2)}</a>" for i in range(rng.randint(2, 8)))}</div>',
            lambda: f'<div{odd()}><ul>{links(rng.randint(2, 8))}</ul></div>',
            lambda: f'<ul{odd()}>{links(rng.randint(2, 8))}</ul>',
            lambda: f'<div class="{rng.choice(["search", "login-form", "newsletter"])}"><form><label>{words(1, 3)}</label></form><p>{sentence(2, 9)}</p></div>',
        ])()

    def comments() -> str:
        tag = rng.choice(["div", "section"])
        each = "".join(f'<{rng.choice(["div", "article"])} class="comment"><b>{words(1, 2)}</b><p>{" ".join(sentence(3, 15) for _ in range(rng.randint(1, 4)))}</p></div>' for _ in range(rng.randint(1, 6)))
        return f'<{tag} {rng.choice(["id", "class"])}="{rng.choice(["comments", "reader-comments", "disqus", "comment-list", "discussion"])}"><h2>{words(1, 2)}</h2>{each}</{tag}>'

    def foot() -> str:
        return rng.choice([
            lambda: f"<footer{rng.choice(['', ' class=site-footer'])}>&copy; {words(1, 2)} &middot; {sentence(2, 16)}</footer>",
            lambda: f'<div class="{rng.choice(["footer", "copyright", "site-footer legal"])}"><p>{sentence(2, 16)}</p><ul>{links(rng.randint(0, 4))}</ul></div>',
            lambda: f"<footer><ul>{links(rng.randint(1, 6))}</ul><p>&copy; {words(1, 3)}</p></footer>",
            lambda: f"<div{odd()}><p>{rng.choice(['Copyright', '&copy;', words(1, 1)])} {rng.randint(1990, 2030)} {words(1, 3)}</p></div>",
        ])()

    for _ in range(n):
        rich = rng.random() < 0.6
        shell = rng.choice(["<article data-main>{}</article>"] * 3 + ["<main data-main>{}</main>", "<main data-main><article data-main>{}</article></main>", '<div data-main class="content">{}</div>', '<div data-main id="main-content">{}</div>', '<div data-main class="post-body">{}</div>', "<div data-main>{}</div>", "<section data-main>{}</section>", "{}"])
        body = shell.format(main(rich))
        before = "".join(part() for _ in range(rng.randint(0, 4)))
        after = "".join(part() for _ in range(rng.randint(0, 2)))
        if rng.random() < 0.3:
            after = comments() + after
        page = before + body + after + (foot() if rng.random() < 0.85 else "")
        if rng.random() < 0.4:
            page = f'<div data-main {rng.choice(["", "class=wrapper", "id=page", "class=container"])}>{page}</div>'
        root = parse(f"<html><head><title>x</title></head><body data-main>{page}</body></html>" if rng.random() < 0.9 else page)
        yield root


def is_main(node: Node) -> bool:
    """Whether a composed page's element is main text: marked, or inline in one that is."""
    while node.parent and node.tag in INLINE and "@main" not in node.tokens:
        node = node.parent
    return node.tag in ("#root", "html") or "@main" in node.tokens


@functools.cache  # of the driver: a model for each set of parameters
def trained(n_pages: int = 500, seed: int = 53) -> tuple[dict[str, float], Trees]:
    known = known_tokens(sample_pages(n_pages, seed + 1))
    x, y = [], []
    for root in sample_pages(n_pages, seed):
        nodes = elements(root)
        x.append(features(nodes, known))
        y += [is_main(n) for n in nodes]
    return known, Trees().fit(np.concatenate(x), np.array(y, dtype=np.float64))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of ``pages``."""
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            out = [main_text(x, model) for x in texts(batch.column("html")).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id").cast(pa.int64()), batch.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
