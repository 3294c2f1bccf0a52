"""Main text of HTML pages by boosted trees over DOM-node features.

A page becomes a tree of block elements and text runs (what stands between
block tags; inline tags are part of a run).  Gradient-boosted trees give each
node the probability that it holds main text, from its subtree's density, its
attribute tokens, depth and siblings.  Choices are decoded from the root: a
node may be kept only below kept ancestors, and the kept set with the largest
total likelihood is taken, so no choice contradicts one above or below it.  The
kept runs are the text in page order, one per line; runs with only embedded
elements (formulas, icons, players) between them share a line.

The trees are fitted on the driver on ``TRAINING_PAGES`` labelled pages, laid
out at random from the page parts that the task names; parsing and scoring run
in the tasks, a batch of pages at a time.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telewatch.llm.common import col, fresh, table

TRAINING_PAGES = 700
TREES, DEPTH, RATE, MIN_LEAF, BINS = 60, 4, 0.3, 10, 24
BATCH_NODES = 50_000

# Fixed values of HTML: elements without content, elements whose content is not
# markup, embedded elements (nodes that stand inside a line), foreign ones among
# them and the parts of those that are nodes, inline elements, and elements that
# end an open paragraph or an open foreign element.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe".split())
EMBEDDED = "svg math object video audio canvas select template noscript".split()
FOREIGN = {"svg", "math"}
FOREIGN_PARTS = {"foreignobject", "desc", "annotation", "annotation-xml"}
INLINE = set(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em embed font i img input ins kbd label mark meter "
    "output param progress q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
BREAKS_OUT = CLOSES_P | set("b big body br code dd dt em embed head i img li meta ruby s small span strong strike sub sup td th tr tt u var".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "menu"}
_IN_LINE = {*EMBEDDED, *FOREIGN_PARTS, "option", "optgroup"}
_SPACED = {"br", "text", "option", "optgroup"}  # words on either side stay apart
_P_SCOPES = {"td", "th", "li", "div", "article", "section", "object", "template", "foreignobject"}
_GAPS = ("", " ", "\n")

_PIECE = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+").findall  # also of a name like bodyContent
_SPACE = re.compile(r"\s+")

# Tokens of names that page authors give to parts; one feature for each line.
NAME_TOKENS = [
    "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager",
    "header masthead banner topbar branding logo",
    "footer foot copyright legal colophon",
    "sidebar aside related widget widgets recommended rail",
    "ad ads advert adverts advertisement sponsor sponsored promo promotion",
    "cookie cookies consent notice gdpr alert popup modal newsletter subscribe subscription",
    "comment comments reply replies discussion disqus respond",
    "form login search signup share sharing social",
    "article post entry story main content body text page",
]
_TOKEN_LINE = {t: k for k, line in enumerate(NAME_TOKENS) for t in line.split()}
TAGS = "#text p div section article main nav header footer aside form ul ol li table td h1 h2 h3 h4 pre blockquote figure".split() + EMBEDDED
TAGS += ["#ended", "#unended"]  # an embedded element with and without its end tag
_TAG_NUMBER = {t: k for k, t in enumerate(TAGS)}


@dataclass(slots=True)
class Node:
    tag: str
    tokens: frozenset[int]
    depth: int
    parent: int
    children: list[int] = field(default_factory=list)
    text: str = ""
    chars: int = 0
    linked: int = 0
    runs: int = 0
    paragraphs: int = 0
    marks: int = 0
    place: int = 0  # among its siblings
    ended: bool = False  # by its own end tag
    gap: int = 2  # what stands between a run and the one before it, a place in _GAPS


def _tokens(attributes: str) -> frozenset[int]:
    found: set[int] = set()
    if "=" in attributes:
        for _, *values in _ATTRIBUTE.findall(attributes):
            found.update(_TOKEN_LINE[w] for w in map(str.lower, _WORDS(html.unescape("".join(values)))) if w in _TOKEN_LINE)
    return frozenset(found)


def parse(page: str) -> list[Node]:
    """The page's nodes in document order, the root first.

    Open elements end where HTML has them end, embedded ones at ``/>``, at their
    end tag or with their parent; unknown and stray tags are passed over; a page
    cut off anywhere parses as far as it goes."""
    nodes = [Node("#root", frozenset(), 0, -1)]
    open_ = [0]
    run: list[str] = []
    links, linked, gap = 0, 0, 2

    def flush(line: bool = True) -> None:
        nonlocal linked, gap
        raw = html.unescape("".join(run))
        text = _SPACE.sub(" ", raw).strip()
        run.clear()
        if raw[:1].isspace():
            gap = max(gap, 1)
        if text:
            parent = open_[-1]
            nodes[parent].children.append(len(nodes))
            node = Node("#text", frozenset(), nodes[parent].depth + 1, parent, text=text, gap=gap)
            node.chars, node.linked = len(text), min(linked, len(text))
            node.place = len(nodes[parent].children) - 1
            nodes.append(node)
            gap = int(raw[-1:].isspace())
        if line:
            gap = 2
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        run.append(text)
        if links:
            linked += len(text)

    def close(tags: set[str], until: set[str], own: bool = False) -> None:
        for k in range(len(open_) - 1, 0, -1):
            tag = nodes[open_[k]].tag
            if tag in tags:
                nodes[open_[k]].ended = own
                del open_[k:]
                return
            if tag in until:
                return

    at = 0
    while at < len(page):
        found = _PIECE.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        end, start, attributes = found.groups()
        foreign = nodes[open_[-1]].tag in FOREIGN
        if end:
            tag = end.lower()
            if tag == "a":
                links = max(0, links - 1)
            elif foreign and not any(nodes[k].tag == tag for k in open_):
                if tag in _SPACED:
                    add(" ")
            elif tag not in INLINE and tag not in VOID:
                flush(tag not in _IN_LINE)
                if tag in _SPACED:
                    add(" ")
                close({tag}, set() if tag in CLOSES_P or tag in SCOPES or tag == "body" else SCOPES, own=True)
        elif start:
            tag = start.lower()
            empty = attributes.endswith("/")
            if tag in RAW:
                if foreign and empty:
                    continue
                ends = rf"</{re.escape(tag)}\b[^>]*>" + (r"|(?=</(?:svg|math)\b)" if foreign else "")
                if done := re.compile(ends, re.I).search(page, at):
                    at = done.end()
                elif not (empty or foreign):
                    at = len(page)
                continue
            if foreign and tag in BREAKS_OUT:
                flush(False)
                while nodes[open_[-1]].tag in FOREIGN:
                    open_.pop()
            elif foreign and tag not in _IN_LINE and tag not in INLINE:
                if tag in _SPACED:
                    add(" ")
                continue
            if tag in _SPACED:
                add(" ")
            if tag == "a":
                links += 1
            if tag in INLINE or tag in _IN_LINE and empty:
                continue
            flush(tag not in _IN_LINE)
            if tag not in _IN_LINE:
                links = 0
            if tag in CLOSES_P:
                close({"p"}, _P_SCOPES)
            if tag in SAME_CLOSES:
                close(SAME_CLOSES[tag], SCOPES - {tag})
            if tag in VOID or empty and tag not in CLOSES_P:
                continue
            parent = open_[-1]
            nodes[parent].children.append(len(nodes))
            nodes.append(Node(tag, _tokens(attributes), nodes[parent].depth + 1, parent))
            nodes[-1].place = len(nodes[parent].children) - 1
            open_.append(len(nodes) - 1)
    flush()
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    for k in range(len(nodes) - 1, -1, -1):
        node = nodes[k]
        if node.tag == "#text":
            node.runs, node.marks = 1, sum(map(node.text.count, ".,;!?"))
        if node.parent >= 0:
            up = nodes[node.parent]
            up.chars += node.chars
            up.linked += node.linked
            up.runs += node.runs
            up.marks += node.marks
            up.paragraphs += node.paragraphs + (node.tag == "p")
    total = max(1, nodes[0].chars)
    out = np.zeros((len(nodes), 3 * len(NAME_TOKENS) + 2 * len(TAGS) + 16), dtype=np.float32)
    lines = len(NAME_TOKENS)
    above: list[tuple[frozenset[int], frozenset[int]]] = []
    order = 0
    for k, node in enumerate(nodes):
        if node.parent >= 0:
            names, tags = above[node.parent]
            up = nodes[node.parent]
            siblings, place = len(up.children), node.place
        else:
            names, tags, up, siblings, place = frozenset(), frozenset(), node, 1, 0
        own = {node.tag, *(["#ended" if node.ended else "#unended"] if node.tag in EMBEDDED else [])}
        numbers = {_TAG_NUMBER[t] for t in own if t in _TAG_NUMBER}
        row = out[k]
        for t in node.tokens:
            row[t] = 1
        for t in names:
            row[lines + t] = 1
        for t in numbers:
            row[3 * lines + t] = 1
        for t in tags:
            row[3 * lines + len(TAGS) + t] = 1
        row[-16:] = (
            node.depth, siblings, place / siblings, node.chars, node.chars / total, node.linked / max(1, node.chars),
            node.runs, node.chars / max(1, node.runs), node.marks / max(1, node.chars) * 100, node.paragraphs,
            up.chars / total, up.chars / max(1, up.runs), up.linked / max(1, up.chars), up.paragraphs,
            order / max(1, nodes[0].runs), len(node.children),
        )
        order += node.tag == "#text"
        above.append((names | node.tokens, tags | numbers))
    return out


@dataclass(frozen=True)
class Trees:
    """Boosted trees of one depth, kept as arrays: split features, thresholds, leaf values."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - (2**DEPTH - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting on log loss with histogram splits."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    n, m = x.shape
    rate = y.mean()
    base = float(np.log(rate / (1 - rate)))
    margin = np.full(n, base)
    features_, thresholds, values = [], [], []
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    column = np.arange(m) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p) + 1e-6
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(n, dtype=np.int64)
        for depth in range(DEPTH):
            first = 2**depth - 1
            for node in range(first, 2 * first + 1):
                rows = np.flatnonzero(at == node)
                if rows.size < 2 * MIN_LEAF:
                    continue
                cells = (binned[rows] + column).ravel()
                sums = [
                    np.bincount(cells, weights=np.repeat(w, m), minlength=m * BINS).reshape(m, BINS)
                    for w in (g[rows], h[rows], np.ones(rows.size))
                ]
                (gl, hl, nl) = (np.cumsum(s, axis=1)[:, :-1] for s in sums)
                gt, ht = g[rows].sum(), h[rows].sum()
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(nl < MIN_LEAF) | (rows.size - nl < MIN_LEAF)] = -1
                f, b = divmod(int(gain.argmax()), BINS - 1)
                if gain[f, b] > 1e-6 and b < len(cuts[f]):
                    feature[node], threshold[node] = f, cuts[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - inner
        value = -RATE * np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + 1)
        margin += value[leaf]
        features_.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features_), np.array(thresholds), np.array(values), base)


def decode(nodes: list[Node], margin: np.ndarray) -> list[bool]:
    """The likeliest choices in which every kept node's ancestors are kept, too.

    With ``margin`` the log odds of "kept", a subtree is worth its root's margin
    and what its children are worth, or nothing when it is dropped whole."""
    worth = [0.0] * len(nodes)
    for k in range(len(nodes) - 1, 0, -1):
        worth[k] += float(margin[k])
        if worth[k] > 0:
            worth[nodes[k].parent] += worth[k]
    kept = [True] * len(nodes)
    for k in range(1, len(nodes)):
        kept[k] = kept[nodes[k].parent] and worth[k] > 0
    return kept


def main_text(nodes: list[Node], margin: np.ndarray) -> str:
    kept = decode(nodes, margin)
    parts: list[str] = []
    gap = 0
    for node, keep in zip(nodes, kept, strict=True):
        if node.tag == "#text":
            gap = max(gap, node.gap)
            if keep:
                parts += [_GAPS[gap] if parts else "", node.text]
                gap = 0
    return "".join(parts)


def training_page(rnd: random.Random) -> tuple[str, set[str]]:
    """A page of random words and layout, and the lines of its main part."""
    serial = iter(range(10_000))

    def words(low: int, high: int) -> str:
        made = ["".join(rnd.choice("aeioulnrstmd") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(low, high))]
        made = [w + (rnd.choice([",", ".", ". "]) if rnd.random() < 0.15 else "") for w in made]
        return (" ".join(made) + f" {next(serial)}x").strip()

    main: set[str] = set()

    def block(tag: str, text: str, good: bool) -> str:
        if good:
            main.add(_SPACE.sub(" ", html.unescape(text)).strip())
        inner = html.escape(text)
        style = rnd.random()
        if rnd.random() < 0.08:
            left, _, right = text.partition(" ")
            inner = f"{html.escape(left)} {inside(html.escape(right), good)}"
        elif style < 0.15:
            inner = f"<b>{inner}</b>"
        elif style < 0.22:
            inner = f"<b>{inner}<br>"  # never closed
        return f"<{tag}>{inner}</{tag}>" if rnd.random() < 0.9 or tag not in ("p", "li") else f"<{tag}>{inner}"

    def inside(rest: str, good: bool) -> str:
        """An embedded element before ``rest``, or a formula around its first word."""
        kind = rnd.randrange(4)
        if kind == 0:
            return rnd.choice(['<svg class="icon"/>', '<svg><path d="M0 0"/></svg>', "<canvas></canvas>", "<video src='v'/>"]) + f" {rest}"
        if kind == 1 and good:
            first, _, last = rest.partition(" ")
            return f"<math><mi>{first}</mi></math> {last}"
        return f"{closed(False)} {rest}"

    def closed(blocks: bool = True) -> str:
        """An embedded element with text that is not the page's: what a browser shows in its stead, labels, choices."""
        text = words(1, 12)
        kind = rnd.choice(EMBEDDED)
        if kind == "select":
            return "<select>" + "".join(f"<option>{words(1, 2)}</option>" for _ in range(rnd.randint(1, 5))) + "</select>"
        if kind in FOREIGN:
            return f"<svg class='chart'><g><text x='1'>{text}</text><path d='M0 0'/></g></svg>"
        return f"<{kind}>{block('p', text, False) if blocks and rnd.random() < 0.5 else text}</{kind}>"

    def links(low: int, high: int) -> str:
        each = [f'<li><a href="/{next(serial)}">{words(1, 3)}</a></li>' for _ in range(rnd.randint(low, high))]
        return "<ul>" + "".join(each) + "</ul>"

    def named(name: str, body: str, tags: tuple[str, ...] = ("div", "section")) -> str:
        how = rnd.choice(["class", "id"])
        return f'<{(t := rnd.choice(tags))} {how}="{name}">{body}</{t}>'

    def boiler() -> str:
        kind = rnd.randrange(10)
        text = words(3, 45)
        if kind == 0:
            return f"<nav>{links(3, 9)}</nav>" if rnd.random() < 0.6 else named(rnd.choice(["menu", "site-nav", "breadcrumbs"]), links(2, 8))
        if kind == 1:
            return f"<header>{block('h1', words(1, 5), False)}{links(0, 5)}</header>" if rnd.random() < 0.6 else named("masthead", block("p", text, False))
        if kind == 2:
            return f"<footer>&copy; {text}</footer>" if rnd.random() < 0.7 else named("footer", block("p", text, False))
        if kind == 3:
            return f"<aside>{block('p', text, False)}{links(1, 5)}</aside>" if rnd.random() < 0.6 else named("sidebar", block("p", text, False) + links(1, 6))
        if kind == 4:
            return named(rnd.choice(["ad", "advert", "sponsored", "ad-banner", "promo"]), text if rnd.random() < 0.6 else block("p", text, False))
        if kind == 5:
            return named(rnd.choice(["cookie-notice", "consent", "newsletter", "notice"]), block("p", text, False))
        if kind == 6:
            many = "".join(named("comment", block("p", words(4, 60), False), ("div", "li")) for _ in range(rnd.randint(1, 5)))
            return named("comments", block("h3", words(1, 3), False) + many)
        if kind == 7:
            return f'<form action="/s">{words(1, 4)}<input name="q"><button>{words(1, 1)}</button></form>'
        if kind == 8:
            return closed() if rnd.random() < 0.7 else named(rnd.choice(["menu", "sidebar", "promo", "widget"]), closed() + block("p", text, False))
        return f"<script>var t='{text}</p>';</script><style>p{{margin:0}}</style><!-- {text} -->"

    tops = [boiler() for _ in range(rnd.randint(1, 4))]
    tails = [boiler() for _ in range(rnd.randint(1, 5))]
    body = [block("h1", words(2, 14), True)] if rnd.random() < 0.85 else []
    for _ in range(rnd.choice([0, 1, 1, 2, 3, 5, 8, 13])):
        kind = rnd.random()
        if kind < 0.78:
            body.append(block("p", words(1, 120), True))
        elif kind < 0.86:
            body.append(block(rnd.choice(["h2", "h3"]), words(1, 8), True))
        elif kind < 0.92:
            body.append("<ul>" + "".join(block("li", words(2, 20), True) for _ in range(rnd.randint(1, 5))) + "</ul>")
        elif kind < 0.96:
            body.append(f"<blockquote>{block('p', words(5, 40), True)}</blockquote>")
        else:
            body.append(boiler() if rnd.random() < 0.7 else block("pre", words(5, 40), True))
    if not main:
        body.append(block("p", words(2, 30), True))
    embedded = rnd.random()
    place = rnd.randint(0, len(body))
    if embedded < 0.1:
        body.insert(place, closed())
    elif embedded < 0.2:  # text that has no other place
        kind = rnd.choice(["math", "noscript", "object"])
        text = block("p", words(20, 80), True) if kind != "math" else words(2, 12)
        if kind == "math":
            main.add(text)
        body.insert(place, f"<{kind}>{text}</{kind}>" if kind != "math" else f"<div><math display='block'><mrow>{text}</mrow></math></div>")
    elif embedded < 0.32:  # never closed: the rest of the article is in it
        if place == len(body):
            body.append(block("p", words(5, 60), True))
        body.insert(place, f"<{rnd.choice(EMBEDDED)} class='{rnd.choice(['x', 'player', 'wide'])}'>")
    article = "".join(body)
    wrap = rnd.random()
    if wrap < 0.3:
        article = f"<article>{article}</article>"
    elif wrap < 0.4:
        article = f"<main>{article}</main>"
    elif wrap < 0.55:
        article = named(rnd.choice(["content", "post-body", "entry", "articleBody", "mainContent", "story"]), article)
    elif wrap < 0.75:  # containers that tell nothing
        kind = rnd.choice(["div", "section", "td"])
        name = rnd.choice(["", "", " class='container'", " class='row'", " class='col-8'", " id='wrapper'", " class='x1'", " class='inner box'"])
        article = f"<{kind}{name}>{article}</{kind}>"
        if kind == "td":
            cell = f"<td>{boiler()}</td>" if rnd.random() < 0.6 else ""
            article = f"<table><tr>{cell}{article}</tr></table>"
    if rnd.random() < 0.3:
        article = f"<div>{article}</div>"
    page = "".join(tops) + article + "".join(tails)
    if rnd.random() < 0.25:  # around everything, whatever its name says
        page = named(rnd.choice(["page", "container", "wrapper", "main", "site", "content"]), page)
    end = "</body></html>" if rnd.random() < 0.9 else ""
    return f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title></head><body>{page}{end}", main


def labelled_pages(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rnd = random.Random(seed)
    xs, ys = [], []
    for _ in range(n):
        page, main = training_page(rnd)
        nodes = parse(page)
        lines = "\n".join(main)  # a run may be a part of one
        good = [node.tag == "#text" and node.text in lines for node in nodes]
        for k in range(len(nodes) - 1, 0, -1):
            good[nodes[k].parent] |= good[k]
        xs.append(features(nodes))
        ys.append(good)
    return np.concatenate(xs), np.concatenate(ys).astype(np.float64)


def train(n_pages: int = TRAINING_PAGES, seed: int = 11) -> Trees:
    return fit(*labelled_pages(n_pages, seed))


def extract(pages: DataFrame, model: Trees, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with ``text_col``, the main text, empty where there is none.

    Every row comes back with its other columns (one named ``text_col`` is
    replaced).  Null and empty pages, and pages without markup that the model
    takes for main text, give an empty text; broken markup is read as far as it
    goes; repeated rows give the same text; an empty table gives an empty one.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in pages.columns if c.lower() != text_col.lower()]
    (html_,) = fresh(pages, "page_html")
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField(text_col, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, at, size = 0, 0, 0
            trees: list[list[Node]] = []
            rows: list[np.ndarray] = []
            for page in batch.column(len(keep)):
                trees.append(parse(page.as_py() or ""))
                rows.append(features(trees[-1]))
                at += 1
                size += len(rows[-1])
                if size >= BATCH_NODES or at == batch.num_rows:
                    margin = np.split(shared.value.margin(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
                    texts = [main_text(t, m) for t, m in zip(trees, margin, strict=True)]
                    own = batch.slice(done, at - done)
                    yield pa.RecordBatch.from_arrays([*own.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, text_col])
                    done, size, trees, rows = at, 0, [], []

    return pages.select(*[col(c) for c in keep], col(html_col).alias(html_)).mapInArrow(run, schema)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = extract(pages, train())
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
