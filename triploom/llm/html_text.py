"""Main text of web pages: gradient-boosted trees over DOM-node features and
hierarchical decoding.

A page is read into a tree of its block-level elements (inline elements
belong to the block around them). Every node gets features: text and link
density of its subtree, share of the page's text, tag kind, kinds of tokens
in its own and its ancestors' class, id and role attributes, depth, place
among its siblings and how much they look like it. Gradient-boosted trees
give each node the log-odds of holding main text. Decoding picks the
labelling of the whole tree with the greatest sum of log-odds in which a
node is main text only if its parent is, so no kept node lies in a rejected
one and no rejected one around a kept one.

The trees are trained on a bounded sample of the pages (``sample_pages``,
drawn by a hash of the id). Pages whose markup says where the article is
teach directly; their texts are also set into other layouts (containers
named by class or id only; menus, sidebars, notices, forms, comments and
adverts, around and inside the article), so that the trees learn to do
without the semantic tags.

The text: character references are decoded, white space in a block becomes
one space, empty blocks go, and blocks are joined in page order by an empty
line. Script, style and other unshown elements have no text; they nest and
end like shown ones. (What is only hidden from screen readers is shown.)

Defined results: null and empty pages, and pages without main text, give an
empty text; broken markup (open tags, open quotes, cut references) is read
to the end as a browser would; a page of any length is read whole; repeated
rows are rows; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 300
PAGES_AT_ONCE = 100
ROUNDS, LEAVES_DEPTH, RATE, BINS = 40, 4, 0.25, 32

# Element kinds of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DRAWINGS = ("svg", "math")
RAW = frozenset("script style noscript iframe textarea title".split())   # to the own end tag
UNSHOWN = frozenset("template svg math object canvas select".split())
# ends are not implied, end tags not sought beyond these
SCOPES = frozenset("template svg math object select".split())
BLOCK = frozenset("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav "
                  "header footer aside form fieldset table thead tbody tfoot tr td th caption "
                  "figure figcaption blockquote pre address details summary dialog center "
                  "button label menu".split())
CLOSES_P = BLOCK - {"button", "label", "html", "body"}
# an element of the key closes open ones of the value, up to a container
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}}
CONTAINERS = frozenset("ul ol dl table tbody thead tfoot menu".split())
# kinds of tokens in attributes, by the beginning of the token
TOKENS = {
    "good": "article content main post entry story text body page blog news read".split(),
    "nav": "nav menu breadcrumb crumb toc pager pagination tab links skip".split(),
    "side": "side sidebar aside widget related recommend more popular trending teaser tag "
            "rail complementary".split(),
    "edge": "foot footer bottom copyright legal head header masthead top banner logo "
            "contentinfo site".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion affiliate "
          "commercial outbrain".split(),
    "notice": "notice cookie consent gdpr alert popup modal overlay newsletter subscribe "
              "signup paywall warning message toast".split(),
    "talk": "comment comments reply replies discussion disqus respond feedback review "
            "reviews thread".split(),
    "form": "form search login input share social button follow like".split(),
    "unread": [],   # hidden from screen readers
}
KIND_OF_TOKEN = {t: k for k, ts in TOKENS.items() for t in ts}
TAG_KINDS = {"article": ("article", "main"), "p": ("p", "blockquote", "pre"),
             "heading": ("h1", "h2", "h3", "h4", "h5", "h6"), "list": ("ul", "ol", "dl", "menu"),
             "item": ("li", "dt", "dd"), "div": ("div", "center"), "section": ("section",),
             "nav": ("nav",), "edge": ("header", "footer", "address"), "aside": ("aside",),
             "form": ("form", "fieldset", "button", "label", "dialog"),
             "table": ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"),
             "figure": ("figure", "figcaption", "details", "summary"),
             "root": ("html", "body")}
KIND_OF_TAG = {t: k for k, ts in TAG_KINDS.items() for t in ts}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*"
                   r"(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")
_DIGIT = re.compile("[0-9]")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: tuple = ()
    children: list = field(default_factory=list)
    parts: list = field(default_factory=list)   # own text runs and child places
    links: int = 0                              # characters of own text in links


def _tokens(attrs: str) -> tuple[tuple, bool]:
    """Kinds of the attribute tokens, and whether the element is hidden."""
    if not attrs or attrs.isspace():
        return (), False
    kinds, hidden = [], False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("class", "id", "role"):
            for w in _WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value)):
                kind = KIND_OF_TOKEN.get(w.lower())
                if kind:
                    kinds.append(kind)
        elif name == "hidden":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif value.lower() == "true":
            kinds.append("unread")
    return tuple(kinds), hidden


def read_page(page: str | None) -> list[Node]:
    """The block-level nodes of a page, parents first; node 0 is the root."""
    nodes = [Node("html", -1, 0)]
    if not page:
        return nodes
    # open elements, their nodes and whether they are shown; what isn't shown
    # nests and ends like the rest but makes no nodes
    open_: list[tuple[str, int, bool]] = [("html", 0, True)]
    at, links = 0, 0

    def text(raw: str) -> None:
        if raw and open_[-1][2]:
            own = nodes[open_[-1][1]]
            said = html.unescape(raw) if "&" in raw else raw
            own.parts.append(said)
            if links:
                own.links += len(said)

    def close(to: int) -> None:
        nonlocal links
        for tag, _, _ in open_[to:]:
            links -= tag == "a"
        del open_[to:]

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        end = bool(m[1] or m[4])
        if end:
            if tag in ("html", "body"):
                continue
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == tag:
                    close(k)
                    break
                if open_[k][0] in SCOPES and open_[k][0] != "select":
                    break
            else:
                if tag == "p" and open_[-1][2]:
                    nodes[open_[-1][1]].parts.append(None)
            continue
        if tag == "br" or tag == "hr":
            if open_[-1][2]:
                nodes[open_[-1][1]].parts.append("\n")
            continue
        attrs = m[3] if m[3] is not None else m[6]
        if tag in VOID:
            continue
        # a slash at the end closes an element of a drawing, no other
        if attrs.rstrip().endswith("/") and (tag in DRAWINGS or any(
                o[0] in DRAWINGS for o in open_)):
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        kinds, hidden = _tokens(attrs)
        if tag == "html" or tag == "head":   # what a head shows by mistake is body text
            continue
        for k in range(len(open_) - 1, 0, -1):   # drawings hold no such element
            if tag not in BLOCK or open_[k][0] in BLOCK or open_[k][0] == "foreignobject":
                break
            if open_[k][0] in ("svg", "math"):
                close(k)
                break
        if tag in CLOSES_P:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k][0] == "p":
                    close(k)
                    break
                if open_[k][0] in BLOCK or open_[k][0] in SCOPES:
                    break
        for k in range(len(open_) - 1, 0, -1):
            if tag in CLOSES and open_[k][0] in CLOSES[tag]:
                close(k)
                break
            if open_[k][0] in CONTAINERS or open_[k][0] in SCOPES:
                break
        if hidden or tag in UNSHOWN or not open_[-1][2]:
            links += tag == "a"
            open_.append((tag, open_[-1][1], False))
        elif tag in BLOCK:
            parent = open_[-1][1]
            nodes.append(Node(tag, parent, nodes[parent].depth + 1, kinds))
            nodes[parent].children.append(len(nodes) - 1)
            nodes[parent].parts.append(len(nodes) - 1)
            open_.append((tag, len(nodes) - 1, True))
        else:
            links += tag == "a"
            open_.append((tag, open_[-1][1], True))
    text(page[at:])
    return nodes


def _own_blocks(node: Node) -> list:
    """The node's text runs between child blocks (cleaned), and the child
    places, in order."""
    out, run = [], []

    def flush():
        said = _SPACE.sub(" ", "".join(run)).strip()
        run.clear()
        if said:
            out.append(said)

    for p in node.parts:
        if isinstance(p, str):
            run.append(p)
        else:
            flush()
            if p is not None:
                out.append(p)
    flush()
    return out


KINDS = list(TOKENS)
FEATURES = (["depth", "chars", "log_chars", "share", "own_share", "link_density", "density",
             "children", "siblings", "place", "same_tag", "sibling_chars", "sibling_links",
             "marks", "words", "digits"]
            + [f"tag_{k}" for k in TAG_KINDS] + [f"own_{k}" for k in KINDS]
            + [f"above_{k}" for k in KINDS] + ["above_article", "above_nav", "above_edge",
                                               "above_aside", "above_form", "below_article"])


def node_features(nodes: list[Node], blocks: list[list]) -> np.ndarray:
    """One row of FEATURES per node."""
    n = len(nodes)
    own = np.array([sum(len(b) for b in bs if isinstance(b, str)) for bs in blocks], float)
    marks = np.array([sum(b.count(".") + b.count(",") + b.count("!") + b.count("?")
                          for b in bs if isinstance(b, str)) for bs in blocks], float)
    words = np.array([sum(b.count(" ") + 1 for b in bs if isinstance(b, str))
                      for bs in blocks], float)
    chars, size, links = own.copy(), np.ones(n), np.array([v.links for v in nodes], float)
    all_marks, all_words = marks.copy(), words.copy()
    article_below = np.array([v.tag in ("article", "main") for v in nodes], float)
    for k in range(n - 1, 0, -1):
        p = nodes[k].parent
        for a in (chars, size, links, all_marks, all_words):
            a[p] += a[k]
        article_below[p] = max(article_below[p], article_below[k])
    total = max(chars[0], 1.0)
    out = np.zeros((n, len(FEATURES)))
    col = {f: i for i, f in enumerate(FEATURES)}
    first_above = col[f"above_{KINDS[0]}"]
    first_own = col[f"own_{KINDS[0]}"]
    k_n = len(KINDS)
    parent = np.array([max(v.parent, 0) for v in nodes])
    kin = [nodes[p].children or [0] for p in parent]
    out[:, 0] = [v.depth for v in nodes]
    out[:, 1], out[:, 2] = np.minimum(chars, 1e5), np.log1p(chars)
    out[:, 3], out[:, 4] = chars / total, own / np.maximum(chars, 1)
    out[:, 5] = np.minimum(links / np.maximum(chars, 1), 1)
    out[:, 6], out[:, 7] = chars / size, [len(v.children) for v in nodes]
    out[:, 8] = [len(c) for c in kin]
    out[:, 9] = [(k - c[0]) / max(c[-1] - c[0], 1) for k, c in enumerate(kin)]
    out[:, 13], out[:, 14] = all_marks / np.maximum(all_words, 1), np.log1p(all_words)
    out[:, 15] = [sum(len(_DIGIT.findall(b)) for b in bs if isinstance(b, str))
                  for bs in blocks] / np.maximum(own, 1)
    for k, v in enumerate(nodes):
        row, p = out[k], v.parent
        row[col["tag_" + KIND_OF_TAG.get(v.tag, "div")]] = 1
        for t in v.tokens:
            row[col["own_" + t]] = 1
        if p >= 0:
            above = out[p]
            row[first_above:first_above + k_n] = np.maximum(
                above[first_above:first_above + k_n], above[first_own:first_own + k_n])
            for f, tags in (("above_article", ("article", "main")), ("above_nav", ("nav",)),
                            ("above_edge", ("header", "footer")), ("above_aside", ("aside",)),
                            ("above_form", ("form", "fieldset"))):
                row[col[f]] = max(above[col[f]], nodes[p].tag in tags)
        row[col["below_article"]] = article_below[k]
        if v.children:   # what the siblings share, once per parent
            c = v.children
            tags: dict[str, int] = {}
            for x in c:
                tags[nodes[x].tag] = tags.get(nodes[x].tag, 0) + 1
            mean, link = chars[c].mean(), links[c].sum() / max(chars[c].sum(), 1)
            for x in c:
                out[x, 10] = tags[nodes[x].tag] / len(c)
                out[x, 11], out[x, 12] = np.log1p(mean), min(link, 1)
    return out


# ---------------------------------------------------------------- trees ---

@dataclass
class Trees:
    """Boosted trees of fixed depth: per tree, the split feature and value of
    its inner nodes in level order, and the values of its leaves."""

    bias: float
    feature: np.ndarray    # trees by inner nodes
    value: np.ndarray
    leaf: np.ndarray       # trees by leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for f, v, leaf in zip(self.feature, self.value, self.leaf):
            at = np.zeros(len(x), np.int64)
            while at[0] < len(f) if len(at) else False:
                at = 2 * at + 1 + (x[rows, f[at]] > v[at])
            out += leaf[at - len(f)] if len(at) else 0
        return out


def train_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS,
                depth: int = LEAVES_DEPTH, rate: float = RATE) -> Trees:
    """Gradient boosting on the logistic loss over binned features."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)], axis=1)
    mean = np.clip((y * weight).sum() / weight.sum(), 0.01, 0.99)
    bias = float(np.log(mean / (1 - mean)))
    f, inner = np.full(len(y), bias), (1 << depth) - 1
    feature, value, leaf = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = (y - p) * weight, p * (1 - p) * weight
        at = np.zeros(len(y), np.int64)
        tf, tv = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            base, n_at = (1 << level) - 1, 1 << level
            best = np.full(n_at, 1e-6)
            for j in range(x.shape[1]):
                if not len(cuts[j]):
                    continue
                b = len(cuts[j]) + 1
                key = (at - base) * b + binned[:, j]
                sg = np.bincount(key, g, n_at * b).reshape(n_at, b)
                sh = np.bincount(key, h, n_at * b).reshape(n_at, b)
                lg, lh = sg.cumsum(1)[:, :-1], sh.cumsum(1)[:, :-1]
                tg, th = sg.sum(1, keepdims=True), sh.sum(1, keepdims=True)
                gain = lg**2 / (lh + 1) + (tg - lg)**2 / (th - lh + 1) - tg**2 / (th + 1)
                k = gain.argmax(1)
                top = gain[np.arange(n_at), k]
                better = top > best
                best[better] = top[better]
                tf[base:base + n_at][better] = j
                tv[base:base + n_at][better] = cuts[j][k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), tf[at]] > tv[at])
        at -= inner
        sg, sh = np.bincount(at, g, inner + 1), np.bincount(at, h, inner + 1)
        values = rate * sg / (sh + 1)
        f += values[at]
        feature.append(tf)
        value.append(tv)
        leaf.append(values)
    return Trees(bias, np.array(feature), np.array(value), np.array(leaf))


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """The best labelling in which main text lies in main text only."""
    best = odds.copy()
    for k in range(len(nodes) - 1, 0, -1):
        best[nodes[k].parent] += max(best[k], 0.0)
    keep = np.zeros(len(nodes), bool)
    for k, v in enumerate(nodes):
        keep[k] = best[k] > 0 and (v.parent < 0 or keep[v.parent])
    return keep


def _kept_text(blocks: list[list], keep: np.ndarray) -> str:
    out: list[str] = []
    stack = [iter(blocks[0])] if keep[0] else []
    while stack:
        for b in stack[-1]:
            if isinstance(b, str):
                out.append(b)
            elif keep[b]:
                stack.append(iter(blocks[b]))
                break
        else:
            stack.pop()
    return "\n\n".join(out)


def main_texts(pages: list[str | None], trees: Trees) -> list[str]:
    """The main text of each page; the trees score all their nodes at once."""
    read = []
    for page in pages:
        nodes = read_page(page)
        blocks = [_own_blocks(v) for v in nodes]
        read.append((nodes, blocks, node_features(nodes, blocks)))
    odds = trees.score(np.concatenate([x for _, _, x in read])) if read else np.empty(0)
    out, at = [], 0
    for nodes, blocks, _ in read:
        own = odds[at:at + len(nodes)]
        at += len(nodes)
        out.append(_kept_text(blocks, decode(nodes, own)))
    return out


def main_text(page: str | None, trees: Trees) -> str:
    return main_texts([page], trees)[0]


# ------------------------------------------------------------- training ---

MAIN, OTHER, EITHER = 1, 0, -1


def _stated(nodes: list[Node]) -> np.ndarray | None:
    """Labels of a page whose markup names its article: what is in it (but
    for parts that are marked otherwise) and around it is main, the rest
    isn't. None if there is no such element."""
    said = [v.tag in ("article", "main") for v in nodes]
    if not any(said):
        return None
    bad_tags = {"nav", "footer", "aside", "form", "button", "header"}
    bad_kinds = {"nav", "side", "ad", "notice", "talk", "form", "edge"}
    label = np.zeros(len(nodes), np.int64)
    for k, v in enumerate(nodes):
        odd = v.tag in bad_tags or (bad_kinds & set(v.tokens) and not said[k])
        inside = v.parent >= 0 and label[v.parent] == MAIN and (
            said[v.parent] or nodes[v.parent].tag not in ("html", "body"))
        label[k] = MAIN if (said[k] or inside) and not odd else OTHER
    for k in range(len(nodes) - 1, 0, -1):   # the way down to the article
        if label[k] == MAIN:
            label[nodes[k].parent] = MAIN
    return label


def _texts(nodes: list[Node], label: np.ndarray) -> tuple[list[str], list[str]]:
    """Blocks of main text and of other text."""
    main, other = [], []
    for k, v in enumerate(nodes):
        said = [b for b in _own_blocks(v) if isinstance(b, str)]
        (main if label[k] == MAIN else other).extend(said)
    return main, other


def _layout(main: list[str], other: list[str], strange: list[str], rng) -> str:
    """A page in another layout; elements that hold no main text carry the
    mark data-x, which training reads and the features don't."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    esc = html.escape
    some = lambda xs, n: [esc(pick(xs)) for _ in range(n)] if xs else []
    word = lambda: esc(pick(other)[:int(rng.integers(8, 40))]) if other else "more"

    def attr(kind: str) -> str:
        name = pick(TOKENS[kind])
        full = pick([name, f"{name}-{pick(['box', 'wrap', 'area', 'block', 'inner'])}",
                     f"{pick(['site', 'page', 'c', 'block', 'post'])}-{name}", f"{name}s"])
        return f' {pick(["class", "class", "id"])}="{full}"'

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{k}">{word()}</a></li>' for k in range(n)) + "</ul>"

    def paragraphs(xs: list[str]) -> str:
        return "".join(f"<p>{x}</p>" for x in xs)

    def extra(kind: str) -> str:
        n = int(rng.integers(1, 5))
        if kind == "nav":
            return pick([f'<nav data-x>{links(n + 2)}</nav>',
                         f'<div{attr("nav")} data-x>{links(n + 2)}</div>'])
        if kind == "side":
            tag = pick(["aside", "div", "section"])
            inner = pick([links(n), f"<h3>{word()}</h3>{paragraphs(some(strange, n))}",
                          f"<h2>{word()}</h2>{links(n + 1)}"])
            return f'<{tag}{attr("side")} data-x>{inner}</{tag}>'
        if kind == "ad":
            return f'<div{attr("ad")} data-x>{pick([word(), *some(strange, 1)])}</div>'
        if kind == "notice":
            return (f'<div{attr("notice")} data-x><p>{pick([word(), *some(strange, 1)])}</p>'
                    f'<button>{word()}</button></div>')
        if kind == "talk":
            tag = pick(["div", "section", "ol"])
            item = "li" if tag == "ol" else "div"
            rows = "".join(f'<{item} class="{pick(["comment", "reply", "comment-body"])}">'
                           f'<b>{word()}</b>{paragraphs(some(strange, int(rng.integers(1, 3))))}'
                           f'</{item}>' for _ in range(n))
            return f'<{tag}{attr("talk")} data-x><h3>{word()}</h3>{rows}</{tag}>'
        if kind == "form":
            return pick([f'<form data-x><label>{word()}</label><input><button>{word()}</button>'
                         f'</form>', f'<div{attr("form")} data-x>{links(2)}</div>'])
        edge = pick(["header", "footer", "div"])
        inner = pick([word(), f"&copy; {word()}", f"<p>{word()}</p>{links(n)}",
                      f"<h1>{word()}</h1>"])
        return f'<{edge}{attr("edge") if edge == "div" else ""} data-x>{inner}</{edge}>'

    def block(x: str) -> str:
        form = int(rng.integers(10))
        x = esc(x)
        if form < 6:
            return f"<p>{x}</p>"
        if form == 6:
            return f"<h2>{x[:60]}</h2><p>{x}</p>"
        if form == 7:
            return "<ul>" + "".join(f"<li>{s}</li>" for s in x.split(". ")) + "</ul>"
        if form == 8:
            return f"<blockquote><p>{x}</p></blockquote>"
        return f"<div><p>{x}<br><p><b>{x[:40]}</div>"

    # articles, titles and blocks of any length, very short ones among them
    cut = lambda x: x[:int(pick([8, 15, 30, 80, 300, 10**6]))].strip() or x
    main = [cut(x) if rng.random() < 0.3 else x
            for x in main[:int(pick([1, 2, 4, 8, 12]))]]
    body = [f"<h1>{esc(main[0][:int(rng.integers(5, 90))])}</h1>"] + [block(x) for x in main]
    for kind in ("ad", "form", "side", "nav", "notice"):
        if rng.random() < 0.25:
            body.insert(int(rng.integers(1, len(body) + 1)), extra(kind))
    if rng.random() < 0.2:
        body.append(extra("talk"))
    inner = "".join(body)
    shape = int(rng.integers(5))
    if shape == 0:
        art = f"<article>{inner}</article>"
    elif shape == 1:
        art = f"<main>{inner}</main>"
    elif shape == 2:
        art = f'<div{attr("good")}>{inner}</div>'
    elif shape == 3:
        art = f'<div{attr("good")}><div>{inner}</div></div>'
    else:
        art = f"<div>{inner}</div>"
    before = "".join(extra(k) for k in ("edge", "nav", "notice", "ad") if rng.random() < 0.6)
    after = "".join(extra(k) for k in ("talk", "side", "form", "ad", "edge")
                    if rng.random() < 0.6)
    return f"<html><body>{before}{art}{after}</body></html>"


def training_rows(pages: list[str], seed: int = 11, layouts: int = 3):
    """(features, labels, weights) from sampled pages and other layouts of
    their texts."""
    rng = np.random.default_rng(seed)
    read = [(n, _stated(n)) for n in map(read_page, pages)]
    stated = [(n, y) for n, y in read if y is not None]
    texts = [_texts(n, y) for n, y in stated]
    if not texts:   # no page says where its article is: long blocks stand in
        every = [[b for v in n for b in _own_blocks(v) if isinstance(b, str)] for n, _ in read]
        texts = [([b for b in bs if len(b) >= 80], [b for b in bs if len(b) < 80])
                 for bs in every]
    texts = [t for t in texts if t[0]]
    xs, ys, ws = [], [], []

    def add(nodes, label):
        known = label != EITHER
        xs.append(node_features(nodes, [_own_blocks(v) for v in nodes])[known])
        ys.append(label[known])
        ws.append(np.full(int(known.sum()), 1.0 / max(known.sum(), 1)))

    for nodes, label in stated:
        add(nodes, label)
    for k, (main, other) in enumerate(texts):
        strange = texts[(k + 1) % len(texts)][0]
        for _ in range(layouts):
            page = _layout(main, other, strange, rng)
            nodes = read_page(page.replace(" data-x>", f' role="{_MARK}">'))
            label = np.ones(len(nodes), np.int64)
            for i, v in enumerate(nodes):
                if _MARK in v.tokens or (v.parent >= 0 and label[v.parent] == OTHER):
                    label[i] = OTHER
                v.tokens = tuple(t for t in v.tokens if t != _MARK)
            add(nodes, label)
    if not xs:
        return np.zeros((0, len(FEATURES))), np.zeros(0), np.zeros(0)
    return np.concatenate(xs), np.concatenate(ys).astype(float), np.concatenate(ws)


_MARK = "zqnotmain"          # a role that only training layouts have
KIND_OF_TOKEN[_MARK] = _MARK


def train(pages: DataFrame, html_col: str = "html", id_col: str = "page_id",
          sample_pages: int = SAMPLE_PAGES) -> Trees | None:
    """Trees from the sampled pages; None if there is nothing to learn."""
    draws = pages.filter(F.col(html_col).isNotNull()).select(
        F.xxhash64(id_col).alias("draw"), F.col(html_col).alias("html"))
    # the sample's largest draw first, from the ids alone: no page travels
    # to the driver that isn't in the sample
    last = draws.select("draw").orderBy("draw").limit(sample_pages).agg(F.max("draw")).first()[0]
    if last is None:
        return None
    drawn = draws.filter(F.col("draw") <= last).limit(2 * sample_pages).collect()
    x, y, w = training_rows([r["html"] for r in sorted(drawn)])
    if not len(y) or y.min() == y.max():
        return None
    return train_trees(x, y, w / w.mean())


def extract_text(pages: DataFrame, trees: Trees | None, html_col: str = "html",
                 text_col: str = "text") -> DataFrame:
    """``pages`` with the main text; the trees' size is fixed."""
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("string")
    def text_of(pages: pd.Series) -> pd.Series:
        own, out = shared.value, []
        for k in range(0, len(pages), PAGES_AT_ONCE):
            some = list(pages[k:k + PAGES_AT_ONCE])
            out += [""] * len(some) if own is None else main_texts(some, own)
        return pd.Series(out, dtype=object)

    return pages.withColumn(text_col, text_of(F.col(html_col).cast("string")))
