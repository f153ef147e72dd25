"""Main text of web pages from a tree-structured graphical model over DOM nodes.

The nodes are a page's block elements and, as leaves, the runs of text between block boundaries. Each has a hidden
state, content or not; its measures give a node potential, and every parent-child pair a potential of their two
states (one table for pairs of elements, one for an element and its text). Messages go up from the leaves and down
from the root once (sum-product, exact on a tree); a run of text whose marginal is at least one half is content.
Node weights and pair potentials are fitted together by maximum conditional likelihood on labelled pages.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, slices

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Text inside these is never shown as part of a page.
RAW = frozenset("script style title template noscript iframe svg math object audio video canvas textarea".split())
#: Of these, elements that a slash ends in their tag; all of HTML's own stay open.
FOREIGN = frozenset("svg math".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table body html article section div aside nav main form".split())

#: Groups of tags with a weight each.
TAGS = {t: k for k, names in enumerate(("article main", "nav menu", "header", "footer", "aside", "form fieldset button select option legend input", "p blockquote pre", "h1 h2 h3 h4 h5 h6", "li ul ol dl dt dd", "table tbody thead tr td th caption", "div section", "body html", "figure figcaption", "dialog")) for t in names.split()}
N_TAGS = 15
#: Groups of words in class, id and role attributes with a weight each.
HINTS = {
    w: k
    for k, names in enumerate(
        (
            "article content contents post entry story main body text prose",
            "nav navigation navbar menu breadcrumb breadcrumbs toc pagination pager tabs",
            "header masthead topbar branding hero",
            "footer foot bottom colophon copyright",
            "sidebar aside side rail widget widgets related recommended trending popular",
            "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion",
            "cookie cookies consent notice notices alert gdpr warning popup modal overlay disclaimer",
            "form login signup signin subscribe newsletter search register",
            "comment comments commentlist reply replies discussion discuss disqus respond reader readers",
            "share sharing social follow tags meta byline",
        )
    )
    for w in names.split()
}
N_HINTS = 10
N_FEATURES = N_TAGS + N_HINTS + 9

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTR = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_MARK = re.compile(r"""data-content\s*=\s*"([01])\"""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Page:
    """Nodes in page order, parents before children. kind 1: a run of text."""

    parent: list[int]
    depth: list[int]
    kind: list[int]
    feats: list[tuple[list[int], tuple[float, ...]]]
    label: list[int]
    texts: list[str]  # of the runs, in order


def tags(text: str, resume: list[int]) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it closes, attributes) of each tag; comments and declarations have no name. What is to
    be left out before the next tag is said in resume, a list of one place. A tag ends at
    the first > outside quotes, or, if there is none, at the first one. Where none is left, the rest is text; a comment that
    isn't closed takes the rest. Time is linear but for texts made to have very many quotes that never balance."""
    last = {c: text.rfind(c) for c in ">\"'"}
    lost: set[int] = set()  # places from which no > outside quotes is reached

    def end_of(lt: int, i: int) -> int:
        if lt in lost:
            return -1
        free = []
        while stop := _STOP.search(text, i):
            c, k = stop[0], stop.start()
            free.append((i, k))
            if c == ">":
                return k
            if k == last[c]:
                break
            i = text.find(c, k + 1) + 1
        else:
            free.append((i, len(text)))
        for x, y in free:
            while (x := text.find("<", x, y)) >= 0:
                lost.add(x)
                x += 1
        return -1

    at = 0
    while (lt := text.find("<", max(at, resume[0]))) >= 0:
        if lt > last[">"]:
            lt = text.find("<!--", lt)
            if lt >= 0:
                yield lt, len(text), "", False, ""
            return
        if text.startswith("<!--", lt):
            e = text.find("-->", lt + 4)
            at = e + 3 if e >= 0 else len(text)
            yield lt, at, "", False, ""
        elif text[lt + 1] in "!?":
            at = text.find(">", lt) + 1
            yield lt, at, "", False, ""
        elif m := _NAME.match(text, lt):
            if m.end() > last[">"]:
                at = lt + 1
                continue
            e = end_of(lt, m.end())
            e = e if e >= 0 else text.find(">", m.end())
            at = e + 1
            yield lt, at, m[1].lower(), text[lt + 1] == "/", text[m.end() : e]
        else:
            at = lt + 1


@lru_cache(65536)
def _hints(attrs: str) -> tuple[int, ...]:
    out = set()
    for a, b, c in _ATTR.findall(attrs):
        for w in _WORD.findall(a or b or c):
            if (k := HINTS.get(w.lower())) is not None:
                out.add(N_TAGS + k)
    return tuple(sorted(out))


def parse(text: str) -> Page:
    """The page's block tree. Unclosed and stray tags are taken as browsers roughly do; nothing fails."""
    page = Page([], [], [], [], [], [])
    stack: list[tuple[str, int]] = []
    mark = [-1]
    open_: Counter[str] = Counter()  # names on the stack
    buf: list[str] = []
    linked, a_open = 0, 0

    def node(kind: int, idx: list[int], dense: tuple[float, ...], label: int) -> int:
        page.parent.append(stack[-1][1] if stack else -1)
        page.depth.append(len(stack) if not stack or page.parent[-1] >= 0 else 0)
        page.kind.append(kind)
        page.feats.append((idx, dense))
        page.label.append(label)
        return len(page.parent) - 1

    def flush() -> None:
        nonlocal linked
        s = " ".join(_html.unescape("".join(buf)).split())
        buf.clear()
        if s:
            if not stack:
                stack.append(("html", node(0, [TAGS["html"]], (0.0,) * 5, -1)))
                open_["html"] += 1
                mark.append(-1)
            n = len(s)
            words = s.count(" ") + 1
            idx = [TAGS.get(stack[-1][0], N_TAGS - 1)]
            node(1, idx, (min(n, 400) / 100, min(linked / n, 1.0), float(s[-1] in ".!?:;\"'"), min(words, 60) / 20, 1.0), mark[-1])
            page.texts.append(s)
        linked = 0

    def close(k: int) -> None:
        for x, _ in stack[k:]:
            open_[x] -= 1
        del stack[k:]
        del mark[k + 1 :]

    at, resume = 0, [0]
    for start, stop, name, end, attrs in chain(tags(text, resume), ((len(text), len(text), "", False, ""),)):
        if start > at:
            piece = text[at:start]
            buf.append(piece)
            if a_open:
                linked += len(piece.strip())
        at = stop
        if not name:
            continue
        if name in RAW:
            if not end and not (name in FOREIGN and attrs.endswith("/")):
                over = re.compile(rf"</{re.escape(name)}\b", re.I).search(text, at)
                gt = text.find(">", over.end()) if over else -1
                at = resume[0] = gt + 1 if gt >= 0 else len(text)
            if name in ("title", "noscript", "template", "textarea"):
                flush()
            continue
        if name in INLINE:
            if name == "a":
                a_open = 0 if end else 1
            continue
        if name == "br":
            buf.append(" ")
            continue
        flush()
        a_open = 0
        if name in VOID:
            continue
        if end:
            if open_[name]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if any(open_[x] for x in _CLOSES.get(name, ())):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _CLOSES[name]:
                    close(i)
                    break
                if stack[i][0] in _SCOPE:
                    break
        label = mark[-1]
        if "data-content" in attrs and (x := _MARK.search(attrs)):
            label = int(x[1])
        me = node(0, [TAGS.get(name, N_TAGS - 1), *_hints(attrs)], (0.0,) * 5, label)
        stack.append((name, me))
        open_[name] += 1
        mark.append(label)
    flush()
    return page


def matrix(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Measures, parent (global index, -1: none), depth and kind of all nodes."""
    n = sum(len(p.parent) for p in pages)
    x = np.zeros((n, N_FEATURES), np.float64)
    parent, depth, kind = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    rows: list[int] = []
    cols: list[int] = []
    dense = []
    at = 0
    for p in pages:
        k = len(p.parent)
        q = np.array(p.parent, np.int64)
        parent[at : at + k] = np.where(q >= 0, q + at, -1)
        depth[at : at + k] = p.depth
        kind[at : at + k] = p.kind
        for i, (idx, d) in enumerate(p.feats, at):
            rows += [i] * len(idx)
            cols += idx
            dense.append(d)
        at += k
    x[rows, cols] = 1
    if n:
        x[:, N_TAGS + N_HINTS : N_TAGS + N_HINTS + 5] = dense
        text = kind == 1
        tags = x[text, :N_TAGS]
        x[text, :N_TAGS] = 0  # a run's tag is its element's own matter, but for headings, list items, links and divs
        x[text, N_TAGS + N_HINTS + 5] = tags[:, TAGS["h1"]]
        x[text, N_TAGS + N_HINTS + 6] = tags[:, TAGS["li"]]
        x[text, N_TAGS + N_HINTS + 7] = tags[:, TAGS["p"]]
        x[text, N_TAGS + N_HINTS + 8] = tags[:, TAGS["div"]]
    return x, parent, depth, kind


@dataclass
class Model:
    weights: np.ndarray
    #: Log potentials [pair kind][parent state][child state].
    pair: np.ndarray


def sum_product(unary: np.ndarray, parent: np.ndarray, depth: np.ndarray, kind: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds of every node's marginal; and for each child node its upward belief and its parent's belief without it.

    All messages are log odds. Nodes of a depth go together: from the deepest up, then from the roots down."""
    n = len(unary)
    belief = np.clip(unary, -30, 30).copy()
    up = np.zeros(n)
    pot = np.exp(pair)[kind]
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if n else []
    for level in reversed(levels[1:]):
        e, q = np.exp(np.clip(belief[level], -30, 30)), pot[level]
        up[level] = np.log((e * q[:, 1, 1] + q[:, 1, 0]) / (e * q[:, 0, 1] + q[:, 0, 0]))
        np.add.at(belief, parent[level], up[level])
    below, above = belief.copy(), np.zeros(n)
    for level in levels[1:]:
        above[level] = belief[parent[level]] - up[level]
        e, q = np.exp(np.clip(above[level], -30, 30)), pot[level]
        belief[level] += np.log((e * q[:, 1, 1] + q[:, 0, 1]) / (e * q[:, 1, 0] + q[:, 0, 0]))
    return belief, below, above


def fit(pages: list[str], steps: int = 400, l2: float = 0.0001) -> Model:
    """Fit on pages whose elements say data-content="1" or "0"; what is said holds below it. An element that nothing is
    said of is content if most text below it is. Deterministic."""
    parsed = [p for p in map(parse, pages) if p.texts]
    x, parent, depth, kind = matrix(parsed)
    y = np.array([v for p in parsed for v in p.label], float)
    size = np.array([len(t) for p in parsed for t in p.texts], float)
    text = kind == 1
    good, total = np.zeros(len(y)), np.zeros(len(y))
    good[text], total[text] = size * np.maximum(y[text], 0), size
    for d in range(int(depth.max()), 0, -1):
        level = depth == d
        good += np.bincount(parent[level], weights=good[level], minlength=len(y))
        total += np.bincount(parent[level], weights=total[level], minlength=len(y))
    y = np.where(y >= 0, y, good > total / 2)
    w, pair = np.zeros(N_FEATURES), np.zeros((2, 2, 2))
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind[child], y[parent[child]].astype(int), y[child].astype(int)), 1)
    state = [(np.zeros_like(v), np.zeros_like(v)) for v in (w, pair)]
    for step in range(1, steps + 1):
        belief, below, above = sum_product(x @ w, parent, depth, kind, pair)
        m = 1 / (1 + np.exp(-np.clip(belief, -40, 40)))
        joint = np.exp(pair)[kind[child]] * np.exp(np.stack([np.zeros(len(child)), np.clip(above[child], -30, 30)], 1))[:, :, None] * np.exp(np.stack([np.zeros(len(child)), np.clip(below[child], -30, 30)], 1))[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        expect = np.stack([joint[kind[child] == k].sum(0) for k in (0, 1)])
        for v, g, (a, b) in zip((w, pair), (x.T @ (y - m) / len(y) - l2 * w, (seen - expect) / len(y) - l2 * pair), state, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            v += 0.3 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-9)
    return Model(w, pair)


def labelled_pages(n: int = 400, seed: int = 11) -> list[str]:
    """Training pages of many layouts, labelled by construction: an article among menus, headers, footers, sidebars,
    notices, adverts, forms, scripts and reader comments, which may stand before, after or inside it."""
    r = np.random.RandomState(seed)
    pick = lambda *xs: xs[r.randint(len(xs))]
    vocabulary = ["".join(pick("ka", "lo", "mi", "ne", "ru", "sa", "ti", "vo", "an", "er") for _ in range(r.randint(1, 5))) for _ in range(400)]

    def sentence(lo: int = 1, hi: int = 18) -> str:
        w = [vocabulary[r.randint(400)] for _ in range(r.randint(lo, hi))]
        return w[0].capitalize() + " " * (len(w) > 1) + " ".join(w[1:]) + pick(".", ".", ".", "!", "", " &amp; co.")

    def prose(lo: int = 1, hi: int = 5) -> str:
        return " ".join(sentence() for _ in range(r.randint(lo, hi)))

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{i}">{sentence(1, 4)}</a></li>' for i in range(k))

    def box(names: str, inner: str) -> str:
        name = pick(*names.split())
        return pick(f'<div class="{name}">{inner}</div>', f'<div id="{name}">{inner}</div>', f'<section class="{name} box">{inner}</section>', f'<div class="page-{name}">{inner}</div>')

    def boiler() -> str:
        k = r.randint(12)
        words = prose(1, 4)
        inner = pick(words, f"<p>{words}</p>", f"<p>{words}</p><p>{prose(1, 3)}</p>", f"<h3>{sentence(1, 4)}</h3><p>{words}</p>", f"<div><p>{words}</p></div>")
        if k == 0:
            return pick(f"<nav><ul>{links(r.randint(2, 8))}</ul></nav>", box("menu navigation navbar breadcrumb", f"<ul>{links(4)}</ul>"), f"<nav>{inner}</nav>")
        if k == 1:
            return pick(f"<header>{inner}</header>", f"<header><h1>{sentence(1, 4)}</h1></header>", box("header masthead", inner))
        if k == 2:
            return pick(f"<footer>{inner}</footer>", f"<footer>&copy; {sentence(1, 5)}</footer>", box("footer copyright", inner))
        if k == 3:
            return pick(f"<aside>{inner}</aside>", f'<aside class="sidebar"><h3>{sentence(1, 3)}</h3><ul>{links(4)}</ul></aside>', box("sidebar widget related", inner))
        if k in (4, 5):
            return box("ad ads advert advertisement banner sponsored promo", inner)
        if k in (6, 7):
            return pick(box("cookie-notice notice consent alert gdpr popup", inner), f'<div role="alert">{inner}</div>', f"<dialog>{inner}</dialog>")
        if k == 8:
            return pick(f"<form><label>{sentence(1, 4)}</label><input><button>{sentence(1, 3)}</button></form>", f"<form>{inner}<select><option>{sentence(1, 2)}<option>{sentence(1, 2)}</select></form>", box("newsletter login search", inner))
        if k in (9, 10):
            one = lambda: pick(f'<div class="comment"><b>{sentence(1, 2)}</b><p>{prose(1, 6)}</p></div>', f"<li><p>{prose(1, 6)}</p></li>", f"<p>{prose(1, 6)}</p>", f"<article><p>{prose(1, 4)}</p></article>" if r.rand() < 0.3 else f"<div>{prose(1, 3)}</div>")
            body = f"<h3>{sentence(1, 3)}</h3>" * r.randint(2) + "".join(one() for _ in range(r.randint(1, 5)))
            return box("comments commentlist replies discussion", pick(body, f"<ol>{body}</ol>"))
        return box("share social", f"<ul>{links(3)}</ul>")

    def off() -> str:
        return f'<div data-content="0">{boiler()}</div>' if r.rand() < 0 else re.sub(r"^<(\w+)", r'<\1 data-content="0"', boiler())

    def content() -> str:
        out = [f"<h1>{sentence(1, 10)}</h1>"] if r.rand() < 0.8 else []
        for _ in range(pick(1, 1, 2, 3, 6, 12)):
            k = r.randint(13)
            p = prose(1, pick(2, 2, 4, 8))
            if k == 0:
                out.append(f"<h{r.randint(2, 5)}>{sentence(1, 6)}</h2>")
            elif k == 1:
                out.append("<ul>" + "".join(f"<li>{prose(1, 2)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif k == 2:
                out.append(f"<blockquote><p>{p}</p></blockquote>")
            elif k == 3:
                out.append("<table>" + "".join(f"<tr><td>{sentence(1, 3)}</td><td>{sentence(1, 3)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif k == 4:
                out.append(f"<p>{sentence()} <a href='/x'>{sentence(1, 4)}</a> {sentence()}</p>")
            elif k in (5, 11):
                out.append(f"<p><b>{p}<br>")
            elif k == 6:
                out.append(f"<div>{p}</div>")
            elif k == 7:
                out.append(f"<figure><img src=x><figcaption>{sentence(1, 6)}</figcaption></figure>")
            elif k == 8 and r.rand() < 0.7:
                out.append(off())
            else:
                out.append(f"<p>{p}</p>")
        return "".join(out)

    pages = []
    for _ in range(n):
        inner = content()
        main = pick(
            *[f'<article data-content="1">{inner}</article>'] * 4, f'<main data-content="1">{inner}</main>', f'<main><article data-content="1">{inner}</article></main>', f'<div class="content" data-content="1">{inner}</div>',
            f'<div id="main"><div class="post entry" data-content="1">{inner}</div></div>', f'<section class="story" data-content="1">{inner}</section>', f'<div id="article-body" data-content="1">{inner}</div>',
        )
        before, after = "".join(off() for _ in range(r.randint(0, 4))), "".join(off() for _ in range(r.randint(0, 5)))
        wrap = pick("{}", "{}", '<div class="wrapper">{}</div>', '<div id="page"><div class="container">{}</div></div>')
        pages.append(f"<html><head><title>x</title><script>var a='<p>';</script></head><body>{wrap.format(before + main + after)}</body></html>")
    return pages


def extract(htmls: list[str | None], model: Model) -> list[str]:
    """The main text of each page: its content runs in page order, joined by one line break. Null is empty."""
    pages = [parse(h) if h else Page([], [], [], [], [], []) for h in htmls]
    x, parent, depth, kind = matrix(pages)
    if not len(parent):
        return [""] * len(pages)
    belief, _, _ = sum_product(x @ model.weights, parent, depth, kind, model.pair)
    keep = (belief[kind == 1] >= 0).tolist()
    out, at = [], 0
    for p in pages:
        k = len(p.texts)
        out.append("\n".join(t for t, good in zip(p.texts, keep[at : at + k], strict=True) if good))
        at += k
    return out


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages; text is empty where a page has no content.

    A null html is empty, a null url stays null. Repeated rows are extracted alike. An empty table gives an empty
    result; other columns don't matter. The whole html is read. The model, of fixed size, goes along with the tasks.
    """
    model = model or fit(labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for whole in batches for x in slices(whole, "html", 4_000_000)):
            h, texts, at = b.column("html").to_pylist(), [], 0
            while at < len(h):
                k, size = at, 0
                while k < len(h) and (k == at or size < 2_000_000):
                    size += len(h[k] or "")
                    k += 1
                texts += extract(h[at:k], model)
                at = k
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    d = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    d = in_arrow(d, run, "page_id long, url string, text string")
    return d.withColumn("n_chars", F.length("text").cast("long"))
