"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

A page is cut into leaf blocks, the runs of text between block-level tags, each with its open ancestors. Binary features of a block
(its tag, ancestor tags, groups of class and id words and roles of ancestors, links, length, punctuation, phrases, place on the
page) and of its neighbours feed a two-state chain, article or not. Weights are fitted on labelled pages by maximum likelihood (exact
gradients by forward and backward sums); the states of a page are decoded by Viterbi, so a short line between two paragraphs of
an article stays in it and a lone link line does not.

Labelled pages come from a bounded sample of the table, ``TRAIN_PAGES`` pages of at most ``TRAIN_CHARS`` by a hash of the id: where an ``article`` or ``main`` element
marks the text, its blocks are labelled by that, and the page's own paragraphs and boilerplate are also set into other layouts
(plain ``div``, no article element, sidebars, notices, adverts, forms, reader comments) with known labels, so that the
weights do not hang on one element. Nothing else is sampled: every page is decoded whole.

Text of scripts, styles, titles, hidden templates and form controls is never a block; formulas, drawings and the fallback text
of media are inline text. The head itself hides nothing, as its end tag may be left out; a title or style in it that is not
closed ends with it. White space inside a block, line breaks among it, becomes one space. Defined cases: a null or empty page
has no text; so has one without any article block. Unclosed tags, comments and quotes end with the page at the latest. Without a
page that marks its article the shipped layouts are filled with placeholder words. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, ship

#: pages that weights are fitted on, and layouts that each is set into
TRAIN_PAGES, LAYOUTS = 240, 3
#: blocks of a page that training uses, and the code points of the longest page that it looks at; decoding has neither bound
TRAIN_BLOCKS, TRAIN_CHARS = 40, 200_000

# Elements of the markup language by what they do to text.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = frozenset("script style template noscript iframe title select textarea button".split())
RAW = frozenset("script style textarea title iframe noscript".split())
#: inline elements whose text stands apart from what is around it
APART = frozenset("br svg canvas audio video text".split())
#: elements of another markup language, whose elements a slash may close
FOREIGN = frozenset("svg math".split())
#: elements whose end tag also ends a table that is open inside them
LEAVES_TABLE = frozenset("table body html tr td th tbody thead tfoot caption article main div section".split())
#: elements that keep a paragraph around them open
KEEPS_P = frozenset("table td th li div section article blockquote body main aside".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: an opening tag ends these open elements, up to the given bounds
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: words of class, id and role, by what they tell
GROUPS = {
    "ad": "ad ads advert adverts advertisement advertising adslot banner sponsor sponsored promo promotion promoted affiliate dfp",
    "notice": "cookie cookies consent gdpr notice notices notification alert popup modal overlay warning announcement toast disclaimer",
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager skip topbar toolbar tabs links sitemap",
    "side": "sidebar side aside widget widgets related recommended recommend recommendation recommendations more trending popular complementary rail teaser",
    "foot": "footer foot copyright contentinfo legal bottom colophon imprint credits",
    "head": "header masthead branding logo top hero site",
    "comment": "comment comments commentlist reply replies discussion respond disqus reader readers thread responses feedback",
    "share": "share sharing social follow subscribe newsletter signup login register tags tag",
    "form": "form search searchbox input field contact poll survey",
    "main": "article content main post entry story body text maincontent articlebody prose page",
    "meta": "meta byline author date time published updated",
}
GROUP_OF = {w: g for g, words in GROUPS.items() for w in words.split()}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>", re.S)
#: as above, for pages with a quote that is never closed: only where a tag begins
_OPEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
_MARK = re.compile("[\"'>]")
_HEAD_END = re.compile(r"(?=</head\b|<body\b)", re.I)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Block:
    __slots__ = ("text", "tag", "path", "groups", "linked", "container")

    def __init__(self, text: str, place: Place, linked: int):
        self.text, self.linked = text, linked
        self.tag, self.container = place.tag(), place.container()
        self.path, self.groups = place.names(), place.groups()


class Place:
    """The open elements. What is asked of them takes a time that does not depend on how many there are."""

    def __init__(self) -> None:
        self.open: list[tuple[str, frozenset[str], int]] = []
        self.at: dict[str, list[int]] = {}  # per name, the levels at which it is open
        self.hints: dict[str, int] = {}  # per group, the open elements that point to it

    def push(self, name: str, groups: frozenset[str], serial: int) -> None:
        self.at.setdefault(name, []).append(len(self.open))
        for g in groups:
            self.hints[g] = self.hints.get(g, 0) + 1
        self.open.append((name, groups, serial))

    def level(self, names: Iterable[str]) -> int:
        """The innermost level at which one of the names is open, -1 without any."""
        return max((levels[-1] for levels in map(self.at.get, names) if levels), default=-1)

    def close(self, names: Iterable[str], bounds: Iterable[str]) -> None:
        """End the innermost of the named elements and all inside it, unless a bound lies further in."""
        k = self.level(names)
        if k < 0 or k < self.level(bounds):
            return
        while len(self.open) > k:
            name, groups, _ = self.open.pop()
            self.at[name].pop()
            for g in groups:
                self.hints[g] -= 1

    def tag(self) -> str:
        return self.open[-1][0] if self.open else "body"

    def container(self) -> int:
        return self.open[-2][2] if len(self.open) > 1 else 0

    def names(self) -> frozenset[str]:
        return frozenset(name for name, levels in self.at.items() if levels)

    def groups(self) -> frozenset[str]:
        return frozenset(g for g, n in self.hints.items() if n)


class Tags:
    """The tags of a page from left to right: (start, end, closing, name, attributes); comments and the like have no name.

    A quote may hide the end of a tag; where it is never closed, the tag ends at the first ``>``. The first such tag makes a table of where
    tags would end, so that no later one is followed to the end of the page again.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.marks: list[int] | None = None
        self.ends: list[int] = []

    def _survey(self) -> None:
        """For each quote and ``>`` the place where a tag ends that reaches it outside quotes, -1 for none."""
        page = self.page
        self.marks = [m.start() for m in _MARK.finditer(page)]
        n = len(self.marks)
        self.ends = [-1] * (n + 1)
        quote = {'"': n, "'": n}  # the next mark of each kind to the right
        for k in range(n - 1, -1, -1):
            c = page[self.marks[k]]
            if c == ">":
                self.ends[k] = self.marks[k]
            else:
                if quote[c] < n:
                    self.ends[k] = self.ends[quote[c] + 1]
                quote[c] = k

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        page = self.page
        if at > self.last:  # no tag ends behind here, and a comment goes on to the end
            starts = [k for k in (page.find("<!", at), page.find("<?", at)) if k >= 0]
            return (min(starts), len(page), False, "", "") if starts else None
        if self.marks is None:
            m = _TAG.search(page, at, self.last + 1)
            if m is not None and m[5] is not None:
                self._survey()
        else:
            m = _OPEN.search(page, at, self.last + 1)
        if m is None:
            return self.after(self.last + 1)
        if not (m[2] or m.re is _TAG and m[5]):  # a comment may go on behind the last ">"
            return m.start(), m.end() if m.end() <= self.last else _OPEN.match(page, m.start()).end(), False, "", ""
        if m.re is _TAG:
            return m.start(), m.end(), bool(m[1] or m[4]), (m[2] or m[5]).lower(), m[3] or m[6] or ""
        end = self.ends[bisect_left(self.marks, m.end())]
        if end < 0:
            end = page.find(">", m.end())
        return m.start(), end + 1, bool(m[1]), m[2].lower(), page[m.end(): end]


def _hints(attributes: str) -> frozenset[str]:
    """The groups that an element's class, id and role point to."""
    if "=" not in attributes:
        return frozenset()
    found = set()
    for m in _ATTR.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        for w in _WORDS.findall(_CAMEL.sub(r"\1 \2", value).lower()):
            if w in GROUP_OF:
                found.add(GROUP_OF[w])
    return frozenset(found)


def leaf_blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order."""
    out: list[Block] = []
    place = Place()
    tags = Tags(page)
    raw_ends: dict[tuple[str, str], tuple[int, int]] = {}
    never = len(page) + 1
    parts: list[str] = []
    linked = 0
    in_link = False
    hidden: str | None = None
    depth = 0
    foreign = 0
    in_head = False
    serial = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, place, linked))
            parts.clear()
        linked = 0

    def raw_end(name: str) -> int:
        """Where the text of a raw element ends: behind its end tag, without one at the end of what holds it."""
        bound = "" if name == "script" else "svg|math" if foreign else "head" if in_head else ""
        if raw_ends.get((name, bound), (-1, 0))[0] < at:  # what was found further on, or not at all, still holds
            holder = rf"(?=</(?:{bound})\b)" if bound else "(?!)"
            stop = (re.compile(f"</{name}[^>]*>|{holder}", re.I).search(page, at, tags.last + 1)
                    or re.compile(holder, re.I).search(page, max(at, tags.last + 1)))
            raw_ends[name, bound] = stop.span() if stop else (never, never)
        if raw_ends[name, bound][0] < never:
            return raw_ends[name, bound][1]
        stop = _HEAD_END.search(page, at) if in_head else None
        return stop.end() if stop else len(page)

    while at < len(page):
        found = tags.after(at)
        end = found[0] if found else len(page)
        if end > at and hidden is None:
            piece = page[at:end]
            parts.append(piece)
            if in_link:
                linked += len(piece)
        if found is None:
            break
        _, at, closing, name, attributes = found
        if not name:
            continue
        empty = attributes.endswith("/")
        if name in FOREIGN:
            foreign = max(0, foreign + (-1 if closing else 0 if empty else 1))
        elif name == "head" or name in BLOCK and name != "html":
            in_head = name == "head" and not closing
        if name in RAW and not closing and not (empty and (foreign or in_head)):  # text up to the end tag, whatever it looks like
            at = raw_end(name)
        if hidden is not None:
            if name == hidden:
                depth += -1 if closing else (0 if empty else 1)
                if depth == 0:
                    hidden = None
            continue
        if name in HIDDEN:
            if not closing:
                if name not in RAW and not empty:
                    hidden, depth = name, 1
                parts.append(" ")
            continue
        if name in APART:
            parts.append(" ")
        elif name == "a":
            in_link = not closing
        elif name in BLOCK:
            flush()
            in_link = False
            if closing:
                place.close((name,), ("table",) if name not in LEAVES_TABLE else ())
            else:
                place.close(("p",), KEEPS_P)
                if name in ENDS:
                    place.close(*ENDS[name])
                if name not in VOID:
                    serial += 1
                    place.push(name, _hints(attributes), serial)
    flush()
    return out


# -------------------------------------------------------------------------------------------------------------- features
_END = re.compile(r"[.!?…:;\"”»)]$")
_NOTICE = re.compile(r"cookie|consent|privacy|copyright|©|all rights reserved|subscribe|newsletter|sign (?:up|in)|log ?in|advert|sponsored|"
                     r"related|read more|comments?|reply|share|search|menu|skip to", re.I)


def _own_features(b: Block, k: int, n: int) -> list[str]:
    words = b.text.count(" ") + 1
    link = b.linked / max(len(b.text), 1)
    out = ["bias", f"tag={b.tag}", f"words={0 if words < 3 else 1 if words < 7 else 2 if words < 16 else 3 if words < 41 else 4}",
           f"link={0 if link == 0 else 1 if link < 0.4 else 2 if link < 0.8 else 3}"]
    out += [f"in={t}" for t in b.path if t not in ("html", "body", "div", "p")]
    out += [f"hint={g}" for g in b.groups]
    if not b.groups:
        out.append("no hint")
    if not b.path & {"article", "main"}:
        out.append("no article")
    if _END.search(b.text):
        out.append("sentence end")
    if words < 30 and _NOTICE.search(b.text):
        out.append("notice words")
    if k == 0:
        out.append("first")
    if k == n - 1:
        out.append("last")
    return out


def page_features(blocks: list[Block]) -> list[list[str]]:
    own = [_own_features(b, k, len(blocks)) for k, b in enumerate(blocks)]
    out = []
    headed = False
    for k, b in enumerate(blocks):
        f = list(own[k])
        for step, name in ((-1, "before"), (1, "after")):
            if 0 <= k + step < len(blocks):
                o = blocks[k + step]
                f.append(f"{name} {'same' if o.container == b.container else 'other'} place")
                f.append(f"{name} tag={o.tag}")
        f.append("headline seen" if headed else "no headline yet")
        headed = headed or b.tag == "h1"
        out.append(f)
    return out


# ------------------------------------------------------------------------------------------------------------- the chain
class Chain:
    """A two-state conditional random field: weights per feature and state, and of transitions."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray, start: np.ndarray):
        self.index, self.weights, self.moves, self.start = index, weights, moves, start

    def emissions(self, features: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(features), 2))
        for k, f in enumerate(features):
            ids = [self.index[x] for x in f if x in self.index]
            if ids:
                out[k] = self.weights[ids].sum(axis=0)
        return out

    def decode(self, features: list[list[str]]) -> list[int]:
        """The most likely states (Viterbi)."""
        if not features:
            return []
        e = self.emissions(features)
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = (self.start + e[0]).tolist()
        back = []
        for x, y in e[1:].tolist():
            from_a, from_b = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from_a else 1, 0 if from_b else 1))
            a, b = max(a + m00, b + m10) + x, max(a + m01, b + m11) + y
        state = 0 if a >= b else 1
        out = [state]
        for step in reversed(back):
            state = step[state]
            out.append(state)
        return out[::-1]

    @classmethod
    def fit(cls, pages: list[tuple[list[list[str]], list[int]]], rounds: int = 100, rate: float = 0.4, ridge: float = 1e-3) -> Chain:
        """Maximum likelihood by AdaGrad on all pages at once, their chains padded to one length.

        Of a long training page ``TRAIN_BLOCKS`` blocks are used, the first or the last; decoding has no such bound.
        """
        pages = [(f[a: a + TRAIN_BLOCKS], y[a: a + TRAIN_BLOCKS]) for i, (f, y) in enumerate(pages) if f
                 for a in [max(0, len(f) - TRAIN_BLOCKS) * (i % 2)]]
        index: dict[str, int] = {}
        for f, _ in pages:
            for block in f:
                for x in block:
                    index.setdefault(x, len(index))
        n, longest, d = len(pages), max(len(y) for _, y in pages), len(index)
        x = np.zeros((n * longest, d), dtype=np.float32)
        y = np.zeros((n, longest), dtype=np.int64)
        live = np.zeros((n, longest), bool)
        for i, (f, labels) in enumerate(pages):
            live[i, : len(labels)] = True
            y[i, : len(labels)] = labels
            for k, block in enumerate(f):
                x[i * longest + k, [index[s] for s in block]] = 1
        w, m, s = np.zeros((d, 2)), np.zeros((2, 2)), np.zeros(2)
        gold = (np.eye(2)[y] * live[:, :, None])
        pair = np.zeros((2, 2))
        both = live[:, 1:] & live[:, :-1]
        np.add.at(pair, (y[:, :-1][both], y[:, 1:][both]), 1)
        total = live.sum()
        history = [np.full_like(p, 1e-6) for p in (w, m, s)]

        def lse(v: np.ndarray, axis: int) -> np.ndarray:
            top = v.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(v - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        for _ in range(rounds):
            e = (x @ w).reshape(n, longest, 2)
            fwd, bwd = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
            fwd[:, 0] = s + e[:, 0]
            for k in range(1, longest):
                step = lse(fwd[:, k - 1, :, None] + m, 1) + e[:, k]
                fwd[:, k] = np.where(live[:, k, None], step, fwd[:, k - 1])
            z = lse(fwd[:, -1], 1)
            for k in range(longest - 2, -1, -1):
                step = lse(m + (e[:, k + 1] + bwd[:, k + 1])[:, None, :], 2)
                bwd[:, k] = np.where(live[:, k + 1, None], step, 0.0)
            p = np.exp(fwd + bwd - z[:, None, None]) * live[:, :, None]
            expected = np.zeros((2, 2))
            for k in range(1, longest):
                if both[:, k - 1].any():
                    joint = np.exp(fwd[:, k - 1, :, None] + m + (e[:, k] + bwd[:, k])[:, None, :] - z[:, None, None])
                    expected += joint[both[:, k - 1]].sum(axis=0)
            grads = [x.T @ (gold - p).reshape(-1, 2) / total - ridge * w, (pair - expected) / total - ridge * m,
                     (gold[:, 0] - p[:, 0]).sum(axis=0) / total - ridge * s]
            for value, g, h in zip((w, m, s), grads, history):
                h += g * g
                value += rate * g / np.sqrt(h)
        return cls(index, w, m, s)


# ------------------------------------------------------------------------------------------------------- labelled pages
_NOT_TEXT = frozenset("nav header footer aside form".split())
_NOT_TEXT_HINTS = frozenset("ad notice nav side foot comment share form".split())


def own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels by the page's own article or main element; None where it has neither."""
    if not any(b.path & {"article", "main"} for b in blocks):
        return None
    return [int(bool(b.path & {"article", "main"}) and not b.path & _NOT_TEXT and not b.groups & _NOT_TEXT_HINTS) for b in blocks]


def _layout(rng: np.random.Generator, title: str, paras: list[str], junk: list[str]) -> tuple[str, list[int]]:
    """A page of another layout with the given text, and the labels of its blocks."""
    esc = entities.escape
    pieces: list[tuple[str, list[int]]] = []
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]

    def some(n: int) -> list[str]:
        return [esc(junk[int(rng.integers(len(junk)))]) for _ in range(n)]

    def words(n: int) -> list[str]:
        return [esc(" ".join(junk[int(rng.integers(len(junk)))].split()[: int(rng.integers(1, 4))]) or "more") for _ in range(n)]

    def menu() -> tuple[str, list[int]]:
        w = words(int(rng.integers(2, 8)))
        items = "".join(f'<li><a href="/{k}">{x}</a></li>' for k, x in enumerate(w))
        o, c = pick(("<nav>", "</nav>"), ('<div class="menu">', "</div>"), ('<div id="navigation">', "</div>"), ('<nav class="navbar">', "</nav>"),
                    ('<div class="breadcrumbs">', "</div>"), ("<header>", "</header>"))
        return f"{o}<ul>{items}</ul>{c}", [0] * len(w)

    def box(opens: list[str], n: int, tag: str = "p", head: bool = False) -> tuple[str, list[int]]:
        o = pick(*opens)
        name = o[1:].split()[0].rstrip(">")
        body = "".join(f"<{tag}>{x}</{tag}>" for x in some(n))
        top = f"<h3>{words(1)[0]}</h3>" if head else ""
        return f"{o}{top}{body}</{name}>", [0] * (n + head)

    def plain(opens: list[str], text: str) -> tuple[str, list[int]]:
        o = pick(*opens)
        return f"{o}{text}</{o[1:].split()[0].rstrip('>')}>", [0]

    ad = lambda: plain(['<div class="ad">', '<div class="advert">', '<div id="ad-slot-1">', '<aside class="sponsored">', '<div class="banner-ad">',
                        '<section class="promo">'], pick(some(1)[0], "Advertisement " + words(1)[0]))
    notice = lambda: plain(['<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="notice">', '<div class="alert">',
                            '<div role="alert">', '<div class="consent">'], pick("We use cookies. " + some(1)[0], some(1)[0]))
    side = lambda: box(["<aside>", '<div class="sidebar">', '<div class="related">', '<aside class="widget">', '<div id="sidebar">'],
                       int(rng.integers(1, 4)), pick("p", "li", "div"), bool(rng.integers(2)))
    comments = lambda: box(['<div class="comments">', '<section id="comments">', '<div id="comments" class="comment-list">', '<section class="reader-comments">',
                            '<ol class="commentlist">', '<div class="discussion">'], int(rng.integers(1, 5)), pick("p", "div", "li"), bool(rng.integers(2)))

    def form() -> tuple[str, list[int]]:
        o, c = pick(("<form>", "</form>"), ('<form class="search">', "</form>"), ('<div class="newsletter"><form>', "</form></div>"))
        return f'{o}<p>{pick("Subscribe to our newsletter", words(1)[0], some(1)[0])}</p><input name="q">{c}', [0]

    foot = lambda: plain(["<footer>", '<div class="footer">', '<div id="footer">', "<footer class=\"site-footer\">"],
                         pick("&copy; ", "&copy; example &middot; ", "") + some(1)[0])
    bits = {"ad": ad, "notice": notice, "side": side, "comments": comments, "form": form, "menu": menu}
    for name in ("menu", "notice", "ad", "form", "side"):
        if rng.random() < (0.8 if name == "menu" else 0.4):
            pieces.append(bits[name]())
    if rng.random() < 0.3:
        pieces.append((f"<header><div class=\"logo\">{words(1)[0]}</div></header>", [0]))
    o = pick("<article>", "<main>", '<div class="content">', '<div class="post">', '<div class="entry-content">', '<div id="main">', "<div>",
             '<section class="story-body">', '<main id="content">', "<article class=\"post\">", '<div class="article-body">', '<td class="text">')
    name = o[1:].split()[0].rstrip(">")
    inner, labels = [], []
    if rng.random() < 0.85:
        h = pick("h1", "h1", "h2")
        inner.append(f"<{h}>{esc(title)}</{h}>")
        labels.append(1)
    for p in paras:
        t = esc(p)
        tag = pick("p", "p", "p", "p", "div", "blockquote", "h2" if len(p) < 60 else "p")
        if rng.random() < 0.15:
            inner.append(pick(f"<ul><li>{t}</li></ul>", f"<ol><li>{t}</ol>", f"<table><tr><td>{t}</td></tr></table>", f"<pre>{t}</pre>",
                              f"<figure><figcaption>{t}</figcaption></figure>", f'<p>{t[:40]}<a href="/x">{t[40:60]}</a>{t[60:]}</p>'))
        else:
            inner.append(f"<{tag}>{t}</{tag}>" if tag != "p" or rng.random() < 0.8 else f"<p>{t}")
        labels.append(1)
        if rng.random() < 0.12:
            extra = bits[pick("ad", "side", "form", "notice")]()
            inner.append(extra[0])
            labels += extra[1]
    if rng.random() < 0.25:
        extra = bits[pick("comments", "ad", "side")]()
        inner.append(extra[0])
        labels += extra[1]
    body = f"{o}{''.join(inner)}</{name}>"
    pieces.append((f"<table><tr>{body}</tr></table>" if name == "td" else body, labels))
    for name, chance in (("comments", 0.4), ("side", 0.3), ("ad", 0.2), ("form", 0.2)):
        if rng.random() < chance:
            pieces.append(bits[name]())
    if rng.random() < 0.85:
        pieces.append(foot())
    return "<html><head><title>x</title></head><body>" + "".join(p for p, _ in pieces) + "</body></html>", [x for _, ls in pieces for x in ls]


def labelled_pages(pages: list[str], layouts: int = LAYOUTS, seed: int = 5) -> list[tuple[list[list[str]], list[int]]]:
    """Training chains from raw pages: the pages as they are, and their text in other layouts."""
    rng = np.random.default_rng(seed)
    real, texts, junk = [], [], []
    for page in pages:
        blocks = leaf_blocks(page)
        labels = own_labels(blocks)
        if labels is None:
            continue
        real.append((page_features(blocks), labels))
        texts.append([b.text for b, y in zip(blocks, labels) if y])
        junk += [b.text for b, y in zip(blocks, labels) if not y and len(b.text) > 3]
    texts = [t for t in texts if t] or [["Some words of text.", "More words, in a longer paragraph of text that goes on."] * 3]
    # reader comments and adverts read like text: sentences of other pages stand in for them
    junk = (junk or ["home"]) + [p for t in texts for p in t[1:3]]
    out = list(real)
    for t in texts:
        for _ in range(layouts):
            n = int(rng.integers(1, 9))
            page, labels = _layout(rng, t[0][:90], [p[:400] for p in t[1: n + 1]] or [t[0][:400]], junk)
            blocks = leaf_blocks(page)
            if len(blocks) == len(labels):
                out.append((page_features(blocks), labels))
    return out


def train(pages: DataFrame, sample: int = TRAIN_PAGES, id_col: str = "page_id", html_col: str = "html") -> Chain:
    """Fit the chain on about ``sample`` pages, those whose id has one of the lowest hashes."""
    # very long pages teach no more than others and would weigh on the driver
    rows = pages.where(F.length(html_col).between(1, TRAIN_CHARS))
    share = min(1.0, sample / max(rows.count(), 1))
    low = F.pmod(F.xxhash64(F.col(id_col), F.lit(23)), F.lit(1 << 24)) < math.ceil(share * (1 << 24))
    return Chain.fit(labelled_pages(sorted(r["page"] for r in rows.where(low).select(F.col(html_col).alias("page")).collect())))


def main_text(page: str | None, chain: Chain) -> str:
    blocks = leaf_blocks(page or "")
    states = chain.decode(page_features(blocks))
    return "\n".join(b.text for b, s in zip(blocks, states) if s)


def extract(pages: DataFrame, chain: Chain | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row; ``text`` is the page's article, one line per block."""
    ship(pages.sparkSession)
    chain = chain or train(pages, id_col=id_col, html_col=html_col)
    schema = arrow_schema(page_id=pa.int64(), url=pa.string(), text=pa.string())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                texts = [main_text(p, chain) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], schema=schema)

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string")
