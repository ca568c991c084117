"""Main text of HTML pages by boosted trees over DOM nodes, decoded along the hierarchy."""

from __future__ import annotations

import functools
import html as entities
import io
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnstar.llm.frames import only

# Pages the trees are fitted on at most, by the hash of their ids, and rewritten copies of each.
TRAIN_PAGES = 400
VARIANTS = 3
# Share of the paragraphs of a rewritten copy that get a heading, and that of the others that are
# told as a list or a quotation.
LISTED = 0.15
TREES, DEPTH, BINS, RATE, RIDGE = 50, 4, 32, 0.25, 1.0
BATCH_PAGES = 64
LONG_RUN = 80
STORY_TAGS = ("p", "h1", "h2", "h3", "li", "blockquote")

# Fixed names of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Not read, up to their end tags whatever stands in them.
RAW = frozenset("script style textarea title iframe".split())
# Not read, up to their end tags or that of what they stand in.
UNREAD = frozenset("head template svg button select optgroup option datalist".split())
# What may stand in a head; anything else ends it.
HEAD_MATTER = frozenset("base head link meta noscript script style template title".split())
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i ins kbd label mark"
    " math menclose merror meter mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt"
    " mstyle msub msubsup msup mtable mtd mtext mtr munder munderover nobr noscript object output"
    " progress q rp rt ruby s samp semantics small span strike strong sub sup time tt u var"
    " video".split()
)
# An open element that ends where another begins.
ENDED_BY = {
    "li": ("li",), "tr": ("tr",), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
    "td": ("td", "th"), "th": ("td", "th"),
}
CONTENT = frozenset({"article", "main"})
FURNITURE = frozenset({"nav", "header", "footer", "aside", "form", "menu", "dialog"})
TAGS = (
    "#text p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table tr td th blockquote pre figure figcaption"
    " div section article main nav header footer aside form fieldset address body html"
).split()
TAG_NUMBER = {tag: number for number, tag in enumerate(TAGS)}
OTHER = len(TAGS)

# Words in class, id, role and name attributes, by what they speak for.
TOKEN_GROUPS = {
    "content": "article content post entry body text story main page",
    "menu": "nav navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc",
    "edge": "header footer masthead copyright colophon foot top bottom banner toolbar",
    "side": "sidebar side aside rail column widget widgets related recommended more popular",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion dfp",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay warning dialog message",
    "comment": "comment comments commentlist reply replies respond discussion disqus reviews",
    "form": "form login signup subscribe newsletter search input contact register",
    "share": "share sharing social tags meta byline author date tools print",
}
_GROUP_OF = {w: 1 << g for g, words in enumerate(TOKEN_GROUPS.values()) for w in words.split()}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"\b(?:class|id|role|name)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE
)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_MARK = re.compile(r"data-main-text")
_ENDS = re.compile(r"[.!?…](?=\s|$)")
_SENTENCE_END = re.compile(r"(?<=[.!?…])\s+")


@functools.lru_cache(maxsize=4096)
def token_groups(attributes: str) -> int:
    """The groups of ``TOKEN_GROUPS`` that words of the naming attributes belong to, as bits."""
    bits = 0
    for value in _ATTRIBUTE.findall(attributes):
        for word in _WORD.findall(value):
            bits |= _GROUP_OF.get(word.lower(), 0)
    return bits


@functools.cache
def _close_tag(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE)


class Page:
    """Block elements and runs of text of a page, in page order, parents first."""

    def __init__(self, html: str):
        self.tag: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.groups: list[int] = []
        self.place: list[int] = []
        self.links: list[int] = []
        self.text: list[str | None] = []
        self.marked: list[bool] = []
        self._children: list[int] = []
        self._read(html)

    def _node(
        self, tag: int, parent: int, groups: int, marked: bool, text: str | None, links: int
    ) -> int:
        node = len(self.tag)
        if parent >= 0:
            place = self._children[parent]
            self._children[parent] += 1
        else:
            place = 0
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.groups.append(groups)
        self.place.append(place)
        self.links.append(links)
        self.text.append(text)
        self.marked.append(marked)
        self._children.append(0)
        return node

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("#page", self._node(OTHER, -1, 0, False, None, 0))]
        opened: Counter[str] = Counter()
        run: list[str] = []
        linked, in_link, at, pos = 0, 0, 0, 0
        unread = 0  # where in the stack an element that is not read stands

        def close(depth: int) -> None:
            nonlocal unread
            opened.subtract(name for name, _ in stack[depth:])
            del stack[depth:]
            unread = 0 if depth <= unread else unread

        def take(start: int, end: int) -> None:
            nonlocal linked
            if stack[-1][0] == "head" and not html[start:end].isspace():
                close(len(stack) - 1)
            if not unread:
                run.append(html[start:end])
                linked += end - start if in_link else 0

        def end_run() -> None:
            nonlocal linked
            if run:
                text = "".join(run)
                if "&" in text:
                    text = entities.unescape(text)
                text = " ".join(text.split())
                if text:
                    node = stack[-1][1]
                    self._node(0, node, 0, self.marked[node], text, min(linked, len(text)))
                run.clear()
                linked = 0

        tags_end = html.rfind(">") + 1
        while m := _TOKEN.search(html, pos, tags_end):
            if m.start() > at:
                take(at, m.start())
            at = pos = m.end()
            name = m[2] or m[5]
            if not name:
                if m.group().startswith("<!--") and not m.group().endswith("-->"):
                    at = pos = len(html)  # a comment that is not closed
                continue
            name = name.lower()
            if m[1] or m[4]:
                if name == "a":
                    in_link = in_link if unread else 0
                elif opened[name]:
                    depth = max(d for d in range(1, len(stack)) if stack[d][0] == name)
                    if not unread or depth < unread:
                        end_run()
                    close(depth)
                continue
            if stack[-1][0] == "head" and name not in HEAD_MATTER:
                close(len(stack) - 1)
            attributes = m[3] if m[3] is not None else m[6] or ""
            closed = attributes.endswith("/")
            if name in RAW:
                if not closed:
                    end = _close_tag(name).search(html, pos)
                    at = pos = end.end() if end else len(html)
                if name not in ("script", "style") and not unread:
                    run.append(" ")
                continue
            if unread:
                if not closed and name not in VOID and name not in INLINE:
                    stack.append((name, stack[-1][1]))
                    opened[name] += 1
                continue
            if name == "br" or name == "hr":
                run.append(" ")
                continue
            if name == "a":
                in_link = 1
                continue
            if name in VOID or name in INLINE:
                continue
            if name in UNREAD:
                if name != "template":
                    run.append(" ")
                if not closed:
                    unread = len(stack)
                    stack.append((name, stack[-1][1]))
                    opened[name] += 1
                continue
            end_run()
            if stack[-1][0] == "p":  # no block stands in a paragraph
                close(len(stack) - 1)
            if stack[-1][0] in ENDED_BY.get(name, ()):
                close(len(stack) - 1)
            node = self._node(
                TAG_NUMBER.get(name, OTHER),
                stack[-1][1],
                token_groups(attributes) if attributes else 0,
                self.marked[stack[-1][1]] or (bool(attributes) and bool(_MARK.search(attributes))),
                None,
                0,
            )
            if not closed:
                stack.append((name, node))
                opened[name] += 1
        if at < len(html):
            take(at, len(html))
        end_run()


# ---- features ---------------------------------------------------------------------------

_CONTENT_TAGS = [TAG_NUMBER[t] for t in sorted(CONTENT)]
_FURNITURE_TAGS = [TAG_NUMBER[t] for t in sorted(FURNITURE) if t in TAG_NUMBER]
_HEADING_TAGS = [TAG_NUMBER[f"h{n}"] for n in range(1, 7)]


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(nodes, columns)`` for all nodes of ``pages``, their parents and depths.

    Of a node: its tag and token groups, those of its ancestors, depth, place among siblings,
    and of its subtree: characters, share of the page, links, punctuation, elements per
    character, paragraphs and mean length of a run; then the same of its parent, and where in
    the page's text it begins.
    """
    sizes = np.array([len(p.tag) for p in pages])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    tag, parent, depth, groups, place, links = (
        np.concatenate([np.array(getattr(p, name), np.int64) for p in pages])
        for name in ("tag", "parent", "depth", "groups", "place", "links")
    )
    root = parent < 0
    parent = np.where(root, np.arange(len(tag)), parent + base)
    texts = [t for p in pages for t in p.text]
    chars = np.array([len(t) if t else 0 for t in texts])
    stops = np.array([len(_ENDS.findall(t)) if t else 0 for t in texts])
    is_run = tag == 0

    # Nodes stand in preorder: a subtree is a range that ends where the depth falls back.
    n = len(tag)
    end = np.full(n, n)
    for level in range(int(depth.max(initial=0)) + 1):
        shallow = np.flatnonzero(depth <= level)
        mine = depth[shallow] == level
        following = np.append(shallow[1:], n)
        end[shallow[mine]] = following[mine]

    def subtree(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[end] - total[np.arange(n)]

    page = np.repeat(np.arange(len(pages)), sizes)
    sub_chars, sub_links, sub_stops = subtree(chars), subtree(links), subtree(stops)
    sub_nodes, sub_runs = end - np.arange(n), subtree(is_run.astype(np.int64))
    sub_paragraphs = subtree((tag == TAG_NUMBER["p"]).astype(np.int64))
    sub_items = subtree((tag == TAG_NUMBER["li"]).astype(np.int64))
    siblings = np.bincount(parent[~root], minlength=n)[parent]
    before = np.cumsum(chars) - chars
    page_chars = np.maximum(1, np.bincount(page, chars, len(pages)))[page]
    before = before - before[np.cumsum(sizes) - sizes][page]

    above = np.zeros((n, len(TOKEN_GROUPS) + 2))
    own = np.stack(
        [(groups >> g) & 1 for g in range(len(TOKEN_GROUPS))]
        + [np.isin(tag, _CONTENT_TAGS), np.isin(tag, _FURNITURE_TAGS)],
        axis=1,
    ).astype(float)
    for level in range(1, int(depth.max(initial=0)) + 1):
        at = np.flatnonzero(depth == level)
        above[at] = np.maximum(above[parent[at]], own[parent[at]])
    density = sub_links / np.maximum(1, sub_chars)
    columns = [
        tag,
        is_run,
        tag == TAG_NUMBER["p"],
        np.isin(tag, _HEADING_TAGS),
        tag[parent],
        depth,
        place,
        place / np.maximum(1, siblings),
        siblings,
        np.log1p(sub_chars),
        sub_chars / page_chars,
        density,
        sub_stops / np.maximum(1, sub_chars) * 100,
        sub_nodes / np.maximum(1, sub_chars) * 100,
        sub_chars / np.maximum(1, sub_runs),
        sub_paragraphs,
        sub_items / np.maximum(1, sub_nodes),
        np.log1p(sub_chars[parent]),
        density[parent],
        sub_paragraphs[parent],
        (sub_stops / np.maximum(1, sub_chars))[parent] * 100,
        before / page_chars,
    ]
    table = np.concatenate([np.stack(columns, axis=1), own, above, own[parent]], axis=1)
    return table.astype(np.float32), np.where(root, -1, parent), depth


# ---- boosted trees ----------------------------------------------------------------------


class BoostedTrees:
    """Gradient boosting of complete trees of ``DEPTH`` levels on binned columns."""

    def __init__(
        self,
        edges: np.ndarray,
        start: float,
        split: np.ndarray,
        cut: np.ndarray,
        leaf: np.ndarray,
    ):
        self.edges, self.start, self.split, self.cut, self.leaf = edges, start, split, cut, leaf

    @staticmethod
    def _bins(edges: np.ndarray, table: np.ndarray) -> np.ndarray:
        return np.stack(
            [np.searchsorted(edges[:, j], table[:, j]) for j in range(table.shape[1])], axis=1
        )

    def margins(self, table: np.ndarray) -> np.ndarray:
        binned = self._bins(self.edges, table)
        rows, out = np.arange(len(table)), np.full(len(table), self.start)
        for split, cut, leaf in zip(self.split, self.cut, self.leaf, strict=True):
            at = np.zeros(len(table), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (binned[rows, split[at]] > cut[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out

    @classmethod
    def fit(cls, table: np.ndarray, labels: np.ndarray) -> BoostedTrees:
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        edges = np.quantile(table, quantiles, axis=0).astype(np.float32)
        binned = cls._bins(edges, table)
        mean = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        start = float(np.log(mean / (1 - mean)))
        margin = np.full(len(labels), start)
        inner, width = 2**DEPTH - 1, table.shape[1]
        splits, cuts, leaves = [], [], []
        flat = binned + np.arange(width) * BINS
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = labels - p, p * (1 - p)
            split, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
            at = np.zeros(len(labels), np.int64)
            for level in range(DEPTH):
                first, count = 2**level - 1, 2**level
                cells = ((at - first)[:, None] * (width * BINS) + flat).ravel()
                shape = (count, width, BINS)
                sums = (
                    np.bincount(cells, np.repeat(v, width), count * width * BINS)
                    for v in (gradient, weight)
                )
                g, h = (x.reshape(shape).cumsum(axis=2) for x in sums)
                all_g, all_h = g[:, :, -1:], h[:, :, -1:]
                gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE)
                gain -= all_g**2 / (all_h + RIDGE)
                best = gain.reshape(count, -1).argmax(axis=1)
                worth = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
                split[first : first + count] = best // BINS
                cut[first : first + count] = np.where(worth, best % BINS, BINS)
                at = 2 * at + 1 + (binned[np.arange(len(at)), split[at]] > cut[at])
            at -= inner
            g, h = (np.bincount(at, v, 2**DEPTH) for v in (gradient, weight))
            leaf = RATE * g / (h + RIDGE)
            margin += leaf[at]
            splits.append(split)
            cuts.append(cut)
            leaves.append(leaf)
        return cls(edges, start, np.array(splits), np.array(cuts), np.array(leaves))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        parts = {name: getattr(self, name) for name in ("edges", "start", "split", "cut", "leaf")}
        np.savez(out, **parts)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> BoostedTrees:
        s = np.load(io.BytesIO(data))
        return cls(s["edges"], float(s["start"]), s["split"], s["cut"], s["leaf"])


def decode(margins: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Which nodes to keep: the likeliest choice that keeps no node without its parent.

    A node is worth its margin and what its children are worth, or nothing if that is not
    positive; then the whole subtree goes. Worth rises from the leaves, choices fall from the
    roots.
    """
    worth = margins.astype(np.float64).copy()
    deepest = int(depth.max(initial=0))
    for level in range(deepest, 0, -1):
        at = np.flatnonzero(depth == level)
        np.add.at(worth, parent[at], np.maximum(0, worth[at]))
    keep = worth > 0
    for level in range(1, deepest + 1):
        at = np.flatnonzero(depth == level)
        keep[at] &= keep[parent[at]]
    return keep


# ---- training pages ---------------------------------------------------------------------

_WRAPPERS = {
    "main": ("article", "main", 'div class="post-content"', 'div id="content"', "div",
             'section class="entry"', 'div class="story-body"', 'div class="article-text"',
             'div class="page-main"'),
    "menu": ("nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"',
             'div class="breadcrumbs"'),
    "header": ("header", 'div id="header"', 'div class="masthead"', 'div class="top-banner"'),
    "footer": ("footer", 'div id="footer"', 'div class="copyright"', 'div class="foot"'),
    "side": ("aside", 'div class="sidebar"', 'div class="widget"', 'div class="related"'),
    "advert": ('div class="ad"', 'div class="advert"', 'div class="sponsored"',
               'section class="promo"', 'p class="ad"'),
    "notice": ('div class="cookie-notice"', 'div id="consent"', 'div class="notice"',
               'div role="alert"', 'div class="popup"', 'p class="notice"'),
    "comments": ('section id="comments"', 'div class="comments"', 'ol class="commentlist"',
                 'div class="reader-comments"', 'div class="comment"'),
    "form": ("form", 'div class="newsletter"', 'form class="search"', 'div class="login"'),
    "share": ('div class="share"', 'div class="social"'),
}


def _wrapped(rng: random.Random, kind: str, inside: str) -> str:
    wrapper = rng.choice(_WRAPPERS[kind])
    return f"<{wrapper}>{inside}</{wrapper.split()[0]}>"


def _told(rng: random.Random, tag: str, text: str) -> str:
    """A run of the main text in an element of its own; a paragraph may be a list or a quotation,
    and its first words a heading above it."""
    marked = lambda tag, text: f"<{tag} data-main-text>{entities.escape(text)}</{tag}>"
    words = text.split()
    if tag == "p" and len(words) > 12 and rng.random() < LISTED:
        first = rng.randint(2, 6)
        heading = marked(rng.choice(["h2", "h2", "h3", "h4"]), " ".join(words[:first]))
        return heading + marked("p", " ".join(words[first:]))
    if tag == "p" and rng.random() < LISTED:
        points = _SENTENCE_END.split(text)
        if len(points) > 1 and rng.random() < 0.6:
            kind = rng.choice(["ul", "ol"])
            return f"<{kind}>{''.join(marked('li', point) for point in points)}</{kind}>"
        return f"<blockquote>{marked('p', text)}</blockquote>"
    return marked(tag, text)


def variant(
    rng: random.Random, main: list[tuple[str, str]], other: list[str], foreign: list[str]
) -> str:
    """A page written anew about the same main text or its beginning, in other wrappers and places.

    ``main`` has (tag, text) of the main runs, ``other`` the short runs around them, ``foreign``
    paragraphs of other pages, which speak in sidebars, notices and comments. What belongs to
    the main text is marked by an attribute that features do not read.
    """
    escape = entities.escape
    short = lambda: escape(rng.choice(other)[:200]) if other else "More"
    long = lambda: escape(rng.choice(foreign)) if foreign else short()
    link = lambda: f'<a href="/x">{short()}</a>'
    if rng.random() < 0.5:  # many pages are short
        main = main[: rng.randint(1, 6)]
    heading = rng.choice(["h1", "h1", "h2", "h3"])
    tagged = [(heading if tag == "h1" else tag, text) for tag, text in main]
    blocks = [_told(rng, tag, text) for tag, text in tagged]
    several = lambda part, most: "".join(part() for _ in range(rng.randint(1, most)))

    def extra(kind: str) -> str:
        inside = {
            "advert": lambda: rng.choice([short(), f"<p>{long()}</p>", link()]),
            "side": lambda: rng.choice(
                [f"<h3>{short()}</h3><p>{long()}</p>", f"<ul><li>{link()}</li></ul>"]
            ),
            "form": lambda: f"<label>{short()}</label><input><p>{short()}</p>",
            "share": lambda: f"{link()} {link()}",
            "notice": lambda: rng.choice([f"<p>{long()}</p>", short()]),
            "comments": lambda: several(lambda: f"<div><p>{long()}</p></div>", 4),
        }
        return _wrapped(rng, kind, inside[kind]())

    for kind in ("advert", "side", "form", "share", "notice"):
        if rng.random() < 0.25:
            blocks.insert(rng.randint(0, len(blocks)), extra(kind))
    if rng.random() < 0.25:
        blocks.append(extra("comments"))
    body = _wrapped(rng, "main", "".join(blocks))
    if rng.random() < 0.4:
        body = f"<div>{body}</div>"
    head, tail = [], []
    if rng.random() < 0.6:
        tag = rng.choice(["h1", "p", "p"])
        head.append(_wrapped(rng, "header", f"<{tag}>{short()}</{tag}>"))
    if rng.random() < 0.85:
        items = several(lambda: f"<li>{link()}</li>", 8)
        head.append(_wrapped(rng, "menu", f"<ul>{items}</ul>"))
    for kind in ("notice", "advert", "form", "side", "comments", "share"):
        if rng.random() < 0.45:
            (tail if kind == "comments" or rng.random() < 0.5 else head).append(extra(kind))
    if rng.random() < 0.85:
        tail.append(_wrapped(rng, "footer", rng.choice([f"&copy; {short()}", f"<p>{short()}</p>"])))
    return "<html><body>" + "".join([*head, body, *tail]) + "</body></html>"


def _semantic_labels(page: Page) -> list[bool]:
    """Runs inside an article or main element and in no furniture within or around it.

    Of a page without such elements, long runs that are not mostly links, outside of furniture.
    """
    good, bad = set(_CONTENT_TAGS), set(_FURNITURE_TAGS)
    names = enumerate(TOKEN_GROUPS)
    furniture = sum(1 << g for g, name in names if name not in ("content", "share"))
    state = []
    for tag, parent, groups in zip(page.tag, page.parent, page.groups, strict=True):
        inside, outside = state[parent] if parent >= 0 else (False, False)
        state.append((inside or tag in good, outside or tag in bad or bool(groups & furniture)))
    if any(inside for inside, _ in state):
        return [inside and not outside for inside, outside in state]
    return [
        not outside and text is not None and len(text) >= LONG_RUN and 3 * links < len(text)
        for (_, outside), text, links in zip(state, page.text, page.links, strict=True)
    ]


def _upward(page: Page, runs: list[bool]) -> np.ndarray:
    """A node is to be kept when it holds any run that is."""
    keep = np.array([bool(t) and r for t, r in zip(page.text, runs, strict=True)])
    for node in range(len(keep) - 1, 0, -1):
        if keep[node]:
            keep[page.parent[node]] = True
    return keep


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    htmls = pa.Table.from_batches(parts).sort_by("page").column("html").to_pylist()
    rng = random.Random(11)
    pages, labels, stories, others = [], [], [], []
    for html in htmls:
        page = Page(html or "")
        runs = _semantic_labels(page)
        pages.append(page)
        labels.append(_upward(page, runs))
        main, around = [], []
        for node, text in enumerate(page.text):
            if text and runs[node]:
                parent = page.tag[page.parent[node]]
                name = TAGS[parent] if parent < OTHER else "p"
                main.append((name if name in STORY_TAGS else "p", text))
            elif text:
                around.append(text)
        stories.append(main)
        others.append(around)
    paragraphs = [text for main in stories for tag, text in main if tag == "p"]
    for main, around in zip(stories, others, strict=True):
        for _ in range(VARIANTS if main else 0):
            foreign = rng.sample(paragraphs, min(6, len(paragraphs)))
            page = Page(variant(rng, main, around, foreign))
            pages.append(page)
            labels.append(_upward(page, page.marked))
    table, _, _ = features(pages)
    model = BoostedTrees.fit(table, np.concatenate(labels).astype(float))
    yield pa.record_batch({"model": pa.array([model.to_bytes()], pa.binary())})


def train(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = TRAIN_PAGES
) -> bytes | None:
    """Trees fitted on at most ``sample`` of ``pages``, those with the least hashes of the id.

    Nobody has labelled pages, so labels come from pages that label themselves: what stands in an
    ``article`` or ``main`` element, outside of navigation and the like, is main text. Each such
    page is also rewritten ``VARIANTS`` times about the same text, in wrappers that say less and
    with sidebars, notices, adverts, forms and comments inserted, so that the trees learn
    from density, tokens and place what the tags alone said. One task fits the model; None
    when there are no pages.
    """
    rows = only(pages, page=id_col, html=html_col)
    chosen = rows.select("page").filter("page IS NOT NULL").distinct()
    chosen = chosen.orderBy(F.xxhash64("page"), "page").limit(sample)
    rows = rows.join(F.broadcast(chosen), "page").dropDuplicates(["page"])
    found = rows.repartition(1).mapInArrow(_fit_task, "model binary").collect()
    return bytes(found[0]["model"]) if found else None


def extract(htmls: list[str | None], model: BoostedTrees | None) -> list[str]:
    """Main text of each page, its blocks joined by newlines."""
    pages = [Page(html or "") for html in htmls]
    if not pages:
        return []
    table, parent, depth = features(pages)
    margins = np.ones(len(table)) if model is None else model.margins(table)
    keep = decode(margins, parent, depth).tolist()
    out, low = [], 0
    for page in pages:
        kept = keep[low : low + len(page.text)]
        out.append("\n".join(t for t, k in zip(page.text, kept, strict=True) if t and k))
        low += len(page.text)
    return out


def extract_main_text(
    pages: DataFrame,
    model: bytes | None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages``.

    Every block element and run of text of a page is scored by the trees, and the likeliest
    choice of nodes in which none is kept without its parent is taken; its runs, with character
    references decoded and white space made single, are joined in page order by newlines.
    NULL or empty html has an empty text. Without a model every run is kept. Extra columns are
    ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = None if model is None else BoostedTrees.from_bytes(model)
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_PAGES):
                part = batch.slice(low, BATCH_PAGES)
                texts = extract(part.column(2).to_pylist(), trees)
                yield pa.record_batch(
                    {
                        "page_id": part.column(0),
                        "url": part.column(1),
                        "text": pa.array(texts, pa.string()),
                        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    }
                )

    given = only(pages, page_id=id_col, url=url_col, html=html_col)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema][:2]
    return given.mapInArrow(rows, ", ".join([*kinds, "text string, n_chars bigint"]))
