"""HTML extraction: gradient-boosted trees over DOM nodes, decoded down the tree.

1. ``parse`` reads a page into a tree of block elements, whose leaves are text
   blocks (inline markup, comments, scripts, styles and forms are gone, character
   references decoded, white space runs made one space).
2. ``features`` describes every node: its tag and attribute tokens and those of
   its ancestors by learned log odds, the density of text, links and tags in its
   subtree, its depth, and how it compares with its siblings.
3. ``Boosted`` (histogram gradient boosting, logistic loss) gives each node the
   probability that its subtree holds main text.
4. ``decode`` picks the most likely labelling of the whole tree among those
   without contradiction: below a dropped node all is dropped, and an element
   is only kept with something kept in it. It is found by one pass up (best
   score of each subtree kept and dropped) and one down.

Pages carry no labels, so the model learns from ``TRAINING_PAGES`` labelled
pages that ``layouts`` composes from a fixed seed (menus, banners, sidebars,
adverts, notices, comments, forms, broken markup around an article); the same
model comes out everywhere.

A null, empty or text-free html gives the empty text. Text that is not markup
is one block of the body. Pages cut short are read as if all open elements
ended there. By rule only what holds no text of a page is left out: scripts, styles,
title, head, frames' fallbacks, templates and form controls. Whether something hidden is main text, the trees
decide. An element whose content is no markup hides what stands up to its end
tag; a self-closed one hides nothing, nor does one that never ends, but for
scripts, styles and text areas; a form control without an end ends with its block. Parsing
takes time in proportion to the page, however deep or broken its markup; a page is the
largest thing a task holds. Repeated rows give equal rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.llm import layouts
from subledger.llm.common import fresh, pieces, ship, text_or_empty

TRAINING_PAGES = 800
SEED = 7
CHUNK = 1 << 20

#: Elements that start a block of their own.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html ins legend li main menu nav noscript ol optgroup p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Of these the rest of the page is content if they never end.
OPEN = frozenset("script style textarea".split())
#: Elements whose text is none of the page.
MUTE = frozenset("template select datalist button head".split())
HEAD = RAW | frozenset("head base link meta template noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new element of the key ends an open one of the value, up to an element of SCOPE; others end a paragraph.
ENDS = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot", "tr", "td", "th"}, "option": {"option"},
    "tfoot": {"tbody", "thead", "tr", "td", "th"}, "body": {"head"}, "noscript": set(),
}
PARAGRAPH = frozenset(["p"])
SCOPE = frozenset("ul ol menu dl table div section article aside nav main header footer body html td th form template".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAMES = frozenset("class id role itemprop itemtype aria-label data-role data-component rel".split())
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
CLOSED = re.compile(r"(?:\A|[\s\"'])/\Z")
STOPS = re.compile(r"[.,;:!?]")


@lru_cache(256)
def end_tag(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I)


class Tree:
    """Nodes in page order: element nodes, and text blocks (tag ``#text``)."""

    def __init__(self):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["body"]
        self.attrs: list[str] = [""]
        self.text: list[str | None] = [None]
        self.linked: list[int] = [0]  # characters of a text block that are inside links

    def node(self, parent: int, tag: str, attrs: str, text: str | None = None, linked: int = 0) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1


def hidden(attrs: str) -> bool:
    if "hidden" not in attrs and "none" not in attrs:
        return False
    for name, *value in ATTRIBUTE.findall(attrs):
        text = "".join(value).lower().replace(" ", "")
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and text == "true" or name == "style" and "display:none" in text:
            return True
    return False


class Open:
    """The open elements, with how many there are of each tag, in all and in each scope."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = [("body", 0)]  # inline ones have the node of their block
        self.counts: Counter = Counter()
        self.scopes: list[tuple[str, Counter]] = [("body", Counter())]  # an element of SCOPE and what is open since, itself included
        self.inline: Counter = Counter()  # (node, tag) of inline ones
        self.links = self.mutes = 0

    def push(self, tag: str, node: int, block: bool) -> None:
        self.stack.append((tag, node))
        self.counts[tag] += 1
        if tag in SCOPE:
            self.scopes.append((tag, Counter()))
        self.scopes[-1][1][tag] += 1
        if not block:
            self.inline[node, tag] += 1
        self.links += tag == "a"
        self.mutes += tag in MUTE

    def pop(self) -> str:
        tag, node = self.stack.pop()
        self.counts[tag] -= 1
        self.scopes[-1][1][tag] -= 1
        if tag in SCOPE:
            self.scopes.pop()
        if tag not in BLOCK:
            self.inline[node, tag] -= 1
        self.links -= tag == "a"
        self.mutes -= tag in MUTE
        return tag

    def close(self, tag: str) -> None:
        while len(self.stack) > 1 and self.pop() != tag:
            pass

    def imply(self, ends: frozenset | set) -> None:
        """End the elements of ``ends`` in this scope, with all that is open in them."""
        left = 0
        for owner, counts in reversed(self.scopes):
            left += sum(counts[t] for t in ends)
            if owner not in ends:
                break
        i, cut = len(self.stack) - 1, None
        while left > 0:  # whatever is passed on the way ends too
            if self.stack[i][0] in ends:
                cut, left = i, left - 1
            i -= 1
        if cut:
            while len(self.stack) > cut:
                self.pop()


def parse(page: str) -> Tree:
    tree = Tree()
    open_ = Open()
    run: list[str] = []  # the text block being read, and which parts of it are links
    links: list[bool] = []
    last_end: dict[str, int] = {}

    def ends_later(tag: str) -> bool:
        """Whether an end tag follows; each tag's last one is looked up once."""
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in end_tag(tag).finditer(page, at)), default=-1)
        return at <= last_end[tag]

    def flush() -> None:
        nonlocal run, links
        if run:
            text = " ".join("".join(map(html.unescape, run)).split())
            if text:
                linked = sum(len(x) for x, link in zip(run, links, strict=True) if link)
                tree.node(open_.stack[-1][1], "#text", "", text, min(linked, len(text)))
            run, links = [], []

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and not open_.mutes:
            run.append(page[at:stop])
            links.append(open_.links > 0)
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue  # comment, doctype, instruction
        closing, attrs = found[1] or found[4], found[3] or found[6] or ""
        if tag in RAW and not closing:  # up to its end tag, whatever stands between
            if CLOSED.search(attrs) or tag not in OPEN and attrs.endswith("/"):
                continue  # ends at its own tag
            close = end_tag(tag).search(page, at) if ends_later(tag) else None
            at = close.end() if close else end if tag in OPEN else at
            continue
        if open_.stack[-1][0] == "head" and not closing and tag not in HEAD:
            open_.pop()  # an element that no head can have ends it
        if closing:
            if tag in BLOCK or tag in MUTE:
                if open_.counts[tag]:
                    if tag in BLOCK:
                        flush()
                    open_.close(tag)
                elif tag == "p":
                    flush()
            elif open_.inline[open_.stack[-1][1], tag]:
                open_.close(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br" and run:
                run.append("\n")
                links.append(False)
            continue
        if tag in BLOCK:
            flush()
            open_.imply(ENDS.get(tag, PARAGRAPH))
            if tag in ("html", "body"):  # the root stands for both
                tree.attrs[0] += f" {attrs}" if tag == "body" else ""
                continue
            open_.push(tag, tree.node(open_.stack[-1][1], tag, attrs), True)
        elif tag not in MUTE:
            open_.push(tag, open_.stack[-1][1], False)
        elif not attrs.endswith("/") and ends_later(tag):  # one that never ends hides nothing
            if open_.counts[tag] and tag != "template":
                flush()
                open_.close(tag)
            open_.push(tag, open_.stack[-1][1], False)
    flush()
    return tree


# --- features ---------------------------------------------------------------

FEATURES = (
    "tag odds, attribute odds: sum, least, most; parent's tag and attribute odds; path least, most;"
    " text, blocks, link density, words per block, stops per word, elements per character, depth,"
    " position, share of page, share of parent, siblings, place among them, siblings of its tag,"
    " siblings' text, list items, is text, is hidden, is in something hidden"
)


@lru_cache(1 << 16)
def tokens(attrs: str) -> tuple[str, ...]:
    """Lower-case word parts of the attributes that say what an element is for."""
    out = []
    for name, *value in ATTRIBUTE.findall(attrs):
        if name.lower() in NAMES:
            out += [p.lower() for p in PART.findall("".join(value))]
    return tuple(out)


class Odds:
    """Log odds of main text by tag and by attribute token, from training nodes."""

    def __init__(self, tags: dict[str, float], parts: dict[str, float]):
        self.tags, self.parts = tags, parts
        self.cache: dict[tuple[str, str], tuple[float, ...]] = {}

    def part(self, token: str) -> list[float]:
        """The odds of a token; of an unknown one, those of a known one it begins or ends with."""
        if token in self.parts:
            return [self.parts[token]]
        inside = {token[:i] for i in range(4, len(token))} | {token[i:] for i in range(1, len(token) - 3)}
        near = [self.parts[t] for t in inside if t in self.parts]
        return [min(near) if min(near) < 0 else max(near)] if near else []

    def of(self, tag: str, attrs: str) -> tuple[float, ...]:
        """tag, attribute sum, least and most."""
        got = self.cache.get((tag, attrs))
        if got is None:
            known = [x for t in tokens(attrs) for x in self.part(t)] or [0.0]
            got = (self.tags.get(tag, 0.0), sum(known), min(known), max(known))
            if len(self.cache) > 100_000:
                self.cache.clear()
            self.cache[tag, attrs] = got
        return got


def log_odds(pairs: list[tuple[str, int]]) -> dict[str, float]:
    yes, all_ = {}, {}
    for name, label in pairs:
        yes[name] = yes.get(name, 0) + label
        all_[name] = all_.get(name, 0) + 1
    base = sum(yes.values()) / max(1, len(pairs))
    at = lambda p: np.log(p / (1 - p))
    return {
        k: float(at((yes[k] + 4 * base) / (n + 4)) - at(base)) for k, n in all_.items() if n >= 3
    }


def features(tree: Tree, odds: Odds) -> np.ndarray:
    n = len(tree.tag)
    parent = np.array(tree.parent)
    own = np.array([odds.of(t, a) for t, a in zip(tree.tag, tree.attrs, strict=True)])
    is_text = np.array([t is not None for t in tree.text])
    size = np.array([len(t) if t else 0 for t in tree.text], float)
    total = np.zeros((n, 6))  # characters, linked, words, stops, blocks, elements
    total[:, 0], total[:, 1] = size, tree.linked
    total[:, 2] = [t.count(" ") + 1 if t else 0 for t in tree.text]
    total[:, 3] = [len(STOPS.findall(t)) if t else 0 for t in tree.text]
    total[:, 4], total[:, 5] = is_text, ~is_text
    items = np.array([t == "li" for t in tree.tag], float)
    begin = np.cumsum(size) - size
    depth = np.zeros(n)
    concealed = np.array([hidden(a) for a in tree.attrs], float)
    within = concealed.copy()
    low, high = own[:, 0] + own[:, 2], own[:, 0] + own[:, 3]
    for i in range(1, n):  # parents come before their children
        p = parent[i]
        depth[i] = depth[p] + 1
        within[i] = max(within[i], within[p])
        low[i], high[i] = min(low[i], low[p]), max(high[i], high[p])
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
        items[parent[i]] += items[i]
    kids = np.bincount(parent[1:], minlength=n).astype(float)
    place = np.zeros(n)
    seen: dict[int, int] = {}
    same: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        place[i] = seen[parent[i]] = seen.get(parent[i], -1) + 1
        same[parent[i], tree.tag[i]] = same.get((parent[i], tree.tag[i]), 0) + 1
    up = np.maximum(parent, 0)
    beside = np.maximum(kids[up] - 1, 0)
    alike = np.array([same.get((parent[i], tree.tag[i]), 1) - 1 for i in range(n)], float)
    chars = np.maximum(total[:, 0], 1)
    rest = np.maximum(total[up, 0] - total[:, 0], 0)
    return np.column_stack(
        [
            own, own[up, 0], own[up, 1], low[up], high[up], np.log1p(total[:, 0]), np.log1p(total[:, 4]),
            total[:, 1] / chars, total[:, 2] / np.maximum(total[:, 4], 1), total[:, 3] / np.maximum(total[:, 2], 1),
            total[:, 5] / chars, depth, begin / max(1.0, total[0, 0]), total[:, 0] / max(1.0, total[0, 0]),
            total[:, 0] / np.maximum(total[up, 0], 1), beside, place / np.maximum(beside, 1),
            alike / np.maximum(beside, 1), np.log1p(rest / np.maximum(beside, 1)), np.log1p(items), is_text, concealed, within,
        ]
    ).astype(np.float32)


# --- boosting ---------------------------------------------------------------


class Boosted:
    """Gradient-boosted trees for two classes: histogram splits, complete trees of one depth."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 4.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        grid = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], grid)) for j in range(x.shape[1])]
        b, n_bins = self.binned(x), self.bins
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.base)
        self.trees = []
        for _ in range(self.rounds):
            prob = 1 / (1 + np.exp(-score))
            grad, hess = y - prob, prob * (1 - prob)
            node = np.zeros(len(y), np.int64)
            feature, edge = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, 255)
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                local = node - first
                gains = np.full((width, x.shape[1], n_bins), -np.inf)
                for j in range(x.shape[1]):
                    slot = local * n_bins + b[:, j]
                    g = np.bincount(slot, grad, width * n_bins).reshape(width, n_bins)
                    h = np.bincount(slot, hess, width * n_bins).reshape(width, n_bins)
                    gl, hl = g.cumsum(1), h.cumsum(1)
                    gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1)
                    gain[(hl < self.least) | (hr < self.least)] = -np.inf
                    gains[:, j] = gain
                flat = gains.reshape(width, -1)
                best = flat.argmax(1)
                for k in range(width):
                    if np.isfinite(flat[k, best[k]]):
                        feature[first + k], edge[first + k] = divmod(int(best[k]), n_bins)
                right = b[np.arange(len(y)), feature[node]] > edge[node]
                node = 2 * node + 1 + right
            leaf = node - ((1 << self.depth) - 1)
            g = np.bincount(leaf, grad, 1 << self.depth)
            value = self.rate * g / (np.bincount(leaf, hess, 1 << self.depth) + 1)
            score += value[leaf]
            self.trees.append((feature, edge, value))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of main text."""
        b = self.binned(x)
        rows, score = np.arange(len(x)), np.full(len(x), self.base)
        for feature, edge, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] > edge[node])
            score += value[node - ((1 << self.depth) - 1)]
        return score


def decode(tree: Tree, margin: np.ndarray) -> np.ndarray:
    """The most likely labelling of the nodes without contradiction.

    Scores are relative to dropping everything: keeping a node adds its log
    odds. ``best`` is a node's score if kept; it must keep a child if it has any.
    """
    n = len(tree.tag)
    best = margin.astype(float).tolist()
    gain = [0.0] * n  # of the children worth keeping
    least = [-np.inf] * n  # the best child, if none is
    for i in range(n - 1, 0, -1):
        if tree.text[i] is None:
            best[i] = best[i] + (gain[i] if gain[i] > 0 else least[i])
        p = tree.parent[i]
        gain[p] += max(best[i], 0.0)
        least[p] = max(least[p], best[i])
    keep = np.zeros(n, bool)
    forced = [-1] * n  # a kept element without a child worth keeping keeps its best one
    for i in range(1, n):
        p = tree.parent[i]
        if forced[p] < 0 or best[i] > best[forced[p]]:
            forced[p] = i
    keep[0] = gain[0] > 0
    for i in range(1, n):
        p = tree.parent[i]
        keep[i] = keep[p] and (best[i] > 0 or gain[p] <= 0 and forced[p] == i)
    return keep


# --- training and use -------------------------------------------------------


class Extractor:
    def __init__(self, odds: Odds, model: Boosted):
        self.odds, self.model = odds, model

    def texts(self, pages: list[str]) -> list[str]:
        trees = [parse(p) for p in pages]
        made = [features(t, self.odds) for t in trees]
        margin = self.model.margin(np.concatenate(made)) if made else np.zeros(0)
        out, at = [], 0
        for tree in trees:
            keep = decode(tree, margin[at : at + len(tree.tag)])
            at += len(tree.tag)
            out.append("\n".join(t for t, k in zip(tree.text, keep, strict=True) if k and t))
        return out


def labelled(page: str, wanted: frozenset[str]) -> tuple[Tree, np.ndarray]:
    """The tree of a composed page; 1 for text blocks in ``wanted`` and what they are in."""
    tree = parse(page)
    label = np.array([t in wanted if t else False for t in tree.text])
    for i in range(len(label) - 1, 0, -1):
        label[tree.parent[i]] |= label[i]
    return tree, label.astype(int)


@lru_cache(1)
def trained(n_pages: int = TRAINING_PAGES, seed: int = SEED) -> Extractor:
    """The extractor that ``n_pages`` composed pages give; the bound on what is learned from."""
    sample = [labelled(*x) for x in layouts.compose(n_pages, seed)]
    tags = [(t, y) for tree, label in sample for t, y in zip(tree.tag, label, strict=True)]
    parts = [
        (part, y) for tree, label in sample for a, y in zip(tree.attrs, label, strict=True) for part in set(tokens(a))
    ]
    odds = Odds(log_odds(tags), log_odds(parts))
    x = np.concatenate([features(tree, odds) for tree, _ in sample])
    return Extractor(odds, Boosted().fit(x, np.concatenate([y for _, y in sample])))


def extracted(pages: DataFrame, name: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html``."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(trained())

    @F.pandas_udf("string")
    def main_text(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in column:
            rows, out = list(batch), []
            for a, b in pieces(rows, CHUNK):
                out += model.texts(rows[a:b])
            yield pd.Series(out, dtype=object)

    (made,) = fresh(pages, "made")
    return pages.withColumn(made, main_text(text_or_empty("html"))).select(
        *[F.col(f"`{c}`") for c in pages.columns if c.lower() != name.lower()], F.col(made).alias(name)
    )
