"""Main-text extraction by a tree-structured graphical model of the page.

Every block element and text run of the page's DOM is a binary variable (main
text or not).  Node potentials come from the tag, its class and id words, link
density and text size; parent-child potentials, one table for elements and
one for text runs, couple neighbours.  The graph is a tree, so sum-product
messages, up from the leaves and down from the root, give exact marginals;
the parameters maximise the likelihood of labelled pages
(``labelled_pages``), with the same messages in the gradient.  A text run is
kept when its marginal is at least one half.

Pages are handled in batches: all trees of a batch are one forest, and a
message pass is one numpy step per depth level.

Defined cases: a null page is the empty page; a page without main text gives
the empty string; repeated pages each give a row; markup that is cut off or
badly nested is repaired as HTML prescribes.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import Page, parse
from .labelled_pages import MAIN, OTHER, labelled_page
from .tables import prepare
from .textkit import as_batch

TRAINING_PAGES = 400
PAGES_AT_ONCE = 64

TAGS = ("#page", "#text", "html", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li",
        "dl", "nav", "header", "footer", "aside", "form", "table", "tr", "td", "blockquote", "pre", "figure", "other")
#: Word groups of class and id names, by prefix of a name's parts.
NAMES = (
    ("nav", "menu", "breadcrumb", "topbar"), ("foot", "bottom", "copyright", "legal"), ("head", "mast", "top", "logo"),
    ("side", "widget", "related", "popular", "recommend", "more", "tag", "aside"),
    ("ad", "ads", "advert", "sponsor", "promo"),
    ("cookie", "consent", "gdpr", "notice", "alert", "banner", "newsletter", "subscribe", "popup", "modal"),
    ("comment", "discuss", "repl", "disqus", "respond", "review"), ("share", "social", "meta", "byline"),
    ("content", "article", "post", "entry", "story", "main", "text", "body"),
)
_WHOLE = {"ad", "ads", "top", "tag", "more", "side"}
_PARTS = re.compile(r"[a-z]+")
_TAG_NO = {t: i for i, t in enumerate(TAGS)}


@functools.lru_cache(maxsize=4096)
def _name_groups(names: str) -> tuple[int, ...]:
    parts = _PARTS.findall(names)
    return tuple(g for g, keys in enumerate(NAMES)
                 if any(p == k if k in _WHOLE else p.startswith(k) for p in parts for k in keys)
                 or ("sidebar" in parts and g == 3))


_SIZES = (1, 25, 60, 120, 250, 600)
N_FEATURES = 1 + len(TAGS) + len(NAMES) + 4 + 4 + len(_SIZES) + 4


class Forest:
    """The nodes of several pages, with features and depth levels."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.tag) for p in pages]
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        n = int(self.base[-1])
        self.parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + b)
                                      for p, b in zip(pages, self.base.tolist())]) if pages else np.zeros(0, np.int64)
        self.leaf = np.array([t == "#text" for p in pages for t in p.tag], bool)
        depth = [0] * n
        parent = self.parent.tolist()
        for i in range(n):
            if parent[i] >= 0:
                depth[i] = depth[parent[i]] + 1
        depth = np.array(depth, np.int64)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if n else []
        self.x = self._features(pages, n)

    def _features(self, pages: list[Page], n: int) -> np.ndarray:
        x = np.zeros((n, N_FEATURES), np.float32)
        x[:, 0] = 1
        x[np.arange(n), 1 + np.array([_TAG_NO.get(t, len(TAGS) - 1) for p in pages for t in p.tag], np.int64)] = 1
        at = 1 + len(TAGS)
        i = 0
        for p in pages:
            for names in p.names:
                if names:
                    for g in _name_groups(names):
                        x[i, at + g] = 1
                i += 1
        at += len(NAMES)
        size = np.array([len(t) for p in pages for t in p.text], np.float64)
        linked = np.array([c for p in pages for c in p.linked], np.float64)
        stops = np.array([t.count(".") + t.count(",") for p in pages for t in p.text], np.float64)
        below, below_linked = size.copy(), linked.copy()
        for level in reversed(self.levels[1:]):
            np.add.at(below, self.parent[level], below[level])
            np.add.at(below_linked, self.parent[level], below_linked[level])
        page = np.repeat(np.arange(len(pages)), np.diff(self.base))
        density = below_linked / np.maximum(below, 1)
        x[np.arange(n), at + np.digitize(density, (0.05, 0.35, 0.7))] = 1
        at += 4
        whole = below[self.base[:-1]][page] if n else below
        x[np.arange(n), at + np.digitize(below / np.maximum(whole, 1), (0.05, 0.3, 0.6))] = 1
        at += 4
        x[:, at:at + len(_SIZES)] = below[:, None] >= np.array(_SIZES)
        at += len(_SIZES)
        x[:, at] = self.leaf & (stops >= 1)
        x[:, at + 1] = self.leaf & (stops >= 3)
        x[:, at + 2] = np.array([t.endswith((".", "!", "?")) for p in pages for t in p.text], bool) if n else 0
        x[:, at + 3] = np.array([t.startswith("©") for p in pages for t in p.text], bool) if n else 0
        return x

    def messages(self, node: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(log marginals of the nodes, of each node jointly with its parent,
        log partition sum) from the log potentials ``node[n, 2]`` and
        ``edge[kind, parent, child]``, by an upward and a downward pass."""
        kind = self.leaf.astype(int)
        up = node.copy()                                # node with all messages from below
        sent = np.zeros_like(node)                      # message of a node to its parent
        for level in reversed(self.levels[1:]):
            sent[level] = _lse(edge[kind[level]] + up[level][:, None, :], 2)
            np.add.at(up, self.parent[level], sent[level])
        total = _lse(up[self.levels[0]], 1).sum()
        belief = up.copy()
        pair = np.zeros((len(node), 2, 2))
        for level in self.levels[1:]:
            above = belief[self.parent[level]] - sent[level]     # parent without this child
            joint = above[:, :, None] + edge[kind[level]] + up[level][:, None, :]
            pair[level] = joint
            belief[level] = _lse(joint, 1)
        belief -= _lse(belief, 1)[:, None]
        pair -= _lse(pair.reshape(len(node), 4), 1)[:, None, None]
        return belief, pair, float(total)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (np.log(np.exp(a - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _node_potential(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    z = x @ w
    return np.stack([np.zeros_like(z), z], 1)


def train(pages: list[tuple[Page, np.ndarray]], steps: int = 250, rate: float = 0.08, ridge: float = 0.3
          ) -> tuple[np.ndarray, np.ndarray]:
    """(node weights, edge potentials) that maximise the likelihood of pages
    with known states, by Adam on the exact gradient."""
    forest = Forest([p for p, _ in pages])
    state = np.concatenate([s for _, s in pages]).astype(int)
    child = np.flatnonzero(forest.parent >= 0)
    kind = forest.leaf.astype(int)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind[child], state[forest.parent[child]], state[child]), 1)
    w, edge = np.zeros(N_FEATURES), np.zeros((2, 2, 2))
    moments = [np.zeros(w.size + edge.size) for _ in range(2)]
    for t in range(1, steps + 1):
        belief, pair, _ = forest.messages(_node_potential(forest.x, w), edge)
        gw = forest.x.T @ (state - np.exp(belief[:, 1])) - ridge * w
        expected = np.zeros_like(edge)
        np.add.at(expected, kind[child], np.exp(pair[child]))
        g = np.concatenate([gw, (seen - expected - ridge * edge).ravel()]) / len(state)
        moments[0] += 0.1 * (g - moments[0])
        moments[1] += 0.01 * (g * g - moments[1])
        step = rate * (moments[0] / (1 - 0.9 ** t)) / (np.sqrt(moments[1] / (1 - 0.99 ** t)) + 1e-8)
        w += step[:w.size]
        edge += step[w.size:].reshape(edge.shape)
    return w, edge


def training_set(n: int = TRAINING_PAGES) -> list[tuple[Page, np.ndarray]]:
    """Parsed labelled pages; an element is main if nearly all its text is."""
    out = []
    for seed in range(n):
        page = parse(labelled_page(seed))
        total = np.array([len(t) for t in page.text], float)
        main = np.array([len(t) * t.startswith(MAIN) for t in page.text], float)
        page.text = [t.replace(MAIN, "").replace(OTHER, "") for t in page.text]
        for i in range(len(page.tag) - 1, 0, -1):
            total[page.parent[i]] += total[i]
            main[page.parent[i]] += main[i]
        out.append((page, (main >= 0.8 * total) & (total > 0)))
    return out


def main_texts(sources: list[str], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    w, edge = model
    out = []
    for lo in range(0, len(sources), PAGES_AT_ONCE):
        pages = [parse(s) for s in sources[lo:lo + PAGES_AT_ONCE]]
        forest = Forest(pages)
        belief, _, _ = forest.messages(_node_potential(forest.x, w), edge)
        keep = (forest.leaf & (belief[:, 1] >= np.log(0.5))).tolist()
        for p, b in zip(pages, forest.base.tolist()):
            out.append("\n".join(t for i, t in enumerate(p.text) if keep[b + i]))
    return out


def extract(pages: DataFrame, *, html_col: str = "html", training_pages: int = TRAINING_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = prepare(pages)
    sent = spark.sparkContext.broadcast(train(training_set(training_pages)))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for lo in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(lo, PAGES_AT_ONCE)
                texts = main_texts([h or "" for h in part.column(2).to_pylist()], sent.value)
                yield as_batch(schema, part.column(0), part.column(1), texts)

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col(html_col).alias("html"))
            .mapInArrow(run, "page_id long, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("long")))
