"""Main text of web pages by a tree-structured graphical model.

Nodes of the DOM are content or not. A node has a potential from its features, an edge one for each
pair of labels of parent and child, by the kind of the child. Sum-product messages go from the
leaves up and from the root down; what a text leaf has collected is its marginal, and leaves that
are content with a probability over one half make up the text. The weights maximise the likelihood
of labelled pages, whose expectations the same messages give.

Many children of one element are alike and no independent witnesses: messages of more than 16 to
their parent are scaled to the weight of 16, so that a long list cannot outvote its element.

Labelled pages are built from page parts here, plus a bounded sample of labelled pages of the
caller. Many pages are laid out as one forest, so that a level of all their trees is one array step.

A null page is an empty page; a page without content has an empty text. Unclosed, stray and unknown
tags are tolerated. Repeated rows are each answered; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import in_share, slices, small_batches, texts
from abacist.llm.html_parts import built_pages
from abacist.llm.html_tree import FEATURES, LEAF, Page, folded

KINDS = 4
_BATCH_BYTES = 2 << 20
_SHORT = 20
_CROWD = 16.0


class Forest:
    """The trees of several pages as arrays."""

    def __init__(self, pages: list[Page]):
        parent, kind, depth, nodes, names, values = [], [], [], [], [], []
        self.starts = []
        for page in pages:
            base = len(parent)
            self.starts.append(base)
            parent += [p + base if p >= 0 else -1 for p in page.parent]
            kind += page.kind
            depth += page.depth
            a, b, c = page.features()
            nodes += [i + base for i in a]
            names += b
            values += c
        self.n = len(parent)
        self.parent, self.kind = np.array(parent, np.int64), np.array(kind, np.int64)
        depth = np.array(depth, np.int64)
        order = np.argsort(depth, kind="stable")
        cuts = np.flatnonzero(np.diff(depth[order])) + 1
        self.levels = np.split(order, cuts) if self.n else []
        self.nodes, self.names, self.values = np.array(nodes, np.int64), np.array(names, np.int64), np.array(values)
        self.leaf = self.kind == LEAF
        children = np.bincount(self.parent[self.parent >= 0], minlength=self.n)
        self.weight = np.where(self.parent >= 0, _CROWD / np.maximum(children[self.parent], _CROWD), 1.0)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.nodes, self.values * weights[self.names], minlength=self.n)

    def marginals(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of content per node, and of each pair of labels (parent, child) per edge."""
        own = np.stack([np.zeros(self.n), self.scores(weights)], axis=1)
        table = edges[self.kind]
        up = np.zeros((self.n, 2))
        below = own.copy()
        for level in reversed(self.levels[1:]):
            up[level] = np.logaddexp.reduce(table[level] + below[level][:, None, :], axis=2)
            up[level] *= self.weight[level][:, None]
            np.add.at(below, self.parent[level], up[level])
        above = np.zeros((self.n, 2))
        pairs = np.zeros((self.n, 2, 2))
        for level in self.levels[1:]:
            parent = self.parent[level]
            rest = below[parent] + above[parent] - up[level]
            joint = rest[:, :, None] + table[level] + below[level][:, None, :]
            pairs[level] = joint
            down = np.logaddexp.reduce(rest[:, :, None] + table[level], axis=1)
            above[level] = down - down.max(axis=1, keepdims=True)
        belief = below + above
        content = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        pairs = np.exp(pairs - np.logaddexp.reduce(pairs.reshape(-1, 4), axis=1)[:, None, None])
        return content, pairs


class Model:
    def __init__(self, weights: np.ndarray, edges: np.ndarray):
        self.weights, self.edges = weights, edges

    def extract(self, html: list[str]) -> list[str]:
        """Main text of each page."""
        pages = [Page(h) for h in html]
        forest = Forest(pages)
        content, _ = forest.marginals(self.weights, self.edges)
        keep = content > 0.5
        ends = [*forest.starts[1:], forest.n]
        return [p.main_text(keep[a:b]) for p, a, b in zip(pages, forest.starts, ends)]


def _labels(page: Page, main: str | None) -> np.ndarray:
    """1 for content: what stands in a marked element, or whose text the given main text holds.

    Elements are content if they are marked so, or if nearly all of their text is. Short texts may be
    in the main text by chance; they count only inside an element that is content by its longer ones.
    """
    n = len(page.parent)
    size, good = np.zeros(n), np.zeros(n)
    marked = np.zeros(n, bool)
    short = []
    for i in range(n):
        if i:
            marked[i] = marked[page.parent[i]]
        if "data-main" in page.flags[i]:
            marked[i] = 'data-main="1"' in page.flags[i]
        if page.text[i] is not None:
            text = folded(page.text[i])
            if main is None:
                hit = marked[i]
            elif len(text) < _SHORT:
                if text in main:
                    short.append(i)
                continue
            else:
                hit = text in main
            size[i] = len(text)
            good[i] = size[i] if hit else 0
    for i in range(n - 1, 0, -1):
        size[page.parent[i]] += size[i]
        good[page.parent[i]] += good[i]
    labels = marked.copy() if main is None else (size > 0) & (good >= 0.95 * size)
    for i in short:
        up = page.parent[i]
        while up > 0 and not size[up]:
            up = page.parent[up]
        if labels[up]:
            up = i
            while up >= 0 and not size[up]:
                labels[up] = True
                up = page.parent[up]
    return labels.astype(np.int64)


def train(labelled: list[tuple[str, str | None]], rounds: int = 300, step: float = 1.0, decay: float = 1e-5) -> Model:
    """Maximum likelihood by gradient ascent; pages without a main text carry ``data-main`` marks."""
    pages = [Page(h) for h, _ in labelled]
    y = np.concatenate([_labels(p, m) for p, (_, m) in zip(pages, labelled)])
    forest = Forest(pages)
    inner = forest.parent >= 0
    seen = np.zeros((forest.n, 2, 2))
    seen[np.flatnonzero(inner), y[forest.parent[inner]], y[inner]] = 1
    weights, edges = np.zeros(len(FEATURES)), np.zeros((KINDS, 2, 2))
    sums = [np.zeros_like(weights), np.zeros_like(edges)]
    for _ in range(rounds):
        content, pairs = forest.marginals(weights, edges)
        pull = np.bincount(forest.names, forest.values * (y - content)[forest.nodes], minlength=len(weights))
        turn = np.zeros_like(edges)
        np.add.at(turn, forest.kind[inner], (seen - pairs)[inner])
        for at, (value, slope) in enumerate(((weights, pull), (edges, turn))):
            slope = slope / len(pages) - decay * value
            sums[at] += slope**2
            value += step * slope / np.sqrt(sums[at] + 1e-8)
    return Model(weights, edges)


def _extract(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", _BATCH_BYTES):
        found = model.extract(texts(batch.column("html")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def linked_pages(pages: DataFrame, docs: DataFrame, most: int = 200) -> DataFrame:
    """About ``most`` pages (html, main) whose address ends in the number of a document with the same text."""
    number = F.regexp_extract("url", r"/(\d{1,18})(?:\.html|/)?(?:[?#].*)?$", 1)
    rows = pages.select(F.when(number != "", number.cast("long")).alias("doc_id"), "html").where("doc_id IS NOT NULL")
    n = pages.count()
    rows = rows.where(in_share(F.xxhash64("doc_id"), most, n))
    rows = rows.orderBy("doc_id", F.xxhash64("html")).limit(2 * most)  # one number may be on very many pages
    main = docs.select("doc_id", F.col("text").alias("main")).where(F.length("main") > 0)
    return main.join(F.broadcast(rows), "doc_id").select("html", "main")


def main_texts(
    pages: DataFrame,
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    ``labelled`` (html, main) is a bounded number of pages that help to train the model.
    """
    small_batches(pages.sparkSession)
    given = [] if labelled is None else sorted((r[0], folded(r[1])) for r in labelled.collect())
    model = train([*built_pages(), *((h, m) for h, m in given if h and m)])
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    return rows.mapInArrow(partial(_extract, model=model), "page_id long, url string, text string, n_chars long")
