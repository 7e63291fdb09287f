"""Benchmark passages inside documents by the q-gram lemma and banded alignment.

Texts are lower-cased and their white space is folded. An occurrence of a passage of m characters
with at most k edits shares at least ``m - q + 1 - k q`` q-grams with it, and all of them lie on
diagonals (position in the text minus position in the passage) that are at most k apart. So shared
q-grams are counted in diagonal bands of width 2 (k + 1), each overlapping the next by half, and
regions that reach the bound are aligned with the passage inside their band. ``k`` is ``rate`` times
m, rounded down; q is 8, or the largest number for which the bound is positive if that is less. Passages of
one q are searched together, so that short ones cost the others nothing.

Null and empty passages match nothing; a passage of a few characters is found wherever they stand.
A null document is empty and matches nothing. Documents are searched whole. Equal passages with
different ids are each reported, and so are repeated documents; repeated benchmark rows count once. Of occurrences with
equally many edits the first counts. Other columns than id and text play no part. Empty tables give empty results.

The benchmark is searched for in blocks of bounded size: one index per block goes along with the
tasks, every block is held against all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import slices, small_batches, texts

Q = 8
_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BATCH_BYTES = 256 << 10  # while it is looked up, a text takes some twenty times its size
HITS = "doc_id long, item_id long, distance long, start long, end long"


def fold(text: str) -> str:
    """Lower case, one space for white space, none at the ends."""
    return " ".join(text.lower().split())


def _symbols(text: str) -> np.ndarray:
    """One byte per character; equal characters give equal bytes, so no shared q-gram is lost."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return (points ^ (points >> 7)).astype(np.uint8)


def _grams(symbols: np.ndarray, q: int) -> np.ndarray:
    """The q-gram at every position as a 64-bit number."""
    if len(symbols) < q:
        return np.empty(0, np.uint64)
    held = symbols.tobytes() + bytes(Q - q)
    return np.ndarray((len(symbols) - q + 1,), "<u8", buffer=held, strides=(1,)) & np.uint64((1 << 8 * q) - 1)


def align(passage: np.ndarray, text: np.ndarray, first: int, width: int) -> tuple[int, int]:
    """Least edits between the passage and a part of the text, and where that part ends.

    Only diagonals ``first .. first + width - 1`` are looked at.
    """
    far = len(passage) + len(text)
    cells = np.arange(width)
    at = first + cells  # position in the text before the passage's first character
    row = np.where((at >= 0) & (at <= len(text)), 0, far)
    padded = np.append(text.astype(np.int64), -1)
    for i, symbol in enumerate(passage.tolist()):
        at = first + i + cells
        inside = (at >= 0) & (at < len(text))
        same = padded[np.where(inside, at, len(text))] == symbol
        best = np.where(inside, row + ~same, far)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)  # a character of the passage is missing
        best = np.minimum.accumulate(best - cells) + cells  # characters too many in the text
        row = np.where((at + 1 >= 0) & (at + 1 <= len(text)), best, far)
    end = int(np.argmin(row))
    return int(row[end]), first + len(passage) + end


def edits(m: int, rate: float) -> tuple[int, int]:
    """Budget of a passage of m characters, and the longest q-gram that certifies it."""
    k = min(int(rate * m), m - 1)
    return k, min(Q, m // (k + 1))


class Passages:
    """Indexes of a block of passages, one for each length of q-grams."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        by_q: dict[int, list[tuple[int, str]]] = {}
        for i, text in items:
            if text := fold(text):
                by_q.setdefault(edits(len(text), rate)[1], []).append((i, text))
        self.parts = [_Passages(by_q[q], rate, q) for q in sorted(by_q)]

    def search(self, documents: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(number of the document, item id, edits, start, end) of the best occurrence of each pair."""
        documents = [fold(t) for t in documents]
        for part in self.parts:
            yield from part.search(documents)


class _Passages:
    """Index of the q-grams of folded passages."""

    def __init__(self, items: list[tuple[int, str]], rate: float, q: int):
        self.q = q
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.array([edits(len(t), rate)[0] for t in self.texts], np.int64)
        self.bound = m - q + 1 - self.budget * q
        grams = [_grams(_symbols(t), q) for t in self.texts]
        codes = np.concatenate([*grams, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(m)), [len(g) for g in grams])
        offset = np.concatenate([np.arange(len(g)) for g in grams] + [np.empty(0, np.int64)])
        order = np.argsort(codes, kind="stable")
        self.item, self.offset = item[order], offset[order].astype(np.int64)
        self.codes, self.first, self.count = np.unique(codes[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[self._slot(self.codes)] = True
        self.window = int((m + self.budget).max()) if len(m) else 0
        self.least = int(self.bound.min()) if len(m) else 0

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * _MIX) >> np.uint64(64 - _BITS)

    def search(self, documents: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        lengths = np.array([len(t) + 1 for t in documents], np.int64)
        starts = np.cumsum(lengths) - lengths
        codes = _grams(_symbols("\0".join(documents)), self.q)
        at = np.flatnonzero(self.seen[self._slot(codes)])
        found = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        real = self.codes[found] == codes[at]
        at, found = at[real], found[real]
        # a region needs ``least`` shared q-grams within the length of the longest occurrence
        here = np.arange(len(at))
        last = np.searchsorted(at, at + self.window)
        dense = last - here >= self.least
        cover = np.zeros(len(at) + 1, np.int64)
        np.add.at(cover, here[dense], 1)
        np.add.at(cover, last[dense], -1)
        near = np.cumsum(cover[:-1]) > 0
        at, found = at[near], found[near]
        if not len(at):
            return
        times = self.count[found]
        ends = np.cumsum(times)
        entry = np.arange(int(ends[-1])) + np.repeat(self.first[found] - ends + times, times)
        at, item, offset = np.repeat(at, times), self.item[entry], self.offset[entry]
        doc = np.searchsorted(starts, at, "right") - 1
        step = self.budget[item] + 1
        band = (at - starts[doc] - offset) // step
        table = np.stack([np.tile(doc, 2), np.tile(item, 2), np.append(band, band - 1), np.tile(offset, 2)])
        table = _distinct(table)  # a q-gram of the passage counts once in a band
        keys, shared = _distinct(table[:3], counts=True)
        keys = keys[:, shared >= self.bound[keys[1]]]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for number, which, low in keys.T.tolist():
            k = int(self.budget[which])
            hit = self._verify(documents[number], self.texts[which], low * (k + 1) - k, 4 * k + 2)
            if hit[0] <= k:
                best[number, which] = min(best.get((number, which), hit), hit)
        for (number, which), hit in best.items():
            yield number, self.ids[which], *hit

    @staticmethod
    def _verify(document: str, passage: str, first: int, width: int) -> tuple[int, int, int]:
        """Edits, start and end of the best occurrence on the diagonals from ``first`` on."""
        low = max(0, first)
        part = document[low : max(0, first + width + len(passage))]
        exact = part.find(passage)
        if exact >= 0:
            return 0, low + exact, low + exact + len(passage)
        a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (passage, part))
        least, end = align(a, b, first - low, width)
        end = min(max(end, 0), len(b))
        # the same backwards from there gives the start
        _, length = align(a[::-1], b[:end][::-1], -(width // 2) - 1, width + 2)
        return least, low + end - min(max(length, 0), end), low + end


def _distinct(columns: np.ndarray, counts: bool = False):
    """Distinct columns of a table of whole numbers, sorted."""
    order = np.lexsort(columns[::-1])
    table = columns[:, order]
    new = np.append(True, (table[:, 1:] != table[:, :-1]).any(axis=0))
    if not counts:
        return table[:, new]
    first = np.flatnonzero(new)
    return table[:, first], np.diff(np.append(first, table.shape[1]))


def _hits(batches: Iterable[pa.RecordBatch], passages: Passages) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", _BATCH_BYTES):
        ids = batch.column("doc_id").to_pylist()
        rows = [(ids[n], *rest) for n, *rest in passages.search(texts(batch.column("text")))]
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "distance", "start", "end"]
        )


def _clean(batches: Iterable[pa.RecordBatch], passages: Passages, text_col: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text_col, _BATCH_BYTES):
        hit = {n for n, *_ in passages.search(texts(batch.column(text_col)))}
        yield batch.filter(pa.array([n not in hit for n in range(batch.num_rows)], pa.bool_()))


def blocks(benchmark: DataFrame, rate: float, block_bytes: int) -> Iterator[Passages]:
    """Indexes of the benchmark, one for about every ``block_bytes`` of its text."""
    small_batches(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy("item_id", "text").collect()
        yield Passages([tuple(r) for r in rows], rate)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.1,
    block_bytes: int = 8 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pairs (doc_id, item_id) with the edits of the best occurrence and its place in the folded text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for passages in blocks(benchmark, rate, block_bytes):
        part = rows.mapInArrow(partial(_hits, passages=passages), HITS)
        found = part if found is None else found.union(part)
    return found


def clean(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, block_bytes: int = 8 << 20, text_col: str = "text"
) -> DataFrame:
    """``docs`` without the rows in which a passage occurs; same columns."""
    for passages in blocks(benchmark, rate, block_bytes):
        docs = docs.mapInArrow(partial(_clean, passages=passages, text_col=text_col), docs.schema)
    return docs
