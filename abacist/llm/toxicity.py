"""Toxicity by votes of the nearest labelled examples.

Texts are TF-IDF vectors over the words and word beginnings (the first four and five bytes, for forms
that share a stem) of all labelled examples; document frequencies are counted over all documents. A
term that sets toxic examples apart weighs more, the surer the more; no term is left out. Toxic
examples in which a term stands between the same two words count once there, as copied passages are
no evidence about their words. Similarity is the exact cosine of the whole vectors: an inverted
index over the examples sums the rarer terms, the common ones lie in a table, and blocks of examples
whose largest weights of common terms cannot bring them among the nearest are not looked at. What is
left is ranked in single precision and the nearest again in double precision. Examples vote with the
square of their cosine times the labelled texts that they stand for, as the labels are sampled at different rates,
with the share of toxic texts as a weak prior; texts without any term of the examples are voted on by the
examples without any.

The examples are a bounded sample of the distinct pairs of text and label, so that copies have one
vote: at most about ``per_class`` of either label, chosen by a hash of the text; an example has the
smallest id of its copies. Everything else covers all documents. Labels of held-out rows, null labels
and labels without a document teach nothing. A null or empty text has no term. Neighbours at equal
cosine are taken by smaller id. Repeated rows are each scored. An empty table gives an empty result;
without any label every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import fold, slices, small_batches, store, text_bytes

THRESHOLD = 0.3
_BLOCK = 128
_COMMON = 1536  # columns of the table of common terms, at most
_TOGETHER = 128
_FILLED = 128  # examples that are put into the index at a time
_FIRST = 4  # blocks of a query that are summed before the others are bounded
_SLACK = 2e-4  # twice what single precision can be off for unit vectors
_BATCH_BYTES = 4 << 20
_STARTS = ((4, b"^"), (5, b"*"))
# lower case for A-Z, a blank for control characters and ASCII punctuation
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


class _Columns:
    """Columns of the terms of texts: of words and of their beginnings."""

    def __init__(self, columns: dict[bytes, int]):
        self.columns = columns

    def _known(self, terms: pa.Array, sign: bytes = b"") -> np.ndarray:
        """Columns of terms after their sign, -1 for others."""
        if sign:
            terms = pc.binary_join_element_wise(pa.scalar(sign), terms, pa.scalar(b""))
        found = map(self.columns.get, terms.to_numpy(zero_copy_only=False), repeat(-1))
        return np.fromiter(found, np.int64, len(terms))

    def _of_words(self, words: pa.Array) -> np.ndarray:
        """For each word the columns of itself and of its beginnings (-1: none)."""
        found = np.full((len(words), 1 + len(_STARTS)), -1)
        found[:, 0] = self._known(words)
        size = pc.binary_length(words).to_numpy()
        for at, (length, sign) in enumerate(_STARTS, 1):
            longer = size > length
            starts = pc.binary_slice(words.filter(pa.array(longer)), 0, length).dictionary_encode()
            found[longer, at] = self._known(starts.dictionary, sign)[starts.indices.to_numpy()]
        return found

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct columns of the terms of each text, in order, and their counts, and where each text's begin."""
        words, owner = _cut(texts)
        words = words.dictionary_encode()
        width = max(len(self.columns), 1)
        numbers, keys = words.indices.to_numpy(), []
        for kind in self._of_words(words.dictionary).T:
            known = np.flatnonzero(kind[numbers] >= 0)
            keys.append(owner[known] * width + kind[numbers[known]])
        keys = np.concatenate(keys)
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        counts = np.diff(np.append(first, len(keys)))
        text, which = np.divmod(keys[first], width)
        return which, counts, np.searchsorted(text, np.arange(len(texts) + 1))


def _cut(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, in a row, and the text that each is in."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]).translate(_WORDS), np.uint8)
    inside = data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, offsets = edges[::2], np.zeros(len(edges) // 2 + 1, np.int32)
    np.cumsum(edges[1::2] - starts, out=offsets[1:])
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, ends), prepend=0))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers), owner


def settings(text: bytes) -> dict[bytes, int]:
    """Of every term of a text, a hash of the words before and after its first place."""
    words = text.translate(_WORDS).split()
    found: dict[bytes, int] = {}
    for before, word, after in zip([b"", *words], words, [*words[1:], b""]):
        mark = crc32(before + b" " + after)
        found.setdefault(word, mark)
        for length, sign in _STARTS:
            if len(word) > length:
                found.setdefault(sign + word[:length], mark)
    return found


def _example_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # every term is an object of its own here: a few hundred texts at a time
    for batch in slices(batches, "text", _BATCH_BYTES // 4):
        found = [settings(text) for text in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                pa.array([list(x) for x in found], pa.list_(pa.binary())),
                pa.array([list(x.values()) for x in found], pa.list_(pa.int64())),
            ],
            names=["label", "terms", "settings"],
        )


def _kept(shared: Broadcast, kind: type):
    """What ``kind`` makes of a shared value, made once in a process, which then drops the value's parts."""
    if "made" not in shared.value:
        shared.value["made"] = kind(**shared.value.pop("of"))
    return shared.value["made"]


def _vocabulary(names: list[bytes]) -> _Columns:
    return _Columns({t: i for i, t in enumerate(names)})


def _vectors(batches: Iterable[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    columns = _kept(shared, _vocabulary)
    for batch in slices(batches, "text", _BATCH_BYTES):
        *found, cuts = columns.of(text_bytes(batch.column("text")))
        packed = [pa.array([x.astype(np.int32).tobytes() for x in np.split(part, cuts[1:-1])], pa.binary()) for part in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), *packed], names=["doc_id", "label", "columns", "counts"]
        )


def _frequencies(batches: Iterable[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    columns = _kept(shared, _vocabulary)
    total = np.zeros(len(columns.columns) + 1, np.int64)
    for batch in slices(batches, "text", _BATCH_BYTES // 4):
        total[-1] += batch.num_rows  # the last one is the number of documents
        which, _, _ = columns.of(text_bytes(batch.column("text")))
        total += np.bincount(which, minlength=len(total))
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["column", "df"])


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the runs that begin at ``starts``, in a row."""
    ends = np.cumsum(lengths)
    places = np.repeat(starts - ends + lengths, lengths)
    places += np.arange(len(places))
    return places


def _blocks(rows: np.ndarray) -> np.ndarray:
    """An order of the rows in which every ``_BLOCK`` of them are alike: halved again and again along the
    direction in which they differ most."""
    order, todo = [], [np.arange(len(rows))]
    while todo:
        part = todo.pop()
        if len(part) <= _BLOCK:
            order.append(part)
            continue
        here = rows[part]
        middle = here.mean(axis=0)
        along = here[np.argmax(((here - middle) ** 2).sum(axis=1))] - middle
        for _ in range(8):
            along = (here @ along - middle @ along) @ here - (here @ along - middle @ along).sum() * middle
            along /= np.sqrt(along @ along) or 1
        ranked = part[np.argsort(here @ along, kind="stable")]
        half = -(-len(part) // _BLOCK) // 2 * _BLOCK  # whole blocks but for the last
        todo += [ranked[half:], ranked[:half]]
    return np.concatenate([np.empty(0, np.int64), *order])


def _alike(weight: np.ndarray, lengths: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """An order of the examples that puts like ones into one block, by their most common terms."""
    n = len(lengths)
    if not len(columns):
        return np.arange(n)
    spread = np.bincount(columns, minlength=len(weight))
    common = np.argsort(-spread, kind="stable")[: _COMMON // 4]
    place = np.full(len(weight), -1, np.int32)
    place[common] = np.arange(len(common))
    at = place[columns]
    known = np.flatnonzero(at >= 0)
    rows = np.zeros((n, len(common)), np.float32)
    rows[np.repeat(np.arange(n, dtype=np.int32), lengths)[known], at[known]] = (1 + np.log(counts[known])) * weight[columns[known]]
    rows /= np.maximum(np.sqrt((rows**2).sum(axis=1, keepdims=True)), 1e-9)
    return _blocks(rows)


class _Index:
    """Block-max inverted index over the examples' vectors."""

    def __init__(
        self,
        names: list[bytes],
        weight: np.ndarray,
        ids: np.ndarray,
        labels: np.ndarray,
        lengths: np.ndarray,
        columns: np.ndarray,
        counts: np.ndarray,
        k: int,
        prior_weight: float,
        stands_for: np.ndarray | None = None,
    ):
        """``weight`` is that of each term; ``lengths`` cuts ``columns`` and ``counts`` into examples.

        ``stands_for`` says how many labelled texts an example stands for, as labels are sampled at different rates.
        """
        self.k, self.prior_weight = k, prior_weight
        votes = np.ones(len(ids)) if stands_for is None else stands_for
        self.words = _vocabulary(names)
        self.columns, self.weight = self.words.columns, weight
        self.prior = float(votes @ labels / votes.sum()) if len(labels) else 0.0
        votes = votes / votes.max() if len(votes) else votes
        empty = lengths == 0
        self.empty_ids = np.sort(ids[empty])[:k].tolist()
        found = votes[empty] @ labels[empty] + prior_weight * self.prior
        self.empty_score = float(found / (votes[empty].sum() + prior_weight)) if empty.any() else self.prior
        self.votes = votes[~empty]
        self.ids, self.labels = ids[~empty], labels[~empty].astype(np.float64)
        self.lengths, self.which = lengths[~empty], columns
        n = len(self.ids)
        self.blocks = -(-n // _BLOCK)
        self.starts = np.cumsum(self.lengths) - self.lengths
        # the terms of most examples as a table, the others as lists of examples
        spread = np.bincount(columns, minlength=len(names))
        common = np.argsort(-spread, kind="stable")[:_COMMON]
        common = common[spread[common] * 64 > n]
        self.place = np.full(len(names), -1, np.int32)
        self.place[common] = np.arange(len(common))
        self._lay_out(len(common))
        self.list_lengths = np.where(self.place < 0, spread, 0)
        self.list_starts = np.cumsum(self.list_lengths) - self.list_lengths
        # an example and its weight lie in eight bytes, which are read at once
        self.packed = np.zeros(self.list_lengths.sum(), np.int64)
        parts = self.packed.view([("impact", "<f4"), ("listed", "<i4")])
        self.listed, self.listed_impact = parts["listed"], parts["impact"]
        self.impact = np.empty(len(columns))
        free = self.list_starts.copy()
        # some examples at a time: a worker holds hardly more than the index itself
        for first in range(0, n, _FILLED):
            self._fill(first, min(first + _FILLED, n), counts, free)
        for block, here in enumerate(self.here):
            self.most[block, here] = self._block(block).max(axis=0)

    def _lay_out(self, common: int) -> None:
        """Room for the table of common terms: each block has the columns that its examples have."""
        self.here, self.at = [], np.full((self.blocks, common), -1, np.int32)
        self.most = np.zeros((self.blocks, common), np.float32)
        for block in range(self.blocks):
            first, last = block * _BLOCK, min((block + 1) * _BLOCK, len(self.ids)) - 1
            columns = self.place[self.which[self.starts[first] : self.starts[last] + self.lengths[last]]]
            self.here.append(np.unique(columns[columns >= 0]))
            self.at[block, self.here[-1]] = np.arange(len(self.here[-1]))
        self.widths = np.array([len(x) for x in self.here], np.int64)
        self.begins = (np.cumsum(self.widths) - self.widths) * _BLOCK
        self.table = np.zeros(self.widths.sum() * _BLOCK, np.float32)

    def _block(self, block: int) -> np.ndarray:
        """The table of a block: its examples by its columns."""
        begin, width = self.begins[block], self.widths[block]
        return self.table[begin : begin + _BLOCK * width].reshape(_BLOCK, width)

    def _fill(self, first: int, last: int, counts: np.ndarray, free: np.ndarray) -> None:
        """Put examples into the table and at the ends of the lists, which ``free`` moves on."""
        lengths, begin = self.lengths[first:last], self.starts[first]
        here = slice(begin, begin + lengths.sum())
        which = self.which[here]
        impact = np.log(counts[here])
        impact += 1
        impact *= self.weight[which]
        impact /= np.repeat(np.sqrt(np.add.reduceat(impact**2, self.starts[first:last] - begin)), lengths)
        self.impact[here] = impact
        owner, at = np.repeat(np.arange(first, last, dtype=np.int32), lengths), self.place[which]
        known = np.flatnonzero(at >= 0)
        block, row = np.divmod(owner[known], _BLOCK)
        self.table[self.begins[block] + row * self.widths[block] + self.at[block, at[known]]] = impact[known]
        rare = np.flatnonzero(at < 0)
        rare = rare[np.argsort(which[rare], kind="stable")]
        terms, sizes = np.unique(which[rare], return_counts=True)
        places = _spread(free[terms], sizes)
        self.listed[places], self.listed_impact[places] = owner[rare], impact[rare]
        free[terms] += sizes

    def unit(self, which: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Weights of unit length."""
        weights = (1 + np.log(counts)) * self.weight[which]
        return weights / np.sqrt((weights**2).sum())

    def _common(self, near: np.ndarray, dense: np.ndarray, wanted: np.ndarray) -> None:
        """Add the common terms to the sums of the wanted blocks of each query."""
        for block in np.flatnonzero(wanted.any(axis=0)).tolist():
            rows = np.flatnonzero(wanted[:, block])
            here = slice(block * _BLOCK, (block + 1) * _BLOCK)
            near[rows, here] += dense[rows[:, None], self.here[block]] @ self._block(block).T

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Positions and cosines of the k nearest examples with a term in common, for each query."""
        n = len(self.ids)
        if not n:
            return [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        near = np.zeros((len(queries), self.blocks * _BLOCK), np.float32)
        dense = np.zeros((len(queries), self.most.shape[1]), np.float32)
        for row, (which, weights) in enumerate(queries):
            at = self.place[which]
            dense[row, at[at >= 0]] = weights[at >= 0]
            which, weights = which[at < 0], weights[at < 0].astype(np.float32)
            size = self.list_lengths[which]
            found = self.packed.take(_spread(self.list_starts[which], size))
            value = np.repeat(weights, size)
            value *= found.view("<f4")[::2]
            found >>= 32
            near[row] = np.bincount(found, value, minlength=near.shape[1])
        k = min(self.k, n)
        bound = near.reshape(len(queries), self.blocks, _BLOCK).max(axis=2) + dense @ self.most.T
        # the blocks that promise most first: what they hold bounds the others
        first = np.zeros(bound.shape, bool)
        many = min(max(_FIRST, -(-k // _BLOCK)), self.blocks)
        promising = np.argpartition(-bound, many - 1, axis=1)[:, :many]
        np.put_along_axis(first, promising, True, axis=1)
        self._common(near, dense, first)
        summed = np.take_along_axis(near.reshape(*bound.shape, _BLOCK), promising[:, :, None], axis=1)
        summed = summed.reshape(len(queries), many * _BLOCK)
        least = np.partition(summed, summed.shape[1] - k, axis=1)[:, summed.shape[1] - k]
        self._common(near, dense, (bound >= least[:, None] - _SLACK) & (bound > 0) & ~first)
        whole, found = np.zeros(len(self.weight)), []
        for row, (which, weights) in enumerate(queries):
            places = np.flatnonzero((near[row] >= least[row] - _SLACK) & (near[row] > 0))
            if len(places) > k:  # now that all that matter are summed
                sums = near[row, places]
                places = places[sums >= np.partition(sums, len(sums) - k)[len(sums) - k] - _SLACK]
            if not len(places):
                found.append((places, np.empty(0)))
                continue
            whole[which] = weights
            cosine = np.empty(len(places))
            for i, place in enumerate(places.tolist()):
                part = slice(self.starts[place], self.starts[place] + self.lengths[place])
                cosine[i] = whole[self.which[part]] @ self.impact[part]
            whole[which] = 0
            order = np.lexsort((self.ids[places], -cosine.round(12)))[: self.k]
            found.append((places[order], cosine[order]))
        return found

    def nearest(self, which: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.search([(which, weights)])[0]

    def scores(self, texts: list[bytes]) -> list[tuple[float, list[int]]]:
        """Probability of the label 1 and the ids of the examples that voted, for each text."""
        out: list[tuple[float, list[int]]] = [(self.empty_score, self.empty_ids)] * len(texts)
        columns, counts, cuts = self.words.of(texts)
        for start in range(0, len(texts), _TOGETHER):
            here = [slice(a, b) for a, b in zip(cuts[start : start + _TOGETHER], cuts[start + 1 : start + _TOGETHER + 1])]
            filled = [at for at, x in enumerate(here) if x.start < x.stop]
            queries = [(columns[here[at]], self.unit(columns[here[at]], counts[here[at]])) for at in filled]
            for at, (places, cosine) in zip(filled, self.search(queries)):
                # the largest is 1, so that neighbours of one label outvote the prior however rare it is
                votes = cosine**2 * (self.votes[places] / self.votes[places].max(initial=1e-300))
                score = votes @ self.labels[places] + self.prior_weight * self.prior
                score = float(score / (votes.sum() + self.prior_weight))
                out[start + at] = score, self.ids[places].tolist()
        return out


class Neighbours(_Index):
    """The index of examples given as (id, label, counts of terms)."""

    def __init__(
        self,
        examples: list[tuple[int, int, list[tuple[bytes, int]]]],
        frequency: dict[bytes, int],
        documents: int,
        k: int,
        prior_weight: float,
    ):
        names = sorted(frequency)
        column = {t: i for i, t in enumerate(names)}
        rows = sorted((i, y, sorted((column[t], c) for t, c in found)) for i, y, found in examples)
        weight = _idf(np.array([frequency[t] for t in names]), documents)
        pairs = np.array([p for _, _, found in rows for p in found], np.int64).reshape(-1, 2)
        sizes = np.array([len(found) for _, _, found in rows], np.int64)
        rows = [rows[at] for at in _alike(weight, sizes, pairs[:, 0], pairs[:, 1])]
        pairs = np.array([p for _, _, found in rows for p in found], np.int64).reshape(-1, 2)
        super().__init__(
            names,
            weight,
            np.array([i for i, _, _ in rows], np.int64),
            np.array([y for _, y, _ in rows], np.int64),
            np.array([len(found) for _, _, found in rows], np.int64),
            pairs[:, 0],
            pairs[:, 1],
            k,
            prior_weight,
        )

    def vector(self, found: Iterable[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Columns and weights of unit length."""
        pairs = np.array(sorted((self.columns[t], c) for t, c in found), np.int64).reshape(-1, 2)
        return pairs[:, 0], self.unit(pairs[:, 0], pairs[:, 1])


def _idf(frequency: np.ndarray, documents: int) -> np.ndarray:
    return np.log((1 + documents) / (1 + frequency)) + 1


def _strength(a: np.ndarray, b: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """Factor of a term in ``a`` of the toxic and ``b`` of the other examples.

    It grows with the log of the ratio of its shares, less two standard errors.
    """
    if not pos or not neg:
        return np.ones(len(a))
    ratio = np.log((a + 0.5) / (pos + 1)) - np.log((b + 0.5) / (neg + 1))
    certain = ratio - 2 * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    return 1 + 100 * np.maximum(certain, 0) ** 2


def _scores(batches: Iterable[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    index = _kept(shared, _Index)
    for batch in slices(batches, "text", _BATCH_BYTES // 4):
        found = index.scores(text_bytes(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array([s for s, _ in found], pa.float64()),
                pa.array([e for _, e in found], pa.list_(pa.int64())),
            ],
            names=["doc_id", "held_out", "score", "evidence"],
        )


def _accepted(batches: Iterable[pa.RecordBatch], shared: Broadcast, text_col: str) -> Iterator[pa.RecordBatch]:
    index = _kept(shared, _Index)
    for batch in slices(batches, text_col, _BATCH_BYTES // 4):
        kept = [score < THRESHOLD for score, _ in index.scores(text_bytes(batch.column(text_col)))]
        yield batch.filter(pa.array(kept, pa.bool_()))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 4096,
    k: int = 15,
    prior_weight: float = 0.25,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Broadcast:
    """What the index of the labelled examples is made of; ``per_class`` bounds how many there are."""
    spark = docs.sparkSession
    small_batches(spark)
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marks = marks.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~fold("doc_id", 4, 2)).distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("key"))
    # copies are one example
    labelled = rows.select("doc_id", "key").join(marks, "doc_id").groupBy("key", "label").agg(F.min("doc_id").alias("doc_id"))
    labelled = store(labelled, "labelled")
    share, totals = F.lit(0), {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    for label, n in totals.items():
        share = F.when(F.col("label") == label, min(n, per_class) * (1 << 20) // n).otherwise(share)
    sample = labelled.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < share)
    # the sample has a bounded number of ids
    examples = rows.join(F.broadcast(sample), ["doc_id", "key"]).dropDuplicates(["key", "label"])
    examples = store(examples.select("doc_id", "label", "text"), "examples")
    sizes = dict(examples.groupBy("label").count().collect())
    pos, neg = sizes.get(1, 0), sum(sizes.values()) - sizes.get(1, 0)
    seen = examples.select("label", "text").mapInArrow(
        _example_terms, "label int, terms array<binary>, settings array<long>"
    )
    seen = seen.select("label", F.explode(F.arrays_zip("terms", "settings")).alias("x"))
    seen = seen.groupBy(F.col("x.terms").alias("term"), F.col("x.settings").alias("setting")).agg(
        F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") != 1).alias("b")
    )
    seen = seen.groupBy("term").agg(F.count_if(F.col("a") > 0).alias("a"), F.sum("b").alias("b")).toArrow()
    seen = seen.sort_by("term")
    names = seen.column("term").to_pylist()
    a, b = (seen.column(x).to_numpy().astype(np.float64) for x in ("a", "b"))
    vocabulary = spark.sparkContext.broadcast({"of": {"names": names}})
    vectors = examples.mapInArrow(
        partial(_vectors, shared=vocabulary), "doc_id long, label int, columns binary, counts binary"
    ).toArrow()
    vectors = vectors.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    columns, counts = (
        np.frombuffer(b"".join(vectors.column(x).to_pylist()), np.int32) for x in ("columns", "counts")
    )
    counted = rows.select("text").mapInArrow(partial(_frequencies, shared=vocabulary), "column int, df long")
    counted = counted.groupBy("column").agg(F.sum("df").alias("df")).toArrow()
    frequency = np.zeros(len(names) + 1, np.int64)
    frequency[counted.column("column").to_numpy()] = counted.column("df").to_numpy()
    weight = _idf(frequency[:-1], frequency[-1]) * _strength(a, b, pos, neg)
    lengths = np.array([len(x) // 4 for x in vectors.column("columns").to_pylist()], np.int64)
    order = _alike(weight, lengths, columns, counts)
    moved = _spread((np.cumsum(lengths) - lengths)[order], lengths[order])
    listed = vectors.column("label").to_numpy()[order]
    parts = {
        "names": names,
        "weight": weight,
        "ids": vectors.column("doc_id").to_numpy()[order],
        "labels": listed,
        "stands_for": np.array([totals[y] / sizes[y] for y in listed.tolist()]),
        "lengths": lengths[order],
        "columns": columns[moved],
        "counts": counts[moved],
        "k": k,
        "prior_weight": prior_weight,
    }
    return spark.sparkContext.broadcast({"of": parts})


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence (ids of the voters)."""
    shared = learn(docs, labels, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), fold(id_col, 4, 2).alias("held_out"), F.col(text_col).alias("text")
    )
    found = rows.mapInArrow(
        partial(_scores, shared=shared), "doc_id long, held_out boolean, score double, evidence array<long>"
    )
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return found.select("doc_id", "held_out", "score", predicted, "evidence")


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` without the rows predicted to be toxic; same columns."""
    shared = learn(docs, labels, id_col=id_col, text_col=text_col, **options)
    return docs.mapInArrow(partial(_accepted, shared=shared, text_col=text_col), docs.schema)
