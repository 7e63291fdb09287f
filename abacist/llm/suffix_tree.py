"""Language-model scores from a probabilistic suffix tree over bytes.

A text is its words (lower-case A-Z, cut at blanks), one space between them and one end mark. The
tree's nodes are contexts of up to ``depth`` preceding bytes. A context is retained if its
next-symbol distribution diverges from that of the longest retained context inside it: count times
Kullback-Leibler divergence, the gain in log-likelihood, has to reach ``least_gain``. Next-symbol
probabilities are smoothed by absolute discounting: what is taken off the counts of a context goes
to the distribution of the shorter one, down to add-one over all bytes; shorter contexts count in
how many longer ones a symbol followed (Kneser-Ney). A text's score sums the log10 probabilities
given the longest retained suffix of what precedes, end mark included.

Neither the tree nor the vocabulary is held anywhere as a whole. Documents lie in blocks of about
``block_bytes``; each block counts its own words and byte strings, these requests are answered after
a shuffle, and a block is scored with the answers to its own. Byte strings travel in packed parts,
dealt by a hash: a part holds a few of every block's, is summed, and is answered as a whole. The tree
is built from the sums, by the two nearest bytes of a context. What is collected is 65,536 counts of
byte pairs at most.

Held-out rows are scored but teach nothing. A null text is empty, and an empty text is the end mark
alone. Rows with a null id are never held out. Repeated rows count each time. An empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abacist.llm.common import LOWER, fold, small_batches, store, text_bytes

END = b"\n"
_STRETCH = 1 << 19
_RANGE = 1 << 18  # numbers that are sorted at a time when arrays are merged
_HELD = 1 << 21  # numbers that are held before arrays are merged
_MIX = np.uint64(0x9E3779B97F4A7C15)
REQUESTS = "block int, word binary, n long, part int, codes binary, counts binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, known_sum double, score double"


def _pack(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.tobytes(), 1)


def _pack_sorted(numbers: np.ndarray) -> bytes:
    return _pack(np.diff(numbers, prepend=0))


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.int64))


def _part(codes: np.ndarray, parts: int) -> np.ndarray:
    return ((codes.astype(np.uint64) * _MIX >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def _codes(streams: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the streams, in a row, the number of it and the ``depth`` bytes before; and the streams' starts."""
    pad = END * depth
    buffer = b"\0" * 7 + b"".join(pad + s for s in streams)
    lengths = np.fromiter(map(len, streams), np.int64, len(streams))
    starts = np.cumsum(lengths) - lengths
    # the window of eight bytes that ends at each byte
    values = np.ndarray((len(buffer) - 7,), ">u8", buffer=buffer, strides=(1,)).astype(np.int64)
    values &= (1 << 8 * (depth + 1)) - 1
    real = np.ones(len(values), bool)
    real[((starts + depth * np.arange(len(streams)))[:, None] + np.arange(depth)).ravel()] = False
    return values[real], starts


def _counted(numbers: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order and how often they occur, or the sums of their weights."""
    if not len(numbers):
        return numbers, np.empty(0, np.int64)
    if weights is None:
        numbers = np.sort(numbers)
    else:
        order = np.argsort(numbers, kind="stable")
        numbers, weights = numbers[order], weights[order]
    first = np.append(0, np.flatnonzero(numbers[1:] != numbers[:-1]) + 1)
    n = np.diff(np.append(first, len(numbers))) if weights is None else np.add.reduceat(weights, first)
    return numbers[first], n


class _Lookup:
    """Values by number in an open hash table of arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]
            placed = self.keys[slot] == keys[left]
            self.values[slot[placed]] = values[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key; all of them are in the table."""
        slot = self._slot(keys)
        found = self.values[slot]
        left = np.flatnonzero(self.keys[slot] != keys)
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            found[left] = self.values[slot[left]]
            left = left[self.keys[slot[left]] != keys[left]]
        return found


def _merged(found: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of several sorted arrays, in order, and the sums of their counts.

    The arrays are gone through range by range, so that what is sorted is a part of them.
    """
    most = max(found, key=len)
    step = max(-(-sum(map(len, found)) // _RANGE), 1)
    cuts = np.unique(most[np.arange(1, step) * len(most) // step]) if len(most) else most
    bounds = [np.concatenate([[0], np.searchsorted(x, cuts), [len(x)]]) for x in found]
    codes, sums = [], []
    for i in range(len(cuts) + 1):
        part, n = _counted(
            np.concatenate([x[b[i] : b[i + 1]] for x, b in zip(found, bounds)]),
            np.concatenate([x[b[i] : b[i + 1]] for x, b in zip(counts, bounds)]).astype(np.int64),
        )
        codes.append(part)
        sums.append(n)
    return np.concatenate(codes), np.concatenate(sums)


def _stretches(texts: pa.ChunkedArray) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of texts of about half a megabyte: where a run begins and ends, and the streams of its texts."""
    start = size = 0
    for at, length in enumerate(pc.binary_length(texts).to_pylist(), 1):
        size += length or 0
        if size >= _STRETCH or at == len(texts):
            streams = [b" ".join(words_of(text)) + END for text in text_bytes(texts.slice(start, at - start))]
            yield start, at, streams
            start, size = at, 0


def _tokens(streams: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words and ends of the streams, in a row, and how many each stream has."""
    data = np.frombuffer(b"".join(streams), np.uint8)
    cuts = np.flatnonzero((data == 32) | (data == END[0]))
    lengths = np.zeros((len(cuts), 2), np.int32)  # of the word before a cut, and of the end at it
    lengths[:, 0] = np.diff(cuts, prepend=-1) - 1
    lengths[:, 1] = data[cuts] == END[0]
    some, ends = lengths.ravel() > 0, np.flatnonzero(lengths[:, 1])
    n = np.diff(np.cumsum(some)[2 * ends + 1], prepend=0)
    offsets = np.append(np.int32(0), np.cumsum(lengths.ravel()[some], dtype=np.int32))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[data != 32])]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers).dictionary_encode(), n


def _requests(table: pa.Table, depth: int, parts: int) -> pa.Table:
    """Words and parts of byte strings of a block with their counts in its training rows (0: held out only)."""
    block = table.column("block")[0].as_py()
    learned = ~np.array(table.column("held_out").to_pylist())
    words, found, counts = [], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    for a, b, streams in _stretches(table.column("text")):
        tokens, n = _tokens(streams)
        n = np.bincount(tokens.indices, np.repeat(learned[a:b], n), len(tokens.dictionary))
        words.append(pa.table({"word": tokens.dictionary, "n": n.astype(np.int64)}))
        codes, starts = _codes(streams, depth)
        learn = np.repeat(learned[a:b], np.diff(np.append(starts, len(codes))))
        for chosen, weight in ((codes[learn], 1), (codes[~learn], 0)):
            distinct, n = _counted(chosen)
            found.append(distinct)
            counts.append((n * weight).astype(np.int32))  # a text has less than 2 GB
        if len(found) > 1 and sum(map(len, found[1:])) > _HELD:
            found, counts = ([x] for x in _merged(found, counts))
    words = pa.concat_tables(words).group_by("word", use_threads=False).aggregate([("n", "sum")])
    known, uses = (words.column(x).combine_chunks() for x in ("word", "n_sum"))
    codes, n = _merged(found, counts)
    del found, counts, words
    part = _part(codes, parts)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    dealt = [i for i in np.split(order, cuts) if len(i)]
    words, more = len(known), len(dealt)
    return pa.table(
        {
            "block": pa.array(np.full(words + more, block, np.int32)),
            "word": pa.concat_arrays([known, pa.nulls(more, pa.binary())]),
            "n": pa.concat_arrays([uses, pa.nulls(more, pa.int64())]),
            "part": pa.concat_arrays([pa.nulls(words, pa.int32()), pa.array([part[i[0]] for i in dealt], pa.int32())]),
            "codes": pa.concat_arrays(
                [pa.nulls(words, pa.binary()), pa.array([_pack_sorted(codes[i]) for i in dealt], pa.binary())]
            ),
            "counts": pa.concat_arrays([pa.nulls(words, pa.binary()), pa.array([_pack(n[i]) for i in dealt], pa.binary())]),
        }
    )


def _summed(table: pa.Table) -> pa.Table:
    """Counts over all blocks of the byte strings of a part."""
    codes = np.concatenate([_unpack_sorted(x) for x in table.column("codes").to_pylist()])
    counts = np.concatenate([_unpack(x, np.int64) for x in table.column("counts").to_pylist()])
    codes, n = _counted(codes, counts)
    return pa.table({"code": codes, "n": n})


def _answered(asked: pa.Table, tree: pa.Table) -> pa.Table:
    """For each block the values of its byte strings of a part."""
    keys, values = tree.column("code").to_numpy(), tree.column("value").to_numpy()
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    codes = asked.column("codes").to_pylist()
    found = [_pack(values[np.searchsorted(keys, _unpack_sorted(x))]) for x in codes]
    return pa.table(
        {"block": asked.column("block"), "codes": pa.array(codes, pa.binary()), "values": pa.array(found, pa.binary())}
    )


def _mixed(
    count: np.ndarray, context: np.ndarray, shorter: np.ndarray, discount: float, least_gain: float
) -> np.ndarray:
    """Probabilities one level deeper: rows are (context, symbol), ``context`` numbers the contexts."""
    total = np.bincount(context, count)
    kinds = np.bincount(context, count > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(count > 0, count * np.log(count / total[context] / shorter), 0.0)
    retained = (np.bincount(context, gain) >= least_gain) & (total > 0)
    rest = discount * kinds[context] * shorter
    mixed = (np.maximum(count - discount, 0) + rest) / np.maximum(total, 1)[context]
    return np.where(retained[context], mixed, shorter)


def _near(pairs: dict[int, int], discount: float, least_gain: float) -> np.ndarray:
    """Probability of every symbol after every single byte, as a table over (byte, symbol)."""
    count = np.zeros(1 << 16)
    count[list(pairs)] = list(pairs.values())
    single = count.reshape(256, 256).sum(axis=0)
    base = np.tile((single + 1) / (single.sum() + 256), 256)
    return _mixed(count, np.arange(1 << 16) >> 8, base, discount, least_gain)


def _tree(table: pa.Table, near: np.ndarray, depth: int, discount: float, least_gain: float) -> pa.Table:
    """log10 probability of the last byte of each byte string after the others; all share two context bytes."""
    codes = table.column("code").to_numpy()
    probability = near[codes & 0xFFFF]
    # a shorter context counts the longer ones in which a symbol followed it, not their occurrences
    keys, counts = {depth: codes}, {depth: table.column("n").to_numpy()}
    for level in range(depth - 1, 1, -1):
        keys[level], where = np.unique(keys[level + 1] & ((1 << 8 * (level + 1)) - 1), return_inverse=True)
        counts[level] = np.bincount(where, counts[level + 1] > 0)
    for level in range(2, depth + 1):
        at = np.searchsorted(keys[level], codes & ((1 << 8 * (level + 1)) - 1)) if level < depth else slice(None)
        shorter = np.empty(len(keys[level]))
        shorter[at] = probability
        _, context = np.unique(keys[level] >> 8, return_inverse=True)
        probability = _mixed(counts[level], context, shorter, discount, least_gain)[at]
    return pa.table({"code": codes, "value": np.log10(probability)})


def _score(docs: pa.Table, answers: pa.Table, depth: int) -> pa.Table:
    """Score the rows of a block with the answers to its requests."""
    is_word = answers.column("word").is_valid()
    words, packed = answers.filter(is_word), answers.filter(pc.invert(is_word))
    known, count = words.column("word").combine_chunks(), words.column("c").to_numpy()
    chance = _Lookup(
        np.concatenate([_unpack_sorted(x) for x in packed.column("codes").to_pylist()]),
        np.concatenate([_unpack(x, np.float64) for x in packed.column("values").to_pylist()]),
    )
    del answers, words, packed
    runs, scores = [], [np.empty(0)]
    for _, _, streams in _stretches(docs.column("text")):
        runs.append(_tokens(streams))
        codes, starts = _codes(streams, depth)
        scores.append(np.add.reduceat(chance.get(codes), starts))
    del chance
    # all words are known
    asked = pa.chunked_array([tokens.dictionary for tokens, _ in runs], pa.binary())
    uses = np.split(count[pc.index_in(asked, value_set=known).to_numpy()], np.cumsum([len(x) for x in asked.chunks])[:-1])
    n_tokens, n_known, known_sum = [np.empty(0, np.int64)], [], []
    for (tokens, n), of_word in zip(runs, uses):
        n_tokens.append(n)
        for c in np.split(of_word[tokens.indices.to_numpy()], np.cumsum(n)[:-1]):
            n_known.append(int(np.count_nonzero(c)))
            known_sum.append(float(np.log10(c + 1).sum()))
    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "n_tokens": pa.array(np.concatenate(n_tokens), pa.int64()),
            "n_known": pa.array(n_known, pa.int64()),
            "known_sum": pa.array(known_sum, pa.float64()),
            "score": pa.array(np.concatenate(scores), pa.float64()),
        }
    )


def suffix_tree_scores(
    docs: DataFrame,
    depth: int = 5,
    discount: float = 0.9,
    least_gain: float = 1.0,
    block_bytes: int = 16 << 20,
    folds: int = 7,
    held_out: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` is that of single words with add-one smoothing, for comparison.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")  # a byte string and its symbol fit in a long
    small_batches(docs.sparkSession)

    def requests(table: pa.Table) -> pa.Table:
        return _requests(table, depth, blocks)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score(left, right, depth)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), fold(id_col, folds, held_out).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    block = F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64), F.octet_length("text")), F.lit(blocks))
    rows = rows.withColumn("block", block.cast("int")).repartition(blocks, "block")

    asked = store(rows.groupBy("block").applyInArrow(requests, REQUESTS), "requests")
    words, strings = asked.where("word IS NOT NULL"), asked.where("part IS NOT NULL")
    # a word has at most one row per block
    of_word = Window.partitionBy("word")
    known = words.select(
        "block",
        "word",
        "n",
        F.sum("n").over(of_word).alias("c"),
        (F.row_number().over(of_word.orderBy("block")) == 1).alias("first"),
    )
    known = store(known, "word-counts")
    size = known.agg(F.sum("n"), F.count_if(F.col("first") & (F.col("c") > 0))).first()
    n_train, distinct = size[0] or 0, size[1]

    def sums(table: pa.Table) -> pa.Table:
        return _summed(table)

    summed = strings.select("part", "codes", "counts").groupBy("part").applyInArrow(sums, "code long, n long")
    summed = store(summed, "byte-counts")
    pairs = summed.groupBy(F.col("code").bitwiseAND(0xFFFF).alias("pair")).agg(F.sum("n")).collect()
    near = _near({int(p): int(n) for p, n in pairs}, discount, least_gain)

    def probabilities(table: pa.Table) -> pa.Table:
        tree = _tree(table, near, depth, discount, least_gain)
        return tree.append_column("part", pa.array(_part(tree.column("code").to_numpy(), blocks)))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        return _answered(left, right)

    place = F.shiftright("code", 8).bitwiseAND(0xFFFF).alias("place")
    tree = summed.groupBy(place).applyInArrow(probabilities, "code long, value double, part int")
    asked_parts = strings.select("block", "part", "codes").groupBy("part")
    parts = asked_parts.cogroup(tree.groupBy("part")).applyInArrow(answer, "block int, codes binary, values binary")

    none = F.lit(None)
    answers = known.select(
        "block", "word", F.col("c").cast("double").alias("c"), none.cast("binary").alias("codes"), none.cast("binary").alias("values")
    ).union(parts.select("block", none.cast("binary").alias("word"), none.cast("double").alias("c"), "codes", "values"))
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORES)
    base = F.col("known_sum") - F.col("n_tokens") * F.log10(F.lit(float(n_train + distinct + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score",
    )
