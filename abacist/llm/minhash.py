"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its distinct word shingles. Two permutations of the numbers below 2**32
make all coordinates of a signature: the first gives a shingle its position, the second, shifted
circularly by k, is minimised over the set for coordinate k. Coordinates are cut into bands; sets
that share a band are candidates, and a candidate pair is linked only if its whole sets overlap by at least
``percent`` of their union.

Only distinct sets are indexed, so copies cost nothing. Two bounds, which never rule out a link, spare
comparisons: two sets have at most as much in common as either has of shingles that any other candidate has,
and at most the sum of what both have at least in each of ``_GROUPS`` groups of such shingles. In every bucket
all sets are first compared with one of them, the one with the largest part of shared shingles. Sets in one component of
the links found need no comparison any more. In buckets of up to ``crowded`` sets the pairs of different components
that the first bound admits are compared. In larger ones a task meets two blocks of sets as counts by group, finds
the pairs that the second bound admits, and only those are compared as whole sets: no rows are made of the others.
A pair at exactly 80 % misses all bands with a probability of 3e-6.

Words are runs without blanks, A-Z lower-cased; fewer words than a shingle has are one shingle.
Sets hold 64-bit hashes of shingles. Null, empty and blank texts have the empty set and are linked with
nothing. Null ids take part but are never a component's id unless all its ids are null. Repeated rows
are answered each. Texts are never cut, whatever their length. An empty table gives an empty result;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from abacist.llm.common import LOWER, slices, small_batches, store, text_bytes
from abacist.llm.components import components

ROWS, BANDS = 5, 32
_GROUPS = 128
_BITS = 26  # log2 of the bits that mark shared shingles
_BLOCK = 2048  # sets of a crowded bucket that meet in a task
_TOGETHER = 1 << 18  # bytes of text whose shingles are permuted at a time
_SHINGLES = 1 << 20  # hashes collected in a task before they are counted
_MEMO = 300_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """XXH64 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        self[word] = found = xxh64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes, width: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of a UTF-8 text, in order."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    last = len(codes) - size + 1
    found = np.full(last, size, np.uint64)
    for at in range(size):
        found = _mixed(found * _ODD + codes[at : at + last])
    return np.unique(found)


def _permuted(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    return np.bitwise_xor(x, spare, out=x)


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """The first ``size`` coordinates of sets that are not empty, a row each."""
    hashes = np.concatenate(sets)
    places = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    shifted, spare = np.empty_like(places), np.empty_like(places)
    places *= np.uint32(0x9E3779B1)
    places = _permuted(places, spare)  # the first permutation
    starts = np.cumsum([0, *map(len, sets[:-1])])
    found = np.empty((size, len(sets)), np.uint32)
    for k in range(size):
        np.add(places, np.uint32(k), out=shifted)  # the shift is circular: sums are modulo 2**32
        np.minimum.reduceat(_permuted(shifted, spare), starts, out=found[k])
    return found.T


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Keys of the bands, a row per set."""
    signature = signatures(sets, ROWS * BANDS).reshape(len(sets), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS))
    for at in range(ROWS):
        keys = _mixed(keys * _ODD + signature[:, :, at])
    return keys.view(np.int64)


def _keyed(sets: list[np.ndarray]) -> pa.Array:
    """Bands of each set; none for the empty one."""
    filled = [at for at, x in enumerate(sets) if len(x)]
    found = [[]] * len(sets)
    if filled:
        for at, keys in zip(filled, bands([sets[at] for at in filled]).tolist()):
            found[at] = keys
    return pa.array(found, pa.list_(pa.int64()))


def _signed(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in slices(batches, "text", _TOGETHER):
        sets = [shingle_set(t, width, hashes) for t in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("raw_hash"),
                pa.array([xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
                pa.array([len(x) for x in sets], pa.int64()),
                _keyed(sets),
            ],
            names=["doc_id", "raw_hash", "node", "n_shingles", "bands"],
        )


def _sets(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in slices(batches, "text", _TOGETHER):
        sets = [shingle_set(t, width, hashes).tobytes() for t in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])


def _places(shingles: np.ndarray) -> np.ndarray:
    """The bit of each shingle among those that mark shared ones."""
    return shingles & np.uint64((1 << _BITS) - 1)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of a task have a shingle at each bit."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        bits, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(bits.astype(np.int32)), pa.array(n)], names=["bit", "n"])

    for batch in slices(batches, "shingles", _TOGETHER):
        for x in batch.column("shingles").to_pylist():
            held.append(_places(np.frombuffer(x, np.uint64)))
            size += len(held[-1])
        if size > _SHINGLES:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _grouped(batches: Iterable[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    """Numbers of shared shingles of each set, in all and by group."""
    bitmap = shared.value
    for batch in slices(batches, "shingles", _TOGETHER):
        totals, groups = [], []
        for x in batch.column("shingles").to_pylist():
            x = np.frombuffer(x, np.uint64)
            at = _places(x)
            x = x[(bitmap[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)]
            found = np.bincount((x >> np.uint64(40)) % np.uint64(_GROUPS), minlength=_GROUPS)
            totals.append(len(x))
            groups.append(found.astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(totals, pa.int64()), pa.array(groups, pa.binary())],
            names=["node", "common", "groups"],
        )


def _admitted(rows: pa.Table, percent: int) -> pa.Table:
    """Pairs of one or two blocks of a bucket, of different components, that may overlap enough."""
    left = rows.column("i").to_numpy() == rows.column("block").to_numpy()
    right = rows.column("j").to_numpy() == rows.column("block").to_numpy()
    nodes = rows.column("node").to_pylist()
    root = np.unique(rows.column("root").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    main = rows.column("is_main").to_numpy()
    n = rows.column("n").to_numpy()
    groups = np.frombuffer(b"".join(rows.column("groups").to_pylist()), "<u4").reshape(-1, _GROUPS)
    pairs = []
    within = bool((left & right).any())
    for a, b in ((left, right),) if within else ((left, right), (right, left)):
        other = np.flatnonzero(b)
        for x in np.flatnonzero(a & ~main).tolist():  # of two in the main component none needs to meet
            y = other[(root[other] != root[x]) & (main[other] | (other > x) | (not within and a is left))]
            if len(y):
                most = np.minimum(groups[y], groups[x]).sum(axis=1, dtype=np.int64)
                y = y[(100 + percent) * most >= percent * (n[y] + n[x])]
                pairs += [(min(nodes[x], nodes[z]), max(nodes[x], nodes[z])) for z in y.tolist()]
    return pa.table({c: pa.array([p[at] for p in pairs], pa.binary()) for at, c in enumerate("ab")})


def _confirmed(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets overlap enough."""
    for batch in batches:
        kept = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(x) + len(y) - len(np.union1d(x, y))
            kept.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _close(percent: int) -> Column:
    """Sizes, and numbers of shared shingles, that allow the overlap."""
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & ((100 + percent) * F.least("common_a", "common_b") >= percent * (F.col("n_a") + F.col("n_b")))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the pairs ``(a, b)``; a set that many pairs share is one row of ``sets``, and its pairs may be split."""
    met = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    met = met.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    return met.select("a", "b", "x", "y").mapInArrow(partial(_confirmed, percent=percent), "a binary, b binary")


def _shared_bits(sets: DataFrame) -> Broadcast:
    """A bit for every shingle that two sets have, at least: 2**20 words of 64 bits, at most, come to the driver."""
    counted = sets.select("shingles").mapInArrow(_counted, "bit int, n long")
    counted = counted.groupBy("bit").agg(F.sum("n").alias("n")).where("n > 1")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(63))
    words = counted.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(mask).alias("mask")).toArrow()
    bitmap = np.zeros(1 << (_BITS - 6), np.uint64)
    bitmap[words.column("at").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return sets.sparkSession.sparkContext.broadcast(bitmap)


def _side(rows: DataFrame, mark: str, *more: str) -> DataFrame:
    return rows.select("band", *more, *[F.col(c).alias(f"{x}_{mark}" if x else mark) for c, x in (("node", ""), ("n", "n"), ("common", "common"), ("root", "root"))])


def _crowd_pairs(crowd: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of crowded buckets that both bounds admit; a bucket is cut into blocks, and two of them meet in a task."""
    blocks = F.ceil(F.col("size") / _BLOCK).cast("int")
    crowd = crowd.withColumn("block", F.pmod(F.xxhash64("node", "band"), blocks).cast("int"))
    others = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda x: F.struct(F.least(x, "block").alias("i"), F.greatest(x, "block").alias("j")),
    )
    met = crowd.select("band", "node", "n", "root", "is_main", "block", F.inline(others))
    met = met.join(groups, "node")
    return met.groupBy("band", "i", "j").applyInArrow(lambda rows: _admitted(rows, percent), "a binary, b binary")


def _links(members: DataFrame, texts: DataFrame, percent: int, crowded: int, width: int) -> DataFrame:
    """Links among the ``members`` (band, node, n) that connect what the sets sharing bands connect."""
    buckets = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    met = store(members.join(buckets, "band"), "minhash-met")
    wanted = met.select("node").distinct().join(texts, "node")  # sets of candidates only
    sets = wanted.select("node", "text").mapInArrow(partial(_sets, width=width), "node binary, shingles binary")
    sets = store(sets, "minhash-sets")
    bitmap = _shared_bits(sets)
    groups = sets.mapInArrow(partial(_grouped, shared=bitmap), "node binary, common long, groups binary")
    groups = store(groups, "minhash-groups")
    # a set that shares too little with all others is linked with none
    met = met.join(groups.select("node", "common"), "node").where(100 * F.col("common") >= percent * F.col("n"))
    rank = F.struct(F.expr("1000 * common div n").alias("part"), "node", "n", "common")
    first = met.groupBy("band").agg(F.max(rank).alias("first"), F.count("*").alias("size")).where("size > 1")
    met = met.drop("size").join(first, "band")
    met = store(met.select("band", "size", "node", "n", "common", "first"), "minhash-shared")
    pairs = met.where(F.col("node") != F.col("first.node")).select(
        F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("common").alias("common_a"),
        F.col("first.node").alias("b"), F.col("first.n").alias("n_b"), F.col("first.common").alias("common_b"),
    )
    pairs = pairs.where(_close(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = store(_confirm(pairs, sets, percent), "minhash-links")

    met = met.where("size > 2 AND node != first.node").drop("first")
    met = met.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    roots = met.groupBy("band", "root").agg(F.count("*").alias("held"))
    main = roots.groupBy("band").agg(F.max(F.struct("held", "root")).alias("main"), F.count("*").alias("roots"))
    left = met.join(main.where("roots > 1"), "band").withColumn("is_main", F.col("root") == F.col("main.root"))
    left = store(left.select("band", "size", "node", "n", "common", "root", "is_main"), "minhash-open")
    few = left.where(F.col("size") <= crowded)
    one, two = _side(few.where("NOT is_main"), "a"), _side(few, "b", "is_main")
    pairs = one.join(two, "band").where((F.col("root_a") != F.col("root_b")) & _close(percent) & (F.col("is_main") | F.expr("a < b")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = pairs.union(_crowd_pairs(left.where(F.col("size") > crowded), groups.select("node", "groups"), percent))
    return links.union(store(_confirm(pairs.distinct(), sets, percent), "minhash-links"))


def near_groups(
    docs: DataFrame,
    width: int = 4,
    percent: int = 80,
    crowded: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    if percent < 80:
        raise ValueError("the bands are made for overlaps of 80 percent and more")
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("raw_hash"),
        F.col(text_col).alias("text"),
    )
    signed = rows.mapInArrow(
        partial(_signed, width=width), "doc_id long, raw_hash long, node binary, n_shingles long, bands array<long>"
    )
    signed = store(signed, "minhash-signed")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "raw_hash"))
    nodes = signed.where("n_shingles > 0").groupBy("node").agg(
        one.alias("one"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    nodes = store(nodes.select("node", "one.doc_id", "one.raw_hash", "n", "bands"), "minhash-nodes")
    # a set that no other can be close to is linked with nothing
    members = nodes.where(100 * F.col("n") >= percent * (F.col("n") + 1)).select(F.explode("bands").alias("band"), "node", "n")
    of_node = nodes.select("node", F.col("doc_id").alias("__id"), F.col("raw_hash").alias("__hash"))
    texts = rows.join(of_node, (rows["raw_hash"] == of_node["__hash"]) & rows["doc_id"].eqNullSafe(of_node["__id"]))
    texts = texts.dropDuplicates(["node"])
    roots = components(_links(members, texts, percent, crowded, width))
    rooted = nodes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(lows, "root").select("node", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    found = signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    found = found.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
