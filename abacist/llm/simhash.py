"""Near-duplicates by 64-bit SimHash and deletion-variant signatures.

A fingerprint is cut into two halves: if two differ in at most ``distance`` <= 3 bits, one half
differs in at most one. So every half is indexed under its 32 variants with one bit left out, and
fingerprints that share a variant are verified by counting the bits that differ. Only distinct
fingerprints are indexed, so copies cost nothing. A variant shared by exactly two of them is a pair
as it stands; one shared by a few is joined with itself; fingerprints in variants shared by more
than ``crowded`` are indexed by all their variants with ``distance`` bits left out instead, where
whatever meets is linked. That work is linear in the crowd, and no link is lost.

Words are runs without blanks, A-Z lower-cased; shingles are counted with repeats. Null, empty and
blank texts have the fingerprint zero. Null ids take part but are never a component's id unless all
its ids are null. Repeated rows are answered each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from abacist.llm.common import LOWER, small_batches, store, text_bytes, without
from abacist.llm.components import components

SEED = 42
_BLOCK = 1 << 15
_HALF = 0xFFFFFFFF


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter((xxh64_intdigest(g, SEED) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        octets = hashes[at : at + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t, width) for t in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("raw_hash"), pa.array(found, pa.int64())],
            names=["doc_id", "raw_hash", "fp"],
        )


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, raw_hash (of the text as it is) and fp of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("raw_hash"),
        F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(partial(_fingerprints, width=width), "doc_id long, raw_hash long, fp long")


def _variants(points: DataFrame) -> DataFrame:
    """64 keys per fingerprint: number of the bit left out, and the other bits of its half."""
    bit = F.col("bit")
    half = F.when(bit < 32, F.col("fp").bitwiseAND(_HALF)).otherwise(F.shiftrightunsigned("fp", 32))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int"))
    rows = points.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    return rows.select("fp", (F.call_function("shiftleft", bit.cast("long"), F.lit(32)) + half.bitwiseAND(F.bitwise_not(mask))).alias("key"))


def _apart(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _crowd_links(points: DataFrame, distance: int) -> DataFrame:
    """Links inside a crowd: equal after the same ``distance`` bits are left out means linked."""
    masks = []
    for bits in combinations(range(64), distance):
        mask = sum(1 << b for b in bits)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    # 2016 at distance 2; as a literal they start no second set of Python workers, which would stay on every executor
    keyed = points.select("fp", F.explode(F.lit(sorted(masks))).alias("mask"))
    keyed = keyed.select("fp", "mask", F.col("fp").bitwiseAND(F.bitwise_not("mask")).alias("rest"))
    # at most 2 ** distance fingerprints share (mask, rest)
    met = keyed.groupBy("mask", "rest").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b")


def links(points: DataFrame, distance: int = 2, crowded: int = 64) -> DataFrame:
    """Links ``(a, b)`` that connect whatever distinct fingerprints ``fp`` differ in at most ``distance`` bits."""
    if not 1 <= distance <= 3:
        raise ValueError("two halves serve distances 1 to 3")
    sharing = Window.partitionBy("key")  # distinct fingerprints only; a long run is spilled, not held
    members = _variants(points).withColumns(
        {"n": F.count("*").over(sharing), "a": F.min("fp").over(sharing), "b": F.max("fp").over(sharing)}
    )
    # two alone are a pair as they stand
    members = members.where((F.col("n") > 2) | (F.col("n") == 2) & (_apart("a", "b") <= distance))
    members = store(members, "variants")
    pairs = members.where("n = 2 AND fp = a").select("a", "b")
    members = members.where("n > 2").select("key", "fp", "n")
    few = members.where(F.col("n") <= crowded).select("key", "fp")
    # a pair whose halves are equal meets under all 32 bits of that half: take the first of them
    bit = F.call_function("shiftrightunsigned", F.col("key"), F.lit(32)).cast("int")
    both = F.col("a").bitwiseXOR(F.col("b"))
    half = F.when(bit < 32, both.bitwiseAND(_HALF)).otherwise(F.shiftrightunsigned(both, 32))
    met = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key").where(F.col("a") < F.col("b"))
    met = met.where((_apart("a", "b") <= distance) & ((half != 0) | (bit % 32 == 0))).select("a", "b")

    crowd = members.where(F.col("n") > crowded).select("fp").distinct()
    return pairs.union(met).union(_crowd_links(crowd, distance))


def near_groups(
    docs: DataFrame,
    width: int = 3,
    distance: int = 2,
    crowded: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, raw_hash, fp, component_id (smallest doc_id reachable)."""
    prints = store(fingerprints(docs, width, id_col, text_col), "fingerprints")
    points = store(prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "points")
    nodes = components(links(points.select("fp"), distance, crowded))
    rooted = points.join(nodes, points["fp"] == nodes["node"], "left").select(
        "fp", "low_id", F.coalesce("root", "fp").alias("root")
    )
    lows = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = rooted.join(lows, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "raw_hash", "fp", "component_id")


def keep_one(
    docs: DataFrame, width: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the smallest id of every component; same columns."""
    found = near_groups(docs, width, distance, id_col=id_col, text_col=text_col)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    return without(docs, gone.select(F.col("doc_id").alias(id_col), F.col("raw_hash").alias("__hash")), id_col, text_col)
