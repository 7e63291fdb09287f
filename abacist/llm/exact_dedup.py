"""Exact duplicates by a distributed content sort.

Texts are normalised (runs of blanks become one space), range-partitioned by sampled splitters and
sorted, so that equal texts are neighbours; every row is compared in full with the one before it.
The splitters are (first characters, hash, id): bounded in size however long the texts are, and a
text with very many copies is spread over several partitions. What such a text has in each of them
is put together through the first and last run of every partition, two rows each.

Null and empty texts are equal to each other. Ids that are null come last, so a group has a null
``keep_id`` only if all its ids are null. Rows that repeat both id and text are one document: they
are all counted, and kept or dropped together. An empty table gives an empty result. Columns other
than the id and the text play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.llm.common import small_batches, store, without

BLANKS = r"[\x20\x09-\x0D]+"
_RUNS = "doc_id long, raw_hash long, text_sha256 string, low_id long, size long, part int, run int, edge int, edge_text string"
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("raw_hash", pa.int64()),
        ("text_sha256", pa.string()),
        ("low_id", pa.int64()),
        ("size", pa.int64()),
        ("part", pa.int32()),
        ("run", pa.int32()),
        ("edge", pa.int32()),
        ("edge_text", pa.string()),
    ]
)
_CHUNK = 5_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours in a sorted partition.

    Rows of a run carry its smallest id and its length. Each partition adds a row with the text
    for its first run (``edge`` 0) and for its last one, if that is another (``edge`` 1).
    """
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    ids: list[tuple] = []
    text, run = None, -1

    def close(edge: int | None) -> None:
        sha = hashlib.sha256(text.encode()).hexdigest()
        low, size = ids[0][0], len(ids)
        out.extend((i, h, sha, low, size, part, run, edge, None) for i, h in ids)
        if edge is not None:
            out.append((None, None, sha, low, size, part, run, edge, text))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA
        )

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "raw_hash", "norm")))
        for doc_id, raw_hash, norm in rows:
            if norm != text:
                if ids:
                    close(0 if run == 0 else None)
                    if len(out) >= _CHUNK:
                        yield flush()
                text, run, ids = norm, run + 1, []
            ids.append((doc_id, raw_hash))
    if ids:
        close(min(run, 1))
        yield flush()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, raw_hash, text_sha256, keep_id, group_size, kept."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("raw_hash"),
        normalised(F.col(text_col)).alias("norm"),
    ).select("doc_id", "raw_hash", "norm", F.substring("norm", 1, 16).alias("head"), F.xxhash64("norm").alias("hash"))
    low_first = F.col("doc_id").asc_nulls_last()
    runs = (
        rows.repartitionByRange("head", "hash", low_first)
        .sortWithinPartitions("head", "hash", "norm", low_first)
        .select("doc_id", "raw_hash", "norm")
        .mapInArrow(_runs, _RUNS)
    )
    runs = store(runs, "exact-runs")  # partition numbers must not change between the two uses below

    along = Window.orderBy("part", "edge")  # two rows per partition
    new = F.coalesce(F.lag("edge_text").over(along) != F.col("edge_text"), F.lit(True))
    edges = runs.where("edge_text IS NOT NULL").select("part", "edge", "low_id", "size", new.cast("int").alias("new"))
    edges = edges.withColumn("chain", F.sum("new").over(along))
    chains = edges.groupBy("chain").agg(F.min("low_id").alias("chain_low"), F.sum("size").alias("chain_size"))
    whole = edges.join(chains, "chain").select("part", "edge", "chain_low", "chain_size")
    found = runs.where("edge_text IS NULL").join(F.broadcast(whole), ["part", "edge"], "left")
    keep = F.when(F.col("chain_size").isNull(), F.col("low_id")).otherwise(F.col("chain_low"))
    return found.select(
        "doc_id",
        "raw_hash",
        "text_sha256",
        keep.alias("keep_id"),
        F.coalesce("chain_size", "size").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text a row with a smaller id has; same columns."""
    gone = exact_groups(docs, id_col, text_col).where("NOT kept")
    return without(docs, gone.select(F.col("doc_id").alias(id_col), F.col("raw_hash").alias("__hash")), id_col, text_col)
