"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.sources.shared import new_dir

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what goes to a Python task at a time in bytes: texts can be long, and rows are many."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def in_share(hash64: Column, most: int, total: int) -> Column:
    """True for about ``most`` of ``total`` rows, by a hash; 62 bits serve any number of rows."""
    share = 1 << 62 if total <= most else (most << 62) // total
    return hash64.bitwiseAND((1 << 62) - 1) < F.lit(share)


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them again."""
    path = new_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str, parts: int, rest: int) -> Column:
    """True for rows of the held-out fold: crc32 of the id as text leaves ``rest``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == rest, F.lit(False))


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Values as str; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of the values; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], text_col: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one hold about ``most`` bytes (a longer text stands alone)."""
    for batch in batches:
        start = held = 0
        for at, length in enumerate(pc.binary_length(batch.column(text_col)).to_pylist()):
            held += length or 0
            if held >= most:
                yield batch.slice(start, at + 1 - start)
                start, held = at + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def without(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose (id, hash of the text) is not in ``dropped``; columns stay as they are."""
    gone = dropped.select(F.col(id_col).alias("__id"), F.col("__hash")).distinct()
    mark = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]) & (mark == gone["__hash"]), "left_anti")
