"""Shards along a Hilbert curve, so that files can be pruned by several metadata columns at once.

Every dimension is cut into ``2 ** bits`` levels at its quantiles, in the order of its own values: numbers and
times as they are, text by its first 1,000 characters. Quantiles of text are exact ones of all rows, those of numbers
are of a sketch of all rows that is off by a ten-thousandth of them at most. The levels address a cell, and cells are ordered along the
Hilbert curve. Rows of a cell follow a hash of their id in slices, so that a cell with very many rows is many slices. The place of
a row is the number of rows in the slices before plus its place in its slice; the runs cut from that
order have sizes at most one apart.

What is broadcast has a bound: at most ``2 ** (bits * dimensions)`` cells, and as many slices plus
the square root of the number of rows. Everything is DataFrame functions.

Equal texts are not kept together: the law ``rows`` cuts the order into runs of one size, wherever a run ends. Values
that tie at a quantile have one level. Null values lie before all others in their dimension. A null text has no bytes. Rows with a null id
are placed like any other. Rows equal in id and text may take each other's slots. An empty table
gives an empty result. Columns that are not named play no part.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from abacist.llm.common import in_share, store

OVERHEAD = 16


def ordered(df: DataFrame, name: str) -> Column:
    """The values of a dimension in a type that has quantiles, or as text."""
    kind = df.schema[name].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, BooleanType):
        return F.col(name).cast("int")
    return F.col(name) if isinstance(kind, NumericType) else F.substring(F.col(name).cast("string"), 1, 1000)


def text_cuts(rows: DataFrame, name: str, levels: int) -> list[str]:
    """Values at which the levels of a text dimension begin, by the counts of all values."""
    counts = rows.where(F.col(name).isNotNull()).groupBy(name).count()
    # runs of values in order, so that no task sorts them all: what a run adds to is the sum of those before
    runs = counts.repartitionByRange(name).withColumn("run", F.spark_partition_id())
    runs = store(runs, "shard-values")
    sizes = runs.groupBy("run").agg(F.sum("count").alias("n"))
    before = F.sum("n").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("run", F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total"))
    upto = F.sum("count").over(Window.partitionBy("run").orderBy(name))
    at = runs.withColumn("upto", upto).join(F.broadcast(starts), "run")
    at = at.select(name, F.expr(f"(start + upto) * {levels} div total").alias("level"))
    return [r["cut"] for r in at.groupBy("level").agg(F.min(name).alias("cut")).orderBy("level").collect()]


def hilbert(cells: DataFrame, axes: list[str], bits: int, out: str) -> DataFrame:
    """Add the Hilbert index of the levels in ``axes`` (Skilling's transposed form)."""
    x = [f"__x{i}" for i in range(len(axes))]
    cells = cells.withColumns({a: F.col(b).cast("int") for a, b in zip(x, axes)})
    for bit in reversed(range(1, bits)):
        low = (1 << bit) - 1
        for name in x:
            on = F.col(name).bitwiseAND(1 << bit) != 0
            swap = F.when(on, F.lit(0)).otherwise(F.col(x[0]).bitwiseXOR(F.col(name)).bitwiseAND(low))
            first = F.col(x[0]).bitwiseXOR(F.when(on, F.lit(low)).otherwise(swap))
            # where an axis is the first one itself, both are the same column and the swap is empty
            new = {x[0]: first} if name == x[0] else {x[0]: first, name: F.col(name).bitwiseXOR(swap)}
            cells = cells.withColumns(new)
    for before, name in zip(x, x[1:]):
        cells = cells.withColumn(name, F.col(name).bitwiseXOR(F.col(before)))
    turn = F.lit(0)
    for bit in reversed(range(1, bits)):
        turn = turn.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(1 << bit) != 0, (1 << bit) - 1).otherwise(0))
    cells = cells.withColumn("__turn", turn)
    index = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for name in x:
            one = F.col(name).bitwiseXOR(F.col("__turn")).bitwiseAND(1 << bit) != 0
            index = index * 2 + F.when(one, 1).otherwise(0)
    return cells.withColumn(out, index).drop(*x, "__turn")


def hilbert_shards(
    docs: DataFrame,
    dimensions: list[str],
    shards: int,
    bits: int = 5,
    least_slice: int = 1000,
    sample: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, cell.

    ``dimensions`` are columns of ``docs``, or ``size`` for the bytes of the text. With ``sample`` the levels of
    text are those of about as many rows, chosen by a hash of id and text, instead of all.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[ordered(docs, d).alias(f"__d{i}") for i, d in enumerate(dimensions) if d != "size"],
    )
    for i, d in enumerate(dimensions):
        if d == "size":
            rows = rows.withColumn(f"__d{i}", F.col("size"))
    axes = [f"__d{i}" for i in range(len(dimensions))]
    rows = store(rows, "shard-rows")
    levels = 1 << bits
    parts = F.lit([i / levels for i in range(1, levels)])
    listed = [a for a in axes if isinstance(rows.schema[a].dataType, StringType)]
    numbers = [a for a in axes if a not in listed]
    found = rows.agg(F.count("*").alias("n"), *[F.percentile_approx(a, parts, 10_000).alias(a) for a in numbers]).first()
    total = found["n"]
    cuts = {a: found[a] or [] for a in numbers}
    chosen = rows if sample is None else rows.where(in_share(F.xxhash64("doc_id", "text_crc32", "size"), sample, total))
    cuts |= {a: text_cuts(chosen, a, levels)[: levels - 1] for a in listed}
    level = {a: sum(F.coalesce(F.col(a) >= F.lit(c), F.lit(False)).cast("int") for c in cuts[a]) + F.lit(0) for a in axes}
    cell = F.lit(0)
    for a in axes:
        cell = cell * levels + level[a]
    rows = rows.select("doc_id", "size", "text_crc32", cell.cast("int").alias("cell"))

    room = max(least_slice, isqrt(total))
    cells = rows.groupBy("cell").agg(F.ceil(F.count("*") / room).cast("long").alias("slices"))
    unpack = {a: F.shiftright("cell", bits * (len(axes) - 1 - i)).bitwiseAND(levels - 1) for i, a in enumerate(axes)}
    cells = store(hilbert(cells.withColumns(unpack), axes, bits, "curve").drop(*axes), "shard-cells")
    placed = rows.join(F.broadcast(cells), "cell")
    placed = placed.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("slices")))
    counts = placed.groupBy("curve", "slice").count()
    along = Window.orderBy("curve", "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("curve", "slice", F.coalesce(F.sum("count").over(along), F.lit(0)).alias("start"))
    inside = Window.partitionBy("curve", "slice").orderBy("doc_id", "text_crc32", "size")
    placed = placed.withColumn("at", F.row_number().over(inside) - 1)
    rank = F.col("start") + F.col("at")
    shard = F.expr(f"(start + at) * {shards} div {max(total, 1)}")
    placed = placed.join(F.broadcast(starts), ["curve", "slice"]).withColumns({"rank": rank, "s": shard})
    slot = F.col("rank") - F.expr(f"(s * {total} + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id",
        "size",
        F.col("text_crc32").cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("s").cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("curve").alias("cell"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as Parquet, one folder per shard, rows in curve order inside each file."""
    where = placed.select(
        F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"), "shard", F.col("slot").alias("__slot")
    ).dropDuplicates(["__id", "__crc"])
    mark = F.crc32(F.coalesce(docs[text_col], F.lit("")).cast("binary"))
    joined = docs.drop("shard").join(where, docs[id_col].eqNullSafe(where["__id"]) & (mark == where["__crc"]))
    joined = joined.drop("__id", "__crc").repartition("shard").sortWithinPartitions("shard", "__slot").drop("__slot")
    joined.write.partitionBy("shard").parquet(path)
