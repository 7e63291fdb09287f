"""Reshaping finished reports: long to wide, and shares that need a whole-report view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.functions import pct, quoted


def matrix(
    df: DataFrame,
    rows: Sequence[str],
    column: str | Column,
    value: Column,
    values: Sequence[str] | None = None,
    fill: object | None = None,
) -> DataFrame:
    """Pivot ``column`` into one field per entry of ``values``.

    With ``values`` the schema is known up front, every listed column exists, and no extra job
    runs; a label outside the list stops the query instead of vanishing (a missing label has no
    column). Without it Spark first looks up which values occur, which fits short label sets only.
    """
    label = column if isinstance(column, Column) else F.col(column)
    if values is not None:
        other = F.concat(F.lit("label outside the matrix: "), label.cast("string"))
        listed = label.isNull() | label.isin(*values)
        label = F.when(listed, label).otherwise(F.raise_error(other).cast("string"))
    pivoted = (
        df.withColumn("_label", label)
        .groupBy(*rows)
        .pivot("_label", list(values) if values is not None else None)
        .agg(value)
    )
    if fill is None:
        return pivoted
    cells = pivoted.columns[len(rows) :]
    return pivoted.select(
        *rows, *[F.coalesce(F.col(quoted(c)), F.lit(fill)).alias(c) for c in cells]
    )


def month_label(column: str) -> Column:
    return F.date_format(column, "yyyy-MM")


def day_label(column: str) -> Column:
    return F.date_format(column, "dd")


def transpose(df: DataFrame, row: str, name: str, values: Sequence[str]) -> DataFrame:
    """Swap the axes of a matrix: its columns become rows, ``values`` of ``row`` become columns."""
    cells = [quoted(c) for c in df.columns if c != row]
    long = df.unpivot([row], cells, name, "_cell")
    return matrix(long, [name], row, F.first("_cell"), values)


def pareto(df: DataFrame, entity: str | Sequence[str], volume: str) -> DataFrame:
    """Rank, share and cumulative share of a per-entity volume table, ties sharing one value.

    Entities can be many, so no window runs over them. Rank and running sum depend on the volume
    only, hence the window sees one row per *distinct* volume. Distinct positive integers adding
    up to a total of N are fewer than sqrt(2 N): about a million for 10**12 units.
    """
    entity = [entity] if isinstance(entity, str) else entity
    everything = Window.partitionBy()
    descending = Window.orderBy(F.col(volume).desc())
    steps = (
        df.groupBy(volume)
        .agg(F.count(F.lit(1)).alias("_entities"), F.sum(volume).alias("_units"))
        .select(
            F.col(volume).alias("_volume"),
            (F.sum("_entities").over(descending) - F.col("_entities") + 1).alias("rank"),
            pct(F.col(volume), F.sum("_units").over(everything)).alias("pct_of_total"),
            pct(F.sum("_units").over(descending), F.sum("_units").over(everything)).alias(
                "cumulative_pct"
            ),
        )
    )
    ranked = df.join(steps, df[volume] == steps["_volume"])
    return ranked.select("rank", *entity, volume, "pct_of_total", "cumulative_pct")


def amount_pareto(df: DataFrame, entity: str | Sequence[str], volume: str, parts: int = 200) -> DataFrame:
    """``pareto`` for volumes of which very many differ, such as amounts of money.

    A prefix sum in two steps: distinct volumes are cut into about equal ``parts`` by quantiles of a sketch,
    the sums of the parts above are added to the sums inside a part. A task sees one part, and the window
    over all of them one row per part. NULL volumes come last, with an unknown share.
    """
    entity = [entity] if isinstance(entity, str) else entity
    steps = df.groupBy(volume).agg(F.count(F.lit(1)).alias("_entities"), F.sum(volume).alias("_units"))
    size = F.col(volume).cast("double")
    edges = [F.lit(i / parts) for i in range(1, parts)]
    cuts = steps.where(size.isNotNull()).agg(F.kll_sketch_agg_double(size, F.lit(4096)).alias("kll"))
    cuts = cuts.select(F.kll_sketch_get_quantile_double("kll", F.array(*edges))).scalar()
    # parts are numbered from the largest volumes on; the sketch decides on their sizes only
    larger = F.size(F.filter("_cuts", lambda e: e > size))
    steps = steps.withColumn("_cuts", cuts).withColumn("_part", F.when(size.isNull(), F.lit(parts)).otherwise(larger))
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    sums = steps.groupBy("_part").agg(F.sum("_entities").alias("_n"), F.sum("_units").alias("_sum"))
    offsets = sums.select(
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_before"),
        F.sum("_sum").over(above).alias("_above"),
        F.sum("_sum").over(whole).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(F.col(volume).desc_nulls_last())
    ranked = steps.join(F.broadcast(offsets), F.col("_part") == F.col("_of"))  # a row per part
    upto = F.sum("_units").over(inside)
    ranked = ranked.select(
        F.col(volume).alias("_volume"),
        (F.col("_before") + F.sum("_entities").over(inside) - F.col("_entities") + 1).alias("rank"),
        pct(F.col(volume), F.col("_total")).alias("pct_of_total"),
        pct(F.when(F.col("_above").isNull(), upto).otherwise(F.col("_above") + upto), F.col("_total")).alias(
            "cumulative_pct"
        ),
    )
    found = df.join(ranked, df[volume].eqNullSafe(ranked["_volume"]))
    return found.select("rank", *entity, volume, "pct_of_total", "cumulative_pct")


def running_sum(column: str, order: str) -> Column:
    """Running total over a finished report with one row per calendar period."""
    return F.sum(column).over(
        Window.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
