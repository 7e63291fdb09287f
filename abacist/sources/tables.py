"""Relational tables by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """The table ``<root>/<name>.<fmt>``; a known schema saves the job that would infer it."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{root.rstrip('/')}/{name}.{fmt}")


def read_tables(
    spark: SparkSession, root: str, names: Iterable[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name, fmt) for name in names}
