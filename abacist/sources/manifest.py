"""Versions of a stored thing: files are written aside, and a manifest of one file publishes them.

A manifest lists what belongs to a version. It is written last, by one task, whose file the committer
renames into place: readers see the version before or the new one, never a part of it. What a failed
writer leaves behind is in no manifest. There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    try:
        found = spark.read.schema("version int").parquet(_folder(root))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(r["version"] for r in found.select("version").distinct().collect())


def entries(spark: SparkSession, root: str, schema: str, version: int | None = None) -> tuple[int, list[Row]]:
    """The newest version, or the one asked for, and its entries; version 0 has none."""
    known = versions(spark, root)
    if version is None:
        version = known[-1] if known else 0
    elif version not in known:
        raise ValueError(f"{root} has no version {version}")
    if not version:
        return 0, []
    found = spark.read.schema(f"{schema}, version int").parquet(_folder(root))
    return version, found.where(F.col("version") == version).drop("version").collect()


def publish(spark: SparkSession, root: str, schema: str, rows: Sequence[tuple[Any, ...]], version: int) -> None:
    """Make ``rows`` the entries of a new version."""
    listed = spark.createDataFrame(list(rows), schema).coalesce(1)
    listed.write.mode("errorifexists").parquet(f"{_folder(root)}/version={version}")
