"""Writing finished reports as one bundle that is complete or not there.

Every report is written aside and read back for its row count and digest; then one manifest publishes
the bundle. Readers follow the manifest, so a writer that fails in between leaves the last bundle as
it was. Executors write their partitions themselves, nothing but counts passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.sources import manifest

_ENTRY = "report string, path string, format string, fields string, rows long, digest string"


def _digest(df: DataFrame) -> list[Column]:
    """Rows, and a digest that the order of the rows does not change; maps have no hash, so rows go as JSON."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    total = F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("rows"), total.cast("string").alias("digest")]


def _stored(spark: SparkSession, path: str, fmt: str, fields: str) -> DataFrame:
    reader = spark.read.schema(T.StructType.fromJson(json.loads(fields))).format(fmt)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path)


def report_bundle(reports: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Write the reports as the next bundle below ``root``; returns name -> path."""
    if not reports:
        raise ValueError("a bundle has a report at least")
    names = {name: name.replace("/", "_") for name in reports}
    if len(set(names.values())) < len(names):
        raise ValueError(f"two reports share a path: {sorted(names.items())}")
    spark = next(iter(reports.values())).sparkSession
    last = (manifest.versions(spark, root) or [0])[-1]
    # the writer's own folder: what an earlier one left behind is not in the way
    aside = f"{root.rstrip('/')}/bundles/{last + 1}-{uuid.uuid4().hex}"
    listed, paths = [], {}
    for name, df in reports.items():
        paths[name] = path = f"{aside}/{names[name]}"
        writer = df.write.format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(path)
        fields = df.schema.json()
        kept = _stored(spark, path, fmt, fields)
        found = kept.agg(*_digest(kept)).first()
        listed.append((name, path, fmt, fields, found["rows"], found["digest"]))
    manifest.publish(spark, root, _ENTRY, listed, last + 1)
    return paths


def read_bundle(
    spark: SparkSession, root: str, version: int | None = None, verify: bool = False
) -> dict[str, DataFrame]:
    """The reports of the newest bundle, or of an older ``version``; ``verify`` counts and digests them again."""
    _, listed = manifest.entries(spark, root, _ENTRY, version)
    reports = {e["report"]: _stored(spark, e["path"], e["format"], e["fields"]) for e in listed}
    if verify:
        for e in listed:
            df = reports[e["report"]]
            found = df.agg(*_digest(df)).first()
            if (found["rows"], found["digest"]) != (e["rows"], e["digest"]):
                raise ValueError(f"{e['report']} has {found['rows']} rows, not the {e['rows']} published")
    return reports


def bundle_entries(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """What the manifest says of a bundle: report, rows, digest."""
    _, listed = manifest.entries(spark, root, _ENTRY, version)
    rows = [(e["report"], e["rows"], e["digest"]) for e in listed]
    return spark.createDataFrame(rows, "report string, rows long, digest string")
