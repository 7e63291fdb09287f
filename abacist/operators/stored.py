"""A stored daily grain of usage that is brought up to date instead of being built again.

The store keeps one row per case (its day, user and billable items) and the sums per user and day, both in
files by month. A refresh takes the cases that changed since the watermark, looks up what the store holds of
them, and writes the months they were in and the months they are in anew: a case that moved to another day, lost its
items or went away is taken out where it stood. All other months keep their files. Names and roles are joined when the grain is
read, so that a renamed user needs no refresh. Each refresh is published by a manifest (see
``abacist.sources.manifest``): a refresh that fails changes nothing.

Changes are found by ``modified_at`` of cases and items where the tables have it; rows that are deleted
for good leave no trace there and are named by ``changed``. ``lateness`` looks further back for rows
that arrived after younger ones; cases that are taken twice give the same result.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.bindings import UsageTables
from abacist.functions import day_of, month_of
from abacist.operators.usage import case_folds, entity, with_user
from abacist.sources import manifest

_ENTRY = "kind string, month date, label string, value string"


def _rules(t: UsageTables) -> str:
    """The rules that are applied to stored cases; others need a new store."""
    excluded = t.rules.excluded_users
    named = "table" if isinstance(excluded, DataFrame) else sorted(excluded)
    return f"{sorted(t.rules.billable)} {named} {t.rules.include_deleted}"


def _case_rows(t: UsageTables) -> DataFrame:
    folds = case_folds(t, {"billable_items": F.count("item_id")})
    return folds.select("case_id", "user_id", day_of(F.col("created_at")).alias("day"), "billable_items")


def _watermark(t: UsageTables) -> str | None:
    """The latest change that the tables know of, as text in the session's zone."""
    stamps = [df.agg(F.max("modified_at").cast("string").alias("at")) for df in (t.case, t.case_item) if "modified_at" in df.columns]
    return reduce(DataFrame.union, stamps).agg(F.max("at")).first()[0] if stamps else None


def _changed(t: UsageTables, since: str | None, lateness: timedelta, named: DataFrame | None) -> DataFrame:
    found = [named.select("case_id")] if named is not None else []
    for df in (t.case, t.case_item):
        if "modified_at" in df.columns:
            if since is not None:
                at = F.lit(since).cast(df.schema["modified_at"].dataType)
                df = df.where(F.col("modified_at") > at - F.lit(lateness))
            found.append(df.select("case_id"))
    if not found:
        raise ValueError("neither changed cases nor a modified_at to find them by")
    return reduce(DataFrame.union, found).where("case_id IS NOT NULL").distinct()


def _schemas(t: UsageTables) -> dict[str, T.StructType]:
    user, case = t.case.schema["user_id"].dataType, t.case.schema["case_id"].dataType
    cases = T.StructType().add("case_id", case).add("user_id", user).add("day", "date").add("billable_items", "long")
    grain = T.StructType().add("user_id", user).add("day", "date").add("cases", "long").add("billable_items", "long")
    return {"cases": cases, "grain": grain}


def _folder(label: str, month: date | None) -> str:
    return f"set={label}/month={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def _read(spark: SparkSession, root: str, kind: str, schema: T.StructType, months: dict) -> DataFrame:
    """Rows of the given months (month -> label): one scan of as many folders as there are months."""
    if not months:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/{kind}/{_folder(label, month)}" for month, label in months.items()]
    rows = spark.read.schema(schema).option("basePath", f"{root}/{kind}").parquet(*paths)
    return rows.select(*schema.names)


def _write(df: DataFrame, path: str) -> None:
    # partitions of about one size: a large month is several files, small ones go together
    df = df.withColumn("month", month_of(F.col("day")))
    df.hint("rebalance", F.col("month")).write.partitionBy("month").parquet(path)


def _add_version(
    t: UsageTables, root: str, version: int, label: str, cases: DataFrame, kept: dict, watermark: str | None
) -> int:
    """Write the months of ``cases`` and publish them beside the ``kept`` ones."""
    spark = t.case.sparkSession
    schemas = _schemas(t)
    _write(cases.select(*schemas["cases"].names), f"{root}/cases/set={label}")
    # the schema is given, as a version may have no month at all
    written = spark.read.schema(schemas["cases"].add("month", "date")).parquet(f"{root}/cases/set={label}")
    grain = written.groupBy("user_id", "day").agg(
        F.count(F.lit(1)).alias("cases"), F.sum("billable_items").alias("billable_items")
    )
    _write(grain.select(*schemas["grain"].names), f"{root}/grain/set={label}")
    months = {r["month"]: label for r in written.select("month").distinct().collect()}  # of the calendar
    rows = [("month", month, name, None) for month, name in {**kept, **months}.items()]
    rows.append(("watermark", None, None, watermark))
    rows.append(("rules", None, None, _rules(t)))
    manifest.publish(spark, root, _ENTRY, rows, version)
    return version


def _state(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict, dict]:
    found, rows = manifest.entries(spark, root, _ENTRY, version)
    months = {r["month"]: r["label"] for r in rows if r["kind"] == "month"}
    return found, months, {r["kind"]: r["value"] for r in rows if r["kind"] != "month"}


def build_grain(t: UsageTables, root: str) -> int:
    """Store the grain of all cases as a new version."""
    root = root.rstrip("/")
    version = _state(t.case.sparkSession, root)[0] + 1
    watermark = _watermark(t)  # before the rows are read: what changes meanwhile is taken again
    return _add_version(t, root, version, f"{version}-{uuid.uuid4().hex}", _case_rows(t), {}, watermark)


def refresh_grain(
    t: UsageTables, root: str, changed: DataFrame | None = None, lateness: timedelta = timedelta(0)
) -> int:
    """Bring the store up to date with the tables; returns the version, the same one if nothing changed.

    ``changed`` names cases (``case_id``) beside those that ``modified_at`` tells.
    """
    root, spark = root.rstrip("/"), t.case.sparkSession
    version, months, state = _state(spark, root)
    if not version:
        return build_grain(t, root)
    if state["rules"] != _rules(t):
        raise ValueError("the rules differ from those of the store: build it again")
    since, watermark = state["watermark"], _watermark(t)
    label = f"{version + 1}-{uuid.uuid4().hex}"
    schemas = _schemas(t)
    # the tables may go on changing: the list of cases and their rows are fixed by being written
    _changed(t, since, lateness, changed).write.parquet(f"{root}/changes/{label}")
    ids = spark.read.schema(T.StructType([schemas["cases"]["case_id"]])).parquet(f"{root}/changes/{label}")
    only = replace(t, case=t.case.join(ids, "case_id", "left_semi"), case_item=t.case_item.join(ids, "case_id", "left_semi"))
    _case_rows(only).write.parquet(f"{root}/fresh/{label}")
    fresh = spark.read.schema(schemas["cases"]).parquet(f"{root}/fresh/{label}")
    held = _read(spark, root, "cases", schemas["cases"], months)
    days = held.join(ids, "case_id", "left_semi").select("day").union(fresh.select("day"))
    touched = {r["month"] for r in days.select(month_of(F.col("day")).alias("month")).distinct().collect()}
    if not touched:
        return version
    before = _read(spark, root, "cases", schemas["cases"], {m: x for m, x in months.items() if m in touched})
    after = before.join(ids, "case_id", "left_anti").unionByName(fresh)
    kept = {m: x for m, x in months.items() if m not in touched}
    return _add_version(t, root, version + 1, label, after, kept, max(filter(None, (watermark, since)), default=None))


def read_grain(t: UsageTables, root: str, version: int | None = None) -> DataFrame:
    """The stored grain with today's names and roles, as ``usage.daily_grain`` gives it."""
    root, spark = root.rstrip("/"), t.case.sparkSession
    _, months, _ = _state(spark, root, version)
    grain = _read(spark, root, "grain", _schemas(t)["grain"], months)
    named = with_user(grain, t, role=True)
    return named.groupBy(*entity(t), "role_name", "day").agg(
        F.sum("cases").alias("cases"), F.sum("billable_items").alias("billable_items")
    )
