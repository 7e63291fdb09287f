"""Issue-tracker documents landed as JSON pages, read with a fixed schema.

A page is one JSON object per line, or one per file with ``multi_line``. Nothing is inferred, so
reading needs no extra pass over the files and unknown fields are skipped by the parser.

A page that cannot be read (broken JSON, a field of another type, nesting beyond the parser's limit, no array
where the rows should be) costs no other page: readers pass over it, and ``unreadable_*`` lists it with its
file and the reason. ``unreported_sprints`` names the sprints that are left without a report.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPRINT_SCHEMA = "id BIGINT, name STRING, startDate STRING, endDate STRING"

_ISSUE = """ARRAY<STRUCT<
    key: STRING, summary: STRING, assigneeName: STRING, assignee: STRING,
    status: STRUCT<name: STRING>, typeName: STRING, typeId: STRING,
    priorityName: STRING, priorityId: STRING,
    currentEstimateStatistic: STRUCT<statFieldValue: STRUCT<value: DOUBLE>>>>"""

REPORT_SCHEMA = f"""sprintId BIGINT, contents STRUCT<
    completedIssues: {_ISSUE},
    issuesNotCompletedInCurrentSprint: {_ISSUE},
    puntedIssues: {_ISSUE}>"""

# cycles stay raw maps: an empty object must remain distinguishable from an absent one
_CYCLE = "MAP<STRING, STRING>"
SLA_TYPE = f"STRUCT<ongoingCycle: {_CYCLE}, completedCycles: ARRAY<{_CYCLE}>>"

_NAMED = "STRUCT<name: STRING>"
# a comment body stays raw JSON: its tree has no fixed depth
TICKET_FIELDS = f"""summary STRING, issuetype {_NAMED},
    status STRUCT<name: STRING, statusCategory: {_NAMED}>, priority {_NAMED},
    assignee STRUCT<displayName: STRING>,
    reporter STRUCT<displayName: STRING, emailAddress: STRING>,
    resolution {_NAMED}, labels ARRAY<STRING>, components ARRAY<{_NAMED}>,
    comment STRUCT<total: BIGINT, comments: ARRAY<STRUCT<
        author: STRUCT<displayName: STRING>, body: STRING>>>,
    created STRING, updated STRING, resolutiondate STRING"""

# Fixed value: custom field type that marks an SLA field.
SLA_FIELD_TYPE = "com.atlassian.servicedesk:sd-sla-field"


def ticket_schema(sla_fields: Mapping[str, str] | None = None) -> T.StructType:
    """Schema of one ticket document with a struct per SLA field id."""
    fields = T.StructType.fromDDL(TICKET_FIELDS)
    sla_type = T.StructType.fromDDL(f"x {SLA_TYPE}")["x"].dataType
    for field in sla_fields or {}:
        fields = fields.add(field, sla_type)
    return T.StructType().add("key", "string").add("fields", fields)


NOT_JSON = "unreadable"
_CORRUPT = "_corrupt_record"


def _quarantined(spark: SparkSession, path: str, page: T.StructType, multi_line: bool, needed: str) -> DataFrame:
    """Pages that give no rows: file, reason, length and beginning of what could not be read."""
    schema = T.StructType([*page.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT)
    pages = reader.option("multiLine", multi_line).json(path)
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit(NOT_JSON)).when(
        F.col(needed).isNull(), F.lit(f"no {needed}")
    )
    return pages.select(
        F.col("_metadata.file_path").alias("file"),
        reason.alias("reason"),
        F.length(_CORRUPT).alias("length"),
        F.substring(_CORRUPT, 1, 200).alias("begins"),
    ).where("reason IS NOT NULL")


def _page(schema: T.StructType, array: str) -> T.StructType:
    return T.StructType().add(array, T.ArrayType(schema))


def unreadable_sprint_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return _quarantined(spark, path, _page(T.StructType.fromDDL(SPRINT_SCHEMA), "values"), multi_line, "values")


def unreadable_sprint_reports(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return _quarantined(spark, path, T.StructType.fromDDL(REPORT_SCHEMA), multi_line, "sprintId")


def unreadable_ticket_pages(
    spark: SparkSession, path: str, sla_fields: Mapping[str, str] | None = None, multi_line: bool = False
) -> DataFrame:
    return _quarantined(spark, path, _page(ticket_schema(sla_fields), "issues"), multi_line, "issues")


def unreported_sprints(sprints: DataFrame, reports: DataFrame) -> list[str]:
    """Names of the sprints without a readable report, in order, for ``carryover_matrix(missing=...)``.

    Sprints are as many as the calendar has; of the reports only the ids are read.
    """
    read = reports.where(F.col("contents").isNotNull()).select(F.col("sprintId").alias("id")).distinct()
    return [r["name"] for r in sprints.join(read, "id", "left_anti").select("name", "id").orderBy("id").collect()]


def _pages(
    spark: SparkSession, path: str, schema: T.StructType, array: str, multi_line: bool
) -> DataFrame:
    """Rows of the ``array`` of every page below ``path``."""
    pages = spark.read.schema(_page(schema, array)).option("multiLine", multi_line).json(path)
    return pages.select(F.inline(array))


def read_sprints(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Sprints from landed pages ``{"values": [...]}``."""
    return _pages(spark, path, T.StructType.fromDDL(SPRINT_SCHEMA), "values", multi_line)


def read_sprint_reports(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Sprint reports, one object with ``sprintId`` and ``contents`` each; unreadable ones are left out."""
    reports = spark.read.schema(REPORT_SCHEMA).option("multiLine", multi_line).json(path)
    return reports.where("sprintId IS NOT NULL")


def read_tickets(
    spark: SparkSession,
    path: str,
    sla_fields: Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Ticket documents from landed pages ``{"issues": [...]}``."""
    return _pages(spark, path, ticket_schema(sla_fields), "issues", multi_line)


def discover_sla_fields(
    spark: SparkSession, path: str, multi_line: bool = False
) -> dict[str, str]:
    """Id and name of the SLA fields in a landed field catalogue.

    The catalogue is configuration, one line per field; it shapes the schema and so is needed
    before any plan over tickets can be written.
    """
    catalogue = spark.read.schema("id STRING, name STRING, schema STRUCT<custom: STRING>")
    fields = catalogue.option("multiLine", multi_line).json(path)
    sla = fields.where(F.col("schema.custom") == SLA_FIELD_TYPE).select("id", "name")
    return {row["id"]: row["name"] for row in sla.orderBy("id").collect()}
