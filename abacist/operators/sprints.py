"""Sprint carry-over: issues that were still open when their sprint closed.

Sprint tables are calendar-sized; issue rows may be many. All reports aggregate issues by
(assignee, sprint) first and reshape the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abacist.functions import quoted
from abacist.operators.matrix import matrix

UNASSIGNED = "Unassigned"
COMPLETED, NOT_COMPLETED, PUNTED = "completed", "not_completed", "punted"

# Arrays of a sprint report and the bucket their issues belong to.
REPORT_BUCKETS = {
    "completedIssues": COMPLETED,
    "issuesNotCompletedInCurrentSprint": NOT_COMPLETED,
    "puntedIssues": PUNTED,
}


def select_sprints(
    sprints: DataFrame,
    year: int | None = None,
    prefix: str | None = None,
    last_n: int | None = None,
) -> DataFrame:
    """Sprints by start year and name prefix, the last ``n`` by end date.

    ``seq`` numbers them in end-date order (a missing end date sorts first, ties by id).
    """
    if year is not None:
        sprints = sprints.where(F.col("startDate").startswith(str(year)))
    if prefix is not None:
        sprints = sprints.where(F.col("name").startswith(prefix))
    end = F.coalesce("endDate", F.lit(""))
    if last_n is not None:
        sprints = sprints.orderBy(end.desc(), F.col("id").desc()).limit(last_n)
    return sprints.withColumn("seq", F.row_number().over(Window.orderBy(end, "id")))


def _first_filled(*columns: Column) -> Column:
    """First value that is neither NULL nor empty, else the last one."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])


def flatten_sprint_reports(
    reports: DataFrame, sprints: DataFrame, base_url: str = ""
) -> DataFrame:
    """One row per issue of each report of a selected sprint, with the bucket it was in.

    The three arrays of a report become three tagged rows first, so reports are read once. The
    calendar-sized sprints are broadcast, so that issues are not moved to meet them.
    """
    arrays = [
        F.struct(F.lit(bucket).alias("bucket"), F.col(f"contents.{name}").alias("issues"))
        for name, bucket in REPORT_BUCKETS.items()
    ]
    tagged = reports.select("sprintId", F.inline(F.array(*arrays)))
    issues = tagged.select("sprintId", "bucket", F.explode("issues").alias("issue"))
    chosen = sprints.select(
        F.col("id").alias("sprint_id"), F.col("name").alias("sprint_name"), "endDate"
    )
    rows = issues.join(F.broadcast(chosen), F.col("sprintId") == F.col("sprint_id"))
    issue = lambda path: F.col(f"issue.{path}")
    return rows.select(
        "sprint_id",
        "sprint_name",
        F.col("endDate").try_cast("timestamp").alias("sprint_end"),
        "bucket",
        issue("key").alias("issue_key"),
        issue("summary").alias("summary"),
        _first_filled(issue("assigneeName"), issue("assignee"), F.lit(UNASSIGNED)).alias(
            "assignee"
        ),
        issue("status.name").alias("status"),
        _first_filled(issue("typeName"), issue("typeId")).alias("issue_type"),
        _first_filled(issue("priorityName"), issue("priorityId")).alias("priority"),
        issue("currentEstimateStatistic.statFieldValue.value").alias("story_points"),
        F.concat(F.lit(f"{base_url}/browse/"), F.coalesce(issue("key"), F.lit("None"))).alias(
            "url"
        ),
        F.lit(1).alias("relevant"),
    )


def _carried(count_punted: bool) -> list[str]:
    return [NOT_COMPLETED, PUNTED] if count_punted else [NOT_COMPLETED]


def carryover_rows(issues: DataFrame, count_punted: bool = False) -> DataFrame:
    """Issues left open at sprint end, with ``count_punted`` also those removed before it."""
    return issues.where(F.col("bucket").isin(*_carried(count_punted)))


def carryover_matrix(
    carried: DataFrame, sprint_order: Sequence[str], missing: Sequence[str] = ()
) -> DataFrame:
    """Assignee x sprint counts with a total, every sprint present and in order.

    Sprints in ``missing`` had no readable report: their cells are NULL instead of zero.
    """
    shown = F.when(F.col("sprint_name").isin(*sprint_order), F.col("sprint_name"))
    # someone whose carry-over lies in other sprints only keeps a row of zeros
    wide = matrix(carried, ["assignee"], shown, F.count(F.lit(1)), sprint_order, 0)
    total = F.expr(" + ".join(["0L", *[quoted(s) for s in sprint_order]]))
    blank = {s: F.lit(None).cast("bigint") for s in missing if s in sprint_order}
    return wide.withColumn("TOTAL", total).withColumns(blank)


def carryover_trend(wide: DataFrame, sprint_order: Sequence[str], top_n: int = 10) -> DataFrame:
    """Dense per-sprint series of the ``top_n`` people of a carry-over matrix."""
    top = wide.orderBy(F.desc("TOTAL"), "assignee").limit(top_n).drop("TOTAL")
    cells = [quoted(s) for s in sprint_order]
    return top.unpivot(["assignee"], cells, "sprint_name", "carried")


def team_trend(
    carried: DataFrame,
    sprints: DataFrame,
    window: int = 3,
    reported: DataFrame | None = None,
) -> DataFrame:
    """Carried issues per sprint with a trailing mean over ``window`` sprints.

    Sprints without issues count zero. With ``reported`` (a ``sprint_name`` table of readable
    reports) a sprint missing from it has NULL. One sprint alone has no trailing mean.
    """
    counts = carried.groupBy("sprint_name").agg(F.count(F.lit(1)).alias("_n"))
    dim = sprints.select(F.col("name").alias("sprint_name"), "seq")
    value = F.coalesce("_n", F.lit(0))
    rows = dim.join(counts, "sprint_name", "left")
    if reported is not None:
        seen = reported.select("sprint_name").distinct().withColumn("_seen", F.lit(True))
        rows = rows.join(seen, "sprint_name", "left")
        value = F.when(F.col("_seen"), value)
    rows = rows.select("sprint_name", "seq", value.alias("carried"))
    trailing = Window.orderBy("seq").rowsBetween(1 - window, 0)
    several = F.count(F.lit(1)).over(Window.partitionBy()) >= 2
    mean = F.when(several, F.avg("carried").over(trailing))
    return rows.withColumn("moving_avg", mean)


def tickets_for(issues: DataFrame, person: str, count_punted: bool = False) -> DataFrame:
    """Everything one person carried over."""
    mine = carryover_rows(issues, count_punted).where(F.col("assignee") == person)
    return mine.select(
        "sprint_name",
        "sprint_end",
        "bucket",
        "issue_key",
        "summary",
        "status",
        "issue_type",
        "priority",
        "story_points",
        "url",
    )


def repeat_offenders(carried: DataFrame, min_times: int = 2) -> DataFrame:
    """Issues one assignee carried through several sprints.

    Rows with a missing key part belong to no group. The collected set holds sprint names, so it
    is bounded by the number of sprints however often an issue appears.
    """
    keys = ["issue_key", "summary", "assignee"]
    sets = (
        carried.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set("sprint_name")).alias("_sprints"))
    )
    return sets.where(F.size("_sprints") >= min_times).select(
        *keys,
        F.size("_sprints").alias("times_carried"),
        F.array_join("_sprints", ", ").alias("sprints"),
    )


def carryover_rate(
    issues: DataFrame, sprint_order: Sequence[str], count_punted: bool = False
) -> DataFrame:
    """Assignee x sprint share of relevant issues that were not completed.

    Lists the people of the carry-over matrix except the unassigned; blank without any relevant
    issue. Only ``not_completed`` counts as carried here, whatever the matrix counts.
    """
    relevant = F.col("relevant") == 1
    # someone whose carry-over lies in other sprints only is listed with blanks, as in the matrix
    shown = F.when(F.col("sprint_name").isin(*sprint_order), F.col("sprint_name"))
    cells = (
        issues.where(F.col("assignee") != UNASSIGNED)
        .groupBy("assignee", shown.alias("sprint_name"))
        .agg(
            F.count_if(relevant & (F.col("bucket") == NOT_COMPLETED)).alias("_open"),
            F.count_if(relevant).alias("_all"),
            F.count_if(F.col("bucket").isin(*_carried(count_punted))).alias("_listed"),
        )
        .withColumn("_rate", F.col("_open") / F.nullif("_all", F.lit(0)))
    )
    columns = [
        F.max(F.when(F.col("sprint_name") == s, F.col("_rate"))).alias(s) for s in sprint_order
    ]
    wide = cells.groupBy("assignee").agg(*columns, F.sum("_listed").alias("_listed"))
    return wide.where(F.col("_listed") > 0).drop("_listed")


def bucket_counts(issues: DataFrame, per_sprint: bool = False) -> DataFrame:
    """Issues per bucket, overall or per sprint."""
    keys = ["sprint_name", "bucket"] if per_sprint else ["bucket"]
    return issues.groupBy(*keys).agg(F.count(F.lit(1)).alias("issues"))
