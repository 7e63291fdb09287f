"""Service-desk tickets: from nested documents to rows, features and reports."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.functions import band, numeric, quoted, whole_days
from abacist.operators.matrix import matrix, running_sum

UNASSIGNED = "Unassigned"

# Block types of a document tree that separate their children by line breaks.
BLOCK_TYPES = (
    "paragraph",
    "heading",
    "bulletList",
    "orderedList",
    "listItem",
    "codeBlock",
    "blockquote",
    "panel",
    "rule",
)

# Open status categories, priorities in order, age bands with inclusive lower ends.
OPEN_CATEGORIES = ("To Do", "In Progress")
PRIORITY_ORDER = ("Highest", "High", "Medium", "Low", "Lowest")
AGE_EDGES = (0, 1, 3, 7, 14, 30, 60, 90)
AGE_LABELS = ("0d", "1-2d", "3-6d", "7-13d", "14-29d", "30-59d", "60-89d", "90d+")

SLA_METRICS = ("breached", "remaining", "elapsed")
LOCAL_ZONE = "Europe/Prague"  # Fixed value


# --- nested documents to rows -----------------------------------------------------------------


def _document_reader(levels: int = 400):
    """Functions from a document to its tree, whatever its depth, and to its text.

    The standard parser reads documents of any depth in pieces of ``levels`` open nodes at most.
    """
    # nested, so that the functions travel with the job and executors need no copy of the library
    steps = np.zeros(256, np.int8)
    steps[list(b"{[")], steps[list(b"}]")] = 1, -1
    marks = steps != 0
    marks[list(b'"')] = True

    def brackets(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places of the brackets outside strings, and the number of nodes open after each."""
        codes = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(marks[codes])
        quotes = at[codes[at] == 34]
        if b"\\" in data:
            # a quote after an odd number of backslashes is part of its string
            slashes = np.flatnonzero(codes == 92)
            first = np.append(True, slashes[1:] != slashes[:-1] + 1)
            begins = slashes[first][np.cumsum(first) - 1]
            before = np.searchsorted(slashes, quotes) - 1
            escaped = (slashes[before] == quotes - 1) & ((quotes - begins[before]) % 2 == 1) & (before >= 0)
            quotes = quotes[~escaped]
        at = at[codes[at] != 34]
        at = at[np.searchsorted(quotes, at) % 2 == 0]
        return at, np.cumsum(steps[codes[at]], dtype=np.int64)

    def parse(raw: str, hook=None):
        """What the standard parser gives with ``hook`` for objects, for documents of any depth.

        Nodes ``levels`` below the last cut are read first, each on its own; where they stood, a number that
        occurs nowhere in the document stands for them. Every character is read by the standard parser.
        """
        data = raw.encode("utf-8", "surrogatepass")
        at, depth = brackets(data)
        if len(at) and (depth[-1] != 0 or depth.min() < 0):
            raise ValueError("brackets without their counterparts")
        opened = np.diff(depth, prepend=0) > 0
        inside = np.flatnonzero(opened & (depth > 1) & (depth % levels == 1 % levels))
        ends = np.flatnonzero(~opened & (depth > 0) & (depth % levels == 0))
        # on one level every start is followed by its end
        inside = inside[np.argsort(depth[inside], kind="stable")]
        ends = ends[np.argsort(depth[ends], kind="stable")]
        starts, ends, level = at[inside], at[ends] + 1, depth[inside] // levels
        taken = 0
        while (sign := f"0.{taken}5e") in raw:
            taken += 1
        below: list = []  # what the nodes one level further down were read as
        lower = np.empty((0, 2), np.int64)

        def number(text: str):
            return below[int(text[len(sign) :])] if text.startswith(sign) else float(text)

        decode = json.JSONDecoder(object_hook=hook, parse_float=number).decode

        def read(start: int, end: int):
            a, b = np.searchsorted(lower[:, 0], (start, end)).tolist()
            parts = []
            for i, (cut, after) in enumerate(lower[a:b].tolist(), a):
                parts += data[start:cut], f" {sign}{i} ".encode()
                start = after
            parts.append(data[start:end])
            return decode(b"".join(parts).decode("utf-8", "surrogatepass"))

        for k in range(int(level[-1]) if len(level) else 0, 0, -1):
            here = np.stack((starts, ends), axis=1)[slice(*np.searchsorted(level, (k, k + 1)))]
            found = [read(start, end) for start, end in here.tolist()]
            below, lower = found, here
        return read(0, len(data))

    def text_of_node(node: dict) -> tuple[str] | None:
        """A node's text in a tuple, which no other value is; none for a node without."""
        kind, content = node.get("type"), node.get("content")
        if kind == "text":
            leaf = node.get("text")
            return (leaf,) if isinstance(leaf, str) else None
        if not isinstance(content, list):
            return None
        found = [child[0] for child in content if type(child) is tuple]
        text = ("\n" if kind in BLOCK_TYPES else "").join(found)
        return (text,) if text else None

    def text_of(raw: str | None) -> str:
        if not raw:
            return ""
        try:
            try:
                found = json.loads(raw, object_hook=text_of_node)
            except RecursionError:  # nested beyond what the standard parser takes
                found = parse(raw, text_of_node)
        except ValueError:  # no JSON
            return ""
        return found[0] if type(found) is tuple else ""

    return parse, text_of


def _document_text_udf():
    _, text_of = _document_reader()

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(text_of)

    return F.pandas_udf(texts, T.StringType())


def document_text(body: Column) -> Column:
    """Plain text of a JSON document tree; anything that is not a tree gives an empty string.

    Trees may be nested to any depth: neither reading nor walking them recurs. Nodes whose content is
    no list have no children, and texts that are no strings are left out.

    The depth of the tree is open, which no built-in function can walk: the one Python function
    of the library, run on Arrow batches in every partition.
    """
    return _document_text_udf()(body)


def _filled(value: Column, default: str = "") -> Column:
    return F.coalesce(value, F.lit(default))


def last_comment(comments: Column) -> dict[str, Column]:
    """Text and author of the last element of a comment array, empty without comments."""
    last = F.try_element_at(comments, F.lit(-1))
    return {
        "last_comment": _filled(document_text(last["body"])),
        "last_comment_user": _filled(last["author"]["displayName"]),
    }


def last_comment_of(comments: DataFrame, ticket: str, order: str, text: str, user: str) -> DataFrame:
    """The same for a long comment table: the latest comment per ticket, without collecting any.

    The last place in the order is found by a hash aggregation; only the comments at that place
    are moved with their texts. Of several at one place the first by text and user counts.
    """
    ends = comments.groupBy(ticket).agg(
        F.max(order).alias("_end"), F.count(F.lit(1)).alias("comment_count")
    )
    last = comments.select(
        F.col(ticket).alias("_ticket"), F.col(order).alias("_at"), F.col(text).alias("_text"), F.col(user).alias("_user")
    )
    at_end = ends[ticket].eqNullSafe(last["_ticket"]) & (ends["_end"] == last["_at"])
    first = Window.partitionBy(ticket).orderBy("_text", "_user")
    rows = ends.join(last, at_end, "left").withColumn("_n", F.row_number().over(first))
    return rows.where("_n = 1").select(
        ticket,
        "comment_count",
        _filled(F.col("_text")).alias("last_comment"),
        _filled(F.col("_user")).alias("last_comment_user"),
    )


def sla_status(sla: Column) -> dict[str, Column]:
    """Breach flag, remaining and elapsed time of one SLA.

    The ongoing cycle counts, else the last completed one; an empty ongoing object is none.
    Remaining time exists only while a cycle is ongoing. Cycles are string maps (raw JSON
    values), so that an empty object stays distinguishable from an absent one.
    """
    ongoing = F.when(F.size(sla["ongoingCycle"]) > 0, sla["ongoingCycle"])
    completed = F.try_element_at(sla["completedCycles"], F.lit(-1))
    cycle = F.coalesce(ongoing, F.when(F.size(completed) > 0, completed))

    def friendly(source: Column, name: str) -> Column:
        return _filled(F.get_json_object(source[name], "$.friendly"))

    breached = F.coalesce(cycle["breached"].try_cast("boolean"), F.lit(False))
    return {
        "breached": F.when(cycle.isNotNull(), breached),
        "remaining": friendly(ongoing, "remainingTime"),
        "elapsed": friendly(cycle, "elapsedTime"),
    }


def sla_column(name: str, metric: str) -> str:
    return f"{name} — {metric}"


def flatten_tickets(
    tickets: DataFrame, base_url: str = "", sla_fields: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per ticket document; ``sla_fields`` maps SLA field ids to their names."""
    f = lambda path: F.col(f"fields.{path}")
    sla = {
        sla_column(name, metric): value
        for field, name in (sla_fields or {}).items()
        for metric, value in sla_status(f(field)).items()
    }
    names = F.transform(f("components"), lambda c: _filled(c["name"]))
    assignee = F.nullif(f("assignee.displayName"), F.lit(""))
    row = {
        "key": F.col("key"),
        "url": F.concat(F.lit(f"{base_url}/browse/"), F.col("key")),
        "summary": _filled(f("summary")),
        "issuetype": _filled(f("issuetype.name")),
        "status": _filled(f("status.name")),
        "status_category": _filled(f("status.statusCategory.name")),
        "priority": _filled(f("priority.name")),
        "assignee": _filled(assignee, UNASSIGNED),
        "reporter": _filled(f("reporter.displayName")),
        "reporter_email": _filled(f("reporter.emailAddress")),
        "resolution": _filled(f("resolution.name")),
        "labels": _filled(F.array_join(f("labels"), ", ")),
        "components": _filled(F.array_join(names, ", ")),
        "comment_count": F.coalesce(f("comment.total"), F.lit(0)),
        **last_comment(f("comment.comments")),
        "created": f("created"),
        "updated": f("updated"),
        "resolutiondate": f("resolutiondate"),
        **sla,
    }
    return tickets.select(*[value.alias(name) for name, value in row.items()])


def local_time(stamp: Column, zone: str = LOCAL_ZONE) -> Column:
    """Zoned timestamp text to wall-clock time in ``zone``, whatever the session zone is."""
    micros = F.unix_micros(F.to_timestamp(stamp))
    utc = F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def ticket_features(rows: DataFrame, as_of: datetime, zone: str = LOCAL_ZONE) -> DataFrame:
    """Local times, whole-day age and resolution, month, week and the open flag.

    ``as_of`` is wall-clock time in ``zone``.
    """
    times = {c: local_time(F.col(c), zone) for c in ("created", "updated", "resolutiondate")}
    return add_features(rows.withColumns(times), as_of)


def wall_clock(moment: datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def add_features(rows: DataFrame, as_of: datetime) -> DataFrame:
    """The derived columns of ``ticket_features`` for rows already in local time."""
    created = F.col("created")
    monday = F.trunc(created, "week")
    return rows.withColumns(
        {
            "age_days": whole_days(wall_clock(as_of), created),
            "resolution_days": whole_days(F.col("resolutiondate"), created),
            "month": F.date_format(created, "yyyy-MM"),
            "week": F.concat(
                monday.cast("string"), F.lit("/"), F.date_add(monday, 6).cast("string")
            ),
            "is_open": F.coalesce(F.col("status_category").isin(*OPEN_CATEGORIES), F.lit(False)),
        }
    )


# --- reports ----------------------------------------------------------------------------------


def ticket_kpis(features: DataFrame) -> DataFrame:
    """Total, open and closed tickets, mean age of the open ones and mean resolution time."""
    is_open = F.col("is_open")
    totals = features.agg(
        F.count(F.lit(1)).cast("decimal(18,1)").alias("total"),
        F.count_if(is_open).cast("decimal(18,1)").alias("open"),
        F.count_if(~is_open).cast("decimal(18,1)").alias("closed"),
        numeric(F.avg(F.when(is_open, F.col("age_days"))), 1).alias("age"),
        numeric(F.avg("resolution_days"), 1).alias("resolution"),
    )
    # Metric names of the summary sheet.
    metrics = {
        "Total issues": "total",
        "Open": "open",
        "Closed / Done": "closed",
        "Avg age open (days)": "age",
        "Avg resolution (days)": "resolution",
    }
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(column).alias("value"))
        for name, column in metrics.items()
    ]
    return totals.select(F.inline(F.array(*pairs)))


def count_by(features: DataFrame, column: str) -> DataFrame:
    """Tickets per value of ``column``."""
    known = features.where(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def monthly_volume(features: DataFrame) -> DataFrame:
    """Tickets per month and their running total."""
    monthly = features.where(F.col("month").isNotNull()).groupBy("month").agg(
        F.count(F.lit(1)).alias("issues")
    )
    return monthly.withColumn("cumulative", running_sum("issues", "month"))


def ordered_priority(
    by_priority: DataFrame, order: Sequence[str] = PRIORITY_ORDER
) -> DataFrame:
    """Priority counts with their place in a fixed order; other priorities are dropped."""
    place = F.array_position(F.array(*[F.lit(p) for p in order]), F.col("priority"))
    placed = by_priority.withColumn("ordinal", place.cast("int"))
    return placed.where(F.col("ordinal") > 0)


def assignee_workload(features: DataFrame) -> DataFrame:
    """Closed, open and all tickets per assignee."""
    return features.groupBy("assignee").agg(
        F.count_if(~F.col("is_open")).alias("closed"),
        F.count_if("is_open").alias("open"),
        F.count(F.lit(1)).alias("total"),
    )


def top_reporters(features: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` reporters with most tickets, with the e-mail of their newest ticket that has one.

    Tickets are counted by hash; e-mails are looked up for the ``k`` reporters only.
    """
    grouped = features.where(F.col("reporter").isNotNull()).groupBy("reporter").agg(
        F.count("key").alias("total"), F.count_if("is_open").alias("open")
    )
    top = grouped.orderBy(F.desc("total"), "reporter").limit(k)
    mailed = features.where(F.col("reporter_email").isNotNull()).select(
        F.col("reporter").alias("_who"), "key", F.coalesce("created", F.lit("0001-01-01").cast("timestamp_ntz")).alias("_at"),
        F.col("reporter_email").alias("email"),
    )
    names = top.select(F.col("reporter").alias("_name"))
    mailed = mailed.join(F.broadcast(names), F.col("_who") == F.col("_name"), "left_semi")  # k rows
    newest = mailed.groupBy("_who").agg(F.max("_at").alias("_newest"))
    newest = newest.withColumnRenamed("_who", "_whose")
    latest = mailed.join(newest, (F.col("_who") == F.col("_whose")) & (F.col("_at") == F.col("_newest")))
    by_key = Window.partitionBy("_who").orderBy(F.desc("key"))
    latest = latest.withColumn("_n", F.row_number().over(by_key)).where("_n = 1")
    found = top.join(latest, F.col("reporter") == F.col("_who"), "left")
    return found.select("reporter", "total", "open", "email")


def _open_with_band(features: DataFrame) -> DataFrame:
    # cut on the age itself: a filter on the label would be pushed down as eight copies of it
    aged = features.where(F.col("is_open") & (F.col("age_days") >= AGE_EDGES[0]))
    label = band(F.col("age_days"), AGE_EDGES, AGE_LABELS, closed="lower")
    return aged.withColumn("age_bucket", label)


def aging_buckets(features: DataFrame) -> DataFrame:
    """Open tickets per age band; empty bands and negative ages do not appear."""
    return _open_with_band(features).groupBy("age_bucket").agg(F.count(F.lit(1)).alias("count"))


def aging_by_assignee(features: DataFrame, labels: Sequence[str] = AGE_LABELS) -> DataFrame:
    """Assignee x age band counts of open tickets, zero-filled."""
    aged = _open_with_band(features)
    return matrix(aged, ["assignee"], "age_bucket", F.count(F.lit(1)), labels, 0)


def oldest_open(features: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` oldest open tickets, ties by creation time and key."""
    oldest = features.where("is_open").orderBy(F.desc("age_days"), "created", "key").limit(k)
    return oldest.select(
        "key", "summary", "status", "priority", "assignee", "age_days", "created"
    )


def resolution_stats(features: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the resolution days.

    Whole days have few distinct values, so the exact percentile keeps a small map.
    """
    days = F.col("resolution_days")
    stats = features.where(days.isNotNull()).agg(
        F.count(days).alias("count"),
        F.avg(days).alias("mean"),
        F.stddev_samp(days).alias("std"),
        F.min(days).alias("min"),
        F.percentile(days, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
        F.max(days).alias("max"),
    )
    quartiles = [numeric(F.col("q")[i], 1).alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
    return stats.select(
        "count",
        *[numeric(F.col(c), 1).alias(c) for c in ("mean", "std", "min")],
        *quartiles,
        numeric(F.col("max"), 1).alias("max"),
    )


def resolution_histogram(features: DataFrame, cap: int = 60, bins: int = 30) -> DataFrame:
    """Equal-width bins over the capped resolution days, the last one closed on both sides.

    Days fold to one row per distinct value before the extremes are taken, so the unpartitioned
    window sees a bounded table. Bin numbers are whole-number arithmetic; empty bins are listed.
    """
    days = F.least(F.col("resolution_days"), F.lit(cap))
    counted = (
        features.where(F.col("resolution_days").isNotNull())
        .groupBy(days.cast("bigint").alias("days"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    everything = Window.partitionBy()
    ranged = counted.select(
        "days", "n", F.min("days").over(everything).alias("lo"), F.max("days").over(everything).alias("hi")
    )
    # a single distinct value gets a range of one day around it, i.e. the middle bin
    index = F.when(
        F.col("hi") > F.col("lo"),
        F.least(F.expr(f"(days - lo) * {bins} div (hi - lo)"), F.lit(bins - 1)),
    ).otherwise(F.lit(bins // 2))
    filled = ranged.withColumn("bin", index.cast("int")).groupBy("bin", "lo", "hi").agg(
        F.sum("n").alias("issues")
    )
    number = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    spine = filled.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where(
        F.col("lo").isNotNull()
    )
    spine = spine.select(number, "lo", "hi")
    single = F.col("lo") == F.col("hi")
    start = F.when(single, F.col("lo") - 0.5).otherwise(F.col("lo").cast("double"))
    width = F.when(single, F.lit(1.0)).otherwise((F.col("hi") - F.col("lo")).cast("double"))
    return spine.join(filled.select("bin", "issues"), "bin", "left").select(
        "bin",
        (start + width * F.col("bin") / bins).alias("from_days"),
        (start + width * (F.col("bin") + 1) / bins).alias("to_days"),
        F.coalesce("issues", F.lit(0)).alias("issues"),
    )


def median_resolution_by_type(features: DataFrame) -> DataFrame:
    """Median resolution days per issue type."""
    resolved = features.where(F.col("resolution_days").isNotNull())
    return resolved.groupBy("issuetype").agg(
        F.percentile("resolution_days", 0.5).alias("median_days")
    )


def month_category_matrix(
    features: DataFrame, categories: Sequence[str] | None = None
) -> DataFrame:
    """Month x status category counts, zero-filled."""
    return matrix(features, ["month"], "status_category", F.count(F.lit(1)), categories, 0)


# Columns of the exported sheet before and after the SLA columns.
EXPORT_COLUMNS = (
    "key",
    "summary",
    "issuetype",
    "status",
    "priority",
    "assignee",
    "reporter",
    "reporter_email",
    "labels",
    "comment_count",
    "last_comment",
    "last_comment_user",
    "created",
    "updated",
    "resolutiondate",
    "age_days",
)


def ticket_export(
    features: DataFrame, sla_names: Sequence[str] = (), open_only: bool = False
) -> DataFrame:
    """The exported columns with minute timestamps, for all tickets or the open ones."""
    if open_only:
        features = features.where("is_open")
    stamps = {"created", "updated", "resolutiondate"}
    columns = [
        F.date_format(c, "yyyy-MM-dd HH:mm").alias(c) if c in stamps else F.col(c)
        for c in EXPORT_COLUMNS
    ]
    sla = [F.col(quoted(sla_column(n, m))) for n in sla_names for m in SLA_METRICS]
    return features.select(*columns, *sla, "url")
