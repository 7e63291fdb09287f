"""Roles of the generated tables (see FIXTURES.md section 2) in the reports."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.bindings import (
    Period,
    Pricing,
    RecordTables,
    TokenTables,
    UsageRules,
    UsageTables,
    bind,
)
from abacist.operators.tickets import LOCAL_ZONE, add_features, flatten_tickets, ticket_features
from abacist.operators.usage import CASE_STATES, ITEM_STATUSES
from abacist.sources.shared import new_dir
from abacist.sources.tables import read_table

BASE_URL = "https://tracker.example"
EXCLUDED = (3, 17, 99, 512, 899)
RULES = UsageRules(excluded_users=EXCLUDED)
PRICING = Pricing()
MONTH = Period.month(1996, 3)
YEARS = Period(date(1995, 1, 1), date(2002, 1, 1))
AS_OF = datetime(1998, 1, 1, 12, 0)
STATUS_NAMES = list(ITEM_STATUSES.values())

ITEM_STATUS = (
    "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 5 "
    "WHEN l_returnflag = 'R' THEN 2 WHEN l_returnflag = 'A' THEN 4 "
    "WHEN l_linestatus = 'F' THEN 3 ELSE 1 END"
)
CASE_STATE = "CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'P' THEN 2 ELSE 1 END"


@lru_cache(maxsize=None)
def _schema(spark: SparkSession, sf: str, name: str):
    return read_table(spark, sf, name).schema


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A generated table; they never change, so a session infers each schema only once."""
    return read_table(spark, sf, name, schema=_schema(spark, sf, name))


def name_table(spark: SparkSession, id_column: str, name_column: str, names: dict) -> DataFrame:
    """A small lookup table written out as SQL values."""
    rows = ", ".join(f"({i}, '{n}')" for i, n in names.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({id_column}, {name_column})")


def usage(spark: SparkSession, sf: str) -> UsageTables:
    """case = orders, item = lineitem, user = customer, role = nation."""
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return UsageTables(
        case=bind(
            orders,
            case_id="o_orderkey",
            user_id="o_custkey",
            state_id=CASE_STATE,
            created_at="o_orderdate",
            items_total="CAST(o_orderkey % 50 AS INT)",
            percentage_matched="CAST(o_custkey % 101 AS DOUBLE)",
            percentage_done="CAST(o_orderkey % 97 AS DOUBLE)",
            is_deleted="o_orderpriority = '5-LOW'",
        ),
        case_item=bind(
            lineitem,
            item_id="l_orderkey",
            case_id="l_orderkey",
            status_id=ITEM_STATUS,
            exact_dimensions_found="l_linenumber <= 3",
            is_deleted="l_linenumber = 7",
        ),
        user=users(spark, sf),
        user_role=bind(table(spark, sf, "nation"), role_id="n_nationkey", role_name="n_name"),
        case_state=name_table(spark, "state_id", "state_name", CASE_STATES),
        item_status=name_table(spark, "status_id", "status_name", ITEM_STATUSES),
        rules=RULES,
    )


def stamped_usage(spark: SparkSession, sf: str, earlier: bool) -> UsageTables:
    """``usage`` with times of change: as it is, or as it was before urgent orders moved to another day,
    those of high priority to another user, and some lines to another status."""
    base = usage(spark, sf)
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    late = F.col("l_linenumber") == 6
    if earlier:
        orders = orders.withColumns(
            {
                "o_orderdate": F.when(urgent, F.expr("o_orderdate - INTERVAL 40 DAYS")).otherwise(F.col("o_orderdate")),
                "o_custkey": F.when(high, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")),
            }
        )
        lineitem = lineitem.withColumn("l_returnflag", F.when(late, F.lit("N")).otherwise(F.col("l_returnflag")))
        urgent = high = late = F.lit(False)
    first, then = (F.lit(x).cast("timestamp_ntz") for x in ("2002-01-01 00:00:00", "2002-02-01 00:00:00"))
    case = bind(
        orders,
        case_id="o_orderkey",
        user_id="o_custkey",
        created_at="o_orderdate",
        is_deleted="o_orderpriority = '5-LOW'",
        modified_at=F.when(urgent | high, then).otherwise(first),
    )
    item = bind(
        lineitem,
        item_id="l_orderkey",
        case_id="l_orderkey",
        status_id=ITEM_STATUS,
        is_deleted="l_linenumber = 7",
        modified_at=F.when(late, then).otherwise(first),
    )
    return replace(base, case=case, case_item=item)


def namesakes(spark: SparkSession, sf: str) -> UsageTables:
    """Many users of one name, told apart by their ids."""
    base = usage(spark, sf)
    named = base.user.withColumns(
        {"first_name": F.lit("Sam"), "last_name": (F.col("user_id") % 7).cast("string")}
    )
    return replace(base, user=named, rules=replace(base.rules, by_user_id=True))


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth customer has no last name (falls to e-mail), every 25th nothing at all."""
    return bind(
        table(spark, sf, "customer"),
        user_id="c_custkey",
        first_name="substring_index(c_name, '#', 1)",
        last_name="CASE WHEN c_custkey % 10 <> 0 THEN substring_index(c_name, '#', -1) END",
        email="CASE WHEN c_custkey % 25 <> 0 THEN concat('u', c_custkey, '@example.org') END",
        role_id="c_nationkey",
    )


def latency(spark: SparkSession, sf: str) -> UsageTables:
    """case = lineitem: created at order date, queued at ship date, modified at order date + 90 d."""
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    joined = orders.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    case = bind(
        joined,
        case_id="o_orderkey",
        user_id="o_custkey",
        state_id=CASE_STATE,
        created_at="o_orderdate",
        queued_at="l_shipdate",
        last_modified="o_orderdate + INTERVAL 90 DAYS + make_dt_interval(0, 0, l_linenumber, l_quantity)",
        items_total="CAST(l_quantity AS INT)",
    )
    return UsageTables(case=case, rules=RULES)


def offers(spark: SparkSession, sf: str) -> UsageTables:
    """item = order, offer = lineitem; 257 orders at sf0.01 have no offer."""
    base = usage(spark, sf)
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return UsageTables(
        case=base.case,
        case_item=bind(orders, item_id="o_orderkey", case_id="o_orderkey", status_id="5"),
        user=base.user,
        offer_item=bind(
            lineitem,
            offer_item_id="l_orderkey",
            item_id="l_orderkey",
            is_selected="l_returnflag = 'R'",
            match_distance="l_discount * 10 + l_tax",
        ),
        rules=RULES,
    )


def offers_of_grouped_items(spark: SparkSession, sf: str) -> UsageTables:
    """As ``offers``, with up to four items per case."""
    base = offers(spark, sf)
    items = base.case_item.withColumn("case_id", F.col("item_id") - F.col("item_id") % 4)
    return replace(base, case_item=items)


def fanned_accessories(spark: SparkSession, sf: str) -> UsageTables:
    """As ``accessories``, with up to eight items per case; most have two offers or none."""
    base = accessories(spark, sf)
    items = base.case_item.withColumn("case_id", F.col("item_id") - F.col("item_id") % 8)
    pair = F.col("offer_item_id") - F.col("offer_item_id") % 2
    # an offer belongs to the even order of its pair if there is one, else to its own
    even = base.case_item.select(F.col("item_id").alias("even"))
    offered = base.offer_item.drop("item_id").join(even, pair == F.col("even"), "left")
    offered = offered.withColumn("item_id", F.coalesce("even", "offer_item_id")).drop("even")
    return replace(base, case_item=items, offer_item=offered)


def accessories(spark: SparkSession, sf: str) -> UsageTables:
    """offer = order (urgent ones selected), accessory = lineitem."""
    base = offers(spark, sf)
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return UsageTables(
        case=base.case,
        case_item=base.case_item,
        offer_item=bind(
            orders,
            offer_item_id="o_orderkey",
            item_id="o_orderkey",
            is_selected="o_orderpriority <> '5-LOW'",
        ),
        product_accessory=bind(
            lineitem,
            accessory_id="l_partkey",
            offer_item_id="l_orderkey",
            is_selected="l_returnflag = 'R'",
            accessory_quantity="CAST(l_quantity AS INT)",
        ),
        rules=RULES,
    )


def records(spark: SparkSession, sf: str) -> RecordTables:
    """record = lineitem, client = nation of the supplier, job = order."""
    lineitem = table(spark, sf, "lineitem")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    located = lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return RecordTables(
        record=bind(
            located,
            record_id="l_orderkey",
            client_id="s_nationkey",
            job_harvest_id="l_orderkey",
            state_id="CASE l_returnflag WHEN 'R' THEN 18 WHEN 'A' THEN 12 "
            "ELSE CASE WHEN l_linestatus = 'F' THEN 20 ELSE 7 END END",
            created_at="l_shipdate",
            is_deleted="l_linenumber = 7",
            source_key="l_partkey",
        ),
        client=bind(table(spark, sf, "nation"), client_id="n_nationkey", name="n_name"),
    )


# a general list that changes in mid-1996 and ends with 1997, and one client's own list
DATED_PRICES = """(NULL, NULL, DATE '1996-07-01', 0, 500, 10, 2990), (NULL, NULL, DATE '1996-07-01', 500, NULL, 9, 2990),
    (NULL, DATE '1996-07-01', DATE '1998-01-01', 0, 300, 11, 1500),
    (NULL, DATE '1996-07-01', DATE '1998-01-01', 300, 1000, 7, 1500),
    (NULL, DATE '1996-07-01', DATE '1998-01-01', 1000, NULL, 5, 1500),
    ('NATION_3', DATE '1995-06-01', NULL, 0, NULL, 6, 0)"""
_PRICE_COLUMNS = "client_name, valid_from, valid_to, lower, upper, rate, minimum"


def dated_prices(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {DATED_PRICES} AS t({_PRICE_COLUMNS})")


def segment_records(spark: SparkSession, sf: str) -> RecordTables:
    """record = lineitem, client = one market segment or the others, which exceed the last price tier."""
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "BUILDING").otherwise("OTHERS")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", segment.alias("segment"))
    lines = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return RecordTables(
        record=bind(
            lines.join(customer, F.col("o_custkey") == F.col("c_custkey")),
            record_id="l_orderkey",
            client_id="segment",
            job_harvest_id="l_orderkey",
            state_id="18",
            created_at="l_shipdate",
            is_deleted="l_linenumber = 7",
        ),
        client=bind(customer.select("segment").distinct(), client_id="segment", name="segment"),
    )


def tokens(spark: SparkSession, sf: str) -> TokenTables:
    """usage = events, record = customer, client = nation."""
    k = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    return TokenTables(
        usage=bind(
            table(spark, sf, "events"),
            usage_id="event_id",
            record_id="user_id",
            invoked_at="ts",
            prompt_tokens=f"{k} * 1000",
            completion_tokens=f"{k} * 10 + user_id",
            total_tokens=f"{k} * 1010 + user_id",
            elapsed_time_seconds="value",
            model_name="event_type",
        ),
        record=bind(
            table(spark, sf, "customer"), record_id="c_custkey", client_id="c_nationkey"
        ),
        client=bind(table(spark, sf, "nation"), client_id="n_nationkey", name="n_name"),
    )


def monthly_tokens(spark: SparkSession, sf: str) -> TokenTables:
    """usage = lineitem over many months, record = order, client = nation of the customer."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    record = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return TokenTables(
        usage=bind(
            table(spark, sf, "lineitem"),
            usage_id="l_partkey",
            record_id="l_orderkey",
            invoked_at="l_shipdate",
            prompt_tokens="CAST(l_quantity AS BIGINT) * 1000 + l_linenumber",
            completion_tokens="CAST(l_quantity AS BIGINT) * 37",
            total_tokens="CAST(l_quantity AS BIGINT) * 1037 + l_linenumber",
            elapsed_time_seconds="l_tax * 100 + l_quantity",
            model_name="concat('model-', l_returnflag)",
        ),
        record=bind(record, record_id="o_orderkey", client_id="c_nationkey"),
        client=bind(table(spark, sf, "nation"), client_id="n_nationkey", name="n_name"),
    )


def sprint_months(spark: SparkSession, sf: str) -> DataFrame:
    """One sprint per calendar month that has orders."""
    months = table(spark, sf, "orders").select(F.trunc("o_orderdate", "month").alias("m"))
    return bind(
        months.distinct(),
        id="year(m) * 100 + month(m)",
        name="concat('Team ', date_format(m, 'yyyy-MM'))",
        startDate="date_format(m, \"yyyy-MM-dd'T'00:00:00.000'Z'\")",
        endDate="date_format(last_day(m), \"yyyy-MM-dd'T'00:00:00.000'Z'\")",
    )


BUCKET = "CASE l_returnflag WHEN 'R' THEN 'not_completed' WHEN 'A' THEN 'completed' ELSE 'punted' END"


def sprint_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Issue rows: sprint = order month, issue = part, assignee = nation of the supplier."""
    sprints = bind(
        table(spark, sf, "orders"),
        o_orderkey="o_orderkey",
        o_orderpriority="o_orderpriority",
        sprint_id="year(o_orderdate) * 100 + month(o_orderdate)",
        sprint_name="concat('Team ', date_format(o_orderdate, 'yyyy-MM'))",
        sprint_end="last_day(o_orderdate)",
    )
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    people = bind(
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")),
        s_suppkey="s_suppkey",
        assignee="CASE WHEN n_nationkey = 7 THEN 'Unassigned' ELSE n_name END",
    )
    joined = (
        table(spark, sf, "lineitem")
        .join(sprints, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(people, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return bind(
        joined,
        sprint_id="sprint_id",
        sprint_name="sprint_name",
        sprint_end="sprint_end",
        bucket=BUCKET,
        issue_key="concat('P-', l_partkey)",
        summary="concat('part ', l_partkey)",
        assignee="assignee",
        status="l_linestatus",
        issue_type="CAST(l_linenumber AS STRING)",
        priority="o_orderpriority",
        story_points="l_quantity",
        url="concat('https://tracker.example/browse/P-', l_partkey)",
        relevant="CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END",
    )


def sprint_names() -> list[str]:
    return [f"Team {m}" for m in YEARS.months()]


ODD_PREFIX = 'Team, "1`.5" '


def odd_sprint_names() -> list[str]:
    return [f"{ODD_PREFIX}{y}" for y in range(YEARS.start.year, YEARS.end.year)]


PRIORITY = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Highest' WHEN '2-HIGH' THEN 'High' "
    "WHEN '3-MEDIUM' THEN 'Medium' WHEN '4-NOT SPECIFIED' THEN 'Unset' ELSE 'Lowest' END"
)
TICKET_LABELS = {
    "status": "CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'Waiting' ELSE 'Working' END",
    "category": "CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'To Do' ELSE 'In Progress' END",
}


STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'"
CREATED_UTC = "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT))"
RESOLVED_UTC = f"{CREATED_UTC} + make_dt_interval(0, CAST(o_orderkey % 2400 AS INT))"


# cycles as string maps of raw JSON values, the way landed pages are read
SLA_CYCLES = """CASE WHEN o_orderkey % 5 <> 0 THEN named_struct(
    'ongoingCycle', CASE WHEN o_orderstatus = 'F' THEN CAST(map() AS MAP<STRING, STRING>) ELSE map(
        'breached', CAST(o_totalprice > 250000 AS STRING),
        'remainingTime', '{"friendly":"2h"}', 'elapsedTime', '{"friendly":"1h"}') END,
    'completedCycles', array(
        map('breached', 'true', 'elapsedTime', '{"friendly":"9h"}'),
        map('elapsedTime', '{"friendly":"3h"}'))) END"""


def sla_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """The SLA field of every ticket on its own."""
    return bind(table(spark, sf, "orders"), key="concat('T-', o_orderkey)", sla=SLA_CYCLES)


def nested_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """Ticket documents in their landed shape, built row by row from the orders.

    Created some hours into the order date; done tickets are resolved after a number of hours.
    """
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    )
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))

    def text(expr: str) -> str:
        return f'date_format({expr}, "{STAMP}")'

    def paragraphs(expr: str) -> str:
        leaf = "named_struct('type', 'text', 'text', x)"
        block = f"named_struct('type', 'paragraph', 'content', array({leaf}))"
        blocks = f"transform(split({expr}, ' '), x -> {block})"
        return f"to_json(named_struct('type', 'panel', 'content', {blocks}))"

    fields = f"""named_struct(
        'summary', concat('order ', o_orderkey),
        'issuetype', named_struct('name', c_mktsegment),
        'status', named_struct('name', {TICKET_LABELS["status"]},
                               'statusCategory', named_struct('name', {TICKET_LABELS["category"]})),
        'priority', named_struct('name', {PRIORITY}),
        'assignee', CASE WHEN c_nationkey <> 7 THEN named_struct('displayName', concat('Agent ', c_nationkey)) END,
        'reporter', named_struct('displayName', c_name,
                                 'emailAddress', concat('u', o_custkey, '@example.org')),
        'resolution', CASE WHEN o_orderstatus = 'F' THEN named_struct('name', 'Fixed') END,
        'labels', CASE WHEN o_orderkey % 3 = 0 THEN array('a', o_orderpriority) END,
        'components', array(named_struct('name', c_mktsegment), named_struct('name', o_orderstatus)),
        'comment', CASE WHEN o_orderkey % 4 <> 0 THEN named_struct(
            'total', 2L,
            'comments', array(
                named_struct('author', named_struct('displayName', 'first'), 'body', '{{}}'),
                named_struct('author', named_struct('displayName', c_name),
                             'body', {paragraphs("concat('handled by  ', c_name)")}))) END,
        'created', {text(CREATED_UTC)},
        'updated', {text(CREATED_UTC)},
        'resolutiondate', CASE WHEN o_orderstatus = 'F' THEN {text(RESOLVED_UTC)} END,
        'sla_1', {SLA_CYCLES})"""
    return bind(joined, key="concat('T-', o_orderkey)", fields=fields)


SLA_FIELDS = {"sla_1": "Time to resolution"}


def nested_reports(spark: SparkSession, sf: str, issues: str = "1") -> DataFrame:
    """Sprint reports in their landed shape, one report per order line.

    The line's array has ``issues`` copies of its issue, numbered in their keys. No issues are
    gathered per sprint: a month of lines would have to fit into one row.
    """
    orders = table(spark, sf, "orders")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        table(spark, sf, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    issue = """named_struct(
        'key', concat('P-', l_partkey, CASE WHEN n > 1 THEN concat('/', n) ELSE '' END),
        'summary', concat('part ', l_partkey),
        'assigneeName', CASE WHEN s_nationkey = 7 THEN '' ELSE concat('Agent ', s_nationkey) END,
        'assignee', CASE WHEN s_nationkey = 7 AND l_linenumber > 2 THEN 'agent7' END,
        'status', CASE WHEN l_linenumber <> 5 THEN named_struct('name', l_linestatus) END,
        'typeName', CASE WHEN l_linenumber <> 3 THEN concat('type ', l_linenumber) END,
        'typeId', '3',
        'priorityName', o_orderpriority,
        'priorityId', '9',
        'currentEstimateStatistic', CASE WHEN l_linenumber <> 4 THEN
            named_struct('statFieldValue', named_struct('value', l_quantity)) END)"""

    def array_for(flag: str) -> str:
        return f"CASE WHEN l_returnflag = '{flag}' THEN issues END"

    listed = f"transform(sequence(1, CAST({issues} AS INT)), n -> {issue})"
    return bind(
        bind(joined, issues=listed, l_returnflag="l_returnflag", o_orderdate="o_orderdate"),
        sprintId="CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT)",
        contents=f"""named_struct(
            'completedIssues', {array_for("A")},
            'issuesNotCompletedInCurrentSprint', {array_for("R")},
            'puntedIssues', {array_for("N")})""",
    )


def ticket_rows(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_tickets(nested_tickets(spark, sf), BASE_URL, SLA_FIELDS)


def ticket_features_of(spark: SparkSession, sf: str) -> DataFrame:
    """Features by way of the landed documents."""
    return ticket_features(ticket_rows(spark, sf), AS_OF)


def _flat_rows(spark: SparkSession, sf: str, stamp: str) -> DataFrame:
    """Ticket rows without nested input; ``stamp`` renders a UTC time with ``{}`` in its place."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    )
    return bind(
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")),
        key="concat('T-', o_orderkey)",
        summary="concat('order ', o_orderkey)",
        issuetype="c_mktsegment",
        status=TICKET_LABELS["status"],
        status_category=TICKET_LABELS["category"],
        priority=PRIORITY,
        assignee="CASE WHEN c_nationkey = 7 THEN 'Unassigned' ELSE concat('Agent ', c_nationkey) END",
        reporter="c_name",
        reporter_email="concat('u', o_custkey, '@example.org')",
        created=stamp.format(CREATED_UTC),
        updated=stamp.format(CREATED_UTC),
        resolutiondate=f"CASE WHEN o_orderstatus = 'F' THEN {stamp.format(RESOLVED_UTC)} END",
    )


def stamped_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """Features from rows with timestamp texts, as the flattening leaves them."""
    return ticket_features(_flat_rows(spark, sf, f'date_format({{}}, "{STAMP}")'), AS_OF)


def flat_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """The same features from rows already in local time, for all further reports."""
    return add_features(_flat_rows(spark, sf, f"convert_timezone('UTC', '{LOCAL_ZONE}', {{}})"), AS_OF)


def deep_trees(spark: SparkSession, sf: str, depth: int = 2500) -> DataFrame:
    """Every conversation as one tree: each turn holds the next one ``depth`` levels further down."""
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", F.regexp_replace("text", "\n", " ").alias("text")))).alias("turns")
    )
    leaf = "to_json(named_struct('type', 'text', 'text', t.text))"
    opened = f"""'{{"type":"paragraph","content":[', {leaf}, ',', repeat('{{"type":"doc","content":[', {depth})"""
    closed = f"repeat(']}}', {depth}), ']}}'"
    body = f"""concat(array_join(transform(turns, t -> concat({opened})), ''),
        '{{"type":"rule"}}', repeat(concat({closed}), size(turns)))"""
    return bind(turns, conv_id="conv_id", body=body)


def landed_reports(spark: SparkSession, sf: str) -> str:
    """Folder of landed reports, an order each, of which low priorities broke off and urgent ones lost their id."""
    report = "to_json(named_struct('sprintId', o_orderkey, 'contents', named_struct('completedIssues', array())))"
    line = f"""CASE o_orderpriority WHEN '5-LOW' THEN substring({report}, 1, length({report}) - 1 - o_orderkey % 9)
        WHEN '1-URGENT' THEN replace({report}, 'sprintId', 'id') ELSE {report} END"""
    path = new_dir(spark, "landed-reports")
    bind(table(spark, sf, "orders"), value=line).write.text(path)
    return path


def document_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation turn as a document tree with one paragraph per line."""
    leaf = "named_struct('type', 'text', 'text', line)"
    block = f"named_struct('type', 'paragraph', 'content', array({leaf}))"
    lines = f"transform(split(text, '\\n'), line -> {block})"
    return bind(
        table(spark, sf, "conversations"),
        conv_id="conv_id",
        turn="turn",
        body=f"to_json(named_struct('type', 'panel', 'content', {lines}))",
    )
