import json
import sys
from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from abacist.operators import tickets as tic
from abacist.operators.matrix import transpose
from abacist.sources import discover_sla_fields, read_tickets, report_bundle

BASE = "https://tracker.example"
CUSTOM = "com.atlassian.servicedesk:sd-sla-field"
CATALOGUE = [
    {"id": "summary", "name": "Summary", "schema": {"type": "string"}},
    {"id": "customfield_1", "name": "First response", "schema": {"custom": CUSTOM}},
    {"id": "customfield_2", "name": "Other", "schema": {"custom": "something:else"}},
]


def text(value):
    return {"type": "text", "text": value}


def block(kind, *children):
    return {"type": kind, "content": list(children)}


BODY = block(
    "doc",
    block("paragraph", text("one"), text("two")),
    block("paragraph"),
    block(
        "bulletList",
        block("listItem", block("paragraph", text("a"))),
        block("listItem", block("paragraph", text("b"), block("strange", text("c"), text("d")))),
    ),
    block("codeBlock", text("x = 1")),
)
BODY_TEXT = "one\ntwoa\nb\ncdx = 1"


def ticket(key, status="To Do", created="2024-06-01T10:00:00.000+0000", resolved=None, **fields):
    return {
        "key": key,
        "fields": {
            "summary": f"about {key}",
            "issuetype": {"name": "Incident"},
            "status": {"name": "Waiting", "statusCategory": {"name": status}},
            "priority": {"name": "High"},
            "created": created,
            "updated": created,
            "resolutiondate": resolved,
            "labels": [],
            **fields,
        },
    }


def cycle(friendly, **more):
    return {"elapsedTime": {"friendly": friendly}, **more}


TICKETS = [
    ticket("T-1", assignee={"displayName": "Ann"}, labels=["x", "y"], components=[{"name": "c1"}, {}],
           reporter={"displayName": "Rob", "emailAddress": "old@x"},
           comment={"total": 2, "comments": [
               {"author": {"displayName": "first"}, "body": block("doc")},
               {"author": {"displayName": "last"}, "body": BODY}]},
           customfield_1={"ongoingCycle": cycle("1h", breached=True, remainingTime={"friendly": "-1h"}),
                          "completedCycles": [cycle("9h")]}),
    ticket("T-2", assignee={"displayName": ""}, comment={"total": 0, "comments": []},
           reporter={"displayName": "Rob", "emailAddress": "new@x"}, created="2024-06-02T10:00:00.000+0000",
           customfield_1={"ongoingCycle": {}, "completedCycles": [cycle("8h", breached=True), cycle("3h")]}),
    # month changes in local time, done within a day across midnight
    ticket("T-3", "Done", "2024-06-30T22:30:00.000+0000", "2024-07-01T22:29:00.000+0000", customfield_1={"ongoingCycle": {}}),
    # winter offset, and an elapsed day more in wall-clock time than on the watch
    ticket("T-4", "Done", "2024-01-31T23:30:00.000+0100", "2024-03-31T21:30:00.000+0000", assignee=None,
           comment={"total": 1, "comments": [{"author": None, "body": "plain text"}]}),
    ticket("T-5", "Unknown", priority={"name": "Blocker"}, resolution={"name": "Fixed"}),
    ticket("T-6", "In Progress", created="2024-07-02T10:00:00.000+0000"),  # in the future
]
AS_OF = datetime(2024, 7, 1, 13, 0)


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("tickets")
    pages = [{"issues": TICKETS[:4], "nextPageToken": "x"}, {"issues": TICKETS[4:]}]
    (root / "pages.json").write_text("\n".join(json.dumps(p) for p in pages))
    (root / "fields.json").write_text("\n".join(json.dumps(f) for f in CATALOGUE))
    (root / "page.json").write_text(json.dumps(pages[0], indent=1))
    return root


@pytest.fixture(scope="module")
def flat(spark, landed):
    sla = discover_sla_fields(spark, str(landed / "fields.json"))
    assert sla == {"customfield_1": "First response"}
    return tic.flatten_tickets(read_tickets(spark, str(landed / "pages.json"), sla), BASE, sla)


@pytest.fixture(scope="module")
def features(flat):
    return tic.ticket_features(flat, AS_OF)


def test_flattened_tickets(flat, rows):
    found = {r["key"]: r for r in rows(flat, "key")}
    first = found["T-1"]
    assert (first["labels"], first["components"], first["comment_count"]) == ("x, y", "c1, ", 2)
    assert (first["last_comment"], first["last_comment_user"]) == (BODY_TEXT, "last")
    assert first["url"] == BASE + "/browse/T-1" and first["status_category"] == "To Do"
    assert [found[k]["assignee"] for k in ("T-2", "T-4", "T-5")] == ["Unassigned"] * 3
    assert (found["T-2"]["last_comment"], found["T-4"]["last_comment"]) == ("", "")
    assert (found["T-4"]["comment_count"], found["T-4"]["last_comment_user"]) == (1, "")
    assert (found["T-3"]["reporter"], found["T-3"]["components"], found["T-5"]["resolution"]) == ("", "", "Fixed")


def test_sla(flat, rows):
    names = [tic.sla_column("First response", m) for m in tic.SLA_METRICS]
    found = {r["key"]: tuple(r[n] for n in names) for r in rows(flat, "key")}
    assert found == {
        "T-1": (True, "-1h", "1h"),
        "T-2": (False, "", "3h"),  # empty ongoing cycle: last completed, no remaining time
        "T-3": (None, "", ""),
        "T-4": (None, "", ""),
        "T-5": (None, "", ""),
        "T-6": (None, "", ""),
    }


def test_document_text_of_other_values(spark):
    bodies = [(None,), ("",), ("no json",), ("[1]",), (json.dumps(text("leaf")),), ('{"type":"doc"}',)]
    df = spark.createDataFrame(bodies, "b string").coalesce(1)
    found = [r["t"] for r in df.select(tic.document_text(F.col("b")).alias("t")).collect()]
    assert found == ["", "", "", "", "leaf", ""]


@pytest.mark.parametrize("depth", [1500, 200_000])
def test_document_text_of_a_deep_tree(spark, depth):
    opened, closed = '{"type":"panel","content":[' * depth, "]}" * depth
    bodies = [opened + json.dumps(text("leaf")) + closed, opened + json.dumps(text("leaf")) + closed[:-1], opened + closed + "x"]
    df = spark.createDataFrame([(b, i) for i, b in enumerate(bodies)], "b string, i int")
    found = df.select("i", tic.document_text(F.col("b")).alias("t")).collect()
    assert [r["t"] for r in sorted(found)] == ["leaf", "", ""]


_JSON = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats() | st.text(),
    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=3), x, max_size=4),
)


@given(_JSON, st.integers(0, 60), st.sampled_from(["", " ", ",", "]", "}", '"', ":", "1", "\\", "nul", "\n"]), st.integers(1, 4))
def test_documents_read_in_pieces_are_what_the_standard_reader_gives(value, at, change, levels):
    """Trees deeper than ``levels`` are read piece by piece, valid or not."""
    parse, _ = tic._document_reader(levels)
    raw = json.dumps([{"a": [value, 0.05e3, "\\\"]{"]}, value])
    for body in (raw, raw[:at] + change + raw[at:], raw[:at], raw[:at] + raw[at + 1 :]):
        try:
            wanted = repr(json.loads(body))
        except ValueError:
            with pytest.raises(ValueError):
                parse(body)
        else:
            assert repr(parse(body)) == wanted


def test_deep_documents_are_read_by_the_standard_parser():
    """Levels are not walked one at a time in Python: reading 20,000 of them takes few calls."""
    body = '{"type":"panel","content":[' * 20_000 + json.dumps(text("leaf")) + "]}" * 20_000
    parse, text_of = tic._document_reader()
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        parse(body)
    finally:
        sys.setprofile(None)
    assert calls < 20_000 and text_of(body) == "leaf"


@given(_JSON, st.integers(0, 60), st.sampled_from(["", " ", ",", "]", "}", '"', ":", "1", "\\", "nul", "\n"]), st.booleans())
def test_the_reader_without_recursion_gives_what_the_standard_one_gives(value, at, change, ascii_only):
    parse, _ = tic._document_reader()
    raw = json.dumps(value, ensure_ascii=ascii_only, indent=at % 3 or None)
    for body in (raw, raw[:at] + change + raw[at:], raw[:at], raw[:at] + raw[at + 1 :]):
        try:
            wanted = repr(json.loads(body))
        except ValueError:
            with pytest.raises(ValueError):
                parse(body)
        else:
            assert repr(parse(body)) == wanted


def test_features(features, rows):
    found = {r["key"]: r for r in rows(features, "key")}
    assert found["T-1"]["created"] == datetime(2024, 6, 1, 12)
    assert (found["T-1"]["age_days"], found["T-6"]["age_days"]) == (30, -1)
    assert (found["T-3"]["month"], found["T-3"]["resolution_days"]) == ("2024-07", 0)
    assert found["T-3"]["week"] == "2024-07-01/2024-07-07"
    assert (found["T-4"]["month"], found["T-4"]["resolution_days"]) == ("2024-01", 60)
    assert [found[k]["is_open"] for k in ("T-1", "T-3", "T-5", "T-6")] == [True, False, False, True]


def test_features_do_not_depend_on_the_session_zone(spark, flat, features, rows):
    by_utc = rows(features.select("key", "created", "age_days", "month"), "key")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        again = tic.ticket_features(flat, AS_OF).select("key", "created", "age_days", "month")
        assert rows(again, "key") == by_utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_summary_reports(features, rows):
    kpis = {r["metric"]: r["value"] and float(r["value"]) for r in rows(tic.ticket_kpis(features), "metric")}
    assert kpis == {
        "Total issues": 6.0, "Open": 3.0, "Closed / Done": 3.0,
        "Avg age open (days)": 19.3, "Avg resolution (days)": 30.0,
    }
    none = {r["metric"]: r["value"] for r in rows(tic.ticket_kpis(features.where("key = 'T-5'")), "metric")}
    assert none["Avg age open (days)"] is None and none["Avg resolution (days)"] is None
    by_priority = tic.count_by(features, "priority")
    assert {r["priority"]: r["count"] for r in rows(by_priority, "priority")} == {"Blocker": 1, "High": 5}
    assert [(r["priority"], r["ordinal"]) for r in rows(tic.ordered_priority(by_priority), "ordinal")] == [("High", 2)]
    monthly = rows(tic.monthly_volume(features), "month")
    assert [(r["month"], r["issues"], r["cumulative"]) for r in monthly] == [
        ("2024-01", 1, 1), ("2024-06", 3, 4), ("2024-07", 2, 6),
    ]
    labels = sorted({r.status_category for r in features.select("status_category").collect()})
    matrix = tic.month_category_matrix(features, labels).select("month", "To Do", "Done")
    with pytest.raises(Exception, match="label outside the matrix"):
        tic.month_category_matrix(features, ["To Do"]).collect()
    assert rows(matrix, "month")[1] == {"month": "2024-06", "To Do": 2, "Done": 0}
    turned = transpose(matrix.where("month > '2024-01'"), "month", "category", ["2024-06", "2024-07"])
    assert rows(turned, "category") == [
        {"category": "Done", "2024-06": 0, "2024-07": 1},
        {"category": "To Do", "2024-06": 2, "2024-07": 0},
    ]


def test_people(features, rows):
    workload = {r["assignee"]: r for r in rows(tic.assignee_workload(features), "assignee")}
    assert workload["Ann"] == {"assignee": "Ann", "closed": 0, "open": 1, "total": 1}
    assert (workload["Unassigned"]["closed"], workload["Unassigned"]["open"]) == (3, 2)
    top = tic.top_reporters(features, 2).collect()
    assert [(r["reporter"], r["total"], r["open"], r["email"]) for r in top] == [
        ("", 4, 1, ""), ("Rob", 2, 2, "new@x"),
    ]


def test_aging(features, rows):
    assert rows(tic.aging_buckets(features), "age_bucket") == [
        {"age_bucket": "14-29d", "count": 1},
        {"age_bucket": "30-59d", "count": 1},
    ]
    wide = rows(tic.aging_by_assignee(features), "assignee")
    assert [r["assignee"] for r in wide] == ["Ann", "Unassigned"]
    assert (wide[0]["30-59d"], wide[0]["0d"]) == (1, 0)
    assert [r["key"] for r in tic.oldest_open(features, 2).collect()] == ["T-1", "T-2"]


def days(spark, values):
    df = spark.createDataFrame([(v, "t") for v in values], "resolution_days int, issuetype string")
    return df


def test_resolution(spark, rows):
    stats = rows(tic.resolution_stats(days(spark, [1, 2, 3, 10, None])), "count")[0]
    assert {k: float(v) for k, v in stats.items()} == {
        "count": 4, "mean": 4.0, "std": 4.1, "min": 1.0, "p25": 1.8, "p50": 2.5, "p75": 4.8, "max": 10.0,
    }
    bins = rows(tic.resolution_histogram(days(spark, [0, 0, 1, 2, 59, 60, 500, None])), "bin")
    assert len(bins) == 30 and sum(r["issues"] for r in bins) == 7
    assert (bins[0]["issues"], bins[1]["issues"], bins[29]["issues"]) == (3, 1, 3)
    assert (bins[29]["from_days"], bins[29]["to_days"]) == (58.0, 60.0)
    single = rows(tic.resolution_histogram(days(spark, [4, 4])), "bin")
    assert single[15]["issues"] == 2 and (single[0]["from_days"], single[29]["to_days"]) == (3.5, 4.5)
    assert rows(tic.resolution_histogram(days(spark, [None])), "bin") == []
    assert rows(tic.median_resolution_by_type(days(spark, [1, 4, None])), "issuetype")[0]["median_days"] == 2.5


def test_no_open_tickets_at_all(features, rows):
    closed = features.where(~F.col("is_open"))
    assert rows(tic.aging_buckets(closed), "age_bucket") == []
    assert {r["open"] for r in rows(tic.assignee_workload(closed), "assignee")} == {0}


def test_last_comment_of_a_long_table(spark, rows):
    turns = spark.createDataFrame(
        [(1, 2, "b", "u2"), (1, 1, "a", "u1"), (2, 1, None, "u3")],
        "t int, n int, body string, who string",
    )
    assert [tuple(r.values()) for r in rows(tic.last_comment_of(turns, "t", "n", "body", "who"), "t")] == [
        (1, 2, "b", "u2"), (2, 1, "", "u3"),
    ]


def test_export_and_bundle(spark, features, tmp_path, rows):
    names = ["First response"]
    sheets = {
        "All Issues": tic.ticket_export(features, names),
        "Open Issues": tic.ticket_export(features, names, open_only=True),
        "Summary": tic.ticket_kpis(features),
    }
    assert sheets["All Issues"].columns == [
        *tic.EXPORT_COLUMNS, *[tic.sla_column("First response", m) for m in tic.SLA_METRICS], "url",
    ]
    paths = report_bundle(sheets, str(tmp_path / "run"), fmt="csv")
    written = spark.read.option("header", True).option("multiLine", True).csv(paths["Open Issues"])
    assert {r["key"]: r["created"] for r in written.collect()} == {
        "T-1": "2024-06-01 12:00", "T-2": "2024-06-02 12:00", "T-6": "2024-07-02 12:00",
    }
    stored = report_bundle({"Summary": sheets["Summary"]}, str(tmp_path / "parquet"))
    assert rows(spark.read.parquet(stored["Summary"]), "metric") == rows(sheets["Summary"], "metric")


def test_pages_may_span_lines_and_sla_fields_may_be_absent(spark, landed, rows):
    tickets = read_tickets(spark, str(landed / "page.json"), multi_line=True)
    flat = tic.flatten_tickets(tickets, BASE)
    assert [r["key"] for r in rows(flat, "key")] == ["T-1", "T-2", "T-3", "T-4"]
    assert not [c for c in flat.columns if "—" in c]


def test_no_document_ends_a_job(spark):
    good = json.dumps({"type": "paragraph", "content": [{"type": "text", "text": "fine"}]})
    bad = [
        '{"content":[' * 200_000 + "]}" * 200_000,
        '{"type":"paragraph","content":5}',
        '{"type":"paragraph","content":[{"type":"text","text":5},{"type":"text","text":"x"}]}',
        '{"type":["p"],"content":[3,"a",null,[]]}',
        '{"broken',
        "7",
        None,
    ]
    df = spark.createDataFrame(list(enumerate([good, *bad, good])), "n int, body string").coalesce(1)
    found = [r[0] for r in df.select(tic.document_text(F.col("body")).alias("t"), "n").orderBy("n").collect()]
    assert found == ["fine", "", "", "x", "", "", "", "", "fine"]


def test_reporters_take_the_newest_mail_there_is(spark):
    rows = [("Ann", "k1", "a@old", 1), ("Ann", "k2", "a@new", 2), ("Ann", "k3", None, 3), ("Bob", "k4", None, 1), ("Cy", "k5", "c", None)]
    df = spark.createDataFrame(rows, "reporter string, key string, reporter_email string, day int").selectExpr(
        "reporter", "key", "reporter_email", "true AS is_open",
        "CAST(date_add(DATE '2024-01-01', day) AS TIMESTAMP_NTZ) AS created",
    )
    found = {r.reporter: (r.total, r.email) for r in tic.top_reporters(df).collect()}
    assert found == {"Ann": (3, "a@new"), "Bob": (1, None), "Cy": (1, "c")}
    assert "SortAggregate" not in tic.top_reporters(df)._jdf.queryExecution().executedPlan().toString()


def test_last_comment_of_ties_and_gaps(spark):
    rows = [(1, 1, "a", "u"), (1, 2, "c", "v"), (1, 2, "b", "w"), (2, None, "x", "u"), (None, 1, "n", "u")]
    df = spark.createDataFrame(rows, "t int, turn int, text string, who string")
    last = tic.last_comment_of(df, "t", "turn", "text", "who")
    found = {r.t: (r.comment_count, r.last_comment, r.last_comment_user) for r in last.collect()}
    assert found == {1: (3, "b", "w"), 2: (1, "", ""), None: (1, "n", "u")}
    assert "SortAggregate" not in last._jdf.queryExecution().executedPlan().toString()
