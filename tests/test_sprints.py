import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from abacist.operators import sprints as spr
from abacist.sources import read_sprint_reports, read_sprints
from abacist.sources.landed import REPORT_SCHEMA

BASE = "https://tracker.example"
SPRINTS = [
    {"id": 1, "name": "Team 1", "startDate": "2026-01-05T00:00:00.000Z", "endDate": "2026-01-19T00:00:00.000Z"},
    {"id": 2, "name": "Team 2", "startDate": "2026-01-19T00:00:00.000Z", "endDate": "2026-02-02T00:00:00.000Z"},
    {"id": 3, "name": "Team 3", "startDate": "2026-02-02T00:00:00.000Z", "endDate": "2026-02-16T00:00:00.000Z"},
    {"id": 4, "name": "Team 4", "startDate": "2026-02-16T00:00:00.000Z", "state": "closed"},
    {"id": 5, "name": "Other", "startDate": "2026-01-05T00:00:00.000Z", "endDate": "2026-01-06T00:00:00.000Z"},
    {"id": 6, "name": "Team 0", "startDate": "2025-12-05T00:00:00.000Z", "endDate": "2025-12-19T00:00:00.000Z"},
]


def issue(key, who=None, summary="s", points=None, **more):
    found = {"key": key, "summary": summary, "status": {"name": "Open"}, "typeName": "Bug", "priorityName": "High"}
    if who is not None:
        found["assigneeName"] = who
    if points is not None:
        found["currentEstimateStatistic"] = {"statFieldValue": {"value": points}}
    return {**found, **more}


REPORTS = [
    {"sprintId": 1, "contents": {
        "completedIssues": [issue("A-1", "Ann", points=3.0)],
        "issuesNotCompletedInCurrentSprint": [
            issue("A-2", "Ann"), issue("A-3", "", assignee="bob"), issue("A-4", typeName="", typeId="7")],
        "puntedIssues": [issue("A-5", "Cid", status=None)],
        "issuesCompletedInAnotherSprint": [issue("A-9", "Ann")]}},
    {"sprintId": 2, "contents": {
        "completedIssues": [],
        "issuesNotCompletedInCurrentSprint": [issue("A-2", "Ann"), issue("A-3", "Ann"), issue("A-7", "Ann", summary=None)]}},
    {"sprintId": 5, "contents": {"completedIssues": [issue("X-1", "Ann")]}},
]


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("sprints")
    (root / "sprints.json").write_text(
        "\n".join(json.dumps({"values": page, "isLast": True}) for page in (SPRINTS[:4], SPRINTS[4:]))
    )
    (root / "reports.json").write_text("\n".join(json.dumps(r) for r in REPORTS))
    return root


@pytest.fixture(scope="module")
def sprints(spark, landed):
    return spr.select_sprints(read_sprints(spark, str(landed / "sprints.json")), 2026, "Team")


@pytest.fixture(scope="module")
def issues(spark, landed, sprints):
    reports = read_sprint_reports(spark, str(landed / "reports.json"))
    return spr.flatten_sprint_reports(reports, sprints, BASE)


NAMES = ["Team 4", "Team 1", "Team 2", "Team 3"]


def test_sprint_selection(spark, landed, sprints, rows):
    # a missing end date sorts first
    assert [r["name"] for r in rows(sprints, "seq")] == NAMES
    last = spr.select_sprints(read_sprints(spark, str(landed / "sprints.json")), last_n=2)
    assert [r["name"] for r in rows(last, "seq")] == ["Team 2", "Team 3"]


def test_flattened_rows(issues, rows):
    found = rows(issues, "sprint_id", "issue_key")
    assert [(r["issue_key"], r["bucket"], r["assignee"]) for r in found] == [
        ("A-1", "completed", "Ann"),
        ("A-2", "not_completed", "Ann"),
        ("A-3", "not_completed", "bob"),
        ("A-4", "not_completed", "Unassigned"),
        ("A-5", "punted", "Cid"),
        ("A-2", "not_completed", "Ann"),
        ("A-3", "not_completed", "Ann"),
        ("A-7", "not_completed", "Ann"),
    ]
    assert found[0] == {
        "sprint_id": 1, "sprint_name": "Team 1", "sprint_end": datetime(2026, 1, 19), "bucket": "completed",
        "issue_key": "A-1", "summary": "s", "assignee": "Ann", "status": "Open", "issue_type": "Bug",
        "priority": "High", "story_points": 3.0, "url": BASE + "/browse/A-1", "relevant": 1,
    }
    assert (found[3]["issue_type"], found[4]["status"], found[1]["story_points"]) == ("7", None, None)


def test_matrix_and_trend(issues, rows):
    carried = spr.carryover_rows(issues)
    wide = spr.carryover_matrix(carried, NAMES, missing=["Team 3"])
    found = {r["assignee"]: r for r in rows(wide, "assignee")}
    assert list(found["Ann"]) == ["assignee", *NAMES, "TOTAL"]
    assert list(found["Ann"].values()) == ["Ann", 0, 1, 3, None, 4]
    assert set(found) == {"Ann", "bob", "Unassigned"}
    punted = spr.carryover_matrix(spr.carryover_rows(issues, count_punted=True), NAMES)
    assert {r["assignee"] for r in rows(punted, "assignee")} == {"Ann", "bob", "Cid", "Unassigned"}
    series = rows(spr.carryover_trend(spr.carryover_matrix(carried, NAMES), NAMES, 2), "assignee", "sprint_name")
    assert [(r["assignee"], r["sprint_name"], r["carried"]) for r in series][:4] == [
        ("Ann", "Team 1", 1), ("Ann", "Team 2", 3), ("Ann", "Team 3", 0), ("Ann", "Team 4", 0),
    ]
    assert {r["assignee"] for r in series} == {"Ann", "Unassigned"}
    elsewhere = rows(spr.carryover_matrix(carried, ["Team 2"]), "assignee")
    assert [r["TOTAL"] for r in elsewhere] == [3, 0, 0]


def test_team_trend(issues, sprints, rows):
    carried = spr.carryover_rows(issues)
    found = rows(spr.team_trend(carried, sprints), "seq")
    assert [(r["sprint_name"], r["carried"]) for r in found] == [
        ("Team 4", 0), ("Team 1", 3), ("Team 2", 3), ("Team 3", 0),
    ]
    assert [r["moving_avg"] for r in found] == [0.0, 1.5, 2.0, 2.0]
    known = rows(spr.team_trend(carried, sprints, reported=issues), "seq")
    assert [r["carried"] for r in known] == [None, 3, 3, None]
    single = sprints.where(F.col("name") == "Team 1")
    assert rows(spr.team_trend(carried, single), "seq")[0]["moving_avg"] is None


def test_drill_down(issues, rows):
    assert [r["issue_key"] for r in rows(spr.tickets_for(issues, "Cid"), "issue_key")] == []
    mine = rows(spr.tickets_for(issues, "Cid", count_punted=True), "issue_key")
    assert [r["issue_key"] for r in mine] == ["A-5"]


def test_repeat_offenders(issues, rows):
    found = rows(spr.repeat_offenders(spr.carryover_rows(issues)), "issue_key")
    # A-3 changed hands, A-7 has no summary
    assert [(r["issue_key"], r["times_carried"], r["sprints"]) for r in found] == [("A-2", 2, "Team 1, Team 2")]


def test_rate(issues, rows):
    edited = issues.withColumn("relevant", F.when(F.col("issue_key") == "A-7", 0).otherwise(1))
    found = rows(spr.carryover_rate(edited, NAMES), "assignee")
    assert [r["assignee"] for r in found] == ["Ann", "bob"]
    assert (found[0]["Team 1"], found[0]["Team 2"], found[0]["Team 3"]) == (0.5, 1.0, None)
    assert "Cid" in [r["assignee"] for r in rows(spr.carryover_rate(edited, NAMES, True), "assignee")]


def test_bucket_counts(issues, rows):
    assert {r["bucket"]: r["issues"] for r in rows(spr.bucket_counts(issues), "bucket")} == {
        "completed": 1, "not_completed": 6, "punted": 1,
    }
    assert len(rows(spr.bucket_counts(issues, per_sprint=True), "bucket")) == 4


def test_rate_lists_whoever_the_matrix_lists(issues, rows):
    carried = spr.carryover_rows(issues)
    for order in (NAMES, NAMES[:1], NAMES[1:2]):
        listed = {r["assignee"] for r in rows(spr.carryover_matrix(carried, order), "assignee")}
        rated = {r["assignee"] for r in rows(spr.carryover_rate(issues, order), "assignee")}
        assert rated == listed - {spr.UNASSIGNED}


def test_sprints_of_any_name(spark, rows):
    names = ["Team 1.5", "a`b", 'q"uote', "x, y", "Team 2"]
    df = spark.createDataFrame([("Ann", n, "not_completed") for n in names[:4]], "assignee string, sprint_name string, bucket string")
    wide = spr.carryover_matrix(df, names, missing=["a`b"])
    cells = wide.first()
    assert list(cells)[1:] == [1, None, 1, 1, 0, 4]
    series = rows(spr.carryover_trend(wide, names[:4], 3), "sprint_name")
    assert {r["sprint_name"]: r["carried"] for r in series} == {"Team 1.5": 1, "a`b": None, 'q"uote': 1, "x, y": 1}


def test_issues_are_not_moved_to_meet_their_sprint(spark, sprints):
    """Sprints are broadcast whatever their estimated size: of the issues no shuffle is planned."""
    reports = spark.createDataFrame([json.dumps(r) for r in REPORTS], "string")
    reports = reports.select(F.from_json("value", REPORT_SCHEMA).alias("r")).select("r.*")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = spr.flatten_sprint_reports(reports, sprints, BASE)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert found.count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
