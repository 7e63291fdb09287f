from datetime import date, datetime
from decimal import Decimal as D

import pytest

from abacist import RecordTables
from abacist.operators import records as rec

CLIENTS = [(1, "North"), (2, "South"), (3, "North"), (4, "Giant")]


@pytest.fixture(scope="module")
def tables(spark):
    at = datetime(2026, 4, 10, 12)
    rows = [
        (1, 1, 100, 18, datetime(2026, 4, 1), False, "a"),
        (2, 1, 100, 12, datetime(2026, 4, 30, 23, 59, 59), False, "a"),
        (3, 3, 100, 19, at, False, "b"),  # other client of the same name, same job
        (4, 1, None, 20, at, False, "c"),  # counts as a record, not as a job
        (5, 1, 101, 17, at, False, "c"),  # not billable
        (6, 1, 101, None, at, False, None),  # no state
        (7, 1, 101, 18, at, True, "d"),
        (8, 1, 101, 18, at, None, "e"),  # unknown deletion flag counts as deleted
        (9, 1, 102, 18, datetime(2026, 5, 1), False, "f"),
        (10, 9, 103, 18, at, False, "g"),  # client without a row
        (11, 2, 104, 18, datetime(2026, 3, 31, 23, 59, 59), False, "h"),
    ]
    giant = [(1000 + i, 4, i % 7, 18, at, False, "x") for i in range(5001)]
    return RecordTables(
        record=spark.createDataFrame(
            rows + giant,
            "record_id bigint, client_id bigint, job_harvest_id bigint, state_id int, "
            "created_at timestamp, is_deleted boolean, source_key string",
        ),
        client=spark.createDataFrame(CLIENTS, "client_id bigint, name string"),
    )


def test_invoice(tables, rows):
    found = rows(rec.client_invoice(tables, 2026, 4), "client_name")
    assert [tuple(r.values()) for r in found] == [
        ("Giant", 7, 5001, 2990, True),
        ("North", 1, 4, 2990, False),
        ("ZZ TOTAL", 8, 5005, 5980, True),
    ]
    open_price = rows(rec.client_invoice(tables, 2026, 4, over_cap="null"), "client_name")
    assert (open_price[0]["monthly_price_czk"], open_price[-1]["monthly_price_czk"]) == (None, 2990)


def test_billable_rule_is_a_parameter(tables, rows):
    listed = lambda state: state.isin(12, 18)
    found = rows(rec.client_invoice(tables, 2026, 4, billable=listed), "client_name")
    assert found[1]["records_created"] == 2


def test_growth_and_trend(tables, rows):
    north = [r for r in rows(rec.client_mom_growth(tables), "client_name", "month") if r["client_name"] == "North"]
    assert [(r["month"], r["records_created"], r["records_growth_pct"]) for r in north] == [
        (date(2026, 4, 1), 4, None),
        (date(2026, 5, 1), 1, D("-75.0")),
    ]
    assert north[1]["revenue_growth_pct"] == D("0.0")
    yearly = rows(rec.client_revenue_trend(tables, "year"), "client_name")
    assert {r["month"] for r in yearly} == {date(2026, 1, 1)}


def test_states_and_unbilled(tables, rows):
    states = [r for r in rows(rec.client_state_distribution(tables), "client_name", "state_id") if r["client_name"] == "North"]
    assert [(r["state_id"], r["record_count"]) for r in states] == [
        (12, 1), (17, 1), (18, 2), (19, 1), (20, 1), (None, 1),
    ]
    assert states[2]["pct_of_client"] == D("28.6")
    unbilled = rows(rec.unbilled_records(tables), "client_name", "state_id")
    assert [tuple(r.values()) for r in unbilled] == [("North", 17, 1), ("North", None, 1)]


def test_jobs_days_tiers_and_revenue(tables, rows):
    jobs = {r["client_name"]: r for r in rows(rec.job_efficiency(tables), "client_name")}
    assert (jobs["North"]["jobs_harvested"], jobs["North"]["records_per_job"]) == (2, D("2.5"))
    days = rows(rec.client_daily_volume(tables), "client_name", "day")
    assert ("North", date(2026, 4, 10), 2) in [tuple(r.values()) for r in days]
    tiers = {(r["client_name"], r["month"].month): r["pricing_tier"] for r in rows(rec.tier_distribution(tables), "client_name")}
    assert tiers["Giant", 4] == "5000+ (custom)" and tiers["North", 4] == "0–500 (10 Kč)"
    revenue = rows(rec.ytd_revenue(tables), "month")
    assert [r["cumulative_revenue_czk"] for r in revenue] == [2990, 8970, 11960]
    assert rows(rec.client_pareto(tables), "rank")[0]["client_name"] == "Giant"


def test_own_definitions(tables, rows):
    duplicates = {r["client_name"]: r for r in rows(rec.duplicate_rate(tables, "source_key"), "client_name")}
    assert duplicates["Giant"]["distinct_keys"] == 1 and duplicates["Giant"]["duplicate_pct"] == D("99.98")
    errors = {r["client_name"]: r["error_pct"] for r in rows(rec.error_rate(tables, [17]), "client_name")}
    assert errors == {"Giant": D("0.00"), "North": D("14.29"), "South": D("0.00")}


def test_row_level_base(tables, rows):
    assert len(rows(rec.billable_records(tables), "record_id")) == 5001 + 6


def test_months_above_the_last_tier_are_flagged(spark, rows):


    record = spark.range(5001).selectExpr(
        "id AS record_id", "1L AS client_id", "id AS job_harvest_id", "18 AS state_id",
        "TIMESTAMP '2026-01-05' AS created_at", "false AS is_deleted",
    )
    t = RecordTables(record=record, client=spark.sql("SELECT * FROM VALUES (1L, 'A'), (2L, 'A') AS t(client_id, name)"))
    (line,) = rows(rec.client_revenue_trend(t), "month")
    assert (line["monthly_price_czk"], line["needs_custom_price"]) == (2990, True)
    (line,) = rows(rec.client_mom_growth(t, over_cap="null"), "month")
    assert (line["monthly_price_czk"], line["needs_custom_price"]) == (None, True)
    (line,) = rows(rec.ytd_revenue(t), "month")
    assert (line["monthly_revenue_czk"], line["needs_custom_price"]) == (2990, True)


def test_clients_by_id(spark, rows):


    record = spark.range(10).selectExpr(
        "id AS record_id", "id % 2 + 1 AS client_id", "id AS job_harvest_id", "18 AS state_id",
        "TIMESTAMP '2026-01-05' AS created_at", "false AS is_deleted",
    )
    t = RecordTables(record=record, client=spark.sql("SELECT * FROM VALUES (1L, 'A'), (2L, 'A') AS t(client_id, name)"), by_client_id=True)
    assert [(r["client_id"], r["client_name"], r["records_created"]) for r in rows(rec.client_invoice(t), "client_id")] == [
        (1, "A", 5), (2, "A", 5), (None, rec.TOTAL_LINE, 10),
    ]
    for report in (rec.client_mom_growth, rec.job_efficiency, rec.client_pareto, rec.client_state_distribution):
        assert len(report(t).collect()) == 2


def test_two_reports_on_one_path(spark, tmp_path):
    from abacist.sources.sinks import report_bundle

    with pytest.raises(ValueError):
        report_bundle({"a/b": spark.range(1), "a_b": spark.range(2)}, str(tmp_path))
