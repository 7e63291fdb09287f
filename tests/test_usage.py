"""Usage reports on a hand-made fixture with every awkward row of FIXTURES.md section 1.1."""

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from abacist import Period, Pricing, UsageRules, UsageTables
from abacist.operators import ordering
from abacist.operators import usage as use
from abacist.operators.matrix import pareto

JULY = Period.month(2026, 7)
USERS = [
    ("u1", "Ada", "Low", "ada@x.example", 1),
    ("u2", "Ada", "Low", "ada2@x.example", 2),  # namesake of u1 in another role
    ("u3", "Bo", None, "bo@x.example", 1),  # falls to e-mail
    ("u4", " ", " ", None, None),  # nothing to show, no role
    ("u5", "Tess", "Ter", "t@x.example", 1),  # excluded
    ("u6", "Cy", "Day", "cy@x.example", 9),  # role without a row
]
ROLES = [(1, "buyer"), (2, "seller")]


def ts(text):
    return datetime.fromisoformat(text)


# case_id, user, state, created, queued, modified, items_total, matched %, done %, deleted
CASES = [
    (1, "u1", 5, ts("2026-07-01 00:00:00"), ts("2026-07-01 00:00:10"), ts("2026-07-01 00:01:10"), 3, 50.0, 100.0, False),
    (2, "u2", 4, ts("2026-07-31 23:59:59"), ts("2026-08-01 00:00:09.5"), ts("2026-08-01 00:00:19.5"), 1, 0.0, 10.0, False),
    (3, "u1", 5, ts("2026-08-01 00:00:00"), None, ts("2026-08-02 00:00:00"), 1, 10.0, 20.0, False),
    (4, None, 1, ts("2026-07-10 08:00:00"), None, None, 2, None, None, False),
    (5, "gone", 6, ts("2026-07-11 08:00:00"), ts("2026-07-11 08:00:30"), None, 2, 1.0, 1.0, True),
    (6, "u5", 5, ts("2026-07-12 08:00:00"), ts("2026-07-12 08:00:01"), ts("2026-07-12 08:00:02"), 1, 1.0, 1.0, False),
    (7, "u3", 5, ts("2026-05-03 08:00:00"), ts("2026-05-03 08:00:05"), ts("2026-05-03 08:01:05"), 4, 30.0, 30.0, False),
    (8, "u3", 8, ts("2026-07-03 08:00:00"), ts("2026-07-03 08:00:07"), ts("2026-07-03 08:00:17"), 2, 30.0, 30.0, False),
    (9, "u4", 2, ts("2025-12-31 23:59:59"), None, None, 1, 0.0, 0.0, False),
    (10, "u6", 2, ts("2026-07-20 10:00:00"), None, None, 0, 0.0, 0.0, False),  # no items
]

# item_id, case_id, status, exact dimensions, deleted
ITEMS = [
    (11, 1, 5, True, False),
    (12, 1, 2, False, False),
    (13, 1, 3, True, False),  # unbilled, yet exact
    (21, 2, 4, True, True),
    (31, 3, 5, True, False),
    (41, 4, 2, False, False),
    (42, 4, 1, False, False),
    (51, 5, 5, None, False),
    (52, 5, 5, False, False),
    (61, 6, 5, True, False),
    (71, 7, 5, True, False),
    (72, 7, 5, True, False),
    (73, 7, 2, True, False),
    (74, 7, 4, False, False),
    (81, 8, 3, True, False),
    (82, 8, 5, True, False),
    (91, 9, 4, False, False),
    (99, 77, 5, True, False),  # case does not exist
]
# offer_item_id, item_id, selected, distance
OFFERS = [
    (1101, 11, True, 0.3),
    (1102, 11, False, 0.1),
    (1201, 12, False, 0.5),
    (5101, 51, True, 0.2),
    (5102, 51, True, 0.6),
    (7101, 71, True, 0.25),
    (7201, 72, True, None),
    (7301, 73, True, 0.75),
]
# accessory_id, offer_item_id, selected, quantity
ACCESSORIES = [(1, 1101, True, 2), (2, 1101, False, 9), (3, 1101, True, 3), (4, 5101, False, 1), (5, 7101, None, 4)]


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return UsageTables(
        case=make(
            CASES,
            "case_id bigint, user_id string, state_id int, created_at timestamp, queued_at timestamp, "
            "last_modified timestamp, items_total int, percentage_matched double, "
            "percentage_done double, is_deleted boolean",
        ),
        case_item=make(
            ITEMS,
            "item_id bigint, case_id bigint, status_id int, exact_dimensions_found boolean, "
            "is_deleted boolean",
        ),
        user=make(
            USERS,
            "user_id string, first_name string, last_name string, email string, role_id int",
        ),
        user_role=make(ROLES, "role_id int, role_name string"),
        case_state=make(list(use.CASE_STATES.items()), "state_id int, state_name string"),
        item_status=make(list(use.ITEM_STATUSES.items()), "status_id int, status_name string"),
        offer_item=make(
            OFFERS,
            "offer_item_id bigint, item_id bigint, is_selected boolean, match_distance double",
        ),
        product_accessory=make(
            ACCESSORIES,
            "accessory_id bigint, offer_item_id bigint, is_selected boolean, accessory_quantity int",
        ),
        rules=UsageRules(excluded_users=("u5",)),
    )


def test_summary_of_a_half_open_month(tables, rows):
    found = rows(use.usage_summary(tables, period=JULY), "user_name", "role_name")
    assert [(r["user_name"], r["role_name"], r["cases"], r["billable_items"]) for r in found] == [
        ("(unknown user)", "(none)", 2, 3),  # no user id, and a user id without a row
        ("Ada Low", "buyer", 1, 2),
        ("Ada Low", "seller", 1, 1),
        ("bo@x.example", "buyer", 1, 1),
    ]
    assert found[0]["amount_eur"] == D("0.11") and found[0]["amount_czk"] == D("2.75")


def test_exclusion_list_from_a_table_keeps_cases_without_user(tables, rows, spark):
    listed = spark.createDataFrame([("u5",)], "user_id string")
    other = replace(tables, rules=UsageRules(excluded_users=listed))
    by = ("user_name", "role_name")
    assert rows(use.usage_summary(other), *by) == rows(use.usage_summary(tables), *by)


def test_deleted_rows_can_be_left_out(tables, rows):
    strict = replace(tables, rules=UsageRules(excluded_users=("u5",), include_deleted=False))
    found = rows(use.usage_summary(strict, period=JULY), "user_name")
    assert [(r["user_name"], r["billable_items"]) for r in found] == [
        ("(unknown user)", 1),
        ("Ada Low", 2),
        ("bo@x.example", 1),
    ]


def test_billable_units_is_row_level(tables, rows):
    found = rows(use.billable_units(tables, JULY), "item_id")
    assert [r["item_id"] for r in found] == [11, 12, 21, 41, 51, 52, 82]
    assert {r["role_name"] for r in found} == {"buyer", "seller", "(none)"}


def test_invoice_totals_come_from_the_raw_count(spark, tables, rows):
    summary = use.usage_summary(tables, period=JULY)
    lines = ordering.in_report_order(use.invoice_lines(summary), "invoice_lines").collect()
    assert [r["line_order"] for r in lines] == [0, 0, 0, 0, 1, 2, 3]
    subtotal, fee, total = lines[-3:]
    # 7 units are 0.245, the rounded lines add up to 0.26
    assert sum(r["amount_eur"] for r in lines[:4]) == D("0.26")
    assert (subtotal["amount_eur"], fee["amount_eur"], total["amount_eur"]) == (
        D("0.25"),
        D("650.00"),
        D("650.25"),
    )
    assert (fee["cases"], fee["billable_items"], fee["user_name"]) == (None, None, use.FEE_LINE)
    assert total["amount_czk"] == D("16256.25") and subtotal["cases"] == 5
    many = spark.createDataFrame(
        [("x", "y", 1, 237, D("8.30"), D("207.50"))],
        "user_name string, role_name string, cases bigint, billable_items bigint, "
        "amount_eur decimal(18,2), amount_czk decimal(18,2)",
    )
    assert rows(use.invoice_lines(many), "line_order")[1]["amount_eur"] == D("8.30")


def test_growth_is_against_the_previous_month_present(tables, rows):
    found = [r for r in rows(use.mom_growth(tables), "user_name", "month")]
    bo = [r for r in found if r["user_name"] == "bo@x.example"]
    assert [(r["month"], r["billable_items"], r["items_growth_pct"]) for r in bo] == [
        (date(2026, 5, 1), 4, None),
        (date(2026, 7, 1), 1, D("-75.0")),
    ]
    assert bo[1]["prev_month_amount_eur"] == D("0.14") and bo[1]["revenue_growth_pct"] == D("-71.4")
    dense = [r for r in rows(use.mom_growth(tables, calendar=True), "user_name", "month")]
    bo = [r for r in dense if r["user_name"] == "bo@x.example"]
    assert [r["billable_items"] for r in bo] == [4, 0, 1]
    assert [r["items_growth_pct"] for r in bo] == [None, D("-100.0"), None]


def test_growth_matrix(tables, rows):
    months = Period(date(2025, 12, 1), date(2026, 9, 1)).months()
    found = rows(use.growth_matrix(use.mom_growth(tables), months), "user_name")
    assert list(found[0]) == ["user_name", *months] and len(months) == 9
    with pytest.raises(Exception, match="label outside the matrix: 2025-12"):
        use.growth_matrix(use.mom_growth(tables), months[1:]).collect()
    ada = next(r for r in found if r["user_name"] == "Ada Low")
    assert (ada["2026-07"], ada["2026-08"]) == (None, D("-66.7"))


def test_running_totals(tables, rows):
    found = rows(use.ytd_cumulative(tables, year=2026), "month")
    assert [(r["month"].month, r["billable_items"], r["cumulative_items"]) for r in found] == [
        (5, 4, 4),
        (7, 7, 11),
        (8, 1, 12),
    ]
    assert found[-1]["cumulative_eur"] == D("1950.43")  # 0.14 + 0.25 + 0.04 and three fees
    assert found[-1]["cumulative_czk"] == D("48760.75")
    assert len(rows(use.ytd_cumulative(tables), "month")) == 4


def test_days(tables, rows):
    daily = use.daily_volume(tables, JULY)
    wide = rows(use.daily_matrix(daily, JULY.days()), "user_name")
    ada = next(r for r in wide if r["user_name"] == "Ada Low")
    assert (ada["01"], ada["02"], ada["31"]) == (2, 0, 1) and len(ada) == 32
    occurring = rows(use.daily_matrix(daily), "user_name")
    assert list(occurring[0]) == ["user_name", "01", "03", "10", "11", "31"]


def test_case_sizes_are_weighted_by_case(tables, rows):
    found = {r["user_name"]: r for r in rows(use.batch_efficiency(tables), "user_name")}
    bo = found["bo@x.example"]  # cases of 4 and 1 items
    assert (bo["cases"], bo["billable_items"], bo["smallest_case"], bo["largest_case"]) == (2, 5, 1, 4)
    assert (bo["items_per_case"], bo["median_case_size"], bo["p95_case_size"]) == (
        D("2.5"),
        D("2.5"),
        D("3.9"),  # 3.85
    )


def test_pareto_ties_share_rank_and_cumulative_share(spark, rows):
    volumes = spark.createDataFrame(
        [("a", 5), ("b", 3), ("c", 3), ("d", 1)], "user_name string, billable_items bigint"
    )
    found = rows(pareto(volumes, "user_name", "billable_items"), "rank", "user_name")
    assert [(r["rank"], r["user_name"], r["pct_of_total"], r["cumulative_pct"]) for r in found] == [
        (1, "a", D("41.7"), D("41.7")),
        (2, "b", D("25.0"), D("91.7")),
        (2, "c", D("25.0"), D("91.7")),
        (4, "d", D("8.3"), D("100.0")),
    ]


def test_pareto_of_users_ends_at_everything(tables, rows):
    found = rows(use.usage_pareto(tables), "rank")
    assert found[-1]["cumulative_pct"] == D("100.0")


def test_status_shares(tables, rows):
    found = rows(use.status_distribution(tables, JULY), "user_name", "status_id")
    ada = [r for r in found if r["user_name"] == "Ada Low"]
    assert [(r["status_name"], r["item_count"], r["pct_of_user"], r["is_billable"]) for r in ada] == [
        ("MATCHED", 1, D("25.0"), True),
        ("NOT_MATCHED", 1, D("25.0"), False),
        ("MATCH_NOT_FOUND", 1, D("25.0"), True),
        ("PAIRED", 1, D("25.0"), True),
    ]
    wide = rows(
        use.status_matrix(use.status_distribution(tables, JULY), list(use.ITEM_STATUSES.values())),
        "user_name",
    )
    assert next(r for r in wide if r["user_name"] == "Ada Low")["CREATED"] == 0


def test_quality_rates(tables, rows):
    found = rows(use.match_quality(tables), "user_name", "month")
    bo = [r for r in found if r["user_name"] == "bo@x.example"]
    assert bo[1]["billable_items"] == 1 and bo[1]["not_matched_unbilled"] == 1
    assert bo[1]["exact_dimensions_pct"] == D("200.0")  # unbilled items count as well
    months = ["2026-05", "2026-07"]
    quality = use.match_quality(tables)
    wide = use.quality_matrix(quality.where(F.date_format("month", "yyyy-MM").isin(months)), "pair_rate_pct", months)
    wide = rows(wide, "user_name")
    assert next(r for r in wide if r["user_name"] == "bo@x.example") == {
        "user_name": "bo@x.example",
        "2026-05": D("50.0"),
        "2026-07": D("100.0"),
    }


def test_state_funnel(tables, rows):
    funnel = use.state_funnel(tables)
    july = [r for r in rows(funnel, "month", "state_id") if r["month"] == date(2026, 7, 1)]
    assert [(r["state_name"], r["cases"], r["pct_of_month"], r["is_settled"]) for r in july] == [
        ("OPENED", 1, D("16.7"), False),
        ("PARSED", 1, D("16.7"), False),
        ("FAILED", 1, D("16.7"), True),
        ("PROCESSED", 1, D("16.7"), True),
        ("EXPORTED", 1, D("16.7"), True),
        ("DROPPED", 1, D("16.7"), True),
    ]
    assert july[0]["avg_pct_matched"] is None
    rate = {r["month"]: r["settled_pct"] for r in rows(use.settled_rate(funnel), "month")}
    assert rate[date(2026, 7, 1)] == 100.0 * 4 / 6 and rate[date(2025, 12, 1)] == 0.0
    wide = rows(use.funnel_matrix(funnel, list(use.CASE_STATES.values())), "month")
    shown = {k: v for k, v in wide[-1].items() if v}
    assert shown == {"month": "2026-08", "PROCESSED": 1} and len(wide[-1]) == 9
    with pytest.raises(Exception, match="label outside the matrix"):
        use.funnel_matrix(funnel, ["OPENED", "PROCESSED"]).collect()


def test_latency_skips_unqueued_and_unsettled_cases(tables, rows):
    found = rows(use.stage_latency(tables), "month")
    assert [(r["month"].month, r["cases"]) for r in found] == [(5, 1), (7, 4)]
    july = found[1]  # parse 10, 10.5, 30, 7 seconds; process 60, 10, -, 10 seconds
    assert (july["avg_parse_secs"], july["p50_parse_secs"], july["p95_parse_secs"]) == (
        D("14.4"),
        D("10.3"),
        D("27.1"),
    )
    assert (july["avg_process_secs"], july["p50_process_secs"], july["p95_process_secs"]) == (
        D("26.7"),
        D("10.0"),
        D("55.0"),
    )
    assert july["avg_items_per_case"] == D("2.0")
    sketched = rows(use.stage_latency(tables, exact=False), "month")
    assert sketched[0]["p50_parse_secs"] == D("5.0")


def test_candidate_depth(tables, rows):
    found = {
        (r["user_name"], r["month"].month): r
        for r in rows(use.candidate_depth(tables), "user_name", "month")
    }
    bo = found["bo@x.example", 5]  # items 71 and 73 with a distance, 72 without, 74 no offer
    assert (bo["billable_items"], bo["items_with_no_offer"], bo["items_with_selection"]) == (4, 1, 3)
    assert (bo["avg_offers_per_item"], bo["selection_rate_pct"]) == (D("0.75"), D("75.0"))
    assert (bo["avg_best_distance"], bo["p50_selected_distance"]) == (D("0.5000"), D("0.5000"))
    ada = found["Ada Low", 7]
    assert (ada["avg_best_distance"], ada["avg_selected_distance"]) == (D("0.3000"), D("0.3000"))
    none = found["Ada Low", 8]
    assert none["avg_best_distance"] is None and none["p50_selected_distance"] is None


def test_attach_rate_counts_offers_once(tables, rows):
    found = {r["month"].month: r for r in rows(use.attach_rate(tables), "month")}
    july = found[7]  # offers 1101 (3 accessories), 5101 (1, not selected), 5102 (none)
    assert (july["selected_offers"], july["accessories_offered"], july["accessories_selected"]) == (3, 4, 2)
    assert (july["accessory_qty_selected"], july["offers_with_accessory_pct"]) == (5, D("33.3"))
    may = found[5]
    assert (may["accessories_offered"], may["accessory_qty_selected"]) == (1, None)
    assert may["offers_with_accessory_pct"] == D("0.0")


def test_volume_bands(tables, rows):
    found = rows(use.volume_band(tables, edges=(1, 3), labels=("one", "few", "many")), "month")
    assert {r["volume_band"] for r in found if r["billable_items"] == 4} == {"many"}


def test_trend_and_prices(tables, rows):
    found = rows(use.consumption_trend(tables, Pricing(unit_price=D("0.5"), fx=D("2"))), "month")
    assert found[0]["amount_eur"] == D("0.50") and found[0]["amount_czk"] == D("1.00")


def test_reports_from_a_stored_daily_grain(spark, tables, rows, tmp_path):
    path = str(tmp_path / "grain")
    use.daily_grain(tables).write.parquet(path)
    stored = UsageTables(grain=spark.read.parquet(path))
    for report, by in [
        (lambda t: use.usage_summary(t, period=JULY), ("user_name", "role_name")),
        (use.mom_growth, ("user_name", "month")),
        (use.consumption_trend, ("user_name", "month")),
        (lambda t: use.ytd_cumulative(t, year=2026), ("month",)),
        (lambda t: use.daily_volume(t, JULY), ("user_name", "day")),
        (use.usage_pareto, ("rank", "user_name")),
        (use.volume_band, ("user_name", "month")),
    ]:
        assert rows(report(stored), *by) == rows(report(tables), *by)


def test_every_status_of_the_lookup_is_listed(spark, tables, rows):


    case = spark.sql("SELECT 1 AS case_id, 'u' AS user_id, TIMESTAMP '2026-07-02' AS created_at, false AS is_deleted")
    items = spark.sql("SELECT * FROM VALUES (1, 1, 5, false), (2, 1, 6, false), (3, 1, 99, false) AS t(item_id, case_id, status_id, is_deleted)")
    lookup = spark.sql("SELECT * FROM VALUES (5, 'PAIRED'), (6, 'SPLIT') AS t(status_id, status_name)")
    found = rows(use.status_distribution(replace(tables, case=case, case_item=items, item_status=lookup)), "status_id")
    assert [(r["status_name"], r["item_count"], r["pct_of_user"]) for r in found] == [
        ("PAIRED", 1, D("50.0")), ("SPLIT", 1, D("50.0")),
    ]


def test_calendar_growth_keeps_an_entity_without_name(spark, rows):
    df = spark.sql(
        "SELECT * FROM VALUES (CAST(NULL AS STRING), DATE '2026-01-01', 3L, true), (NULL, DATE '2026-03-01', 6L, NULL) "
        "AS t(who, month, n, flag)"
    )
    found = rows(use.with_growth(df, ["who"], {"n": ("before", "pct")}, calendar=True), "month")
    assert [(r["who"], r["n"], r["flag"], r["before"]) for r in found] == [
        (None, 3, True, None), (None, 0, False, 3), (None, 6, None, 0),
    ]


def test_items_with_the_time_of_their_case_are_pruned(spark, tables, rows):


    timed = tables.case_item.join(tables.case.selectExpr("case_id", "created_at AS case_created_at"), "case_id")
    known = replace(tables, case_item=timed)
    for report in (use.usage_summary, lambda t, p, d: use.status_distribution(t, d), lambda t, p, d: use.daily_volume(t, d)):
        want, found = (report(t, Pricing(), JULY) for t in (tables, known))
        assert sorted(map(str, want.collect())) == sorted(map(str, found.collect()))


def test_days_of_one_month_only():
    assert Period(date(2026, 2, 1), date(2026, 3, 1)).days()[-1] == "28"
    with pytest.raises(ValueError):
        Period(date(2026, 2, 1), date(2026, 4, 1)).days()


def test_namesakes_by_id(spark, tables, rows):


    one_name = tables.user.withColumns({"first_name": F.lit("Al"), "last_name": F.lit("Le")})
    merged = replace(tables, user=one_name)
    apart = replace(merged, rules=replace(tables.rules, by_user_id=True))
    names = rows(use.consumption_trend(merged), "month", "user_name")
    ids = rows(use.consumption_trend(apart), "month", "user_id")
    assert {r["user_id"] for r in ids} > {None} and len(ids) > len(names)
    assert sum(r["billable_items"] for r in ids) == sum(r["billable_items"] for r in names)
    for report in (use.mom_growth, use.usage_pareto, use.batch_efficiency, use.match_quality, use.status_distribution):
        assert "user_id" in report(apart).columns and "user_id" not in report(merged).columns
    lines = rows(use.invoice_lines(use.usage_summary(apart)), "line_order", "user_id")
    assert lines[-1]["user_name"] == use.TOTAL_LINE and lines[-1]["user_id"] is None
