import random
from datetime import date
from decimal import Decimal as D

import pytest

from abacist import RecordTables
from abacist.functions import interval_join
from abacist.operators import records as rec


def test_equals_comparing_all(spark):
    rng = random.Random(2)
    points = [(i, rng.choice(["a", "b", None]), rng.choice([None, *(rng.randint(-300, 300) for _ in range(9))])) for i in range(300)]
    ranges = []
    for j in range(120):
        low = rng.choice([None, rng.randint(-300, 300)])
        high = rng.choice([None, (low or 0) + rng.choice([-5, 0, 1, 2, 7, 64, 200])])
        ranges.append((j, rng.choice(["a", "b", None]), low, high))
    p = spark.createDataFrame(points, "i int, k string, x int")
    r = spark.createDataFrame(ranges, "j int, k string, low bigint, high bigint")
    found = sorted((f.i, f.j) for f in interval_join(p, r, ["k"], "x", "low", "high").select("i", "j").collect())
    wanted = sorted(
        (i, j) for i, k, x in points for j, g, low, high in ranges
        if x is not None and k == g and (low is None or low <= x) and (high is None or x < high)
    )
    assert found == wanted and len(found) > 500
    semi = {f.i for f in interval_join(p, r, ["k"], "x", "low", "high", "left_semi").collect()}
    assert semi == {i for i, _ in wanted}


def test_no_nested_loop(spark):
    p, r = spark.range(100).selectExpr("id AS x", "1 AS k"), spark.range(9).selectExpr("id AS low", "id + 3 AS high", "1 AS k")
    plan = interval_join(p, r, ["k"], "x", "low", "high")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_intervals(spark):
    p = spark.range(5).selectExpr("id AS x", "1 AS k")
    r = spark.createDataFrame([], "low bigint, high bigint, k int")
    assert interval_join(p, r, ["k"], "x", "low", "high").collect() == []


@pytest.fixture(scope="module")
def tables(spark):
    def many(client, month, n):
        return f"SELECT {client} AS client_id, DATE '2026-{month:02d}-15' AS day FROM range({n})"

    rows = spark.sql(" UNION ALL ".join([many(1, 1, 10), many(1, 3, 700), many(2, 1, 600), many(2, 3, 600), many(1, 7, 3)]))
    record = rows.selectExpr(
        "monotonically_increasing_id() AS record_id", "client_id", "1L AS job_harvest_id", "18 AS state_id",
        "CAST(day AS timestamp_ntz) AS created_at", "false AS is_deleted",
    )
    client = spark.sql("SELECT * FROM VALUES (1, 'A'), (2, 'B') AS t(client_id, name)")
    return RecordTables(record=record, client=client)


def test_lists_change_and_a_clients_own_one_counts(spark, tables, rows):
    prices = spark.createDataFrame(
        [
            (None, date(2026, 1, 1), date(2026, 3, 1), 0, 500, D(10), D(100)),
            (None, date(2026, 1, 1), date(2026, 3, 1), 500, None, D(8), D(100)),
            (None, date(2026, 3, 1), date(2026, 7, 1), 0, None, D(5), D(0)),
            ("B", date(2026, 3, 1), None, 0, 100, D(2), D(50)),
            ("B", date(2026, 3, 1), None, 100, 200, D(1), D(50)),
        ],
        "client_name string, valid_from date, valid_to date, lower bigint, upper bigint, rate decimal(9,2), minimum decimal(9,2)",
    )
    found = rows(rec.dated_revenue(tables, prices), "client_name", "month")
    assert [(r["client_name"], r["month"].month, r["records_created"], r["price_czk"], r["own_list"]) for r in found] == [
        ("A", 1, 10, D("100.00"), False),
        ("A", 3, 700, D("3500.00"), False),
        ("A", 7, 3, None, None),  # no list is valid any more
        ("B", 1, 600, D("5800.00"), False),
        ("B", 3, 600, D("300.00"), True),
    ]
