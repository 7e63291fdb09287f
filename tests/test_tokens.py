from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal as D

import pytest

from abacist import TokenTables
from abacist.functions import standard_error
from abacist.operators import tokens as tok


@pytest.fixture(scope="module")
def tables(spark):
    june, july = datetime(2026, 6, 30, 23, 59), datetime(2026, 7, 1)
    usage = [
        (1, 10, june, 1_000_000, 100_000, 1_100_000, 2.0, "m1"),
        (2, 10, july, 1_000_000, 0, 1_000_000, 4.0, "m1"),
        (3, 10, july, 0, 0, 0, None, "m2"),  # no time
        (4, 11, july, 1, 1, 2, 10.0, "m2"),
        (5, 12, july, 0, 7, 7, 10.0, "m2"),  # other client, no prompt tokens
        (6, 99, july, 5, 5, 10, 99.0, "m1"),  # record without a row
    ]
    return TokenTables(
        usage=spark.createDataFrame(
            usage,
            "usage_id bigint, record_id bigint, invoked_at timestamp, prompt_tokens bigint, "
            "completion_tokens bigint, total_tokens bigint, elapsed_time_seconds double, "
            "model_name string",
        ),
        record=spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "record_id bigint, client_id bigint"),
        client=spark.createDataFrame([(1, "North"), (2, "South")], "client_id bigint, name string"),
    )


def test_cost_by_client_and_month(tables, rows):
    found = rows(tok.llm_cost_by_client_month(tables), "client_name", "month")
    assert [(r["client_name"], r["month"].month, r["records_processed"], r["llm_calls"]) for r in found] == [
        ("North", 6, 1, 1),
        ("North", 7, 2, 3),
        ("South", 7, 1, 1),
    ]
    assert found[0]["total_cost_eur"] == D("2.9420") and found[2]["total_cost_eur"] == D("0.0001")


def test_latency_ignores_missing_times(tables, rows):
    found = {r["client_name"]: r for r in rows(tok.llm_latency_by_client(tables), "client_name")}
    north = found["North"]  # 2, 4, 10
    assert (north["records_processed"], north["avg_elapsed_sec"]) == (2, D("5.33"))
    assert (north["min_elapsed_sec"], north["max_elapsed_sec"]) == (D("2.00"), D("10.00"))
    assert north["p95_elapsed_sec"] == D("9.40")
    assert rows(tok.llm_latency_by_client(tables, exact=False), "client_name")[0]["p95_elapsed_sec"] == D("10.00")


def test_ratios(tables, rows):
    efficiency = {r["client_name"]: r for r in rows(tok.token_efficiency(tables), "client_name")}
    assert efficiency["North"]["completion_pct"] == D("5.00")
    assert efficiency["South"]["completion_pct"] is None
    calls = {r["client_name"]: r for r in rows(tok.calls_per_record(tables), "client_name")}
    assert (calls["North"]["records"], calls["North"]["calls_per_record"]) == (2, D("2.00"))


def test_models_days_and_trend_include_unknown_records(tables, rows):
    models = rows(tok.model_usage_monthly(tables), "month", "model_name")
    assert [(r["month"].month, r["model_name"], r["llm_calls"]) for r in models] == [
        (6, "m1", 1), (7, "m1", 2), (7, "m2", 3),
    ]
    assert models[2]["avg_elapsed_sec"] == D("10.00")
    days = rows(tok.llm_daily_volume(tables), "day")
    assert (days[1]["day"], days[1]["records_processed"], days[1]["llm_calls"]) == (date(2026, 7, 1), 4, 5)
    trend = rows(tok.llm_cost_trend(tables), "month")
    assert trend[1]["cumulative_cost_eur"] == trend[0]["cost_eur"] + trend[1]["cost_eur"]


def test_slowest_calls_put_missing_times_last_and_break_ties_by_id(tables):
    slow = [r["record_id"] for r in tok.slowest_calls(tables, 2).collect()]
    assert slow == [11, 12]
    everything = [r["elapsed_time_seconds"] for r in tok.slowest_calls(tables, 50).collect()]
    assert everything == [10.0, 10.0, 4.0, 2.0, None]


def test_stored_grain_gives_the_same_reports(spark, tables, rows, tmp_path):
    """Few records: sketches are exact, and so every report is the same."""
    path = str(tmp_path / "grain")
    tok.token_grain(tables).write.parquet(path)
    stored = replace(tables, usage=None, grain=spark.read.parquet(path))
    flagged = replace(tables, distinct_lg_k=12)
    for report in (
        tok.llm_cost_by_client_month, tok.token_efficiency, tok.calls_per_record,
        tok.model_usage_monthly, tok.llm_daily_volume, tok.llm_cost_trend,
    ):
        wanted = sorted(map(str, report(tables).collect()))
        assert sorted(map(str, report(stored).collect())) == wanted, report.__name__
        assert sorted(map(str, report(flagged).collect())) == wanted, report.__name__


@pytest.mark.parametrize("lg_k", [8, 12, 14])
def test_sketches_of_days_and_models_unite_within_the_error(spark, lg_k):
    """Records that return on many days and in several models count once per month and client."""
    usage = spark.range(240_000).selectExpr(
        "id AS usage_id", "id * 7919 % 30000 AS record_id", "timestamp_seconds(1767225600 + id * 20) AS invoked_at",
        "1L AS prompt_tokens", "2L AS completion_tokens", "3L AS total_tokens", "1.5D AS elapsed_time_seconds",
        "concat('m', id % 5) AS model_name",
    )
    t = TokenTables(
        usage=usage,
        record=spark.range(29_000).selectExpr("id AS record_id", "id % 3 AS client_id"),
        client=spark.sql("SELECT * FROM VALUES (0L, 'A'), (1L, 'B'), (2L, 'B') AS t(client_id, name)"),
    )
    grain = tok.token_grain(t, lg_k)
    for report, key, count in (
        (tok.llm_cost_by_client_month, ("client_name", "month"), "records_processed"),
        (tok.calls_per_record, ("client_name",), "records"),
        (tok.llm_daily_volume, ("day",), "records_processed"),
    ):
        exact = {tuple(r[k] for k in key): r for r in report(t).collect()}
        for other in (replace(t, grain=grain), replace(t, distinct_lg_k=lg_k)):
            found = {tuple(r[k] for k in key): r for r in report(other).collect()}
            assert found.keys() == exact.keys()
            for k, r in found.items():
                assert r["llm_calls"] == exact[k]["llm_calls"]
                assert abs(r[count] - exact[k][count]) <= 4 * standard_error(lg_k) * exact[k][count] + 1, (k, lg_k)


def test_distinct_counts_are_exact_unless_asked(spark, tables):
    plan = tok.llm_daily_volume(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "hll" not in plan.lower() and tables.distinct_lg_k is None
