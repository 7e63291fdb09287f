from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from abacist import Period, UsageRules, UsageTables
from abacist.operators import reconcile, usage
from abacist.sources import read_bundle

PERIOD = Period(date(2026, 1, 1), date(2026, 2, 1))


@pytest.fixture(scope="module")
def tables(spark):
    case = spark.sql(
        "SELECT * FROM VALUES (1L, 'a', DATE '2026-01-05', false), (2L, 'b', DATE '2026-01-31', false),"
        " (3L, 'x', DATE '2026-01-06', false), (4L, 'a', DATE '2026-02-01', false), (5L, 'a', DATE '2026-01-07', true),"
        " (6L, NULL, DATE '2026-01-08', false) AS t(case_id, user_id, created_at, is_deleted)"
    )
    item = spark.sql(
        "SELECT id AS item_id, id % 8 AS case_id, CAST(id % 5 + 1 AS INT) AS status_id, id % 11 = 0 AS is_deleted FROM range(200)"
        " UNION ALL SELECT NULL, 1L, 5, false UNION ALL SELECT 500L, 1L, NULL, false UNION ALL SELECT 501L, NULL, 5, false"
    )
    user = spark.sql("SELECT * FROM VALUES ('a', 'Ann', 'Lee', 'a@x', 1), ('b', 'Bo', 'Ray', 'b@x', 2) AS t(user_id, first_name, last_name, email, role_id)")
    role = spark.sql("SELECT * FROM VALUES (1, 'lead') AS t(role_id, role_name)")
    rules = UsageRules(excluded_users=("x",), include_deleted=False)
    return UsageTables(case=case, case_item=item, user=user, user_role=role, rules=rules)


@pytest.mark.parametrize("excluded", ["tuple", "table"])
@pytest.mark.parametrize("period", [None, PERIOD])
def test_the_summary_is_the_same_and_the_counts_add_up(spark, tables, period, excluded):
    if excluded == "table":
        tables = replace(tables, rules=replace(tables.rules, excluded_users=spark.sql("SELECT 'x' AS user_id")))
    found, observed = reconcile.reconciled_summary(tables, period=period)
    wanted = usage.usage_summary(tables, period=period)
    assert sorted(map(str, found.select(wanted.columns).collect())) == sorted(map(str, wanted.collect()))
    counts = observed.check()
    assert counts["scanned"] == 203 and counts["without_id"] == 1 and counts["invoiced"] == counts["billed"] > 0
    assert counts["item_deleted"] == 19 and counts["without_case"] > 0 and counts["excluded"] > 0
    assert (counts["outside_period"] > 0) == (period is not None)


def test_items_are_read_once(spark, tables, tmp_path):
    path = str(tmp_path / "items")
    tables.case_item.write.parquet(path)
    found, _ = reconcile.reconciled_summary(replace(tables, case_item=spark.read.parquet(path)), period=PERIOD)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1


def test_a_loss_keeps_the_invoice_back(tables, tmp_path, monkeypatch):
    root = str(tmp_path)
    counts = reconcile.release_invoice(tables, root, period=PERIOD)
    spark = tables.case.sparkSession
    first = read_bundle(spark, root, verify=True)
    assert set(first) == {"summary", "invoice", "counts"} and first["counts"].count() == len(counts)
    invoice = sorted(map(str, first["invoice"].collect()))

    # users that a join loses or repeats
    inner = lambda df, t, role=False: df.join(t.user.select("user_id"), "user_id").select(
        F.col("user_id").alias("user_name"), F.lit("r").alias("role_name"), *[c for c in df.columns if c != "user_id"]
    )
    with monkeypatch.context() as patched:
        patched.setattr(usage, "with_user", inner)
        with pytest.raises(reconcile.NotReconciled, match="billed, but"):
            reconcile.release_invoice(tables, root, period=PERIOD)
    twice = replace(tables, user=tables.user.union(tables.user))
    with pytest.raises(reconcile.NotReconciled, match="invoiced"):
        reconcile.release_invoice(twice, root, period=PERIOD)
    # a case that stands in its table twice
    cases = replace(tables, case=tables.case.union(tables.case.where("case_id = 1")))
    with pytest.raises(reconcile.NotReconciled, match="billable, but"):
        reconcile.release_invoice(cases, root, period=PERIOD)
    assert sorted(map(str, read_bundle(spark, root)["invoice"].collect())) == invoice
