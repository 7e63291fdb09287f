import random
from decimal import Decimal

import pytest

from abacist.operators.matrix import amount_pareto, pareto


@pytest.fixture(scope="module")
def amounts(spark):
    rng = random.Random(5)
    values = [Decimal(round(rng.lognormvariate(3, 2) * 100)) / 100 for _ in range(4000)]
    values += [Decimal("10.00")] * 700 + [Decimal("0.00")] * 30  # ties
    rng.shuffle(values)
    return spark.createDataFrame(list(enumerate(values)), "k int, v decimal(18,2)").repartition(7)


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_equals_the_window_over_all(amounts, parts):
    wanted = sorted(map(tuple, pareto(amounts, "k", "v").collect()))
    assert sorted(map(tuple, amount_pareto(amounts, "k", "v", parts).collect())) == wanted


def test_no_task_sees_all_volumes(amounts):
    plan = amount_pareto(amounts, "k", "v")._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "SinglePartition" in x or "NestedLoop" in x or "Cartesian" in x]
    assert not any("NestedLoop" in x or "Cartesian" in x for x in lines)
    # what goes into one task has a row per part: it has been grouped by part before
    at = plan.splitlines()
    for i, line in enumerate(at):
        if "Exchange SinglePartition" in line:
            below = next(x for x in at[i + 1 :] if "Aggregate" in x)
            assert "_part" in below or "kll" in below, below


def test_empty_null_and_equal_volumes(spark):
    assert amount_pareto(spark.createDataFrame([], "k int, v decimal(18,2)"), "k", "v").collect() == []
    df = spark.createDataFrame([(1, Decimal(5)), (2, Decimal(5)), (3, None)], "k int, v decimal(18,2)")
    found = {r.k: (r["rank"], r.pct_of_total, r.cumulative_pct) for r in amount_pareto(df, "k", "v").collect()}
    assert found[1] == found[2] == (1, Decimal("50.0"), Decimal("100.0"))
    assert found[3][:2] == (3, None)
