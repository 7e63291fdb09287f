import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from abacist.functions import grouped_quantiles, merged_sketch, sketch


def exact(values, p):
    values, p = sorted(values), Fraction(p)
    position = p * (len(values) - 1)
    low = int(position)
    high = values[min(low + 1, len(values) - 1)]
    return float(values[low] + (high - values[low]) * float(position - low))


def check(df, data, quantiles, **options):
    found = {
        r["k"]: r for r in grouped_quantiles(df, ["k"], "v", quantiles, **options).collect()
    }
    want = {k: [v for v in vs if v is not None] for k, vs in data.items()}
    assert set(found) == {k for k, vs in want.items() if vs}
    for key, row in found.items():
        for name, p in quantiles.items():
            assert row[name] == pytest.approx(exact(want[key], p), abs=1e-9), (key, name)


QUANTILES = {"low": "0", "p05": "0.05", "median": "0.5", "p95": "0.95", "p999": "0.999", "high": "1"}


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(7)
    return {
        "one": [5.0],
        "two": [1.0, 2.0],
        "none": [None, None],
        None: [3.0, 9.0, 4.0, None],
        "small": [rng.gauss(0, 1) for _ in range(99)],
        "hundred": [rng.gauss(0, 1) for _ in range(100)],
        "thousand": [rng.expovariate(1) for _ in range(1777)],
        "equal": [7.0] * 15_000,
        "mostly_equal": [0.0] * 14_000 + [rng.random() for _ in range(900)],
        # a third of all rows and more in one group, with far outliers
        "hot": [rng.lognormvariate(0, 4) for _ in range(60_000)] + [1e12],
    }


@pytest.mark.parametrize("options", [{"few_groups": True}, {}, {"spread": ["i"], "salt": 3}])
def test_against_sorting(spark, groups, options):
    data = [(k, v, i) for k, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "k string, v double, i int").repartition(7)
    check(df, groups, QUANTILES, **options)


def test_integer_and_decimal_values(spark):
    data = {"a": list(range(0, 40_001, 2)), "b": [3, 3, 3, 8]}
    rows = [(k, v) for k, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v bigint")
    check(df, data, QUANTILES)
    check(df.withColumn("v", F.col("v").cast("decimal(18,6)")), data, QUANTILES, few_groups=True)


def test_plan_joins_by_hash_and_sorts_inside_groups_only(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v"))
    for few in (True, False):
        result = grouped_quantiles(df, ["k"], "v", {"p": "0.5"}, few_groups=few)
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert "SinglePartition" not in plan


def test_infinite_values(spark):
    inf = float("inf")
    data = {"a": [-inf, 1.0, 2.0, 3.0, inf], "b": [-inf, 5.0], "c": [inf] * 20_000 + [1.0] * 20_001, "d": [1.0, inf]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    found = {r.k: (r.lo, r.mid, r.hi) for r in grouped_quantiles(df, ["k"], "v", {"lo": "0", "mid": "0.5", "hi": "1"}).collect()}
    assert found == {"a": (-inf, 2.0, inf), "b": (-inf, -inf, 5.0), "c": (1.0, 1.0, inf), "d": (1.0, inf, inf)}


def test_sketch_from_another_aggregate(spark, groups):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    stats = df.groupBy("k").agg(F.count("*").alias("n"), *sketch("v"))
    check(df, groups, QUANTILES, sketches=stats, bins=16)


def test_merged_sketches(spark, groups):
    """Folded to small parts first, as calls fold to records."""
    rows = [(k, v, i % 211) for k, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, v double, part int").repartition(5)
    parts = df.groupBy("k", "part").agg(*sketch("v", name="x"))
    check(df, groups, QUANTILES, sketches=parts.groupBy("k").agg(*merged_sketch("x")), name="x")


@pytest.mark.parametrize("few", [True, False])
def test_a_bracket_that_misses_its_rank_is_not_the_end(spark, groups, few):
    """A sketch of other values: every bracket is wrong, and the values are found all the same."""
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    wrong = df.groupBy("k").agg(*sketch("v"), *sketch(F.col("v") * 0 - 5, name="far"))
    wrong = wrong.withColumn("_sketch", F.col("_sketch").withField("kll", F.col("_sketchfar.kll")))
    check(df, groups, QUANTILES, sketches=wrong, few_groups=few)


def test_rows_are_read_twice_at_most(spark, tmp_path, groups):
    """Once for the sketch and once for the values; no more while no bracket misses."""
    path = str(tmp_path / "rows")
    spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").write.parquet(path)
    found = grouped_quantiles(spark.read.parquet(path), ["k"], "v", {"p": "0.5"})
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 2, final


def test_values_are_ordered_inside_one_bin_only(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v"))
    plan = grouped_quantiles(df, ["k"], "v", {"p": "0.5"})._jdf.queryExecution().optimizedPlan().toString()
    by_value = [line for line in plan.splitlines() if "Window [" in line and "[_v#" in line]
    assert by_value and all("_bin#" in line.split("[_v#")[0].rpartition("[")[2] for line in by_value)
