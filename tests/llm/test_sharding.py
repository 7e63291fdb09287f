import random
import zlib
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abacist.llm import sharding


@pytest.fixture(scope="module")
def rows(prose):
    texts = prose(6, 500, 1, 80)
    found = [(i, t, "en" if i % 3 else "de", f"src{i % 7}") for i, t in enumerate(texts)]
    found += [(1000 + i, "hot text", "en", "src0") for i in range(400)]
    return found + [(2000, None, None, None), (2001, "", "", ""), (None, "ä", "en", "src1"), (5, texts[5], "en", "src5"), (2002, "x" * 200_000, "fr", "src1")]


def frame(spark, rows):
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, lang string, source string, shard int")
    return df.repartition(4)


def test_law_of_rows(spark, rows):
    for shards in (1, 7, 40):
        df = sharding.hilbert_shards(frame(spark, rows), ["lang", "source", "size"], shards, least_slice=50)
        found = df.collect()
        assert len(found) == len(rows)
        per = Counter(r.shard for r in found)
        assert set(per) == set(range(shards)) and max(per.values()) - min(per.values()) <= 1
        for shard, n in per.items():
            assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
        order = sorted(found, key=lambda r: (r.shard, r.slot))
        assert [r.cell for r in order] == sorted(r.cell for r in order)
        want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "rows", None) for i, t, _, _ in rows)
        assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in found) == want
        again = {(r.doc_id, r.text_crc32): r for r in df.collect()}
        assert all((r.doc_id == 5) or again[r.doc_id, r.text_crc32] == r for r in found)


def test_fewer_rows_than_shards_and_none(spark, rows):
    few = sharding.hilbert_shards(frame(spark, rows[:3]), ["lang"], 40).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0] and len({r.shard for r in few}) == 3
    assert sharding.hilbert_shards(frame(spark, rows).where("false"), ["lang", "size"], 40).collect() == []


@pytest.mark.parametrize("axes,bits", [(2, 3), (3, 3), (2, 1), (4, 2)])
def test_curve_visits_every_cell_by_steps_of_one(spark, axes, bits):
    side = 1 << bits
    cells = spark.range(side**axes)
    names = [f"a{i}" for i in range(axes)]
    cells = cells.selectExpr(*[f"cast((id div {side**i}) % {side} as int) as a{i}" for i in range(axes)])
    found = sharding.hilbert(cells, names, bits, "at").orderBy("at").collect()
    assert [r["at"] for r in found] == list(range(side**axes))
    for a, b in zip(found, found[1:]):
        assert sum(abs(a[n] - b[n]) for n in names) == 1


def test_files_can_be_pruned(spark, rows, tmp_path):
    df = frame(spark, rows)
    placed = sharding.hilbert_shards(df, ["lang", "source", "size"], 8)
    sharding.write_shards(df, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows)
    per = Counter((r.shard, r.lang) for r in back.select("shard", "lang").collect())
    assert len({s for s, lang in per if lang == "de"}) < 8


def cells_of(spark, values, kind, **options):
    """Cell of every value where it is the only dimension: its level."""
    df = spark.createDataFrame(list(enumerate(values)), f"doc_id long, d {kind}").withColumn("text", F.lit("x")).repartition(3)
    found = sharding.hilbert_shards(df, ["d"], 4, **options).collect()
    return [r.cell for r in sorted(found, key=lambda r: r.doc_id)]


@pytest.mark.parametrize(
    "kind,values",
    [
        ("string", [f"https://source-{i % 16:04d}/same/start" for i in range(400)]),
        ("double", [i % 40 / 100 for i in range(400)]),
        ("decimal(9,3)", [Decimal(i % 40) / 1000 for i in range(400)]),
        ("date", [date(2026, 1, 1) + timedelta(days=i % 40) for i in range(400)]),
        ("timestamp", [datetime(2026, 1, 1) + timedelta(seconds=i % 40) for i in range(400)]),
        ("boolean", [bool(i % 2) for i in range(400)]),
        ("int", [i % 3 for i in range(400)]),
    ],
)
def test_levels_follow_the_order_of_the_values(spark, kind, values):
    cells = cells_of(spark, [*values, None], kind)
    assert cells.pop() == 0
    level = {}
    for value, cell in zip(values, cells):
        assert level.setdefault(value, cell) == cell  # one level per value
    ordered = [level[v] for v in sorted(level)]
    assert ordered == sorted(ordered) and max(ordered) < 32
    assert len(set(ordered)) >= min(len(level), 16)


def test_levels_of_text_equal_the_definition(spark):
    """Weighted quantiles by hand: level n begins with the first value at which n parts of 32 are reached."""
    rng = random.Random(4)
    values = [f"common-{rng.choice('abcdefghij') * rng.randint(1, 6)}" for _ in range(700)] + ["common-hot"] * 300
    counts, upto, reached = Counter(values), 0, {}
    for value in sorted(counts):
        upto += counts[value]
        reached.setdefault(upto * 32 // len(values), value)
    cuts = sorted(reached.values())[:31]
    assert cells_of(spark, values, "string") == [sum(c <= v for c in cuts) for v in values]


def test_levels_by_a_sample(spark):
    values = [f"s{i % 50:02d}" for i in range(3000)]
    cells = cells_of(spark, values, "string", sample=500)
    level = dict(zip(values, cells))
    ordered = [level[v] for v in sorted(level)]
    assert ordered == sorted(ordered) and len(set(ordered)) > 20


def test_levels_of_text_count_every_row(spark):
    """Levels of more rows than the sample of 100,000 had: each of 64 values fills half a level, in each of all rows."""
    df = spark.range(128_000).selectExpr("id as doc_id", "'x' as text", "format_string('v%02d', id % 64) as d")
    found = sharding.hilbert_shards(df, ["d"], 4).select("doc_id", "cell").groupBy((F.col("doc_id") % 64).alias("v"), "cell").count()
    cells = {r["v"]: r["cell"] for r in found.collect()}
    assert len(cells) == found.count() == 64
    # level n begins with the first value at which n of 32 parts are reached; the first value reaches none
    assert [cells[v] for v in range(64)] == [min((v + 1) // 2 + 1, 31) for v in range(64)]


def test_no_python_in_the_plan(spark, rows):
    plan = sharding.hilbert_shards(frame(spark, rows), ["lang", "size"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
