import hashlib
import re

import pytest

from abacist.llm import exact_dedup

LONG = "word  \t" * 40_000


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0d]+", " ", t or "")) for i, t in rows]
    found = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        low = min((j for j in ids if j is not None), default=None)
        found.append((i, low, len(ids), i == low, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(found, key=str)


def answer(df):
    return sorted(map(tuple, exact_dedup.exact_groups(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_groups_match_brute_force(documents, prose):
    texts = prose(1, 60, 1, 4)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, "the same  text\nagain") for i in range(150)] + [(300 + i, "the same text again") for i in range(50)]
    rows += [(400, None), (401, ""), (402, "  "), (403, " "), (404, LONG), (405, LONG + " "), (406, "x" * 300_000)]
    rows += [(7, texts[7]), (7, "other text for a known id"), (None, "the same text again"), (None, "alone"), (None, "alone")]
    rows += [(500, "a b"), (501, "a b"), (502, "a\u000bb"), (503, "a\u001cb")]
    assert answer(documents(rows)) == brute(rows)


def test_hot_text_spans_partitions(spark, documents):
    rows = [(i, "hot" if i % 3 else f"text {i}") for i in range(900)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert answer(documents(rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None)]])
def test_small_tables(documents, rows):
    assert answer(documents(rows)) == brute(rows)


def test_stage_keeps_columns_and_first_rows(documents):
    df = documents([(3, "a b"), (1, "a  b"), (2, "c"), (2, "c"), (None, "c"), (4, None), (5, "")])
    kept = exact_dedup.drop_copies(df)
    assert kept.schema == df.schema
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 4]
