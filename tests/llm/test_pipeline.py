import os

import pytest

import corpus_pipeline
from abacist.llm import decontaminate, exact_dedup, queries, simhash, toxicity
from abacist.llm.byte_bpe import encode
from abacist.sources.tables import read_table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated tables are absent")


def test_stages_on_the_tables(spark):
    docs = read_table(spark, SF_DIR, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).schema == docs.schema
        assert stage(spark, docs.where("false"), SF_DIR).collect() == []


def test_run_equals_the_decisions_one_by_one(spark):
    docs = read_table(spark, SF_DIR, "documents")
    labels, bench = (read_table(spark, SF_DIR, t) for t in ("labels", "benchmark"))
    ids = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 0").select("doc_id").collect()}
    left = lambda: docs.where(docs.doc_id.isin(list(ids)))
    ids = {r.doc_id for r in exact_dedup.exact_groups(left()).where("kept").collect()}
    ids = {r.doc_id for r in simhash.near_groups(left()).where("doc_id = component_id").collect()}
    ids -= {r.doc_id for r in decontaminate.contaminated(left(), bench).collect()}
    want = {(r.doc_id, r.n_tokens) for r in encode(left(), *bpe()).collect()}
    assert {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == want


def bpe():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_twins(spark, name):
    from check_oracle import connect, normalised

    df = queries.QUERIES[name](spark, SF_DIR)
    result = connect(SF_DIR).execute(queries.ORACLE[name])
    columns = [c[0] for c in result.description]
    assert normalised(df.columns, [tuple(r) for r in df.collect()]) == normalised(columns, result.fetchall())


def test_each_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))


def test_odd_rows_through_all_stages(spark, tmp_path, prose):
    """Null ids and texts, repeated rows, a very long text, columns whose names operators use themselves."""
    clean = prose(21, 120, 40, 60)
    bad = [f"{t} grubby rotten foulish person" for t in prose(22, 60, 30, 50)]
    rows = [(i, t) for i, t in enumerate(clean)] + [(1000 + i, t) for i, t in enumerate(bad)]
    labels = [(i, 0, 0) for i in range(110)] + [(1000 + i, 0, 1) for i in range(24)]  # fewer than the threshold are toxic
    passage = " ".join(f"benchmark{i} question" for i in range(12))
    long = "Long story " * 40_000
    near = " ".join(f"uncommon{i}" for i in range(800))
    rows += [(2000, None), (2001, ""), (2002, " "), (None, clean[5]), (None, None), (7, clean[7]), (3000, clean[3])]
    rows += [(4000, near), (4001, near.replace("uncommon400", "other")), (5000, f"{clean[9]} {passage} end"), (6000, long), (6001, long)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int, run string, keep_id int")
    folder = str(tmp_path)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*labels, (None, 1, 1), (9, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    ids = sorted(r.doc_id for r in found if r.doc_id is not None)
    # 2000 is the empty text that stays; blank and null ones, and the null ids' copies, go with it or with theirs
    assert set(ids) == {*range(120), 2000, 4000, 6000} - {i for i in range(120) if clean[i] in clean[:i]}
    assert ids.count(7) == 2  # one document that stands in the table twice
    assert all(r.doc_id is not None for r in found)
