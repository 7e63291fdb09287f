import random
import zlib
from collections import Counter

import numpy as np
import pytest

from abacist.llm import toxicity as tox

BAD = "grubby rotten foulish".split()


@pytest.fixture(scope="module")
def rows(prose):
    rng = random.Random(4)
    docs, labels = [], []
    for i, text in enumerate(prose(9, 900, 20, 60)):
        bad = rng.random() < 0.15
        words = text.split()
        for _ in range(rng.randint(1, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, int(bad)))
    return docs, labels, {i for i, t in docs if set(t.split()) & set(BAD)}


def test_held_out_accuracy_and_fold(spark, documents, rows):
    docs, labels, bad = rows
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = {r.doc_id: r for r in tox.toxicity(documents(docs), marks).collect()}
    assert len(found) == len(docs)
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    wrong = [i for i in found if found[i].predicted != int(i in bad)]
    assert len(wrong) <= 0.01 * len(docs)
    learned = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    assert all(set(r.evidence) <= learned for r in found.values())


def test_labels_of_held_out_rows_teach_nothing(spark, documents, rows):
    docs, labels, _ = rows
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    scores = [
        {r.doc_id: r.score for r in tox.toxicity(documents(docs), spark.createDataFrame(x, "doc_id long, toxic int")).collect()}
        for x in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_search_equals_brute_force():
    rng = random.Random(1)
    names = [bytes([65 + i]) for i in range(12)]
    examples = []
    for i in range(500):
        found = [(t, rng.randint(1, 5)) for t in rng.sample(names, rng.randint(0, 5))]
        examples.append((i, rng.randint(0, 1), found))
    index = tox.Neighbours(examples, {t: rng.randint(1, 400) for t in names}, 1000, 15, 0.25)
    dense = np.zeros((len(index.ids), len(names)))
    for at, i in enumerate(index.ids):
        which, weights = index.vector(examples[i][2])
        dense[at, which] = weights
    for _ in range(200):
        query = [(t, rng.randint(1, 4)) for t in rng.sample(names, rng.randint(1, 4))]
        which, weights = index.vector(query)
        cosine = dense[:, which] @ weights
        order = np.lexsort((index.ids, -cosine.round(12)))
        order = order[cosine[order] > 0][:15]
        places, scores = index.nearest(which, weights)
        assert places.tolist() == order.tolist()
        assert np.allclose(scores, cosine[order])


def test_odd_rows(spark, documents):
    docs = [(1, "rotten"), (2, None), (3, ""), (None, "rotten"), (4, "x " * 100_000), (1, "rotten")]
    for labels in ([], [(1, 1)], [(1, None), (9, 1)], [(1, 1), (1, 1), (2, 0)]):
        marks = spark.createDataFrame(labels, "doc_id long, toxic int")
        found = tox.toxicity(documents(docs), marks).collect()
        assert len(found) == len(docs)
    assert tox.toxicity(documents([]), marks).collect() == []


def test_stage_drops_what_it_predicts(spark, documents, rows):
    docs, labels, _ = rows
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    df = documents(docs)
    kept = tox.accepted(df, marks)
    assert kept.schema == df.schema
    gone = {r.doc_id for r in tox.toxicity(df, marks).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - gone


def test_copies_of_a_toxic_text_are_one_example(spark, documents, rows):
    docs, labels, bad = rows
    one = next(i for i, y in labels if y and zlib.crc32(str(i).encode()) % 4 != 2)
    text = dict(docs)[one]
    copies = [(10_000 + i, text) for i in range(len(docs) // 2)]  # a third of all rows
    df = documents([*docs, *copies])
    marks = spark.createDataFrame([*labels, *((i, 1) for i, _ in copies)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in tox.toxicity(df, marks).collect()}
    wrong = [i for i, _ in docs if found[i].predicted != int(i in bad)]
    assert len(wrong) <= 0.01 * len(docs)
    assert all(found[i].predicted == 1 for i, _ in copies)
    assert not any(set(r.evidence) & {i for i, _ in copies} - {min(one, 10_000)} for r in found.values())


def test_vectors_hold_all_terms_of_the_examples(spark, documents, prose):
    texts = prose(6, 200, 20, 60)
    # known words in few toxic examples, and clean texts that only their own words tell apart
    texts += [f"{t} plainly{i // 2} wordsof{i // 2} example{i // 2}" for i, t in enumerate(texts[:60])]
    docs = [(i, t) for i, t in enumerate(texts)]
    labels = [(i, int(200 <= i < 204)) for i in range(260)]
    found = {r.doc_id: r for r in tox.toxicity(documents(docs), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    learned = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2}
    assert len({round(r.score, 9) for r in found.values()}) > 100
    for i, r in found.items():
        if 204 <= i and i ^ 1 in learned and i not in learned:
            assert i ^ 1 in r.evidence
        if i in learned:
            assert i in r.evidence


def test_labels_sampled_at_different_rates_stay_calibrated(spark, documents, prose):
    """Few toxic examples are all taken, of the many clean ones a few: clean texts keep low scores."""
    rng = random.Random(8)
    docs, labels = [], []
    for i, text in enumerate(prose(12, 1500, 20, 40)):
        toxic = i % 15 == 0
        docs.append((i, f"{text} {rng.choice(BAD)}" if toxic else text))
        labels.append((i, int(toxic)))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = {r.doc_id: r for r in tox.toxicity(documents(docs), marks, per_class=100).collect()}
    toxic = {i for i, y in labels if y}
    assert sum(found[i].predicted for i in toxic) >= 0.99 * len(toxic)
    clean = [found[i].score for i, _ in docs if i not in toxic]
    assert sum(x >= 0.3 for x in clean) <= 0.01 * len(clean) and np.mean(clean) < 0.12


def test_index_is_filled_some_examples_at_a_time(monkeypatch):
    """The index does not depend on how many examples are put into it at a time."""
    rng = np.random.default_rng(5)
    lengths = rng.integers(0, 30, 200)
    columns = np.concatenate([np.sort(rng.choice(60, n, replace=False)) for n in lengths]).astype(np.int32)
    parts = {
        "names": [b"t%d" % i for i in range(60)], "weight": rng.random(60) + 0.5, "ids": np.arange(200),
        "labels": rng.integers(0, 2, 200), "lengths": lengths, "columns": columns,
        "counts": rng.integers(1, 9, len(columns)).astype(np.int32), "k": 5, "prior_weight": 0.25,
    }
    monkeypatch.setattr(tox, "_COMMON", 10)
    made = []
    for at_a_time in (1, 7, 1000):
        monkeypatch.setattr(tox, "_FILLED", at_a_time)
        made.append(tox._Index(**parts))
    for index in made[1:]:
        for name in ("impact", "table", "most", "listed", "listed_impact", "list_starts"):
            assert (getattr(index, name) == getattr(made[0], name)).all()
    norms = np.bincount(np.repeat(np.arange((lengths > 0).sum()), lengths[lengths > 0]), made[0].impact ** 2)
    assert np.allclose(norms, 1)


def test_terms_of_many_texts_at_once_are_those_of_each():
    """Terms are cut, looked up and counted for all texts of a batch together."""
    names = [b"ab", b"abcdef", b"^abcd", b"*abcde", b"\xc3\xa4", b"x1", b"^\xc3\xa4\xc3\xb6"]
    column = {t: i for i, t in enumerate(names)}
    texts = [b"", b" ab.AB", b"abcdef abcdefg,abcd abcde", b"\t\n", "ä äöx unknown".encode(), b"x1 ", b"ab" * 3]
    columns, counts, cuts = tox._Columns(column).of(texts)
    for at, text in enumerate(texts):
        want = Counter()
        for word in text.translate(tox._WORDS).split():
            terms = [word, *(sign + word[:n] for n, sign in tox._STARTS if len(word) > n)]
            want.update(column[t] for t in terms if t in column)
        here = slice(cuts[at], cuts[at + 1])
        assert list(zip(columns[here].tolist(), counts[here].tolist())) == sorted(want.items())
    assert [len(x) for x in tox._Columns(column).of([])] == [0, 0, 1]
    assert [len(x) for x in tox._Columns({}).of([b"ab", b""])] == [0, 0, 3]


def test_blocks_hold_only_the_common_terms_of_their_examples():
    """What is summed for a block are the terms that its examples have, not all common ones."""
    rng = random.Random(3)
    examples = []
    for i in range(6 * tox._BLOCK):
        side = b"lr"[i % 2 :][:1]
        examples.append((i, i % 2, [(side + b"%d" % j, rng.randint(1, 4)) for j in rng.sample(range(20), 8)]))
    index = tox.Neighbours(examples, {s + b"%d" % j: 50 for s in (b"l", b"r") for j in range(20)}, 1000, 15, 0.25)
    assert index.most.shape == (6, 40) and index.widths.tolist() == [20] * 6
    assert len(index.table) == 6 * tox._BLOCK * 20
    dense = np.zeros((len(index.ids), 40))
    for at, i in enumerate(index.ids):
        which, weights = index.vector(examples[i][2])
        dense[at, which] = weights
    queries = [index.vector(found) for _, _, found in examples[:300]]  # more than are searched for together
    for (which, weights), (places, cosine) in zip(queries, index.search(queries)):
        exact = dense[:, which] @ weights
        assert places.tolist() == np.lexsort((index.ids, -exact.round(12)))[:15].tolist()
        assert np.allclose(cosine, exact[places])
