import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from abacist.llm import decontaminate as dec


def distance(passage, text):
    """Least edits between the passage and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(passage, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("qxzé")
        elif kind == 1:
            chars.insert(at, rng.choice("qxzé"))
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(11)
    letters = "abcdefghij é"
    items = [(k, "".join(rng.choices(letters, k=rng.randint(20, 160)))) for k in range(12)]
    docs = []
    for i in range(120):
        left, right = ("".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(2))
        _, text = rng.choice(items)
        docs.append((i, left + edited(rng, text, rng.randint(0, max(1, len(text) // 6))) + right))
    return items, docs


def brute(items, docs, rate):
    found = {}
    for k, item in items:
        p = dec.fold(item)
        if not p:
            continue
        budget = int(rate * len(p))
        for i, text in docs:
            d = distance(p, dec.fold(text or ""))
            if d <= budget:
                found[i, k] = d
    return found


def test_all_occurrences_within_budget(case):
    items, docs = case
    index = dec.Passages(items, 0.1)
    found = {(docs[n][0], k): d for n, k, d, _, _ in index.search([t for _, t in docs])}
    assert found == brute(items, docs, 0.1)
    assert len(found) > 40


@pytest.mark.parametrize("rate", [0.1, 0.25])
def test_short_passages_are_found_at_their_whole_budget(rate):
    rng = random.Random(3)
    items = [(m, "".join(rng.choices("abcdefgh", k=m))) for m in range(1, 46)]
    docs = [(-1, ""), (-2, "zz")]
    for i in range(400):
        _, text = items[i % len(items)]
        left, right = ("".join(rng.choices("ghxyz ", k=rng.randint(0, 30))) for _ in range(2))
        docs.append((i, left + edited(rng, text, rng.randint(0, int(rate * len(text)) + 1)) + right))
    found = {(docs[n][0], k): d for n, k, d, _, _ in dec.Passages(items, rate).search([t for _, t in docs])}
    assert found == brute(items, docs, rate)
    ((_, _, d, start, end),) = dec.Passages([(1, "Paris?")], 0.1).search(["xx Paris? yy"])
    assert (d, start, end) == (0, 3, 9)


def test_place_of_an_occurrence():
    index = dec.Passages([(5, "The Quick  brown fox jumps over")], 0.1)
    text = "well, the quick brown fax jumps over it"
    ((_, item, edits, start, end),) = index.search([text])
    assert (item, edits, text[start:end]) == (5, 1, "the quick brown fax jumps over")


def test_alignment_equals_full_table():
    rng = random.Random(2)
    for _ in range(200):
        a = "".join(rng.choices("abc", k=rng.randint(1, 12)))
        b = "".join(rng.choices("abc", k=rng.randint(0, 20)))
        x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
        edits, _ = dec.align(x, y, -len(a) - 1, len(a) + len(b) + 3)
        assert edits == distance(a, b), (a, b)


def test_rows(spark, documents, case):
    items, docs = case
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (52, "short"), (53, items[0][1])], "item_id long, text string")
    rows = docs[:40] + [(900, None), (901, ""), (None, items[1][1]), (902, "y" * 300_000 + items[2][1]), (3, docs[3][1])]
    want = brute([*items, (53, items[0][1])], docs[:40], 0.1)
    for block_bytes in (8 << 20, 400):
        found = dec.contaminated(documents(rows), bench, block_bytes=block_bytes).collect()
        assert {(r.doc_id, r.item_id): r.distance for r in found if r.doc_id is not None and r.doc_id < 900} == want
        assert {(r.doc_id, r.item_id) for r in found if r.doc_id in (None, 902)} == {(None, 1), (902, 2)}
    assert dec.contaminated(documents([]), bench).collect() == []
    assert dec.contaminated(documents(rows), bench.where("false")).collect() == []


def test_stage_drops_leaks_only(spark, documents, case):
    items, docs = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents([*docs, (900, None), (901, "nothing of it")])
    kept = dec.clean(df, bench)
    assert kept.schema == df.schema
    hit = {i for i, _ in brute(items, docs, 0.1)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in docs} - hit | {900, 901})


def test_a_worker_holds_little_beside_its_batch():
    """A batch of some 3 MB, as Spark hands it over, is searched in small parts."""
    rng = random.Random(5)
    rows = ["".join(rng.choices("abcdefghij ", k=4000)) for _ in range(800)]
    passage = "".join(rng.choices("klmnop ", k=100))
    rows[7] = rows[7][:2000] + passage + rows[7][2000:]
    batch = pa.RecordBatch.from_arrays([pa.array(range(800)), pa.array(rows)], names=["doc_id", "text"])
    index = dec.Passages([(1, passage)], 0.1)
    tracemalloc.start()
    kept = sum(part.num_rows for part in dec._clean([batch], index, "text"))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept == 799
    assert peak < 12 << 20
