import random
import re

import numpy as np
import pytest

from abacist.llm import minhash


def brute_set(text, width=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", words) if w]
    grams = {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}
    return grams or ({" ".join(words)} if words else set())


def brute_groups(rows, percent=80):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[top(i)] = min(doc_id, low.get(top(i), doc_id))
    return [
        (doc_id, len(s), c := (low.get(top(i)) if s else doc_id), doc_id == c)
        for i, ((doc_id, _), s) in enumerate(zip(rows, sets))
    ]


def answered(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near(prose):
    """Unrelated texts, and copies whose distance from each other is on both sides of the limit."""
    rng = random.Random(7)
    texts = prose(3, 40, 0, 80)
    for base in prose(4, 12, 60, 120):
        words = base.split()
        texts += [edited(rng, words, rng.randint(0, 4)) for _ in range(8)]
    return texts


def test_groups_equal_all_pairs(documents, near):
    rows = list(enumerate(near))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "One two"), (904, "one  TWO"), (905, "one two three four")]
    rows += [(906, "one two three four five"), (907, "Ünï CODE Ü x"), (908, "w " * 50_000), (None, near[60]), (5, near[60]), (5, near[60])]
    assert answered(minhash.near_groups(documents(rows))) == sorted(brute_groups(rows), key=str)


@pytest.mark.parametrize("block", [3, 2048])
def test_crowds_lose_no_connection(documents, near, monkeypatch, block):
    """Every bucket a crowd, in one block and in many."""
    monkeypatch.setattr(minhash, "_BLOCK", block)
    rng = random.Random(11)
    common = [f"c{i}" for i in range(90)]
    # texts that share a passage without being near, and chains of near ones among them
    texts = [" ".join(common + [f"t{i}-{j}" for j in range(60)]) for i in range(20)]
    chain = common + [f"x{j}" for j in range(60)]
    for _ in range(15):
        chain = edited(rng, chain, 2).split()
        texts.append(" ".join(chain))
    rows = list(enumerate(texts + near[40:100]))
    assert answered(minhash.near_groups(documents(rows), crowded=1)) == sorted(brute_groups(rows), key=str)


def test_only_null_ids_and_empty_table(spark, documents):
    rows = [(None, "a b c d e"), (None, "a b c d e")]
    assert answered(minhash.near_groups(documents(rows))) == [(None, 2, None, True)] * 2
    empty = spark.createDataFrame([], "doc_id long, text string, node int, band int")
    assert minhash.near_groups(empty).collect() == []


@pytest.mark.parametrize("overlap", [0.5, 0.8, 0.95])
def test_coordinates_agree_as_often_as_the_sets_overlap(overlap):
    rng = np.random.default_rng(1)
    share = []
    for _ in range(40):
        union = rng.integers(0, 2**64, 400, dtype=np.uint64)
        both = round(400 * overlap)
        half = (400 - both) // 2
        a, b = np.unique(union[: both + half]), np.unique(np.append(union[:both], union[both + half :]))
        x, y = minhash.signatures([a, b], 160)
        share.append((x == y).mean())
    assert abs(np.mean(share) - overlap) < 0.02


def test_pairs_at_the_limit_share_a_band():
    rng = np.random.default_rng(2)
    for _ in range(200):
        union = rng.integers(0, 2**64, 100, dtype=np.uint64)
        x, y = minhash.bands([np.unique(union[:90]), np.unique(np.append(union[:80], union[90:]))])
        assert (x == y).any()
