import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from abacist.llm import suffix_tree


def words(text):
    return suffix_tree.words_of((text or "").encode())


def brute(rows, depth, discount, least_gain):
    """The same model from dictionaries, one symbol at a time."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    tokens = [[*words(t), b"\n"] for _, t in rows]
    c = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    streams = [b" ".join(ws[:-1]) + b"\n" for ws in tokens]

    def places(stream):
        padded = b"\n" * depth + stream
        for at in range(depth, len(padded)):
            yield padded[at - depth : at], padded[at]

    full = defaultdict(Counter)
    for stream, h in zip(streams, held):
        for context, symbol in [] if h else places(stream):
            full[context][symbol] += 1
    counts = {depth: full}
    for level in range(depth - 1, -1, -1):
        counts[level] = defaultdict(Counter)
        for context, follow in counts[level + 1].items():
            for symbol, k in follow.items():
                raw = level < 2
                counts[level][context[1:]][symbol] += k if raw else 1
        if level == 1:  # the two shortest levels count occurrences
            counts[1] = defaultdict(Counter)
            for context, follow in full.items():
                for symbol, k in follow.items():
                    counts[1][context[-1:]][symbol] += k
    single = counts[0][b""]
    memo = {}

    def chance(context, symbol):
        if not context:
            return (single[symbol] + 1) / (sum(single.values()) + 256)
        if (context, symbol) not in memo:
            shorter = chance(context[1:], symbol)
            follow = counts[len(context)].get(context)
            memo[context, symbol] = shorter
            if follow and retained(context):
                total = sum(follow.values())
                memo[context, symbol] = (max(follow[symbol] - discount, 0) + discount * len(follow) * shorter) / total
        return memo[context, symbol]

    kept = {}

    def retained(context):
        if context not in kept:
            follow = counts[len(context)][context]
            total = sum(follow.values())
            gain = sum(k * math.log(k / total / chance(context[1:], s)) for s, k in follow.items())
            kept[context] = gain >= least_gain
        return kept[context]

    out = []
    for (i, _), ws, h, stream in zip(rows, tokens, held, streams):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        score = sum(math.log10(chance(context, symbol)) for context, symbol in places(stream))
        out.append((i, h, len(ws), sum(c[w] > 0 for w in ws), n, base, score))
    return out


@pytest.mark.parametrize("depth,block_bytes", [(2, 1 << 20), (3, 700), (5, 3000)])
def test_scores_match_brute_force(documents, prose, depth, block_bytes):
    rows = list(enumerate(prose(3, 60)))
    rows += [(100, None), (101, ""), (102, " \t"), (103, "Ünï the THE\nof"), (5, rows[5][1]), (None, "the of"), (104, "zz" * 3000)]
    got = suffix_tree.suffix_tree_scores(documents(rows), depth=depth, block_bytes=block_bytes).collect()
    found = sorted(map(tuple, got), key=lambda r: (str(r[0]), r[2]))
    want = sorted(brute(rows, depth, 0.9, 1.0), key=lambda r: (str(r[0]), r[2]))
    assert [r[:5] for r in found] == [r[:5] for r in want]
    for a, b in zip(found, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9), a[0]


def test_probabilities_sum_to_one(documents, prose):
    import numpy as np
    import pyarrow as pa

    streams = [(" ".join(prose(8, 30)) + "\n").encode()]
    codes, _ = suffix_tree._codes(streams, 3)
    seen, n = np.unique(codes, return_counts=True)
    contexts = np.unique(seen >> 8)
    every = (contexts[:, None] * 256 + np.arange(256)).ravel()
    count = np.zeros(len(every), np.int64)
    count[np.searchsorted(every, seen)] = n
    pairs = Counter()
    for code, k in zip(seen.tolist(), n.tolist()):
        pairs[code & 0xFFFF] += k
    near = suffix_tree._near(pairs, 0.9, 1.0)
    for place in np.unique(every >> 8 & 0xFFFF):
        here = (every >> 8 & 0xFFFF) == place
        table = suffix_tree._tree(pa.table({"code": every[here], "n": count[here]}), near, 3, 0.9, 1.0)
        chance = 10 ** table.column("value").to_numpy()
        assert np.bincount(np.unique(every[here] >> 8, return_inverse=True)[1], chance) == pytest.approx(1)


def test_held_out_rows_teach_nothing(documents, prose):
    rows = list(enumerate(prose(4, 40)))
    turned = [(i, t if zlib.crc32(str(i).encode()) % 7 != 2 else "entirely different") for i, t in rows]
    a, b = ({r.doc_id: r.score for r in suffix_tree.suffix_tree_scores(documents(x)).collect()} for x in (rows, turned))
    assert all(a[i] == pytest.approx(b[i], rel=1e-12) for i, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2)


def test_empty_table(documents):
    assert suffix_tree.suffix_tree_scores(documents([])).collect() == []
    with pytest.raises(ValueError):
        suffix_tree.suffix_tree_scores(documents([]), depth=7)


def test_counts_of_stretches_are_merged_range_by_range(monkeypatch):
    """What is sorted at a time stays a part of all; the sums are those of all at once."""
    rng = np.random.default_rng(2)
    found = [np.unique(rng.integers(-50, 4000, n)) for n in (0, 900, 3000, 1, 700)]
    counts = [rng.integers(0, 2**31 - 1, len(x)).astype(np.int32) for x in found]
    want = suffix_tree._counted(np.concatenate(found), np.concatenate(counts).astype(np.int64))
    monkeypatch.setattr(suffix_tree, "_RANGE", 500)
    sizes, counted = [], suffix_tree._counted
    monkeypatch.setattr(suffix_tree, "_counted", lambda x, w=None: sizes.append(len(x)) or counted(x, w))
    got = suffix_tree._merged(found, counts)
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(got, want))
    assert len(sizes) > 5 and max(sizes) < 1000
    assert [len(x) for x in suffix_tree._merged(found[:1], counts[:1])] == [0, 0]


def test_words_and_byte_strings_of_a_block_are_counted_run_by_run(monkeypatch, prose):
    """A block's requests do not depend on how long the runs of its texts are, nor on when counts are merged."""
    texts = ["", None, " \t", "Ünï THE the\nof", *prose(5, 60), "the"]
    table = pa.table({"block": [3] * len(texts), "text": texts, "held_out": [i % 3 == 1 for i in range(len(texts))]})
    want_words, want_strings = Counter(), Counter()
    for text, out in zip(texts, table.column("held_out").to_pylist()):
        stream = b" ".join(words(text)) + b"\n"
        padded = b"\n" * 3 + stream
        for word in [*words(text), b"\n"]:
            want_words[word] += not out
        for at in range(len(stream)):
            want_strings[int.from_bytes(padded[at : at + 4])] += not out
    longest = []
    counted = suffix_tree._codes
    monkeypatch.setattr(suffix_tree, "_codes", lambda x, d: longest.append(sum(map(len, x))) or counted(x, d))
    for stretch, held in ((1 << 30, 1 << 30), (700, 1 << 30), (700, 900), (1, 1)):
        monkeypatch.setattr(suffix_tree, "_STRETCH", stretch)
        monkeypatch.setattr(suffix_tree, "_HELD", held)
        longest.clear()
        got = suffix_tree._requests(table, 3, 5)
        rows = got.filter(got.column("word").is_valid())
        assert dict(zip(rows.column("word").to_pylist(), rows.column("n").to_pylist())) == want_words
        found = {}
        for row in got.filter(got.column("part").is_valid()).to_pylist():
            found.update(zip(suffix_tree._unpack_sorted(row["codes"]).tolist(), suffix_tree._unpack(row["counts"], np.int64).tolist()))
        assert found == want_strings
        assert max(longest) < 2 * max(stretch, max(len((t or "").encode()) + 1 for t in texts)) or stretch == 1 << 30
