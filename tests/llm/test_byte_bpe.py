import base64
import hashlib
import random
import struct

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from abacist.llm import byte_bpe  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def oracle():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return byte_bpe.Encoder(byte_bpe.Vocabulary(file.read(), public_tokenizers.PATTERN))


def texts():
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "the", "ing", "12", "!", "'s", "的", " ", "\x1c", "　", "😀", ".", "Ü", "<|endoftext|>"]
    yield from ("".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(2000))
    yield from ("".join(rng.choices("abcdeént", k=rng.randint(0, 300))) for _ in range(200))
    yield from ["", " ", "a" * 30_000, "ab" * 20_000, " " * 20_000, "é" * 9_999, " lead", "trail ", "a\n b"]
    yield from ("x" + chr(c) + "y " + chr(c) + " z" for c in range(0, 0x3100))


def test_batch_equals_oracle(encoder, oracle):
    batch = list(texts())
    for text, ids in zip(batch, encoder.encode(batch)):
        assert ids.tolist() == oracle.encode_ordinary(text), text[:60]
        assert encoder.vocabulary.decode(ids) == text.encode()


def test_table_is_begun_anew(encoder, oracle):
    small = byte_bpe.Encoder(encoder.vocabulary, most=3)
    for _ in range(3):
        batch = ["one two three four five", "six  seven", "one two"]
        assert [i.tolist() for i in small.encode(batch)] == [oracle.encode_ordinary(t) for t in batch]


def test_other_patterns_are_not_cut(encoder):
    vocabulary = byte_bpe.Vocabulary(open(PATH, "rb").read(), r"[^x]+|x")
    whole = tiktoken.Encoding("o", pat_str=r"[^x]+|x", mergeable_ranks=vocabulary.rank, special_tokens={})
    batch = ["the cat sat", "ax b xx c", "the  the the"]
    assert [i.tolist() for i in byte_bpe.Encoder(vocabulary).encode(batch)] == [whole.encode_ordinary(t) for t in batch]


def test_queue_pops_ranks_in_order():
    import numpy as np

    queue = byte_bpe.RankQueue(1000)
    queue.put_all(np.array([700, 3, -1, 3, 255]), np.arange(5))
    queue.put(256, np.array([9, 8, 9]))
    popped = []
    while (found := queue.pop()) is not None:
        popped.append((found[0], found[1].tolist()))
    assert popped == [(3, [1, 3]), (255, [4]), (256, [8, 9]), (700, [0])]


def test_encode_and_decode_rows(documents, oracle):
    rows = [(1, "Hello  wörld"), (2, None), (3, ""), (4, "x" * 200_000), (4, "again"), (None, "no id")]
    got = byte_bpe.encode(documents(rows), PATH, public_tokenizers.PATTERN)
    found = sorted(got.collect(), key=str)
    want = []
    for i, t in rows:
        ids = oracle.encode_ordinary(t or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((i, len(ids), packed, hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(lambda r: (r[0], r[1], bytes(r[2]), r[3], r[4]), found), key=str) == sorted(want, key=str)
    back = byte_bpe.decode(got, PATH, public_tokenizers.PATTERN)
    assert sorted((r.doc_id, bytes(r.text).decode()) for r in back.collect() if r.doc_id) == sorted((i, t or "") for i, t in rows if i)
    assert byte_bpe.encode(documents([]), PATH, public_tokenizers.PATTERN).collect() == []
