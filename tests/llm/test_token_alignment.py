import hashlib
from collections import Counter

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from abacist.llm import token_alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def brute():
    """(n_a, n_b, links, groups) of a text by walking both token lists byte by byte."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B)

    def byte_of():
        printable = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c]
        table, extra = {chr(c): c for c in printable}, 256
        for c in range(256):
            if c not in printable:
                table[chr(extra)] = c
                extra += 1
        return table

    level = byte_of()

    def piece(i):
        token = b.id_to_piece(i)
        return bytes([int(token[3:5], 16)]) if b.is_byte(i) else token.replace("▁", " ").encode()

    def walk(text):
        if not text:
            return 0, 0, [], ""
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_tokens = [bytes(level[c] for c in a.id_to_token(i)) for i in a_ids]
        b_tokens = [piece(i) for i in b_ids]
        if not b"".join(a_tokens) == b"".join(b_tokens) == b" " + text.encode():
            return 0, 0, [], ""
        links, groups, j, at, end = [], [], 0, 0, 0
        left, right = [], []
        for i, token in zip(a_ids, a_tokens):
            left.append(i)
            at += len(token)
            while end < at:
                right.append(b_ids[j])
                end += len(b_tokens[j])
                j += 1
            if end == at:
                links.append((i, right[-1]))
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        return len(a_ids), len(b_ids), links, ";".join(groups)

    return walk


TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello world, hello  world\n\n\tagain",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "naïve œuvre 東京 \U0001f469‍\U0001f680 ́",
    "▁ stands for a space",
    "ﬁ ligature and ① are not given back where B normalises",
    "nul \x00 byte",
    "x" * 3000,
    "12345678901234567890 !!!??? --",
    " leading and trailing ",
]


@pytest.mark.parametrize("held", [0, 3, 1 << 20])
def test_measures_equal_a_walk(documents, prose, brute, held):
    rows = list(enumerate(TEXTS + prose(1, 40)))
    rows += [(500, rows[4][1]), (501, rows[4][1]), (4, rows[4][1]), (None, rows[15][1]), (502, rows[20][1] * 200)]
    found = token_alignment.align(documents(rows), A, B, held=held)
    walked = {t: brute(t) for _, t in rows}
    count = Counter(p for _, t in rows for p in walked[t][2])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    pairs = {(r.a_id, r.b_id): (r.n, r.best) for r in found.pairs.collect()}
    assert pairs == {p: (n, n == most[p[1]]) for p, n in count.items()}

    def measures(i, text):
        n_a, n_b, links, groups = walked[text]
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_groups = groups.count(";") + 1 if groups else 0
        best = sum(count[p] == most[p[1]] for p in links)
        return i, n_a, n_b, n_groups, len(links), best, sum(count[p] for p in links), sha

    assert Counter(map(tuple, found.measures.collect())) == Counter(measures(i, t) for i, t in rows)
    assert sum(r[1] == 0 for r in map(tuple, found.measures.collect())) >= 3  # null, empty, the real U+2581


def test_groups_are_given_as_text(documents, brute):
    rows = [(1, "Hello naïve world"), (2, "Hello naïve world"), (3, None)]
    found = {r.copies: r for r in token_alignment.aligned_texts(documents(rows), A, B).collect()}
    assert found[2].groups == brute("Hello naïve world")[3] and found[1].groups == ""


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, key string")
    found = token_alignment.align(docs, A, B)
    assert found.measures.collect() == [] and found.pairs.collect() == []


def test_stretches_give_what_whole_texts_give(prose, monkeypatch):
    """Cut at single spaces and remembered, or encoded whole: the same; also with a memory of few stretches."""
    monkeypatch.setattr(token_alignment, "_MEMO", 50)
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        aligner = token_alignment._Aligner(a.read(), b.read())
    assert aligner.cuts
    spaces = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 6158, 8195, 8203, 8232, 12288, 65279)]
    odd = [f"a{s} b {s}c 's {s} {s}{s} 1{s}2  't" for s in spaces] + ["▁ a ▁b", "it 's 're 'll  do n't", " a", "a ", "  ", "é" * 60 + " x"]
    texts = [t for t in TEXTS if t] + odd + prose(9, 200)
    cut = [x for i in range(0, len(texts), 20) for x in aligner.align(texts[i : i + 20])]
    aligner.cuts = False
    assert cut == aligner.align(texts)
