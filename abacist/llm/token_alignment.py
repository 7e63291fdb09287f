"""Alignment of two tokenizers over a corpus, on the byte offsets where tokens of both end.

Equal texts are aligned once: rows are grouped by their full text (copies meet in the map-side
aggregate, so a text with very many of them is no large group), every distinct text is encoded by
both tokenizers and its measures are joined back to the rows by the text's SHA-256. Two tokens are
linked if their byte ranges end together; the links of a text count as often as the text occurs.
What a text needs of the corpus-wide counts comes in two ways that give the same numbers: the most
frequent pairs, at most ``held``, are broadcast, all others are looked up by a shuffled join.

Where both tokenizers allow it (see ``_Aligner``), a text is cut at single spaces between other characters,
where tokens of both end whatever stands around; what a short stretch gives is remembered and not encoded again.

Tokenizer A sees a space and the text, tokenizer B the text (it adds the space itself); strings of
special tokens are plain text. Null and empty texts, and texts that either tokenizer does not give
back byte by byte, have no tokens: their measures are 0 and their groups ''. Texts are never cut;
one text is encoded at a time in one task, whatever its length. Ids play no part but to be returned:
null ids and repeated rows are answered each. Pairs that tie for the highest count of their B token
are all best. An empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import accumulate, chain, compress

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.llm.common import slices, small_batches, store

_TOGETHER = 1 << 20  # bytes of text whose tokens are held at a time
_MEMO = 150_000
_SHORT = 48
# a space between characters that no regex engine takes for white space
_CUT = re.compile(" (?=[^\\s\u180e\u200b-\u200f\u2060\ufeff])(?<=[^\\s\u180e\u200b-\u200f\u2060\ufeff] )")
_PAIRS = 1 << 20  # distinct pairs counted in a task before they are handed on
_MEASURES = "key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"


@dataclass(frozen=True)
class Alignment:
    """``measures``: one row per row of the documents; ``pairs``: a_id, b_id, n (links), best."""

    measures: DataFrame
    pairs: DataFrame


def _byte_level() -> dict[str, int]:
    """Characters of byte-level vocabularies and the bytes they stand for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


# what a stretch of text gives: both numbers of tokens in one, groups as text, codes of the links in order
_Found = tuple[int, str, bytes]
_NONE: _Found = (0, "", b"")
_CHANGED: _Found = (1 << 80, "", b"")  # a tokenizer does not give it back


class _Aligner:
    """Both tokenizers and, for every id, its bytes and its decimal forms.

    Texts may be cut at single spaces if A cuts there itself (the regex of byte-level vocabularies takes a
    space together with what follows it) and no piece of B has its space anywhere but in front. The tokens
    of a text are then those of its stretches, each with a space in front, one after the other.
    """

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        level = _byte_level()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            known = all(c in level for c in token)
            self.a_bytes[at] = bytes(level[c] for c in token) if known else token.encode()
        self.b_bytes = []
        for at in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(at)
            one = bytes([int(piece[3:5], 16)]) if self.b.is_byte(at) else piece.replace("▁", " ").encode()
            self.b_bytes.append(one)
        self.a_length = np.array([len(x) for x in self.a_bytes])
        self.b_length = np.array([len(x) for x in self.b_bytes])
        a_ids, b_ids = range(len(self.a_bytes)), range(len(self.b_bytes))
        self.words = [f"{i}{end}" for end, ids in ((",", a_ids), ("|", a_ids), (",", b_ids), (";", b_ids)) for i in ids]
        pre = json.loads(a_json).get("pre_tokenizer") or {}
        cuts = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not json.loads(a_json).get("normalizer")
        self.cuts = bool(cuts) and not any(b" " in x.lstrip(b" ") for x in self.b_bytes)
        # four bytes hold a code of any usual vocabularies
        self.code = "<u4" if len(self.a_bytes) * len(self.b_bytes) <= 1 << 32 else "<i8"
        self.memo: dict[str, _Found] = {}
        self.before: dict[str, _Found] = {}

    def encode(self, texts: list[str]) -> tuple[list[int], list[list[int]], list[list[int]]]:
        """Positions of the texts that both give back whole, and their ids."""
        filled = [at for at, text in enumerate(texts) if text]
        a = [e.ids for e in self.a.encode_batch_fast([" " + texts[at] for at in filled], add_special_tokens=False)]
        b = self.b.encode([texts[at] for at in filled], num_threads=1)
        kept = np.flatnonzero(self._given_back([texts[at] for at in filled], a, b)).tolist()
        return [filled[row] for row in kept], [a[row] for row in kept], [b[row] for row in kept]

    def _given_back(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """True where the bytes of both lists of ids are a space and the text."""
        wanted = [b" " + text.encode() for text in texts]
        sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
        good = np.ones(len(wanted), bool)
        both = ((a, self.a_bytes, self.a_length), (b, self.b_bytes, self.b_length))
        for ids, _, length in both:
            cuts = np.cumsum([0, *map(len, ids)])
            flat = np.fromiter(chain.from_iterable(ids), np.int64, cuts[-1])
            good &= np.diff(np.append(0, np.cumsum(length[flat]))[cuts]) == sizes
        # of one size, so that the bytes of all can be compared in a row
        rows, ends = np.flatnonzero(good), np.cumsum(sizes[good])
        whole = np.frombuffer(b"".join(compress(wanted, good)), np.uint8)
        for ids, token, _ in both:
            given = b"".join(map(token.__getitem__, chain.from_iterable(compress(ids, good))))
            other = np.flatnonzero(np.frombuffer(given, np.uint8) != whole)
            good = good.copy()
            good[rows[np.searchsorted(ends, other, "right")]] = False
            if len(other):
                rows, ends = np.flatnonzero(good), np.cumsum(sizes[good])
                whole = np.frombuffer(b"".join(compress(wanted, good)), np.uint8)
        return good

    def _whole(self, texts: list[str]) -> list[_Found]:
        """What each text gives, encoded in one piece."""
        found = [_CHANGED] * len(texts)
        places, a, b = self.encode(texts)
        if not places:
            return found
        # the texts in a row: both tokenizers cover the same bytes, so an offset is common to both
        a_ids, b_ids = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        a_ends, b_ends = np.cumsum(self.a_length[a_ids]), np.cumsum(self.b_length[b_ids])
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_last, b_last = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        codes = (a_ids[a_last] * len(self.b_bytes) + b_ids[b_last]).astype(self.code).tobytes()
        # groups in order, the tokens of A before those of B
        a_group, b_group = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        a_word, b_word = a_ids.copy(), b_ids + 2 * len(self.a_bytes)
        a_word[a_last] += len(self.a_bytes)
        b_word[b_last] += len(self.b_bytes)
        words = list(map(self.words.__getitem__, np.concatenate([a_word, b_word])[order].tolist()))
        a_cuts, b_cuts = ([0, *accumulate(map(len, x))] for x in (a, b))
        wide = np.dtype(self.code).itemsize
        cuts = [0, *(wide * (np.searchsorted(ends, a_ends[np.array(a_cuts[1:]) - 1]) + 1)).tolist()]
        for row, at in enumerate(places):
            groups = "".join(words[a_cuts[row] + b_cuts[row] : a_cuts[row + 1] + b_cuts[row + 1]])[:-1]
            found[at] = (len(a[row]) << 32) + len(b[row]), groups, codes[cuts[row] : cuts[row + 1]]
        return found

    def _remember(self, stretches: set[str]) -> None:
        """Have what each stretch gives in ``memo``; what was not met for long is forgotten."""
        if len(self.memo) > _MEMO:
            self.memo, self.before = {}, self.memo
        new = []
        for x in stretches:
            if x not in self.memo:
                if x in self.before:
                    self.memo[x] = self.before[x]
                else:
                    new.append(x)
        self.memo.update(zip(new, self._whole(new)))

    def align(self, texts: list[str]) -> list[tuple[int, int, str, bytes]]:
        """n_a, n_b, groups and links of each text; nothing if a tokenizer does not give it back."""
        if not self.cuts:
            each = self._whole(texts)
        else:
            cut = [_CUT.split(text) if text else [] for text in texts]
            self._remember(set(chain.from_iterable(cut)))
            each = []
            for text, parts in zip(texts, cut):
                sizes, groups, links = zip(*map(self.memo.__getitem__, parts)) if parts else ((), (), ())
                total = sum(sizes)
                whole = total < _CHANGED[0] and (total, ";".join(groups), b"".join(links))
                each.append(whole or self._whole([text])[0])
            for x in chain.from_iterable(cut):
                if len(x) > _SHORT:
                    self.memo.pop(x, None)
        each = [_NONE if x is _CHANGED else x for x in each]
        return [(n >> 32, n & 0xFFFFFFFF, groups, links) for n, groups, links in each]


def _made(shared: Broadcast) -> _Aligner:
    """The tokenizers, loaded once in a process."""
    if "made" not in shared.value:
        shared.value["made"] = _Aligner(**shared.value["of"])
    return shared.value["made"]


def _aligned(batches: Iterable[pa.RecordBatch], shared: Broadcast, digest: bool) -> Iterator[pa.RecordBatch]:
    aligner = _made(shared)
    width = bytes([np.dtype(aligner.code).itemsize])
    for batch in slices(batches, "text", _TOGETHER):
        n_a, n_b, groups, links = zip(*aligner.align(batch.column("text").to_pylist()))
        if digest:
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        n_links = [len(x) // width[0] for x in links]  # one at the end of every group
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("copies"),
                *(pa.array(c, pa.int64()) for c in (n_a, n_b, n_links, n_links)),
                pa.array(groups, pa.string()),
                pa.array([width + x for x in links], pa.binary()),
            ],
            names=["key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
        )


def _unpacked(value: bytes) -> np.ndarray:
    """Codes of links; the first byte says how wide they are."""
    return np.frombuffer(value, "<u4" if value[0] == 4 else "<i8", offset=1).astype(np.int64)


def _sums(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the whole-number sums of their counts."""
    if not len(codes):
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.append(0, np.flatnonzero(codes[1:] != codes[:-1]) + 1)
    return codes[first], np.add.reduceat(counts, first)


def _pair_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in slices(batches, "links", _TOGETHER):
        found = [_unpacked(x) for x in batch.column("links").to_pylist()]
        copies = np.repeat(batch.column("copies").to_numpy(), [len(x) for x in found])
        codes, counts = _sums(np.concatenate([codes, *found]), np.concatenate([counts, copies]))
        if len(codes) > _PAIRS:
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])
            codes, counts = codes[:0], counts[:0]
    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])


def _looked_up(batches: Iterable[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    """A row per text with what the held pairs give, and a row per pair of it that is not held."""
    held, n, best = shared.value
    for batch in slices(batches, "links", _TOGETHER):
        keys, rows = batch.column("key").to_pylist(), []
        for key, packed in zip(keys, batch.column("links").to_pylist()):
            codes = _unpacked(packed)
            at = np.searchsorted(held, codes)
            known = at < len(held)
            known[known] = held[at[known]] == codes[known]
            at = at[known]
            rows.append((key, None, 0, int(best[at].sum()), int(n[at].sum())))
            other, times = _sums(codes[~known], np.ones(len(codes) - len(at), np.int64))
            rows.extend((key, c, t, 0, 0) for c, t in zip(other.tolist(), times.tolist()))
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
            names=["key", "code", "times", "n_best", "count_sum"],
        )


def _most_frequent(pairs: DataFrame, held: int) -> Broadcast:
    """Codes, counts and marks of the most frequent pairs: whole classes of size, at most ``held`` pairs."""
    size = F.floor(F.log2("n")).cast("int")
    least, total = 64, 0
    for level, n in sorted(pairs.groupBy(size).count().collect(), reverse=True):  # 64 classes at most
        total += n
        if total > held:
            break
        least = level
    found = pairs.where(size >= least).select("code", "n", "best").toArrow().sort_by("code")
    arrays = [found.column(c).to_numpy() for c in ("code", "n", "best")]
    return pairs.sparkSession.sparkContext.broadcast(tuple(arrays))


def _tokenizers(spark: SparkSession, a_path: str, b_path: str) -> Broadcast:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return spark.sparkContext.broadcast({"of": {"a_json": a.read(), "b_model": b.read()}})


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def aligned_texts(
    docs: DataFrame, a_path: str, b_path: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per distinct text: key, copies, n_a, n_b, n_groups, n_links, groups, links.

    ``groups`` lists the ids as ``a1,a2|b1;a3|b2,b3`` (its SHA-256 with ``digest``); ``links`` packs the pairs.
    """
    small_batches(docs.sparkSession)
    shared = _tokenizers(docs.sparkSession, a_path, b_path)
    distinct = _rows(docs, id_col, text_col).groupBy("text").agg(F.count("*").alias("copies"))
    distinct = distinct.select(F.sha2("text", 256).alias("key"), "copies", "text")
    return distinct.mapInArrow(partial(_aligned, shared=shared, digest=digest), _MEASURES)


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """code, a_id, b_id, n (links of the pair in the corpus), best (no pair of the B token has more)."""
    counted = aligned.select("links", "copies").mapInArrow(_pair_counts, "code long, n long")
    counted = counted.groupBy("code").agg(F.sum("n").alias("n"))
    counted = counted.select(
        "code", F.expr(f"code div {b_size}").alias("a_id"), F.expr(f"code % {b_size}").alias("b_id"), "n"
    )
    counted = store(counted, "pairs")
    most = counted.groupBy("b_id").agg(F.max("n").alias("most"))  # as many rows as B has ids, at most
    counted = counted.join(F.broadcast(most), "b_id").select("code", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))
    return store(counted, "pairs")


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    held: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Alignment:
    """Measures of every row (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) and the pairs.

    ``a_path`` is a byte-level BPE of the ``tokenizers`` library, ``b_path`` a ``sentencepiece`` model;
    ``held`` bounds the pairs that are broadcast.
    """
    from sentencepiece import SentencePieceProcessor

    aligned = store(aligned_texts(docs, a_path, b_path, True, id_col, text_col), "aligned")
    pairs = pair_counts(aligned, SentencePieceProcessor(model_file=b_path).get_piece_size())
    shared = _most_frequent(pairs, held)
    found = aligned.select("key", "links").mapInArrow(
        partial(_looked_up, shared=shared), "key string, code long, times long, n_best long, count_sum long"
    )
    found = store(found, "looked-up")
    rest = found.where("code IS NOT NULL").join(pairs, "code").select(
        "key",
        (F.col("best").cast("long") * F.col("times")).alias("n_best"),
        (F.col("n") * F.col("times")).alias("count_sum"),
    )
    sums = found.where("code IS NULL").select("key", "n_best", "count_sum").union(rest)
    sums = sums.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    by_text = aligned.drop("links", "copies").join(sums, "key")
    rows = _rows(docs, id_col, text_col).select("doc_id", F.sha2("text", 256).alias("key"))
    measures = rows.join(by_text, "key").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )
    return Alignment(measures, pairs.select("a_id", "b_id", "n", "best"))
