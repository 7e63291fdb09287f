"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A batch of distinct pre-tokens is laid out as one linked list of symbols. For every merge rank a
bucket holds the list positions of the pairs with that rank; a two-level bitmap marks the ranks
whose buckets hold something, and find-first-set gives the next one. Popping a bucket drops entries
whose pair has changed meanwhile and merges the others, which puts new pairs into their buckets. A
bucket is merged as a whole, so a pre-token of a million bytes takes no more steps than a short one.

Merging a bucket as a whole equals merging one pair at a time unless a merge can create a pair of a
lower rank. The few ranks for which the vocabulary allows that are known beforehand; for them only
the leftmost entry of each pre-token is merged at a time.

A null text is empty; an empty text has no tokens. Texts are encoded whole, each row by itself, so
ties, repeated rows and extra columns have no influence; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import slices, small_batches, texts

# Fixed value: the pattern whose matches may be looked up chunk by chunk.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_FAN = 256
_BATCH_BYTES = 2 << 20


class RankQueue:
    """Buckets of positions by rank under a two-level bitmap."""

    def __init__(self, ranks: int):
        self.leaves = [0] * (ranks // _FAN + 1)
        self.top = 0
        self.buckets: dict[int, list[np.ndarray]] = {}

    def put(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [positions]
            self.leaves[rank // _FAN] |= 1 << rank % _FAN
            self.top |= 1 << rank // _FAN
        else:
            bucket.append(positions)

    def put_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """File positions by their ranks; those with the rank -1 are no pairs."""
        valid = ranks >= 0
        if not valid.all():
            ranks, positions = ranks[valid], positions[valid]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
            self.put(rank, positions[a:b])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions in ascending order, once each."""
        if not self.top:
            return None
        leaf = (self.top & -self.top).bit_length() - 1
        bits = self.leaves[leaf]
        low = bits & -bits
        self.leaves[leaf] = bits ^ low
        if bits == low:
            self.top ^= 1 << leaf
        rank = leaf * _FAN + low.bit_length() - 1
        found = self.buckets.pop(rank)
        at = np.sort(np.concatenate(found) if len(found) > 1 else found[0])
        return rank, at[np.append(True, at[1:] != at[:-1])] if len(at) > 1 else at


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens that forms a token."""

    def __init__(self, data: bytes, pattern: str):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.size = max(self.rank.values()) + 1
        by_rank = [b""] * self.size
        for token, rank in self.rank.items():
            by_rank[rank] = token
        self.lengths = np.array([len(t) for t in by_rank], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.octets = np.frombuffer(b"".join(by_rank), np.uint8)
        self.first = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        self.lone = np.zeros(self.size, bool)
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
                    for part in (left, right):
                        if part > rank and len(by_rank[part]) > 1:
                            self.lone[part] = True
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], -1)
        self.byte_pairs = self.pairs(np.repeat(self.first, 256), np.tile(self.first, 256)).reshape(256, 256)
        self.pattern, self.exact = pattern, regex.compile(pattern)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it forms no token."""
        keys = left * self.size + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces in a row, and how many each has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        octets = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(octets)
        if not n:
            return np.empty(0, np.int64), lengths
        owner = np.repeat(np.arange(len(pieces)), lengths)
        token = self.first[octets]
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        ends = np.cumsum(lengths)
        ends = ends[lengths > 0]
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        before[0] = -1
        rank_of = np.full(n, -1, np.int64)
        rank_of[:-1] = self.byte_pairs[octets[:-1], octets[1:]]
        rank_of[ends - 1] = -1
        alive, changed = np.ones(n, bool), np.zeros(n, bool)
        queue = RankQueue(self.size)
        queue.put_all(rank_of, np.arange(n))
        while (found := queue.pop()) is not None:
            rank, at = found
            at = at[rank_of[at] == rank]  # the others are stale
            if len(at) > 1:
                if self.lone[rank]:
                    leftmost = np.append(True, owner[at[1:]] != owner[at[:-1]])
                    if not leftmost.all():
                        queue.put(rank, at[~leftmost])
                        at = at[leftmost]
                else:
                    chained = np.append(False, after[at[:-1]] == at[1:])
                    if chained.any():  # overlapping pairs: every other one, from the left
                        here = np.arange(len(at))
                        head = np.maximum.accumulate(np.where(chained, 0, here))
                        at = at[(here - head) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            rank_of[gone] = -1
            right = after[gone]
            after[at] = right
            inner = right >= 0
            before[right[inner]] = at[inner]
            left = before[at]
            changed[at] = True
            left = left[(left >= 0) & ~changed[left]]  # -1 reads the last flag, and is left out
            changed[at] = False
            fresh = np.concatenate([left, at])
            to = after[fresh]
            ranks = self.pairs(token[fresh], token[to])
            ranks[to < 0] = -1
            rank_of[fresh] = ranks
            queue.put_all(ranks, fresh)
        return token[alive], np.bincount(owner[alive], minlength=len(pieces))

    def decode(self, ids: np.ndarray) -> bytes:
        return self.octets[_spread(self.starts[ids], self.lengths[ids])].tobytes()


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``start .. start + length`` in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


class _Numbers(dict):
    """Numbers for keys in the order they come up."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class Encoder:
    """Encodes batches of texts; a chunk that repeats is merged once.

    With the pattern ``WORDS`` a text is cut at its spaces first. Where neither neighbour of a space
    is white space a new match starts there, so the cut changes nothing, and the ids of a chunk can
    be looked up. Texts with other spaces go through the pattern as a whole, match by match. Chunks
    are kept for later batches; beyond ``most`` of them the table is begun anew.

    Keys of the table: a string is a chunk after a space, a string with a space in front is the
    chunk at the start of a text, a tuple holds one match of the pattern.
    """

    def __init__(self, vocabulary: Vocabulary, most: int = 250_000):
        self.vocabulary, self.most = vocabulary, most
        self._begin()

    def _begin(self) -> None:
        self.chunks = _Numbers()
        self.odd = np.empty(0, bool)
        self.starts = self.counts = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def encode(self, batch: list[str]) -> Iterator[np.ndarray]:
        """Token ids of each text."""
        if len(self.chunks) > self.most:
            self._begin()
        number, cut = self.chunks.__getitem__, self.vocabulary.pattern == WORDS
        rows: list = [None] * len(batch)
        if cut:
            for at, text in enumerate(batch):
                parts = text.split(" ") if text else []
                if parts:
                    parts[0] = " " + parts[0]
                rows[at] = np.fromiter(map(number, parts), np.int64, len(parts))
            self._learn()
        for at, text in enumerate(batch):
            if not cut or self.odd[rows[at]].any():
                found = list(zip(self.vocabulary.exact.findall(text)))
                rows[at] = np.fromiter(map(number, found), np.int64, len(found))
        self._learn()
        for row in rows:
            yield self.ids[_spread(self.starts[row], self.counts[row])]

    def _learn(self) -> None:
        """Merge the chunks that have come up since the last call."""
        fresh = list(islice(self.chunks, len(self.odd), None))
        if not fresh:
            return
        pieces = _Numbers()
        number, matches = pieces.__getitem__, self.vocabulary.exact.findall
        odd, sizes, flat = np.zeros(len(fresh), bool), [], []
        for at, key in enumerate(fresh):
            if isinstance(key, tuple):
                found = key
            else:
                first = key[:1] == " "
                inner = key[1:] if first else key
                lead = "" if first else " "
                if inner.isalpha():
                    found = (lead + inner,)
                elif inner[:-1].isalpha() and inner[-1] in ".,;:!?":
                    found = (lead + inner[:-1], inner[-1])
                elif not inner or inner[0].isspace() or inner[-1].isspace():
                    odd[at], found = True, ()
                else:
                    found = matches(lead + inner)
            sizes.append(len(found))
            flat += map(number, found)

        data = [p.encode() for p in pieces]
        known = [self.vocabulary.rank.get(p, -1) for p in data]
        ids, counts = self.vocabulary.merge([b"" if k >= 0 else p for p, k in zip(data, known)])
        known = np.array(known, np.int64)
        counts = counts.astype(np.int64)
        starts = np.cumsum(counts) - counts
        # a piece that is a token itself is that token; such ids stand behind the merged ones
        whole = known >= 0
        starts[whole] = len(ids) + np.arange(int(whole.sum()))
        counts[whole] = 1
        ids = np.concatenate([ids, known[whole]])

        flat, sizes = np.array(flat, np.int64), np.array(sizes, np.int64)
        ends = np.append(0, np.cumsum(counts[flat]))[np.append(0, np.cumsum(sizes))]
        self.starts = np.concatenate([self.starts, len(self.ids) + ends[:-1]])
        self.counts = np.concatenate([self.counts, np.diff(ends)])
        self.ids = np.concatenate([self.ids, ids[_spread(starts[flat], counts[flat])].astype(np.int32)])
        self.odd = np.concatenate([self.odd, odd])


def _encode(
    batches: Iterable[pa.RecordBatch], data: bytes, pattern: str, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(Vocabulary(data, pattern))
    for batch in slices(batches, "text", _BATCH_BYTES):
        n, ids_sha, text_sha, ids = [], [], [], []
        for row in encoder.encode(texts(batch.column("text"))):
            packed = row.astype("<u4").tobytes()
            n.append(len(row))
            ids_sha.append(hashlib.sha256(packed).hexdigest())
            text_sha.append(hashlib.sha256(encoder.vocabulary.decode(row)).hexdigest())
            if with_ids:
                ids.append(packed)
        columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64())}
        if with_ids:
            columns["ids"] = pa.array(ids, pa.binary())
        columns |= {"ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _decode(batches: Iterable[pa.RecordBatch], data: bytes, pattern: str) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary(data, pattern)
    for batch in batches:
        found = [vocabulary.decode(np.frombuffer(x or b"", "<u4").astype(np.int64)) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "text"])


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame, path: str, pattern: str, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids (little-endian 32-bit), and digests.

    ``path`` is a rank file on the driver, a bounded table that goes along with the tasks. The ids
    are decoded again in the same pass; ``decoded_sha256`` is the digest of what comes out.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = "ids binary, " if with_ids else ""
    run = partial(_encode, data=_read(path), pattern=pattern, with_ids=with_ids)
    return rows.mapInArrow(run, f"doc_id long, n_tokens long, {ids}ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The bytes (column ``text``) of the ``ids`` of each row; null ids are empty."""
    run = partial(_decode, data=_read(path), pattern=pattern)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")
