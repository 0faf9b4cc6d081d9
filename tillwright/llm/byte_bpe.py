"""Byte-level BPE encoding and decoding with two tiers.

A text is split by the pattern of the vocabulary.  The first tier looks the bytes of a whole
pre-token up through a minimal perfect hash over the vocabulary: one hash, one displacement,
one comparison.  What is no entry goes to the second tier, which merges bytes: neighbours are
linked, and a heap hands out the pair of lowest rank, the leftmost of equal ones.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tillwright.llm.common import Memo, slices

#: Vocabulary entries per bucket of the perfect hash; fewer make it larger and quicker to build.
KEYS_PER_BUCKET = 3
#: Pre-tokens a task remembers.
MEMO_TOKENS = 800_000


class PerfectHash:
    """Hash and displace: every key has a slot of its own, as many slots as keys.

    Buckets are placed largest first, each with the first displacement that puts all its keys
    on free slots; buckets of one key name their slot instead (as a negative number).
    """

    def __init__(self, keys: list[bytes]):
        self.slots = max(1, len(keys))
        self.buckets = max(1, len(keys) // KEYS_PER_BUCKET)
        buckets: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh3_64_intdigest(key) for key in keys]
        if len(set(hashes)) < len(keys):
            raise ValueError("two keys have the same hash")
        for i, h in enumerate(hashes):
            buckets[h % self.buckets].append(i)
        self.displacement = [0] * self.buckets
        self.key_at = [-1] * self.slots
        single = []
        for b in sorted(range(self.buckets), key=lambda b: -len(buckets[b])):
            if len(buckets[b]) < 2:
                single += [b] * len(buckets[b])
                continue
            d = 0
            while True:
                slots = [self._slot(hashes[i], d) for i in buckets[b]]
                if len(set(slots)) == len(slots) and all(self.key_at[s] < 0 for s in slots):
                    break
                d += 1
            self.displacement[b] = d
            for i, s in zip(buckets[b], slots, strict=True):
                self.key_at[s] = i
        free = (s for s in range(self.slots) if self.key_at[s] < 0)
        for b, s in zip(single, free, strict=False):
            self.displacement[b] = -s - 1
            self.key_at[s] = buckets[b][0]
        self.keys = [keys[i] if i >= 0 else None for i in self.key_at]

    def _slot(self, h: int, d: int) -> int:
        mixed = (h ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9
        return (mixed >> 24 & 0xFFFFFFFFFF) % self.slots

    def find(self, key: bytes) -> int:
        """Index of ``key``, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[h % self.buckets]
        slot = self._slot(h, d) if d >= 0 else -d - 1
        return self.key_at[slot] if self.keys[slot] == key else -1


class ByteBpe:
    """Encodes and decodes texts by merge ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_tokens: int = MEMO_TOKENS):
        entries = sorted(ranks.items(), key=lambda entry: entry[1])
        self.ranks = ranks
        self.rank_of = [rank for _, rank in entries]
        self.hash = PerfectHash([key for key, _ in entries])
        self.bytes_of = {rank: key for key, rank in entries}
        self.split = regex.compile(pattern).findall
        self.memo = Memo(lambda token: self._packed(token.encode()), memo_tokens)

    def token(self, token: bytes) -> list[int]:
        """Ids of one pre-token."""
        found = self.hash.find(token)
        return [self.rank_of[found]] if found >= 0 else self.merge(token)

    def merge(self, token: bytes) -> list[int]:
        """Ids after merging neighbours by rank; ends are positions of the next part."""
        size, ranks = len(token), self.ranks
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(rank, i, i + 2) for i in range(size - 1) if (rank := ranks.get(token[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            middle = after[i] if after[i] >= 0 else size
            if after[i] < 0 or middle >= size or after[middle] != end:
                continue  # one of the two parts has been merged since
            after[i], after[middle] = end, -1
            if end < size:
                before[end] = i
                if (rank := ranks.get(token[i : after[end]])) is not None:
                    heappush(heap, (rank, i, after[end]))
            if (left := before[i]) >= 0 and (rank := ranks.get(token[left:end])) is not None:
                heappush(heap, (rank, left, end))
        ids, i = [], 0
        while i < size:
            ids.append(ranks[token[i : after[i]]])
            i = after[i]
        return ids

    def _packed(self, token: bytes) -> bytes:
        ids = self.token(token)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a file with one base64 entry and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, lines) if rank}


@lru_cache(maxsize=2)
def _bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


def encode(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text: ``doc_id``, ``n_tokens`` and ``ids`` packed as little-endian 32-bit integers.

    ``ranks`` is the path of a rank file that every machine has.  No special token is recognised.
    A NULL or empty text has no ids; a NULL id stays NULL; repeated rows are encoded each; an
    empty table gives none; other columns are not read.  There is no shuffle.
    """
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(ranks, pattern)
        for batch in slices(batches):
            packed = [bpe.encode(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(ids) // 4 for ids in packed], pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids"],
            )

    return source.mapInArrow(work, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` with a column ``decoded``, the bytes of its ``ids``; NULL ids give none."""
    source = encoded.select("doc_id", "n_tokens", "ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(ranks, pattern)
        for batch in slices(batches):
            decoded = [bpe.decode(ids or b"") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return source.mapInArrow(work, "doc_id long, n_tokens long, ids binary, decoded binary")
