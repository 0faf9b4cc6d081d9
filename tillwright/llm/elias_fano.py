"""Monotone numbers in little more than their entropy, and a trie of contexts and successors made of them.

Everything works on whole arrays of questions, and on any buffer: what :meth:`Trie.pack` made can lie in a memory-mapped
file or in an Arrow batch and is used in place.
"""

from __future__ import annotations

import mmap
from typing import NamedTuple

import numpy as np

_ONE, _WORD = np.uint64(1), np.uint64(63)


def _u(values) -> np.ndarray:
    return np.asarray(values, np.uint64)


class EliasFano(NamedTuple):
    """A sequence that never falls: low bits packed, high bits in unary, with a count of ones before each word."""

    size: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = _u(values)
        size = len(values)
        last = int(values[-1]) if size else 0
        bits = max(0, (last // size).bit_length() - 1) if size else 0
        place = np.arange(size, dtype=np.uint64)
        low = np.zeros(size * bits // 64 + 2, np.uint64)
        if bits:
            part, at = values & _u((1 << bits) - 1), place * _u(bits)
            word, shift = (at >> _u(6)).astype(np.int64), at & _WORD
            np.add.at(low, word, part << shift)
            np.add.at(low, word + 1, part >> _ONE >> (_WORD - shift))
        ones = (values >> _u(bits)) + place
        high = np.zeros(((last >> bits) + 1 + size) // 64 + 1, np.uint64)
        np.add.at(high, (ones >> _u(6)).astype(np.int64), _ONE << (ones & _WORD))
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls(size, bits, low, high, ranks)

    def _select(self, counts: np.ndarray, words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the ``k``-th bit of ``words``, with ``counts`` bits before each word."""
        word = np.searchsorted(counts, k, "right") - 1
        left, bits, place = _u(k - counts[word]), words[word], np.zeros(len(k), np.uint64)
        for half in (32, 16, 8, 4, 2, 1):
            below = np.bitwise_count((bits >> place) & _u((1 << half) - 1)).astype(np.uint64)
            beyond = left >= below
            left = np.where(beyond, left - below, left)
            place = np.where(beyond, place + _u(half), place)
        return word * 64 + place.astype(np.int64)

    def _bucket_end(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have high bits of at most ``high``; none below zero."""
        zeros = np.arange(len(self.ranks), dtype=np.int64) * 64 - self.ranks
        return np.where(high < 0, 0, self._select(zeros, ~self.high, np.maximum(high, 0)) - high)

    def _lows(self, index: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(index), np.uint64)
        at = _u(index) * _u(self.bits)
        word, shift = (at >> _u(6)).astype(np.int64), at & _WORD
        both = (self.low[word] >> shift) | (self.low[word + 1] << _ONE << (_WORD - shift))
        return both & _u((1 << self.bits) - 1)

    def get(self, index: np.ndarray) -> np.ndarray:
        index = np.asarray(index, np.int64)
        high = self._select(self.ranks, self.high, index) - index
        return (_u(high) << _u(self.bits)) | self._lows(index)

    def successor(self, values: np.ndarray, start=0, end=None) -> np.ndarray:
        """Place of the first number from ``start`` on that is not below the value, or ``end``."""
        values = _u(values)
        end = np.full(len(values), self.size if end is None else end, np.int64)
        start = np.minimum(np.broadcast_to(np.asarray(start, np.int64), values.shape), end)
        most = int(self.high.size * 64 - self.ranks[-1] - 1)  # the last zero
        high = np.minimum(values >> _u(self.bits), _u(most)).astype(np.int64)
        first = np.clip(self._bucket_end(high - 1), start, end)
        last = np.clip(self._bucket_end(high), first, end)
        beyond = (values >> _u(self.bits)) > _u(most)
        first = np.where(beyond, last, first)
        wanted = values & _u((1 << self.bits) - 1)
        while (open_ := np.flatnonzero(first < last)).size:
            middle = (first[open_] + last[open_]) // 2
            below = self._lows(middle) < wanted[open_]
            first[open_[below]] = middle[below] + 1
            last[open_[~below]] = middle[~below]
        return first

    def find(self, values: np.ndarray, start=0, end=None) -> np.ndarray:
        """Place of each value, or -1."""
        at = self.successor(values, start, end)
        limit = np.full(len(at), self.size if end is None else end, np.int64)
        inside = np.flatnonzero(at < limit)
        found = np.full(len(at), -1, np.int64)
        same = inside[self.get(at[inside]) == _u(values)[inside]]
        found[same] = at[same]
        return found

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.size, self.bits], np.int64), self.low, self.high, self.ranks]

    @classmethod
    def from_arrays(cls, arrays: list[np.ndarray]) -> EliasFano:
        (size, bits), low, high, ranks = arrays
        return cls(int(size), int(bits), low, high, ranks)


class Trie(NamedTuple):
    """Contexts and the successors of each, with a code per context and a code per successor.

    ``contexts`` are the sorted ids of the first level and ``pointers`` say where the successors of each begin.
    ``words`` are the ids of all successors.  A successor is stored by its place there, plus a base by context,
    so the whole second level never falls; it is looked for in its context's range only.
    """

    contexts: EliasFano
    pointers: EliasFano
    words: EliasFano
    successors: EliasFano
    context_codes: np.ndarray
    codes: np.ndarray

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, codes: np.ndarray, context_codes: np.ndarray) -> Trie:
        """From pairs in order of context and word; ``context_codes`` has a code per different context."""
        contexts, starts = np.unique(context, return_index=True)
        words, place = np.unique(word, return_inverse=True)
        base = np.repeat(np.arange(len(contexts)), np.diff(np.append(starts, len(context)))) * max(1, len(words))
        return cls(
            EliasFano.of(contexts), EliasFano.of(np.append(starts, len(context))), EliasFano.of(words),
            EliasFano.of(base + place), context_codes.astype(np.uint16), codes.astype(np.uint16),
        )

    def look_up(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the contexts and of the successors within them; -1 for what is not there."""
        at, place = self.contexts.find(context), self.words.find(word)
        found = np.full(len(at), -1, np.int64)
        asked = np.flatnonzero((at >= 0) & (place >= 0))
        own = at[asked]
        start, end = (self.pointers.get(own + k).astype(np.int64) for k in (0, 1))
        found[asked] = self.successors.find(own * max(1, self.words.size) + place[asked], start, end)
        return at, found

    def pack(self) -> bytes:
        """One buffer: the number of arrays, their lengths in bytes, then each at a multiple of eight."""
        levels = [array for level in self[:4] for array in level.arrays()]
        parts = [array.tobytes() for array in [*levels, self.context_codes, self.codes]]
        head = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
        return head + b"".join(part + bytes(-len(part) % 8) for part in parts)

    @classmethod
    def open(cls, buffer) -> Trie:
        """The trie in a buffer, without copying it."""
        count = int(np.frombuffer(buffer, np.int64, 1)[0])
        lengths = np.frombuffer(buffer, np.int64, count, 8).tolist()
        kinds = [np.int64, np.uint64, np.uint64, np.int64] * 4 + [np.uint16, np.uint16]
        at, arrays = 8 + 8 * count, []
        for kind, length in zip(kinds, lengths, strict=True):
            arrays.append(np.frombuffer(buffer, kind, length // np.dtype(kind).itemsize, at))
            at += length + -length % 8
        levels = [EliasFano.from_arrays(arrays[k : k + 4]) for k in range(0, 16, 4)]
        return cls(*levels, *arrays[16:])

    @classmethod
    def open_file(cls, path: str) -> Trie:
        """The trie in a file, memory-mapped: only pages that are looked at are read."""
        with open(path, "rb") as file:
            return cls.open(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
