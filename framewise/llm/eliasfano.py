"""Elias-Fano sequences and two-part n-gram levels over memory-mapped files.

A monotone sequence of n values below ``bound`` keeps the low bits of each value in a packed array
and the high bits in unary, about 2 + log2(bound / n) bits a value.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

_ONE = np.uint64(1)


class EliasFano:
    """``words`` is one uint64 array: the packed low parts, then the unary high parts."""

    def __init__(self, words: np.ndarray, n: int, low_bits: int):
        self.n, self.low_bits = n, low_bits
        cut = (n * low_bits + 63) // 64 + 1
        self.low = words[:cut]
        bits = np.unpackbits(words[cut:].view(np.uint8), bitorder="little")
        self.ones = np.flatnonzero(bits)[:n]       # directories, expanded when a level is opened
        self.zeros = np.flatnonzero(bits == 0)

    @staticmethod
    def pack(values: np.ndarray, bound: int) -> tuple[np.ndarray, int, int]:
        """(words, n, low bits) of a sorted uint64 array of values below ``bound``."""
        n = len(values)
        low_bits = min(62, max(0, (max(1, bound) // max(1, n)).bit_length() - 1))
        at = np.arange(n, dtype=np.int64) * low_bits
        low = values & ((_ONE << np.uint64(low_bits)) - _ONE)
        packed = np.zeros((n * low_bits + 63) // 64 + 1, np.uint64)
        shift = (at & 63).astype(np.uint64)
        np.bitwise_or.at(packed, at >> 6, low << shift)
        over = np.flatnonzero((at & 63) + low_bits > 64)
        np.bitwise_or.at(packed, (at[over] >> 6) + 1, low[over] >> (np.uint64(64) - shift[over]))
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        places = high + np.arange(n)
        unary = np.zeros(64 * (((int(high[-1]) if n else 0) + n + 2) // 64 + 1), np.uint8)
        unary[places] = 1
        return np.concatenate([packed, np.packbits(unary, bitorder="little").view(np.uint64)]), n, low_bits

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.int64) * self.low_bits
        shift = (at & 63).astype(np.uint64)
        first = self.low[at >> 6] >> shift
        spill = np.where(shift > 0, self.low[(at >> 6) + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (first | spill) & ((_ONE << np.uint64(self.low_bits)) - _ONE)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = (self.ones[i] - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value >= x (n where there is none)."""
        if not self.n:
            return np.zeros(len(x), np.int64)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        low = x & ((_ONE << np.uint64(self.low_bits)) - _ONE)
        last = len(self.zeros) - 1  # values of high part h lie between the zeros h - 1 and h
        start = np.where(high > 0, self.zeros[np.clip(high - 1, 0, last)] - (high - 1), 0)
        start = np.where(high - 1 > last, self.n, start)
        stop = np.where(high > last, self.n, self.zeros[np.clip(high, 0, last)] - high)
        start, stop = np.minimum(start, self.n), np.minimum(stop, self.n)
        while len(todo := np.flatnonzero(start < stop)):
            mid = (start[todo] + stop[todo]) // 2
            less = self._low(mid) < low[todo]
            start[todo] = np.where(less, mid + 1, start[todo])
            stop[todo] = np.where(less, stop[todo], mid)
        return start


class Level:
    """One level of a trie: contexts, monotone pointers, successors relative to their context, and
    a quantised code per successor, in one memory-mapped file."""

    def __init__(self, keys: np.ndarray, codes: np.ndarray, successor_bits: int):
        """``keys``: sorted distinct uint64, the successor in the lower ``successor_bits``, its
        context above."""
        self.bits, self.mask = np.uint64(successor_bits), np.uint64((1 << successor_bits) - 1)
        context = keys >> self.bits
        self.least = context[0] if len(keys) else np.uint64(0)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.zeros(0, np.int64)
        which = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(keys)]))
        # the successors of context i continue from i << bits, which makes the whole level monotone
        successors = (which.astype(np.uint64) << self.bits) | (keys & self.mask)
        relative = context[first] - self.least
        parts = [EliasFano.pack(relative, int(relative[-1]) + 1 if len(keys) else 1),
                 EliasFano.pack(np.r_[first, len(keys)].astype(np.uint64), len(keys) + 1),
                 EliasFano.pack(successors, max(1, len(first)) << successor_bits)]
        codes = np.concatenate([codes.astype(np.uint16), np.zeros(-len(codes) % 4, np.uint16)]).view(np.uint64)
        file, self.path = tempfile.mkstemp(prefix="level-")
        with os.fdopen(file, "wb") as f:
            for words in (*(p[0] for p in parts), codes):
                f.write(words.tobytes())
        self.map = np.memmap(self.path, np.uint64, "r")
        at, opened = 0, []
        for words, n, low_bits in parts:
            opened.append(EliasFano(self.map[at:at + len(words)], n, low_bits))
            at += len(words)
        self.contexts, self.pointers, self.successors = opened
        self.codes = self.map[at:].view(np.uint16)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Codes of ``keys``, 0 where the level lacks one: find the context, then the successor
        within the context's pointer range."""
        code = np.zeros(len(keys), np.uint16)
        if not self.contexts.n:
            return code
        context = (keys >> self.bits) - self.least  # one below the least wraps round, past the last
        i = self.contexts.successor(context)
        open_ = np.flatnonzero(i < self.contexts.n)
        open_ = open_[self.contexts.get(i[open_]) == context[open_]]
        i = i[open_]
        want = (i.astype(np.uint64) << self.bits) | (keys[open_] & self.mask)
        at = self.successors.successor(want)
        inside = at < self.pointers.get(i + 1).astype(np.int64)
        open_, at, want = open_[inside], at[inside], want[inside]
        hit = self.successors.get(at) == want
        code[open_[hit]] = self.codes[at[hit]]
        return code

    def close(self) -> None:
        del self.codes, self.contexts, self.pointers, self.successors, self.map
        os.unlink(self.path)
