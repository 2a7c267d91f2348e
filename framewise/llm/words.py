"""Word hashing over whole Arrow text columns, without a Python object per word.

A word's hash is the polynomial sum(byte_j * R**j) modulo 2**64 over its lower-cased (A-Z only)
bytes, finalised by an avalanche mix.  Sums over all words of a piece of the column come from one
running sum, so the cost is a few array operations per byte.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_R = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 20  # bytes of text hashed at a time; a longer text is a piece of its own

#: `[^\x20\x09-\x0D]+`
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a lower-cased text: ASCII letters, digits, all non-ASCII
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


class Words(NamedTuple):
    hashes: np.ndarray   # uint64, one per word, in text order
    starts: np.ndarray   # int64 byte positions in ``data``
    ends: np.ndarray
    bounds: np.ndarray   # int64, texts + 1: words of text i are bounds[i]:bounds[i + 1]
    data: np.ndarray     # uint8, the column's bytes as given


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit avalanche (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, _PIECE + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * _PIECE:  # a very long text's powers are not kept
            _powers[name] = have
    return have[:n]


def byte_column(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def hash_words(column, is_word: np.ndarray = NOT_SPACE) -> Words:
    """Hashes and places of the words of every text of an Arrow column."""
    data, offsets = byte_column(column)
    hashes, starts, ends, bounds = [], [], [], np.zeros(len(offsets), np.int64)
    done, first, n_texts = 0, 0, len(offsets) - 1
    while first < n_texts:
        last = int(np.searchsorted(offsets, offsets[first] + _PIECE, "right")) - 1
        last = min(max(last, first + 1), n_texts)
        lo, hi = int(offsets[first]), int(offsets[last])
        piece, cuts = data[lo:hi], offsets[first:last + 1] - lo
        inside = is_word[piece]
        n = len(piece)
        edge = np.zeros(n + 1, bool)
        edge[cuts] = True
        edge[1:-1] |= ~inside[:-1]
        begin = np.flatnonzero(inside & edge[:-1])
        edge = np.zeros(n + 1, bool)
        edge[cuts] = True
        edge[1:-1] |= ~inside[1:]
        end = np.flatnonzero(inside & edge[1:]) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER[piece].astype(np.uint64) + np.uint64(1)) * _power("up", _R, n), out=sums[1:])
        hashes.append(mix((sums[end] - sums[begin]) * _power("down", pow(_R, -1, 1 << 64), n)[begin]))
        starts.append(begin + lo)
        ends.append(end + lo)
        bounds[first + 1:last + 1] = done + np.searchsorted(begin, cuts[1:])
        done += len(begin)
        first = last
    none = np.zeros(0, np.int64)
    return Words(np.concatenate(hashes) if hashes else none.astype(np.uint64),
                 np.concatenate(starts) if starts else none,
                 np.concatenate(ends) if ends else none, bounds, data)
