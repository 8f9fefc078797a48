"""Words, shingles and their hashes over Arrow columns of texts, in numpy.

A batch of texts is one array of bytes with offsets. Words are found and
hashed for the whole batch at once: eight bytes at a time, so a word costs one
or two steps; words of over 64 bytes are hashed one by one.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], U)
LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@dataclass
class Words:
    """Word hashes of a batch; ``first[d]:first[d + 1]`` are those of text d.
    ``start`` and ``length`` place each word in ``data`` (lower-cased bytes),
    ``offsets`` each text."""
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    length: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def _bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    return inside, start, np.flatnonzero(ends) + 1 - start


def words(column, separators: np.ndarray = _SPACE) -> Words:
    """Words of each text: runs of bytes outside ``separators`` (default: the
    space and 9 to 13), with A-Z lower-cased."""
    data, offsets = flat(column)
    data = _LOWER[data]
    _, start, length = _bounds(data, offsets, separators)
    return Words(data, offsets, start, length, _hash_words(data, start, length), np.searchsorted(start, offsets))


def split(column, lower: bool, separators: np.ndarray = _SPACE) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as one array of strings, and where each text's
    begin in it."""
    data, offsets = flat(column)
    data = _LOWER[data] if lower else data
    inside, start, length = _bounds(data, offsets, separators)
    at = np.concatenate([[0], np.cumsum(length)])
    out = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data[inside])])
    return out, np.searchsorted(start, offsets)


def _hash_words(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(max(0, len(padded) - 7), "<u8", padded, 0, (1,))
    out = length.astype(U) * U(0x9E3779B97F4A7C15)
    plain = length <= LONG_WORD
    active = np.flatnonzero(plain)
    for step in range(0, LONG_WORD, 8):
        active = active[length[active] > step]
        if not len(active):
            break
        left = np.minimum(length[active] - step, 8)
        out[active] = mix(out[active] ^ (eight[start[active] + step] & _MASK[left]))
    for i in np.flatnonzero(~plain):
        out[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + length[i]].tobytes())
    return out


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each position (the last n - 1
    positions of the array have none)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, U)
    out = np.full(m, n * 0xA24BAED4963EE407 % (1 << 64), U)
    for j in range(n):
        out = mix(out ^ hashes[j:j + m]) + U(j + 1)
    return out


def shingle_sets(w: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct n-word shingles of each text; a text with fewer words
    has its whole sequence as one, a text without words has none."""
    grams = ngrams(w.hash, n)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(grams[a:b - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(ngrams(w.hash[a:b], b - a) if b > a else np.zeros(0, U))
    return out
