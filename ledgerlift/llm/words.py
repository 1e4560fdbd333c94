"""Words and word shingles of Arrow text batches, as numpy arrays.

Words are the runs of bytes other than space and ``\\t \\n \\v \\f \\r``.  UTF-8
never uses those bytes inside a character, so the byte view gives the same
words as ``[^\\x20\\x09-\\x0D]+`` on the text.  Every word becomes a 64-bit hash
of its bytes; a shingle hash mixes the hashes of its words.  Two different
shingles among n share a hash with a probability of about n^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
LONG_WORD = 1024

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LANE = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
                np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd(j: int) -> np.uint64:
    """The multiplier of the j-th word of a window."""
    base = int(_ODD[j % len(_ODD)])
    return np.uint64((base + 2 * (j // len(_ODD)) * 0x9E3779B97F4A7C15) % (1 << 64) | 1)


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """``(first row, last row + 1, bytes, offsets)`` of runs of rows of about
    ``limit`` bytes (one longer text is a run of its own); nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray):
    """Word starts, word ends, and per row the index of its first word (rows + 1 entries)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    finishes = solid
    finishes[:-1] &= ~np.r_[solid[1:]] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, eight bytes at a time."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    lanes = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    size = ends - starts
    out = mix((lanes[starts] & LANE[np.minimum(size, 8)])
              ^ (size.astype(np.uint64) * _ODD[0]))
    at = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    place, rest = starts[at] + 8, size[at] - 8
    while at.size:
        out[at] = mix(out[at] * _ODD[1] ^ (lanes[place] & LANE[np.minimum(rest, 8)]))
        more = rest > 8
        at, place, rest = at[more], place[more] + 8, rest[more] - 8
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


def windows(word: np.ndarray, first: np.ndarray, k: int):
    """Hash of each k-word window inside a row: ``(hashes, first word of each, row of each)``."""
    if len(word) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = len(word) - k + 1
    total = word[:n] * odd(0)
    for j in range(1, k):
        total = total + word[j:n + j] * odd(j)
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return mix(total[at]), at, row[at]


def short_rows(word: np.ndarray, first: np.ndarray, k: int):
    """Rows with 1 to k - 1 words, and a hash of the whole sequence of each."""
    count = np.diff(first)
    rows = np.flatnonzero((count > 0) & (count < k))
    total = count[rows].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    for j in range(k - 1):
        has = count[rows] > j
        total[has] += word[first[rows[has]] + j] * odd(j + k)
    return rows, mix(total)


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flags are set between consecutive offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
