"""Vectorised text kernels shared by the operators that run numpy on Arrow batches.

A batch is worked off in slices of about SLICE_BYTES of text (a longer text is a slice of its own), so that a worker's
temporary arrays stay a small multiple of that, whatever the number of rows in a batch. Words are runs of bytes other
than the six ASCII white space characters, which for valid UTF-8 is the pattern ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

U = np.uint64
_M1, _M2, _GOLD = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> U(30))
    x *= _M1
    x ^= x >> U(27)
    x *= _M2
    x ^= x >> U(31)
    return x


# A random 64-bit value for each byte at each of the first 256 places of a word.
_PLACES = mix(np.arange(1, 65537, dtype=np.uint64) * _GOLD)


def column(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (rows + 1 of them) of a string column; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = pc.fill_null(col, "")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, name: str = "text", most: int = SLICE_BYTES):
    """(first row, last row + 1, bytes, offsets) of runs of rows that hold about `most` bytes of text."""
    data, offs = column(batch, name)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, side="right")) - 1)
        hi = min(hi, n, lo + 65536)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def words(data: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and for each row the index of its first word (rows + 1 of them)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    ink = np.zeros(n + 2, bool)
    np.logical_not(space[data], out=ink[1:-1])
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(ink[1:-1] & (~ink[:-2] | edge[:-1]))
    ends = np.flatnonzero(ink[1:-1] & (~ink[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes: a sum of random values by byte and place, mixed with the length.

    Spans are worked off about SLICE_BYTES at a time, so that a long text takes little more than its spans' numbers.
    """
    lens = ends - starts
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(lens > 0)
    total = np.concatenate([[0], np.cumsum(lens[full])])
    lo = 0
    while lo < len(full):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + SLICE_BYTES, side="right")) - 1)
        own = full[lo:hi]
        s, ln, first = starts[own], lens[own], total[lo:hi] - total[lo]
        place = np.arange(int(total[hi] - total[lo]), dtype=np.int64) - np.repeat(first, ln)
        byte = data[place + np.repeat(s, ln)]
        value = _PLACES[((place & 255) << 8) | byte]
        if ln.max() > 256:
            value *= ((place >> 8) * 2 + 1).astype(np.uint64)
        out[own] = np.add.reduceat(value, first)
        lo = hi
    return mix(out + lens.astype(np.uint64) * _GOLD + U(seed))


def doubled(h: np.ndarray, step: int) -> np.ndarray:
    """Hashes of spans made of the span at i and the one at i + step; as many fewer as step says."""
    if len(h) <= step:
        return np.zeros(0, np.uint64)
    return mix(h[:-step] * _GOLD + h[step:])


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` items, by doubling; the last step overlaps where size is no power of two."""
    at = 1
    while at * 2 <= size:
        h, at = doubled(h, at), at * 2
    return doubled(h, size - at) if at < size else h


def row_of(first: np.ndarray) -> np.ndarray:
    """For each item its row, given each row's first item (rows + 1 of them)."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole_windows(first: np.ndarray, size: int) -> np.ndarray:
    """True for each item at which a window of `size` items starts that ends in the same row."""
    last = np.repeat(first[1:], np.diff(first))
    return np.arange(first[-1]) + size <= last


def repeated(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for each item whose hash occurs twice or more in its row."""
    out = np.zeros(len(h), bool)
    if len(h) > 1:
        key = mix(h + row.astype(np.uint64) * _GOLD)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """True for each of n places that a run of `size` from one of `starts` covers."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + size, n), -1)
    return np.cumsum(d[:n]) > 0


class Lookup:
    """Places of 64-bit hashes in a fixed set, without a search: a table by their leading bits, then a few steps."""

    def __init__(self, keys: np.ndarray):
        order = np.argsort(keys, kind="stable")
        # One more key, the largest, at which a search ends.
        self.keys = np.append(keys[order], U(2**64 - 1))
        self.order = np.append(order, -1).astype(np.int32)
        bits = max(1, int(np.ceil(np.log2(len(keys) + 1))))
        self.shift = U(64 - bits)
        self.first = np.searchsorted(self.keys[:-1] >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)

    def find(self, q: np.ndarray) -> np.ndarray:
        """The index that each key had, or -1."""
        at = self.first[(q >> self.shift).view(np.int64)]
        live = np.flatnonzero(self.keys[at] < q)
        while len(live):
            own = at[live] + 1
            at[live] = own
            live = live[self.keys[own] < q[live]]
        return np.where(self.keys[at] == q, self.order[at], np.int32(-1))


def marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that the bit map (a power of two of words) doesn't have; places are numbered by leading bits."""
    shift = U(64 - int(len(marks)).bit_length() + 1)
    return (marks[keys >> shift] >> (keys >> shift - U(6) & U(63)) & U(1)).astype(bool)


def release() -> None:
    """Gives freed memory back to the system: idle workers would keep it otherwise. Does nothing where that isn't known."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
