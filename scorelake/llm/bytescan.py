"""Arrow text columns as byte arrays: word spans, rolling hashes, slices of bounded size.

Everything works on the UTF-8 bytes, vectorised over a slice of many texts. A
null text counts as empty.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes of text that one vectorised step handles; a longer text is a slice of its own.
SLICE = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of `[^\x20\x09-\x0D]+`.
SPACED_WORD = ~WHITE
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, for lower-cased text.
PLAIN_WORD = np.zeros(256, bool)
PLAIN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, U)
_inverses = np.ones(1, U)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n, kept for the next call."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16)
        both = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            row = np.full(size, U(base), U)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        _powers, _inverses = both
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the splitmix64 finish)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running sums of (value + 1) * BASE**i; differences give hashes of any span."""
    sums = np.zeros(len(values) + 1, U)
    np.cumsum((values.astype(U) + U(1)) * powers(len(values) + 1)[0][: len(values)], out=sums[1:])
    return sums


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` neighbouring values."""
    if len(values) < width:
        return np.zeros(0, U)
    sums = prefix_sums(values)
    return mix((sums[width:] - sums[:-width]) * powers(len(sums))[1][: len(sums) - width])


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span; spans are in order and do not overlap."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + SLICE, "right")))
        sums = prefix_sums(buf[low : ends[j - 1]])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[e] - sums[s]) * powers(len(sums))[1][s]
        i = j
    return mix(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a string array, and where each begins; n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    return buf, off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of at most `rows` rows whose texts hold at most `limit` bytes, or of one row."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    i = 0
    while i < batch.num_rows:
        before = ends[i - 1] if i else 0
        j = min(i + rows, max(i + 1, int(np.searchsorted(ends, before + limit, "right"))))
        yield batch.slice(i, j - i)
        i = j


def spans(buf: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that the table allows, cut at text ends: starts, ends,
    and the number of the first run of each text (n + 1 entries)."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = table[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, off)


def totals_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values over the runs first[i]:first[i + 1]; empty runs give 0."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, ascending; by sorting, which beats numpy's hashing here."""
    ranked = np.sort(values)
    keep = np.ones(len(ranked), bool)
    keep[1:] = ranked[1:] != ranked[:-1]
    return ranked[keep]


def seen_twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once, and did it occur before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    again = np.zeros(len(keys), bool)
    again[1:] = ranked[1:] == ranked[:-1]
    twice = again.copy()
    twice[:-1] |= again[1:]
    both = np.zeros((2, len(keys)), bool)
    both[0, order], both[1, order] = twice, again
    return both[0], both[1]
