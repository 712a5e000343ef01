"""Words of a batch of texts as numpy arrays: spans and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK_BYTES = 1 << 19

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2**64, at least n of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, BLOCK_BYTES + 1)
        for base, name in ((_BASE, "_powers"), (pow(_BASE, -1, 1 << 64), "_inverses")):
            table = np.full(size, base, U64)
            table[0] = 1
            globals()[name] = np.cumprod(table, dtype=U64)
    return _powers, _inverses


def forget_tables() -> None:
    """Free the tables of powers; they are made again when they are needed."""
    global _powers, _inverses
    _powers = _inverses = np.ones(1, U64)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    h = h ^ (h >> U64(31))
    h = h * U64(0x7FB5D329728EA185)
    h = h ^ (h >> U64(27))
    h = h * U64(0x81DADEF4BC2DD44D)
    return h ^ (h >> U64(33))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, at - at[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about `size` bytes; a longer text is alone."""
    data, at = buffers(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, "right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def spans(data: np.ndarray, at: np.ndarray, apart: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes, and the index of each text's first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~apart[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = at[:-1]
    before[edges[edges < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = at[1:]
    after[ends[ends > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, at)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which span_hash takes the hash of any span."""
    powers, _ = _tables(len(data) + 1)
    sums = np.empty(len(data) + 1, U64)
    sums[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * powers[: len(data)], out=sums[1:])
    return sums


def span_code(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial of each span's bytes, before it is scrambled: cheap, the same wherever the span lies."""
    _, inverses = _tables(len(sums))
    return (sums[ends] - sums[starts]) * inverses[starts]


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span lies."""
    _, inverses = _tables(len(sums))
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(U64))


def windows(data: np.ndarray, at: np.ndarray, apart: np.ndarray = WHITE, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of data of about `size` bytes that cut no word; only a word longer than that makes a longer one."""
    lo, n = 0, len(data)
    while n - lo > 2 * size:
        hi = lo + size
        while True:
            white = np.flatnonzero(apart[data[lo + 1 : hi]])
            edge = at[np.searchsorted(at, lo, "right") : np.searchsorted(at, hi, "right")]
            cut = max(lo + 1 + int(white[-1]) if len(white) else lo, int(edge[-1]) if len(edge) else lo)
            if cut > lo or hi >= n:
                break
            hi = min(n, hi + size)
        if cut <= lo:
            break
        yield lo, cut
        lo = cut
    if lo < n:
        yield lo, n


def hashed_words(data: np.ndarray, at: np.ndarray, apart: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words, and the index of each text's first word.

    A long text is hashed in windows, so what is needed beside the result does not grow with it.
    """
    hashes, starts, ends = [np.zeros(0, U64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in windows(data, at, apart):
        own = np.unique(np.concatenate([[lo], at[(at > lo) & (at < hi)], [hi]])) - lo
        a, b, _ = spans(data[lo:hi], own, apart)
        hashes.append(span_hash(prefix_sums(data[lo:hi]), a, b))
        starts.append(a + lo)
        ends.append(b + lo)
    begin = np.concatenate(starts)
    return np.concatenate(hashes), begin, np.concatenate(ends), np.searchsorted(begin, at)


def word_hashes(data: np.ndarray, at: np.ndarray, apart: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and the index of each text's first word."""
    hashes, _, _, first = hashed_words(data, at, apart)
    return hashes, first
