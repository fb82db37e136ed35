"""numpy kernels over the UTF-8 bytes of Arrow string columns: word spans, word hashes, row chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: An odd base and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes that separate words of the plain rule: blank and 9 to 13.
BLANKS = np.zeros(256, bool)
BLANKS[[32, *range(9, 14)]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and the offsets of the rows in them; null counts as empty."""
    a = column.fill_null("").cast(pa.large_string())
    _, offsets, data = a.buffers()
    if offsets is None or len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(a) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_chunks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``most`` bytes, or one longer row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix finish)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int, base: int, _kept: dict = {}) -> np.ndarray:  # noqa: B006
    """base**0 .. base**(n-1) modulo 2**64; short tables are kept by the process."""
    have = _kept.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 1 << 22:
            _kept[base] = have
    return have[:n]


def spans(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of bytes that aren't separators; no run crosses a row's end."""
    n = len(raw)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[raw]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    first = offsets[:-1]
    before[first[first < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    per_row = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, np.repeat(np.arange(len(per_row)), per_row)


def span_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes that doesn't depend on where the span lies."""
    n = len(raw)
    with np.errstate(over="ignore"):
        sums = np.empty(n + 1, U64)
        sums[0] = 0
        np.cumsum((raw.astype(U64) + U64(1)) * powers(n, BASE), out=sums[1:])
        h = (sums[ends] - sums[starts]) * powers(n, INVERSE)[starts]
        return mix(h ^ (ends - starts).astype(U64))


def sum_rows(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of values that share an index, as an array of n rows."""
    out = np.zeros((n, *values.shape[1:]), values.dtype)
    if len(index):
        order = np.argsort(index, kind="stable")
        ranked = index[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        out[ranked[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x
