"""Vectorised byte work on Arrow text columns, shared by the text operators.

The functions work on the UTF-8 bytes of many documents at once: a chunk is the
concatenated bytes of some rows and the offsets between them, so one numpy call
serves thousands of documents. Hashes of any substring follow in constant time from 64-bit
polynomial prefix hashes (``h(s) = sum((s[j] + 1) * P**j)`` modulo 2**64, mixed); hashes
of words are sums with drawn coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_P = U(0x9E3779B97F4A7C15 | 1)
_P_INV = U(pow(int(_P), -1, 1 << 64))
_powers = {"n": 0}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**j and P**-j for j up to n, grown on demand and kept by the worker."""
    if _powers["n"] < n + 1:
        size = max(n + 1, 1 << 20)
        with np.errstate(over="ignore"):
            for name, base in (("p", _P), ("i", _P_INV)):
                out = np.full(size, base, U)
                out[0] = U(1)
                _powers[name] = np.multiply.accumulate(out)
        _powers["n"] = size
    return _powers["p"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_drawn = {"c": np.zeros(0, U)}


def coefficients(n: int) -> np.ndarray:
    """At least ``n`` values that look drawn at random, the same in every task; grown on demand and kept by the worker.
    Sums of values times such coefficients have no sequences that always agree, as sums
    of powers modulo 2**64 have."""
    if len(_drawn["c"]) < n:
        at = np.arange(max(n, 2 * len(_drawn["c"]), 1 << 12), dtype=U)
        with np.errstate(over="ignore"):
            _drawn["c"] = mix(mix(at + U(0x8BB84B93962EACC9)) ^ U(0x4B33A62ED433D4A3)) | U(1)
    return _drawn["c"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes any substring's hash."""
    power, _ = powers(len(data))
    out = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[:len(data)], out=out[1:])
    return out


_BYTE_VALUES = mix(mix(np.arange(256, dtype=U) + U(0x589965CC75374CC3)))


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unmixed hash of the bytes [start, end): equal bytes, equal hash, wherever they are."""
    return (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without a copy; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs


def chunks(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``size`` bytes (one longer text alone): first row, end row, bytes, offsets from 0."""
    if not len(column):
        return
    raw, offs = text_column(column)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def runs(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``mask`` that stay inside one text: start, end and text number of each."""
    n = len(mask)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(n + 1, bool)
    edge[offs[offs <= n]] = True
    before = np.zeros(n, bool)
    before[1:] = mask[:-1]
    start = np.flatnonzero(mask & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = mask[1:]
    end = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offs, start, side="right") - 1


def words(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray, lower: bool = True):
    """Words of a chunk: start, end, text number and 64-bit hash, with A-Z lower-cased if asked.

    The hash is the mixed sum of a value drawn for each byte times a coefficient drawn for its place in the word."""
    body = LOWER[data] if lower else data
    inside = is_word[data]
    start, end, doc = runs(inside, offs)
    if not len(start):
        return start, end, doc, np.zeros(0, U)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    total = np.add.reduceat(_BYTE_VALUES[body[inside]] * coefficients(int(size.max()))[place], first)
    return start, end, doc, mix(total + size.astype(U))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost position of the least value in each window of ``width`` values.

    Doubling: the winner of a window of 2k is the better of two windows of k.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best[:n]
