"""Numpy kernels over whole batches of texts: word and n-gram hashes, sets of them, ragged gathers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z lower-cased; the other bytes, those of longer characters among them, as they are.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of x bears on every bit of the result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


_cache: dict[int, np.ndarray] = {}


def powers(which: np.uint64, n: int) -> np.ndarray:
    have = _cache.get(int(which))
    if have is None or len(have) < n:
        have = _cache[int(which)] = _powers(which, max(n, 1 << 16))
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts in them (null: empty)."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    at = np.frombuffer(at, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and len(at) else np.zeros(0, np.uint8)
    return data, at - at[0]


#: All ASCII but letters and digits.
PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def word_spans(data: np.ndarray, at: np.ndarray, spaces: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that spaces is false for; none goes over a text's end."""
    n = len(data)
    inside = ~spaces[data]
    first = np.zeros(n + 1, dtype=bool)
    first[at] = True
    before = np.append(False, inside[:-1])
    after = np.append(inside[1:], False)
    return np.flatnonzero(inside & (~before | first[:-1])), np.flatnonzero(inside & (~after | first[1:])) + 1


def span_hashes(data: np.ndarray, *spans: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Hashes of spans of data, A-Z lower-cased: differences of running sums, brought to the same power."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * powers(_BASE, len(data)), out=total[1:])
    back = powers(_BASE_INVERSE, len(data))
    return [mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64)) for start, end in spans]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of every text, A-Z lower-cased, and n + 1 offsets of the texts in them."""
    data, at = text_bytes(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    start, end = word_spans(data, at)
    return span_hashes(data, (start, end))[0], np.searchsorted(start, at)


def shingles(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words of every text and the texts' offsets in them; of a text with fewer words, one hash
    of the whole sequence; none without words."""
    count = np.diff(at)
    out_count = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out_at = np.concatenate(([0], np.cumsum(out_count)))
    start = np.arange(out_at[-1]) + np.repeat(at[:-1] - out_at[:-1], out_count)
    length = np.repeat(np.minimum(count, n), out_count)
    h = length.astype(np.uint64)
    padded = np.concatenate((hashes, np.zeros(n, np.uint64)))
    for j in range(n):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + np.where(j < length, padded[start + j], np.uint64(0)))
    return h, out_at


def sets(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes in ascending order, and the offsets."""
    out, sizes = [], np.zeros(len(at), dtype=np.int64)
    for i in range(len(at) - 1):
        own = np.sort(h[at[i] : at[i + 1]])
        if len(own) > 1:
            keep = np.empty(len(own), dtype=bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        out.append(own)
        sizes[i + 1] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(sizes)


def runs(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of values in each run, 0 for an empty one."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[at[1:]] - total[at[:-1]]


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start:start + length] of every pair, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(start - (ends - length), length)]


def i64(x: np.ndarray) -> pa.Array:
    """uint64 hashes as Spark longs."""
    return pa.array(x.view(np.int64))
