"""Word-shingle sets and MinHash signatures, vectorised over Arrow batches.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; a
document's set holds the 64-bit hashes of its distinct word n-grams (the whole
word sequence when it has fewer words; nothing without words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
SUB_BATCH_BYTES = 1 << 20

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "pow" not in _tables or _tables["pow"].size < n:
        size = max(n, 2 * SUB_BATCH_BYTES)
        for name, base in (("pow", _BASE), ("inv", pow(_BASE, -1, 1 << 64))):
            t = np.full(size, base, dtype=_U)
            t[0] = 1
            _tables[name] = np.multiply.accumulate(t)
    return _tables["pow"][:n], _tables["inv"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated UTF-8 bytes and the offsets of a string column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if buffers[2] is None or offsets.size == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def sub_batches(offsets: np.ndarray, limit: int = SUB_BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document stands alone."""
    i, n = 0, offsets.size - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and, per document, the place of its first word."""
    n = data.size
    if n == 0:
        return np.zeros(0, _U), np.zeros(offsets.size, np.int64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    start = ~space
    start[1:] &= space[:-1] | edge[1:n]
    stop = ~space
    stop[:-1] &= space[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    power, inverse = _powers(n)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum((_LOWER[data].astype(_U) + _U(1)) * power, out=total[1:])
    h = (total[e] - total[s]) * inverse[s]
    return mix(h + (e - s).astype(_U) * _U(0xD6E8FEB86659FD93)), np.searchsorted(s, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes in order (with repeats) and each document's first place."""
    h, at = word_hashes(data, offsets)
    words = np.diff(at)
    count = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    odd = [_U((0x2545F4914F6CDD1D * (2 * j + 3)) % (1 << 64) | 1) for j in range(k)]
    out = np.zeros(int(first[-1]), dtype=_U)
    if h.size >= k:
        rolled = h[: h.size - k + 1] * odd[0]
        for j in range(1, k):
            rolled = rolled + h[j: h.size - k + 1 + j] * odd[j]
        doc = np.repeat(np.arange(words.size), words)[: rolled.size]
        inside = np.arange(rolled.size) + k <= at[1:][doc]
        out[np.repeat(words >= k, count)] = rolled[inside]
    for d in np.flatnonzero((words > 0) & (words < k)):
        w = h[at[d]:at[d + 1]]
        out[first[d]] = _U(sum(int(x) * int(odd[j]) for j, x in enumerate(w)) + 977 * len(w) & (2**64 - 1))
    return mix(out), first


def sets(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every document."""
    h, first = shingles(data, offsets, k)
    return [np.unique(h[first[d]:first[d + 1]]) for d in range(first.size - 1)]


def signature_seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=_U) * _U(0xA0761D6478BD642F))
    return x[:n], x[n:] | _U(1)


def signatures(parts: list[np.ndarray], n: int) -> np.ndarray:
    """MinHash signatures (documents x n, uint32); all ones for an empty set."""
    out = np.full((len(parts), n), 0xFFFFFFFF, dtype=np.uint32)
    rows = [i for i, p in enumerate(parts) if p.size]
    if rows:
        joined = np.concatenate([parts[i] for i in rows])
        first = np.concatenate([[0], np.cumsum([parts[i].size for i in rows])[:-1]])
        xor, mul = signature_seeds(n)
        for j in range(n):
            out[rows, j] = np.minimum.reduceat(((joined ^ xor[j]) * mul[j]) >> _U(32), first).astype(np.uint32)
    return out
