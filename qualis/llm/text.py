"""Columnar text helpers shared by the operators of this subpackage.

Everything works on the UTF-8 buffer of an Arrow string column with numpy, so
no Python object is made per word.  A *word* is a maximal run of bytes outside
0x20 and 0x09-0x0D; documents never share a word.  Work is cut into slices of
bounded size (``SLICE`` bytes), and one very long text is itself hashed in
pieces that end at white space, so memory does not follow the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE = 1 << 20  # bytes of text that are hashed at once
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POW: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
PLAIN = np.arange(256, dtype=np.uint8)
LOWER = PLAIN.copy()
LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """splitmix64 finaliser of ``x + seed * golden`` (vectorised)."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i mod 2^64 for i < n."""
    if len(_POW[0]) < n:
        n = max(n, SLICE + 1)
        for k, b in ((0, _BASE), (1, _INV)):
            p = np.full(n, b, U)
            p[0] = 1
            _POW[k] = np.multiply.accumulate(p)
    return _POW[0][:n], _POW[1][:n]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null has length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, off, data = column.buffers()
    offs = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, limit: int = SLICE):
    """Row ranges whose texts hold at most ``limit`` bytes together (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def spans(raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the runs of bytes outside ``breaks``; documents bound runs."""
    inside = ~breaks[raw]
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    o = offsets[1:-1]
    o = o[(o > 0) & (o < len(raw))]
    first[o] = inside[o]
    last[o - 1] = inside[o - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = PLAIN) -> np.ndarray:
    """64-bit hash of each byte run (after the byte map ``table``)."""
    p, q = powers(len(raw) + 1)
    h = np.zeros(len(raw) + 1, U)
    np.cumsum((table.astype(U) + U(1))[raw] * p[:len(raw)], out=h[1:])
    return mix((h[ends] - h[starts]) * q[starts] + (ends - starts).astype(U))


def word_hashes(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and offsets of each document's words in them."""
    parts, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for i, j in slices(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        if j == i + 1 and hi - lo > SLICE:  # one long text: pieces that end at white space
            while lo < hi:
                end = min(hi, lo + SLICE)
                if end < hi:
                    gaps = np.flatnonzero(SPACE[raw[lo:end]])
                    while not len(gaps) and end < hi:
                        end = min(hi, end + SLICE)
                        gaps = np.flatnonzero(SPACE[raw[lo:end]])
                    if end < hi or (len(gaps) and end - lo > SLICE):
                        end = lo + int(gaps[-1]) + 1
                piece = raw[lo:end]
                s, e = spans(piece, np.array([0, len(piece)]))
                parts.append(span_hash(piece, s, e, table))
                counts[i] += len(s)
                lo = end
        else:
            piece, o = raw[lo:hi], offsets[i:j + 1] - lo
            s, e = spans(piece, o)
            parts.append(span_hash(piece, s, e, table))
            counts[i:j] = np.diff(np.searchsorted(s, o))
    return (np.concatenate(parts) if parts else np.zeros(0, U)), np.concatenate([[0], np.cumsum(counts)])


def shingles(words: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and their offsets by document; a document of
    1 to k-1 words has its whole sequence as its only shingle."""
    n, size = len(words), np.diff(offsets)
    counts = np.where(size >= k, size - k + 1, np.minimum(size, 1))
    out_off = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(int(out_off[-1]), U)
    if not n:
        return out, out_off
    weights = mix(np.arange(k, dtype=U), 77) | U(1)
    if n >= k:
        roll = np.zeros(n - k + 1, U)
        for t in range(k):
            roll += words[t:n - k + 1 + t] * weights[t]
        long = np.flatnonzero(size >= k)
        ok = np.zeros(n, bool)
        ok[ranges(offsets[long], counts[long])] = True
        put = np.zeros(len(out), bool)
        put[ranges(out_off[long], counts[long])] = True
        out[put] = mix(roll[ok[:len(roll)]])
    short = np.flatnonzero((size > 0) & (size < k))
    if len(short):
        acc = np.zeros(len(short), U)
        for t in range(k - 1):
            has = size[short] > t
            acc[has] += words[offsets[short[has]] + t] * weights[t]
        out[out_off[short]] = mix(acc + size[short].astype(U) * weights[k - 1], 5)
    return out, out_off


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + count)."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def owners(offsets: np.ndarray) -> np.ndarray:
    """Row number of every element of a ragged array."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row of a ragged array."""
    v = values.copy()
    for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if j - i > 1:
            v[i:j].sort()
    keep = np.ones(len(v), bool)
    keep[1:] = v[1:] != v[:-1]
    keep[offsets[:-1][offsets[:-1] < len(v)]] = True
    return v[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row of a ragged array (any number type, wraps for unsigned)."""
    acc = np.zeros(len(values) + 1, values.dtype if values.dtype.kind in "uf" else np.int64)
    np.cumsum(values, out=acc[1:])
    return acc[offsets[1:]] - acc[offsets[:-1]]


def shingle_sets(column, k: int = 5, table: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text of an Arrow string column."""
    raw, off = utf8(column)
    return distinct(*shingles(*word_hashes(raw, off, table), k))
