"""Texts of an Arrow batch as one byte array, and vectorised words and hashes over it.

Used inside Spark tasks. Everything works on whole texts; a batch is taken in
chunks of a few megabytes (a single longer text is a chunk of its own), which
bounds the memory of a task whatever the number of rows in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_rng = np.random.RandomState(20240607)
#: A random 64-bit value for each byte.
TABLE = (_rng.randint(0, 1 << 32, 256).astype(_U) << _U(32)) | _rng.randint(0, 1 << 32, 256).astype(_U)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        size = max(n + 1, CHUNK + 1)
        have = np.full(size, base, dtype=_U)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; a one-to-one map."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def byte_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes and the n + 1 offsets between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes each."""
    at, n = 0, len(offs) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, to
        at = to


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the n + 1 indices of each text's first word."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = ~SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def prefix_hash(data: np.ndarray, table: np.ndarray = TABLE) -> np.ndarray:
    """Running sums from which ``span_hash`` takes the hash of any span."""
    out = np.empty(len(data) + 1, _U)
    out[0] = 0
    np.cumsum(table[data] * powers(pow(_BASE | 1, -1, 1 << 64), len(data))[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, the same wherever they stand."""
    return mix64((prefix[ends] - prefix[starts]) * powers(_BASE | 1, len(prefix))[starts])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def run_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values, in order; len - k + 1 of them."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for i in range(k):
        out *= _U(_BASE | 1)
        out += mix64(hashes[i:i + n])
    return mix64(out)


def window_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Word indices at which k words of the same text begin; ``first`` as of ``word_bounds``."""
    n = int(first[-1]) if len(first) else 0
    if n < k:
        return np.zeros(0, np.int64)
    ok = np.zeros(n + 1, np.int32)
    begin, end = first[:-1], np.maximum(first[1:] - k + 1, first[:-1])
    np.add.at(ok, begin, 1)
    np.add.at(ok, end, -1)
    return np.flatnonzero(np.cumsum(ok[:n]) > 0)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values; len - w + 1 of them. Doubles the width, so about log2(w) passes."""
    if len(x) < w:
        return x[:0]
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space after each, and where they start and end there."""
    size = ends - starts
    to = np.cumsum(size + 1)
    begin = to - size - 1
    out = np.full(int(to[-1]) if len(to) else 0, 32, np.uint8)
    shift = np.repeat(begin - starts, size)
    source = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - starts, size)
    out[source + shift] = data[source]
    return out, begin, to - 1


def spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all spans one after the other, and the n + 1 offsets between them."""
    size = end - begin
    offs = np.concatenate([[0], np.cumsum(size)])
    return data[np.arange(int(offs[-1])) + np.repeat(begin - offs[:-1], size)], offs


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of a sorted array, and the bounds of each one's run."""
    if not len(values):
        return values, np.zeros(1, np.int64)
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[at], np.append(at, len(values))


def run_prefix(values: np.ndarray) -> np.ndarray:
    """``prefix_hash`` for 64-bit values in place of bytes; ``span_hash`` takes runs of them."""
    out = np.empty(len(values) + 1, _U)
    out[0] = 0
    np.cumsum(values * powers(pow(_BASE | 1, -1, 1 << 64), len(values))[:len(values)], out=out[1:])
    return out


def equal_groups(hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorts spans into groups of equal bytes: their order, the groups' bounds in it, and sizes.

    Sorted by hash first; spans of one hash are then compared byte by byte, and
    the groups split where a hash stands for different bytes.
    """
    order = np.argsort(hashes, kind="stable")
    if not len(order):
        return order, np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = hashes[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    a, b = begin[order], end[order]
    again = np.flatnonzero(~new)
    if len(again):
        buf = memoryview(data)
        differs = [i for i, w, x, y, z in zip(again.tolist(), a[again - 1].tolist(), b[again - 1].tolist(),
                                              a[again].tolist(), b[again].tolist(), strict=True) if buf[w:x] != buf[y:z]]
        for group in np.unique(np.cumsum(new)[differs]).tolist() if differs else []:
            at = np.flatnonzero(np.cumsum(new) == group)
            raw = [bytes(buf[x:y]) for x, y in zip(a[at].tolist(), b[at].tolist(), strict=True)]
            by = sorted(range(len(at)), key=lambda i: raw[i])  # noqa: B023
            order[at] = order[at][by]
            new[at] = [j == 0 or raw[by[j]] != raw[by[j - 1]] for j in range(len(at))]
    at = np.flatnonzero(new)
    return order, at, np.diff(np.concatenate([at, [len(order)]]))
