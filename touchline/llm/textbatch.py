"""Vectorised words of a whole Arrow column: no Python object per word.

A word is a maximal run of kept bytes of the UTF-8 text; A-Z count as a-z. Its
64-bit hash is a polynomial over per-byte values, taken with one ``reduceat``
for all words, then mixed. Equal words have equal hashes everywhere; two
different words agree with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 21  # bytes hashed at once
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shift-multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers, the same in every process."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


def byte_values(separators: bytes) -> np.ndarray:
    """Hash value of each byte: 0 for separators, A-Z as a-z."""
    v = constants(256, 17)
    v[65:91] = v[97:123]
    v[list(separators)] = 0
    return v


#: Words as runs of anything but the space and 0x09-0x0D.
SPACED = byte_values(bytes([0x20, *range(0x09, 0x0E)]))
#: Words as runs of letters and digits, every non-ASCII character kept.
ALNUM = byte_values(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

_R = _U(0xD1342543DE82EF95)
_R_INV = _U(pow(0xD1342543DE82EF95, -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    fwd, inv = np.full(n, _R, _U), np.full(n, _R_INV, _U)
    fwd[0] = inv[0] = 1
    return np.multiply.accumulate(fwd), np.multiply.accumulate(inv)


class Hasher:
    """Words of text columns under one byte table."""

    def __init__(self, values: np.ndarray, prefixes: tuple[int, ...] = ()):
        self.values, self.prefixes = values, prefixes
        self.fwd, self.inv = powers(1 << 16)

    def words(self, data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Hashes of all words in order, the offsets of each document's words,
        and for every prefix length the hashes of the words' first bytes (0
        where a word is not longer)."""
        found: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []
        at, n = 0, len(data)
        while at < n:
            end = min(at + PIECE, n)
            if end < n:  # cut at a separator or between documents
                cut = docs[np.searchsorted(docs, end, "right") - 1]
                if cut <= at:
                    gap = np.flatnonzero(self.values[data[at:end]] == 0)
                    if len(gap):
                        cut = at + gap[-1] + 1
                    else:  # a word longer than a piece
                        rest = np.flatnonzero(self.values[data[end:]] == 0)
                        nxt = docs[np.searchsorted(docs, at, "right")]
                        cut = min(end + rest[0] + 1 if len(rest) else n, nxt)
                end = int(cut)
            found.append(self._piece(data[at:end], at, docs))
            at = end
        if not found:
            return np.empty(0, _U), np.zeros(len(docs), np.int64), [np.empty(0, _U) for _ in self.prefixes]
        h = np.concatenate([x[0] for x in found])
        starts = np.concatenate([x[1] for x in found])
        return h, np.searchsorted(starts, docs), [np.concatenate([x[2][i] for x in found]) for i in range(len(self.prefixes))]

    def _piece(self, data, base, docs):
        if len(data) > len(self.fwd):
            self.fwd, self.inv = powers(max(PIECE, len(data)))
        v = self.values[data]
        keep = v != 0
        first, last = keep.copy(), keep.copy()
        first[1:] &= ~keep[:-1]
        last[:-1] &= ~keep[1:]
        lo, hi = np.searchsorted(docs, base), np.searchsorted(docs, base + len(data))
        edge = docs[lo:hi] - base
        first[edge] = keep[edge]
        edge = edge[edge > 0] - 1
        last[edge] = keep[edge]
        s = np.flatnonzero(first)
        if not len(s):
            return np.empty(0, _U), np.empty(0, np.int64), [np.empty(0, _U) for _ in self.prefixes]
        length = np.flatnonzero(last) + 1 - s
        with np.errstate(over="ignore"):
            v *= self.fwd[: len(v)]
            back = self.inv[s]
            h = mix(np.add.reduceat(v, s) * back + length.astype(_U))
            more = []
            if self.prefixes:
                total = np.concatenate([np.zeros(1, _U), np.cumsum(v, dtype=_U)])
                for k in self.prefixes:
                    long = length > k
                    p = np.zeros(len(s), _U)
                    p[long] = mix((total[s[long] + k] - total[s[long]]) * back[long] + _U(1000 + k))
                    more.append(p)
        return h, s + base, more


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with up to ``most`` bytes of text, a longer text alone."""
    if not batch.num_rows:
        return
    _, off = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def grams(h: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a document, their offsets per
    document, and the index of each run's first word."""
    count = np.maximum(np.diff(off) - k + 1, 0)
    goff = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
    first = np.repeat(off[:-1] - goff[:-1], count) + np.arange(goff[-1])
    if not len(first):
        return np.empty(0, _U), goff, first
    c = constants(k, 7000 + k)
    with np.errstate(over="ignore"):
        n = len(h) - k + 1
        g = h[:n] * c[0]
        for j in range(1, k):
            g += h[j : j + n] * c[j]
        g = mix(g)
    return (g if len(first) == n else g[first]), goff, first


def doc_index(off: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def list_column(values: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(values, kind))
