"""Vectorised work on the UTF-8 bytes of an Arrow batch of texts (numpy, inside Spark tasks).

A batch is cut into runs of whole documents of about ``MAX_BYTES`` (a longer document is a run of its
own), so the arrays stay small.  Hashes are 64-bit polynomials over random byte values, mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MAX_BYTES = 1 << 20

_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
BYTE_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
#: ASCII punctuation but the apostrophe, which joins a contraction.
POINT = np.zeros(256, bool)
POINT[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = True

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, MAX_BYTES + 1)
        for key, base in (("up", BASE), ("down", BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[key] = np.cumprod(p)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit changes every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (row i is data[offsets[i]:offsets[i+1]]) of a string or binary column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if off is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return bytes_, offsets.astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray, max_bytes: int = MAX_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole rows of about ``max_bytes``."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


class Words:
    """Words (runs of other than space and tab..CR) of a run of documents, A-Z lower-cased; with ``parts``
    they are also cut between an ASCII letter and ASCII punctuation."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, parts: bool = False):
        self.docs = len(offsets) - 1
        self.low = LOWER[data]
        n = len(data)
        if n == 0:
            self.start = self.end = self.doc = np.empty(0, np.int64)
            self.first = np.zeros(self.docs + 1, np.int64)
            return
        inside = ~SEPARATOR[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        between = edge[1:n].copy()   # between[i]: a cut before byte i + 1
        if parts:
            letter, point = LETTER[data], POINT[data]
            between |= (letter[:-1] & point[1:]) | (point[:-1] & letter[1:])
        begins = inside.copy()
        begins[1:] &= between | ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= between | ~inside[1:]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: words of document i are first[i]:first[i+1]
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(self.docs), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        up, down = powers(len(self.low) + 1)
        sums = np.zeros(len(self.low) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[self.low] * up[:len(self.low)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start])

    def shingles(self, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first): every ``size``-word shingle in place, those of document i at
        first[i]:first[i+1]; a document with fewer words has its whole sequence as one, one without
        words has none."""
        word = self.hashes()
        counts = np.diff(self.first)
        per_doc = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
        first = np.concatenate([[0], np.cumsum(per_doc)])
        out = np.empty(first[-1], np.uint64)
        coef = powers(size + 1)[0]
        if len(word) >= size:
            total = np.zeros(len(word) - size + 1, np.uint64)
            for j in range(size):
                total += word[j:len(word) - size + 1 + j] * coef[j + 1]
            full = self.doc[size - 1:] == self.doc[:len(word) - size + 1]
            where = np.repeat(counts >= size, per_doc)
            out[where] = mix(total[full])
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            h = int(counts[i])
            for w in word[self.first[i]:self.first[i + 1]].tolist():
                h = (h * BASE + w) & 0xFFFFFFFFFFFFFFFF
            out[first[i]] = mix(np.array([h], np.uint64))[0]
        return out, first


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)


def list_array(values: np.ndarray, first: np.ndarray, type_: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and row starts."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32), pa.int32()), pa.array(values, type_))
