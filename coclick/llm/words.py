"""Vectorised word tables over Arrow text columns.

A word is a maximal run of bytes other than ``[\\x20\\x09-\\x0D]``; words never
run across documents.  All work is on the UTF-8 bytes of a slice of documents,
so memory is bounded by the slice size (one longer document is a slice alone).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Letters and digits of ASCII, and every byte of a longer character.
_TERM = np.ones(256, dtype=bool)
for _first, _last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM[_first:_last + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# polynomial hash modulo 2**64 over randomised byte values (odd base, so it has an inverse)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        step = np.full(size, base, dtype=np.uint64)
        step[0] = 1
        have = _powers[base] = np.multiply.accumulate(step)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return _flat(pc.fill_null(column.cast(pa.large_string()), ""))


def flat_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n + 1 offsets) of a binary column; null counts as empty."""
    return _flat(pc.fill_null(column.cast(pa.large_binary()), b""))


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges of at most ``limit`` bytes, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


@dataclass
class Spans:
    """Spans of bytes: start, end (exclusive); ``first[d]:first[d + 1]`` are those of document d."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def _spans(inside: np.ndarray, offsets: np.ndarray) -> Spans:
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[offsets] = True
    out = ~inside
    prev = np.empty(len(inside), dtype=bool)
    nxt = np.empty(len(inside), dtype=bool)
    prev[1:], nxt[:-1] = out[:-1], out[1:]
    start = np.flatnonzero(inside & (edge[:-1] | prev)) if len(inside) else np.zeros(0, np.int64)
    end = np.flatnonzero(inside & (edge[1:] | nxt)) + 1 if len(inside) else np.zeros(0, np.int64)
    return Spans(start, end, np.searchsorted(start, offsets))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    return _spans(~_SPACE[data], offsets)


def term_spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII."""
    return _spans(_TERM[data], offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """Non-empty lines (split at line feeds)."""
    return _spans(data != 0x0A, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return _LOWER[data]


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes (and length)."""
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, n), out=total[1:])
    h = (total[end] - total[start]) * _power(_INVERSE, n + 1)[start]
    return mix(h ^ mix((end - start).astype(np.uint64)))


def window_hash(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` words from each position on (the last size - 1 positions are cut)."""
    n = max(0, len(word) - size + 1)
    h = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + word[k:k + n]) if k % 2 else \
            h * np.uint64(0xD6E8FEB86659FD93) + word[k:k + n]
    return mix(h)
