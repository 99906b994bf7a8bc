"""Words and shingles of Arrow text columns as 64-bit hashes, with whole-array operations.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Its hash is a
polynomial over per-byte constants; no Python object is made for a word. Batches are cut into
pieces of about ``PIECE`` bytes (one longer text makes one piece), which bounds the memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_FOLDED = np.arange(256)
_FOLDED[65:91] += 32
BYTE = mix((_FOLDED.astype(_U) + _U(1)) * _U(_BASE))
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True

_powers = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i`` for i below ``n``, modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, PIECE + 1), base, _U)
        held[0] = 1
        held = np.cumprod(held)
        if n <= 4 * PIECE:
            _powers[base] = held
    return held[:n]


def pieces(text: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each."""
    offsets = text_offsets(text)
    first, last = 0, len(text)
    while first < last:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(last, max(first + 1, end))
        yield first, end
        first = end


def text_offsets(text: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32
    return np.frombuffer(text.buffers()[1], kind)[text.offset:text.offset + len(text) + 1].astype(np.int64)


def text_bytes(text: pa.Array, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of rows ``first`` to ``end`` and their bounds within them."""
    bounds = text_offsets(text)[first:end + 1]
    held = text.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of every word, in order."""
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    inside = ~BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < n)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    total = np.zeros(n + 1, _U)
    np.cumsum(BYTE[data] * _power(_BASE, n), out=total[1:])
    hashes = mix((total[ends + 1] - total[starts]) * _power(_INVERSE, n)[starts])
    return hashes, np.searchsorted(bounds, starts, "right") - 1


def shingles(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of every run of ``width`` words; a row with fewer words has one of them all."""
    n = len(words)
    if not n:
        return words, rows
    counts = np.bincount(rows)
    out_hash, out_row = [], []
    if n >= width:
        full = np.flatnonzero(rows[width - 1:] == rows[:n - width + 1])
        total = np.zeros(len(full), _U)
        for i in range(width):
            total = mix(total * _U(_BASE) + words[full + i])
        out_hash.append(total)
        out_row.append(rows[full])
    short = (counts < width) & (counts > 0)
    if short.any():
        begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
        at = np.flatnonzero(short)
        total = counts[at].astype(_U)
        for i in range(width - 1):
            more = counts[at] > i
            total[more] = mix(total[more] * _U(_BASE) + words[begin[at[more]] + i])
        out_hash.append(total)
        out_row.append(at)
    return np.concatenate(out_hash), np.concatenate(out_row)


def distinct(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, sorted by row and hash."""
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[keep], rows[keep]
