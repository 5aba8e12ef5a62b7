"""Runs of windows that share an anchor, and a count-min sketch over the anchors.

Both exact-substring operators look for sequences of ``length`` symbols (words or bytes) that
occur more than once. The *anchor* of a window is the smallest hash among the ``gram``-symbol
sequences inside it, so equal windows have equal anchors; a *piece* is a maximal run of
consecutive windows of a document with the same anchor. A count-min sketch over the anchors
overestimates how often each window occurs: a window whose anchor is estimated at one cannot
repeat. Pieces are about (length - gram) / 2 times fewer than windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so invertible modulo 2**64
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept per process, grown on need)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b, dtype=_U)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=_U))
        have = _powers[base] = (tables[0], tables[1])
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over all 64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Hashes of any range of a symbol sequence from prefix sums."""

    def __init__(self, symbols: np.ndarray, which: int = 0):
        n = len(symbols)
        power, self.inverse = _power_tables(_BASES[which], n + 1)
        self.prefix = np.zeros(n + 1, dtype=_U)
        np.cumsum(symbols * power[:n], out=self.prefix[1:])

    def fixed(self, width: int) -> np.ndarray:
        """Of every range of ``width`` symbols."""
        m = len(self.prefix) - width
        if m <= 0:
            return np.empty(0, dtype=_U)
        return mix((self.prefix[width:] - self.prefix[:m]) * self.inverse[:m])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(((self.prefix[end] - self.prefix[start]) * self.inverse[start]) ^ mix((end - start).astype(_U)))


def sliding(a: np.ndarray, width: int, op: Callable) -> np.ndarray:
    """op over every ``width`` consecutive values, by doubling: log2(width) passes."""
    have, out = 1, a
    while have < width:
        step = min(have, width - have)
        out = op(out[: len(out) - step], out[step:])
        have += step
    return out


@dataclass
class Pieces:
    """Arrays over the pieces of a slice. start: index of the first window; count: windows; anchor: the shared hash;
    row: the text's number in the slice; again: its windows may repeat among themselves. site_row, site_anchor: of every selected
    gram position (what the sketch counts)."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    row: np.ndarray
    again: np.ndarray
    site_row: np.ndarray
    site_anchor: np.ndarray
    rolling: Rolling


def find_pieces(symbols: np.ndarray, ends: np.ndarray, length: int, gram: int) -> Pieces | None:
    """Pieces of the concatenated sequences that end at ``ends``; None if no sequence is as long as a window."""
    n, width = len(symbols), length - gram + 1
    if n < length:
        return None
    lens = np.diff(ends, prepend=0)
    starts = ends - lens
    edge = np.zeros(n + 1, dtype=np.int32)  # +1 where windows begin to be possible, -1 behind the last
    fits = lens >= length
    if not fits.any():
        return None
    np.add.at(edge, starts[fits], 1)
    np.add.at(edge, ends[fits] - length + 1, -1)
    valid = np.cumsum(edge[: n - length + 1]) > 0
    rolling = Rolling(symbols)
    grams = rolling.fixed(gram)
    low = sliding(grams, width, np.minimum)  # of every window
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (low[1:] != low[:-1])
    start = np.flatnonzero(first)
    stop = np.append(start[1:], len(valid))
    last = np.append(np.flatnonzero(valid[:-1] & ~valid[1:]) + 1, len(valid)) if len(valid) else start
    stop = np.minimum(stop, last[np.searchsorted(last, start, side="right")])
    # a gram is selected if it is the smallest of some valid window that holds it
    masked = np.where(valid, low, _U(0))
    padded = np.concatenate((np.zeros(width - 1, dtype=_U), masked, np.zeros(width - 1, dtype=_U)))
    site = np.flatnonzero((sliding(padded, width, np.maximum) == grams) & (grams != 0))
    at = lambda p: np.searchsorted(ends, p, side="right")
    # a window can repeat inside its piece only if a selected gram comes again within a window's length
    order = np.lexsort((site, grams[site]))
    near = (np.diff(grams[site][order]) == 0) & (np.diff(site[order]) < 2 * length)
    twice = np.sort(site[order][:-1][near])
    again = (stop - start > width) | (np.searchsorted(twice, start) < np.searchsorted(twice, stop + width))
    return Pieces(start, stop - start, low[start], at(start), again, at(site), grams[site], rolling)


# ---- the sketch -------------------------------------------------------------------------------

DEPTH, BLOCK = 3, 1 << 16
MIN_WIDTH, MAX_WIDTH = 1 << 16, 1 << 25  # cells a row: 3 x 32 MB in a task at most, 12 MB as broadcast bits


def sketch_width(expected: float) -> int:
    """Cells a row: twice the expected number of anchors or more, as a power of two within the bounds. A full sketch loses nothing,
    it only lets more windows through to the exact pass."""
    return min(MAX_WIDTH, max(MIN_WIDTH, 1 << max(0, int(2 * expected) - 1).bit_length()))


def _cells(anchor: np.ndarray, width: int) -> list[np.ndarray]:
    a, b = mix(anchor ^ _U(0x5851F42D4C957F2D)), mix(anchor + _U(0x14057B7EF767814F)) | _U(1)
    return [((a + _U(r) * b) >> _U(20)) & _U(width - 1) for r in range(DEPTH)]


def build_sketch(texts: DataFrame, anchors_of: Callable[[pa.RecordBatch], np.ndarray], slicer: Callable, width: int, least: int = 2) -> np.ndarray:
    """Merged count-min sketch of all rows, as bits: cell counted ``least`` times (1 or 2) or more. Each partition fills a sketch of its own and
    hands out its non-empty blocks compressed; blocks are dealt by number and added up one by one, so that a task
    holds its blocks only. The driver receives depth x width bits (12 MB at most)."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((DEPTH, width), dtype=np.uint8)
        for b in slicer(batches):
            anchors = anchors_of(b)
            for r, idx in enumerate(_cells(anchors, width) if len(anchors) else ()):
                at, times = np.unique(idx, return_counts=True)
                cells[r][at] = np.minimum(cells[r][at] + np.minimum(times, 2), 2)
        flat, squeeze = cells.reshape(-1, BLOCK), zstandard.ZstdCompressor(level=1)
        some = np.flatnonzero(flat.any(axis=1))
        for part in np.array_split(some, max(1, len(some) // 256)):
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array([squeeze.compress(flat[i].tobytes()) for i in part], pa.binary())], ["block", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            for block, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                add = np.frombuffer(open_.decompress(cells), dtype=np.uint8)
                total[block] = np.minimum(total[block] + add, 2) if block in total else add
        if total:
            bits = [squeeze_bits(total[k]) for k in total]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(bits, pa.binary())], ["block", "cells"])

    def squeeze_bits(cells: np.ndarray) -> bytes:
        return np.packbits(cells >= least).tobytes()

    filled = texts.mapInArrow(fill, "block int, cells binary")
    blocks = DEPTH * width // BLOCK
    merged = filled.repartition(min(64, blocks), "block").mapInArrow(merge, "block int, cells binary")
    out = np.zeros((blocks, BLOCK // 8), dtype=np.uint8)
    for row in merged.where(F.col("block").isNotNull()).toLocalIterator():
        out[row.block] = np.frombuffer(row.cells, dtype=np.uint8)
    return out.reshape(DEPTH, width // 8)


def repeated(bits: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Whether the sketch estimates each anchor at ``least`` or more."""
    out = np.ones(len(anchor), dtype=bool)
    for r, idx in enumerate(_cells(anchor, bits.shape[1] * 8)):
        out &= (bits[r][(idx >> _U(3)).astype(np.int64)] >> (7 - (idx & _U(7))).astype(np.uint8)) & 1 > 0
    return out
