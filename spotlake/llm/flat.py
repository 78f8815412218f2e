"""Texts of an Arrow batch as one flat byte array, with words and hashes found by numpy.

Whole texts are handled, a few megabytes at a time; only a single longer text makes a
larger piece. Nothing here loops over bytes or words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from spotlake.llm.common import ship

ship(__name__)

PIECE = 1 << 21
ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def codes(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + seed)) * ODD)


def lowering() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lowering()
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
BYTES = codes(0)


@dataclass
class Piece:
    """Rows ``first`` to ``last`` of a batch: their bytes, and where each text begins and ends."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first


def pieces(column: pa.Array | pa.ChunkedArray, limit: int = PIECE) -> Iterator[Piece]:
    """The column's texts (null: empty) in pieces of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, starts, held = column.buffers()
    offsets = np.frombuffer(starts, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Piece(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def powers(count: int, base: np.uint64) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    out = np.ones(max(count, 1), dtype=np.uint64)
    done = 1
    while done < count:
        step = min(done, count - done)
        out[done:done + step] = out[:step] * (out[done - 1:done] * base)
        done += step
    return out


class Powers:
    """Powers of BASE and of its inverse, grown on demand and kept by the worker."""

    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))

    def __init__(self):
        self.up = powers(1 << 16, BASE)
        self.down = powers(1 << 16, self.inverse)

    def grow(self, count: int) -> None:
        if len(self.up) < count:
            self.up, self.down = powers(count, BASE), powers(count, self.inverse)


POWERS = Powers()


def prefix_hashes(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """h[i] = sum of table[data[j]] * BASE**j for j < i, modulo 2**64."""
    POWERS.grow(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * POWERS.up[:len(data)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], the same wherever these bytes stand."""
    return (prefix[end] - prefix[start]) * POWERS.down[start]


@dataclass
class Words:
    """Words of a piece: hash, place in the bytes, and ``at``, the first word of each text."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray


def words(piece: Piece, lower: bool = True) -> Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of every text, A-Z in lower case if asked."""
    space = SPACES[piece.data]
    edge = np.ones(len(piece.data) + 1, dtype=bool)
    edge[:-1] = False
    edge[piece.offsets] = True
    before = np.ones(len(piece.data) + 1, dtype=bool)
    before[1:] = space
    before |= edge
    start = np.flatnonzero(~space & before[:-1])
    after = np.ones(len(piece.data) + 1, dtype=bool)
    after[:-1] = space
    after |= edge
    end = np.flatnonzero(~space & after[1:]) + 1
    table = BYTES[LOWER] if lower else BYTES
    hashes = mix(range_hashes(prefix_hashes(piece.data, table), start, end) + (end - start).astype(np.uint64) * ODD)
    return Words(hashes, start, end, np.searchsorted(start, piece.offsets))


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
