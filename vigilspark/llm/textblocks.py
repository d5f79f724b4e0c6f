"""Whole texts as numpy blocks inside a task.

``blocks`` cuts an Arrow batch into runs of rows of a bounded number of bytes (one
row at least), without copying texts.  Words are byte ranges; hashes of any byte
range come from one prefix sum over the block, so that words, prefixes of words and
n-grams are hashed without a Python loop.  A null text counts as an empty one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
BYTE_VALUES = np.random.default_rng(20240601).integers(1, 2**64 - 1, 256, dtype=U64)
SPACES = b"\t\n\x0b\x0c\r "
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


NOT_SPACE = ~byte_set(SPACES)
#: Letters, digits and everything beyond ASCII.
ALNUM = np.array([chr(i).isalnum() if i < 128 else True for i in range(256)])


@dataclass
class Block:
    rows: pa.RecordBatch
    buf: np.ndarray      # UTF-8 bytes of all texts, end to end
    bounds: np.ndarray   # text i is buf[bounds[i]:bounds[i + 1]]

    @property
    def n(self) -> int:
        return len(self.bounds) - 1


def blocks(batch: pa.RecordBatch, text: str = "text", max_bytes: int = 1 << 20) -> Iterator[Block]:
    if batch.num_rows == 0:
        return
    column = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        bounds = offsets[at:to + 1]
        yield Block(batch.slice(at, to - at), data[bounds[0]:bounds[-1]], bounds - bounds[0])
        at = to


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=U64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any range of ``buf`` follows."""
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(BYTE_VALUES[buf] * powers(len(buf) + 1)[0][:len(buf)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray      # row of each word
    first: np.ndarray    # words of row i are first[i]:first[i + 1]


def words(block: Block, members: np.ndarray) -> Words:
    """Maximal runs of the bytes in ``members``, never across texts."""
    inside = members[block.buf]
    size = len(inside)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = block.bounds[:-1][block.bounds[:-1] < size]
    begins[cuts] = inside[cuts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = block.bounds[1:][block.bounds[1:] > 0] - 1
    ends[last] = inside[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, block.bounds)
    return Words(start, end, np.repeat(np.arange(block.n), np.diff(first)), first)


def shape_bytes(buf: np.ndarray) -> np.ndarray:
    return _SHAPE[buf]


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a"):ord("z") + 1] = ord("x")
_SHAPE[ord("A"):ord("Z") + 1] = ord("X")
_SHAPE[ord("0"):ord("9") + 1] = ord("d")
_SHAPE[128:] = ord("x")


def shape_hashes(block: Block, w: Words) -> np.ndarray:
    """Hash of each word's shape: character kinds, repeats of a kind once."""
    shape = shape_bytes(block.buf)
    keep = np.zeros(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[w.start] = True
    place = np.zeros(len(shape) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    return range_hash(prefix_sums(shape[keep]), place[w.start], place[w.end])


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U64(0xD6E8FEB86659FD93) + b)


def per_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each row's range."""
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def apart(spans: list[tuple[int, int, int]], taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans (start, kind, end) that overlap none of ``taken``, which is sorted by start."""
    starts = [t[0] for t in taken]
    reach = list(accumulate((t[2] for t in taken), max, initial=-1))   # furthest end of the first i
    return [s for s in spans if reach[bisect_left(starts, s[2])] <= s[0]]
