"""Bitmaps of hashes seen once, and of hashes seen twice, built by many tasks and merged in chunks.

A filter answers "maybe" or "surely not", so it may decide what is looked at, never what is true. Its size
follows the number of hashes up to ``MAX_BITS``, which bounds what is sent to executors; beyond that it
lets more through.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS_PER_HASH = 16
MAX_BITS = 1 << 29
CHUNK_BITS = 1 << 19
HELD_HASHES = 2 << 20
CHUNK_SCHEMA = "chunk int, once binary, twice binary"
_U = np.uint64
_TYPES = (pa.int32(), pa.binary(), pa.binary())


def bits_for(count: int, limit: int = MAX_BITS, per_hash: int = BITS_PER_HASH) -> int:
    return min(limit, max(CHUNK_BITS, 1 << int(count * per_hash).bit_length()))


class Chunks:
    """Collects hashes and gives rows of packed chunks: slots hit once or more, and slots hit twice or more."""

    def __init__(self, bits: int):
        self.bits, self.held, self.count = bits, [], 0
        self.slot_type = np.int32 if bits <= 1 << 31 else np.int64

    def add(self, hashes: np.ndarray) -> list[tuple[int, bytes, bytes]]:
        self.held.append((hashes % _U(self.bits)).astype(self.slot_type))
        self.count += len(hashes)
        return self.rows() if self.count > HELD_HASHES else []

    def rows(self) -> list[tuple[int, bytes, bytes]]:
        if not self.count:
            return []
        slots = np.concatenate(self.held)
        self.held, self.count = [], 0
        slots.sort()
        new = np.ones(len(slots), bool)
        np.not_equal(slots[1:], slots[:-1], out=new[1:])
        again, slots = np.append(~new[1:], False)[new], slots[new]
        chunks = slots // CHUNK_BITS
        starts = np.flatnonzero(np.diff(chunks, prepend=-1))
        return [(int(chunks[s]), _packed(slots[s:e]), _packed(slots[s:e][again[s:e]])) for s, e in zip(starts, [*starts[1:], len(slots)])]


def _packed(slots: np.ndarray) -> bytes:
    chunk = np.zeros(CHUNK_BITS, bool)
    chunk[slots % CHUNK_BITS] = True
    return zlib.compress(np.packbits(chunk).tobytes(), 1)


OCCURRENCE_BITS = 64
HELD_OCCURRENCES = 1 << 20
_SLOT = _U(CHUNK_BITS - 1)


class Occurrences:
    """Collects hashes and gives rows of them packed by chunk, for ``Counted`` to tell which occur again, and how often.

    A hash is cut to its slot among ``bits`` and to ``extra`` more bits, so that all together ``OCCURRENCE_BITS`` values
    stand for each of ``count`` hashes: what occurs again is told from what only shares a slot. A row takes about 2.3 bytes a hash.
    """

    def __init__(self, bits: int, count: int):
        self.shift = _U(bits.bit_length() - 1)
        extra = max(0, (max(1, count) * OCCURRENCE_BITS // bits).bit_length())
        self.low, self.high = _U(bits - 1), _U((1 << min(extra, 32 - CHUNK_BITS.bit_length() + 1)) - 1)
        self.held, self.count = [], 0

    def add(self, hashes: np.ndarray) -> list[tuple[int, bytes]]:
        slots = hashes & self.low
        key = ((hashes >> self.shift) & self.high) * _U(CHUNK_BITS) | slots & _SLOT
        self.held.append((slots // _U(CHUNK_BITS)) << _U(32) | key)
        self.count += len(hashes)
        return self.rows() if self.count > HELD_OCCURRENCES else []

    def rows(self) -> list[tuple[int, bytes]]:
        if not self.count:
            return []
        together = np.concatenate(self.held)
        self.held, self.count = [], 0
        together.sort()
        keys, chunks = together.astype(np.uint32), (together >> _U(32)).astype(np.int64)
        starts = np.flatnonzero(np.diff(chunks, prepend=-1))
        return [(int(chunks[s]), packed_keys(keys[s:e])) for s, e in zip(starts, [*starts[1:], len(keys)])]


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as steps from each to the next, byte by byte of their place: the upper bytes are mostly zero."""
    return zlib.compress(np.diff(keys, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked_keys(packed: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32)


def counted(rows: list[bytes], run: int) -> tuple[bytes, bytes]:
    """Of all packed rows of a chunk: the bitmap of slots with a hash that occurs again, and the levels of how often.

    A level stands for ``run`` slots: eight times the binary logarithm of the most occurrences of a hash there.
    """
    keys = np.concatenate([unpacked_keys(r) for r in rows])
    keys.sort()
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(starts, append=len(keys))
    many = counts > 1
    slots = (keys[starts[many]] & np.uint32(CHUNK_BITS - 1)).astype(np.int64)
    again = np.zeros(CHUNK_BITS, bool)
    again[slots] = True
    levels = np.zeros(CHUNK_BITS // run, np.uint8)
    np.maximum.at(levels, slots // run, np.minimum(8 * np.log2(counts[many]), 255).astype(np.uint8))
    return zlib.compress(np.packbits(again).tobytes(), 1), zlib.compress(levels.tobytes(), 1)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], names=["chunk", "once", "twice"])


def chunk_rows(bits: int, hashes_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]):
    """A function for ``mapInArrow`` that turns a task's hashes into packed chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(bits)
        for hashes in hashes_of(batches):
            if rows := chunks.add(hashes):
                yield _batch(rows)
        yield _batch(chunks.rows())
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots hit by two tasks, or twice by one; all rows of a chunk are in one partition."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for chunk, *packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
            once, twice = (np.frombuffer(zlib.decompress(p), np.uint8) for p in packed)
            known = sums.setdefault(chunk, [np.zeros(CHUNK_BITS // 8, np.uint8), np.zeros(CHUNK_BITS // 8, np.uint8)])
            known[1] |= twice | known[0] & once
            known[0] |= once
    yield _batch([(chunk, *(zlib.compress(x.tobytes(), 1) for x in s)) for chunk, s in sums.items()])


def merged_bits(parts: DataFrame, bits: int, which: str) -> np.ndarray:
    """The merged bitmap ``once`` or ``twice``: ``bits`` long, whatever the data."""
    out = np.zeros(bits // 8, np.uint8)
    for chunk, packed in parts.repartition("chunk").mapInArrow(_merge, CHUNK_SCHEMA).select("chunk", which).toLocalIterator():
        out[chunk * CHUNK_BITS // 8:(chunk + 1) * CHUNK_BITS // 8] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return out


def contains(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = (hashes % _U(len(bitmap) * 8)).astype(np.int64)
    return (bitmap[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1
