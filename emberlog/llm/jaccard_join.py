"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

1. Documents with equal shingle sets form a class; all later work is on classes, so copies cost nothing.
   The same pass counts shingles over all documents: a filter tells those that surely occur once, a
   sketch of fixed size how frequent the others are.
2. A set is ordered rarest first by (once, sketch count, hash). Two sets that reach the threshold share a
   shingle in their prefixes; prefixes meet in lists, one per shingle, of which single entries, and
   members that no other's length and place allow, go. A shingle that surely occurs once has no list.
3. Each list first proposes only pairs with its first class, after length and positional filters. They are
   verified once each, and linked classes become components.
4. Lists whose classes are then still in more than one component are checked whole, but for members
   without a possible partner in another component, in cells of bounded size: every pair that passes length, positional and suffix filters, and that has this list's
   shingle as its first common one, is verified there by the exact overlap. A cell returns a spanning
   forest of its links, never all pairs.
5. Components of both kinds of links are the result.

``links`` and ``link_counts`` leave out steps 3 and 4: they check every list whole, so that each pair of
classes is verified in its first common list, and no link inside a component is left out.

No true link between different components is lost: its pair shares a list, and step 4 checks that list.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing.
A text with fewer than ``k`` words has one shingle, its whole sequence. A null id is its own component
only if its class has no other id. Repeated rows are copies. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.bit_filter import CHUNK_BITS, CHUNK_SCHEMA, Occurrences, bits_for, chunk_rows, contains, counted, merged_bits
from emberlog.llm.blocks import free_unused, small_batches, text_blocks
from emberlog.llm.components import components
from emberlog.llm.hashing import mixed, shingle_sets
from emberlog.session import stored

SKETCH_BITS = 24
FIRST_ROW = 1 << 40
TEXT_BYTES = 1 << 18
CELL_CLASSES = 512
WHOLE_LIST = 2048
VIABLE_ROWS = 64
CELL_BYTES = 1 << 20
BROADCAST_ROWS = 100_000
SUFFIX_PARTS = 16
_U = np.uint64


def class_of(shingles: np.ndarray) -> bytes:
    """128-bit fingerprint of a set."""
    parts = (mixed(shingles ^ _U(salt)).sum(dtype=_U) for salt in (0x243F6A8885A308D3, 0x13198A2E03707344))
    return b"".join(int(p).to_bytes(8, "big") for p in parts)


def _classes_and_hashes(k: int, id_type: pa.DataType, bits: int, count: int):
    """Rows (doc_id, tag, n, class) of all documents, each a part of its own, and the task's shingles packed by chunk."""
    names = ["doc_id", "tag", "n", "class", "part", "packed"]

    def chunks(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        nothing = [pa.nulls(len(rows), t) for t in (id_type, pa.int64(), pa.int32(), pa.binary())]
        return pa.RecordBatch.from_arrays([*nothing, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_unused()
        seen, number = Occurrences(bits, count), FIRST_ROW
        for block in text_blocks(batches, "text", TEXT_BYTES):
            sets = shingle_sets(block.column("text"), k)
            if sets and (rows := seen.add(np.concatenate(sets))):
                yield chunks(rows)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("tag"), pa.array([len(s) for s in sets], pa.int32()), pa.array([class_of(s) for s in sets], pa.binary()),
                                              pa.array(np.arange(number, number + len(sets))), pa.nulls(len(sets), pa.binary())], names=names)
            number += len(sets)
        yield chunks(seen.rows())
    return run


def _counted_chunks(id_type: pa.DataType, run_of_level: int):
    """Of rows sorted by part: each chunk's filter of repeated shingles and their levels; the rows of documents as they are."""
    names = ["doc_id", "tag", "n", "class", "part", "repeated", "levels"]

    def chunk(part: int, rows: list[bytes]) -> pa.RecordBatch:
        nothing = [pa.nulls(1, t) for t in (id_type, pa.int64(), pa.int32(), pa.binary())]
        return pa.RecordBatch.from_arrays([*nothing, pa.array([part], pa.int64()), *(pa.array([x], pa.binary()) for x in counted(rows, run_of_level))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            parts = batch.column("part").to_numpy()
            edge = int(np.searchsorted(parts, FIRST_ROW))
            for part, packed in zip(parts[:edge].tolist(), batch.column("packed").slice(0, edge).to_pylist()):
                if held and part != last:
                    yield chunk(last, held)
                    held = []
                last = part
                held.append(packed)
            rest = batch.slice(edge)
            yield pa.RecordBatch.from_arrays([*(rest.column(c) for c in names[:5]), pa.nulls(len(rest), pa.binary()), pa.nulls(len(rest), pa.binary())], names=names)
        if held:
            yield chunk(last, held)
    return run


class Order:
    """The global order of shingles: those that surely occur once, then by the level of how often, then by hash."""

    def __init__(self, sketch: np.ndarray, repeated: np.ndarray):
        self.sketch, self.repeated = sketch, repeated
        self.run = max(1, len(repeated) * 8 // len(sketch))

    def rare_first(self, shingles: np.ndarray) -> tuple[np.ndarray, int]:
        """The set, sorted by hash, in the global order; and how many of it surely occur once."""
        many = contains(self.repeated, shingles)
        slots = (shingles % _U(len(self.repeated) * 8)).astype(np.int64)
        rank = np.where(many, self.sketch[slots // self.run].astype(np.int64) + 1, 0)
        return shingles[np.argsort(rank, kind="stable")], len(many) - int(many.sum())


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of sets of ``n`` and ``m`` that reaches the threshold."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(k: int, percent: int, shared):
    """(shingle, class, n, pos) of every prefix shingle, once per class and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_unused()
        done: set[bytes] = set()
        for block in text_blocks(batches, "text", TEXT_BYTES):
            rows, names = [], []
            for shingles in shingle_sets(block.column("text"), k):
                name = class_of(shingles)
                if not len(shingles) or name in done:
                    continue
                if len(done) > 200_000:
                    done.clear()  # later copies are only repeated rows
                done.add(name)
                length = prefix_length(len(shingles), percent)
                ordered, single = shared.value.rare_first(shingles)
                if single < length:
                    rows.append((ordered[single:length], len(shingles), single))
                    names.append(name)
            sizes = [len(r[0]) for r in rows]
            if rows:
                first = np.concatenate([r[0] for r in rows]).view(np.int64)
                place = np.concatenate([np.arange(r[2], r[2] + s, dtype=np.int32) for r, s in zip(rows, sizes)])
                which = pa.array(np.repeat(np.arange(len(rows)), sizes))
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(names, pa.binary()).take(which), pa.array(np.repeat([r[1] for r in rows], sizes).astype(np.int32)), pa.array(place)],
                                                 names=["shingle", "class", "n", "pos"])
    return run


def groups(batches: Iterator[pa.RecordBatch], keys: list[str], at_most: int | None = None) -> Iterator[pa.Table]:
    """Tables of equal ``keys`` from batches sorted by them; one group is held, of a longer one about ``at_most`` rows at a time."""
    open_rows: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(batch)]):
            key = tuple(v[start] for v in values)
            if last is not None and (key != last or at_most and sum(map(len, open_rows)) > at_most):
                yield pa.Table.from_batches(open_rows)
                open_rows = []
            open_rows.append(batch.slice(start, end - start))
            last = key
    if open_rows:
        yield pa.Table.from_batches(open_rows)


def _first_pairs(percent: int):
    """From lists sorted by (shingle, class): pairs of each class with the list's first, if size and place allow it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            found = []
            for shingle, name, n, pos in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if head is None or head[0] != shingle:
                    head = (shingle, name, n, pos)
                elif name != head[1]:
                    need = least_overlap(n, head[2], percent)
                    if 100 * min(n, head[2]) >= percent * max(n, head[2]) and min(n - pos, head[2] - head[3]) >= need:
                        found.append((head[1], name))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.binary()) for i in range(2)], names=["a", "b"])
    return run


def viable(n: np.ndarray, pos: np.ndarray, percent: int, component: np.ndarray | None = None) -> np.ndarray:
    """Which members of a list have a partner in it, of another component, that length and place of the shared shingle allow.

    Members go by length, so those whose length fits one of them are neighbours; a few members are compared at a time.
    """
    order = np.argsort(n, kind="stable")
    n, rest = n[order], (n - pos)[order]
    component = None if component is None else component[order]
    # lengths that reach the threshold with each member's: percent * larger <= 100 * smaller
    low = np.searchsorted(n, -(-percent * n // 100), side="left")
    high = np.searchsorted(n, 100 * n // percent, side="right")
    found = np.zeros(len(n), bool)
    for start in range(0, len(n), VIABLE_ROWS):
        end = min(start + VIABLE_ROWS, len(n))
        at, to = np.arange(start, end), np.arange(low[start], high[end - 1])
        fits = np.minimum(rest[at][:, None], rest[to]) >= least_overlap(n[at][:, None], n[to], percent)
        fits &= (to >= low[at][:, None]) & (to < high[at][:, None]) & (to != at[:, None])
        if component is not None:
            fits &= component[at][:, None] != component[to]
        found[at] = fits.any(1)
    out = np.empty(len(n), bool)
    out[order] = found
    return out


def _lists(percent: int):
    """Of rows sorted by (shingle, class): one row per class, of the lists and members that can give a pair.

    A list of more than ``WHOLE_LIST`` members is passed on whole, row by row, without being held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        long_list = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            shingle = rows["shingle"].to_numpy()
            last = int(np.searchsorted(shingle, shingle[-1])) if len(shingle) else 0
            if len(shingle) - last > WHOLE_LIST:
                long_list, last = shingle[-1], len(shingle)
            yield from _viable_rows(rows.slice(0, last), percent, long_list)
            held = rows.slice(last)
        if held is not None:
            yield from _viable_rows(held, percent, long_list)
    return run


def _viable_rows(rows: pa.Table, percent: int, long_list: int | None) -> Iterator[pa.RecordBatch]:
    rows = rows.combine_chunks()
    if not len(rows):
        return
    shingle, n, pos = rows["shingle"].to_numpy(), rows["n"].to_numpy().astype(np.int64), rows["pos"].to_numpy().astype(np.int64)
    names = np.frombuffer(b"".join(rows["class"].to_pylist()), np.uint64).reshape(-1, 2)
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (names[1:] != names[:-1]).any(1)
    at = np.flatnonzero(new)
    starts = np.flatnonzero(np.diff(shingle[at], prepend=shingle[0] ^ 1))
    sizes = np.diff(starts, append=len(at))
    keep = np.zeros(len(at), bool)
    two = starts[sizes == 2]
    if len(two):
        i, j = at[two], at[two + 1]
        fine = (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= least_overlap(n[i], n[j], percent)) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
        keep[two[fine]] = keep[two[fine] + 1] = True
    for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
        inside = at[start:start + size]
        keep[start:start + size] = viable(n[inside], pos[inside], percent) if size <= WHOLE_LIST else True
    if long_list is not None:
        keep |= shingle[at] == long_list
    yield from rows.take(pa.array(at[keep])).to_batches()


def _ordered_sets(k: int, order, chosen):
    """(class, shingles in global order) of the documents whose key passes the filter of chosen ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_unused()
        for block in text_blocks(batches, "text", TEXT_BYTES):
            block = block.filter(pa.array(contains(chosen.value, block.column("key").to_numpy().view(_U))))
            found = [(class_of(s), order.value.rare_first(s)[0].tobytes()) for s in shingle_sets(block.column("text"), k)]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.binary()) for i in range(2)], names=["class", "shingles"])
    return run


def _other_components(percent: int):
    """Of lists sorted by (shingle, class): members with a possible partner in another component; long lists as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["shingle"], WHOLE_LIST):
            keep = np.ones(len(rows), bool)
            if len(rows) <= WHOLE_LIST and rows["whole"][0].as_py():
                n, pos = rows["n"].to_numpy().astype(np.int64), rows["pos"].to_numpy().astype(np.int64)
                keep = viable(n, pos, percent, np.unique(rows["component"].to_pylist(), return_inverse=True)[1])
            yield from rows.filter(pa.array(keep)).to_batches()
    return run


def signature(shingles: np.ndarray) -> bytes:
    """Whether the shingles in each slot are odd in number, of as many slots as shingles, up to a power of two.

    Two sets differ in at least as many shingles as their signatures in bits, once the longer one is folded.
    """
    slots = max(64, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & _U(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [signature(np.frombuffer(s, _U)) for s in batch.column("shingles").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(found, pa.binary())], names=["class", "signature"])


def possible_partners(n: np.ndarray, pos: np.ndarray, component: np.ndarray, signatures: list[bytes], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Which members of a cell have a partner of another component that length, place and signatures allow; with ``side``, across sides only."""
    need = least_overlap(n[:, None], n[None, :], percent)
    fits = 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
    fits &= np.minimum((n - pos)[:, None], (n - pos)[None, :]) >= need
    fits &= component[:, None] != component[None, :]
    if side is not None:
        fits &= side[:, None] != side[None, :]
    at, to = np.nonzero(np.triu(fits, 1))
    found, sizes = np.zeros(len(n), bool), np.array([len(s) for s in signatures])
    shared = np.minimum(sizes[at], sizes[to])
    for size in np.unique(shared):
        folded = np.zeros((len(n), size // 8), _U)
        for member in np.flatnonzero(sizes >= size):
            folded[member] = np.bitwise_xor.reduce(np.frombuffer(signatures[member], _U).reshape(-1, size // 8), axis=0)
        i, j = at[shared == size], to[shared == size]
        block = max(1, CELL_BYTES // size)
        for start in range(0, len(i), block):
            x, y = i[start:start + block], j[start:start + block]
            new = ~(found[x] & found[y])
            x, y = x[new], y[new]
            apart = np.bitwise_count(folded[x] ^ folded[y]).sum(1, dtype=np.int64)
            fine = apart <= n[x] + n[y] - 2 * need[x, y]
            found[x[fine]] = found[y[fine]] = True
    return found


def _cell_members(percent: int):
    """Of cells with signatures: members with a possible partner in another component, as rows without signatures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["shingle", "i", "j"]):
            n, pos = rows["n"].to_numpy().astype(np.int64), rows["pos"].to_numpy().astype(np.int64)
            component = np.unique(rows["component"].to_pylist(), return_inverse=True)[1]
            side = rows["c"].to_numpy() if rows["i"][0] != rows["j"][0] else None
            keep = possible_partners(n, pos, component, rows["signature"].to_pylist(), percent, side)
            yield from rows.select(["shingle", "i", "j", "c", "class", "n", "pos"]).filter(pa.array(keep)).to_batches()
    return run


def _verify_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                good.append(len(np.intersect1d(x, y, assume_unique=True)) >= least_overlap(len(x), len(y), percent))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])
    return run


def cell_links(sets: list[np.ndarray], n: np.ndarray, pos: np.ndarray, percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Boolean matrix of the pairs of a list that pass the filters and reach the threshold; with ``side``, pairs across sides only."""
    need = least_overlap(n[:, None], n[None, :], percent)
    open_pairs = 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])  # length
    open_pairs &= np.minimum((n - pos)[:, None], (n - pos)[None, :]) >= need  # place of the shared shingle
    parts = np.stack([np.bincount((s >> _U(60)).astype(np.int64), minlength=SUFFIX_PARTS) for s in sets])
    if side is not None:
        open_pairs &= side[:, None] != side[None, :]
    open_pairs = np.triu(open_pairs, 1)
    at, to = np.nonzero(open_pairs)
    apart = np.abs(parts[at] - parts[to]).sum(1)  # sets differ in at least as many shingles as their parts differ in size
    fine = apart <= n[at] + n[to] - 2 * need[at, to]
    at, to = at[fine], to[fine]
    out = np.zeros((len(sets), len(sets)), bool)
    if not len(at):
        return out
    lengths = np.array([len(s) for s in sets])
    token, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member, place = np.repeat(np.arange(len(sets)), lengths), np.concatenate([np.arange(x) for x in lengths])
    shared = count[code] > 1
    local = np.cumsum(count > 1) - 1
    bits = np.zeros((len(sets), -(-int((count > 1).sum()) // 64) * 64), bool)
    bits[member[shared], local[code[shared]]] = True
    early = np.zeros_like(bits)
    before = shared & (place < pos[member])
    early[member[before], local[code[before]]] = True
    bits, early = (np.packbits(b, axis=1).view(np.uint64) for b in (bits, early))
    for start in range(0, len(at), 4096):
        i, j = at[start:start + 4096], to[start:start + 4096]
        elsewhere = (early[i] & early[j]).any(1)  # an earlier common shingle: the pair belongs to that list
        i, j = i[~elsewhere], j[~elsewhere]
        enough = np.bitwise_count(bits[i] & bits[j]).sum(1, dtype=np.int64) >= need[i, j]
        out[i[enough], j[enough]] = True
    return out


def _forest(links: np.ndarray) -> np.ndarray:
    """Smallest member that each member is connected to."""
    both, label = links | links.T | np.eye(len(links), dtype=bool), np.arange(len(links))
    while True:
        new = np.where(both, label[None, :], len(links)).min(1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _check_cells(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["shingle", "i", "j"]):
            names = rows["class"].to_pylist()
            n, pos = rows["n"].to_numpy().astype(np.int64), rows["pos"].to_numpy().astype(np.int64)
            across = rows["i"][0] != rows["j"][0]  # two chunks of a large list; each has a cell of its own for its inner pairs
            sets = [np.frombuffer(s, _U) for s in rows["shingles"].to_pylist()]
            label = _forest(cell_links(sets, n, pos, percent, rows["c"].to_numpy() if across else None))
            moved = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in moved], pa.binary()), pa.array([names[label[x]] for x in moved], pa.binary())], names=["a", "b"])
    return run


def _cell_matrix(rows: pa.Table, percent: int) -> np.ndarray:
    """The verified pairs of one cell, each in the cell of its first common shingle only."""
    n, pos = rows["n"].to_numpy().astype(np.int64), rows["pos"].to_numpy().astype(np.int64)
    across = rows["i"][0] != rows["j"][0]
    return cell_links([np.frombuffer(s, _U) for s in rows["shingles"].to_pylist()], n, pos, percent, rows["c"].to_numpy() if across else None)


def _cell_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["shingle", "i", "j"]):
            names, (at, to) = rows["class"].to_pylist(), np.nonzero(_cell_matrix(rows, percent))
            yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in side], pa.binary()) for side in (at, to)], names=["a", "b"])
    return run


def _cell_counts(percent: int):
    """Per class of a cell the rows of the classes linked with it there, so that no pair leaves the cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, ["shingle", "i", "j"]):
            links = _cell_matrix(rows, percent)
            found = (links | links.T).astype(np.float64) @ rows["rows"].to_numpy().astype(np.float64)  # exact up to 2^53 rows
            some = np.flatnonzero(found)
            names = rows["class"].to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in some], pa.binary()), pa.array(found[some].astype(np.int64))], names=["class", "found"])
    return run


def _small(rows: DataFrame) -> DataFrame:
    """Stored narrow rows (about 80 bytes each), to be sent to all executors if they are few, so that the sets they meet stay in place."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    return (batch.column(0).to_numpy().view(_U) for batch in batches)


def _lists_and_sets(docs: DataFrame, sized: DataFrame, order, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The lists (shingle, class, n, pos) that can give a pair, and the set of every class in one."""
    lists = docs.select("text").mapInArrow(_prefixes(k, percent, order), "shingle long, class binary, n int, pos int").repartition("shingle").sortWithinPartitions("shingle", "class")
    lists = stored(lists.mapInArrow(_lists(percent), "shingle long, class binary, n int, pos int"))

    in_lists = lists.select("class").distinct()
    chosen = stored(sized.join(in_lists, "class", "left_semi").groupBy("class").agg(F.min(F.struct("doc_id", "tag")).alias("d")).select(F.xxhash64("d.doc_id", "d.tag").alias("key")))

    # the filter finds the chosen documents without a shuffle of texts; a wrong hit is one set too many
    bits = bits_for(chosen.count(), per_hash=128)
    wanted = docs.sparkSession.sparkContext.broadcast(merged_bits(chosen.mapInArrow(chunk_rows(bits, _keys), CHUNK_SCHEMA), bits, "once"))
    texts = docs.select("text", F.xxhash64("doc_id", "tag").alias("key"))
    sets = stored(texts.mapInArrow(_ordered_sets(k, order, wanted), "class binary, shingles binary"))
    # lists and sets are stored: nothing reads the filters and the order again
    wanted.unpersist()
    order.unpersist()
    return lists, sets


def link_classes(docs: DataFrame, sized: DataFrame, order, k: int, percent: int) -> DataFrame:
    """``node, component`` over the classes of ``docs`` (doc_id, text, tag) that have a link; ``sized`` has (doc_id, n, class)."""
    lists, sets = _lists_and_sets(docs, sized, order, k, percent)
    pairs = stored(lists.repartition("shingle").sortWithinPartitions("shingle", "class").mapInArrow(_first_pairs(percent), "a binary, b binary").distinct())
    left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
    near = stored(left.join(_small(pairs), "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_verify_pairs(percent), "a binary, b binary"))

    known = components(near)
    placed = lists.join(known, lists["class"] == known["node"], "left").select("shingle", "class", "n", "pos", F.coalesce("component", "class").alias("component"))
    placed = stored(placed)
    mixed_lists = placed.groupBy("shingle").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    mixed_lists = mixed_lists.select(F.col("shingle").alias("s"), F.ceil(F.col("members") / CELL_CLASSES).cast("int").alias("chunks"), "members")
    placed = placed.join(mixed_lists, F.col("shingle") == F.col("s")).withColumn("whole", F.col("members") <= WHOLE_LIST).select("shingle", "class", "n", "pos", "component", "chunks", "whole")
    placed = placed.repartition("shingle").sortWithinPartitions("shingle", "class").mapInArrow(_other_components(percent), "shingle long, class binary, n int, pos int, component binary, chunks int, whole boolean")
    members = placed.withColumn("c", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = members.select("shingle", F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j"), "c", "class", "n", "pos", "component")
    # signatures, a bit or two for each shingle, tell most members that no set needs to be sent for
    signed = stored(sets.select("class", "shingles").mapInArrow(_signatures, "class binary, signature binary"))
    cells = stored(cells).join(signed, "class").select("shingle", "i", "j", "c", "class", "n", "pos", "component", "signature")
    cells = cells.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "class")
    cells = stored(cells.mapInArrow(_cell_members(percent), "shingle long, i int, j int, c int, class binary, n int, pos int"))
    cells = sets.join(_small(cells), "class")
    cells = cells.select("shingle", "i", "j", "c", "class", "n", "pos", "shingles").repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "class")
    return components(near.unionByName(cells.mapInArrow(_check_cells(percent), "a binary, b binary")))


def _prepared(df: DataFrame, text: str, doc_id: str, k: int):
    """``doc_id, text, tag`` of every row, its ``doc_id, tag, n, class``, and the order of shingles, broadcast."""
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tag"))
    id_sql = docs.schema["doc_id"].dataType.simpleString()
    id_type = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    count = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 6  # about one word in six bytes
    bits = bits_for(count, per_hash=8)
    repeated, sketch = np.zeros(bits // 8, np.uint8), np.zeros(min(bits, 1 << SKETCH_BITS), np.uint8)
    kept = f"doc_id {id_sql}, tag long, n int, class binary, part long"
    first = docs.mapInArrow(_classes_and_hashes(k, id_type, bits, count), f"{kept}, packed binary").repartition("part").sortWithinPartitions("part")
    first = stored(first.mapInArrow(_counted_chunks(id_type, bits // len(sketch)), f"{kept}, repeated binary, levels binary"))
    sized = first.filter("class IS NOT NULL").select("doc_id", "tag", "n", "class")
    chunks = bits // CHUNK_BITS
    for part, *packed in first.filter("class IS NULL").select("part", "repeated", "levels").toLocalIterator():
        for whole, piece in zip((repeated, sketch), packed):
            size = len(whole) // chunks
            whole[part * size:(part + 1) * size] = np.frombuffer(zlib.decompress(piece), np.uint8)
    order = Order(sketch, repeated)
    return docs, sized, spark.sparkContext.broadcast(order)


def linked_rows(df: DataFrame, text: str, doc_id: str, k: int, percent: int) -> DataFrame:
    """``doc_id, tag`` (hash of the text)``, n, class, component`` of every row, the last null without shingles."""
    with small_batches(df.sparkSession):
        docs, sized, order = _prepared(df, text, doc_id, k)
        linked = stored(link_classes(docs, sized, order, k, percent))
    linked = linked.select("node", F.col("component").alias("reached"))
    found = sized.join(linked, F.col("class") == F.col("node"), "left")
    return stored(found.select("doc_id", "tag", "n", "class", F.when(F.col("n") > 0, F.coalesce("reached", "class")).alias("component")))


def cluster(df: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links, its own included)."""
    rows = linked_rows(df, text, doc_id, k, percent)
    ids = stored(rows.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("component", "c"))
    found = rows.join(ids, F.col("component") == F.col("c"), "left")
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _whole_cells(docs: DataFrame, sized: DataFrame, order, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All lists as cells of bounded size, without the component short cut; and the rows of each class with shingles."""
    lists, sets = _lists_and_sets(docs, sized, order, k, percent)
    lists = lists.dropDuplicates(["shingle", "class"])  # a long list was passed on in parts
    sets = sets.dropDuplicates(["class"])  # the filter of chosen documents lets some copies pass
    sizes = stored(sized.filter("n > 0").groupBy("class").agg(F.count("*").alias("rows")))
    chunks = lists.groupBy(F.col("shingle").alias("s")).agg(F.ceil(F.count("*") / CELL_CLASSES).cast("int").alias("chunks"), F.count("*").alias("members")).filter("members > 1")
    members = lists.join(chunks, F.col("shingle") == F.col("s")).withColumn("c", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = members.select("shingle", F.least("c", "other").alias("i"), F.greatest("c", "other").alias("j"), "c", "class", "n", "pos")
    cells = cells.join(sizes, "class").join(sets, "class").select("shingle", "i", "j", "c", "class", "n", "pos", "rows", "shingles")
    return cells.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j", "class"), sizes


def links(df: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links: pairs of classes ``a, b``, each once, and the membership ``doc_id, class`` of every row with shingles.

    Rows of one class are linked with each other, and with every row of a class that theirs is paired with.
    There are as many pairs as similar sets, so they grow with the square of a group of different near copies;
    ``link_counts`` returns none of them.
    """
    with small_batches(df.sparkSession):
        docs, sized, order = _prepared(df, text, doc_id, k)
        cells, _ = _whole_cells(docs, sized, order, k, percent)
        return stored(cells.mapInArrow(_cell_pairs(percent), "a binary, b binary")), sized.filter("n > 0").select("doc_id", "class")


def link_counts(df: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``n_links`` (other rows that are similar, copies included)."""
    with small_batches(df.sparkSession):
        docs, sized, order = _prepared(df, text, doc_id, k)
        cells, sizes = _whole_cells(docs, sized, order, k, percent)
        near = cells.mapInArrow(_cell_counts(percent), "class binary, found long").groupBy("class").agg(F.sum("found").alias("found"))
        per_class = stored(sizes.join(near, "class", "left").select("class", (F.col("rows") - 1 + F.coalesce("found", F.lit(0))).alias("n_links")))
    found = sized.join(per_class, "class", "left")
    return found.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(df: DataFrame, text: str = "text", doc_id: str = "doc_id", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each component the row with the smallest id, then hash of text, stays.

    Rows without shingles all stay. Only the ids of the rows to drop are joined to the texts, by id
    and hash, so no component meets in one task. Rows equal in id and text stay or go together.
    """
    if clash := {"near_tag", "near_hit"} & set(df.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    rows = linked_rows(df, text, doc_id, k, percent)
    winners = stored(rows.filter("n > 0").groupBy("component").agg(F.min(F.struct("doc_id", "tag")).alias("winner")).withColumnRenamed("component", "c"))
    losers = rows.join(winners, F.col("component") == F.col("c")).filter(F.struct("doc_id", "tag") > F.col("winner"))
    losers = stored(losers.select(F.col("doc_id").alias("l_id"), F.col("tag").alias("l_tag")))
    # a filter of their ids lets nearly all other rows by, so that no text is shuffled but those of rows that may go
    key, bits = F.xxhash64("l_id", "l_tag"), bits_for(losers.count(), per_hash=128)
    wanted = df.sparkSession.sparkContext.broadcast(merged_bits(losers.select(key).mapInArrow(chunk_rows(bits, _keys), CHUNK_SCHEMA), bits, "once"))

    @F.pandas_udf("boolean")
    def among(keys: pd.Series) -> pd.Series:
        return pd.Series(contains(wanted.value, keys.to_numpy().view(_U)))

    tagged = df.withColumn("near_tag", F.xxhash64(text))
    tagged = tagged.withColumn("near_hit", among(F.xxhash64(doc_id, "near_tag")))
    stay = tagged.filter("near_hit").join(losers, tagged[doc_id].eqNullSafe(losers["l_id"]) & (tagged["near_tag"] == losers["l_tag"]), "left_anti")
    return tagged.filter("NOT near_hit").unionByName(stay).drop("near_tag", "near_hit")
