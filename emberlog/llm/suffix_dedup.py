"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a smaller document,
or in the same one at a smaller place. Strings are judged on the input.

The suffix arrays are sparse. The anchor of a string of ``LENGTH`` bytes is the first of its grams of ``GRAM``
bytes with the smallest hash, so equal strings have equal anchors at equal offsets, and it is enough to
compare strings whose anchors are equal. The context of an anchor is all bytes of its strings, which follow
each other; every string of a text is in one context. Three passes over the texts keep what is moved small:

1. A filter, sized by the data, of the grams that may occur twice. Unique grams are not looked at again.
2. Contexts, as 128-bit fingerprints. Every context but the first of its kind is removed whole; of copies
   in one block of texts only the first is shuffled. Only grams with several different contexts, the ends
   of repeated passages, need more.
3. First contexts of those grams go, with their bytes, to index families, dealt by gram. A family takes
   its contexts in document order, in batches. A new batch gets a suffix array of its strings; the array
   is merge-scanned against the existing levels, where a match means that the string starts earlier; the
   strings that are new become a level, and levels of equal rank merge, so there are logarithmically many.

The filters only decide what is looked at: a wrong hit costs work and changes no result. A gram with more
than ``FAMILY_CONTEXTS`` different contexts is not given to one family: its strings are dealt by their own
fingerprints instead.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes lose nothing. A null id is smaller
than any other. Rows that share an id are ordered by a hash of their texts; rows equal in both count as
one document and get equal results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.bit_filter import CHUNK_BITS, CHUNK_SCHEMA, MAX_BITS, bits_for, chunk_rows, contains, merged_bits
from emberlog.llm.blocks import text_blocks as _text_blocks
from emberlog.llm.hashing import BASES, layout, mixed, pieces, running
from emberlog.session import stored

LENGTH = 100
GRAM = 40
BATCH_CONTEXTS = 4096
BLOCK_BYTES = 1 << 18  # arrays of one number a byte stay in the processor's cache
FAMILY_CONTEXTS = 50_000
_U = np.uint64
_ORDER_BASE = 0x9E3779B1


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    out, size = values, 1
    while size * 2 <= width:
        out, size = pick(out[:-size], out[size:]), size * 2
    count = len(values) - width + 1
    return pick(out[:count], out[width - size:width - size + count])


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _text_blocks(batches, "text", BLOCK_BYTES)


def _gram_order(data: np.ndarray, width: int) -> np.ndarray:
    """A 32-bit hash of the ``width`` bytes from each place on, put together from pieces of 1, 2, 4, ... bytes."""
    piece, size, out, done = data.astype(np.uint32) + np.uint32(1), 1, None, 0
    while True:
        if width & size:
            count = len(data) - done - size + 1
            out = piece if out is None else out[:count] * np.uint32(pow(_ORDER_BASE, size, 1 << 32)) + piece[done:]
            done += size
        if size * 2 > width:
            break
        piece = piece[:-size] * np.uint32(pow(_ORDER_BASE, size, 1 << 32)) + piece[size:]
        size *= 2
    out = (out ^ (out >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    out = (out ^ (out >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return out ^ (out >> np.uint32(16))


class Anchors:
    """Anchors of a block of texts: document number, place, gram hash, and both ends of the context."""

    def __init__(self, column: pa.Array, length: int = LENGTH, gram: int = GRAM):
        self.data, self.offsets = layout(column)
        self.sums = running(self.data, BASES[0])
        self.at = self.doc = self.low = self.high = np.empty(0, np.int64)
        self.gram = np.empty(0, _U)
        if len(self.data) < length:
            return
        # hash and place in one number, so that the first of equal hashes is the least
        keys = self.data[:len(self.data) - gram + 1].astype(np.int64)
        keys[:] = _gram_order(self.data, gram) >> np.uint32(1)
        keys <<= 32
        keys |= np.arange(len(keys))
        anchor = _slide(keys, length - gram + 1, np.minimum)
        first, last = self.offsets[:-1], self.offsets[1:] - length + 1
        long = last > first
        # a context ends where the anchor changes and where its document has no more strings
        cuts = np.ones(len(anchor) + 1, bool)
        np.not_equal(anchor[1:], anchor[:-1], out=cuts[1:-1])
        cuts[first[long]] = cuts[last[long]] = True
        cuts = np.flatnonzero(cuts)
        begin, end = cuts[:-1], cuts[1:]
        doc = np.searchsorted(self.offsets, begin, side="right") - 1
        inside = begin + length <= self.offsets[doc + 1]
        self.low, self.high, self.doc = begin[inside], end[inside] + length - 1, doc[inside]
        self.at = anchor[self.low] & 0xFFFFFFFF
        self.gram = pieces(self.sums, BASES[0], self.at, self.at + gram)

    def keep(self, which: np.ndarray) -> None:
        self.at, self.doc, self.gram, self.low, self.high = (x[which] for x in (self.at, self.doc, self.gram, self.low, self.high))

    def contexts(self) -> None:
        """Fingerprints of the contexts, which tell the anchor's offset too."""
        left = mixed((self.at - self.low).astype(_U) + _U(1))
        self.first = pieces(self.sums, BASES[0], self.low, self.high) ^ left
        self.second = mixed(pieces(running(self.data, BASES[1]), BASES[1], self.low, self.high) + left)


class SuffixFamily:
    """Sorted arrays of strings seen so far, one level per rank; a level of rank ``r`` holds about ``2 ** r`` batches."""

    def __init__(self):
        self.levels: list[tuple[int, np.ndarray]] = []

    def add(self, strings: np.ndarray) -> np.ndarray:
        """Whether each string of a batch, given in document order, was seen before it."""
        if not len(strings):
            return np.zeros(0, bool)
        suffix_array = np.argsort(strings, kind="stable")
        ordered = strings[suffix_array]
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        heads = np.flatnonzero(new)
        known = np.zeros(len(heads), bool)
        for _, level in self.levels:
            at = np.minimum(np.searchsorted(level, ordered[heads]), len(level) - 1)
            known |= level[at] == ordered[heads]
        seen = ~new
        seen[heads] = known
        self._push(ordered[heads[~known]])
        out = np.empty(len(strings), bool)
        out[suffix_array] = seen
        return out

    def _push(self, level: np.ndarray) -> None:
        rank = 0
        while self.levels and self.levels[-1][0] <= rank:
            level = np.sort(np.concatenate([self.levels.pop()[1], level]), kind="stable")
            rank += 1
        if len(level):
            self.levels.append((rank, level))


def strings_of(contexts: pa.Array, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """All strings of ``length`` bytes in the contexts, as fixed-size items; and how many each context has."""
    sizes = pc.binary_length(contexts).to_numpy().astype(np.int64)
    data, counts = np.frombuffer(b"".join(contexts.to_pylist()), np.uint8), sizes - length + 1
    if not len(counts):
        return np.empty(0, f"S{length}"), counts
    begin = np.arange(counts.sum()) + np.repeat(np.arange(len(counts)) * (length - 1), counts)
    return np.lib.stride_tricks.sliding_window_view(data, length)[begin].view(f"S{length}").ravel(), counts


def _runs(seen: np.ndarray, counts: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, low, high) of the byte ranges covered by the marked strings; ``starts`` are the places of the contexts."""
    at = np.flatnonzero(seen)
    context = np.repeat(np.arange(len(counts)), counts)[at]
    place = at + (starts - np.cumsum(counts) + counts)[context]
    new = np.ones(len(at), bool)
    new[1:] = (context[1:] != context[:-1]) | (place[1:] - place[:-1] > length)
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(at))[:len(firsts)] - 1
    return context[firsts], place[firsts], place[lasts] + length


# --- passes --------------------------------------------------------------------------------

def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for block in text_blocks(batches):
        yield Anchors(block.column("text")).gram


def _place_hash(first: np.ndarray, second: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mixed(first + mixed(second ^ mixed(place.astype(_U))))


def _pack(pos: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Place in the document and reach to both sides in one number, in the order of places."""
    return pos << 14 | left << 7 | right


def _context_rows(repeated):
    """(gram, f1, f2, doc_id, tag, place) of the first anchor of each context in a block; of later ones their whole context as a range.

    A range has no gram, and ``f1`` and ``place`` as its ends.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            found = Anchors(block.column("text"))
            if repeated is not None:
                found.keep(contains(repeated.value, found.gram))
            found.contexts()
            ids = block.column("doc_id").to_pylist()
            rank = np.empty(len(ids), np.int64)
            rank[sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, block.column("tag")[i].as_py()))] = np.arange(len(ids))
            order = np.lexsort((found.at, rank[found.doc], found.second, found.first))
            later = np.zeros(len(order), bool)
            later[order[1:]] = (found.first[order[1:]] == found.first[order[:-1]]) & (found.second[order[1:]] == found.second[order[:-1]])
            start = found.offsets[found.doc]
            place = _pack(found.at - start, found.at - found.low, found.high - found.at)
            which = pa.array(found.doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.gram.astype(_U).view(np.int64), mask=later), pa.array(np.where(later, found.low - start, found.first.view(np.int64))), pa.array(found.second.view(np.int64)),
                 block.column("doc_id").take(which), block.column("tag").take(which), pa.array(np.where(later, found.high - start, place))],
                names=["gram", "f1", "f2", "doc_id", "tag", "place"])
    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (context, document, place): the first of each context as it is, later ones as ranges."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        gram, f1, f2, place = (batch.column(c) for c in ("gram", "f1", "f2", "place"))
        context = ~np.asarray(gram.is_null())
        f1, f2, place = (x.to_numpy().copy() for x in (f1, f2, place))
        before1, before2, was = (np.concatenate([[x], y[:-1]]) for x, y in zip(last or (0, 0, False), (f1, f2, context)))
        later = context & was.astype(bool) & (f1 == before1) & (f2 == before2)
        last = (f1[-1], f2[-1], bool(context[-1]))
        pos, left, right = place >> 14, place >> 7 & 127, place & 127
        is_range = later | ~context
        low, high = np.where(later, pos - left, f1), np.where(later, pos + right, place)
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram.fill_null(0).to_numpy(), mask=is_range), pa.array(f1, mask=is_range), pa.array(f2, mask=is_range), batch.column("doc_id"), batch.column("tag"), pa.array(place, mask=is_range),
             pa.array(low.astype(np.int32), mask=~is_range), pa.array(high.astype(np.int32), mask=~is_range)],
            names=["gram", "f1", "f2", "doc_id", "tag", "place", "low", "high"])


def _context_bytes(several, firsts):
    """(gram, doc_id, tag, pos, reach_left, context) of the anchors that pass both filters: of grams with several contexts, and of first places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches):
            found = Anchors(block.column("text"))
            found.keep(contains(several.value, found.gram))
            found.contexts()
            pos, left = found.at - found.offsets[found.doc], found.at - found.low
            at = np.flatnonzero(contains(firsts.value, _place_hash(found.first, found.second, _pack(pos, left, found.high - found.at))))
            data, which = found.data.tobytes(), pa.array(found.doc[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.gram[at].astype(_U).view(np.int64)), block.column("doc_id").take(which), block.column("tag").take(which), pa.array(pos[at].astype(np.int32)), pa.array(left[at].astype(np.int32)),
                 pa.array([data[a:b] for a, b in zip(found.low[at], found.high[at])], pa.binary())], names=["gram", "doc_id", "tag", "pos", "reach_left", "context"])
    return run


def _family_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feed one partition's contexts, in document order, to a family; byte ranges of strings that start earlier."""
    family = SuffixFamily()
    for batch in batches:
        for start in range(0, len(batch), BATCH_CONTEXTS):
            part = batch.slice(start, BATCH_CONTEXTS)
            lefts, pos = (part.column(c).to_numpy().astype(np.int64) for c in ("reach_left", "pos"))
            strings, counts = strings_of(part.column("context"))
            context, low, high = _runs(family.add(strings), counts, pos - lefts, LENGTH)
            which = pa.array(context)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(which), part.column("tag").take(which), *(pa.array(x.astype(np.int32)) for x in (low, high))],
                                             names=["doc_id", "tag", "low", "high"])


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of the contexts of a very frequent gram as a row of its own, by fingerprint."""
    for batch in batches:
        for start in range(0, len(batch), 256):
            part = batch.slice(start, 256)
            lefts, pos = (part.column(c).to_numpy().astype(np.int64) for c in ("reach_left", "pos"))
            strings, counts = strings_of(part.column("context"))
            data = strings.view(np.uint8)
            ends = np.arange(0, len(data) + 1, LENGTH)
            prints = [pieces(running(data, b), b, ends[:-1], ends[1:]).view(np.int64) for b in BASES]
            row = np.repeat(np.arange(len(counts)), counts)
            place = (pos - lefts)[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays([*map(pa.array, prints), part.column("doc_id").take(pa.array(row)), part.column("tag").take(pa.array(row)), pa.array(place.astype(np.int32))],
                                             names=["s1", "s2", "doc_id", "tag", "low"])


def _later(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Rows that are not the first of their key in document order."""
    order = F.struct("doc_id", "tag", place)
    first = rows.groupBy(*keys).agg(F.min(order).alias("least"), F.count("*").alias("n")).filter("n > 1").select(*(F.col(k).alias(f"k_{k}") for k in keys), "least")
    same = [F.col(k) == F.col(f"k_{k}") for k in keys]
    return rows.join(stored(first), same).filter(order > F.col("least"))


def removed_ranges(docs: DataFrame, max_filter_bits: int = MAX_BITS, family_contexts: int = FAMILY_CONTEXTS) -> DataFrame:
    """``doc_id, tag, low, high``: byte ranges to remove, possibly overlapping; ``docs`` has (doc_id, tag, text)."""
    spark = docs.sparkSession
    id_sql = docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    repeated, bits = None, bits_for(size // 32, limit=1 << 62)  # about one anchor in 32 bytes
    if bits <= max_filter_bits:  # a larger filter is not sent; then all anchors pass, which moves more but finds the same
        repeated = spark.sparkContext.broadcast(merged_bits(docs.select("text").mapInArrow(chunk_rows(bits, _grams), CHUNK_SCHEMA), bits, "twice"))
    rows = docs.mapInArrow(_context_rows(repeated), f"gram long, f1 long, f2 long, doc_id {id_sql}, tag long, place long")
    settled = rows.repartition("f1", "f2").sortWithinPartitions("f1", "f2", F.col("gram").isNull(), "doc_id", "tag", "place")
    settled = stored(settled.mapInArrow(_settle, f"gram long, f1 long, f2 long, doc_id {id_sql}, tag long, place long, low int, high int"))
    ranges, kinds = settled.filter("gram IS NULL").select("doc_id", "tag", "low", "high"), settled.filter("gram IS NOT NULL")

    count = kinds.count()
    if not count:
        return ranges

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (b.column(0).to_numpy().view(_U) for b in batches)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            f1, f2, place = (batch.column(i).to_numpy() for i in range(3))
            yield _place_hash(f1.view(_U), f2.view(_U), place)

    bits = bits_for(count)
    several = spark.sparkContext.broadcast(merged_bits(kinds.select("gram").mapInArrow(chunk_rows(bits, grams), CHUNK_SCHEMA), bits, "twice"))
    firsts = spark.sparkContext.broadcast(merged_bits(kinds.select("f1", "f2", "place").mapInArrow(chunk_rows(bits, places), CHUNK_SCHEMA), bits, "once"))
    frequent = stored(kinds.groupBy("gram").count().filter(F.col("count") > family_contexts).select(F.col("gram").alias("g")))
    contexts = docs.mapInArrow(_context_bytes(several, firsts), f"gram long, doc_id {id_sql}, tag long, pos int, reach_left int, context binary")
    dealt = contexts
    if not frequent.isEmpty():
        dealt = contexts.join(frequent, F.col("gram") == F.col("g"), "left_anti")
        strings = contexts.join(frequent, F.col("gram") == F.col("g"), "left_semi").mapInArrow(_string_rows, f"s1 long, s2 long, doc_id {id_sql}, tag long, low int")
        ranges = ranges.unionByName(_later(strings, ["s1", "s2"], "low").select("doc_id", "tag", "low", (F.col("low") + LENGTH).cast("int").alias("high")))
    # ends of passages are some part of all contexts: partitions sized as if they were a quarter
    partitions = max(1, -(-count // (8 * BATCH_CONTEXTS)))
    dealt = dealt.repartition(partitions, "gram").sortWithinPartitions("doc_id", "tag", "pos")
    return ranges.unionByName(dealt.mapInArrow(_family_ranges, f"doc_id {id_sql}, tag long, low int, high int"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the ranges of each document and take the rest of its bytes."""
    for block in text_blocks(batches):
        data, offsets = layout(block.column("text"))
        ranges = block.column("ranges")
        sizes = pc.fill_null(pc.list_value_length(ranges), 0).to_numpy()
        ends, doc = ranges.flatten(), np.repeat(np.arange(len(sizes)), sizes)
        low, high = (ends.field(c).to_numpy().astype(np.int64) + offsets[doc] for c in ("low", "high"))
        order = np.lexsort((low, doc))
        low, reach, doc = low[order], np.maximum.accumulate(high[order]), doc[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
        firsts = np.flatnonzero(new)
        low, high, doc = low[firsts], reach[np.append(firsts[1:], len(reach))[:len(firsts)] - 1], doc[firsts]
        edges = np.concatenate([[0], np.stack([low, high], 1).ravel(), [len(data)]])
        kept = np.repeat(np.arange(len(edges) - 1) % 2 == 0, np.diff(edges))
        left = np.concatenate([[0], np.cumsum(kept)])[offsets].astype(np.int32)
        rest = pa.BinaryArray.from_buffers(pa.binary(), len(block), [None, pa.py_buffer(left), pa.py_buffer(data[kept])])
        spans = pa.StructArray.from_arrays([pa.array((x - offsets[doc]).astype(np.int32)) for x in (low, high)], names=["low", "high"])
        spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(block) + 1)).astype(np.int32)), spans)
        texts = block.drop_columns(["ranges"])
        yield pa.RecordBatch.from_arrays([*texts.columns, rest, spans], names=[*texts.schema.names, "kept_bytes", "spans"])


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``doc_id, text, kept_bytes`` (binary) and ``spans``: maximal removed ranges (low, high) in bytes, per input row."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # the tag tells rows of one id apart; where all ids differ it is 0 and costs nothing to move
    docs, once = docs.withColumn("tag", F.lit(0).cast("long")), None
    if not docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        docs = docs.withColumn("tag", F.xxhash64("text"))
        once = docs.dropDuplicates(["doc_id", "tag"])
    ranges = removed_ranges(docs if once is None else once, **options).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    ranges = stored(ranges.select(F.col("doc_id").alias("r_id"), F.col("tag").alias("r_tag"), "ranges"))
    joined = docs.join(ranges, docs["doc_id"].eqNullSafe(ranges["r_id"]) & (docs["tag"] == ranges["r_tag"]), "left").select("doc_id", "text", "ranges")
    id_sql = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_cut, f"doc_id {id_sql}, text string, kept_bytes binary, spans array<struct<low:int,high:int>>")
