"""Hard negatives: for each anchor and positive the best rows of another label within a window of scores.

Rows are laid along a Hilbert curve within their label and written as blocks to a Parquet table, each with
the smallest and largest value of every dimension (its zone map) and of the label. Anchors carry what they
look for: first a least score for their positives, then the score windows of their negatives. Interval
arithmetic on a zone map bounds every score that a block can give an anchor; only the blocks whose bounds
reach into what an anchor looks for are joined to it and scored. Each cell returns its own best few rows and
a rank over those few gives the result, so nothing grows with the square but the bounds themselves, which
are taken between blocks of anchors and shards of zone maps.

Scores are integer inner products of the components times ``SCALE``, rounded down. A row's own
least score for positives comes from its own block before anything is joined.

Defined cases: rows with a null id, label or vector, with a null or non-finite component, with a component
of 2^24 or more after scaling, or with another number of components than most rows have (the smaller number
on a tie) take no part. Equal scores are ordered by the smaller id, then by place on the curve; repeated rows and ids are
rows of their own, and a row is never its own positive. An anchor without a positive, and a positive without a
negative in its window, give no row; empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.session import stored

SCALE = 256
BLOCK_ROWS = 2048
LEAST_ROWS = 64
GROUP_ANCHORS = 1024
SHARD_ZONES = 128  # a pair of shard and group returns at most so many packed groups
CURVE_DIMENSIONS, CURVE_BITS = 8, 4
POSITIVES, NEGATIVES = 5, 3
LOWEST = -(1 << 62)
_BLOCKS = "block long, first long, label_lo long, label_hi long, ids binary, labels binary, vectors binary, lo binary, hi binary, a_at binary, a_floor binary"
_ANCHORS = "a_row long, a_id long, a_label long, a_vector binary, wanted binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points given as one row of cell numbers (below ``2 ** bits``) each."""
    x = cells.astype(np.int64).T.copy()
    count = len(x)
    top = 1 << (bits - 1)
    step = top
    while step > 1:  # undo the turns and reflections from the coarsest cell on
        low = step - 1
        for i in range(count):
            inside = (x[i] & step) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        step >>= 1
    for i in range(1, count):  # Gray code over the dimensions
        x[i] ^= x[i - 1]
    flip, step = np.zeros_like(x[0]), top
    while step > 1:
        flip ^= np.where((x[-1] & step) != 0, step - 1, 0)
        step >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(count):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of both: in doubles where every sum stays below 2^53, else in whole numbers."""
    if len(left) and len(right) and int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1] >= 1 << 53:
        return (left.astype(object) @ right.astype(object).T).astype(np.int64)
    return (left.astype(float) @ right.astype(float).T).astype(np.int64)


def score_bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any vector between ``lo`` and ``hi`` of each block."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def usable(df: DataFrame, label: Column, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, label, vector`` (scaled whole numbers) of the rows that take part."""
    values = F.transform(F.col(vector).cast("array<double>"), lambda x: x * F.lit(float(SCALE)))
    fine = F.coalesce(F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 24))), F.lit(False))
    rows = df.filter(F.col(vec_id).isNotNull() & label.isNotNull() & fine).select(
        F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform(values, lambda x: F.floor(x).cast("int")).alias("vector"))
    common = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("vector") == (common["size"] if common else 0))


def _flat(column: pa.Array, count: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(count, -1)


def _spreads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, total, square = 0, 0.0, 0.0
    for batch in batches:
        if len(batch):
            values = _flat(batch.column(0), len(batch)).astype(float)
            rows, total, square = rows + len(values), total + values.sum(0), square + (values ** 2).sum(0)
    if rows:
        at = np.arange(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.full(len(at), rows)), pa.array(total), pa.array(square)], names=["at", "n", "total", "square"])


def curve_cells(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The dimensions of widest spread, with the mean and deviation that their cells are cut by; one row per dimension is collected."""
    sums = rows.select("vector").mapInArrow(_spreads, "at int, n long, total double, square double").groupBy("at").agg(*[F.sum(c).alias(c) for c in ("n", "total", "square")]).orderBy("at").collect()
    n, total, square = (np.array([r[c] for r in sums], float) for c in ("n", "total", "square"))
    mean = total / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(square / np.maximum(n, 1) - mean ** 2, 0))
    chosen = np.sort(np.argsort(-spread, kind="stable")[:CURVE_DIMENSIONS])
    return chosen, mean[chosen], np.maximum(spread[chosen], 1e-9)


def on_curve(rows: DataFrame) -> DataFrame:
    """``rows`` with their place on the curve, as ``place``."""
    chosen, mean, spread = curve_cells(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                values = _flat(batch.column("vector"), len(batch))[:, chosen]
                side = 1 << CURVE_BITS  # cells cover two deviations on either side, the outer ones all beyond
                cells = np.clip(np.floor(((values - mean) / spread + 2) * side / 4), 0, side - 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells, CURVE_BITS))], names=[*batch.schema.names, "place"])

    return rows.mapInArrow(run, "vec_id long, label long, vector array<int>, place long")


def _fifth(scores: np.ndarray, allowed: np.ndarray, count: int) -> np.ndarray:
    """The ``count``-th best allowed score of each row, or ``LOWEST``."""
    if scores.shape[1] < count:
        return np.full(len(scores), LOWEST)
    return -np.partition(-np.where(allowed, scores, LOWEST), count - 1, axis=1)[:, count - 1]


def _pack(anchor_step: int, block_rows: int):
    def block(number: int, first: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> list:
        at = np.flatnonzero(ids % anchor_step == 0)
        floors = np.empty(len(at), np.int64)
        for start in range(0, len(at), 256):  # the anchors of a block, a few at a time
            some = at[start:start + 256]
            same = labels[some][:, None] == labels
            same[np.arange(len(some)), some] = False
            floors[start:start + 256] = _fifth(products(vectors[some], vectors), same, POSITIVES)
        lo, hi = vectors.min(0), vectors.max(0)
        return [number, first, int(labels.min()), int(labels.max()), *(x.tobytes() for x in (ids, labels, vectors, lo, hi, at.astype(np.int32), floors))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = first = TaskContext.get().partitionId() << 40
        held: list[np.ndarray] | None = None
        names = [f.split()[0] for f in _BLOCKS.split(", ")]
        types = [pa.int64()] * 4 + [pa.binary()] * 7

        def cut() -> pa.RecordBatch:
            nonlocal held, number, first
            labels = held[1][:block_rows]
            changes = np.flatnonzero(np.diff(labels)) + 1
            end = int(next((c for c in changes if c >= LEAST_ROWS), len(labels)))
            row = block(number, first, *(x[:end] for x in held))
            held, number, first = [x[end:] for x in held], number + 1, first + end
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            if len(batch):
                new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), _flat(batch.column(2), len(batch)).astype(np.int32)]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
                while len(held[0]) >= block_rows:
                    yield cut()
        while held is not None and len(held[0]):
            yield cut()
    return run


def write_blocks(rows: DataFrame, anchor_step: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The stored block table of usable rows."""
    placed = on_curve(rows)
    ranged = placed.repartitionByRange("label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id").select("vec_id", "label", "vector")
    return stored(ranged.mapInArrow(_pack(anchor_step, block_rows), _BLOCKS))


def anchors_of(blocks: DataFrame) -> DataFrame:
    """One row per anchor; ``wanted`` is its least score for positives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.frombuffer(row["a_at"], np.int32).astype(np.int64)
                ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
                vectors = np.frombuffer(row["vectors"], np.int32).reshape(len(ids), -1)[at]
                floors = np.frombuffer(row["a_floor"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["first"] + at), pa.array(ids[at]), pa.array(labels[at]), pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([f.tobytes() for f in floors], pa.binary())],
                    names=["a_row", "a_id", "a_label", "a_vector", "wanted"])

    chosen = blocks.filter(F.length("a_at") > 0).select("first", "ids", "labels", "vectors", "a_at", "a_floor")
    return stored(chosen.mapInArrow(run, _ANCHORS))


class Asked:
    """Some anchors with what each of them looks for."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, wanted: np.ndarray):
        self.rows, self.ids, self.labels, self.vectors, self.wanted = rows, ids, labels, vectors, wanted

    @classmethod
    def of(cls, table: pa.Table) -> Asked:
        def matrix(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind).reshape(len(table), -1)
        return cls(table["a_row"].to_numpy(), table["a_id"].to_numpy(), table["a_label"].to_numpy(), matrix("a_vector", np.int32), matrix("wanted", np.int64))

    def pick(self, at: np.ndarray) -> Asked:
        return Asked(self.rows[at], self.ids[at], self.labels[at], self.vectors[at], self.wanted[at])

    def packed(self) -> list[bytes]:
        return [x.tobytes() for x in (self.rows, self.ids, self.labels, self.vectors, self.wanted)]

    @classmethod
    def unpacked(cls, parts: list[bytes]) -> Asked:
        rows, ids, labels = (np.frombuffer(p, np.int64) for p in parts[:3])
        return cls(rows, ids, labels, np.frombuffer(parts[3], np.int32).reshape(len(rows), -1), np.frombuffer(parts[4], np.int64).reshape(len(rows), -1))


def _asks_positives(asked: Asked, least: np.ndarray, most: np.ndarray, label_lo: np.ndarray, label_hi: np.ndarray) -> np.ndarray:
    within = (asked.labels[:, None] >= label_lo) & (asked.labels[:, None] <= label_hi)
    return within & (most >= asked.wanted[:, :1])


def _asks_negatives(asked: Asked, least: np.ndarray, most: np.ndarray, label_lo: np.ndarray, label_hi: np.ndarray) -> np.ndarray:
    """Windows are pairs of least and largest score; an empty window has its least above its largest."""
    other = (asked.labels[:, None] != label_lo) | (asked.labels[:, None] != label_hi)
    reached = np.zeros(least.shape, bool)
    for lo, hi in zip(asked.wanted[:, 0::2].T, asked.wanted[:, 1::2].T):
        reached |= (lo <= hi)[:, None] & (most >= lo[:, None]) & (least <= hi[:, None])
    return other & reached


def needed_blocks(blocks: DataFrame, anchors: DataFrame, asks: Callable, anchor_count: int, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """``block, grp`` and the packed anchors of the group that the block's bounds cannot turn away.

    Anchors are cut into groups along the curve, zone maps into shards; each pair of the two is one task's work.
    """
    groups, zone_count = max(1, -(-anchor_count // group_anchors)), blocks.count()
    shards = max(1, -(-zone_count // SHARD_ZONES))
    grouped = anchors.repartitionByRange(groups, "a_row").withColumn("grp", F.spark_partition_id())
    asked = grouped.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    zones = blocks.select("block", "label_lo", "label_hi", "lo", "hi", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int").alias("shard"))
    zones = zones.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    names = ["block", "grp", "rows", "ids_a", "labels_a", "vectors_a", "wanted"]
    schema = pa.schema([("block", pa.int64()), ("grp", pa.int32()), *[(n, pa.binary()) for n in names[2:]]])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            group, number = Asked.of(right), right["grp"][0].as_py()
            lo, hi = (np.frombuffer(b"".join(left[c].to_pylist()), np.int32).reshape(len(left), -1) for c in ("lo", "hi"))
            least, most = score_bounds(group.vectors, lo, hi)
            need = asks(group, least, most, left["label_lo"].to_numpy(), left["label_hi"].to_numpy())
            for at, block in enumerate(left["block"].to_pylist()):
                chosen = np.flatnonzero(need[:, at])
                if len(chosen):
                    out.append((block, number, *group.pick(chosen).packed()))
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return zones.groupBy("shard", "grp").cogroup(asked.groupBy("shard", "grp")).applyInArrow(
        run, "block long, grp int, rows binary, ids_a binary, labels_a binary, vectors_a binary, wanted binary")


def _in_cells(blocks: DataFrame, needed: DataFrame, pick: Callable, schema: str) -> DataFrame:
    """Join each needed block to the anchors that need it and let ``pick`` choose among its rows."""
    payload = blocks.select("block", "first", F.col("ids"), F.col("labels"), F.col("vectors"))
    fields = [f.split() for f in schema.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        found: list[list] = [[] for _ in fields]
        for row in table.to_pylist():
            asked = Asked.unpacked([row[c] for c in ("rows", "ids_a", "labels_a", "vectors_a", "wanted")])
            ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
            vectors, own = np.frombuffer(row["vectors"], np.int32).reshape(len(ids), -1), row["first"] + np.arange(len(ids))
            order = np.lexsort((own, ids))  # so that a stable sort by score leaves ties by id
            for start in range(0, len(asked.rows), 256):
                some = asked.pick(np.arange(start, min(start + 256, len(asked.rows))))
                for values, column in zip(pick(some, products(some.vectors, vectors[order]), ids[order], labels[order], own[order]), found):
                    column.append(values)
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in found]
        return pa.table({name: pa.array(c.astype(np.int32 if kind == "int" else np.int64)) for (name, kind), c in zip(fields, columns)})

    return needed.join(payload, "block").groupBy("block", "grp").applyInArrow(run, schema)


def _pick_positives(asked: Asked, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
    out: list[tuple] = []
    for at in range(len(asked.rows)):
        same = np.flatnonzero((labels == asked.labels[at]) & (own != asked.rows[at]) & (scores[at] >= asked.wanted[at, 0]))
        best = same[np.argsort(-scores[at, same], kind="stable")[:POSITIVES]]
        out.append((np.full(len(best), asked.rows[at]), np.full(len(best), asked.ids[at]), own[best], ids[best], scores[at, best]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5


def _pick_negatives(asked: Asked, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
    out: list[tuple] = []
    for at in range(len(asked.rows)):
        other = np.flatnonzero(labels != asked.labels[at])
        other = other[np.argsort(-scores[at, other], kind="stable")]
        down = -scores[at, other]
        for number, (lo, hi) in enumerate(zip(asked.wanted[at, 0::2].tolist(), asked.wanted[at, 1::2].tolist())):
            first = int(np.searchsorted(down, -hi, side="left"))
            best = other[first:first + NEGATIVES]
            best = best[scores[at, best] >= lo]
            out.append((np.full(len(best), asked.rows[at]), np.full(len(best), number + 1), own[best], ids[best], scores[at, best]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5


def positives(blocks: DataFrame, anchors: DataFrame, anchor_count: int, **options) -> DataFrame:
    """``a_row, anchor_id, number, positive_id, positive_score``: the first rows of each anchor's own label."""
    needed = needed_blocks(blocks, anchors, _asks_positives, anchor_count, **options)
    found = _in_cells(blocks, needed, _pick_positives, "a_row long, anchor_id long, p_row long, positive_id long, positive_score long")
    best = Window.partitionBy("a_row").orderBy(F.desc("positive_score"), "positive_id", "p_row")
    return found.withColumn("number", F.row_number().over(best)).filter(F.col("number") <= POSITIVES).drop("p_row")


def windows(anchors: DataFrame, chosen: DataFrame, low: int, high: int) -> DataFrame:
    """Anchors with a window of scores per positive: ``low`` to ``high`` per cent of the positive's score.

    Every anchor has ``POSITIVES`` windows; those without a positive are empty.
    """
    per_anchor = chosen.groupBy("a_row").agg(F.sort_array(F.collect_list(F.struct("number", "positive_score"))).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for found in batch.column("found").to_pylist():
                limits = [(-(-low * f["positive_score"] // 100), high * f["positive_score"] // 100) for f in found]
                limits += [(1, 0)] * (POSITIVES - len(limits))
                packed.append(np.array(limits, np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(packed, pa.binary())], names=[*batch.schema.names[:4], "wanted"])

    return anchors.drop("wanted").join(per_anchor, "a_row").select("a_row", "a_id", "a_label", "a_vector", "found").mapInArrow(run, _ANCHORS)


def mine(df: DataFrame, label: Column, anchor_step: int, vec_id: str = "vec_id", vector: str = "embedding", low: int = 50, high: int = 95,
         block_rows: int = BLOCK_ROWS, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; anchors are the ids divisible by ``anchor_step``."""
    blocks = write_blocks(usable(df, label, vec_id, vector), anchor_step, block_rows)
    anchors = anchors_of(blocks)
    count = anchors.count()
    chosen = stored(positives(blocks, anchors, count, group_anchors=group_anchors))
    looking = stored(windows(anchors, chosen, low, high))
    needed = needed_blocks(blocks, looking, _asks_negatives, count, group_anchors=group_anchors)
    found = _in_cells(blocks, needed, _pick_negatives, "a_row long, number int, n_row long, negative_id long, negative_score long")
    best = Window.partitionBy("a_row", "number").orderBy(F.desc("negative_score"), "negative_id", "n_row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= NEGATIVES)
    return ranked.join(chosen, ["a_row", "number"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
