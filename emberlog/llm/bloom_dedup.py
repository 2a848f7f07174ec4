"""Exact deduplication by two passes over Bloom filters.

Pass one builds a Bloom filter of text hashes per task, cut into segments, and merges the segments
into one filter of the hashes that were possibly seen twice. Pass two probes it: rows that hit are
the only ones that shuffle and are grouped by the SHA-256 of their text; all others pass straight
through as groups of one.

Defined cases: a null text counts as empty, so null and empty texts are copies of each other. Rows
that share text and ``id`` are copies too and have the same ``keep_id``; ``keep_copies`` keeps one of
them. A null id is smaller than any other. Columns of the input are never dropped or overwritten:
``annotate`` names what it adds, and raises on a clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.session import stored

BITS_PER_ROW = 16
SEGMENT_BITS = 1 << 16
BROADCAST_BYTES = 32 << 20
"""Largest filter that is sent to every executor; a larger one is joined by segment instead."""


def _slots(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Two slots per hash, both in the same segment: a probe needs one segment only."""
    base = np.mod(hashes, segments) * SEGMENT_BITS
    bits = hashes.view(np.uint64)
    first, second = (bits >> np.uint64(32)) % np.uint64(SEGMENT_BITS), ((bits >> np.uint64(48)) ^ (bits >> np.uint64(13))) % np.uint64(SEGMENT_BITS)
    return base + first.astype(np.int64), base + second.astype(np.int64)


def _filters(segments_in_all: int):
    """Per task and segment: slots set by one distinct arrival, and slots set by two or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        if not taken:
            return
        hashes = np.concatenate(taken)
        slots, counts = np.unique(np.concatenate(_slots(hashes, segments_in_all)), return_counts=True)
        segments = slots // SEGMENT_BITS
        cuts = np.flatnonzero(np.diff(segments, prepend=-1))
        rows = []
        for start, end in zip(cuts, [*cuts[1:], len(slots)]):
            inside, many = (slots[start:end] % SEGMENT_BITS).astype(np.uint16), counts[start:end] > 1
            rows.append((int(segments[start]), zlib.compress(inside.tobytes(), 1), zlib.compress(inside[many].tobytes(), 1)))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))],
                                         names=["segment", "once", "twice"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment: a slot is repeated if one task saw it twice or two tasks saw it."""
    def unpack(data: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(data), np.uint16)

    current, seen, repeated = None, None, None

    def close():
        slots = np.flatnonzero(repeated).astype(np.uint16)
        return [(current, slots)] if len(slots) else []

    for batch in batches:
        done = []
        for segment, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if segment != current:
                done += close() if current is not None else []
                current, seen, repeated = segment, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
            slots = unpack(once)
            repeated[slots[seen[slots]]] = True
            repeated[unpack(twice)] = True
            seen[slots] = True
        yield _segment_rows(done)
    if current is not None:
        yield _segment_rows(close())


def _segment_rows(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tobytes() for r in rows], pa.binary())],
                                      names=["segment", "slots"])


def _among(slots: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    if not len(repeated):
        return np.zeros(len(slots), bool)
    return repeated[np.minimum(np.searchsorted(repeated, slots), len(repeated) - 1)] == slots


def possible_repeats(rows: DataFrame, bits_per_row: int = BITS_PER_ROW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` (with a long ``bloom_hash``) plus ``bloom_hit``: false only if no other row has the hash.

    Only hashes leave their task while the filter is built: about four bytes a row. The merged filter
    holds repeated slots only. Its size is taken before it is sent anywhere; above
    ``broadcast_bytes`` the rows are joined to its segments instead.
    """
    spark = rows.sparkSession
    segments = max(1, -(-rows.count() * bits_per_row // SEGMENT_BITS))
    parts = rows.select("bloom_hash").mapInArrow(_filters(segments), "segment long, once binary, twice binary")
    merged = stored(parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, "segment long, slots binary"))
    total = merged.agg(F.coalesce(F.sum(F.length("slots")), F.lit(0)).alias("n")).first()["n"]
    if total * 4 <= broadcast_bytes:  # two bytes a slot here, eight when spread out for the search
        found = [np.int64(r["segment"]) * SEGMENT_BITS + np.frombuffer(r["slots"], np.uint16).astype(np.int64) for r in merged.collect()]
        shared = spark.sparkContext.broadcast(np.sort(np.concatenate(found)) if found else np.empty(0, np.int64))

        @F.pandas_udf("boolean")
        def probe(hashes: pd.Series) -> pd.Series:
            first, second = _slots(hashes.to_numpy(), segments)
            return pd.Series(_among(first, shared.value) & _among(second, shared.value))

        return rows.withColumn("bloom_hit", probe("bloom_hash"))

    @F.pandas_udf("boolean")
    def probe_segment(hashes: pd.Series, slots: pd.Series) -> pd.Series:
        pairs = zip(*(s % SEGMENT_BITS for s in _slots(hashes.to_numpy(), segments)), slots)
        return pd.Series([d is not None and bool(np.isin((a, b), np.frombuffer(d, np.uint16)).all()) for a, b, d in pairs], dtype=bool)

    keyed = rows.withColumn("bloom_segment", F.pmod("bloom_hash", F.lit(segments)))
    joined = keyed.join(merged.toDF("bloom_segment", "bloom_slots"), "bloom_segment", "left")
    return joined.withColumn("bloom_hit", probe_segment("bloom_hash", "bloom_slots")).select(*rows.columns, "bloom_hit")


def annotate(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id`` (largest id of the group), ``group_size``, ``text_sha256``, ``bloom_hit``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    hashed = stored(df.select(F.col(doc_id).alias("doc_id"), F.sha2(whole.cast("binary"), 256).alias("text_sha256"), F.xxhash64(whole).alias("bloom_hash")))
    probed = stored(possible_repeats(hashed, **limits).drop("bloom_hash"))
    hits = probed.filter("bloom_hit")
    # stored, so that the join deals its rows anew and Spark can split a large group
    groups = stored(hits.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    repeated = hits.join(groups, "text_sha256").select("doc_id", "keep_id", "group_size", "text_sha256", "bloom_hit")
    alone = probed.filter("NOT bloom_hit").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256", "bloom_hit")
    return alone.unionByName(repeated)


def keep_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **limits) -> DataFrame:
    """The input without copies: of equal texts one row with the largest id stays, with all its columns.

    Rows that miss the filter are never shuffled. Rows that hit meet by (hash, id): a group of copies
    spreads over tasks by their ids, and only rows equal in both meet.
    """
    added = ("bloom_hash", "bloom_hit", "bloom_sha", "bloom_winner")
    if clash := set(added) & set(df.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    whole = F.coalesce(F.col(text), F.lit(""))
    probed = possible_repeats(df.withColumns({"bloom_hash": F.xxhash64(whole), "bloom_sha": F.sha2(whole.cast("binary"), 256)}), **limits)
    hits = probed.filter("bloom_hit")
    winners = stored(hits.groupBy("bloom_sha").agg(F.max(doc_id).alias("bloom_winner")))
    won = hits.alias("h").join(winners.alias("w"), (F.col("h.bloom_sha") == F.col("w.bloom_sha")) & F.col(f"h.{doc_id}").eqNullSafe(F.col("w.bloom_winner")), "left_semi")
    return probed.filter("NOT bloom_hit").select(*df.columns).unionByName(won.dropDuplicates(["bloom_sha"]).select(*df.columns))
