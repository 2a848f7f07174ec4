"""Importance resampling of documents towards a target text collection, by hashed word n-grams.

A text becomes lower case (A-Z only) and its separators collapse to single spaces. One overlapped regular
expression scan, held to word starts and ends by lookarounds, then emits the runs of one, two and three
words that begin at each word, and their CRC-32 picks a bucket. Bucket counts of the raw and of the target
texts give each bucket a gain, the scaled log ratio of its smoothed rates; a document's weight is the sum
of its features' gains, and Gumbel noise that depends on the id alone turns the highest scores into a
draw without replacement.

Every text is scanned once: the scan writes each document's bucket counts, packed, and at the end of each
task the task's own bucket totals. Totals are summed by bucket, so what is collected is one row per
bucket, a number that the caller sets. The rank is taken by ordered slices, not in one task.

Defined cases: a null or empty text has no features and weight 0. Words are counted whole however long the
text is; matches are handled one by one. Equal scores are ordered by the smaller id, a null id first;
repeated rows are scored and ranked each. The noise of a null id is that of the empty id. Empty tables
give an empty result; an empty target leaves the smoothed rates. Only the id and text columns are read
and the result has its own columns, so further columns of any name neither clash nor appear.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.blocks import text_blocks
from emberlog.operators import ordered
from emberlog.session import stored

BUCKETS = 10_000
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# A word, the next and the one after, where there are such; possessive, so no shorter piece is tried.
_GRAMS = regex.compile(rb"(?<![^ ])([^ ]++)(?:( [^ ]++)( [^ ]++)?+)?+(?![^ ])")


def gram_hashes(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words, and the CRC-32 of every run of one to three words."""
    if not text:
        return 0, np.empty(0, np.uint32)
    plain = _SEPARATORS.sub(b" ", text.encode().translate(_LOWER))
    hashes: list[int] = []
    add, crc, words = hashes.append, zlib.crc32, 0
    parts = []
    for match in _GRAMS.finditer(plain, overlapped=True):
        one, two, three = match.groups()
        words += 1
        value = crc(one)
        add(value)
        if two is not None:
            value = crc(two, value)
            add(value)
            if three is not None:
                add(crc(three, value))
        if len(hashes) > 1 << 18:  # keep the hashes of a very long text as numbers of four bytes
            parts.append(np.array(hashes, np.uint32))
            hashes.clear()
    return words, np.concatenate([*parts, np.array(hashes, np.uint32)])


def pack(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted buckets as gaps, then their counts, compressed."""
    gaps = np.diff(buckets, prepend=0).astype("<u4")
    return zlib.compress(np.concatenate([gaps, counts.astype("<u4")]).view(np.uint8).reshape(-1, 4).T.tobytes(), 1) if len(buckets) else b""


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not data:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
    half = len(flat) // 2
    return np.cumsum(flat[:half]), flat[half:]


def _scan(buckets: int):
    names = ["doc_id", "n_words", "n_features", "packed", "bucket", "total"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in text_blocks(batches, "text"):
            words, features, packed = [], [], []
            for text in batch.column(1).to_pylist():
                n, hashes = gram_hashes(text)
                found, counts = np.unique(hashes % np.uint32(buckets), return_counts=True)
                found = found.astype(np.int64)
                totals[found] += counts
                words.append(n)
                features.append(len(hashes))
                packed.append(pack(found, counts))
            rest = [pa.nulls(len(batch), t) for t in types[4:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, types[1]), pa.array(features, types[2]), pa.array(packed, types[3]), *rest], names=names)
        at = np.flatnonzero(totals)
        empty = [pa.nulls(len(at), t) for t in types[:4]]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(at, types[4]), pa.array(totals[at], types[5])], names=names)
    return run


def scan(df: DataFrame, text: str = "text", doc_id: str | None = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """One row per document (``bucket`` null) and, after them, each task's total of each bucket it met."""
    key = F.col(doc_id).cast("long") if doc_id else F.lit(None).cast("long")
    return df.select(key.alias("doc_id"), F.col(text).alias("text")).mapInArrow(_scan(buckets), "doc_id long, n_words long, n_features long, packed binary, bucket int, total long")


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Totals by bucket: at most ``buckets`` rows reach the driver."""
    out = np.zeros(buckets, np.int64)
    for row in scanned.filter(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("total").alias("total")).collect():
        out[row["bucket"]] = row["total"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the rates with one added to every bucket, rounded down."""
    size, all_raw, all_target = len(raw), int(raw.sum()), int(target.sum())
    ratios = (target + 1.0) * (all_raw + size) / ((raw + 1.0) * (all_target + size))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weights(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of the documents of a scan."""
    shared = scanned.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = []
            for data in batch.column(3).to_pylist():
                found, counts = unpack(data)
                total.append(int((shared.value[found] * counts).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(total, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    rows = scanned.filter(F.col("bucket").isNull()).select("doc_id", "n_words", "n_features", "packed")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise of an id in thousandths, rounded down, from 32 bits of a hash."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def resample(df: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
             percent: int = 5, min_words: int = 20, buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document.

    Of the documents with ``min_words`` words or more, ``percent`` in a hundred with the highest scores have a rank.
    """
    scanned = stored(scan(df, text, doc_id, buckets))
    raw, wanted = bucket_counts(scanned, buckets), bucket_counts(scan(target, target_text, None, buckets), buckets)
    scored = stored(weights(scanned, gains(raw, wanted)).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    long_enough = F.col("n_words") >= min_words
    drawn = scored.filter(long_enough).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features")]
    ranked = ordered.ranked(scored.filter(long_enough), [], order, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank").cast("long")))
    every = ranked.unionByName(scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long")))
    return every.select("doc_id", "n_features", "weight", "score", "rank")
