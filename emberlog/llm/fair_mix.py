"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every document copy gets a virtual finish time: the running total of its source's words in shuffled
order, divided by the source's target. Copies of all sources are taken in order of finish time until
the total budget is used up. A source is shuffled by the MD5 of its document ids, so reruns agree.

Running totals never put a source, however large, into one task: a source is cut into slices of the
shuffle order, slices are summed first, and only the slice sums are scanned together. The cut in
finish time is found the same way, by summing a fixed number of finish-time steps and sorting the
one step that the budget ends in.

Defined cases: a null text has no words. A null source is a source of its own, the last. Documents
without words are taken with zero words. Documents that repeat an id are queued one after the other
by size; rows equal in id, source and size are interchangeable. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)


def words(text: Column) -> Column:
    """Number of runs of characters other than the six ASCII white-space characters."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, budget_share: float, weights: tuple[float, ...], max_repeats: int) -> DataFrame:
    """``sources`` (mix_source, source_size) plus ``source_rank`` and ``target``: the budget shared by weight, no source above its cap.

    In order of cap per weight, the first source that the budget left after the full caps before it
    cannot fill sets the level; a source gets its weight times the level, or its cap if that is less.
    The windows scan one row per source.
    """
    ranks, all_rows = Window.orderBy(F.col("mix_source").asc_nulls_last()), (Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sources.withColumn("source_rank", F.row_number().over(ranks))
    ranked = ranked.withColumns({
        "weight": F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int")),
        "cap": max_repeats * F.col("source_size"),
    }).withColumn("fill", F.col("cap") / F.col("weight"))
    by_fill = Window.orderBy("fill", "source_rank")
    until = by_fill.rowsBetween(Window.unboundedPreceding, 0)
    left = budget_share * F.sum("source_size").over(by_fill.rowsBetween(*all_rows)) - (F.sum("cap").over(until) - F.col("cap"))
    ranked = ranked.withColumn("own_level", left / F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
    unfilled = F.when(F.col("own_level") < F.col("fill"), F.col("own_level"))
    ranked = ranked.withColumn("level", F.first(unfilled, ignorenulls=True).over(by_fill.rowsBetween(*all_rows)))
    share = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return ranked.select("mix_source", "source_size", "source_rank", share.alias("target"))


def mix(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", budget_share: float = 1.5,
        weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 2, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, mix_source, size, source_size, target, copies, taken``, and the columns in ``keep``.

    ``copies`` is how often the mix takes the document, at most ``max_repeats``; ``taken`` is its
    words so often. ``budget_share`` times all words is the budget, at most ``max_repeats`` of them.
    """
    added = {"shuffle_key", "mix_source", "size", "source_size", "source_rank", "target", "slice", "running", "position", "copies", "taken"}
    if clash := added & set(keep):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))
    sized = stored(df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("mix_source"), words(F.col(text)).alias("size"), key.alias("shuffle_key"),
                             *(c for c in keep if c != "doc_id")))
    shares = stored(targets(sized.groupBy("mix_source").agg(F.sum("size").alias("source_size")), budget_share, weights, max_repeats))

    side = max(1, math.isqrt(sized.count()))  # slices of a source, and rows of a slice, both grow as the root of the rows
    sliced = sized.withColumn("slice", F.shiftright(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long") * side, 32))
    until = Window.partitionBy("mix_source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    sums = sliced.groupBy("mix_source", "slice").agg(F.sum("size").alias("slice_size"))
    sums = sums.withColumn("before", F.sum("slice_size").over(until) - F.col("slice_size")).join(
        shares.withColumnRenamed("mix_source", "s"), F.col("mix_source").eqNullSafe(F.col("s")))
    sums = sums.select("s", F.col("slice").alias("c"), "before", "source_size", "source_rank", "target")
    inside = Window.partitionBy("mix_source", "slice").orderBy("shuffle_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = sliced.withColumn("running", F.sum("size").over(inside))
    queued = queued.join(sums, queued["mix_source"].eqNullSafe(sums["s"]) & (queued["slice"] == sums["c"]))
    queued = stored(queued.withColumn("position", F.col("before") + F.col("running")).drop("s", "c", "before", "running", "slice", "shuffle_key"))

    taken = F.lit(max_repeats)
    if edge := _edge(queued, budget_share, max_repeats):
        taken = F.size(F.filter(F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda c: _within(*_finish(c), *edge)))
    copies = F.when(F.col("size") > 0, taken).otherwise(0).cast("long")
    return queued.withColumn("copies", copies).select(
        "doc_id", "mix_source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(c for c in keep if c != "doc_id"))


def _finish(copy: Column) -> tuple[Column, Column, Column]:
    """Order of a copy in the mix: virtual finish time, then rank of the source, then place in the source."""
    place = copy * F.col("source_size") + F.col("position")
    return place / F.col("target"), F.col("source_rank"), place


def _within(finish: Column, rank: Column, place: Column, *edge) -> Column:
    at_finish, at_rank, at_place = map(F.lit, edge)
    return (finish < at_finish) | (finish == at_finish) & ((rank < at_rank) | (rank == at_rank) & (place <= at_place))


def _edge(queued: DataFrame, budget_share: float, max_repeats: int) -> tuple[float, int, int] | None:
    """Order of the last copy within the budget; None if all copies are.

    Copies are summed by steps of finish time; of the sums, as many as the root of the rows, the one
    that the budget ends in is found, and only that step is sorted copy by copy.
    """
    rows, words_in_all = queued.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    finish, rank, place = _finish(F.col("copy"))
    copies = queued.filter("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    per_unit = max(1, math.isqrt(rows))
    copies = copies.select("size", finish.alias("finish"), rank.alias("rank"), place.alias("place"))
    copies = copies.withColumn("step", F.floor(F.least(F.col("finish"), F.lit(4.0)) * per_unit))
    until = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    steps = copies.groupBy("step").agg(F.sum("size").alias("step_size")).withColumn("through", F.sum("step_size").over(until))
    over = steps.filter(F.col("through") > budget_share * words_in_all).orderBy("step").select("step", (F.col("through") - F.col("step_size")).alias("before")).first()
    if over is None:
        return None
    order = Window.orderBy("finish", "rank", "place").rowsBetween(Window.unboundedPreceding, 0)
    step = copies.filter(F.col("step") == over["step"]).withColumn("through", F.sum("size").over(order) + over["before"])
    last = step.filter(F.col("through") <= budget_share * words_in_all).orderBy(F.desc("through")).select("finish", "rank", "place").first()
    # nothing of the step fits: all before it is taken, nothing in it
    return tuple(last) if last else (over["step"] / per_unit, 0, -1)


def take(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **options) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as it is taken.

    Only ids, hashes and copies go through the queue; texts shuffle once, when they are repeated. Rows
    equal in id, source and text are one document here, which comes out as often as all of them are taken.
    """
    if clash := {"mix_tag", "mix_copies"} & set(df.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    tag = F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(source).cast("string"), F.lit("")))
    tagged = df.withColumn("mix_tag", tag)
    copies = mix(tagged, text, source, doc_id, keep=("mix_tag",), **options).groupBy("doc_id", "mix_tag").agg(F.sum("copies").cast("int").alias("mix_copies"))
    copies = stored(copies.filter("mix_copies > 0").withColumnsRenamed({"doc_id": "m_id", "mix_tag": "m_tag"}))
    distinct = tagged.dropDuplicates([doc_id, "mix_tag"])
    joined = distinct.join(copies, distinct[doc_id].eqNullSafe(copies["m_id"]) & (distinct["mix_tag"] == copies["m_tag"]))
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(*df.columns)
