"""Joins Spark has no single operator for: interval, as-of, and hot-key aware lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.operators import ordered
from emberlog.session import stored


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[tuple[Column | str, Column | str]],
           columns: Sequence[str | Column], how: str = "left") -> DataFrame:
    """Join columns of a keyed table to a frame; the key columns of the table are dropped.

    ``on`` pairs an expression over ``df`` with one over ``dim``. The dimension must hold one row
    per key, so rows never multiply.
    """
    names = [f"_on_{i}" for i in range(len(on))]
    right = dim.select(*[(F.col(r) if isinstance(r, str) else r).alias(n) for n, (_, r) in zip(names, on)], *columns)
    condition = [(F.col(l) if isinstance(l, str) else l) == F.col(n) for n, (l, _) in zip(names, on)]
    return df.join(right, condition, how).drop(*names)


def restrict_to(df: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the other frame; it never multiplies rows."""
    return df.join(allowed.select(*keys), list(keys), "left_semi")


def split_hot_join(df: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left",
                   share: float = 0.001) -> DataFrame:
    """Join a table with one row per key where a few keys may hold most rows.

    Keys above ``share`` of all rows number at most ``1 / share``; their dimension rows are
    broadcast and those fact rows never shuffle. All other keys take the usual shuffle join. Rows
    with a null key have no partner and are not joined at all. A hot key that the dimension repeats
    is an error, so that what is broadcast stays as small as said.
    """
    keys = list(keys)
    rest = [c for c in dim.columns if c not in keys]
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    facts = df.filter(whole)
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    hot = counts.filter(F.col("_n") > total.scalar() * share).select(*keys)
    flagged = facts.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    only = dim.join(F.broadcast(hot), keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(F.lit(1), *rest)).alias("_row"))
    checked = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(F.lit("the dimension repeats a hot key")))
    hot_dim = only.select(*keys, checked.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
    columns = [*df.columns, *rest]
    cold_rows = flagged.filter(F.col("_hot").isNull()).drop("_hot").join(dim, keys, how)
    hot_rows = flagged.filter(F.col("_hot")).drop("_hot").join(F.broadcast(hot_dim), keys, how)
    joined = cold_rows.select(*columns).unionByName(hot_rows.select(*columns))
    if how == "inner":
        return joined
    alone = df.filter(~whole).select("*", *[F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in rest])
    return joined.unionByName(alone)


LEVEL_BITS = 4


def _gaps(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """The stretches between the first and the last range of a key that no range covers."""
    ends = F.explode(F.array(F.struct(F.col("_from").alias("_pos"), F.lit(1).alias("_delta")), F.struct((F.col("_to") + 1).alias("_pos"), F.lit(-1).alias("_delta"))))
    turns = ranges.select(*keys, ends.alias("_e")).groupBy(*keys, F.col("_e._pos").alias("_pos")).agg(F.sum("_e._delta").alias("_delta"))
    walked = ordered.running(turns, keys, [F.col("_pos").asc()], {"_depth": ("sum", "_delta"), "_before": ("prev", "_pos")})
    return walked.filter((F.col("_depth") == F.col("_delta")) & F.col("_before").isNotNull()).select(*keys, F.col("_before").alias("_from"), (F.col("_pos") - 1).alias("_to"))


def interval_join(events: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str | Column, start: str,
                  end: str, columns: Sequence[str], base_bits: int = 20) -> DataFrame:
    """Left join of events to the intervals that contain them (both ends included, whole numbers), per key.

    Intervals and the gaps between them stand in one table of ranges. Time is cut into blocks of
    ``2 ** base_bits`` units, and on every further level into blocks 16 times as long; a range lies on the
    lowest level whose blocks are as long as itself, so it touches two blocks at most, however long
    it is. An event looks into its block on each level that its key uses. It lies in some range, an
    interval or a gap, unless it is outside of all, so one equi-join gives the rows without a partner too, and
    events are read once. A hot key is spread over its blocks.
    """
    keys = list(keys)
    names = [f"_i_{k}" for k in keys]
    spans = stored(intervals.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(start).cast("bigint").alias("_from"),
                                    F.col(end).cast("bigint").alias("_to"), *[F.col(c).alias(f"_v_{c}") for c in columns]).filter("_from <= _to"))
    ranges = spans.unionByName(_gaps(spans, names), allowMissingColumns=True)
    above = F.greatest(F.ceil(F.log2((F.col("_to") - F.col("_from") + 1).cast("double"))).cast("int") - base_bits, F.lit(0))
    ranges = ranges.withColumn("_level", F.least(F.lit(base_bits) + F.ceil(above / LEVEL_BITS).cast("int") * LEVEL_BITS, F.lit(62)))
    known = ranges.groupBy(*names).agg(F.collect_set("_level").alias("_levels"), F.min("_from").alias("_first"), F.max("_to").alias("_last"))
    blocks = ranges.withColumn("_block", F.explode(F.expr("sequence(shiftright(_from, _level), shiftright(_to, _level))")))

    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & (F.col(k) == F.col(n))
    moment = events.withColumn("_at", (F.col(at) if isinstance(at, str) else at).cast("bigint"))
    within = F.when((F.col("_at") >= F.col("_first")) & (F.col("_at") <= F.col("_last")), F.col("_levels"))
    looking = moment.join(known, same, "left").select(*events.columns, "_at", F.explode_outer(within).alias("_look"))
    looking = looking.withColumn("_place", F.expr("shiftright(_at, _look)"))
    inside = same & (F.col("_look") == F.col("_level")) & (F.col("_place") == F.col("_block")) & (F.col("_at") >= F.col("_from")) & (F.col("_at") <= F.col("_to"))
    found = looking.join(blocks, inside, "left").filter(F.col("_from").isNotNull() | F.col("_look").isNull())
    return found.select(*events.columns, *[F.col(f"_v_{c}").alias(c) for c in columns])


def resolve_interval_id(events: DataFrame, intervals: DataFrame, keys: Sequence[str], event_id: str,
                        interval_id: str, at: str, start: str, end: str, **options) -> DataFrame:
    """Fill a missing id from the interval that holds the event's time; a given id is kept.

    A row with an id has no time to look for, so it takes no part in the time join and
    passes through it once, as it is.
    """
    open_at = F.when(F.col(event_id).isNull(), F.col(at))
    found = interval_join(events, intervals.withColumn("_id", F.col(interval_id)), keys, open_at, start, end, ["_id"], **options)
    return found.withColumn(interval_id, F.coalesce(event_id, "_id")).drop("_id", *([event_id] if event_id != interval_id else []))


def asof_last(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, value_as: str,
              nested: Sequence[str] = (), nested_as: str | None = None, hot_rows: int = 1_000_000) -> DataFrame:
    """Time of the last right row at or before each left row, per key; null keys are equal.

    With ``nested``, ``nested_as`` is the same among the right rows that also agree in those columns: both come
    from one shuffle by ``keys``, and no pair of rows is formed. A key with more than ``hot_rows`` rows is cut
    into slices of its ordered rows instead, and the state is carried from slice to slice.
    """
    keys, nested = list(keys), list(nested)
    marks = right.select(*keys, *nested, F.col(right_at).cast("bigint").alias("_when")).filter(F.col("_when").isNotNull()).distinct()
    tagged = left.withColumns({"_when": F.col(left_at).cast("bigint"), "_mark": F.lit(None).cast("bigint"), "_side": F.lit(1)})
    merged = stored(tagged.unionByName(marks.withColumns({"_mark": F.col("_when"), "_side": F.lit(0)}), allowMissingColumns=True))
    outputs = {value_as: keys} | ({nested_as: [*keys, *nested]} if nested_as else {})
    order = [F.col("_when").asc(), F.col("_side").asc()]
    large = stored(merged.groupBy(*[F.col(k).alias(f"_h_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_h_{k}"))

    def scanned(rows: DataFrame) -> DataFrame:
        upto = {n: F.last("_mark", ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) for n, by in outputs.items()}
        return rows.withColumns(upto)

    found = scanned(merged if large.isEmpty() else merged.join(large, same, "left_anti"))
    if not large.isEmpty():
        hot = merged.join(large, same, "left_semi")
        for name, by in outputs.items():
            hot = ordered.running(hot, by, order, {name: ("last", "_mark")})
        found = found.unionByName(hot)
    return found.filter("_side = 1").select(*left.columns, *outputs)
