"""Picking rows per key. Every operator here shrinks its input before the shuffle, so a key
that holds a large share of all rows costs no more than any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]


def top_n_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str], n: int,
             rank_as: str | None = None) -> DataFrame:
    """The first ``n`` rows per key. A plain name in ``order`` means descending, nulls last.

    Spark limits each map partition to ``n`` rows per key before the shuffle (WindowGroupLimit).
    """
    name = rank_as or "_rn"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*_columns(order))))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank_as else kept.drop(name)


def latest_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return top_n_by(df, keys, order, 1)


def dedup_ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
                  count_as: str | None = None) -> DataFrame:
    """One row per key, the greatest by ``order`` and then by all other columns.

    It is an aggregation, so copies collapse on the map side; ``count_as`` adds how many rows
    the key had before.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order if c in rest]
    packed = [*ordered, *[c for c in rest if c not in ordered]]
    measures = [F.max(F.struct(*packed)).alias("_row")] if packed else []
    if count_as or not measures:
        measures.append(F.count(F.lit(1)).alias(count_as or "_n"))
    best = df.groupBy(*keys).agg(*measures)
    picked = [F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    return best.select(*picked, *([count_as] if count_as else []))


def drop_repeats(stream: DataFrame, keys: Sequence[str], order: Sequence[str] = (), delay: str = "14 days",
                 arrived: Column | None = None) -> DataFrame:
    """Of a stream, every version of a key once: rows that repeat one within ``delay`` of its arrival go.

    The watermark follows the arrival (by default the time of the micro-batch), not a time in the data, so that
    nothing that arrives is ever too late. State holds a key, its order columns and a hash of the row, and leaves
    after the delay. A version that comes again later stays as a repeated row; ``dedup_ordered`` on read takes one.
    """
    rest = [c for c in stream.columns if c not in keys and c not in order]
    stamped = stream.withColumns({"_arrived": F.current_timestamp() if arrived is None else arrived, "_content": F.xxhash64(*rest) if rest else F.lit(0).cast("bigint")})
    once = stamped.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark([*keys, *order, "_content"])
    return once.drop("_arrived", "_content")


def with_duplicate_count(df: DataFrame, keys: Sequence[str], name: str = "_duplicate_count") -> DataFrame:
    """All rows, with the number of rows sharing their key.

    Counts are combined before the shuffle and joined back, so adaptive execution can split a
    hot key, which a window over the key could not.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    right = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], name)
    condition = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return df.join(right, condition, "left").drop(*[f"_k_{k}" for k in keys])


def collapse_copies(df: DataFrame, count_as: str = "_copies") -> DataFrame:
    """Equal rows as one row with their number; combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count_as))


def expand_copies(df: DataFrame, count: str = "_copies", index_as: str = "_copy", chunk: int = 10_000) -> DataFrame:
    """Each row repeated ``count`` times, numbered from 0.

    A row with many copies is cut into chunks that are dealt out over tasks before they expand.
    """
    def numbers(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(low, high)).alias(index_as)

    zero = F.lit(0).cast("bigint")
    few = df.filter(F.col(count) <= chunk).select("*", numbers(zero, F.col(count) - 1))
    many = df.filter(F.col(count) > chunk).select("*", F.explode(F.sequence(zero, F.floor((F.col(count) - 1) / chunk))).alias("_chunk"))
    dealt = many.repartition(F.col("_chunk"), F.xxhash64(*df.columns))
    low = F.col("_chunk") * chunk
    return few.unionByName(dealt.select(*df.columns, numbers(low, F.least(low + chunk, F.col(count)) - 1)))


def mode_by(df: DataFrame, keys: Sequence[str], value: str, value_as: str, count_as: str | None = None,
            largest_value_first: bool = False) -> DataFrame:
    """Most frequent non-null value per key; ties go to the smallest (or largest) value."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    tie = F.col(value).desc() if largest_value_first else F.col(value).asc()
    best = latest_by(counts, keys, [F.col("_n").desc(), tie])
    outputs = [*keys, F.col(value).alias(value_as)]
    return best.select(*outputs, *([F.col("_n").alias(count_as)] if count_as else []))


def top_values_json(df: DataFrame, keys: Sequence[str], value: str, n: int, name: str) -> DataFrame:
    """JSON list of the ``n`` most frequent values per key as ``{name, count}``, best first."""
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("name"))
              .agg(F.count(F.lit(1)).alias("count")))
    top = top_n_by(counts, keys, [F.col("count").desc(), F.col("name").asc()], n, rank_as="_rank")
    ordered = F.array_sort(F.collect_list(F.struct("_rank", "name", "count")))
    return top.groupBy(*keys).agg(
        F.to_json(F.transform(ordered, lambda e: F.struct(e["name"].alias("name"), e["count"].alias("count")))).alias(name))


def prefer_flagged(df: DataFrame, keys: Sequence[str], flag: Column) -> DataFrame:
    """Rows passing the flag; keys with no such row keep all their rows."""
    flagged = df.filter(flag).select(*keys).distinct()
    others = df.filter(~F.coalesce(flag, F.lit(False))).join(flagged, list(keys), "left_anti")
    return df.filter(flag).unionByName(others)


def union_branches(branches: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing in a branch is null there."""
    result = branches[0]
    for branch in branches[1:]:
        result = result.unionByName(branch, allowMissingColumns=True)
    return result


def first_source_wins(sources: Sequence[DataFrame], keys: Sequence[Column]) -> DataFrame:
    """Union of sources where an earlier source wins a key, then the smaller row."""
    tagged = union_branches([s.withColumn("_source_no", F.lit(i)) for i, s in enumerate(sources)])
    order = [F.col("_source_no").asc(), *[F.col(c).asc() for c in sources[0].columns]]
    return latest_by(tagged, keys, order)
