"""Running values, ranks and exact quantiles that do not need one task per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.session import stored

# kind -> (value within an ordered frame, how earlier slices add up)
_FRAME = {
    "count": (lambda c: F.count(c), "sum"),
    "sum": (lambda c: F.sum(c), "sum"),
    "min": (lambda c: F.min(c), "min"),
    "max": (lambda c: F.max(c), "max"),
    "last": (lambda c: F.last(c, ignorenulls=True), "last"),
}


def _local(kind: str, column: str | None, ordered, rows, whole) -> Column:
    value = F.col(column) if column else F.lit(1)
    if kind == "row":
        return F.row_number().over(ordered)
    if kind == "prev":
        return F.lag(value).over(ordered)
    if kind == "total":
        return (F.sum(value) if column else F.count(value)).over(whole)
    return _FRAME[kind][0](value).over(rows)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
            measures: Mapping[str, tuple[str, str | None]], parts: int | None = None) -> DataFrame:
    """Add running values per key in a total order.

    Kinds: ``count``, ``sum``, ``min``, ``max`` and ``last`` (non-null) up to and including the
    row, ``prev`` (value of the row before), ``row`` (row number) and ``total`` (sum of a column
    over the key, or row count without one).

    The input is cut into ordered slices by range, so that a key with any share of the rows, or no
    key at all, spreads over many tasks; each slice is scanned on its own, and the at most ``parts``
    slice totals per key carry the state across.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *[F.col(k).asc() for k in keys], *order)
    # Slice numbers must not change between the two uses below, so the slices are stored.
    sliced = stored(ranged.withColumn("_slice", F.spark_partition_id()))
    whole = Window.partitionBy(*keys, "_slice")
    ordered = whole.orderBy(*order)
    rows = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.select("*", F.row_number().over(ordered).alias("_at"),
                          *[_local(kind, c, ordered, rows, whole).alias(n) for n, (kind, c) in measures.items()])

    state = []
    for name, (kind, column) in measures.items():
        ends = {"row": "_at", "prev": column}.get(kind, name)
        state.append(F.max_by(F.struct(F.col(ends).alias("v")), "_at")["v"].alias(f"_end_{name}"))
    totals = local.groupBy(*keys, "_slice").agg(*state)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = []
    for name, (kind, _) in measures.items():
        end = F.col(f"_end_{name}")
        if kind == "total":
            carry.append(F.sum(end).over(Window.partitionBy(*keys)).alias(f"_carry_{name}"))
        elif kind == "prev":
            carry.append(F.last(end).over(earlier).alias(f"_carry_{name}"))
        else:
            how = "sum" if kind == "row" else _FRAME[kind][1]
            fold = F.last(end, ignorenulls=True) if how == "last" else getattr(F, how)(end)
            carry.append(fold.over(earlier).alias(f"_carry_{name}"))
    right = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_k_slice"), *carry)
    condition = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_slice") == F.col("_k_slice")]
    joined = local.join(right, condition, "left")

    outputs = []
    for name, (kind, _) in measures.items():
        here, before = F.col(name), F.col(f"_carry_{name}")
        if kind == "total":
            value = before
        elif kind == "prev":
            value = F.when(F.col("_at") == 1, before).otherwise(here)
        elif kind == "last":
            value = F.coalesce(here, before)
        elif kind in ("min", "max"):
            value = (F.least if kind == "min" else F.greatest)(here, before)
        elif kind == "sum":
            value = F.when(here.isNull(), before).otherwise(here + F.coalesce(before, F.lit(0)))
        else:
            value = here + F.coalesce(before, F.lit(0))
        outputs.append(value.alias(name))
    return joined.select(*df.columns, *outputs)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank_as: str,
           total_as: str | None = None, **options) -> DataFrame:
    """Position per key in a total order, with the number of ranked rows."""
    measures: dict[str, tuple[str, str | None]] = {rank_as: ("row", None)}
    if total_as:
        measures[total_as] = ("total", None)
    return running(df, keys, order, measures, **options)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
                    **options) -> DataFrame:
    """Linear-interpolated quantiles per key, exact.

    Values are counted first (combined before the shuffle), then located by a running count.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running(counts, keys, [F.col(value).asc()],
                     {"_upto": ("sum", "_n"), "_all": ("total", "_n")}, **options)
    measures = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_all") - 1)
        for side, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("_upto") > index) & (F.col("_upto") - F.col("_n") <= index)
            measures.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"_{side}_{name}"))
        measures.append(F.max(at - F.floor(at)).alias(f"_part_{name}"))
    found = placed.groupBy(*keys).agg(F.max("_all").alias("n"), *measures)
    return found.select(*keys, "n", *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")).alias(n) for n in probs])
