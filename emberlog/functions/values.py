"""Column functions for labels, ratios, buckets, arrays and times."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlog.functions.names import col


def label(code: Column | str, labels: Mapping[int, str], otherwise: Column | str | None = None) -> Column:
    """Code to label; unknown codes give ``otherwise``."""
    result = None
    for key, text in labels.items():
        result = (F if result is None else result).when(col(code) == key, text)
    if otherwise is None:
        return result
    return result.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def outcome(is_kill: Column | str) -> Column:
    return F.when(col(is_kill), "kill").otherwise("wipe")


def tidy(value: Column | str, places: int) -> Column:
    """Round half up on the decimal value: floating noise below nine places is taken off first."""
    return F.round(F.round(col(value), 9), places)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / max(whole, 1)`` as double, so an empty whole never divides by zero."""
    return col(part).cast("double") / F.greatest(col(whole).cast("double"), F.lit(1.0))


def pct(part: Column | str, whole: Column | str, places: int = 1) -> Column:
    return tidy(ratio(part, whole) * 100, places)


def mean(value: Column | str) -> Column:
    """Mean of doubles or whole numbers.

    Where every value has at most fourteen decimal places the sum is taken exactly, so that the result does
    not depend on how rows were partitioned; else, and where that sum would be too long, it is the plain average.
    """
    given = col(value)
    exact = given.try_cast("decimal(38,14)")
    inexact = F.count_if(given.isNotNull() & ~F.coalesce(exact.cast("double") == given.cast("double"), F.lit(False)))
    total = F.try_sum(exact).cast("double") / F.nullif(F.count(given), F.lit(0))
    return F.when(inexact == 0, F.coalesce(total, F.avg(given.cast("double")))).otherwise(F.avg(given.cast("double")))


def tagged_items(lists: Mapping[str, Column], tag: str, item: str) -> Column:
    """All items of several arrays as structs of the list's name and the item; null arrays are empty."""
    def tagged(name: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.struct(F.lit(name).alias(tag), x.alias(item)))

    return F.flatten(F.filter(F.array(*(tagged(n, c) for n, c in lists.items())), lambda a: a.isNotNull()))


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def mm_ss(seconds: Column | str) -> Column:
    """``5m 07s``."""
    total = col(seconds)
    return F.format_string("%dm %02ds", F.floor(total / 60).cast("bigint"), (total % 60).cast("bigint"))


def epoch_ms(value: Column | str) -> Column:
    return F.timestamp_millis(col(value))


def week_start(moment: Column | str) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", col(moment)))


def reset_week_start(day: Column | str, first_weekday: int = 4) -> Column:
    """Start of a week that begins on another day (4 = Wednesday, counting Sunday as 1)."""
    return F.date_sub(col(day), F.pmod(F.dayofweek(col(day)) - first_weekday, F.lit(7)))


def phase_bucket(phase: Column | str) -> Column:
    phase = col(phase)
    return (F.when(phase <= 1, "Phase 1").when(phase == 2, "Phase 2").when(phase >= 3, "Phase 3+")
            .otherwise("Unknown"))


def duration_bucket(seconds: Column | str) -> Column:
    seconds = col(seconds)
    return (F.when(seconds < 60, "< 1 min").when(seconds < 180, "1-3 min").when(seconds < 300, "3-5 min")
            .otherwise("5+ min"))


def timed_run(source: Column, clear_ms: Column, par_ms: Column, upgrades: Column) -> Column:
    """The source tag decides first, then the clock, then the upgrades."""
    within = F.coalesce(clear_ms <= par_ms, F.lit(False))
    return (source == "best") | within | F.coalesce(upgrades > 0, F.lit(False))


def first_where(array: Column | str, test) -> Column:
    """First element passing the test, or null."""
    return F.get(F.filter(col(array), test), F.lit(0))


def keyed_value(array: Column | str, key: str) -> Column:
    """``value`` of the first element with that ``key``."""
    return first_where(array, lambda e: e["key"] == key)["value"]


def array_mean(array: Column | str, number, places: int = 1) -> Column:
    """Rounded mean of a number drawn from each element; missing numbers count as 0."""
    total = F.aggregate(col(array), F.lit(0).cast("bigint"),
                        lambda acc, e: acc + F.coalesce(number(e), F.lit(0).cast("bigint")))
    return tidy(ratio(total, F.size(col(array))), places)


def killing_blow(events: Column | str) -> Column:
    """First hostile damage event; the list is newest first."""
    return first_where(events, lambda e: (e["type"] == "damage") & ~e["sourceIsFriendly"])


def rank_percentile(rank: Column | str, total: Column | str) -> Column:
    """100 for the best of the ranked, 0 for the last; 100 when there is only one."""
    rank, total = col(rank), col(total)
    return F.when(total <= 1, F.lit(100.0)).otherwise(
        tidy((total - rank).cast("double") / F.nullif((total - 1).cast("double"), F.lit(0.0)) * 100, 1))
