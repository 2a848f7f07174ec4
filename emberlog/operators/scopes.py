"""Scope roll-ups: one pass over all filter levels, with 'All' for a level left open."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"


def scope_rollup(df: DataFrame, keys: Sequence[str], dims: Sequence[str], sets: Sequence[Sequence[str]],
                 measures: Mapping[str, Column], labels: Sequence[str] = ()) -> DataFrame:
    """Aggregate by several subsets of ``dims`` at once.

    ``sets`` lists the dims kept at each level. An open dim reads 'All' when it is one of
    ``labels``, else null. Give rows already summed to the finest grain: every row is repeated
    once per level before the partial aggregation.
    """
    fields = df.schema
    groups = [[F.col(c) for c in [*keys, *kept]] for kept in sets]
    agg = df.groupingSets(groups, *keys, *dims).agg(
        *[m.alias(n) for n, m in measures.items()], *[F.grouping(d).alias(f"_open_{d}") for d in dims])
    outputs = [F.col(k) for k in keys]
    for d in dims:
        open_value = F.lit(ALL) if d in labels else F.lit(None).cast(fields[d].dataType)
        outputs.append(F.when(F.col(f"_open_{d}") == 1, open_value).otherwise(F.col(d)).alias(d))
    return agg.select(*outputs, *measures)


def only_value(column: str) -> Column:
    """The value of a column where a group has exactly one distinct value, else null."""
    return F.when(F.min(column) == F.max(column), F.max(column))


def combine_sources(sources: Sequence[DataFrame], keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Full outer combination of keyed sources as one union and one aggregation.

    It groups null keys together and needs one shuffle, whatever the number of sources.
    """
    merged = sources[0]
    for source in sources[1:]:
        merged = merged.unionByName(source, allowMissingColumns=True)
    return merged.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def scope(df: DataFrame, zone: str | None = None, boss: str | None = None, difficulty: str | None = None) -> DataFrame:
    """Keep the rows of a dashboard scope; None leaves a level open."""
    for column, wanted in (("zone_name", zone), ("boss_name", boss), ("difficulty_label", difficulty)):
        if wanted is not None:
            df = df.filter(F.col(column) == wanted)
    return df
