"""Player identity: realm lookup per report and the key that names a character."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions.names import identity_key
from emberlog.operators.joins import lookup


def with_identity(df: DataFrame, actors: DataFrame) -> DataFrame:
    """Add ``realm`` and ``player_identity_key`` from the actor roster of the same report."""
    realms = (actors.filter(F.trim("realm") != "")
              .groupBy("report_code", F.lower("player_name").alias("_n"), F.lower("player_class").alias("_c"))
              .agg(F.max(F.trim("realm")).alias("realm")))
    joined = lookup(df, realms, [("report_code", "report_code"), (F.lower("player_name"), "_n"), (F.lower("player_class"), "_c")],
                    ["realm"])
    return (joined.withColumn("realm", F.coalesce("realm", F.lit("unknown")))
            .withColumn("player_identity_key", identity_key("player_name", "player_class", "realm")))
