"""Row expectations: count violations, or drop them and count the drops.

Every silver table holds its rules in ``TABLE_RULES``. They are counted while the table is written, at no
extra pass: a batch build collects them inside ``collecting()``, a stream reports them with its progress.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping
from contextvars import ContextVar
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from emberlog.functions.values import tidy

# Shared rules, name -> SQL condition.
RULES = {
    "valid_id": "id IS NOT NULL AND id > 0",
    "valid_timestamp": "created_at IS NOT NULL",
    "no_future_dates": "created_at <= current_timestamp()",
    "valid_name": "name IS NOT NULL AND length(trim(name)) > 0",
    "unique_player_per_fight": "_duplicate_count = 1",
    "ingested_at_present": "_ingested_at IS NOT NULL",
    "freshness_within_48h": "to_timestamp(_ingested_at) >= current_timestamp() - INTERVAL 48 HOURS",
}


_INGESTED = {"ingested_at_present": RULES["ingested_at_present"]}
_UNIQUE = {"unique_player_per_fight": RULES["unique_player_per_fight"]}


class TableRules(NamedTuple):
    """Rules whose violations drop a row, and rules whose violations are only counted, on the rows that are left."""

    drop: Mapping[str, str] = {}
    warn: Mapping[str, str] = {}


# Names and conditions of the rules of each table.
TABLE_RULES = {
    "silver_guild_reports": TableRules({"valid_report_code": "code IS NOT NULL AND length(code) > 0"},
                                       {"valid_start_time": "start_time_utc IS NOT NULL", **_INGESTED}),
    "silver_fight_events": TableRules({"valid_fight_id": "fight_id IS NOT NULL", "valid_report_code": "report_code IS NOT NULL",
                                       "is_raid_encounter": "encounter_id IS NOT NULL AND encounter_id > 0", "is_raid_difficulty": "difficulty IN (3, 4, 5)"}, _INGESTED),
    "silver_raid_attendance": TableRules({"valid_report_code": "report_code IS NOT NULL AND length(report_code) > 0",
                                          "valid_player_name": "player_name IS NOT NULL AND length(player_name) > 0"}, _INGESTED),
    "silver_actor_roster": TableRules({"valid_report_code": "report_code IS NOT NULL", "valid_actor_id": "actor_id IS NOT NULL",
                                       "valid_player_name": "player_name IS NOT NULL AND length(player_name) > 0"}, _INGESTED),
    "silver_player_performance": TableRules({"valid_fight_ref": "report_code IS NOT NULL AND fight_id IS NOT NULL",
                                             "valid_player_name": "player_name IS NOT NULL AND length(player_name) > 0"}, {**_UNIQUE, **_INGESTED}),
    "silver_player_rankings": TableRules({"valid_ranking_ref": "report_code IS NOT NULL AND fight_id IS NOT NULL", "valid_player_name": "player_name IS NOT NULL"},
                                         {**_UNIQUE, **_INGESTED, "rank_percent_present": "rank_percent IS NOT NULL"}),
    "silver_player_deaths": TableRules({"valid_player_name": "player_name IS NOT NULL"}, _UNIQUE),
    "silver_player_cast_events": TableRules(warn=_INGESTED),
    "silver_player_combatant_buffs": TableRules(warn=_INGESTED),
    "silver_player_cooldown_capacity": TableRules(warn=_INGESTED),
    "silver_zone_catalog": TableRules({"valid_zone_id": "zone_id IS NOT NULL", "valid_encounter_id": "encounter_id IS NOT NULL"}),
    "silver_guild_members": TableRules({"valid_name": "name IS NOT NULL", "valid_rank": "rank IS NOT NULL"}),
    "silver_guild_zone_ranks": TableRules({"valid_zone_id": "zone_id IS NOT NULL", "valid_progress": "progress_json IS NOT NULL"}),
    "silver_character_media": TableRules({"valid_player_name": "player_name IS NOT NULL"}),
    "silver_character_equipment": TableRules({"valid_player_name": "player_name IS NOT NULL"}),
    "silver_character_achievements": TableRules({"valid_player_name": "player_name IS NOT NULL"}),
    "silver_item_media": TableRules({"valid_item_id": "item_id IS NOT NULL"}),
    "silver_raiderio_player_scores": TableRules({"valid_player_name": "player_name IS NOT NULL"}),
    "silver_raiderio_player_runs": TableRules({"valid_player_name": "player_name IS NOT NULL", "valid_dungeon": "dungeon IS NOT NULL"}),
    "silver_live_raid_roster": TableRules({"valid_name": "name IS NOT NULL AND length(name) > 0"}),
}
METRICS = "table_name STRING, action STRING, rule STRING, total_rows BIGINT, failed_rows BIGINT, dropped_rows BIGINT"


def _failed(condition: str):
    return F.count_if(~F.coalesce(F.expr(condition), F.lit(False)))


def expect(df: DataFrame, rules: Mapping[str, str], observation: Observation | None = None) -> DataFrame:
    """The same rows; violations are counted while another action runs, at no extra pass."""
    metrics = [F.count(F.lit(1)).alias("rows"), *[_failed(c).alias(n) for n, c in rules.items()]]
    return df.observe(observation or "expectations", *metrics)


def expect_or_drop(df: DataFrame, rules: Mapping[str, str], observation: Observation | None = None) -> DataFrame:
    """Rows that pass all rules (a null result fails); drops are counted when observed."""
    if observation is not None:
        df = expect(df, rules, observation)
    for condition in rules.values():
        df = df.filter(condition)
    return df


def expectation_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: rows seen, failed and the failed share, from one aggregation."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[_failed(c).alias(n) for n, c in rules.items()])
    entries = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed_rows")) for n in rules])
    flat = counted.select("_rows", F.explode(entries).alias("e"))
    return flat.select("e.rule", F.col("_rows").alias("total_rows"), "e.failed_rows",
                       tidy(F.col("e.failed_rows") / F.greatest("_rows", F.lit(1)), 4).alias("failed_share"))


def _metrics(rules: Mapping[str, str]) -> list:
    """Rows, violations of each rule, and rows that break any."""
    broken = F.lit(False)
    for condition in rules.values():
        broken = broken | ~F.coalesce(F.expr(condition), F.lit(False))
    return [F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("_any"), *[_failed(c).alias(n) for n, c in rules.items()]]


def _rows(table: str, action: str, seen: Mapping[str, int]) -> list[tuple]:
    rules = getattr(TABLE_RULES[table], action)
    return [(table, action, rule, seen["rows"], seen[rule], seen["_any"] if action == "drop" else 0) for rule in rules]


class Collector:
    """Observations of the tables planned while it was active; read them after the tables are written."""

    def __init__(self):
        self.seen: list[tuple[str, str, Observation]] = []

    def rows(self) -> list[tuple]:
        """One row per table and rule, in the columns of ``METRICS``."""
        return [row for table, action, observed in self.seen for row in _rows(table, action, observed.get)]


_active: ContextVar[Collector | None] = ContextVar("collector", default=None)


@contextlib.contextmanager
def collecting() -> Iterator[Collector]:
    """Tables planned inside are observed; each of them must then be written once.

    Range partitioning reads its input twice, so a table laid out by range must be observed on what it reads.
    """
    token = _active.set(Collector())
    try:
        yield _active.get()
    finally:
        _active.reset(token)


def hold(df: DataFrame, table: str, action: str) -> DataFrame:
    """Hold rows to the rules of a table: ``drop`` leaves out those that break one, ``warn`` only counts."""
    rules = getattr(TABLE_RULES[table], action)
    if not rules:
        return df
    collector = _active.get()
    if df.isStreaming:
        df = df.observe(f"{table}:{action}", *_metrics(rules))
    elif collector is not None:
        observed = Observation(f"{table}:{action}")
        collector.seen.append((table, action, observed))
        df = df.observe(observed, *_metrics(rules))
    if action == "drop":
        for condition in rules.values():
            df = df.filter(condition)
    return df


def streamed_rows(query: StreamingQuery) -> list[tuple]:
    """The same rows from the progress of a finished stream, summed over its micro-batches."""
    sums: dict[str, dict[str, int]] = {}
    for progress in query.recentProgress:
        for name, seen in progress.get("observedMetrics", {}).items():
            total = sums.setdefault(name, {})
            for metric, value in (seen.asDict() if hasattr(seen, "asDict") else seen).items():
                total[metric] = total.get(metric, 0) + value
    return [row for name, seen in sums.items() for row in _rows(*name.split(":"), seen)]
