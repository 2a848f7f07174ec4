"""All tables by name with the tables they read, and one function that builds them in order."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.plans import gold_boss as boss
from emberlog.plans import gold_core as core
from emberlog.plans import gold_mplus as mplus
from emberlog.plans import gold_player as player
from emberlog.plans import gold_profile as profile
from emberlog.plans import gold_readiness as readiness
from emberlog.plans import gold_wipes as wipes
from emberlog.plans import silver
from emberlog.quality.expectations import METRICS, collecting
from emberlog.session import collected, discard, stored
from emberlog.sources import payloads
from emberlog.sources.sinks import write_clustered

Table = tuple[Callable[..., DataFrame], tuple[str, ...]]

SILVER: dict[str, Table] = {
    "silver_guild_reports": (silver.guild_reports, ("guild_reports",)),
    "silver_fight_events": (silver.fight_events, ("report_fights", "silver_guild_reports")),
    "silver_raid_attendance": (silver.raid_attendance, ("raid_attendance", "silver_guild_reports")),
    "silver_actor_roster": (silver.actor_roster, ("actor_roster",)),
    "silver_player_performance": (silver.player_performance, ("player_details",)),
    "silver_player_rankings": (silver.player_rankings, ("fight_rankings",)),
    "silver_player_deaths": (silver.player_deaths, ("fight_deaths",)),
    # The cast payload is parsed once into three typed tables.
    "silver_cast_payload_events": (silver.parsed_casts, ("fight_casts",)),
    "silver_buff_payload_events": (silver.parsed_buffs, ("fight_casts",)),
    "silver_combatant_payload_events": (silver.parsed_combatants, ("fight_casts",)),
    "silver_player_cast_events": (silver.player_cast_events, ("silver_cast_payload_events", "silver_fight_events", "silver_actor_roster")),
    "silver_player_combatant_buffs": (silver.player_combatant_buffs,
                                      ("silver_combatant_payload_events", "silver_fight_events", "silver_actor_roster")),
    "silver_player_cooldown_capacity": (silver.player_cooldown_capacity, (
        "silver_fight_events", "silver_actor_roster", "silver_player_cast_events", "silver_player_combatant_buffs")),
    "silver_zone_catalog": (silver.zone_catalog, ("zone_catalog",)),
    "silver_guild_members": (silver.guild_members, ("guild_members",)),
    "silver_guild_zone_ranks": (silver.guild_zone_ranks, ("guild_zone_ranks",)),
    "silver_character_media": (silver.character_media, ("character_media",)),
    "silver_character_equipment": (silver.character_equipment, ("character_equipment",)),
    "silver_character_achievements": (silver.character_achievements, ("character_achievements",)),
    "silver_item_media": (silver.item_media, ("item_media",)),
    "silver_raiderio_player_scores": (silver.mplus_scores, ("raiderio_character_profiles",)),
    "silver_raiderio_player_runs": (silver.mplus_runs, ("raiderio_character_profiles",)),
    "silver_live_raid_roster": (silver.live_raid_roster, ("live_raid_roster",)),
}


def _utility(fights: DataFrame, actors: DataFrame, raw_casts: DataFrame) -> DataFrame:
    return wipes.player_utility_by_pull(fights, actors, silver.parsed_casts(wipes.latest_cast_payloads(raw_casts)))


_FIGHTS, _ACTORS, _REPORTS = "silver_fight_events", "silver_actor_roster", "silver_guild_reports"
_ROSTER, _RUNS, _SCORES = "gold_boss_kill_roster", "silver_raiderio_player_runs", "silver_raiderio_player_scores"

GOLD: dict[str, Table] = {
    "dim_player": (core.dim_player, (_ACTORS, "silver_raid_attendance", "silver_guild_members", "silver_player_performance")),
    "dim_guild_member": (core.dim_guild_member, ("silver_guild_members", "silver_raid_attendance")),
    "fact_player_fight_performance": (core.fact_player_fight_performance, (
        "silver_player_performance", _FIGHTS, "silver_player_rankings", "silver_player_combatant_buffs", "silver_buff_payload_events", _ACTORS)),
    "fact_player_events": (core.fact_player_events, ("silver_player_deaths", _REPORTS)),
    "gold_player_attendance": (player.player_attendance, ("silver_raid_attendance", _ACTORS)),
    _ROSTER: (player.boss_kill_roster, ("fact_player_fight_performance", _ACTORS)),
    "gold_player_performance_summary": (player.player_performance_summary, (_ROSTER,)),
    "gold_player_boss_performance": (player.player_boss_performance, (_ROSTER,)),
    "gold_boss_progression": (boss.boss_progression, (_FIGHTS,)),
    "gold_raid_summary": (boss.raid_summary, (_REPORTS, _FIGHTS)),
    "gold_progression_timeline": (boss.progression_timeline, (_FIGHTS,)),
    "gold_best_kills": (boss.best_kills, (_FIGHTS,)),
    "gold_boss_wipe_analysis": (boss.boss_wipe_analysis, (_FIGHTS,)),
    "gold_boss_progress_history": (boss.boss_progress_history, (_FIGHTS, _REPORTS)),
    "gold_boss_pull_history": (boss.boss_pull_history, (_FIGHTS, _REPORTS)),
    "gold_encounter_catalog": (boss.encounter_catalog, ("silver_zone_catalog",)),
    "gold_guild_roster": (core.guild_roster, ("dim_guild_member",)),
    "gold_raid_team": (core.raid_team, ("dim_guild_member", "dim_player")),
    "gold_player_survivability": (player.player_survivability, ("fact_player_events", _ROSTER, _ACTORS)),
    "gold_player_death_events": (player.player_death_events, ("fact_player_events", _FIGHTS, _ACTORS)),
    "gold_player_survivability_rankings": (player.player_survivability_rankings, (_ROSTER, "gold_player_death_events", "gold_raid_team")),
    "gold_boss_mechanics": (boss.boss_mechanics, (_FIGHTS,)),
    "gold_player_mplus_score_history": (mplus.score_history, (_SCORES,)),
    "gold_player_mplus_run_history": (mplus.run_history, (_RUNS,)),
    "gold_player_mplus_summary": (mplus.summary, (_SCORES, _RUNS)),
    "gold_player_mplus_weekly_activity": (mplus.weekly_activity, (_RUNS,)),
    "gold_player_mplus_dungeon_breakdown": (mplus.dungeon_breakdown, (_RUNS,)),
    "gold_weekly_activity": (boss.weekly_activity, ("gold_raid_summary",)),
    "gold_player_utility_by_pull": (_utility, (_FIGHTS, _ACTORS, "fight_casts")),
    "gold_live_raid_roster": (profile.live_raid_roster, ("silver_live_raid_roster",)),
    "gold_preparation_readiness": (readiness.preparation_readiness, (
        "gold_raid_summary", "gold_live_raid_roster", "gold_raid_team", "identity_overrides", _ROSTER)),
    "gold_wipe_survival_events": (wipes.wipe_survival_events, (
        "gold_player_death_events", "silver_player_cooldown_capacity", "silver_player_cast_events", _ACTORS)),
    "gold_wipe_cooldown_utilization": (wipes.wipe_cooldown_utilization, ("silver_player_cooldown_capacity", _ACTORS)),
    "gold_wipe_survival_discipline": (wipes.wipe_survival_discipline, (
        "gold_player_utility_by_pull", "gold_wipe_survival_events", "gold_wipe_cooldown_utilization", _ROSTER, "gold_player_death_events")),
    "gold_guild_zone_ranks": (profile.guild_zone_ranks, ("silver_guild_zone_ranks",)),
    "gold_player_character_media": (profile.player_character_media, ("silver_character_media",)),
    "gold_player_character_equipment": (profile.player_character_equipment, ("silver_character_equipment", "silver_item_media")),
    "gold_player_raid_achievements": (profile.player_raid_achievements, ("silver_character_achievements",)),
    "gold_parse_completeness_daily": (core.parse_completeness_daily, ("silver_player_rankings", _FIGHTS)),
}
TABLES = {**SILVER, **GOLD}

# landing folder, its payload column, and the kind it is parsed as
PAYLOAD_COLUMNS = (
    ("player_details", "player_details_json", "player_details"), ("fight_rankings", "rankings_json", "rankings"),
    ("fight_rankings", "rankings_hps_json", "rankings"), ("fight_deaths", "table_json", "deaths"), ("fight_casts", "events_json", "casts"),
    ("fight_casts", "buffs_json", "casts"), ("fight_casts", "combatant_info_json", "combatants"), ("guild_zone_ranks", "progress_json", "zone_progress"),
    ("character_media", "media_json", "media"), ("item_media", "media_json", "media"), ("character_equipment", "equipment_json", "equipment"),
    ("character_achievements", "achievements_json", "achievement_totals"), ("character_achievements", "achievements_json", "achievements"),
    ("raiderio_character_profiles", "profile_json", "profile"))


def _corrupt(column: str, kind: str) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: payloads.corrupt_rows(raw, column, kind)


# Landing rows whose payload cannot be read, whole as they landed: what the silver tables leave out. Usually empty.
CORRUPT: dict[str, Table] = {f"corrupt_{folder}_{column.removesuffix('_json')}_as_{kind}": (_corrupt(column, kind), (folder,)) for folder, column, kind in PAYLOAD_COLUMNS}

# Columns readers filter on, used to lay out files on write.
LAYOUT = {
    "dim_player": ("player_name",), "dim_guild_member": ("name",), "fact_player_fight_performance": ("encounter_id",),
    "fact_player_events": ("player_name",), "gold_player_attendance": ("player_name",), "gold_boss_progression": ("encounter_id",),
    "gold_boss_progress_history": ("encounter_id", "report_code"), "gold_boss_pull_history": ("encounter_id", "report_code"),
    "gold_player_death_events": ("player_name", "encounter_id"), "gold_player_survivability": ("player_name",),
}


EXPECTATIONS = "table_expectations"


class Catalog(dict):
    """Frames by table name; a missing table is planned from the ones it reads.

    ``planners`` may replace the planning of single tables, ``builds`` what they are made from. Tables named in
    ``store`` are written once to the shared folder when first used, because several others read them; after
    ``only_for`` they are deleted again when no other table that is asked for will read them.
    """

    def __init__(self, *args, store: tuple[str, ...] = (), **kwargs):
        super().__init__(*args, **kwargs)
        self.planners: dict[str, Callable[[], DataFrame]] = {}
        self.builds: dict[str, Table] = dict(TABLES)
        self.store = store
        self.readers: Counter[str] | None = None

    def reads(self, name: str) -> tuple[str, ...]:
        return self.builds[name][1] if name in self.builds and name not in self.planners else ()

    def only_for(self, names: Iterable[str]) -> None:
        """Each of ``names`` is asked for, and released by the caller, as often as it is given; every table on the way must be stored."""
        names = list(names)
        self.readers, seen = Counter(names), set()
        while names:
            if (name := names.pop()) not in seen:
                seen.add(name)
                self.readers.update(self.reads(name))
                names += self.reads(name)
        if kept := seen - set(self.store) - set(self):
            raise ValueError(f"tables that are not stored: {sorted(kept)}")

    def release(self, name: str) -> None:
        """One reader less; after the last one the stored table goes, and would be made anew if it were asked for."""
        if self.readers is not None:
            self.readers[name] -= 1
            if not self.readers[name] and name in self:
                discard(self.pop(name))

    def __missing__(self, name: str) -> DataFrame:
        inputs = [self[i] for i in self.reads(name)]
        with collected() as made:
            frame = self.planners[name]() if name in self.planners else self.builds[name][0](*inputs)
            self[name] = stored(frame) if name in self.store else frame
        if self.readers is not None:
            discard(*(t for t in made if t is not self[name]))  # steps on the way to this table alone
            for i in self.reads(name):
                self.release(i)
        return self[name]


def build_all(spark: SparkSession, bronze: Mapping[str, DataFrame], out: str, names: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """Build the tables in order; each is written once and read back by those that follow.

    Without ``names`` these are all tables, and the side tables of corrupt payloads. What the rules of the
    tables found is counted while they are written, and appended to the table ``EXPECTATIONS``.
    """
    tables: dict[str, DataFrame] = dict(bronze)
    every = {**CORRUPT, **TABLES}
    seen: list[tuple] = []
    for name in names or every:
        build, inputs = every[name]
        with collecting() as collector:
            frame = build(*[tables[i] for i in inputs])
        if name in LAYOUT:
            write_clustered(frame, f"{out}/{name}", LAYOUT[name])
        else:
            frame.write.mode("overwrite").parquet(f"{out}/{name}")
        seen += collector.rows()
        tables[name] = spark.read.parquet(f"{out}/{name}")
    # one row per rule: a few dozen
    metrics = spark.createDataFrame(seen, METRICS).withColumn("measured_at", F.current_timestamp())
    metrics.coalesce(1).write.mode("append").parquet(f"{out}/{EXPECTATIONS}")
    tables[EXPECTATIONS] = spark.read.parquet(f"{out}/{EXPECTATIONS}")
    return tables


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose the tables to SQL under their names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
