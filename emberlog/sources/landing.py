"""Landing folders: one fixed schema each, read as an incremental JSON stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberlog.quality.expectations import TABLE_RULES, TableRules

_META = "_source STRING, _ingested_at STRING"
_ZONE = "zone STRUCT<id: BIGINT, name: STRING>"
_ACTORS = "ARRAY<STRUCT<id: BIGINT, name: STRING, type: STRING, subType: STRING, server: STRING>>"
_FIGHTS = ("ARRAY<STRUCT<id: BIGINT, name: STRING, encounterID: BIGINT, kill: BOOLEAN, startTime: BIGINT, "
           "endTime: BIGINT, difficulty: BIGINT, fightPercentage: DOUBLE, bossPercentage: DOUBLE, "
           "lastPhase: BIGINT, size: BIGINT, friendlyPlayers: ARRAY<BIGINT>>>")

# folder -> (schema without the two bookkeeping fields, columns that must not be null)
_FOLDERS: dict[str, tuple[str, tuple[str, ...]]] = {
    "guild_reports": (f"code STRING, title STRING, startTime BIGINT, endTime BIGINT, {_ZONE}", ("code", "_ingested_at")),
    "report_fights": (f"code STRING, title STRING, startTime BIGINT, endTime BIGINT, {_ZONE}, "
                      f"masterData STRUCT<actors: {_ACTORS}>, fights {_FIGHTS}", ("code", "_ingested_at")),
    "raid_attendance": (f"code STRING, startTime BIGINT, {_ZONE}, "
                        "players ARRAY<STRUCT<name: STRING, presence: BIGINT, type: STRING>>", ("code", "_ingested_at")),
    "actor_roster": (f"report_code STRING, actors {_ACTORS}", ("report_code", "_ingested_at")),
    "player_details": ("report_code STRING, fight_id BIGINT, boss_name STRING, encounter_id BIGINT, difficulty BIGINT, "
                       "is_kill BOOLEAN, duration_ms BIGINT, zone_id BIGINT, zone_name STRING, "
                       "player_details_json STRING", ("report_code", "fight_id", "_ingested_at")),
    "zone_catalog": ("id BIGINT, name STRING, frozen BOOLEAN, encounters ARRAY<STRUCT<id: BIGINT, name: STRING>>, "
                     "difficulties ARRAY<STRUCT<id: BIGINT, name: STRING, sizes: ARRAY<BIGINT>>>", ("id",)),
    "fight_rankings": ("report_code STRING, rankings_json STRING, rankings_hps_json STRING", ("report_code", "rankings_json")),
    "fight_deaths": ("report_code STRING, fight_ids ARRAY<BIGINT>, table_json STRING", ("report_code", "table_json")),
    "fight_casts": ("report_code STRING, fight_ids ARRAY<BIGINT>, events_json STRING, buffs_json STRING, "
                    "combatant_info_json STRING", ("report_code", "events_json")),
    "guild_zone_ranks": ("zone_id BIGINT, zone_name STRING, progress_json STRING", ("zone_id",)),
    "guild_members": ("name STRING, realm_slug STRING, rank BIGINT, class_id BIGINT, class_name STRING, level BIGINT", ()),
    "character_media": ("player_name STRING, realm_slug STRING, media_json STRING", ("player_name",)),
    "character_equipment": ("player_name STRING, realm_slug STRING, equipment_json STRING", ("player_name",)),
    "character_achievements": ("player_name STRING, realm_slug STRING, achievements_json STRING", ("player_name",)),
    "item_media": ("item_id BIGINT, media_json STRING", ("item_id",)),
    "raiderio_character_profiles": ("player_name STRING, realm_slug STRING, region STRING, profile_url STRING, "
                                    "profile_json STRING", ("player_name", "profile_json")),
    "live_raid_roster": ("sheet_id STRING, gid STRING, csv_text STRING", ("csv_text",)),
}
FOLDERS = tuple(_FOLDERS)


def landing_schema(folder: str) -> StructType:
    return StructType.fromDDL(f"{_FOLDERS[folder][0]}, {_META}")


def landing_rules(folder: str) -> dict[str, str]:
    """Warn-only rules of a landing folder."""
    return {f"has_{c.lstrip('_')}": f"{c} IS NOT NULL" for c in _FOLDERS[folder][1]}


# The rules of the bronze tables stand beside those of the silver ones.
TABLE_RULES.update({f"bronze_{f}": TableRules(warn=landing_rules(f)) for f in FOLDERS})


def read_landing(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """Stream of a landing folder: each file once, with its path in ``_file_path``."""
    return (spark.readStream.schema(landing_schema(folder)).json(f"{root}/{folder}")
            .withColumn("_file_path", F.col("_metadata.file_path")))


def file_versions(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """Path and modification time of every landed file: a listing, which opens none of them."""
    listing = spark.read.format("binaryFile").load(f"{root}/{folder}").select("path", "modificationTime")
    return listing.withColumnRenamed("modificationTime", "modified_at")


def read_versions(spark: SparkSession, folder: str, paths: list[str]) -> DataFrame:
    """Rows of the given files of a landing folder, each with the version of the file it comes from."""
    return (spark.read.schema(landing_schema(folder)).json(paths)
            .select("*", F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.file_modification_time").alias("_modified_at")))
