"""Queries over the silver tables, read from JSON landing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.plans import silver
from emberlog.workload import bronze
from emberlog.workload.domain import Domain
from emberlog.workload.registry import cte, query


@query("silver_guild_reports", "SELECT code, title, start_time_utc, end_time_utc, zone_id, zone_name FROM reports")
def guild_reports(dom: Domain) -> DataFrame:
    return silver.guild_reports(bronze.guild_reports(dom)).drop("_ingested_at", "_source")


_FIGHT_COLUMNS = ("report_code, report_title, fight_id, boss_name, encounter_id, is_kill, difficulty, fight_start_ms, duration_seconds, "
                  "boss_percentage, last_phase, fight_size, difficulty_label, outcome, zone_id, zone_name, start_time_utc, raid_night_date")


@query("silver_fight_events", f"""SELECT {_FIGHT_COLUMNS}, n AS friendly_players FROM fights JOIN
    (SELECT report_code AS rc, fight_id AS fid, COUNT(*) AS n FROM fight_players GROUP BY report_code, fight_id) p
    ON report_code = rc AND fight_id = fid""")
def fight_events(dom: Domain) -> DataFrame:
    landed = bronze.report_fights(dom)
    # Landed twice: the second landing must not double the pulls.
    out = silver.fight_events(landed.unionByName(landed), silver.guild_reports(bronze.guild_reports(dom)))
    return out.select(*_FIGHT_COLUMNS.split(", "), F.size("friendly_player_ids").cast("bigint").alias("friendly_players"))


_ATTENDANCE = "report_code, player_name, presence, player_class, presence_status, zone_id, zone_name, report_start_utc, raid_night_date"


@query("silver_raid_attendance", f"SELECT {_ATTENDANCE} FROM attendance")
def raid_attendance(dom: Domain) -> DataFrame:
    return silver.raid_attendance(bronze.raid_attendance(dom), dom["reports"]).select(*_ATTENDANCE.split(", "))


@query("silver_actor_roster", "SELECT report_code, actor_id, player_name, player_class, realm FROM actors")
def actor_roster(dom: Domain) -> DataFrame:
    return silver.actor_roster(bronze.actor_roster(dom)).drop("_ingested_at")


_PERF = ("report_code, fight_id, boss_name, encounter_id, difficulty, difficulty_label, zone_id, zone_name, duration_ms, role, actor_id, "
         "player_name, player_class, spec, avg_item_level, potion_use, healthstone_use, has_weapon_enhancement, weapon_enhancement_names, "
         "crit_rating, haste_rating, mastery_rating, versatility_rating")


@query("silver_player_performance", f"SELECT {_PERF}, CAST(1 AS BIGINT) AS _duplicate_count FROM perf")
def player_performance(dom: Domain) -> DataFrame:
    return silver.player_performance(bronze.player_details(dom)).drop("_ingested_at")


_RANKS = ("report_code, fight_id, role, player_name, player_class, spec, amount, rank_percent, bracket_percent, rank_string, total_parses")


@query("silver_player_rankings", f"SELECT {_RANKS}, CAST(1 AS BIGINT) AS _duplicate_count FROM rankings")
def player_rankings(dom: Domain) -> DataFrame:
    return silver.player_rankings(bronze.fight_rankings(dom)).select(*_RANKS.split(", "), "_duplicate_count")


@query("silver_player_deaths", """SELECT report_code, fight_id, player_name, player_class, death_timestamp_ms, overkill, killing_blow_name,
    killing_blow_id, COUNT(*) OVER (PARTITION BY report_code, fight_id, player_name, death_timestamp_ms) AS _duplicate_count FROM deaths""")
def player_deaths(dom: Domain) -> DataFrame:
    return silver.player_deaths(bronze.fight_deaths(dom)).drop("_ingested_at")


_PLACED = """(c.event_fight_id = f.fight_id OR (c.event_fight_id IS NULL AND {at} >= f.fight_start_ms
    AND {at} <= f.fight_start_ms + CAST(f.duration_seconds AS BIGINT) * 1000))"""
cte("casts", f"""SELECT DISTINCT c.report_code, COALESCE(c.event_fight_id, f.fight_id) AS fight_id, c.cast_timestamp_ms, c.actor_id, c.ability_id,
    a.player_name, a.player_class FROM raw_casts c LEFT JOIN fights f ON c.report_code = f.report_code AND {_PLACED.format(at='c.cast_timestamp_ms')}
    JOIN actors a ON c.report_code = a.report_code AND c.actor_id = a.actor_id""")
cte("buffs", f"""SELECT c.report_code, COALESCE(c.event_fight_id, f.fight_id) AS fight_id, a.player_name, a.player_class, MAX(c.spec_id) AS spec_id,
    string_agg(DISTINCT CAST(c.talent_id AS VARCHAR), ',' ORDER BY CAST(c.talent_id AS VARCHAR)) AS talent_spell_ids,
    COALESCE(BOOL_OR(aura_name IN ('Well Fed', 'Royal Roast')), FALSE) AS has_food_buff,
    string_agg(DISTINCT aura_name, ' | ' ORDER BY aura_name) FILTER (aura_name IN ('Well Fed', 'Royal Roast')) AS food_buff_names,
    COALESCE(BOOL_OR(aura_name LIKE 'Flask%' OR aura_name LIKE '%Phial%'), FALSE) AS has_flask_or_phial_buff,
    string_agg(DISTINCT aura_name, ' | ' ORDER BY aura_name) FILTER (aura_name LIKE 'Flask%' OR aura_name LIKE '%Phial%') AS flask_or_phial_names,
    COALESCE(BOOL_OR(aura_name LIKE '%Oil'), FALSE) AS has_weapon_enhancement_aura,
    string_agg(DISTINCT aura_name, ' | ' ORDER BY aura_name) FILTER (aura_name LIKE '%Oil') AS weapon_enhancement_aura_names
    FROM combatants c LEFT JOIN fights f ON c.report_code = f.report_code AND {_PLACED.format(at='c.combatant_timestamp_ms')}
    JOIN actors a ON c.report_code = a.report_code AND c.actor_id = a.actor_id
    GROUP BY c.report_code, COALESCE(c.event_fight_id, f.fight_id), a.player_name, a.player_class""")


@query("silver_player_cast_events", "SELECT * FROM casts")
def player_cast_events(dom: Domain) -> DataFrame:
    casts = silver.parsed_casts(bronze.fight_casts(dom))
    out = silver.player_cast_events(casts, dom.fights(), dom["actors"])
    return out.select("report_code", "fight_id", "cast_timestamp_ms", "actor_id", "ability_id", "player_name", "player_class")


@query("silver_player_combatant_buffs", "SELECT * FROM buffs")
def player_combatant_buffs(dom: Domain) -> DataFrame:
    combatants = silver.parsed_combatants(bronze.fight_casts(dom))
    out = silver.player_combatant_buffs(combatants, dom.fights(), dom["actors"])
    return out.withColumn("talent_spell_ids", F.array_join("talent_spell_ids", ",")).drop("_ingested_at")


@query("silver_buff_payload_events", "SELECT report_code, fight_id, timestamp_ms, actor_id, ability_name, ability_id FROM buff_events")
def buff_events(dom: Domain) -> DataFrame:
    return silver.parsed_buffs(bronze.fight_casts(dom))


@query("silver_zone_catalog", """SELECT zone_id, zone_name, zone_frozen, encounter_id, encounter_name, 'Normal,Heroic,Mythic' AS difficulty_names FROM zones""")
def zone_catalog(dom: Domain) -> DataFrame:
    return silver.zone_catalog(bronze.zone_catalog(dom)).withColumn("difficulty_names", F.array_join("difficulty_names", ",")).drop("_ingested_at")


@query("silver_guild_members", "SELECT * FROM labelled_members")
def guild_members(dom: Domain) -> DataFrame:
    return silver.guild_members(bronze.guild_members(dom))


cte("signups", "SELECT * FROM e WHERE event_type = 'signup'")
cte("newest_signup", """SELECT * FROM (SELECT signups.*, ROW_NUMBER() OVER (PARTITION BY player_name ORDER BY ts DESC) AS rn FROM signups) t WHERE rn = 1""")


@query("silver_character_media", """SELECT player_name, realm_slug, CONCAT('avatar/', k) AS avatar_url,
    CASE WHEN k % 3 > 0 THEN CONCAT('inset/', k) END AS inset_url, CASE WHEN k % 3 > 0 THEN CONCAT('main/', k) END AS main_url,
    CASE WHEN k % 3 > 0 THEN CONCAT('main-raw/', k) END AS main_raw_url FROM newest_signup""")
def character_media(dom: Domain) -> DataFrame:
    return silver.character_media(bronze.character_media(dom)).drop("snapshot_at", "_ingested_at")


@query("silver_item_media", """SELECT item_id, CONCAT('icon/', k) AS icon_url FROM (SELECT k % 20 AS item_id, k,
    ROW_NUMBER() OVER (PARTITION BY k % 20 ORDER BY ts DESC) AS rn FROM signups) t WHERE rn = 1""")
def item_media(dom: Domain) -> DataFrame:
    return silver.item_media(bronze.item_media(dom)).drop("snapshot_at", "_ingested_at")


@query("silver_character_equipment", """SELECT player_name, realm_slug, 600 + k + (k % 3 + 2) / 2 AS avg_item_level,
    CAST(k % 3 + 1 AS INT) AS equipped_item_count FROM newest_signup""")
def character_equipment(dom: Domain) -> DataFrame:
    return silver.character_equipment(bronze.character_equipment(dom)).select("player_name", "realm_slug", "avg_item_level", "equipped_item_count")


@query("silver_character_achievements", "SELECT player_name, realm_slug, k AS total_quantity, k * 10 AS total_points FROM newest_signup")
def character_achievements(dom: Domain) -> DataFrame:
    return silver.character_achievements(bronze.character_achievements(dom)).select("player_name", "realm_slug", "total_quantity", "total_points")


cte("newest_zone_rank", """SELECT * FROM (SELECT user_id % 4 AS zone_id, CONCAT('ZONE_', user_id % 4) AS zone_name, k, ts,
    ROW_NUMBER() OVER (PARTITION BY user_id % 4 ORDER BY ts DESC) AS rn FROM signups) t WHERE rn = 1""")


@query("silver_guild_zone_ranks", "SELECT zone_id, zone_name, ts AS snapshot_at FROM newest_zone_rank")
def guild_zone_ranks(dom: Domain) -> DataFrame:
    return silver.guild_zone_ranks(bronze.guild_zone_ranks(dom)).select("zone_id", "zone_name", "snapshot_at")


_SCORE = ("player_name, realm_slug, region, profile_url, season, score_all, score_dps, score_healer, score_tank, world_rank, region_rank, "
          "realm_rank, raiderio_last_crawled_at, snapshot_at")


@query("silver_raiderio_player_scores", f"SELECT {_SCORE} FROM scores")
def mplus_scores(dom: Domain) -> DataFrame:
    return silver.mplus_scores(bronze.score_profiles(dom)).select(*_SCORE.split(", "))


_RUN = ("player_name, realm_slug, region, season, source, dungeon, short_name, mythic_level, completed_at, clear_time_ms, par_time_ms, "
        "num_keystone_upgrades, map_challenge_mode_id, zone_id, score, url, timed, snapshot_at")


@query("silver_raiderio_player_runs", f"SELECT {_RUN} FROM runs")
def mplus_runs(dom: Domain) -> DataFrame:
    return silver.mplus_runs(bronze.character_profiles(dom)).select(*_RUN.split(", "))


@query("silver_live_raid_roster", "SELECT name, roster_rank, player_class, race, note, source_refreshed_at FROM live_roster")
def live_raid_roster(dom: Domain) -> DataFrame:
    return silver.live_raid_roster(bronze.live_raid_roster(dom)).drop("snapshot_at", "_ingested_at")
