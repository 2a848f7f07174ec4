"""Queries over the gold tables, planned from flat silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.plans import gold_wipes, silver
from emberlog.plans.gold_readiness import preparation_readiness
from emberlog.plans.pipeline import Catalog
from emberlog.workload import bronze
from emberlog.workload.domain import Domain
from emberlog.workload.registry import cte, mean, query


def parsed_casts(dom: Domain) -> DataFrame:
    """Cast events as the payload parser gives them."""
    null = F.lit(None)
    return dom["raw_casts"].select(
        "report_code", "event_fight_id", "cast_timestamp_ms", "actor_id", null.cast("bigint").alias("target_actor_id"),
        null.cast("string").alias("ability_name"), "ability_id", null.cast("string").alias("ability_icon"), "_ingested_at")


# Tables that many others read; queries deep in the chain store them.
SHARED = ("silver_fight_events", "silver_player_cast_events", "silver_player_combatant_buffs", "silver_player_cooldown_capacity",
          "gold_boss_kill_roster", "gold_player_death_events", "gold_wipe_survival_events", "silver_actor_roster", "gold_raid_team")
READY = ("silver_fight_events", "silver_player_combatant_buffs", "gold_boss_kill_roster", "gold_raid_summary", "gold_raid_team")


def catalog(dom: Domain, store: tuple[str, ...] = ()) -> Catalog:
    """All tables, from the silver level of the domain upwards."""
    def combatants() -> DataFrame:
        return dom["combatants"].select(
            "report_code", "event_fight_id", "combatant_timestamp_ms", "actor_id", "spec_id", F.array("aura_name").alias("aura_names"),
            F.array(F.col("talent_id").cast("string")).alias("talent_spell_ids"), "_ingested_at")

    def zones() -> DataFrame:
        return dom["zones"].withColumn("difficulty_names", F.array(*[F.lit(n) for n in rules.DIFFICULTIES.values()]))

    tables = Catalog(store=store)
    tables.planners.update({
        "silver_guild_reports": lambda: dom["reports"].drop("start_ms", "end_ms", "raid_night_date"),
        "silver_fight_events": dom.fights,
        "silver_raid_attendance": lambda: dom["attendance"],
        "silver_actor_roster": lambda: dom["actors"],
        "silver_player_performance": lambda: dom["perf"],
        "silver_player_rankings": lambda: dom["rankings"],
        "silver_player_deaths": lambda: dom["deaths"].drop("event_id"),
        "silver_cast_payload_events": lambda: parsed_casts(dom),
        "silver_buff_payload_events": lambda: dom["buff_events"].drop("event_id"),
        "silver_combatant_payload_events": combatants,
        "silver_guild_members": lambda: dom["labelled_members"],
        "silver_zone_catalog": zones,
        "silver_raiderio_player_scores": lambda: dom["scores"],
        "silver_raiderio_player_runs": lambda: dom["runs"],
        "silver_live_raid_roster": lambda: dom["live_roster"],
        "identity_overrides": lambda: dom["overrides"],
        "silver_character_media": lambda: silver.character_media(bronze.character_media(dom)),
        "silver_character_equipment": lambda: silver.character_equipment(bronze.character_equipment(dom)),
        "silver_character_achievements": lambda: silver.character_achievements(bronze.character_achievements(dom)),
        "silver_item_media": lambda: silver.item_media(bronze.item_media(dom)),
        "silver_guild_zone_ranks": lambda: silver.guild_zone_ranks(bronze.guild_zone_ranks(dom)),
    })
    tables.builds["gold_player_utility_by_pull"] = (gold_wipes.player_utility_by_pull, ("silver_fight_events", "silver_actor_roster", "silver_cast_payload_events"))
    return tables


def joined_text(df: DataFrame, *columns: str) -> DataFrame:
    """Array columns as comma text."""
    for column in columns:
        df = df.withColumn(column, F.array_join(column, ","))
    return df


def gold(name: str, sql: str | None, *arrays: str, store: tuple[str, ...] = ()):
    """Register a gold table under its own name; other statements read it as ``t_<name>``."""
    cte(f"t_{name}", sql)

    @query(name, sql)
    def run(dom: Domain) -> DataFrame:
        inputs = tuple(t for t in store if t != name)
        return joined_text(catalog(dom, inputs)[name], *arrays).drop("_ingested_at")


KEY = "LOWER(CONCAT({n}, ':', {c}, ':', COALESCE({r}, 'unknown')))"
_BOSS = "encounter_id, boss_name, zone_name, difficulty, difficulty_label"

# --- bosses, raids, weeks ------------------------------------------------------------------

gold("gold_boss_progression", f"""SELECT encounter_id, boss_name, zone_id, zone_name, difficulty, difficulty_label, COUNT(*) AS total_pulls,
    COUNT(*) FILTER (is_kill) AS total_kills, COUNT(*) FILTER (NOT is_kill) AS total_wipes, MIN(duration_seconds) FILTER (is_kill) AS best_kill_seconds,
    {mean('duration_seconds')} AS avg_pull_duration_seconds, MAX(CASE WHEN is_kill THEN TRUE END) AS is_killed,
    MIN(raid_night_date) FILTER (is_kill) AS first_kill_date, MAX(raid_night_date) AS last_attempt_date,
    ROUND(COUNT(*) FILTER (NOT is_kill) / GREATEST(COUNT(*) FILTER (is_kill), 1), 2) AS wipe_to_kill_ratio
    FROM fights GROUP BY encounter_id, boss_name, zone_id, zone_name, difficulty, difficulty_label""")
cte("raid_summary", """SELECT r.code AS report_code, r.title AS report_title, r.start_time_utc, r.end_time_utc, MAX(f.zone_id) AS zone_id,
    MAX(f.zone_name) AS zone_name, MAX(f.raid_night_date) AS raid_night_date, ARG_MIN(f.difficulty_label, f.fight_id) AS primary_difficulty,
    COUNT(f.fight_id) AS total_pulls, COUNT(*) FILTER (f.is_kill) AS boss_kills, COUNT(*) FILTER (NOT f.is_kill) AS total_wipes,
    CAST(SUM(f.duration_seconds) AS BIGINT) AS total_fight_seconds, COUNT(DISTINCT f.encounter_id) AS unique_bosses_engaged,
    COUNT(DISTINCT f.encounter_id) FILTER (f.is_kill) AS unique_bosses_killed
    FROM reports r LEFT JOIN fights f ON r.code = f.report_code GROUP BY r.code, r.title, r.start_time_utc, r.end_time_utc""")
gold("gold_raid_summary", "SELECT * FROM raid_summary")
gold("gold_progression_timeline", f"""SELECT {_BOSS}, raid_night_date,
    COUNT(*) OVER (PARTITION BY difficulty ORDER BY raid_night_date, encounter_id ROWS UNBOUNDED PRECEDING) AS cumulative_kills
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY encounter_id, difficulty ORDER BY raid_night_date, report_code, fight_id) AS rn
    FROM fights WHERE is_kill) t WHERE rn = 1""")
gold("gold_best_kills", f"""SELECT {_BOSS}, MIN(duration_seconds) AS best_kill_seconds, {mean('duration_seconds')} AS avg_kill_seconds,
    COUNT(*) AS total_kills, MIN(raid_night_date) AS first_kill_date, MAX(raid_night_date) AS latest_kill_date,
    printf('%dm %02ds', MIN(duration_seconds) // 60, MIN(duration_seconds) % 60) AS best_kill_mm_ss FROM fights WHERE is_kill GROUP BY {_BOSS}""")
gold("gold_boss_wipe_analysis", f"""SELECT {_BOSS}, COUNT(*) AS total_wipes, MIN(boss_percentage) AS best_wipe_pct, CAST(SUM(CAST(boss_percentage AS DECIMAL(28,12))) AS DOUBLE) / COUNT(boss_percentage) AS avg_wipe_pct,
    {mean('last_phase')} AS avg_last_phase, MAX(last_phase) AS max_phase_reached, {mean('duration_seconds')} AS avg_wipe_duration_seconds,
    MAX(duration_seconds) AS longest_wipe_seconds, MIN(raid_night_date) AS first_wipe_date, MAX(raid_night_date) AS latest_wipe_date,
    COUNT(DISTINCT raid_night_date) AS raid_nights_attempted, ROUND({mean('boss_percentage')}, 1) AS avg_wipe_pct_rounded
    FROM fights WHERE NOT is_kill GROUP BY {_BOSS}""")
cte("progress_history", f"""SELECT {_BOSS}, f.raid_night_date, f.report_code, MAX(r.title) AS report_title, MAX(r.start_time_utc) AS start_time_utc,
    MAX(r.end_time_utc) AS end_time_utc, COUNT(*) AS pulls_on_night, COUNT(*) FILTER (is_kill) AS kills_on_night,
    COUNT(*) FILTER (NOT is_kill) AS wipes_on_night, MIN(boss_percentage) FILTER (NOT is_kill) AS best_wipe_pct_on_night,
    ROUND({mean('CASE WHEN NOT is_kill THEN boss_percentage END')}, 2) AS avg_wipe_pct_on_night,
    CASE WHEN BOOL_OR(is_kill) THEN 0.0::DOUBLE ELSE ROUND(MIN(boss_percentage) FILTER (NOT is_kill), 2) END AS best_boss_hp_remaining,
    BOOL_OR(is_kill) AS is_kill_on_night, MAX(duration_seconds) FILTER (is_kill) AS kill_duration_seconds, MAX(duration_seconds) AS longest_pull_seconds
    FROM (SELECT * EXCLUDE (zone_id, start_time_utc) FROM fights) f JOIN (SELECT code, title, start_time_utc, end_time_utc FROM reports) r
    ON f.report_code = r.code GROUP BY {_BOSS}, f.raid_night_date, f.report_code""")
gold("gold_boss_progress_history", "SELECT * FROM progress_history")
gold("gold_boss_pull_history", f"""SELECT f.encounter_id, f.boss_name, f.zone_name, f.difficulty, f.difficulty_label, f.raid_night_date, f.report_code,
    r.title AS report_title, r.start_time_utc, r.end_time_utc, fight_id, is_kill, boss_percentage,
    CASE WHEN is_kill THEN 0.0::DOUBLE ELSE boss_percentage END AS boss_hp_remaining, duration_seconds, last_phase
    FROM fights f JOIN reports r ON f.report_code = r.code""")
gold("gold_encounter_catalog", """SELECT zone_id, zone_name, encounter_id, encounter_name, 'Normal,Heroic,Mythic' AS difficulty_names
    FROM zones WHERE NOT zone_frozen""", "difficulty_names")
_P = "COUNT(*) FILTER ({c})"
cte("boss_mechanics", f"""WITH w AS (SELECT *, date_trunc('week', raid_night_date) AS wk FROM fights WHERE NOT is_kill),
    recent AS (SELECT encounter_id, difficulty, ARG_MAX(m, wk) AS last_mean FROM (SELECT encounter_id, difficulty, wk, {mean('boss_percentage')} AS m
    FROM w GROUP BY encounter_id, difficulty, wk) x GROUP BY encounter_id, difficulty),
    a AS (SELECT {_BOSS}, COUNT(*) AS total_wipes, {mean('boss_percentage')} AS m, COUNT(*) FILTER (last_phase <= 1) AS p1,
    COUNT(*) FILTER (last_phase = 2) AS p2, COUNT(*) FILTER (last_phase >= 3) AS p3, COUNT(*) FILTER (duration_seconds < 60) AS wipes_lt_1min,
    COUNT(*) FILTER (duration_seconds >= 60 AND duration_seconds < 180) AS wipes_1_3min,
    COUNT(*) FILTER (duration_seconds >= 180 AND duration_seconds < 300) AS wipes_3_5min, COUNT(*) FILTER (duration_seconds >= 300) AS wipes_5plus_min
    FROM w GROUP BY {_BOSS})
    SELECT a.encounter_id, boss_name, zone_name, a.difficulty, difficulty_label, total_wipes, ROUND(m, 1) AS avg_boss_pct,
    ROUND(p1 / total_wipes * 100, 1) AS pct_wipes_phase_1, ROUND(p2 / total_wipes * 100, 1) AS pct_wipes_phase_2,
    ROUND(p3 / total_wipes * 100, 1) AS pct_wipes_phase_3_plus, wipes_lt_1min, wipes_1_3min, wipes_3_5min, wipes_5plus_min,
    ROUND(last_mean, 1) AS last_week_avg_boss_pct, ROUND(last_mean - m, 2) AS progress_trend,
    CASE WHEN ROUND(last_mean - m, 2) < 0 THEN 'improving' WHEN ROUND(last_mean - m, 2) > 0 THEN 'regressing' ELSE 'flat' END AS trend_direction
    FROM a JOIN recent ON a.encounter_id = recent.encounter_id AND a.difficulty = recent.difficulty""")
gold("gold_boss_mechanics", "SELECT * FROM boss_mechanics")
gold("gold_weekly_activity", """SELECT date_trunc('week', start_time_utc) AS week_start, COUNT(*) AS raid_nights, CAST(SUM(boss_kills) AS BIGINT) AS total_boss_kills,
    CAST(SUM(total_wipes) AS BIGINT) AS total_wipes, CAST(SUM(total_pulls) AS BIGINT) AS total_pulls, CAST(SUM(total_fight_seconds) AS BIGINT) AS total_raid_seconds,
    string_agg(DISTINCT zone_name, ',' ORDER BY zone_name) AS zones_raided FROM raid_summary WHERE zone_name <> 'Blackrock Depths'
    GROUP BY date_trunc('week', start_time_utc)""", "zones_raided")

# --- dimensions and facts ------------------------------------------------------------------

cte("dim_player", """SELECT p.player_name, p.player_class, p.realm, m.name IS NOT NULL AS is_guild_member, m.rank, m.rank_label, m.rank_category,
    COALESCE(m.is_raid_team, FALSE) AS is_raid_team, a.first_seen_date, a.last_seen_date
    FROM (SELECT DISTINCT player_name, player_class, realm FROM actors) p LEFT JOIN labelled_members m ON LOWER(p.player_name) = LOWER(m.name)
    LEFT JOIN (SELECT player_name, MIN(raid_night_date) AS first_seen_date, MAX(raid_night_date) AS last_seen_date FROM attendance GROUP BY player_name) a
    ON p.player_name = a.player_name""")
gold("dim_player", "SELECT * FROM dim_player")
cte("dim_member", """SELECT m.name, m.realm_slug, m.rank, m.rank_label, m.rank_category, m.is_raid_team, m.class_id, m.class_name, m.level,
    COALESCE(t, 0) AS total_raids_tracked, COALESCE(p, 0) AS raids_present, ROUND(COALESCE(p, 0) / GREATEST(COALESCE(t, 0), 1) * 100, 1) AS attendance_rate_pct,
    last_raid_date, first_raid_date, ROUND(COALESCE(p, 0) / GREATEST(COALESCE(t, 0), 1) * 100, 1) >= 25 OR rank IN (0, 1, 2) AS is_active, m.name AS possible_main
    FROM labelled_members m LEFT JOIN (SELECT LOWER(player_name) AS n, COUNT(*) AS t, COUNT(*) FILTER (presence = 1) AS p, MAX(raid_night_date) AS last_raid_date,
    MIN(raid_night_date) AS first_raid_date FROM attendance GROUP BY LOWER(player_name)) a ON LOWER(m.name) = a.n""")
gold("dim_guild_member", "SELECT * FROM dim_member")
cte("potions", """SELECT b.report_code, b.fight_id, a.player_name, COUNT(DISTINCT timestamp_ms) AS combat_potion_casts,
    string_agg(DISTINCT ability_name, ' | ' ORDER BY ability_name) AS combat_potion_names FROM buff_events b JOIN actors a
    ON b.report_code = a.report_code AND b.actor_id = a.actor_id WHERE ability_name IN ('Light''s Potential', 'Potion of Recklessness')
    OR ability_id IN (1236616, 1236994, 1238443, 1237154) GROUP BY b.report_code, b.fight_id, a.player_name""")
cte("fact", """SELECT p.report_code, p.fight_id, f.encounter_id, f.boss_name, f.zone_name, f.difficulty, f.difficulty_label, f.raid_night_date, f.is_kill,
    f.duration_seconds, p.player_name, p.player_class, p.role, p.spec, p.avg_item_level, CAST(po.combat_potion_casts IS NOT NULL AS INT) AS potion_use,
    po.combat_potion_casts, po.combat_potion_names, p.healthstone_use, COALESCE(b.has_food_buff, FALSE) AS has_food_buff, b.food_buff_names,
    COALESCE(b.has_flask_or_phial_buff, FALSE) AS has_flask_or_phial_buff, b.flask_or_phial_names,
    p.has_weapon_enhancement OR COALESCE(b.has_weapon_enhancement_aura, FALSE) AS has_weapon_enhancement,
    NULLIF(CONCAT_WS(' | ', p.weapon_enhancement_names, b.weapon_enhancement_aura_names), '') AS weapon_enhancement_names,
    p.crit_rating, p.haste_rating, p.mastery_rating, p.versatility_rating, CAST(TRUNC(r.amount) AS BIGINT) AS throughput_per_second, r.rank_percent,
    r.bracket_percent, r.rank_string FROM perf p JOIN fights f ON p.report_code = f.report_code AND p.fight_id = f.fight_id AND f.is_kill
    LEFT JOIN rankings r ON p.report_code = r.report_code AND p.fight_id = r.fight_id AND p.player_name = r.player_name
    LEFT JOIN buffs b ON p.report_code = b.report_code AND p.fight_id = b.fight_id AND p.player_name = b.player_name
    LEFT JOIN potions po ON p.report_code = po.report_code AND p.fight_id = po.fight_id AND p.player_name = po.player_name""")
gold("fact_player_fight_performance", "SELECT * FROM fact")
cte("death_facts", """SELECT d.report_code, d.fight_id, d.player_name, d.player_class, d.death_timestamp_ms, d.overkill, d.killing_blow_name, d.killing_blow_id,
    r.zone_name, r.zone_id, r.raid_night_date FROM deaths d JOIN reports r ON d.report_code = r.code""")
gold("fact_player_events", "SELECT * FROM death_facts")
gold("gold_guild_roster", """SELECT name, class_name AS player_class, realm_slug AS realm, rank, rank_label, rank_category, is_raid_team, is_active,
    total_raids_tracked, raids_present, attendance_rate_pct, last_raid_date, first_raid_date FROM dim_member""")
cte("raid_team", """SELECT name, class_name AS player_class, realm_slug AS realm, rank, rank_label, rank_category, is_active, total_raids_tracked, raids_present,
    attendance_rate_pct, last_raid_date, first_raid_date, possible_main, LENGTH(name) >= 5 AND LOWER(SUBSTR(name, 1, 5)) IN
    (SELECT LOWER(SUBSTR(player_name, 1, 5)) FROM dim_player WHERE NOT is_guild_member) AS has_possible_alt_in_logs FROM dim_member WHERE is_raid_team""")
gold("gold_raid_team", "SELECT * FROM raid_team")
gold("gold_parse_completeness_daily", """SELECT f.raid_night_date, r.role, COUNT(*) AS player_rows, COUNT(*) FILTER (rank_percent IS NULL) AS null_rank_rows,
    COUNT(*) FILTER (rank_percent IS NULL) / COUNT(*) AS null_rank_pct FROM rankings r JOIN fights f ON r.report_code = f.report_code AND r.fight_id = f.fight_id
    GROUP BY f.raid_night_date, r.role""")

# --- players -------------------------------------------------------------------------------

cte("who", f"""SELECT DISTINCT report_code, player_name AS who_name, COALESCE(realm, 'unknown') AS realm,
    {KEY.format(n='player_name', c='player_class', r='realm')} AS player_identity_key FROM actors""")
gold("gold_player_attendance", """SELECT player_identity_key, player_name, player_class, w.realm AS player_realm, COUNT(*) AS total_raids_tracked,
    COUNT(*) FILTER (presence = 1) AS raids_present, COUNT(*) FILTER (presence = 2) AS raids_benched, COUNT(*) FILTER (presence = 3) AS raids_absent,
    MAX(raid_night_date) AS last_raid_date, MIN(raid_night_date) AS first_raid_date, string_agg(DISTINCT zone_name, ',' ORDER BY zone_name) AS zones_attended,
    ROUND(COUNT(*) FILTER (presence = 1) / COUNT(*) * 100, 1) AS attendance_rate_pct FROM attendance a JOIN who w
    ON a.report_code = w.report_code AND a.player_name = w.who_name GROUP BY player_identity_key, player_name, player_class, w.realm""", "zones_attended")
cte("kill_roster", """SELECT f.report_code, fight_id, boss_name, encounter_id, difficulty, difficulty_label, zone_name, raid_night_date, duration_seconds,
    player_identity_key, player_name, player_class, realm, role, spec, avg_item_level, potion_use, combat_potion_casts, combat_potion_names, healthstone_use,
    has_food_buff, food_buff_names, has_flask_or_phial_buff, flask_or_phial_names, has_weapon_enhancement, weapon_enhancement_names, throughput_per_second,
    rank_percent, bracket_percent, rank_string FROM fact f JOIN who w ON f.report_code = w.report_code AND f.player_name = w.who_name""")
gold("gold_boss_kill_roster", "SELECT * FROM kill_roster")
_STATS = f"""CAST(TRUNC({mean('throughput_per_second')}) AS BIGINT) AS avg_throughput_per_second, MAX(throughput_per_second) AS best_throughput_per_second,
    ROUND({mean('rank_percent')}, 1) AS avg_rank_percent, ROUND(MAX(rank_percent), 1) AS best_rank_percent, ROUND({mean('avg_item_level')}, 1) AS avg_item_level"""
_WHO = "player_identity_key, player_name, player_class, realm"
cte("performance_summary", f"""SELECT {_WHO}, k.role, primary_spec, kills_tracked, avg_throughput_per_second, best_throughput_per_second, avg_rank_percent,
    best_rank_percent, avg_item_level, last_seen_date FROM (SELECT {_WHO}, role, COUNT(*) AS kills_tracked, {_STATS}, MAX(raid_night_date) AS last_seen_date
    FROM kill_roster GROUP BY {_WHO}, role) k LEFT JOIN (SELECT key2, role AS role2, spec AS primary_spec FROM (SELECT player_identity_key AS key2, role, spec,
    ROW_NUMBER() OVER (PARTITION BY player_identity_key, role ORDER BY COUNT(*) DESC, spec) AS rn FROM kill_roster GROUP BY player_identity_key, role, spec) s
    WHERE rn = 1) m ON k.player_identity_key = m.key2 AND k.role = m.role2""")
gold("gold_player_performance_summary", "SELECT * FROM performance_summary")
cte("boss_performance", f"""SELECT {_WHO}, role, primary_spec, {_BOSS}, kills_on_boss, avg_throughput_per_second, best_throughput_per_second,
    latest_throughput_per_second, CASE WHEN kills_on_boss > 1 THEN ROUND((latest_throughput_per_second - avg_throughput_per_second)
    / GREATEST(CAST(avg_throughput_per_second AS DOUBLE), 1) * 100, 1) END AS throughput_trend, avg_rank_percent, best_rank_percent, avg_item_level,
    first_kill_date, latest_kill_date FROM (SELECT {_WHO}, role, {_BOSS}, COUNT(*) AS kills_on_boss, {_STATS}, MIN(raid_night_date) AS first_kill_date,
    MAX(raid_night_date) AS latest_kill_date, ARG_MIN(spec, (raid_night_date, report_code, fight_id)) AS primary_spec
    FROM kill_roster GROUP BY {_WHO}, role, {_BOSS}) k JOIN (SELECT player_identity_key AS k2, encounter_id AS e2, difficulty AS d2,
    ARG_MAX(throughput_per_second, (raid_night_date, report_code, fight_id)) AS latest_throughput_per_second FROM kill_roster GROUP BY player_identity_key,
    encounter_id, difficulty) l ON player_identity_key = k2 AND encounter_id = e2 AND difficulty = d2""")
gold("gold_player_boss_performance", "SELECT * FROM boss_performance")
cte("blow_counts", """SELECT player_identity_key, killing_blow_name, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY player_identity_key
    ORDER BY COUNT(*) DESC, killing_blow_name) AS rn FROM death_facts d JOIN who w ON d.report_code = w.report_code AND d.player_name = w.who_name
    WHERE killing_blow_name IS NOT NULL GROUP BY player_identity_key, killing_blow_name""")
gold("gold_player_survivability", f"""SELECT d.*, COALESCE(kills_tracked, 0) AS kills_tracked,
    ROUND(total_deaths / GREATEST(COALESCE(kills_tracked, 0), 1), 2) AS deaths_per_kill, b.killing_blow_name AS most_common_killing_blow,
    b.n AS most_common_killing_blow_count, t.top_killing_blows_json FROM (SELECT {_WHO}, COUNT(*) AS total_deaths,
    string_agg(DISTINCT zone_name, ',' ORDER BY zone_name) AS zones_died_in, MAX(death_timestamp_ms) AS last_death_timestamp_ms FROM death_facts d JOIN who w
    ON d.report_code = w.report_code AND d.player_name = w.who_name GROUP BY {_WHO}) d
    LEFT JOIN (SELECT player_identity_key AS k2, COUNT(*) AS kills_tracked FROM kill_roster GROUP BY player_identity_key) k ON d.player_identity_key = k2
    LEFT JOIN (SELECT player_identity_key AS k3, killing_blow_name, n FROM blow_counts WHERE rn = 1) b ON d.player_identity_key = k3
    LEFT JOIN (SELECT player_identity_key AS k4, CONCAT('[', string_agg(CONCAT('{{"name":"', killing_blow_name, '","count":', n, '}}'), ',' ORDER BY rn), ']')
    AS top_killing_blows_json FROM blow_counts WHERE rn <= 3 GROUP BY player_identity_key) t ON d.player_identity_key = k4""", "zones_died_in")
cte("death_events", f"""SELECT d.report_code, d.fight_id, f.encounter_id, f.boss_name, f.zone_name, f.zone_id, f.difficulty, f.difficulty_label, f.raid_night_date,
    f.is_kill, {_WHO}, death_timestamp_ms, f.fight_start_ms, overkill, killing_blow_name, killing_blow_id FROM deaths d JOIN fights f
    ON d.report_code = f.report_code AND d.fight_id = f.fight_id JOIN who w ON d.report_code = w.report_code AND d.player_name = w.who_name
    WHERE f.encounter_id > 0""")


@query("gold_player_death_events", "SELECT *, TRUE AS key_is_unique FROM death_events")
def death_events(dom: Domain) -> DataFrame:
    """The key is a hash the check engine lacks, so it is replaced by whether it is unique."""
    events = catalog(dom)["gold_player_death_events"]
    repeated = events.groupBy("death_event_key").count().filter("count > 1").select("death_event_key", F.lit(False).alias("_once"))
    return events.join(repeated, "death_event_key", "left").withColumn("key_is_unique", F.coalesce("_once", F.lit(True))).drop("death_event_key", "_once")


_EIGHT = """GROUPING SETS ((player_identity_key, zone_name, boss_name, difficulty_label), (player_identity_key, zone_name, difficulty_label),
    (player_identity_key, boss_name, difficulty_label), (player_identity_key, difficulty_label), (player_identity_key, zone_name, boss_name),
    (player_identity_key, boss_name), (player_identity_key, zone_name), (player_identity_key))"""
_OPEN = """CASE WHEN GROUPING(zone_name) = 1 THEN 'All' ELSE zone_name END AS zone_name, CASE WHEN GROUPING(boss_name) = 1 THEN 'All' ELSE boss_name END AS boss_name,
    CASE WHEN GROUPING(difficulty_label) = 1 THEN 'All' ELSE difficulty_label END AS difficulty_label"""
cte("survivability_rankings", f"""WITH team AS (SELECT LOWER(name) AS n FROM raid_team),
    kb AS (SELECT * FROM kill_roster WHERE zone_name <> 'Blackrock Depths' AND LOWER(player_name) IN (SELECT n FROM team)),
    db AS (SELECT * FROM death_events WHERE zone_name <> 'Blackrock Depths' AND LOWER(player_name) IN (SELECT n FROM team)),
    sk AS (SELECT player_identity_key, MAX(player_name) AS player_name, MAX(player_class) AS player_class, {_OPEN},
    CASE WHEN GROUPING(boss_name) = 1 OR COUNT(DISTINCT encounter_id) <> 1 THEN NULL ELSE MAX(encounter_id) END AS encounter_id,
    CASE WHEN GROUPING(difficulty_label) = 1 OR COUNT(DISTINCT difficulty) <> 1 THEN NULL ELSE MAX(difficulty) END AS difficulty, COUNT(*) AS kills
    FROM kb GROUP BY {_EIGHT}),
    sd AS (SELECT player_identity_key, {_OPEN}, COUNT(*) AS deaths FROM db GROUP BY {_EIGHT}),
    j AS (SELECT sk.*, COALESCE(sd.deaths, 0) AS deaths, COALESCE(sd.deaths, 0) / GREATEST(kills, 1) AS rate FROM sk LEFT JOIN sd
    ON sk.player_identity_key = sd.player_identity_key AND sk.zone_name = sd.zone_name AND sk.boss_name = sd.boss_name AND sk.difficulty_label = sd.difficulty_label),
    r AS (SELECT *, RANK() OVER (PARTITION BY zone_name, boss_name, difficulty_label ORDER BY rate, deaths, player_identity_key) AS survivability_rank,
    COUNT(*) OVER (PARTITION BY zone_name, boss_name, difficulty_label) AS survivability_rank_total FROM j)
    SELECT player_identity_key, player_name, player_class, zone_name, encounter_id, boss_name, difficulty, difficulty_label, deaths, kills,
    ROUND(rate, 4) AS deaths_per_kill, survivability_rank, survivability_rank_total, CASE WHEN survivability_rank_total <= 1 THEN 100.0::DOUBLE ELSE
    ROUND((survivability_rank_total - survivability_rank) / (survivability_rank_total - 1) * 100, 1) END AS survivability_rank_percentile FROM r""")
gold("gold_player_survivability_rankings", "SELECT * FROM survivability_rankings", store=SHARED)

# --- dungeon runs --------------------------------------------------------------------------

_MKEY = "LOWER(CONCAT(player_name, ':unknown:', realm_slug)) AS player_identity_key"
_RS = ", ".join(f"ROUND(score_{r}, 1) AS score_{r}" for r in ("all", "dps", "healer", "tank"))
_MWHO = "player_name, realm_slug, region, season"
_MBEST = "timed DESC, mythic_level DESC, score DESC, completed_at DESC"
gold("gold_player_mplus_score_history", f"""SELECT {_MKEY}, player_name, realm_slug, region, profile_url, season, snapshot_at, CAST(snapshot_at AS DATE) AS snapshot_date,
    {_RS}, world_rank, region_rank, realm_rank, raiderio_last_crawled_at FROM scores""")
gold("gold_player_mplus_run_history", f"""SELECT {_MKEY}, {_MWHO}, source, dungeon, short_name, mythic_level, score, completed_at,
    CAST(completed_at AS DATE) AS completed_date, clear_time_ms, par_time_ms, num_keystone_upgrades, timed, url, snapshot_at FROM runs""")
_RC = "COUNT(*) AS total_runs, COUNT(*) FILTER (timed) AS timed_runs, COUNT(*) FILTER (NOT timed) AS untimed_runs"
cte("mplus_summary", f"""WITH latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {_MWHO} ORDER BY snapshot_at DESC) AS rn FROM scores) t WHERE rn = 1),
    counts AS (SELECT player_name, {_RC}, MAX(mythic_level) FILTER (timed) AS highest_timed_level, MAX(mythic_level) FILTER (NOT timed) AS highest_untimed_level
    FROM runs GROUP BY player_name),
    best AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY player_name ORDER BY {_MBEST}) AS rn FROM runs) t WHERE rn = 1),
    modal AS (SELECT * FROM (SELECT player_name, mythic_level, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY player_name ORDER BY COUNT(*) DESC, mythic_level DESC) AS rn
    FROM runs GROUP BY player_name, mythic_level) t WHERE rn = 1),
    s AS (SELECT LOWER(CONCAT(l.player_name, ':unknown:', l.realm_slug)) AS player_identity_key, l.player_name, l.realm_slug, l.region, profile_url, l.season, l.snapshot_at, {_RS.replace('score_all, 1) AS', 'score_all, 1) AS')},
    world_rank, region_rank, realm_rank, COALESCE(total_runs, 0) AS total_runs, COALESCE(timed_runs, 0) AS timed_runs, COALESCE(untimed_runs, 0) AS untimed_runs,
    highest_timed_level, highest_untimed_level, m.mythic_level AS most_common_key_level, COALESCE(m.n, 0) AS most_common_key_count, b.dungeon AS best_run_dungeon,
    b.short_name AS best_run_short_name, b.mythic_level AS best_run_level, ROUND(b.score, 1) AS best_run_score, b.timed AS best_run_timed,
    b.completed_at AS best_run_completed_at, b.url AS best_run_url FROM latest l LEFT JOIN counts c ON l.player_name = c.player_name
    LEFT JOIN best b ON l.player_name = b.player_name LEFT JOIN modal m ON l.player_name = m.player_name),
    r AS (SELECT *, CASE WHEN COALESCE(score_all, 0) > 0 THEN RANK() OVER (PARTITION BY season ORDER BY score_all DESC NULLS LAST, player_name) END AS guild_mplus_rank,
    CAST(SUM(CASE WHEN COALESCE(score_all, 0) > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY season) AS BIGINT) AS guild_mplus_rank_total FROM s)
    SELECT *, CASE WHEN guild_mplus_rank_total <= 1 THEN 100.0::DOUBLE WHEN guild_mplus_rank IS NOT NULL THEN
    ROUND((guild_mplus_rank_total - guild_mplus_rank) / (guild_mplus_rank_total - 1) * 100, 1) END AS guild_mplus_rank_percentile FROM r""")
gold("gold_player_mplus_summary", "SELECT * FROM mplus_summary")
cte("mplus_weekly", f"""SELECT {_MKEY}, r.*, m.mythic_level AS most_common_key_level FROM (SELECT {_MWHO}, CAST(date_trunc('week', completed_at) AS DATE) AS week_start,
    {_RC}, MAX(mythic_level) AS highest_key_level, COUNT(DISTINCT dungeon) AS unique_dungeons FROM runs GROUP BY {_MWHO}, date_trunc('week', completed_at)) r
    JOIN (SELECT * FROM (SELECT player_name AS n2, CAST(date_trunc('week', completed_at) AS DATE) AS w2, mythic_level, ROW_NUMBER() OVER (PARTITION BY player_name,
    date_trunc('week', completed_at) ORDER BY COUNT(*) DESC, mythic_level DESC) AS rn FROM runs GROUP BY player_name, date_trunc('week', completed_at), mythic_level) t
    WHERE rn = 1) m ON player_name = n2 AND week_start = w2""")
gold("gold_player_mplus_weekly_activity", "SELECT * FROM mplus_weekly")
cte("mplus_dungeons", f"""SELECT {_MKEY}, c.*, b.short_name AS best_short_name, b.mythic_level AS best_key_level, ROUND(b.score, 1) AS best_score, b.timed AS best_timed,
    b.clear_time_ms AS best_clear_time_ms, b.par_time_ms AS best_par_time_ms, b.completed_at AS best_completed_at, b.url AS best_run_url
    FROM (SELECT {_MWHO}, dungeon, MAX(mythic_level) AS highest_key_level, MAX(mythic_level) FILTER (timed) AS highest_timed_level, {_RC},
    MAX(completed_at) AS latest_completed_at FROM runs GROUP BY {_MWHO}, dungeon) c JOIN (SELECT player_name AS n2, dungeon AS d2, * EXCLUDE (player_name, dungeon, realm_slug,
    region, season) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY player_name, dungeon ORDER BY {_MBEST}) AS rn FROM runs) t WHERE rn = 1) b
    ON c.player_name = b.n2 AND c.dungeon = b.d2""")
gold("gold_player_mplus_dungeon_breakdown", "SELECT * FROM mplus_dungeons")

# --- utility, cooldowns, wipes -------------------------------------------------------------

_IDS = {n: ", ".join(map(str, v)) for n, v in (("stone", rules.HEALTHSTONE_IDS), ("potion", rules.HEALTH_POTION_IDS), ("defensive", rules.DEFENSIVE_IDS))}
cte("utility", f"""WITH used AS (SELECT report_code, event_fight_id AS fight_id, actor_id, ability_id FROM raw_casts WHERE event_fight_id IS NOT NULL),
    u AS (SELECT u.report_code, u.fight_id, u.actor_id, COUNT(*) FILTER (u.ability_id IN ({_IDS['potion']})) AS health_potion_uses,
    COUNT(*) FILTER (u.ability_id IN ({_IDS['stone']})) AS healthstone_casts, COUNT(*) FILTER (u.ability_id IN ({_IDS['defensive']})) AS defensive_casts,
    string_agg(DISTINCT r.ability_name, ', ' ORDER BY r.ability_name) FILTER (u.ability_id IN ({_IDS['defensive']})) AS defensive_abilities
    FROM used u LEFT JOIN rules r ON u.ability_id = r.ability_id GROUP BY u.report_code, u.fight_id, u.actor_id)
    SELECT f.report_code, f.fight_id, f.encounter_id, f.boss_name, f.zone_name, f.difficulty, f.difficulty_label, f.raid_night_date, f.is_kill,
    {KEY.format(n='a.player_name', c='a.player_class', r='a.realm')} AS player_identity_key, a.player_name, a.player_class, COALESCE(a.realm, 'unknown') AS realm,
    COALESCE(health_potion_uses, 0) AS health_potion_uses, COALESCE(healthstone_casts, 0) AS healthstone_casts, COALESCE(defensive_casts, 0) AS defensive_casts,
    COALESCE(defensive_abilities, '') AS defensive_abilities FROM fights f JOIN fight_players p ON f.report_code = p.report_code AND f.fight_id = p.fight_id
    JOIN actors a ON p.report_code = a.report_code AND p.user_id = a.actor_id JOIN (SELECT DISTINCT report_code, fight_id FROM used) i
    ON f.report_code = i.report_code AND f.fight_id = i.fight_id LEFT JOIN u ON p.report_code = u.report_code AND p.fight_id = u.fight_id AND p.user_id = u.actor_id""")
gold("gold_player_utility_by_pull", "SELECT * FROM utility")
cte("capacity", """WITH pulls2 AS (SELECT f.report_code, f.fight_id, f.encounter_id, f.boss_name, f.zone_name, f.zone_id, f.difficulty, f.difficulty_label, f.raid_night_date,
    f.duration_seconds, f.is_kill, a.player_name, a.player_class, a.realm FROM fights f JOIN fight_players p ON f.report_code = p.report_code AND f.fight_id = p.fight_id
    JOIN actors a ON p.report_code = a.report_code AND p.user_id = a.actor_id WHERE EXISTS (SELECT 1 FROM casts c WHERE c.report_code = f.report_code AND c.fight_id = f.fight_id)),
    pc AS (SELECT report_code, fight_id, player_name, ability_id, COUNT(*) AS n, MAX(cast_timestamp_ms) AS last_ms FROM casts GROUP BY report_code, fight_id, player_name, ability_id),
    rc AS (SELECT DISTINCT report_code, player_name, ability_id FROM casts),
    b AS (SELECT p.*, bf.spec_id, bf.talent_spell_ids, bf.report_code IS NOT NULL AS has_combatant_info, r.cooldown_category, r.ability_id, r.ability_name, r.cooldown_seconds,
    r.active_seconds, r.allowed_spec_ids, r.required_talent_spell_ids, r.capacity_model, r.max_charges, r.capacity_score_eligible, rc.ability_id IS NOT NULL AS cast_seen_in_report,
    COALESCE(pc.n, 0) AS observed_casts, pc.last_ms AS last_cast_on_pull_ms,
    r.allowed_spec_ids = '' OR list_contains(string_split(r.allowed_spec_ids, '|'), CAST(bf.spec_id AS VARCHAR)) AS spec_ok,
    CASE WHEN r.required_talent_spell_ids = '' THEN TRUE ELSE list_has_any(string_split(r.required_talent_spell_ids, '|'), string_split(bf.talent_spell_ids, ',')) END AS talent_present,
    CASE WHEN p.duration_seconds > 0 AND r.capacity_score_eligible = 1 THEN CAST(FLOOR(p.duration_seconds / r.cooldown_seconds) AS BIGINT) + GREATEST(r.max_charges, 1) ELSE 0 END AS possible_casts
    FROM pulls2 p JOIN rules r ON p.player_class = r.player_class LEFT JOIN buffs bf ON p.report_code = bf.report_code AND p.fight_id = bf.fight_id AND p.player_name = bf.player_name
    LEFT JOIN rc ON p.report_code = rc.report_code AND p.player_name = rc.player_name AND r.ability_id = rc.ability_id
    LEFT JOIN pc ON p.report_code = pc.report_code AND p.fight_id = pc.fight_id AND p.player_name = pc.player_name AND r.ability_id = pc.ability_id),
    s AS (SELECT *, CASE WHEN NOT has_combatant_info OR spec_id IS NULL THEN 'unknown_missing_combatant_info' WHEN NOT spec_ok THEN 'untracked_spec_ineligible'
    WHEN NOT COALESCE(talent_present, FALSE) AND NOT cast_seen_in_report THEN 'untracked_talent_missing' ELSE 'tracked' END AS cooldown_tracking_state FROM b)
    SELECT *, CASE WHEN spec_id IS NULL THEN NULL ELSE spec_ok END AS spec_eligible, cooldown_tracking_state = 'tracked' AS has_tracked_capacity,
    cooldown_tracking_state = 'tracked' AND capacity_score_eligible = 1 AS has_scored_capacity, LEAST(observed_casts, possible_casts) AS actual_casts,
    GREATEST(observed_casts - possible_casts, 0) AS over_capacity_casts,
    LOWER(CONCAT(player_name, ':', player_class, ':', COALESCE(realm, 'unknown'))) AS player_identity_key FROM s""")


@query("silver_player_cooldown_capacity", "SELECT * EXCLUDE (spec_ok, realm, player_identity_key) FROM capacity")
def cooldown_capacity(dom: Domain) -> DataFrame:
    return joined_text(catalog(dom, SHARED[:3])["silver_player_cooldown_capacity"], "talent_spell_ids").drop("_ingested_at")


cte("utilization", f"""SELECT report_code, fight_id, encounter_id, boss_name, zone_name, difficulty, difficulty_label, raid_night_date, FALSE AS is_kill, duration_seconds, player_identity_key,
    player_name, COALESCE(realm, 'unknown') AS realm, player_class, spec_id, cooldown_category, ability_id, ability_name, cooldown_seconds, active_seconds, capacity_model,
    max_charges, possible_casts, observed_casts, over_capacity_casts, actual_casts, possible_casts - actual_casts AS missed_casts,
    CASE WHEN possible_casts > 0 THEN ROUND(actual_casts / possible_casts * 100, 1) ELSE 0 END AS cast_efficiency_pct FROM capacity
    WHERE has_scored_capacity AND NOT is_kill AND duration_seconds > 0""")
gold("gold_wipe_cooldown_utilization", "SELECT * FROM utilization", store=SHARED)

_SURVIVAL = """WITH d AS (SELECT * FROM death_events e WHERE NOT is_kill AND EXISTS (SELECT 1 FROM casts c WHERE c.report_code = e.report_code AND c.fight_id = e.fight_id)),
    t AS (SELECT * FROM capacity WHERE has_tracked_capacity AND cooldown_category IN ('personal', 'personal_spec')),
    st AS (SELECT d.report_code, d.fight_id, d.player_identity_key, d.death_timestamp_ms, t.spec_id, t.ability_name, t.cooldown_seconds, t.active_seconds,
    (SELECT MAX(cast_timestamp_ms) FROM casts c WHERE c.report_code = d.report_code AND c.player_name = d.player_name AND c.ability_id = t.ability_id
    AND c.cast_timestamp_ms <= d.death_timestamp_ms) AS any_ms,
    (SELECT MIN(cast_timestamp_ms) FROM casts c WHERE c.report_code = d.report_code AND c.player_name = d.player_name AND c.ability_id = t.ability_id
    AND c.cast_timestamp_ms <= d.death_timestamp_ms) AS first_ms,
    (SELECT MAX(cast_timestamp_ms) FROM casts c WHERE c.report_code = d.report_code AND c.fight_id = d.fight_id AND c.player_name = d.player_name AND c.ability_id = t.ability_id
    AND c.cast_timestamp_ms <= d.death_timestamp_ms) AS pull_ms
    FROM (SELECT DISTINCT report_code, fight_id, player_identity_key, player_name, death_timestamp_ms FROM d) d JOIN t
    ON d.report_code = t.report_code AND d.fight_id = t.fight_id AND d.player_identity_key = t.player_identity_key),
    fl AS (SELECT *, COALESCE(death_timestamp_ms <= pull_ms + active_seconds * 1000, FALSE) AS is_active,
    any_ms IS NULL OR death_timestamp_ms >= {ready} + cooldown_seconds * 1000 AS is_ready FROM st),
    sm AS (SELECT report_code, fight_id, player_identity_key, death_timestamp_ms, MAX(spec_id) AS spec_id, MAX(CAST(is_active AS INT)) AS act, MAX(CAST(is_ready AS INT)) AS rdy,
    MAX(any_ms) AS last_defensive_cast_before_death_ms, string_agg(DISTINCT ability_name, ', ' ORDER BY ability_name) FILTER (is_active) AS active_defensives,
    string_agg(DISTINCT ability_name, ', ' ORDER BY ability_name) FILTER (is_ready) AS available_defensives
    FROM fl GROUP BY report_code, fight_id, player_identity_key, death_timestamp_ms)
    SELECT d.report_code, d.fight_id, d.encounter_id, d.boss_name, d.zone_name, d.zone_id, d.difficulty, d.difficulty_label, d.raid_night_date, d.player_identity_key,
    d.player_name, d.player_class, d.realm, sm.spec_id, d.death_timestamp_ms, d.fight_start_ms, d.killing_blow_name, d.killing_blow_id,
    COALESCE(act, 0) AS defensive_active_at_death, COALESCE(rdy, {untracked}) AS defensive_available_at_death,
    CAST(COALESCE(act, 0) = 0 AND COALESCE(rdy, {untracked}) = 1 AS INT) AS available_defensive_unused_at_death, last_defensive_cast_before_death_ms,
    COALESCE(active_defensives, '') AS active_defensives, COALESCE(available_defensives, '') AS available_defensives,
    CAST(EXISTS (SELECT 1 FROM casts c WHERE c.report_code = d.report_code AND c.fight_id = d.fight_id AND c.player_name = d.player_name
    AND c.ability_id IN ({stone}) AND c.cast_timestamp_ms <= d.death_timestamp_ms) AS INT) AS healthstone_before_death,
    CAST(EXISTS (SELECT 1 FROM casts c WHERE c.report_code = d.report_code AND c.fight_id = d.fight_id AND c.player_name = d.player_name
    AND c.ability_id IN ({potion}) AND c.cast_timestamp_ms <= d.death_timestamp_ms) AS INT) AS health_potion_before_death
    FROM d LEFT JOIN sm ON d.report_code = sm.report_code AND d.fight_id = sm.fight_id AND d.player_identity_key = sm.player_identity_key
    AND d.death_timestamp_ms = sm.death_timestamp_ms"""
cte("survival", _SURVIVAL.format(ready="any_ms", untracked=0, **_IDS))
cte("survival_any", _SURVIVAL.format(ready="first_ms", untracked=1, **_IDS))
gold("gold_wipe_survival_events", "SELECT * FROM survival", store=SHARED)


@query("gold_wipe_survival_events_any_cast", "SELECT * FROM survival_any")
def survival_any_cast(dom: Domain) -> DataFrame:
    t = catalog(dom, SHARED)
    return gold_wipes.wipe_survival_events(t["gold_player_death_events"], t["silver_player_cooldown_capacity"], t["silver_player_cast_events"],
                                           t["silver_actor_roster"], mode="any_cast")


_SIX = """GROUPING SETS ((player_identity_key, zone_name, encounter_id, boss_name, difficulty, difficulty_label),
    (player_identity_key, zone_name, difficulty, difficulty_label), (player_identity_key, difficulty, difficulty_label),
    (player_identity_key, zone_name, encounter_id, boss_name), (player_identity_key, zone_name), (player_identity_key))"""
_OPEN6 = f"""player_identity_key, {_OPEN}, CASE WHEN GROUPING(encounter_id) = 1 THEN -1 ELSE encounter_id END AS encounter_id,
    CASE WHEN GROUPING(difficulty) = 1 THEN -1 ELSE difficulty END AS difficulty"""
_ON = " AND ".join(f"a.{c} = {{0}}.{c}" for c in ("player_identity_key", "zone_name", "boss_name", "difficulty_label", "encounter_id", "difficulty"))
_NAMES = "MAX(player_name) AS player_name, MAX(player_class) AS player_class, MAX(realm) AS realm"
cte("discipline", f"""WITH w AS (SELECT {_OPEN6}, {_NAMES}, COUNT(DISTINCT CONCAT(report_code, ':', fight_id)) AS wipe_pulls_tracked FROM utility WHERE NOT is_kill GROUP BY {_SIX}),
    o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY report_code, fight_id ORDER BY death_timestamp_ms, player_name) AS death_order FROM survival),
    d AS (SELECT {_OPEN6}, {_NAMES}, COUNT(*) AS wipe_deaths, COUNT(*) FILTER (death_order = 1) AS first_deaths,
    COUNT(*) FILTER (death_timestamp_ms - fight_start_ms <= 60000) AS early_deaths, COUNT(*) FILTER (healthstone_before_death > 0) AS healthstone_uses,
    COUNT(*) FILTER (health_potion_before_death > 0) AS potion_uses, COUNT(*) FILTER (healthstone_before_death = 0) AS no_healthstone_deaths,
    COUNT(*) FILTER (health_potion_before_death = 0) AS no_health_potion_deaths FROM o GROUP BY {_SIX}),
    kb AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY player_identity_key, zone_name, boss_name, difficulty_label, encounter_id, difficulty ORDER BY n DESC, killing_blow_name) AS rn FROM
    (SELECT {_OPEN6}, killing_blow_name, COUNT(*) AS n FROM survival WHERE killing_blow_name IS NOT NULL GROUP BY {_SIX.replace('))', ')) ').replace('(player_identity_key', '(killing_blow_name, player_identity_key')}) x),
    cp AS (SELECT {_OPEN6}, {_NAMES}, COUNT(DISTINCT CASE WHEN possible_casts > 0 THEN CONCAT(report_code, ':', fight_id) END) AS pulls_with_tracked_defensive_capacity,
    CAST(SUM(possible_casts) AS BIGINT) AS tracked_defensive_capacity, CAST(SUM(actual_casts) AS BIGINT) AS defensive_casts, CAST(SUM(missed_casts) AS BIGINT) AS defensive_missed_casts
    FROM utilization WHERE cooldown_category IN ('personal', 'personal_spec') GROUP BY {_SIX}),
    k AS (SELECT {_OPEN6}, {_NAMES}, COUNT(DISTINCT CONCAT(report_code, ':', fight_id)) AS kills_tracked FROM kill_roster GROUP BY {_SIX}),
    kd AS (SELECT {_OPEN6}, {_NAMES}, COUNT(*) AS kill_deaths FROM death_events WHERE is_kill GROUP BY {_SIX}),
    a AS (SELECT player_identity_key, zone_name, boss_name, difficulty_label, encounter_id, difficulty, MAX(player_name) AS player_name, MAX(player_class) AS player_class, MAX(realm) AS realm
    FROM (SELECT * FROM w UNION ALL BY NAME SELECT * FROM d UNION ALL BY NAME SELECT * FROM cp UNION ALL BY NAME SELECT * FROM k UNION ALL BY NAME SELECT * FROM kd) x
    GROUP BY player_identity_key, zone_name, boss_name, difficulty_label, encounter_id, difficulty),
    roles AS (SELECT player_identity_key, ARG_MAX(role, (raid_night_date, report_code, fight_id)) AS role FROM kill_roster GROUP BY player_identity_key),
    j AS (SELECT a.*, roles.role, COALESCE(wipe_pulls_tracked, 0) AS wipe_pulls_tracked, COALESCE(wipe_deaths, 0) AS wipe_deaths, COALESCE(first_deaths, 0) AS first_deaths,
    COALESCE(early_deaths, 0) AS early_deaths, COALESCE(kill_deaths, 0) AS kill_deaths, COALESCE(kills_tracked, 0) AS kills_tracked,
    COALESCE(pulls_with_tracked_defensive_capacity, 0) AS pulls_with_tracked_defensive_capacity, COALESCE(tracked_defensive_capacity, 0) AS tracked_defensive_capacity,
    COALESCE(defensive_casts, 0) AS defensive_casts, COALESCE(defensive_missed_casts, 0) AS defensive_missed_casts, COALESCE(healthstone_uses, 0) AS healthstone_uses,
    COALESCE(potion_uses, 0) AS potion_uses, COALESCE(no_healthstone_deaths, 0) AS no_healthstone_deaths, COALESCE(no_health_potion_deaths, 0) AS no_health_potion_deaths,
    COALESCE(kb.killing_blow_name, '') AS most_common_killing_blow, COALESCE(kb.n, 0) AS most_common_killing_blow_count
    FROM a LEFT JOIN w ON {_ON.format('w')} LEFT JOIN d ON {_ON.format('d')} LEFT JOIN cp ON {_ON.format('cp')} LEFT JOIN k ON {_ON.format('k')} LEFT JOIN kd ON {_ON.format('kd')}
    LEFT JOIN kb ON {_ON.format('kb')} AND kb.rn = 1 LEFT JOIN roles ON a.player_identity_key = roles.player_identity_key),
    m AS (SELECT *, CASE WHEN wipe_pulls_tracked > 0 THEN wipe_deaths / wipe_pulls_tracked ELSE 0 END AS pw, CASE WHEN kills_tracked > 0 THEN kill_deaths / kills_tracked END AS pk,
    CASE WHEN tracked_defensive_capacity > 0 THEN ROUND(defensive_casts / tracked_defensive_capacity * 100, 1) END AS defensive_usage_rate,
    CASE WHEN wipe_deaths > 0 THEN ROUND(healthstone_uses / wipe_deaths * 100, 1) END AS healthstone_usage_rate,
    CASE WHEN wipe_deaths > 0 THEN ROUND(potion_uses / wipe_deaths * 100, 1) END AS potion_usage_rate,
    CASE WHEN wipe_deaths > 0 THEN ROUND(no_healthstone_deaths / wipe_deaths * 100, 1) ELSE 0 END AS no_healthstone_pct,
    CASE WHEN wipe_deaths > 0 THEN ROUND(no_health_potion_deaths / wipe_deaths * 100, 1) ELSE 0 END AS no_health_potion_pct,
    CASE WHEN tracked_defensive_capacity > 0 AND defensive_casts > 0 THEN 'tracked_used' WHEN tracked_defensive_capacity > 0 THEN 'tracked_zero_usage'
    WHEN wipe_pulls_tracked > 0 THEN 'no_tracked_capacity' ELSE 'unknown' END AS defensive_tracking_status FROM j),
    bl AS (SELECT zone_name, encounter_id, boss_name, difficulty, difficulty_label, player_class, quantile_disc(defensive_usage_rate, 0.5) AS med FROM m
    WHERE defensive_usage_rate IS NOT NULL GROUP BY zone_name, encounter_id, boss_name, difficulty, difficulty_label, player_class),
    c AS (SELECT m.*, med, defensive_usage_rate - med AS gap, LEAST(100, GREATEST(0, 100 - pw * 250)) AS pressure,
    CASE WHEN tracked_defensive_capacity > 0 THEN LEAST(100, GREATEST(0, defensive_usage_rate * 0.7::DOUBLE + LEAST(100, GREATEST(0, 50 + (defensive_usage_rate - med) * 1.5::DOUBLE)) * 0.3::DOUBLE)) ELSE 50 END AS dfn,
    CASE WHEN wipe_deaths > 0 THEN LEAST(100, GREATEST(0, 100 - no_healthstone_pct)) ELSE 100 END AS stn,
    CASE WHEN wipe_deaths > 0 THEN LEAST(100, GREATEST(0, 100 - no_health_potion_pct)) ELSE 100 END AS pot
    FROM m LEFT JOIN bl ON m.zone_name = bl.zone_name AND m.encounter_id = bl.encounter_id AND m.boss_name = bl.boss_name AND m.difficulty = bl.difficulty
    AND m.difficulty_label = bl.difficulty_label AND m.player_class = bl.player_class),
    s AS (SELECT *, LEAST(100, GREATEST(0, dfn * 0.3::DOUBLE + stn * 0.3::DOUBLE + pot * 0.3::DOUBLE + pressure * 0.1::DOUBLE)) AS total, LEAST(dfn, stn, pot, pressure) AS low FROM c
    WHERE wipe_pulls_tracked > 0 OR wipe_deaths > 0),
    z AS (SELECT *, CASE WHEN low >= 95 THEN '—' WHEN dfn <= LEAST(stn, pot, pressure) THEN 'Defensive usage' WHEN pressure <= LEAST(stn, pot) THEN 'Wipe survival'
    WHEN stn <= pot THEN 'Healthstone' ELSE 'Health potion' END AS area FROM s)
    SELECT player_identity_key, player_name, player_class, realm, role, zone_name, NULLIF(encounter_id, -1) AS encounter_id, boss_name, NULLIF(difficulty, -1) AS difficulty,
    difficulty_label, wipe_pulls_tracked, wipe_deaths, first_deaths, early_deaths, kill_deaths, kills_tracked, ROUND(pk, 4) AS deaths_per_kill, ROUND(pw, 4) AS deaths_per_wipe,
    pulls_with_tracked_defensive_capacity, tracked_defensive_capacity, defensive_casts, defensive_missed_casts, healthstone_uses, potion_uses, no_healthstone_deaths,
    no_health_potion_deaths, defensive_usage_rate, healthstone_usage_rate, potion_usage_rate, no_healthstone_pct, no_health_potion_pct,
    ROUND(ROUND(pressure, 9), 1) AS death_pressure_score, ROUND(ROUND(dfn, 9), 1) AS defensive_component_score, ROUND(ROUND(stn, 9), 1) AS healthstone_component_score, ROUND(ROUND(pot, 9), 1) AS potion_component_score,
    ROUND(med, 1) AS defensive_class_baseline_pct, ROUND(ROUND(gap, 9), 1) AS defensive_class_delta_pct,
    ROUND(CAST(defensive_missed_casts * 0.5 + no_healthstone_deaths * 0.3 + no_health_potion_deaths * 0.2 AS DOUBLE), 1) AS weighted_failure_points,
    ROUND(ROUND(total, 9), 1) AS survival_failure_score, ROUND(ROUND(total, 9), 1) AS survival_discipline_score, area AS top_improvement_area, area AS top_missing_category, defensive_tracking_status,
    tracked_defensive_capacity > 0 AS has_defensive_capacity_tracked, most_common_killing_blow, most_common_killing_blow_count FROM z""")
gold("gold_wipe_survival_discipline", "SELECT * FROM discipline", store=SHARED)

# --- readiness -----------------------------------------------------------------------------

_READY = """WITH raids AS (SELECT * FROM raid_summary WHERE zone_name <> 'Blackrock Depths'),
    tier AS (SELECT ARG_MAX(zone_name, (raid_night_date, zone_name)) AS zone_name FROM raids),
    nights AS (SELECT COUNT(DISTINCT raid_night_date) AS n FROM raids WHERE zone_name = (SELECT zone_name FROM tier)),
    team AS ({team}),
    oc AS (SELECT CONCAT('override:', id) AS identity_key, COALESCE(NULLIF(display_name, ''), source_character, target_character, ch) AS display_name, mode, LOWER(TRIM(ch)) AS ch
    FROM (SELECT *, UNNEST(CASE WHEN mode = 'replace' THEN [source_character, target_character] ELSE string_split(characters, '|') END) AS ch FROM overrides
    WHERE COALESCE(enabled, TRUE)) x WHERE TRIM(ch) <> ''),
    tm AS (SELECT t.*, COALESCE(oc.identity_key, CONCAT('character:', LOWER(t.name))) AS identity_key, oc.display_name, oc.mode FROM team t LEFT JOIN oc ON LOWER(t.name) = oc.ch),
    ids AS (SELECT identity_key, COALESCE(MAX(display_name), MAX(name)) AS player_name, ARG_MAX(player_class, name) AS tc, MAX(rank_label) AS rank_label,
    BOOL_OR(is_active) AS is_active, string_agg(DISTINCT name, '|' ORDER BY name) AS character_names, MAX(mode) AS mode, MAX(roster_source) AS roster_source FROM tm GROUP BY identity_key),
    kk AS (SELECT k.*, i.identity_key, LOWER(COALESCE(k.weapon_enhancement_names, '')) AS wn, LOWER(k.spec) AS sp FROM kill_roster k
    JOIN (SELECT DISTINCT identity_key, LOWER(name) AS n FROM tm) i ON LOWER(k.player_name) = i.n WHERE k.zone_name = (SELECT zone_name FROM tier)),
    kw AS (SELECT *, CASE WHEN LOWER(player_class) = 'shaman' THEN CASE sp WHEN 'enhancement' THEN wn LIKE '%flametongue weapon%' AND wn LIKE '%windfury weapon%'
    WHEN 'restoration' THEN wn LIKE '%earthliving weapon%' ELSE wn LIKE '%flametongue weapon%' OR has_weapon_enhancement END ELSE has_weapon_enhancement END AS okw,
    (raid_night_date, report_code, fight_id, player_name) AS tm_at FROM kk),
    ag AS (SELECT identity_key, ARG_MAX(player_class, tm_at) AS kc, ARG_MAX(role, tm_at) AS role, ARG_MAX(spec, tm_at) AS spec, ARG_MAX(avg_item_level, tm_at) AS lvl, MAX(raid_night_date) AS last_d,
    COUNT(*) AS kills, COUNT(*) FILTER (has_food_buff) AS fo, COUNT(*) FILTER (has_flask_or_phial_buff) AS fl, COUNT(*) FILTER (okw) AS we, COUNT(*) FILTER (potion_use > 0) AS po,
    COUNT(DISTINCT raid_night_date) AS rp, ARG_MAX(food_buff_names, tm_at) FILTER (food_buff_names IS NOT NULL) AS rf, ARG_MAX(flask_or_phial_names, tm_at) FILTER (flask_or_phial_names IS NOT NULL) AS rl,
    ARG_MAX(weapon_enhancement_names, tm_at) FILTER (weapon_enhancement_names IS NOT NULL) AS rw, ARG_MAX(combat_potion_names, tm_at) FILTER (combat_potion_names IS NOT NULL) AS rc FROM kw GROUP BY identity_key),
    b AS (SELECT ids.*, COALESCE(kc, tc, 'Unknown') AS player_class, COALESCE(role, 'unknown') AS role2, ag.kills IS NOT NULL AS seen, COALESCE(rp, 0) AS raids_present, nights.n AS total_raids,
    COALESCE(kills, 0) AS kills_tracked, COALESCE(rp, 0) / GREATEST(nights.n, 1) * 100 AS att, COALESCE(fo, 0) / GREATEST(COALESCE(kills, 0), 1) * 100 AS food,
    COALESCE(fl, 0) / GREATEST(COALESCE(kills, 0), 1) * 100 AS flask, COALESCE(we, 0) / GREATEST(COALESCE(kills, 0), 1) * 100 AS weap,
    COALESCE(po, 0) / GREATEST(COALESCE(kills, 0), 1) * 100 AS pot, spec, lvl, last_d, rf, rl, rw, rc, COALESCE(po, 0) AS po FROM ids LEFT JOIN ag ON ids.identity_key = ag.identity_key, nights),
    s AS (SELECT *, CASE WHEN total_raids > 0 AND kills_tracked > 0 AND role2 = 'dps' THEN att * 0.25::DOUBLE + food * 0.25::DOUBLE + flask * 0.2::DOUBLE + weap * 0.15::DOUBLE + pot * 0.15::DOUBLE
    WHEN total_raids > 0 AND kills_tracked > 0 THEN (att * 0.25::DOUBLE + food * 0.25::DOUBLE + flask * 0.2::DOUBLE + weap * 0.15::DOUBLE) / 0.85::DOUBLE WHEN total_raids > 0 THEN att ELSE 0 END AS score,
    list_filter([CASE WHEN NOT seen THEN 'no current-tier logs' END, CASE WHEN att > 0 AND att < 70 THEN 'attendance risk' END,
    CASE WHEN kills_tracked > 0 AND food < 80 THEN 'food coverage low' END, CASE WHEN kills_tracked > 0 AND flask < 80 THEN 'flask/phial coverage low' END,
    CASE WHEN kills_tracked > 0 AND weap < 80 THEN 'weapon enhancement coverage low' END, CASE WHEN role2 = 'dps' AND kills_tracked > 0 AND pot < 50 THEN 'combat potion usage low' END,
    CASE WHEN seen AND kills_tracked = 0 THEN 'no tracked boss kills' END], lambda x: x IS NOT NULL) AS notes FROM b)
    SELECT identity_key, player_name, player_class, role2 AS role, rank_label, is_active, (SELECT zone_name FROM tier) AS current_tier, roster_source, seen AS has_current_tier_data,
    ROUND(att, 1) AS attendance_rate_pct, raids_present, total_raids AS total_raids_tracked, kills_tracked, ROUND(food, 1) AS food_rate, ROUND(flask, 1) AS flask_rate,
    ROUND(weap, 1) AS weapon_rate, ROUND(pot, 1) AS combat_potion_rate, ROUND(ROUND(score, 9), 1) AS readiness_score,
    CASE WHEN score >= 85 AND LEN(notes) <= 1 THEN 'strong' WHEN score < 65 OR LEN(notes) >= 3 THEN 'watch' ELSE 'steady' END AS readiness_label,
    array_to_string(notes, '|') AS readiness_notes, COALESCE(spec, '—') AS spec, ROUND(COALESCE(lvl, 0), 1) AS latest_avg_item_level,
    COALESCE(CAST(last_d AS VARCHAR), '') AS latest_kill_date, CASE WHEN role2 = 'dps' AND pot <= LEAST(food, flask, weap) THEN 'Combat Potion' WHEN food <= LEAST(flask, weap) THEN 'Food'
    WHEN flask <= weap THEN 'Flask' ELSE 'Weapon' END AS weakest_signal_label, COALESCE(rf, '') AS recent_food_names, COALESCE(rl, '') AS recent_flask_names,
    COALESCE(rw, '') AS recent_weapon_names, COALESCE(rc, CASE WHEN po > 0 THEN 'Combat potion used' ELSE '' END) AS recent_combat_potion_names, character_names,
    CASE mode WHEN 'replace' THEN 'Replace' WHEN 'pool' THEN 'Pool' ELSE '' END AS override_label FROM s"""
cte("readiness", _READY.format(team="""SELECT name, player_class, roster_rank AS rank_label, TRUE AS is_active, 'live_raid_roster' AS roster_source FROM live_roster"""))
cte("readiness_fallback", _READY.format(team="SELECT name, player_class, rank_label, is_active, 'gold_raid_team' AS roster_source FROM raid_team"))
gold("gold_preparation_readiness", "SELECT * FROM readiness", store=READY)


@query("gold_preparation_readiness_fallback", "SELECT * FROM readiness_fallback")
def readiness_fallback(dom: Domain) -> DataFrame:
    """The raid team stands in when the live roster holds no named row."""
    t = catalog(dom, READY)
    blank = t["gold_live_raid_roster"].withColumn("name", F.lit(""))
    return preparation_readiness(t["gold_raid_summary"], blank, t["gold_raid_team"], t["identity_overrides"], t["gold_boss_kill_roster"])


# --- profiles ------------------------------------------------------------------------------

gold("gold_live_raid_roster", "SELECT name, roster_rank, player_class, race, note, source_refreshed_at FROM live_roster")
gold("gold_guild_zone_ranks", "SELECT zone_id, zone_name, k * 100 AS world_rank, k * 10 AS region_rank, k AS server_rank FROM newest_zone_rank")
gold("gold_player_character_media", f"""SELECT {_MKEY}, player_name, realm_slug, CONCAT('avatar/', k) AS avatar_url, CASE WHEN k % 3 > 0 THEN CONCAT('inset/', k) END AS inset_url,
    CASE WHEN k % 3 > 0 THEN CONCAT('main/', k) END AS main_url, CASE WHEN k % 3 > 0 THEN CONCAT('main-raw/', k) END AS main_raw_url FROM newest_signup""")
cte("equipment", f"""WITH items AS (SELECT *, UNNEST(range(1, k % 3 + 2)) AS i FROM newest_signup), icons AS (SELECT item_id, CONCAT('icon/', ik) AS icon_url FROM
    (SELECT k % 20 AS item_id, k AS ik, ROW_NUMBER() OVER (PARTITION BY k % 20 ORDER BY ts DESC) AS rn2 FROM signups) t WHERE rn2 = 1)
    SELECT player_name, {_MKEY}, realm_slug, CONCAT('SLOT', i) AS slot_type, CONCAT('Slot ', i) AS slot_name, (k + i) % 25 AS item_id, CONCAT('Item ', (k + i) % 25) AS item_name,
    COALESCE(icon_url, '') AS icon_url, 'Epic' AS quality, 600 + k + i AS item_level, CAST(NULL AS VARCHAR) AS inventory_type, CAST(NULL AS VARCHAR) AS item_subclass,
    CAST(NULL AS VARCHAR) AS binding, CAST(NULL AS VARCHAR) AS transmog_name,
    CONCAT('[{{"display_string":"+10","source_item_name":"","enchantment_id":', i, '}}]') AS enchantments_json, CAST(NULL AS VARCHAR) AS sockets_json,
    CAST(NULL AS VARCHAR) AS stats_json, CAST(NULL AS VARCHAR) AS spells_json,
    '{{"name_description":"","requirements_level":"","durability_display":"","limit_category":""}}' AS raw_details_json
    FROM items LEFT JOIN icons ON (k + i) % 25 = icons.item_id""")
gold("gold_player_character_equipment", "SELECT * FROM equipment")
gold("gold_player_raid_achievements", f"""SELECT {_MKEY}, player_name, realm_slug, CAST(100 + i AS BIGINT) AS achievement_id,
    CASE i WHEN 0 THEN 'Cutting Edge: Boss' ELSE 'Famed Slayer of Bosses' END AS achievement_name, CASE WHEN k % 3 = i THEN k * 1000 END AS completed_timestamp
    FROM (SELECT *, UNNEST([0, 1]) AS i FROM newest_signup) t WHERE k % 2 = i % 2 OR k % 3 = i""")
