"""Contracts of the published tables: fields, keys, enums and row rules, apart from the plans that build them."""

from __future__ import annotations

from typing import NamedTuple

from emberlog.rules import DIFFICULTIES


class Field(NamedTuple):
    type: str
    nullable: bool = False
    allow_empty: bool = False


# The fields of each table with their types, and whether null and empty text are allowed.
FIELDS = {
    "dim_guild_member": {
        "name": Field("string"), "realm_slug": Field("string"), "rank": Field("integer"), "rank_label": Field("string", True, True),
        "rank_category": Field("string", True, True), "is_raid_team": Field("boolean"), "class_id": Field("integer", True),
        "class_name": Field("string", True, True), "level": Field("integer", True), "total_raids_tracked": Field("integer"),
        "raids_present": Field("integer"), "attendance_rate_pct": Field("number"), "last_raid_date": Field("date", True),
        "first_raid_date": Field("date", True), "is_active": Field("boolean"), "possible_main": Field("string", True, True),
        "_ingested_at": Field("timestamp", True),
    },
    "dim_player": {
        "player_name": Field("string"), "player_class": Field("string", True, True), "realm": Field("string", True, True),
        "is_guild_member": Field("boolean"), "rank": Field("integer", True), "rank_label": Field("string", True, True),
        "rank_category": Field("string", True, True), "is_raid_team": Field("boolean"), "first_seen_date": Field("date", True),
        "last_seen_date": Field("date", True),
    },
    "fact_player_events": {
        "report_code": Field("string"), "fight_id": Field("integer"), "player_name": Field("string"), "player_class": Field("string", True, True),
        "death_timestamp_ms": Field("integer"), "overkill": Field("number", True), "killing_blow_name": Field("string", True, True),
        "killing_blow_id": Field("integer", True), "zone_name": Field("string", True, True), "zone_id": Field("integer", True),
        "raid_night_date": Field("date", True),
    },
    "fact_player_fight_performance": {
        "report_code": Field("string"), "fight_id": Field("integer"), "encounter_id": Field("integer"), "boss_name": Field("string"),
        "zone_name": Field("string", True, True), "difficulty": Field("integer", True), "difficulty_label": Field("string", True, True),
        "raid_night_date": Field("date", True), "is_kill": Field("boolean"), "duration_seconds": Field("number", True),
        "player_name": Field("string"), "player_class": Field("string", True, True), "role": Field("string", True, True),
        "spec": Field("string", True, True), "avg_item_level": Field("number", True), "potion_use": Field("integer"),
        "combat_potion_casts": Field("integer", True), "combat_potion_names": Field("string", True, True), "healthstone_use": Field("integer", True),
        "has_food_buff": Field("boolean"), "food_buff_names": Field("string", True, True), "has_flask_or_phial_buff": Field("boolean"),
        "flask_or_phial_names": Field("string", True, True), "has_weapon_enhancement": Field("boolean"),
        "weapon_enhancement_names": Field("string", True, True), "crit_rating": Field("integer", True), "haste_rating": Field("integer", True),
        "mastery_rating": Field("integer", True), "versatility_rating": Field("integer", True), "throughput_per_second": Field("number", True),
        "rank_percent": Field("number", True), "bracket_percent": Field("number", True), "rank_string": Field("string", True, True),
    },
    "gold_best_kills": {
        "encounter_id": Field("integer"), "boss_name": Field("string"), "zone_name": Field("string"), "difficulty": Field("integer"),
        "difficulty_label": Field("string"), "best_kill_seconds": Field("number"), "avg_kill_seconds": Field("number"),
        "total_kills": Field("integer"), "first_kill_date": Field("date"), "latest_kill_date": Field("date"), "best_kill_mm_ss": Field("string"),
    },
    "gold_boss_kill_roster": {
        "report_code": Field("string"), "fight_id": Field("integer"), "boss_name": Field("string"), "encounter_id": Field("integer"),
        "difficulty": Field("integer"), "difficulty_label": Field("string"), "zone_name": Field("string"), "raid_night_date": Field("date"),
        "duration_seconds": Field("number", True), "player_identity_key": Field("string"), "player_name": Field("string"),
        "player_class": Field("string"), "realm": Field("string"), "role": Field("string", True, True), "spec": Field("string", True, True),
        "avg_item_level": Field("number", True), "potion_use": Field("integer"), "combat_potion_casts": Field("integer", True),
        "combat_potion_names": Field("string", True, True), "healthstone_use": Field("integer", True), "has_food_buff": Field("boolean"),
        "food_buff_names": Field("string", True, True), "has_flask_or_phial_buff": Field("boolean"),
        "flask_or_phial_names": Field("string", True, True), "has_weapon_enhancement": Field("boolean"),
        "weapon_enhancement_names": Field("string", True, True), "throughput_per_second": Field("number", True),
        "rank_percent": Field("number", True), "bracket_percent": Field("number", True), "rank_string": Field("string", True, True),
    },
    "gold_boss_mechanics": {
        "encounter_id": Field("integer"), "boss_name": Field("string"), "zone_name": Field("string"), "difficulty": Field("integer"),
        "difficulty_label": Field("string"), "total_wipes": Field("integer"), "avg_boss_pct": Field("number", True),
        "pct_wipes_phase_1": Field("number"), "pct_wipes_phase_2": Field("number"), "pct_wipes_phase_3_plus": Field("number"),
        "wipes_lt_1min": Field("integer"), "wipes_1_3min": Field("integer"), "wipes_3_5min": Field("integer"), "wipes_5plus_min": Field("integer"),
        "last_week_avg_boss_pct": Field("number", True), "progress_trend": Field("number", True),
    },
    "gold_boss_progress_history": {
        "encounter_id": Field("integer"), "boss_name": Field("string"), "zone_name": Field("string"), "difficulty": Field("integer"),
        "difficulty_label": Field("string"), "raid_night_date": Field("date"), "report_code": Field("string"),
        "report_title": Field("string", True, True), "start_time_utc": Field("timestamp", True), "end_time_utc": Field("timestamp", True),
        "pulls_on_night": Field("integer"), "kills_on_night": Field("integer"), "wipes_on_night": Field("integer"),
        "best_wipe_pct_on_night": Field("number", True), "avg_wipe_pct_on_night": Field("number", True),
        "best_boss_hp_remaining": Field("number", True), "is_kill_on_night": Field("boolean"), "kill_duration_seconds": Field("number", True),
        "longest_pull_seconds": Field("number", True),
    },
    "gold_boss_progression": {
        "encounter_id": Field("integer"), "boss_name": Field("string"), "zone_id": Field("integer"), "zone_name": Field("string"),
        "difficulty": Field("integer"), "difficulty_label": Field("string"), "total_pulls": Field("integer"), "total_kills": Field("integer"),
        "total_wipes": Field("integer"), "best_kill_seconds": Field("number", True), "avg_pull_duration_seconds": Field("number", True),
        "is_killed": Field("boolean", True), "first_kill_date": Field("date", True), "last_attempt_date": Field("date", True),
        "wipe_to_kill_ratio": Field("number"),
    },
    "gold_boss_pull_history": {
        "encounter_id": Field("integer"), "boss_name": Field("string"), "zone_name": Field("string"), "difficulty": Field("integer"),
        "difficulty_label": Field("string"), "raid_night_date": Field("date"), "report_code": Field("string"),
        "report_title": Field("string", True, True), "start_time_utc": Field("timestamp", True), "end_time_utc": Field("timestamp", True),
        "fight_id": Field("integer"), "is_kill": Field("boolean"), "boss_percentage": Field("number", True),
        "boss_hp_remaining": Field("number", True), "duration_seconds": Field("number", True), "last_phase": Field("integer", True),
    },
    "gold_boss_wipe_analysis": {
        "encounter_id": Field("integer"), "boss_name": Field("string"), "zone_name": Field("string"), "difficulty": Field("integer"),
        "difficulty_label": Field("string"), "total_wipes": Field("integer"), "best_wipe_pct": Field("number", True),
        "avg_wipe_pct": Field("number", True), "avg_last_phase": Field("number", True), "max_phase_reached": Field("integer", True),
        "avg_wipe_duration_seconds": Field("number", True), "longest_wipe_seconds": Field("number", True), "first_wipe_date": Field("date", True),
        "latest_wipe_date": Field("date", True), "raid_nights_attempted": Field("integer"), "avg_wipe_pct_rounded": Field("number", True),
    },
    "gold_encounter_catalog": {
        "zone_id": Field("integer"), "zone_name": Field("string"), "encounter_id": Field("integer"), "encounter_name": Field("string"),
        "difficulty_names": Field("array", True),
    },
    "gold_guild_roster": {
        "name": Field("string"), "player_class": Field("string", True, True), "realm": Field("string"), "rank": Field("integer"),
        "rank_label": Field("string", True, True), "rank_category": Field("string", True, True), "is_raid_team": Field("boolean"),
        "is_active": Field("boolean"), "total_raids_tracked": Field("integer"), "raids_present": Field("integer"),
        "attendance_rate_pct": Field("number"), "last_raid_date": Field("date", True), "first_raid_date": Field("date", True),
    },
    "gold_guild_zone_ranks": {
        "zone_id": Field("integer"), "zone_name": Field("string"), "world_rank": Field("integer", True), "region_rank": Field("integer", True),
        "server_rank": Field("integer", True),
    },
    "gold_live_raid_roster": {
        "name": Field("string"), "roster_rank": Field("string", True, True), "player_class": Field("string", True, True),
        "race": Field("string", True, True), "note": Field("string", True, True), "source_refreshed_at": Field("timestamp", True),
    },
    "gold_parse_completeness_daily": {
        "raid_night_date": Field("date"), "role": Field("string"), "player_rows": Field("integer"), "null_rank_rows": Field("integer"),
        "null_rank_pct": Field("number"),
    },
    "gold_player_attendance": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "player_class": Field("string"), "player_realm": Field("string"),
        "total_raids_tracked": Field("integer"), "raids_present": Field("integer"), "raids_benched": Field("integer"),
        "raids_absent": Field("integer"), "last_raid_date": Field("date", True), "first_raid_date": Field("date", True),
        "zones_attended": Field("array", True), "attendance_rate_pct": Field("number"),
    },
    "gold_player_boss_performance": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "player_class": Field("string"), "realm": Field("string"),
        "role": Field("string"), "primary_spec": Field("string", True, True), "encounter_id": Field("integer"), "boss_name": Field("string"),
        "zone_name": Field("string"), "difficulty": Field("integer"), "difficulty_label": Field("string"), "kills_on_boss": Field("integer"),
        "avg_throughput_per_second": Field("number", True), "best_throughput_per_second": Field("number", True),
        "latest_throughput_per_second": Field("number", True), "throughput_trend": Field("number", True), "avg_rank_percent": Field("number", True),
        "best_rank_percent": Field("number", True), "avg_item_level": Field("number", True), "first_kill_date": Field("date", True),
        "latest_kill_date": Field("date", True),
    },
    "gold_player_character_equipment": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "realm_slug": Field("string"), "slot_type": Field("string"),
        "slot_name": Field("string", True, True), "item_id": Field("integer", True), "item_name": Field("string", True, True),
        "icon_url": Field("string", allow_empty=True), "quality": Field("string", True, True), "item_level": Field("integer", True),
        "inventory_type": Field("string", True, True), "item_subclass": Field("string", True, True), "binding": Field("string", True, True),
        "transmog_name": Field("string", True, True), "enchantments_json": Field("string", True, True), "sockets_json": Field("string", True, True),
        "stats_json": Field("string", True, True), "spells_json": Field("string", True, True), "raw_details_json": Field("string", True, True),
    },
    "gold_player_character_media": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "realm_slug": Field("string"),
        "avatar_url": Field("string", True, True), "inset_url": Field("string", True, True), "main_url": Field("string", True, True),
        "main_raw_url": Field("string", True, True),
    },
    "gold_player_death_events": {
        "death_event_key": Field("string"), "report_code": Field("string"), "fight_id": Field("integer"), "encounter_id": Field("integer"),
        "boss_name": Field("string", True, True), "zone_name": Field("string", True, True), "zone_id": Field("integer", True),
        "difficulty": Field("integer", True), "difficulty_label": Field("string", True, True), "raid_night_date": Field("date", True),
        "is_kill": Field("boolean", True), "player_identity_key": Field("string"), "player_name": Field("string"),
        "player_class": Field("string", True, True), "realm": Field("string"), "death_timestamp_ms": Field("integer"),
        "fight_start_ms": Field("integer", True), "overkill": Field("number", True), "killing_blow_name": Field("string", True, True),
        "killing_blow_id": Field("integer", True),
    },
    "gold_player_mplus_dungeon_breakdown": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "realm_slug": Field("string"), "region": Field("string"),
        "season": Field("string"), "dungeon": Field("string"), "best_short_name": Field("string", True, True),
        "highest_key_level": Field("integer", True), "highest_timed_level": Field("integer", True), "total_runs": Field("integer"),
        "timed_runs": Field("integer"), "untimed_runs": Field("integer"), "latest_completed_at": Field("timestamp", True),
        "best_key_level": Field("integer", True), "best_score": Field("number", True), "best_timed": Field("boolean", True),
        "best_clear_time_ms": Field("integer", True), "best_par_time_ms": Field("integer", True), "best_completed_at": Field("timestamp", True),
        "best_run_url": Field("string", True, True),
    },
    "gold_player_mplus_run_history": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "realm_slug": Field("string"), "region": Field("string"),
        "season": Field("string"), "source": Field("string", True, True), "dungeon": Field("string"), "short_name": Field("string", True, True),
        "mythic_level": Field("integer", True), "score": Field("number", True), "completed_at": Field("timestamp"),
        "completed_date": Field("date", True), "clear_time_ms": Field("integer", True), "par_time_ms": Field("integer", True),
        "num_keystone_upgrades": Field("integer", True), "timed": Field("boolean", True), "url": Field("string"),
        "snapshot_at": Field("timestamp", True),
    },
    "gold_player_mplus_score_history": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "realm_slug": Field("string"), "region": Field("string"),
        "profile_url": Field("string", True, True), "season": Field("string"), "snapshot_at": Field("timestamp"), "snapshot_date": Field("date"),
        "score_all": Field("number", True), "score_dps": Field("number", True), "score_healer": Field("number", True),
        "score_tank": Field("number", True), "world_rank": Field("integer", True), "region_rank": Field("integer", True),
        "realm_rank": Field("integer", True), "raiderio_last_crawled_at": Field("timestamp", True),
    },
    "gold_player_mplus_summary": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "realm_slug": Field("string"), "region": Field("string"),
        "profile_url": Field("string", True, True), "season": Field("string"), "snapshot_at": Field("timestamp"), "score_all": Field("number", True),
        "score_dps": Field("number", True), "score_healer": Field("number", True), "score_tank": Field("number", True),
        "world_rank": Field("integer", True), "region_rank": Field("integer", True), "realm_rank": Field("integer", True),
        "guild_mplus_rank": Field("integer", True), "guild_mplus_rank_total": Field("integer"), "guild_mplus_rank_percentile": Field("number", True),
        "total_runs": Field("integer"), "timed_runs": Field("integer"), "untimed_runs": Field("integer"),
        "highest_timed_level": Field("integer", True), "highest_untimed_level": Field("integer", True),
        "most_common_key_level": Field("integer", True), "most_common_key_count": Field("integer"), "best_run_dungeon": Field("string", True, True),
        "best_run_short_name": Field("string", True, True), "best_run_level": Field("integer", True), "best_run_score": Field("number", True),
        "best_run_timed": Field("boolean", True), "best_run_completed_at": Field("timestamp", True), "best_run_url": Field("string", True, True),
    },
    "gold_player_mplus_weekly_activity": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "realm_slug": Field("string"), "region": Field("string"),
        "season": Field("string"), "week_start": Field("date"), "total_runs": Field("integer"), "timed_runs": Field("integer"),
        "untimed_runs": Field("integer"), "highest_key_level": Field("integer", True), "unique_dungeons": Field("integer"),
        "most_common_key_level": Field("integer", True),
    },
    "gold_player_performance_summary": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "player_class": Field("string"), "realm": Field("string"),
        "role": Field("string", True, True), "primary_spec": Field("string", True, True), "kills_tracked": Field("integer"),
        "avg_throughput_per_second": Field("number", True), "best_throughput_per_second": Field("number", True),
        "avg_rank_percent": Field("number", True), "best_rank_percent": Field("number", True), "avg_item_level": Field("number", True),
        "last_seen_date": Field("date", True),
    },
    "gold_player_raid_achievements": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "realm_slug": Field("string"), "achievement_id": Field("integer"),
        "achievement_name": Field("string"), "completed_timestamp": Field("integer"),
    },
    "gold_player_survivability": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "player_class": Field("string"), "realm": Field("string"),
        "total_deaths": Field("integer"), "kills_tracked": Field("integer"), "deaths_per_kill": Field("number"),
        "most_common_killing_blow": Field("string", True, True), "most_common_killing_blow_count": Field("integer", True),
        "top_killing_blows_json": Field("string", True, True), "zones_died_in": Field("array", True),
        "last_death_timestamp_ms": Field("integer", True),
    },
    "gold_player_survivability_rankings": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "player_class": Field("string"), "zone_name": Field("string"),
        "encounter_id": Field("integer", True), "boss_name": Field("string"), "difficulty": Field("integer", True),
        "difficulty_label": Field("string"), "deaths": Field("integer"), "kills": Field("integer"), "deaths_per_kill": Field("number"),
        "survivability_rank": Field("integer"), "survivability_rank_total": Field("integer"), "survivability_rank_percentile": Field("number"),
    },
    "gold_player_utility_by_pull": {
        "report_code": Field("string"), "fight_id": Field("integer"), "encounter_id": Field("integer"), "boss_name": Field("string"),
        "zone_name": Field("string"), "difficulty": Field("integer"), "difficulty_label": Field("string"), "raid_night_date": Field("date", True),
        "is_kill": Field("boolean"), "player_identity_key": Field("string"), "player_name": Field("string"),
        "player_class": Field("string", True, True), "realm": Field("string"), "health_potion_uses": Field("integer"),
        "healthstone_casts": Field("integer"), "defensive_casts": Field("integer"), "defensive_abilities": Field("string", True, True),
    },
    "gold_preparation_readiness": {
        "identity_key": Field("string"), "player_name": Field("string"), "player_class": Field("string"), "role": Field("string"),
        "rank_label": Field("string", True, True), "is_active": Field("boolean"), "current_tier": Field("string"), "roster_source": Field("string"),
        "has_current_tier_data": Field("boolean"), "attendance_rate_pct": Field("number"), "raids_present": Field("integer"),
        "total_raids_tracked": Field("integer"), "kills_tracked": Field("integer"), "food_rate": Field("number"), "flask_rate": Field("number"),
        "weapon_rate": Field("number"), "combat_potion_rate": Field("number"), "readiness_score": Field("number"), "readiness_label": Field("string"),
        "readiness_notes": Field("string", allow_empty=True), "spec": Field("string", allow_empty=True),
        "latest_avg_item_level": Field("number", True), "latest_kill_date": Field("string", allow_empty=True),
        "weakest_signal_label": Field("string", allow_empty=True), "recent_food_names": Field("string", allow_empty=True),
        "recent_flask_names": Field("string", allow_empty=True), "recent_weapon_names": Field("string", allow_empty=True),
        "recent_combat_potion_names": Field("string", allow_empty=True), "character_names": Field("string", allow_empty=True),
        "override_label": Field("string", allow_empty=True),
    },
    "gold_progression_timeline": {
        "encounter_id": Field("integer"), "boss_name": Field("string"), "zone_name": Field("string"), "difficulty": Field("integer"),
        "difficulty_label": Field("string"), "raid_night_date": Field("date"), "cumulative_kills": Field("integer"),
    },
    "gold_raid_summary": {
        "report_code": Field("string"), "report_title": Field("string", allow_empty=True), "start_time_utc": Field("timestamp", True),
        "end_time_utc": Field("timestamp", True), "zone_id": Field("integer", True), "zone_name": Field("string"), "raid_night_date": Field("date"),
        "primary_difficulty": Field("string", True, True), "total_pulls": Field("integer"), "boss_kills": Field("integer"),
        "total_wipes": Field("integer"), "total_fight_seconds": Field("number"), "unique_bosses_engaged": Field("integer"),
        "unique_bosses_killed": Field("integer"),
    },
    "gold_raid_team": {
        "name": Field("string"), "player_class": Field("string", True, True), "realm": Field("string"), "rank": Field("integer"),
        "rank_label": Field("string", True, True), "rank_category": Field("string", True, True), "is_active": Field("boolean"),
        "total_raids_tracked": Field("integer"), "raids_present": Field("integer"), "attendance_rate_pct": Field("number"),
        "last_raid_date": Field("date", True), "first_raid_date": Field("date", True), "possible_main": Field("string", True, True),
        "has_possible_alt_in_logs": Field("boolean"),
    },
    "gold_weekly_activity": {
        "week_start": Field("timestamp"), "raid_nights": Field("integer"), "total_boss_kills": Field("integer"), "total_wipes": Field("integer"),
        "total_pulls": Field("integer"), "total_raid_seconds": Field("number"), "zones_raided": Field("array", True),
    },
    "gold_wipe_cooldown_utilization": {
        "report_code": Field("string"), "fight_id": Field("integer"), "encounter_id": Field("integer"), "boss_name": Field("string"),
        "zone_name": Field("string"), "difficulty": Field("integer"), "difficulty_label": Field("string"), "raid_night_date": Field("date", True),
        "is_kill": Field("boolean"), "player_identity_key": Field("string"), "player_name": Field("string"),
        "player_class": Field("string", True, True), "realm": Field("string"), "cooldown_category": Field("string"), "ability_id": Field("integer"),
        "ability_name": Field("string"), "possible_casts": Field("integer"), "observed_casts": Field("integer"), "actual_casts": Field("integer"),
        "over_capacity_casts": Field("integer"), "missed_casts": Field("integer"),
    },
    "gold_wipe_survival_discipline": {
        "player_identity_key": Field("string"), "player_name": Field("string"), "player_class": Field("string"), "realm": Field("string"),
        "role": Field("string", True, True), "zone_name": Field("string"), "encounter_id": Field("integer", True), "boss_name": Field("string"),
        "difficulty": Field("integer", True), "difficulty_label": Field("string"), "wipe_pulls_tracked": Field("integer"),
        "wipe_deaths": Field("integer"), "first_deaths": Field("integer"), "early_deaths": Field("integer"), "kill_deaths": Field("integer"),
        "kills_tracked": Field("integer"), "deaths_per_kill": Field("number", True), "deaths_per_wipe": Field("number"),
        "pulls_with_tracked_defensive_capacity": Field("integer"), "tracked_defensive_capacity": Field("integer"),
        "defensive_casts": Field("integer"), "defensive_missed_casts": Field("integer"), "healthstone_uses": Field("integer"),
        "potion_uses": Field("integer"), "no_healthstone_deaths": Field("integer"), "no_health_potion_deaths": Field("integer"),
        "defensive_usage_rate": Field("number", True), "healthstone_usage_rate": Field("number", True), "potion_usage_rate": Field("number", True),
        "no_healthstone_pct": Field("number"), "no_health_potion_pct": Field("number"), "death_pressure_score": Field("number"),
        "defensive_component_score": Field("number"), "healthstone_component_score": Field("number"), "potion_component_score": Field("number"),
        "defensive_class_baseline_pct": Field("number", True), "defensive_class_delta_pct": Field("number", True),
        "weighted_failure_points": Field("number"), "survival_failure_score": Field("number"), "survival_discipline_score": Field("number"),
        "top_improvement_area": Field("string"), "top_missing_category": Field("string"), "defensive_tracking_status": Field("string"),
        "has_defensive_capacity_tracked": Field("boolean"), "most_common_killing_blow": Field("string", allow_empty=True),
        "most_common_killing_blow_count": Field("integer"),
    },
    "gold_wipe_survival_events": {
        "report_code": Field("string"), "fight_id": Field("integer"), "encounter_id": Field("integer"), "boss_name": Field("string"),
        "zone_name": Field("string"), "zone_id": Field("integer", True), "difficulty": Field("integer"), "difficulty_label": Field("string"),
        "raid_night_date": Field("date", True), "player_identity_key": Field("string"), "player_name": Field("string"),
        "player_class": Field("string", True, True), "realm": Field("string"), "spec_id": Field("integer", True),
        "death_timestamp_ms": Field("integer"), "fight_start_ms": Field("integer", True), "killing_blow_name": Field("string", True, True),
        "killing_blow_id": Field("integer", True), "defensive_active_at_death": Field("integer"), "defensive_available_at_death": Field("integer"),
        "available_defensive_unused_at_death": Field("integer"), "last_defensive_cast_before_death_ms": Field("integer", True),
        "active_defensives": Field("string", True, True), "available_defensives": Field("string", True, True),
        "healthstone_before_death": Field("integer"), "health_potion_before_death": Field("integer"),
    },
}

# The key of each table.
KEYS = {
    "dim_guild_member": ("name", "realm_slug"),
    "dim_player": ("player_name",),
    "fact_player_events": ("report_code", "fight_id", "player_name", "death_timestamp_ms"),
    "fact_player_fight_performance": ("report_code", "fight_id", "player_name"),
    "gold_best_kills": ("encounter_id", "boss_name", "zone_name", "difficulty"),
    "gold_boss_kill_roster": ("report_code", "fight_id", "player_identity_key"),
    "gold_boss_mechanics": ("encounter_id", "boss_name", "zone_name", "difficulty", "difficulty_label"),
    "gold_boss_progress_history": ("encounter_id", "difficulty", "report_code"),
    "gold_boss_progression": ("encounter_id", "boss_name", "zone_id", "zone_name", "difficulty"),
    "gold_boss_pull_history": ("report_code", "fight_id"),
    "gold_boss_wipe_analysis": ("encounter_id", "zone_name", "difficulty"),
    "gold_encounter_catalog": ("zone_id", "encounter_id"),
    "gold_guild_roster": ("name", "realm"),
    "gold_guild_zone_ranks": ("zone_id",),
    "gold_live_raid_roster": ("name",),
    "gold_parse_completeness_daily": ("raid_night_date", "role"),
    "gold_player_attendance": ("player_identity_key",),
    "gold_player_boss_performance": ("player_identity_key", "role", "encounter_id", "boss_name", "zone_name", "difficulty", "difficulty_label"),
    "gold_player_character_equipment": ("player_identity_key", "slot_type"),
    "gold_player_character_media": ("player_identity_key",),
    "gold_player_death_events": ("death_event_key",),
    "gold_player_mplus_dungeon_breakdown": ("player_identity_key", "region", "season", "dungeon"),
    "gold_player_mplus_run_history": ("player_identity_key", "region", "season", "dungeon", "completed_at", "url"),
    "gold_player_mplus_score_history": ("player_identity_key", "region", "season", "snapshot_at"),
    "gold_player_mplus_summary": ("player_identity_key", "region", "season"),
    "gold_player_mplus_weekly_activity": ("player_identity_key", "region", "season", "week_start"),
    "gold_player_performance_summary": ("player_identity_key", "role"),
    "gold_player_raid_achievements": ("player_identity_key", "achievement_id", "completed_timestamp"),
    "gold_player_survivability": ("player_identity_key",),
    "gold_player_survivability_rankings": ("player_identity_key", "zone_name", "boss_name", "difficulty_label"),
    "gold_player_utility_by_pull": ("report_code", "fight_id", "player_identity_key"),
    "gold_preparation_readiness": ("identity_key",),
    "gold_progression_timeline": ("encounter_id", "difficulty"),
    "gold_raid_summary": ("report_code",),
    "gold_raid_team": ("name", "realm"),
    "gold_weekly_activity": ("week_start",),
    "gold_wipe_cooldown_utilization": ("report_code", "fight_id", "player_identity_key", "ability_id"),
    "gold_wipe_survival_discipline": ("player_identity_key", "zone_name", "boss_name", "difficulty_label"),
    "gold_wipe_survival_events": ("report_code", "fight_id", "player_identity_key", "death_timestamp_ms"),
}
_LEVELS = {"difficulty_label": tuple(DIFFICULTIES.values())}
# Allowed values and row rules of each table.
ENUMS = {
    "gold_best_kills": _LEVELS, "gold_boss_kill_roster": _LEVELS, "gold_boss_progression": _LEVELS,
    "gold_preparation_readiness": {"readiness_label": ("watch", "steady", "strong")},
    "gold_wipe_survival_discipline": {"defensive_tracking_status": ("tracked_used", "tracked_zero_usage", "no_tracked_capacity", "unknown")},
}
EXPRESSIONS = {
    "gold_best_kills": {"positive_kill_count": "total_kills > 0"},
    "gold_boss_kill_roster": {"non_negative_potions": "potion_use >= 0"},
    "gold_boss_progression": {"pull_counts": "total_pulls == total_kills + total_wipes"},
    "gold_player_attendance": {"attendance_range": "attendance_rate_pct >= 0 and attendance_rate_pct <= 100"},
    "gold_player_mplus_summary": {"runs_add_up": "total_runs == timed_runs + untimed_runs"},
    "gold_player_survivability_rankings": {"rank_bounds": "survivability_rank >= 1 and survivability_rank <= survivability_rank_total"},
    "gold_preparation_readiness": {"score_range": "readiness_score >= 0 and readiness_score <= 100"},
    "gold_raid_summary": {"pull_counts": "total_pulls == boss_kills + total_wipes and total_pulls >= 0"},
    "gold_wipe_survival_discipline": {
        "score_range": "survival_discipline_score >= 0 and survival_discipline_score <= 100 and survival_failure_score == survival_discipline_score",
        "defensive_zero_usage_semantics": 'defensive_tracking_status != "tracked_zero_usage" or defensive_usage_rate == 0'},
}
# Fixed value: the version that all contracts stand at; one that differs is listed by its table.
VERSION = "0.1.0"
VERSIONS: dict[str, str] = {}
