"""Queries over the dashboard views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.operators.scopes import scope
from emberlog.plans import views
from emberlog.plans.pipeline import Catalog
from emberlog.workload.domain import Domain
from emberlog.workload.q_gold import READY, SHARED, catalog
from emberlog.workload.registry import cte, mean, query

OPEN = "zone_name <> 'Blackrock Depths'"
cte("roster_in", f"SELECT * FROM kill_roster WHERE {OPEN}")
cte("summary_in", f"SELECT * FROM raid_summary WHERE {OPEN}")
cte("progression_in", f"SELECT * FROM t_gold_boss_progression WHERE {OPEN}")
cte("wipes_in", f"SELECT * FROM t_gold_boss_wipe_analysis WHERE {OPEN}")
cte("mechanics_in", f"SELECT * FROM boss_mechanics WHERE {OPEN}")
cte("pulls_in", f"SELECT * FROM t_gold_boss_pull_history WHERE {OPEN}")
cte("deaths_in", f"SELECT * FROM death_events WHERE {OPEN}")
cte("best_in", f"SELECT * FROM t_gold_best_kills WHERE {OPEN}")

_ROSTER, _DEATHS = "gold_boss_kill_roster", "gold_player_death_events"


class In(Catalog):
    """Gold tables without the excluded zones."""

    def __init__(self, dom: Domain, *store: str):
        super().__init__()
        self.source = catalog(dom, store)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = views.included(self.source[name])
        return self[name]


def view(name: str, sql: str, *store: str):
    def register(build):
        query(f"view_{name}", sql)(lambda dom: build(In(dom, *store)))
        return build
    return register




def mean0(x: str) -> str:
    return f"COALESCE({mean(x)}, 0)"


# --- attendance ----------------------------------------------------------------------------

cte("scoped_attendance", """WITH r AS (SELECT * FROM roster_in WHERE zone_name = 'ZONE_1' AND difficulty_label = 'Heroic'),
    s AS (SELECT report_code FROM summary_in WHERE zone_name = 'ZONE_1' AND primary_difficulty = 'Heroic' AND report_code IN (SELECT report_code FROM r)),
    p AS (SELECT player_name, MAX(player_class) AS player_class, COUNT(DISTINCT report_code) AS raids_present, MIN(raid_night_date) AS first_raid_date, MAX(raid_night_date) AS last_raid_date
    FROM r WHERE report_code IN (SELECT report_code FROM s) GROUP BY player_name)
    SELECT player_name, player_class, raids_present, n AS total_raids_tracked, GREATEST(n - raids_present, 0) AS raids_absent, raids_present / GREATEST(n, 1) * 100 AS attendance_rate_pct,
    first_raid_date, last_raid_date FROM p, (SELECT COUNT(*) AS n FROM s) x""")


def _scoped_attendance(t: In) -> DataFrame:
    summary = scope(t["gold_raid_summary"], zone="ZONE_1").filter("primary_difficulty = 'Heroic'")
    return views.scoped_attendance(scope(t[_ROSTER], zone="ZONE_1", difficulty="Heroic"), summary, t.source["silver_raid_attendance"])


view("scoped_attendance", "SELECT * FROM scoped_attendance", _ROSTER)(_scoped_attendance)


@view("attendance_kpis", f"""SELECT COUNT(*) AS players, ROUND({mean('attendance_rate_pct')}, 2) AS avg_attendance, COUNT(*) FILTER (raids_present = total_raids_tracked) AS perfect,
    MAX(total_raids_tracked) AS sessions FROM scoped_attendance""", _ROSTER)
def attendance_kpis(t: In) -> DataFrame:
    return views.attendance_kpis(_scoped_attendance(t))


# --- bosses --------------------------------------------------------------------------------

@view("canonical_zones", """SELECT encounter_id, zone_name FROM (SELECT encounter_id, zone_name, ROW_NUMBER() OVER (PARTITION BY encounter_id ORDER BY COUNT(*) DESC, zone_name) AS rn
    FROM progression_in GROUP BY encounter_id, zone_name) t WHERE rn = 1""")
def canonical_zones(t: In) -> DataFrame:
    return views.canonical_zones(t["gold_boss_progression"])


@view("progression_log", """SELECT encounter_id, difficulty, difficulty_label, report_code, report_title, raid_night_date, COUNT(*) AS pulls, COUNT(*) FILTER (NOT is_kill) AS wipes,
    CASE WHEN BOOL_OR(is_kill) THEN 0.0::DOUBLE ELSE LEAST(100.0::DOUBLE, MIN(boss_hp_remaining)) END AS best_hp, MIN(duration_seconds) FILTER (is_kill) AS kill_time, BOOL_OR(is_kill) AS is_kill
    FROM pulls_in GROUP BY encounter_id, difficulty, difficulty_label, report_code, report_title, raid_night_date""")
def progression_log(t: In) -> DataFrame:
    return views.progression_log(t["gold_boss_pull_history"])


_LBL = "CONCAT_WS(' / ', boss_name, difficulty_label)"
_UNKILLED = "NOT COALESCE(is_killed, FALSE)"


@view("boss_kpis", f"""SELECT CAST(SUM(total_pulls) AS BIGINT) AS total_pulls, CAST(SUM(total_kills) AS BIGINT) AS total_kills,
    COALESCE(ROUND({mean('CASE WHEN is_killed THEN total_pulls END')}, 4), 0) AS avg_pulls_to_kill, COUNT(*) FILTER ({_UNKILLED}) AS unresolved,
    CAST(COALESCE(SUM(total_pulls) FILTER ({_UNKILLED}), 0) AS BIGINT) AS unresolved_pulls, ARG_MAX({_LBL}, (total_wipes, {_LBL})) FILTER ({_UNKILLED}) AS biggest_wall,
    COUNT(*) FILTER (is_killed AND difficulty_label = 'Mythic') AS mythic_kills, COUNT(*) FILTER (is_killed AND difficulty_label = 'Heroic') AS heroic_kills,
    ROUND(SUM(total_kills) / GREATEST(SUM(total_pulls), 1) * 100, 2) AS kill_rate_pct,
    (SELECT ARG_MIN({_LBL}, (best_wipe_pct, {_LBL})) FROM wipes_in w WHERE best_wipe_pct > 0 AND EXISTS (SELECT 1 FROM progression_in p WHERE p.encounter_id = w.encounter_id
    AND p.difficulty = w.difficulty AND {_UNKILLED})) AS closest_unresolved, (SELECT ARG_MIN({_LBL}, (best_kill_seconds, {_LBL})) FROM best_in) AS fastest_kill FROM progression_in""")
def boss_kpis(t: In) -> DataFrame:
    return views.boss_kpis(t["gold_boss_progression"], t["gold_boss_wipe_analysis"], t["gold_best_kills"])


_TIER = "(SELECT ARG_MAX(zone_name, (raid_night_date, zone_name)) FROM summary_in)"


def _tier(t: In):
    return t["gold_raid_summary"].agg(F.max_by("zone_name", F.struct("raid_night_date", "zone_name")).alias("z")).scalar()


@view("overview_bosses", f"""WITH o AS (SELECT *, CASE difficulty_label WHEN 'Mythic' THEN 3 WHEN 'Heroic' THEN 2 ELSE 1 END AS r FROM progression_in WHERE zone_name = {_TIER}),
    h AS (SELECT * FROM o WHERE r = (SELECT MAX(r) FROM o)) SELECT MAX(difficulty_label) AS highest_difficulty,
    ARG_MAX(boss_name, (last_attempt_date, boss_name)) FILTER ({_UNKILLED}) AS current_boss, ARG_MAX(boss_name, (first_kill_date, boss_name)) FILTER (is_killed) AS last_downed_boss FROM h""".replace("WITH o AS (", "SELECT * FROM (WITH o AS (") + ") q")
def overview_bosses(t: In) -> DataFrame:
    return views.overview_bosses(t["gold_boss_progression"], _tier(t))


cte("pull_series", """SELECT * FROM (SELECT encounter_id, difficulty, raid_night_date, report_code, fight_id, is_kill, boss_hp_remaining,
    ROW_NUMBER() OVER w AS pull_index, MIN(LEAST(boss_hp_remaining, 100)) OVER w AS best_so_far_hp, MAX(last_phase) OVER w AS max_phase_so_far,
    SUM(CASE WHEN is_kill THEN 1 ELSE 0 END) OVER w - CASE WHEN is_kill THEN 1 ELSE 0 END AS before FROM pulls_in
    WINDOW w AS (PARTITION BY encounter_id, difficulty ORDER BY raid_night_date, start_time_utc, report_code, fight_id ROWS UNBOUNDED PRECEDING)) t WHERE before = 0""")


@view("pull_series", "SELECT * EXCLUDE (before) FROM pull_series")
def pull_series(t: In) -> DataFrame:
    return views.pull_series(t["gold_boss_pull_history"])


@view("phase_segments", """SELECT encounter_id, difficulty, phase, "end", COALESCE(LAG("end") OVER (PARTITION BY encounter_id, difficulty ORDER BY phase), 0) AS start FROM
    (SELECT encounter_id, difficulty, GREATEST(max_phase_so_far, 1) AS phase, MAX(pull_index) AS "end" FROM pull_series GROUP BY encounter_id, difficulty, GREATEST(max_phase_so_far, 1)) t
    WHERE (encounter_id, difficulty) IN (SELECT (encounter_id, difficulty) FROM pull_series WHERE max_phase_so_far > 1)""")
def phase_segments(t: In) -> DataFrame:
    return views.phase_segments(views.pull_series(t["gold_boss_pull_history"]))


@view("nightly_candles", """WITH n AS (SELECT encounter_id, difficulty, raid_night_date, ARG_MIN(boss_hp_remaining, (start_time_utc, report_code, fight_id)) AS f,
    ARG_MAX(boss_hp_remaining, (start_time_utc, report_code, fight_id)) AS close, MAX(boss_hp_remaining) AS hi, MIN(boss_hp_remaining) AS lo, COUNT(*) AS pull_count
    FROM pulls_in GROUP BY encounter_id, difficulty, raid_night_date),
    o AS (SELECT *, COALESCE(LAG(close) OVER w, f) AS "open", LAG(raid_night_date) OVER w AS previous_night FROM n WINDOW w AS (PARTITION BY encounter_id, difficulty ORDER BY raid_night_date))
    SELECT encounter_id, difficulty, raid_night_date, previous_night, "open", close, GREATEST(hi, "open") AS high, LEAST(lo, "open") AS low, pull_count FROM o""".replace("WITH n AS", "SELECT * FROM (WITH n AS") + ") q")
def nightly_candles(t: In) -> DataFrame:
    return views.nightly_candles(t["gold_boss_pull_history"])


@view("weekly_series", """SELECT g.zone_name, g.week_start, g.week_index, CAST(COALESCE(k, 0) AS BIGINT) AS boss_kills, CAST(COALESCE(w, 0) AS BIGINT) AS wipes, CAST(COALESCE(p, 0) AS BIGINT) AS pulls FROM
    (SELECT zone_name, CAST(a + INTERVAL 7 DAY * i AS DATE) AS week_start, i + 1 AS week_index FROM (SELECT zone_name, a, UNNEST(range(0, date_diff('day', a, b) // 7 + 1)) AS i FROM
    (SELECT zone_name, MIN(raid_night_date - CAST((dayofweek(raid_night_date) + 4) % 7 AS INT)) AS a, MAX(raid_night_date - CAST((dayofweek(raid_night_date) + 4) % 7 AS INT)) AS b
    FROM summary_in GROUP BY zone_name) x) y) g LEFT JOIN
    (SELECT zone_name, raid_night_date - CAST((dayofweek(raid_night_date) + 4) % 7 AS INT) AS ws, SUM(boss_kills) AS k, SUM(total_wipes) AS w, SUM(total_pulls) AS p FROM summary_in
    WHERE primary_difficulty = 'Heroic' GROUP BY ALL) s ON g.zone_name = s.zone_name AND g.week_start = s.ws""")
def weekly_series(t: In) -> DataFrame:
    out = views.weekly_series(t["gold_raid_summary"], "Heroic")
    return out.withColumn("week_index", F.col("week_index").cast("bigint"))


cte("focus", """SELECT encounter_id, difficulty FROM progression_in ORDER BY CASE WHEN COALESCE(is_killed, FALSE) THEN 0 ELSE 1 END DESC,
    CASE WHEN COALESCE(is_killed, FALSE) THEN first_kill_date ELSE last_attempt_date END DESC, encounter_id DESC, difficulty DESC LIMIT 1""")


@view("focus_history", "SELECT h.* FROM progress_history h JOIN focus f ON h.encounter_id = f.encounter_id AND h.difficulty = f.difficulty")
def focus_history(t: In) -> DataFrame:
    return views.focus_history(t["gold_boss_progress_history"], t["gold_boss_progression"])


# --- players -------------------------------------------------------------------------------

_AT = "(raid_night_date, report_code, fight_id)"
cte("scoped_players", f"""SELECT player_name, COUNT(*) AS kills_tracked, ROUND({mean0('throughput_per_second')}, 2) AS avg_throughput_per_second,
    COALESCE(MAX(throughput_per_second), 0) AS best_throughput_per_second, ROUND({mean0('rank_percent')}, 4) AS avg_rank_percent, COALESCE(MAX(rank_percent), 0) AS best_rank_percent,
    ROUND({mean0('avg_item_level')}, 4) AS avg_item_level, MAX(raid_night_date) AS last_seen_date, ARG_MAX(spec, {_AT}) AS primary_spec, ARG_MAX(player_class, {_AT}) AS player_class,
    ARG_MAX(role, {_AT}) AS role FROM roster_in WHERE zone_name = 'ZONE_2' GROUP BY player_name""")


def _players(t: In) -> DataFrame:
    return views.scoped_players(scope(t[_ROSTER], zone="ZONE_2"))


view("scoped_players", "SELECT * FROM scoped_players")(_players)


@view("player_kpis", f"""SELECT ROUND({mean0('CASE WHEN avg_rank_percent > 0 THEN avg_rank_percent END')}, 4) AS avg_parse, COALESCE(MAX(best_rank_percent) FILTER (avg_rank_percent > 0), 0) AS top_parse,
    ROUND({mean0('CASE WHEN avg_item_level > 0 THEN avg_item_level END')}, 4) AS avg_item_level, ROUND(STDDEV_POP(CASE WHEN avg_item_level > 0 THEN avg_item_level END), 4) AS item_level_std_dev,
    COUNT(*) FILTER (avg_rank_percent > 0) AS ranked_players FROM scoped_players""")
def player_kpis(t: In) -> DataFrame:
    return views.player_kpis(_players(t))


@view("top_performers", f"""SELECT player_name, kills_tracked, avg_rank_percent FROM (SELECT player_name, COUNT(*) AS kills_tracked, ROUND({mean('rank_percent')}, 4) AS avg_rank_percent, COUNT(rank_percent) AS n
    FROM roster_in GROUP BY player_name) t WHERE kills_tracked >= 2 AND n > 0 ORDER BY avg_rank_percent DESC, player_name LIMIT 9""")
def top_performers(t: In) -> DataFrame:
    return views.top_performers(t[_ROSTER])


@view("top_parse_players", """SELECT player_identity_key, role, avg_rank_percent, best_rank_percent FROM performance_summary WHERE avg_rank_percent > 0
    ORDER BY avg_rank_percent DESC, player_identity_key, role LIMIT 15""")
def top_parse_players(t: In) -> DataFrame:
    return views.top_parse_players(t.source["gold_player_performance_summary"])


@view("throughput_over_time", "SELECT player_identity_key, raid_night_date, report_code, fight_id, boss_name, throughput_per_second, rank_percent FROM roster_in")
def throughput_over_time(t: In) -> DataFrame:
    return views.throughput_over_time(t[_ROSTER])


@view("player_boss_fallback", f"""SELECT player_name, encounter_id, difficulty, COUNT(*) AS kills_on_boss, ROUND({mean0('throughput_per_second')}, 2) AS avg_throughput_per_second,
    COALESCE(MAX(throughput_per_second), 0) AS best_throughput_per_second, ROUND({mean0('rank_percent')}, 4) AS avg_rank_percent, COALESCE(MAX(rank_percent), 0) AS best_rank_percent,
    ARG_MAX(report_code, {_AT}) AS latest_report_code, ARG_MAX(fight_id, {_AT}) AS latest_fight_id FROM roster_in GROUP BY player_name, encounter_id, difficulty""")
def player_boss_fallback(t: In) -> DataFrame:
    return views.player_boss_fallback(t[_ROSTER])


@view("item_levels", f"""SELECT player_name, COALESCE(g, l, s) AS item_level FROM (SELECT player_name, ROUND({mean('item_level')}, 4) AS g FROM equipment WHERE item_level > 0 AND UPPER(slot_type) NOT IN ('SHIRT', 'TABARD') 
    GROUP BY player_name) a FULL OUTER JOIN (SELECT player_name, ARG_MAX(avg_item_level, {_AT}) AS l FROM roster_in GROUP BY player_name) b USING (player_name)
    FULL OUTER JOIN (SELECT player_name, MAX(avg_item_level) AS s FROM performance_summary GROUP BY player_name) c USING (player_name)""")
def item_levels(t: In) -> DataFrame:
    return views.item_levels(t.source["gold_player_character_equipment"], t[_ROSTER], t.source["gold_player_performance_summary"])


@view("tier_completion", f"""SELECT p.player_name, d.difficulty_label, COALESCE(k.n, 0) AS completed, b.n AS total, ROUND(COALESCE(k.n, 0) / b.n * 100, 2) AS pct FROM
    (SELECT DISTINCT player_name FROM roster_in) p, (SELECT UNNEST(['Normal', 'Heroic', 'Mythic']) AS difficulty_label) d, (SELECT COUNT(DISTINCT encounter_name) AS n FROM zones WHERE zone_name = {_TIER}) b
    LEFT JOIN (SELECT player_name, difficulty_label, COUNT(DISTINCT boss_name) AS n FROM roster_in WHERE zone_name = {_TIER} GROUP BY player_name, difficulty_label) k
    ON p.player_name = k.player_name AND d.difficulty_label = k.difficulty_label""", _ROSTER)
def tier_completion(t: In) -> DataFrame:
    return views.tier_completion(t[_ROSTER], t["gold_encounter_catalog"], _tier(t))


# --- raids ---------------------------------------------------------------------------------

cte("own_zone", "SELECT k.* FROM roster_in k JOIN summary_in s ON k.report_code = s.report_code AND k.zone_name = s.zone_name")


@view("report_boss_stats", "SELECT report_code, COUNT(DISTINCT CONCAT(encounter_id, '-', fight_id)) AS boss_kills, COUNT(DISTINCT encounter_id) AS unique_bosses_killed FROM own_zone GROUP BY report_code")
def report_boss_stats(t: In) -> DataFrame:
    return views.report_boss_stats(t[_ROSTER], t["gold_raid_summary"])


@view("reports_by_boss", "SELECT boss_name, COUNT(DISTINCT report_code) AS reports FROM own_zone GROUP BY boss_name")
def reports_by_boss(t: In) -> DataFrame:
    return views.reports_by_boss(t[_ROSTER], t["gold_raid_summary"])


@view("raid_kpis", f"""SELECT COUNT(*) AS raids, CAST(SUM(boss_kills) AS BIGINT) AS total_kills, CAST(SUM(total_wipes) AS BIGINT) AS total_wipes, CAST(SUM(total_fight_seconds) AS BIGINT) AS total_seconds,
    ROUND({mean('boss_kills')}, 4) AS avg_kills FROM summary_in""")
def raid_kpis(t: In) -> DataFrame:
    return views.raid_kpis(t["gold_raid_summary"])


@view("raids_by_zone", "SELECT zone_name, COUNT(*) AS raids, CAST(SUM(boss_kills) AS BIGINT) AS boss_kills, MAX(raid_night_date) AS last_raid_date FROM summary_in GROUP BY zone_name")
def raids_by_zone(t: In) -> DataFrame:
    return views.raids_by_zone(t["gold_raid_summary"])


@view("raid_kills", """SELECT report_code, encounter_id, fight_id, boss_name, difficulty_label, duration_seconds, COUNT(*) AS players FROM roster_in
    GROUP BY report_code, encounter_id, fight_id, boss_name, difficulty_label, duration_seconds""")
def raid_kills(t: In) -> DataFrame:
    return views.raid_kills(t[_ROSTER])


@view("raid_kill_rosters", """SELECT report_code, CONCAT(encounter_id, '-', fight_id) AS encounter_key, boss_name, difficulty_label, duration_seconds,
    COUNT(*) OVER (PARTITION BY report_code, encounter_id, fight_id) AS players, player_identity_key, player_name, player_class, role, spec, avg_item_level, throughput_per_second, rank_percent
    FROM roster_in""")
def raid_kill_rosters(t: In) -> DataFrame:
    return views.raid_kill_rosters(t[_ROSTER])


@view("top_parses", """SELECT report_code, fight_id, player_identity_key, boss_name, rank_percent FROM roster_in WHERE rank_percent > 0
    ORDER BY rank_percent DESC, report_code, fight_id, player_identity_key LIMIT 10""")
def top_parses(t: In) -> DataFrame:
    return views.top_parses(t[_ROSTER])


@view("recent_raids", "SELECT report_code, raid_night_date, boss_kills FROM summary_in ORDER BY raid_night_date DESC NULLS LAST, report_code DESC LIMIT 5")
def recent_raids(t: In) -> DataFrame:
    return views.recent_raids(t["gold_raid_summary"]).select("report_code", "raid_night_date", "boss_kills")


# --- roster and readiness ------------------------------------------------------------------

@view("merged_team", """SELECT l.name, COALESCE(r.player_class, g.class_name, l.player_class, 'Unknown') AS player_class, COALESCE(r.realm, g.realm_slug, '') AS realm, l.roster_rank AS rank_label,
    l.roster_rank AS rank_category, COALESCE(r.is_active, g.is_active, TRUE) AS is_active, COALESCE(r.total_raids_tracked, g.total_raids_tracked, 0) AS total_raids_tracked,
    COALESCE(r.raids_present, g.raids_present, 0) AS raids_present, COALESCE(r.attendance_rate_pct, g.attendance_rate_pct, 0) AS attendance_rate_pct, COALESCE(r.possible_main, '') AS possible_main,
    COALESCE(r.has_possible_alt_in_logs, FALSE) AS has_possible_alt_in_logs, l.race, l.note FROM live_roster l LEFT JOIN raid_team r ON LOWER(l.name) = LOWER(r.name)
    LEFT JOIN dim_member g ON LOWER(l.name) = LOWER(g.name)""")
def merged_team(t: In) -> DataFrame:
    s = t.source
    return views.merged_team(s["gold_live_raid_roster"], s["gold_guild_roster"], s["gold_raid_team"])


@view("readiness_kpis", f"""SELECT ROUND({mean('readiness_score')}, 2) AS avg_readiness, ROUND({mean0('CASE WHEN kills_tracked > 0 THEN combat_potion_rate END')}, 2) AS avg_combat_potion,
    ROUND({mean0('CASE WHEN kills_tracked > 0 THEN (food_rate + flask_rate + weapon_rate) / 3 END')}, 2) AS avg_core_coverage, COUNT(*) FILTER (readiness_label = 'watch') AS watchlist,
    COUNT(*) FILTER (is_active) AS active, COUNT(*) FILTER (has_current_tier_data) AS current_tier, COUNT(*) FILTER (kills_tracked > 0) > 0 AND
    COUNT(*) FILTER (kills_tracked > 0 AND food_rate + flask_rate + weapon_rate + combat_potion_rate <> 0) = 0 AS zero_consumable_coverage FROM readiness""", *READY)
def readiness_kpis(t: In) -> DataFrame:
    return views.readiness_kpis(t.source["gold_preparation_readiness"])


@view("watch_list", "SELECT identity_key, readiness_score FROM readiness WHERE readiness_label = 'watch' ORDER BY readiness_score, identity_key LIMIT 3", *READY)
def watch_list(t: In) -> DataFrame:
    return views.watch_list(t.source["gold_preparation_readiness"])


@view("best_prepared", "SELECT identity_key, readiness_score FROM readiness ORDER BY readiness_score DESC, identity_key LIMIT 3", *READY)
def best_prepared(t: In) -> DataFrame:
    return views.best_prepared(t.source["gold_preparation_readiness"])


@view("strongest_signals", """SELECT identity_key, ARG_MAX(l, (v, -o)) AS signal, MAX(v) AS value FROM (SELECT identity_key, UNNEST(['Attendance', 'Food', 'Flask', 'Weapon', 'Combat Potion']) AS l,
    UNNEST([attendance_rate_pct, food_rate, flask_rate, weapon_rate, CASE WHEN role = 'dps' THEN combat_potion_rate ELSE -1 END]) AS v, UNNEST([0, 1, 2, 3, 4]) AS o FROM readiness) t GROUP BY identity_key""", *READY)
def strongest_signals(t: In) -> DataFrame:
    return views.strongest_signals(t.source["gold_preparation_readiness"])


# --- dungeon runs --------------------------------------------------------------------------

_ROLE = """CASE WHEN COALESCE(score_healer, 0) >= COALESCE(score_dps, 0) AND COALESCE(score_healer, 0) >= COALESCE(score_tank, 0) AND COALESCE(score_healer, 0) > 0 THEN 'healer'
    WHEN COALESCE(score_tank, 0) >= COALESCE(score_dps, 0) AND COALESCE(score_tank, 0) >= COALESCE(score_healer, 0) AND COALESCE(score_tank, 0) > 0 THEN 'tank' ELSE 'dps' END"""
cte("runners", f"SELECT *, {_ROLE} AS role FROM mplus_summary WHERE score_all > 0")
cte("team_runners", "SELECT * FROM runners WHERE LOWER(player_name) IN (SELECT LOWER(name) FROM live_roster)")
cte("this_week", "SELECT player_name, MAX(total_runs) AS n FROM mplus_weekly WHERE week_start = (SELECT MAX(week_start) FROM mplus_weekly) GROUP BY player_name")
_M, _W, _D = "gold_player_mplus_summary", "gold_player_mplus_weekly_activity", "gold_player_mplus_dungeon_breakdown"


def _team(t: In) -> DataFrame:
    s = t.source
    return views.team_runners(s[_M], s["gold_live_raid_roster"], s["gold_raid_team"])


@view("team_runners", "SELECT player_name, role, score_all, guild_mplus_rank FROM team_runners")
def team_runners(t: In) -> DataFrame:
    return _team(t).select("player_name", "role", "score_all", "guild_mplus_rank")


@view("runner_kpis", f"""SELECT COUNT(*) AS active, ROUND({mean('score_all')}, 2) AS avg_score, ARG_MAX(r.player_name, (score_all, r.player_name)) AS top_player, CAST(SUM(COALESCE(n, 0)) AS BIGINT) AS keys_this_week
    FROM team_runners r LEFT JOIN this_week w ON r.player_name = w.player_name""")
def runner_kpis(t: In) -> DataFrame:
    return views.runner_kpis(_team(t), t.source[_W])


@view("vault_tiers", """SELECT COUNT(*) FILTER (COALESCE(n, 0) >= 1) AS filled_1, COUNT(*) FILTER (n >= 4) AS filled_4, COUNT(*) FILTER (n >= 8) AS filled_8, COUNT(*) AS players,
    CAST(SUM(COALESCE(n, 0)) AS BIGINT) AS total_runs FROM runners r LEFT JOIN this_week w ON r.player_name = w.player_name""")
def vault_tiers(t: In) -> DataFrame:
    return views.vault_tiers(views.active_runners(t.source[_M]), t.source[_W])


_DUNGEONS = [f"Dungeon {i}" for i in range(8)]


@view("dungeon_matrix", "SELECT r.player_name, " + ", ".join(f"COALESCE(MAX(highest_timed_level) FILTER (dungeon = '{d}'), 0) AS {d.lower().replace(' ', '_')}" for d in _DUNGEONS)
      + " FROM (SELECT DISTINCT player_name FROM runners) r LEFT JOIN mplus_dungeons d ON r.player_name = d.player_name GROUP BY r.player_name")
def dungeon_matrix(t: In) -> DataFrame:
    return views.dungeon_matrix(t.source[_D], views.active_runners(t.source[_M]), _DUNGEONS)


@view("matrix_summary", f"""SELECT COUNT(*) FILTER (highest_timed_level > 0) AS timed_cells, MAX(highest_key_level) AS best_key,
    ROUND({mean0('CASE WHEN highest_timed_level > 0 THEN highest_timed_level END')}, 4) AS avg_timed,
    (SELECT COUNT(DISTINCT player_name) FROM runners) * (SELECT COUNT(DISTINCT dungeon) FROM mplus_dungeons) AS total_cells,
    COALESCE(CAST(quantile_cont(CASE WHEN highest_timed_level > 0 THEN highest_timed_level END, 0.5) AS DOUBLE), 0) AS median_timed,
    ROUND(COUNT(*) FILTER (highest_timed_level > 0) / ((SELECT COUNT(DISTINCT player_name) FROM runners) * (SELECT COUNT(DISTINCT dungeon) FROM mplus_dungeons)) * 100, 2) AS coverage_pct
    FROM mplus_dungeons WHERE player_name IN (SELECT player_name FROM runners)""")
def matrix_summary(t: In) -> DataFrame:
    return views.matrix_summary(t.source[_D], views.active_runners(t.source[_M]))


@view("score_trajectory", f"""SELECT CAST(snapshot_at AS DATE) AS snapshot_date, {', '.join(f"ROUND({mean(f'CASE WHEN r.role = {chr(39)}{x}{chr(39)} THEN ROUND(s.score_all, 1) END')}, 4) AS {x}" for x in ('dps', 'healer', 'tank'))},
    ROUND({mean('ROUND(s.score_all, 1)')}, 4) AS all_roles FROM scores s JOIN runners r ON s.player_name = r.player_name WHERE s.score_all > 0 GROUP BY CAST(snapshot_at AS DATE)""".replace("CAST(snapshot_at", "CAST(s.snapshot_at"))
def score_trajectory(t: In) -> DataFrame:
    return views.score_trajectory(t.source["gold_player_mplus_score_history"], views.active_runners(t.source[_M]))


@view("push_candidates", """SELECT d.player_name, COALESCE(r.role, 'dps') AS role, d.dungeon, d.best_short_name AS short_name, d.highest_key_level AS highest_untimed,
    COALESCE(d.highest_timed_level, 0) AS highest_timed, d.highest_key_level - COALESCE(d.highest_timed_level, 0) AS gap, d.latest_completed_at AS latest
    FROM mplus_dungeons d LEFT JOIN runners r ON d.player_name = r.player_name WHERE d.highest_key_level > COALESCE(d.highest_timed_level, 0)""")
def push_candidates(t: In) -> DataFrame:
    return views.push_candidates(t.source[_D], views.active_runners(t.source[_M]))


@view("run_heatmap", """SELECT player_name, CAST(completed_at AS DATE) AS completed_date, COUNT(*) AS runs, MAX(mythic_level) AS highest_level, COUNT(*) FILTER (timed) AS timed
    FROM runs GROUP BY player_name, CAST(completed_at AS DATE)""")
def run_heatmap(t: In) -> DataFrame:
    return views.run_heatmap(t.source["gold_player_mplus_run_history"])


@view("runs_in_year", "SELECT player_name, COUNT(*) AS runs_this_year FROM runs WHERE year(completed_at) = 2024 GROUP BY player_name")
def runs_in_year(t: In) -> DataFrame:
    return views.runs_in_year(t.source["gold_player_mplus_run_history"], 2024)


@view("timer_used", "SELECT url, clear_time_ms / par_time_ms * 100 AS timer_used_pct FROM runs")
def timer_used(t: In) -> DataFrame:
    return views.timer_used(t.source["gold_player_mplus_run_history"])


# --- parse distribution --------------------------------------------------------------------

_BIN = "LEAST(CAST(FLOOR(rank_percent / 5) AS BIGINT), 19)"
cte("parse_bins", f"""SELECT g.bin, COALESCE(n, 0) AS parses FROM (SELECT UNNEST(range(20)) AS bin) g LEFT JOIN (SELECT {_BIN} AS bin, COUNT(*) AS n FROM roster_in WHERE rank_percent >= 0
    AND rank_percent <= 100 GROUP BY {_BIN}) c ON g.bin = c.bin""")


@view("parse_histogram", "SELECT bin, parses, CAST(bin * 5 + 2.5 AS DOUBLE) AS midpoint FROM parse_bins")
def parse_histogram(t: In) -> DataFrame:
    return views.parse_histogram(t[_ROSTER])


@view("parse_tier_mix", """SELECT CASE WHEN bin >= 19 THEN 'Legendary' WHEN bin >= 15 THEN 'Epic' WHEN bin >= 10 THEN 'Blue' WHEN bin >= 5 THEN 'Green' ELSE 'Grey' END AS tier,
    CAST(SUM(parses) AS BIGINT) AS parses FROM parse_bins GROUP BY ALL HAVING SUM(parses) > 0""")
def parse_tier_mix(t: In) -> DataFrame:
    return views.parse_tier_mix(t[_ROSTER])


@view("parse_median", "SELECT COUNT(rank_percent) AS n, quantile_cont(rank_percent, 0.5) AS median FROM roster_in WHERE rank_percent >= 0 AND rank_percent <= 100")
def parse_median(t: In) -> DataFrame:
    return views.parse_median(t[_ROSTER])


@view("parse_shape", """SELECT n, peaks, ROUND(sd, 6) AS standard_deviation, ROUND(skew, 6) AS skewness, ROUND(kurt, 6) AS kurtosis, type, ROUND(w / tot * 100, 4) AS probability FROM (
    WITH x AS (SELECT rank_percent AS v FROM roster_in WHERE rank_percent >= 0 AND rank_percent <= 100), mu AS (SELECT AVG(v) AS m, COUNT(*) AS n FROM x),
    mo AS (SELECT MAX(n) AS n, AVG(POWER(v - m, 2)) AS m2, AVG(POWER(v - m, 3)) AS m3, AVG(POWER(v - m, 4)) AS m4 FROM x, mu),
    sm AS (SELECT bin, (COALESCE(LAG(parses) OVER (ORDER BY bin), parses) + parses + COALESCE(LEAD(parses) OVER (ORDER BY bin), parses)) / 3 AS s FROM parse_bins),
    pk AS (SELECT COUNT(*) AS peaks FROM (SELECT s, LAG(s) OVER (ORDER BY bin) AS a, LEAD(s) OVER (ORDER BY bin) AS b FROM sm) y, mu WHERE s > a AND s > b AND s >= n * 0.025),
    b AS (SELECT n, SQRT(m2) AS sd, m3 / POWER(SQRT(m2), 3) AS skew, m4 / POWER(m2, 2) AS kurt, peaks FROM mo, pk),
    sc AS (SELECT *, 1 - ABS(skew) / 1.25 - ABS(kurt - 3) / 4 - CASE WHEN peaks > 1 THEN 0.2 ELSE 0 END AS s1,
    CASE WHEN skew < 0 THEN ABS(skew) / 1.15 + CASE WHEN kurt > 3 THEN 0.08 ELSE 0 END ELSE 0.03 END AS s2, CASE WHEN skew > 0 THEN ABS(skew) / 1.15 + CASE WHEN kurt > 3 THEN 0.08 ELSE 0 END ELSE 0.03 END AS s3,
    CASE WHEN peaks >= 2 THEN 0.48 + (peaks - 1) * 0.12 + GREATEST(0, (skew * skew + 1) / GREATEST(kurt, 0.001) - 0.55) ELSE 0.02 END AS s4,
    1 - ABS(skew) / 0.8 - ABS(kurt - 1.8) / 1.4 - CASE WHEN peaks > 2 THEN 0.2 ELSE 0 END AS s5 FROM b),
    w AS (SELECT *, UNNEST(['Normal', 'Left-skew', 'Right-skew', 'Bimodal', 'Uniform']) AS type, EXP(UNNEST([LEAST(0.98, GREATEST(0.02, s1)), LEAST(0.98, GREATEST(0.02, s2)), LEAST(0.98, GREATEST(0.02, s3)),
    LEAST(0.98, GREATEST(0.02, s4)), LEAST(0.82, GREATEST(0.02, s5))]) * 4) AS w FROM sc), tt AS (SELECT *, SUM(w) OVER () AS tot FROM w)
    SELECT * FROM tt ORDER BY w DESC LIMIT 1) q""", _ROSTER)
def parse_shape(t: In) -> DataFrame:
    return views.parse_shape(t[_ROSTER])


@view("parse_shape_of_equal_parses", """SELECT COUNT(*) AS n, 0 AS peaks, 0.0 AS standard_deviation, 0.0 AS skewness, 0.0 AS kurtosis, 'Uniform' AS type, 100.0 AS probability
    FROM roster_in HAVING COUNT(*) >= 10""", _ROSTER)
def parse_shape_of_equal_parses(t: In) -> DataFrame:
    """All parses of the roster set to one value."""
    return views.parse_shape(t[_ROSTER].withColumn("rank_percent", F.lit(50.0)))


# --- wipes ---------------------------------------------------------------------------------

cte("scoped_survivability", """WITH k AS (SELECT player_name, COUNT(*) AS kills_tracked, MAX(player_class) AS pc FROM roster_in GROUP BY player_name),
    d AS (SELECT player_name, COUNT(*) AS total_deaths, COUNT(*) FILTER (is_kill) AS kill_deaths, COUNT(*) FILTER (NOT is_kill) AS wipe_deaths, MAX(player_class) AS pd FROM deaths_in GROUP BY player_name),
    w AS (SELECT player_name, SUM(total_wipes) AS wipes FROM (SELECT DISTINCT player_name, report_code FROM roster_in) x JOIN summary_in s ON x.report_code = s.report_code GROUP BY player_name),
    b AS (SELECT * FROM (SELECT player_name, killing_blow_name, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY player_name ORDER BY COUNT(*) DESC, killing_blow_name) AS rn FROM deaths_in
    WHERE killing_blow_name IS NOT NULL GROUP BY player_name, killing_blow_name) t WHERE rn = 1)
    SELECT player_name, COALESCE(GREATEST(pc, pd), pc, pd) AS player_class, COALESCE(total_deaths, 0) AS total_deaths, COALESCE(wipe_deaths, 0) AS wipe_deaths, COALESCE(kill_deaths, 0) AS kill_deaths,
    COALESCE(kills_tracked, 0) AS kills_tracked, CAST(COALESCE(kills_tracked, 0) + COALESCE(wipes, 0) AS BIGINT) AS pulls_tracked,
    CASE WHEN kills_tracked > 0 THEN ROUND(COALESCE(total_deaths, 0) / kills_tracked, 4) END AS deaths_per_kill,
    CASE WHEN COALESCE(kills_tracked, 0) + COALESCE(wipes, 0) > 0 THEN ROUND(COALESCE(total_deaths, 0) / (COALESCE(kills_tracked, 0) + COALESCE(wipes, 0)), 4) END AS deaths_per_pull,
    COALESCE(b.killing_blow_name, '') AS most_common_killing_blow, COALESCE(b.n, 0) AS most_common_killing_blow_count
    FROM k FULL OUTER JOIN d USING (player_name) LEFT JOIN w USING (player_name) LEFT JOIN b USING (player_name)""")


def _survivability(t: In) -> DataFrame:
    return views.scoped_survivability(t[_ROSTER], t[_DEATHS], t["gold_raid_summary"])


view("scoped_survivability", "SELECT * FROM scoped_survivability", "silver_fight_events", _DEATHS, _ROSTER)(_survivability)


@view("most_punished", "SELECT player_name, wipe_deaths, total_deaths FROM scoped_survivability WHERE wipe_deaths > 0 ORDER BY wipe_deaths DESC, player_name LIMIT 10", "silver_fight_events", _DEATHS, _ROSTER)
def most_punished(t: In) -> DataFrame:
    return views.most_punished(_survivability(t))


cte("capacity_totals", f"""SELECT cooldown_category, player_name, ability_id, MAX(ability_name) AS ability_name, CAST(SUM(possible_casts) AS BIGINT) AS possible_casts, CAST(SUM(actual_casts) AS BIGINT) AS actual_casts,
    CAST(SUM(missed_casts) AS BIGINT) AS missed_casts, COUNT(*) AS pulls_tracked, CASE WHEN SUM(possible_casts) > 0 THEN ROUND(SUM(actual_casts) / SUM(possible_casts) * 100, 4) ELSE 0 END AS cast_efficiency_pct
    FROM utilization WHERE {OPEN} GROUP BY cooldown_category, player_name, ability_id""")


@view("cooldown_capacity", "SELECT * FROM capacity_totals", *SHARED[:4])
def cooldown_capacity(t: In) -> DataFrame:
    return views.cooldown_capacity(t["gold_wipe_cooldown_utilization"])


@view("top_missed_cooldowns", "SELECT * FROM capacity_totals WHERE cooldown_category = 'external' ORDER BY missed_casts DESC, possible_casts DESC, player_name, ability_id LIMIT 8", *SHARED[:4])
def top_missed_cooldowns(t: In) -> DataFrame:
    return views.top_missed_cooldowns(t["gold_wipe_cooldown_utilization"], "external")


@view("relative_grades", """SELECT player_identity_key, zone_name, boss_name, difficulty_label, survival_discipline_score, CASE WHEN n <= 1 OR i = n - 1 THEN 'S' WHEN i = 0 THEN 'F' WHEN n <= 3 THEN 'A'
    WHEN (i - 1) / (n - 3) >= 0.8 THEN 'A' WHEN (i - 1) / (n - 3) >= 0.6 THEN 'B' WHEN (i - 1) / (n - 3) >= 0.4 THEN 'C' WHEN (i - 1) / (n - 3) >= 0.2 THEN 'D' ELSE 'E' END AS survival_grade FROM
    (SELECT *, MAX(i) OVER (PARTITION BY zone_name, boss_name, difficulty_label) + 1 AS n FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY zone_name, boss_name, difficulty_label
    ORDER BY survival_discipline_score) - 1 AS i FROM discipline) x) y""", *SHARED)
def relative_grades(t: In) -> DataFrame:
    return views.relative_grades(t.source["gold_wipe_survival_discipline"])


@view("wipe_kpis", """SELECT *, ROUND(wipes_lt_1min / GREATEST(total_wipes, 1), 4) AS early_wipe_rate, ROUND(wipes_5plus_min / GREATEST(total_wipes, 1), 4) AS late_wipe_rate,
    ROUND(wipe_deaths / GREATEST(total_wipes, 1), 4) AS deaths_per_wipe, CASE WHEN GREATEST(wipes_lt_1min, wipes_1_3min, wipes_3_5min, wipes_5plus_min) / GREATEST(total_wipes, 1) < 0.4 THEN NULL
    WHEN wipes_lt_1min >= GREATEST(wipes_1_3min, wipes_3_5min, wipes_5plus_min) THEN '<1 min' WHEN wipes_1_3min >= GREATEST(wipes_3_5min, wipes_5plus_min) THEN '1–3 min'
    WHEN wipes_3_5min >= wipes_5plus_min THEN '3–5 min' ELSE '5+ min' END AS dominant_length FROM (SELECT (SELECT CAST(SUM(total_wipes) AS BIGINT) FROM wipes_in) AS total_wipes,
    (SELECT COUNT(*) FROM deaths_in WHERE NOT is_kill) AS wipe_deaths, CAST(SUM(wipes_lt_1min) AS BIGINT) AS wipes_lt_1min, CAST(SUM(wipes_1_3min) AS BIGINT) AS wipes_1_3min,
    CAST(SUM(wipes_3_5min) AS BIGINT) AS wipes_3_5min, CAST(SUM(wipes_5plus_min) AS BIGINT) AS wipes_5plus_min FROM mechanics_in) t""")
def wipe_kpis(t: In) -> DataFrame:
    return views.wipe_kpis(t["gold_boss_wipe_analysis"], t["gold_boss_mechanics"], t[_DEATHS])


@view("top_killing_blows", "SELECT killing_blow_name, COUNT(*) AS deaths FROM deaths_in WHERE killing_blow_name IS NOT NULL GROUP BY killing_blow_name ORDER BY deaths DESC, killing_blow_name LIMIT 10")
def top_killing_blows(t: In) -> DataFrame:
    return views.top_killing_blows(t[_DEATHS])


cte("killers", """SELECT killing_blow_name, COUNT(*) AS deaths, COUNT(DISTINCT player_name) AS unique_players, COUNT(DISTINCT boss_name) AS unique_bosses FROM deaths_in
    WHERE NOT is_kill AND killing_blow_name IS NOT NULL GROUP BY killing_blow_name""")


@view("recurring_killers", "SELECT * FROM killers ORDER BY unique_players DESC, deaths DESC, killing_blow_name LIMIT 10")
def recurring_killers(t: In) -> DataFrame:
    return views.recurring_killers(t[_DEATHS])


@view("cause_by_boss", """SELECT k.*, b.boss_name AS top_boss, b.n AS top_boss_deaths FROM (SELECT * FROM killers ORDER BY unique_players DESC, deaths DESC, killing_blow_name LIMIT 5) k JOIN
    (SELECT killing_blow_name AS kb, boss_name, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY killing_blow_name ORDER BY COUNT(*) DESC, boss_name) AS rn FROM deaths_in WHERE NOT is_kill
    GROUP BY killing_blow_name, boss_name) b ON k.killing_blow_name = b.kb AND b.rn = 1""", _DEATHS)
def cause_by_boss(t: In) -> DataFrame:
    return views.cause_by_boss(t[_DEATHS])


@view("death_timing", """SELECT MIN(ms) AS min_ms, MAX(ms) AS max_ms, MIN(ms) FILTER (ms >= q1 - (q3 - q1) * 1.5) AS lower_whisker, MAX(ms) FILTER (ms <= q3 + (q3 - q1) * 1.5) AS upper_whisker,
    COUNT(*) FILTER (ms < q1 - (q3 - q1) * 1.5 OR ms > q3 + (q3 - q1) * 1.5) AS outliers, MAX(n) AS n, MAX(q1) AS q1, MAX(median) AS median, MAX(q3) AS q3 FROM
    (SELECT death_timestamp_ms - fight_start_ms AS ms FROM deaths_in WHERE NOT is_kill AND death_timestamp_ms >= fight_start_ms AND death_timestamp_ms - fight_start_ms < 3600000) a,
    (SELECT COUNT(*) AS n, quantile_cont(death_timestamp_ms - fight_start_ms, 0.25) AS q1, quantile_cont(death_timestamp_ms - fight_start_ms, 0.5) AS median,
    quantile_cont(death_timestamp_ms - fight_start_ms, 0.75) AS q3 FROM deaths_in WHERE NOT is_kill AND death_timestamp_ms >= fight_start_ms AND death_timestamp_ms - fight_start_ms < 3600000) b""", _DEATHS)
def death_timing(t: In) -> DataFrame:
    return views.death_timing(t[_DEATHS])


_LATE = "(ms * ms // 3600000) * (ms * ms // 3600000) // 3600000"


@view("death_outliers", f"""SELECT * FROM (WITH x AS (SELECT {_LATE} AS ms FROM (SELECT death_timestamp_ms - fight_start_ms AS ms FROM deaths_in WHERE NOT is_kill
    AND death_timestamp_ms >= fight_start_ms AND death_timestamp_ms - fight_start_ms < 3600000) t),
    b AS (SELECT COUNT(*) AS n, quantile_cont(ms, 0.25) AS q1, quantile_cont(ms, 0.75) AS q3 FROM x)
    SELECT ms, COUNT(*) AS deaths, CASE WHEN ms < MAX(q1) - (MAX(q3) - MAX(q1)) * 1.5 THEN 'below' ELSE 'above' END AS side FROM x, b
    WHERE n >= 5 AND (ms < q1 - (q3 - q1) * 1.5 OR ms > q3 + (q3 - q1) * 1.5) GROUP BY ms) o""", _DEATHS)
def death_outliers(t: In) -> DataFrame:
    """Times are drawn towards the pull, so that late deaths stand out."""
    ms = F.col("death_timestamp_ms") - F.col("fight_start_ms")
    late = t[_DEATHS].filter(ms.between(0, 3_599_999)).withColumn("_ms", ms).withColumn("_ms", F.expr("(_ms * _ms div 3600000) * (_ms * _ms div 3600000) div 3600000"))
    return views.death_outliers(late.withColumn("death_timestamp_ms", F.col("fight_start_ms") + F.col("_ms")))


cte("openers", """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY report_code, fight_id, boss_name ORDER BY death_timestamp_ms, player_name, killing_blow_name NULLS FIRST) AS rn
    FROM deaths_in WHERE NOT is_kill AND death_timestamp_ms > 0) t WHERE rn = 1""")


@view("first_death_leaders", "SELECT player_name, COUNT(*) AS first_deaths, MAX(player_class) AS player_class FROM openers GROUP BY player_name")
def first_death_leaders(t: In) -> DataFrame:
    return views.first_death_leaders(t[_DEATHS])


_T = "death_timestamp_ms - fight_start_ms"


@view("first_death_profile", f"""SELECT COUNT(*) AS total, COUNT(*) FILTER (role = 'tank') AS role_tank, COUNT(*) FILTER (role = 'healer') AS role_healer, COUNT(*) FILTER (role = 'dps') AS role_dps,
    COUNT(*) FILTER (role IS NULL) AS role_unknown, COUNT(*) FILTER (fight_start_ms > 0 AND {_T} < 30000) AS lt_30s, COUNT(*) FILTER (fight_start_ms > 0 AND {_T} >= 30000 AND {_T} < 60000) AS s30_60,
    COUNT(*) FILTER (fight_start_ms > 0 AND {_T} >= 60000 AND {_T} < 120000) AS m1_2, COUNT(*) FILTER (fight_start_ms > 0 AND {_T} >= 120000) AS gt_2m FROM openers o LEFT JOIN
    (SELECT player_name AS pn, ARG_MIN(role, {_AT}) AS role FROM roster_in GROUP BY player_name) r ON o.player_name = r.pn""")
def first_death_profile(t: In) -> DataFrame:
    return views.first_death_profile(t[_DEATHS], t[_ROSTER])


@view("first_death_blows", "SELECT killing_blow_name, COUNT(*) AS deaths FROM openers WHERE killing_blow_name IS NOT NULL GROUP BY killing_blow_name ORDER BY deaths DESC, killing_blow_name LIMIT 4")
def first_death_blows(t: In) -> DataFrame:
    return views.first_death_blows(t[_DEATHS])


@view("phase_breakdown", "SELECT max_phase_reached AS phase, CAST(SUM(total_wipes) AS BIGINT) AS wipes FROM wipes_in WHERE max_phase_reached > 0 GROUP BY max_phase_reached")
def phase_breakdown(t: In) -> DataFrame:
    return views.phase_breakdown(t["gold_boss_wipe_analysis"])


@view("boss_spotlight", """SELECT w.encounter_id, w.difficulty, w.boss_name, w.zone_name, best_wipe_pct, progress_trend, trend_direction FROM wipes_in w LEFT JOIN mechanics_in m
    ON w.encounter_id = m.encounter_id AND w.difficulty = m.difficulty AND w.zone_name = m.zone_name WHERE best_wipe_pct > 0 ORDER BY best_wipe_pct, w.encounter_id, w.difficulty LIMIT 12""")
def boss_spotlight(t: In) -> DataFrame:
    return views.boss_spotlight(t["gold_boss_wipe_analysis"], t["gold_boss_mechanics"])


@view("scope_signals", f"""SELECT CAST(SUM(total_wipes) AS BIGINT) AS total_wipes, ARG_MAX({_LBL}, (total_wipes, {_LBL})) AS top_blocker, ROUND(MAX(total_wipes) / SUM(total_wipes) * 100, 2) AS top_blocker_pct,
    (SELECT COUNT(*) FROM progression_in WHERE {_UNKILLED}) AS unresolved, (SELECT killing_blow_name FROM killers ORDER BY unique_players DESC, deaths DESC, killing_blow_name LIMIT 1) AS top_killer,
    (SELECT player_name FROM openers GROUP BY player_name ORDER BY COUNT(*) DESC, player_name DESC LIMIT 1) AS first_death_leader FROM wipes_in""", _DEATHS)
def scope_signals(t: In) -> DataFrame:
    return views.scope_signals(t["gold_boss_wipe_analysis"], t["gold_boss_progression"], t[_DEATHS])


@view("frozen_zones_left_out", "SELECT zone_id, encounter_id FROM zones WHERE NOT zone_frozen")
def frozen_zones(t: In) -> DataFrame:
    return t["gold_encounter_catalog"].select("zone_id", "encounter_id")


