"""Dashboard views as DataFrame functions over gold tables.

Each view takes tables already cut to a scope (``operators.scopes.scope``). Lists the dashboard
shows in full are returned in full; top lists are limits by design.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import values as v
from emberlog.operators import joins, ordered, rows
from emberlog.session import stored

c = F.col
BOSS = ["encounter_id", "difficulty"]


def included(df: DataFrame) -> DataFrame:
    """Rows of zones the dashboard shows."""
    return df.filter("trim(zone_name) <> ''").filter(~c("zone_name").isin(*rules.EXCLUDED_ZONES))


def _mean(column: Column | str) -> Column:
    """Mean of the known values, 0 when there is none."""
    return F.coalesce(v.mean(column), F.lit(0.0))


# --- attendance ----------------------------------------------------------------------------

def scoped_attendance(roster: DataFrame, summary: DataFrame, attendance: DataFrame) -> DataFrame:
    """Per player: distinct reports with a kill in scope, against the sessions in scope."""
    sessions = joins.restrict_to(summary, roster, ["report_code"])
    total = sessions.agg(F.count("*").alias("n"))
    seen = joins.restrict_to(roster, sessions, ["report_code"]).groupBy("player_name").agg(
        F.countDistinct("report_code").alias("raids_present"), F.min("raid_night_date").alias("first_raid_date"),
        F.max("raid_night_date").alias("last_raid_date"), F.max("player_class").alias("_class"))
    classes = attendance.groupBy("player_name").agg(F.max("player_class").alias("_own"))
    joined = seen.join(classes, "player_name", "left").withColumn("total_raids_tracked", total.scalar())
    return joined.select("player_name", F.coalesce("_own", "_class", F.lit("Unknown")).alias("player_class"), "raids_present", "total_raids_tracked",
                         F.greatest(c("total_raids_tracked") - c("raids_present"), F.lit(0)).alias("raids_absent"),
                         (v.ratio("raids_present", "total_raids_tracked") * 100).alias("attendance_rate_pct"), "first_raid_date", "last_raid_date")


def attendance_kpis(scoped: DataFrame) -> DataFrame:
    tracked = scoped.filter("total_raids_tracked > 0")
    return tracked.agg(F.count("*").alias("players"), v.tidy(v.mean("attendance_rate_pct"), 2).alias("avg_attendance"),
                       F.count_if(c("raids_present") == c("total_raids_tracked")).alias("perfect"), F.max("total_raids_tracked").alias("sessions"))


# --- bosses --------------------------------------------------------------------------------

def canonical_zones(progression: DataFrame) -> DataFrame:
    """Zone with the most rows per encounter; ties by name."""
    return rows.mode_by(progression.filter("trim(zone_name) <> ''"), ["encounter_id"], "zone_name", "zone_name")


def in_canonical_zone(df: DataFrame, progression: DataFrame) -> DataFrame:
    return df.join(canonical_zones(progression), ["encounter_id", "zone_name"], "left_semi")


def progression_log(pulls: DataFrame) -> DataFrame:
    """Per boss and report: pulls, wipes, best health left and fastest kill."""
    kill = c("is_kill")
    return pulls.groupBy(*BOSS, "difficulty_label", "report_code", "report_title", "raid_night_date").agg(
        F.count("*").alias("pulls"), F.count_if(~kill).alias("wipes"),
        F.when(F.max(kill), 0.0).otherwise(F.least(F.lit(100.0), F.coalesce(F.min("boss_hp_remaining"), F.lit(100.0)))).alias("best_hp"),
        F.min(F.when(kill, c("duration_seconds"))).alias("kill_time"), F.max(kill).alias("is_kill"))


def boss_kpis(progression: DataFrame, wipes: DataFrame, best: DataFrame) -> DataFrame:
    """One row: kill rate, pulls to kill, biggest wall, closest unresolved and fastest kill."""
    killed = F.coalesce("is_killed", F.lit(False))
    label = F.concat_ws(" / ", "boss_name", "difficulty_label")
    base = progression.agg(
        F.sum("total_pulls").alias("total_pulls"), F.sum("total_kills").alias("total_kills"),
        F.coalesce(v.tidy(v.mean(F.when(killed, c("total_pulls"))), 4), F.lit(0.0)).alias("avg_pulls_to_kill"),
        F.count_if(~killed).alias("unresolved"), F.coalesce(F.sum(F.when(~killed, c("total_pulls"))), F.lit(0)).alias("unresolved_pulls"),
        F.max_by(label, F.when(~killed, F.struct("total_wipes", label))).alias("biggest_wall"),
        F.count_if(killed & (c("difficulty_label") == "Mythic")).alias("mythic_kills"),
        F.count_if(killed & (c("difficulty_label") == "Heroic")).alias("heroic_kills"))
    unresolved = progression.filter(~killed).select(*BOSS).distinct()
    close = wipes.filter("best_wipe_pct > 0").join(unresolved, BOSS, "left_semi").agg(F.min_by(label, F.struct("best_wipe_pct", label)).alias("x"))
    fast = best.agg(F.min_by(label, F.struct("best_kill_seconds", label)).alias("x"))
    return base.select("*", v.tidy(v.ratio("total_kills", "total_pulls") * 100, 2).alias("kill_rate_pct"),
                       close.scalar().alias("closest_unresolved"), fast.scalar().alias("fastest_kill"))


def overview_bosses(progression: DataFrame, tier: Column) -> DataFrame:
    """One row: highest difficulty of the tier, its boss in progress and the boss downed last."""
    rank = F.when(c("difficulty_label") == "Mythic", 3).when(c("difficulty_label") == "Heroic", 2).otherwise(1)
    own = progression.filter(c("zone_name") == tier).withColumn("_rank", rank)
    top = own.agg(F.max("_rank").alias("r"))
    rows_ = own.filter(c("_rank") == top.scalar())
    killed = F.coalesce("is_killed", F.lit(False))
    return rows_.agg(F.max("difficulty_label").alias("highest_difficulty"),
                     F.max_by("boss_name", F.when(~killed, F.struct("last_attempt_date", "boss_name"))).alias("current_boss"),
                     F.max_by("boss_name", F.when(killed, F.struct("first_kill_date", "boss_name"))).alias("last_downed_boss"))


_PULL_ORDER = ("raid_night_date", "start_time_utc", "report_code", "fight_id")


def pull_series(pulls: DataFrame, **options) -> DataFrame:
    """Pulls of a boss up to its first kill, with best health and highest phase so far."""
    base = pulls.select(*BOSS, *_PULL_ORDER, "boss_hp_remaining", "is_kill", F.coalesce("last_phase", F.lit(0)).alias("_phase"),
                        F.least("boss_hp_remaining", F.lit(100.0)).alias("_hp"), c("is_kill").cast("int").alias("_kill"))
    scanned = ordered.running(base, BOSS, [c(n).asc() for n in _PULL_ORDER], {
        "pull_index": ("row", None), "best_so_far_hp": ("min", "_hp"), "max_phase_so_far": ("max", "_phase"), "_kills": ("sum", "_kill")}, **options)
    upto = scanned.filter(c("_kills") - c("_kill") == 0)
    return upto.select(*BOSS, "raid_night_date", "report_code", "fight_id", "is_kill", "boss_hp_remaining", "pull_index",
                       F.coalesce("best_so_far_hp", F.lit(100.0)).alias("best_so_far_hp"), "max_phase_so_far")


def phase_segments(series: DataFrame) -> DataFrame:
    """Stretches of pulls with the same highest phase; the phase never falls, so they are groups."""
    ends = series.groupBy(*BOSS, F.greatest("max_phase_so_far", F.lit(1)).alias("phase")).agg(F.max("pull_index").alias("end"))
    by_phase = Window.partitionBy(*BOSS).orderBy("phase")  # a boss has a handful of phases
    cut = ends.withColumn("start", F.coalesce(F.lag("end").over(by_phase), F.lit(0)))
    return cut.withColumn("_top", F.max("phase").over(Window.partitionBy(*BOSS))).filter("_top > 1").drop("_top")


def nightly_candles(pulls: DataFrame, **options) -> DataFrame:
    """Open, close, high and low of the health left per boss and night; a night opens where the last one closed."""
    hp = v.clamp(F.coalesce("boss_hp_remaining", "boss_percentage"))
    when = F.struct("start_time_utc", "report_code", "fight_id")
    nights = pulls.groupBy(*BOSS, "raid_night_date").agg(
        F.min_by(hp, when).alias("_first"), F.max_by(hp, when).alias("close"), F.max(hp).alias("_high"), F.min(hp).alias("_low"),
        F.count("*").alias("pull_count"))
    chained = ordered.running(nights, BOSS, [c("raid_night_date").asc()], {"_before": ("prev", "close"), "previous_night": ("prev", "raid_night_date")}, **options)
    opened = chained.withColumn("open", F.coalesce("_before", "_first"))
    return opened.select(*BOSS, "raid_night_date", "previous_night", "open", "close", F.greatest("_high", "open").alias("high"),
                         F.least("_low", "open").alias("low"), "pull_count")


def weekly_series(summary: DataFrame, difficulty: str | None = None) -> DataFrame:
    """Zero-filled raid weeks (from Wednesday) per zone, numbered from its first week."""
    raids = summary.filter("trim(zone_name) <> '' AND raid_night_date IS NOT NULL").withColumn("week_start", v.reset_week_start("raid_night_date"))
    span = raids.groupBy("zone_name").agg(F.min("week_start").alias("_from"), F.max("week_start").alias("_to"))
    grid = span.select("zone_name", F.posexplode(F.sequence("_from", "_to", F.expr("INTERVAL 7 DAYS"))).alias("_i", "week_start"))
    kept = raids if difficulty is None else raids.filter(F.lower(F.trim("primary_difficulty")) == difficulty.lower())
    sums = kept.groupBy("zone_name", "week_start").agg(F.sum("boss_kills").alias("boss_kills"), F.sum("total_wipes").alias("wipes"), F.sum("total_pulls").alias("pulls"))
    filled = grid.join(sums, ["zone_name", "week_start"], "left").fillna(0, ["boss_kills", "wipes", "pulls"])
    return filled.select("zone_name", "week_start", (c("_i") + 1).alias("week_index"), "boss_kills", "wipes", "pulls")


def focus_boss(progression: DataFrame) -> DataFrame:
    """The unkilled boss tried last, else the boss killed first most recently."""
    open_first = (~F.coalesce("is_killed", F.lit(False))).cast("int")
    day = F.when(open_first == 1, c("last_attempt_date")).otherwise(c("first_kill_date"))
    best = progression.agg(F.max(F.struct(open_first.alias("o"), day.alias("d"), *BOSS)).alias("b"))
    return best.select(*[c(f"b.{n}").alias(n) for n in BOSS])


def focus_history(history: DataFrame, progression: DataFrame) -> DataFrame:
    return in_canonical_zone(history, progression).join(focus_boss(progression), BOSS, "left_semi")


# --- players -------------------------------------------------------------------------------

def _latest() -> Column:
    """Order of kills; the last is the newest."""
    return F.struct("raid_night_date", "report_code", "fight_id")


def scoped_players(roster: DataFrame) -> DataFrame:
    return roster.groupBy("player_name").agg(
        F.count("*").alias("kills_tracked"), v.tidy(_mean("throughput_per_second"), 2).alias("avg_throughput_per_second"),
        F.coalesce(F.max("throughput_per_second"), F.lit(0)).alias("best_throughput_per_second"),
        v.tidy(_mean("rank_percent"), 4).alias("avg_rank_percent"), F.coalesce(F.max("rank_percent"), F.lit(0.0)).alias("best_rank_percent"),
        v.tidy(_mean("avg_item_level"), 4).alias("avg_item_level"), F.max("raid_night_date").alias("last_seen_date"),
        *[F.max_by(n, _latest()).alias(a) for n, a in (("spec", "primary_spec"), ("player_class", "player_class"), ("role", "role"))])


def player_kpis(players: DataFrame) -> DataFrame:
    """One row: mean and best parse, mean item level and its population deviation."""
    ranked, levelled = c("avg_rank_percent") > 0, c("avg_item_level") > 0
    return players.agg(
        v.tidy(_mean(F.when(ranked, c("avg_rank_percent"))), 4).alias("avg_parse"),
        F.coalesce(F.max(F.when(ranked, c("best_rank_percent"))), F.lit(0.0)).alias("top_parse"),
        v.tidy(_mean(F.when(levelled, c("avg_item_level"))), 4).alias("avg_item_level"),
        v.tidy(F.stddev_pop(F.when(levelled, c("avg_item_level"))), 4).alias("item_level_std_dev"), F.count_if(ranked).alias("ranked_players"))


def top_performers(roster: DataFrame, n: int = 9) -> DataFrame:
    players = roster.groupBy("player_name").agg(F.count("*").alias("kills_tracked"), F.count("rank_percent").alias("_ranked"),
                                                v.tidy(v.mean("rank_percent"), 4).alias("avg_rank_percent"))
    kept = players.filter("kills_tracked >= 2 AND _ranked > 0").drop("_ranked")
    return kept.orderBy(c("avg_rank_percent").desc(), "player_name").limit(n)


def top_parse_players(summary: DataFrame, n: int = 15) -> DataFrame:
    ranked = summary.filter("avg_rank_percent > 0").select("player_identity_key", "role", "avg_rank_percent", "best_rank_percent")
    return ranked.orderBy(c("avg_rank_percent").desc(), "player_identity_key", "role").limit(n)


def throughput_over_time(roster: DataFrame) -> DataFrame:
    return roster.select("player_identity_key", "raid_night_date", "report_code", "fight_id", "boss_name", "throughput_per_second", "rank_percent")


def player_boss_fallback(roster: DataFrame) -> DataFrame:
    """Boss aggregate of a player straight from kill rows, with the newest report per boss."""
    return roster.groupBy("player_name", *BOSS).agg(
        F.count("*").alias("kills_on_boss"), v.tidy(_mean("throughput_per_second"), 2).alias("avg_throughput_per_second"),
        F.coalesce(F.max("throughput_per_second"), F.lit(0)).alias("best_throughput_per_second"),
        v.tidy(_mean("rank_percent"), 4).alias("avg_rank_percent"), F.coalesce(F.max("rank_percent"), F.lit(0.0)).alias("best_rank_percent"),
        F.max_by("report_code", _latest()).alias("latest_report_code"), F.max_by("fight_id", _latest()).alias("latest_fight_id"))


def item_levels(equipment: DataFrame, roster: DataFrame, summary: DataFrame) -> DataFrame:
    """Worn gear mean without cosmetic slots, else the latest log, else the summary."""
    worn = equipment.filter(~F.upper("slot_type").isin("SHIRT", "TABARD") & (c("item_level") > 0)).groupBy("player_name").agg(
        v.tidy(v.mean("item_level"), 4).alias("_gear"))
    logged = roster.groupBy("player_name").agg(F.max_by("avg_item_level", F.when(c("avg_item_level") > 0, _latest())).alias("_log"))
    known = summary.groupBy("player_name").agg(F.max(F.when(c("avg_item_level") > 0, c("avg_item_level"))).alias("_summary"))
    merged = rows.union_branches([worn, logged, known]).groupBy("player_name").agg(*[F.max(n).alias(n) for n in ("_gear", "_log", "_summary")])
    return merged.select("player_name", F.coalesce("_gear", "_log", "_summary").alias("item_level")).filter("item_level IS NOT NULL")


def tier_completion(roster: DataFrame, catalog: DataFrame, tier: Column) -> DataFrame:
    """Bosses of the tier downed per player and difficulty, difficulties without a kill included."""
    bosses = catalog.filter(c("zone_name") == tier).agg(F.countDistinct("encounter_name").alias("n"))
    kills = roster.filter(c("zone_name") == tier).groupBy("player_name", "difficulty_label").agg(F.countDistinct("boss_name").alias("completed"))
    levels = F.array(*[F.lit(x) for x in rules.DIFFICULTIES.values()])
    grid = roster.select("player_name").distinct().withColumn("difficulty_label", F.explode(levels))
    filled = grid.join(kills, ["player_name", "difficulty_label"], "left").fillna(0, ["completed"]).withColumn("total", bosses.scalar())
    return filled.withColumn("pct", v.tidy(v.ratio("completed", "total") * 100, 2))


# --- raids ---------------------------------------------------------------------------------

def report_boss_stats(roster: DataFrame, summary: DataFrame) -> DataFrame:
    """Kills per report, counting only bosses of the report's own zone."""
    own = roster.join(summary.select("report_code", "zone_name"), ["report_code", "zone_name"], "left_semi")
    return own.groupBy("report_code").agg(F.countDistinct("encounter_id", "fight_id").alias("boss_kills"),
                                          F.countDistinct("encounter_id").alias("unique_bosses_killed"))


def reports_by_boss(roster: DataFrame, summary: DataFrame) -> DataFrame:
    own = roster.join(summary.select("report_code", "zone_name"), ["report_code", "zone_name"], "left_semi")
    return own.groupBy("boss_name").agg(F.countDistinct("report_code").alias("reports"))


def raid_kpis(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count("*").alias("raids"), F.sum("boss_kills").alias("total_kills"), F.sum("total_wipes").alias("total_wipes"),
                       F.sum("total_fight_seconds").alias("total_seconds"), v.tidy(v.mean("boss_kills"), 4).alias("avg_kills"))


def raids_by_zone(summary: DataFrame) -> DataFrame:
    return summary.groupBy("zone_name").agg(F.count("*").alias("raids"), F.sum("boss_kills").alias("boss_kills"), F.max("raid_night_date").alias("last_raid_date"))


def raid_kills(roster: DataFrame) -> DataFrame:
    """Kills of a report with the size of their roster; the roster rows themselves stay rows."""
    return roster.groupBy("report_code", "encounter_id", "fight_id", "boss_name", "difficulty_label", "duration_seconds").agg(F.count("*").alias("players"))


def raid_kill_rosters(roster: DataFrame) -> DataFrame:
    """The players of each kill of a report, one row each, with the key of the kill and the size of its roster."""
    kill = ["report_code", "encounter_id", "fight_id"]
    counted = rows.with_duplicate_count(roster, kill, "players")
    return counted.select(
        "report_code", F.concat_ws("-", "encounter_id", "fight_id").alias("encounter_key"), "boss_name", "difficulty_label", "duration_seconds", "players",
        "player_identity_key", "player_name", "player_class", "role", "spec", "avg_item_level", "throughput_per_second", "rank_percent")


def top_parses(roster: DataFrame, n: int = 10) -> DataFrame:
    ranked = roster.filter("rank_percent > 0").select("report_code", "fight_id", "player_identity_key", "boss_name", "rank_percent")
    return ranked.orderBy(c("rank_percent").desc(), "report_code", "fight_id", "player_identity_key").limit(n)


def recent_raids(summary: DataFrame, n: int = 5) -> DataFrame:
    return summary.orderBy(c("raid_night_date").desc_nulls_last(), c("report_code").desc()).limit(n)


# --- roster and readiness ------------------------------------------------------------------

def merged_team(live: DataFrame, guild: DataFrame, team: DataFrame) -> DataFrame:
    """Live roster rows filled from team, then guild rows; the first non-blank value wins."""
    shared = ("player_class", "realm", "rank_label", "rank_category", "is_active", "total_raids_tracked", "raids_present",
              "attendance_rate_pct", "last_raid_date", "first_raid_date")

    def keyed(df: DataFrame, mark: str, extra: tuple[str, ...] = ()) -> DataFrame:
        one = rows.dedup_ordered(df.withColumn("_key", F.lower("name")).select("_key", *shared, *extra), ["_key"])
        return one.select(c("_key").alias(f"_{mark}_key"), *[c(n).alias(f"_{mark}_{n}") for n in (*shared, *extra)])

    t = keyed(team, "t", ("possible_main", "has_possible_alt_in_logs"))
    g = keyed(guild, "g")
    joined = (live.withColumn("_key", F.lower("name")).join(t, c("_key") == c("_t_key"), "left").join(g, c("_key") == c("_g_key"), "left"))

    def text(*options: Column | str) -> Column:
        return F.coalesce(*[F.nullif(c(o) if isinstance(o, str) else o, F.lit("")) for o in options])

    unknown = F.lit("Unknown")
    return joined.select(
        "name", F.coalesce(text("_t_player_class", "_g_player_class", "player_class"), unknown).alias("player_class"),
        F.coalesce(text("_t_realm", "_g_realm"), F.lit("")).alias("realm"),
        F.coalesce(text("roster_rank", "_t_rank_label", "_g_rank_label"), unknown).alias("rank_label"),
        F.coalesce(text("roster_rank", "_t_rank_category", "_g_rank_category"), unknown).alias("rank_category"),
        F.coalesce("_t_is_active", "_g_is_active", F.lit(True)).alias("is_active"),
        *[F.coalesce(f"_t_{n}", f"_g_{n}", F.lit(0)).alias(n) for n in ("total_raids_tracked", "raids_present", "attendance_rate_pct")],
        F.coalesce("_t_possible_main", F.lit("")).alias("possible_main"),
        F.coalesce("_t_has_possible_alt_in_logs", F.lit(False)).alias("has_possible_alt_in_logs"), "race", "note")


def readiness_kpis(ready: DataFrame) -> DataFrame:
    tracked = c("kills_tracked") > 0
    core = (c("food_rate") + c("flask_rate") + c("weapon_rate")) / 3
    bare = (c("food_rate") + c("flask_rate") + c("weapon_rate") + c("combat_potion_rate")) == 0
    return ready.agg(
        v.tidy(v.mean("readiness_score"), 2).alias("avg_readiness"), v.tidy(_mean(F.when(tracked, c("combat_potion_rate"))), 2).alias("avg_combat_potion"),
        v.tidy(_mean(F.when(tracked, core)), 2).alias("avg_core_coverage"), F.count_if(c("readiness_label") == "watch").alias("watchlist"),
        F.count_if("is_active").alias("active"), F.count_if("has_current_tier_data").alias("current_tier"),
        ((F.count_if(tracked) > 0) & (F.count_if(tracked & ~bare) == 0)).alias("zero_consumable_coverage"))


def watch_list(ready: DataFrame, n: int = 3) -> DataFrame:
    return ready.filter("readiness_label = 'watch'").select("identity_key", "readiness_score").orderBy("readiness_score", "identity_key").limit(n)


def best_prepared(ready: DataFrame, n: int = 3) -> DataFrame:
    return ready.select("identity_key", "readiness_score").orderBy(c("readiness_score").desc(), "identity_key").limit(n)


def strongest_signals(ready: DataFrame) -> DataFrame:
    """Highest rate per raider; potions count for damage dealers only, earlier rates win ties."""
    signals = ["attendance_rate_pct", "food_rate", "flask_rate", "weapon_rate", "combat_potion_rate"]
    labels = ["Attendance", "Food", "Flask", "Weapon", "Combat Potion"]
    entries = [F.struct(c(s).alias("value"), F.lit(-i).alias("order"), F.lit(label).alias("label")) for i, (s, label) in enumerate(zip(signals, labels))]
    entries[-1] = F.when(c("role") == "dps", entries[-1])
    best = F.array_max(F.array_compact(F.array(*entries)))
    return ready.select("identity_key", best["label"].alias("signal"), best["value"].alias("value"))


# --- dungeon runs --------------------------------------------------------------------------

def main_role(dps: str = "score_dps", healer: str = "score_healer", tank: str = "score_tank") -> Column:
    d, h, t = (F.coalesce(n, F.lit(0.0)) for n in (dps, healer, tank))
    return (F.when((h >= d) & (h >= t) & (h > 0), "healer").when((t >= d) & (t >= h) & (t > 0), "tank").otherwise("dps"))


def active_runners(summary: DataFrame) -> DataFrame:
    return summary.filter("player_name IS NOT NULL AND score_all > 0").withColumn("role", main_role())


def team_runners(summary: DataFrame, live: DataFrame, team: DataFrame) -> DataFrame:
    """Active players of the live roster, or of the raid team when the live roster is empty."""
    size = live.agg(F.count("*").alias("n"))
    names = live.select(F.lower(F.trim("name")).alias("_name")).unionByName(
        team.filter(size.scalar() == 0).select(F.lower("name").alias("_name"))).filter("_name <> ''")
    return active_runners(summary).withColumn("_name", F.lower("player_name")).join(names, "_name", "left_semi").drop("_name")


def _this_week(weekly: DataFrame) -> DataFrame:
    newest = weekly.agg(F.max("week_start").alias("w"))
    return weekly.filter(c("week_start") == newest.scalar()).groupBy("player_name").agg(F.max("total_runs").alias("runs_this_week"))


def runner_kpis(runners: DataFrame, weekly: DataFrame) -> DataFrame:
    joined = runners.join(_this_week(weekly), "player_name", "left").fillna(0, ["runs_this_week"])
    return joined.agg(F.count("*").alias("active"), v.tidy(v.mean("score_all"), 2).alias("avg_score"),
                      F.max_by("player_name", F.struct("score_all", "player_name")).alias("top_player"), F.sum("runs_this_week").alias("keys_this_week"))


def vault_tiers(runners: DataFrame, weekly: DataFrame) -> DataFrame:
    joined = runners.join(_this_week(weekly), "player_name", "left").fillna(0, ["runs_this_week"])
    return joined.agg(*[F.count_if(c("runs_this_week") >= n).alias(f"filled_{n}") for n in (1, 4, 8)], F.count("*").alias("players"),
                      F.sum("runs_this_week").alias("total_runs"))


def dungeon_matrix(dungeons: DataFrame, runners: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per player, one column per dungeon with the best timed level; the dungeon list is the season's."""
    own = dungeons.join(runners.select("player_name"), "player_name", "left_semi")
    wide = own.groupBy("player_name").pivot("dungeon", list(names)).agg(F.coalesce(F.max("highest_timed_level"), F.lit(0)))
    filled = runners.select("player_name").distinct().join(wide, "player_name", "left").fillna(0, list(names))
    return filled.select("player_name", *[c(f"`{n}`").alias(n.lower().replace(" ", "_")) for n in names])


def matrix_summary(dungeons: DataFrame, runners: DataFrame, **options) -> DataFrame:
    """Coverage of the player × dungeon grid, from counts: the grid itself is never formed."""
    own = dungeons.join(runners.select("player_name"), "player_name", "left_semi")
    players = runners.agg(F.countDistinct("player_name").alias("n"))
    kinds = dungeons.agg(F.countDistinct("dungeon").alias("n"))
    timed = own.filter("highest_timed_level > 0")
    median = ordered.exact_quantiles(timed, [], "highest_timed_level", {"m": 0.5}, **options).select("m")
    base = own.agg(F.count_if(c("highest_timed_level") > 0).alias("timed_cells"), F.max("highest_key_level").alias("best_key"),
                   v.tidy(_mean(F.when(c("highest_timed_level") > 0, c("highest_timed_level"))), 4).alias("avg_timed"))
    cells = base.select("*", (players.scalar() * kinds.scalar()).alias("total_cells"), F.coalesce(median.scalar(), F.lit(0.0)).alias("median_timed"))
    return cells.withColumn("coverage_pct", v.tidy(v.ratio("timed_cells", "total_cells") * 100, 2))


def score_trajectory(history: DataFrame, runners: DataFrame) -> DataFrame:
    roles = runners.groupBy("player_name").agg(F.max("role").alias("role"))
    scored = history.filter("score_all > 0").join(roles, "player_name")
    return scored.groupBy("snapshot_date").agg(
        *[v.tidy(v.mean(F.when(c("role") == r, c("score_all"))), 4).alias(r) for r in ("dps", "healer", "tank")],
        v.tidy(v.mean("score_all"), 4).alias("all_roles"))


def push_candidates(dungeons: DataFrame, runners: DataFrame) -> DataFrame:
    """Dungeons where the best key is above the best timed one."""
    roles = runners.groupBy("player_name").agg(F.max("role").alias("role"))
    timed = F.coalesce("highest_timed_level", F.lit(0))
    above = dungeons.filter((c("highest_key_level") > timed) & (c("highest_key_level") > 0)).join(roles, "player_name", "left")
    return above.select("player_name", F.coalesce("role", F.lit("dps")).alias("role"), "dungeon", c("best_short_name").alias("short_name"),
                        c("highest_key_level").alias("highest_untimed"), timed.alias("highest_timed"), (c("highest_key_level") - timed).alias("gap"),
                        c("latest_completed_at").alias("latest"))


def run_heatmap(runs: DataFrame) -> DataFrame:
    return runs.filter("completed_date IS NOT NULL").groupBy("player_name", "completed_date").agg(
        F.count("*").alias("runs"), F.max("mythic_level").alias("highest_level"), F.count_if("timed").alias("timed"))


def runs_in_year(runs: DataFrame, year: int) -> DataFrame:
    return runs.filter(F.year("completed_date") == year).groupBy("player_name").agg(F.count("*").alias("runs_this_year"))


def timer_used(runs: DataFrame) -> DataFrame:
    used = F.when((c("clear_time_ms") > 0) & (c("par_time_ms") > 0), c("clear_time_ms") / c("par_time_ms") * 100)
    return runs.select("url", used.alias("timer_used_pct"))


# --- parse distribution --------------------------------------------------------------------

def _parses(roster: DataFrame) -> DataFrame:
    return roster.filter("rank_percent >= 0 AND rank_percent <= 100").select("rank_percent", F.least(F.floor(c("rank_percent") / 5), F.lit(19)).alias("bin"))


# First bin of each parse tier.
PARSE_TIERS = (("Grey", 0), ("Green", 5), ("Blue", 10), ("Epic", 15), ("Legendary", 19))


def parse_histogram(roster: DataFrame) -> DataFrame:
    """Twenty bins, empty ones included."""
    counts = _parses(roster).groupBy("bin").agg(F.count("*").alias("parses"))
    bins = roster.sparkSession.range(20).select(c("id").alias("bin"))
    return bins.join(counts, "bin", "left").fillna(0, ["parses"]).withColumn("midpoint", c("bin") * 5 + 2.5)


def parse_tier_mix(roster: DataFrame) -> DataFrame:
    tier = F.lit(None).cast("string")
    for name, first in PARSE_TIERS:
        tier = F.when(c("bin") >= first, name).otherwise(tier) if first else F.lit(name)
    return _parses(roster).groupBy(tier.alias("tier")).agg(F.count("*").alias("parses"))


def parse_median(roster: DataFrame, **options) -> DataFrame:
    return ordered.exact_quantiles(_parses(roster), [], "rank_percent", {"median": 0.5}, **options)


def parse_shape(roster: DataFrame) -> DataFrame:
    """One row: moments of the parse distribution and the most likely type with its probability.

    Parses that are all equal are surely uniform, with no spread, skewness or kurtosis.
    """
    moments = _parses(roster).agg(F.count("*").alias("n"), F.stddev_pop("rank_percent").alias("sd"), F.skewness("rank_percent").alias("skew"),
                                  (F.kurtosis("rank_percent") + 3).alias("kurt"))
    line = Window.partitionBy(F.lit(0)).orderBy("bin")  # twenty rows
    bins = parse_histogram(roster)
    around = [F.coalesce(f("parses").over(line), c("parses")) for f in (F.lag, F.lead)]
    smooth = bins.select("bin", ((around[0] + c("parses") + around[1]) / 3).alias("s"))
    total = moments.select("n")
    peak = (c("s") > F.lag("s").over(line)) & (c("s") > F.lead("s").over(line)) & (c("s") >= total.scalar() * 0.025)
    peaks = smooth.select(peak.alias("p")).agg(F.count_if("p").alias("n"))
    base = moments.filter("n >= 10 AND sd > 0").withColumn("peaks", peaks.scalar())
    size, heavy = F.abs("skew"), F.when(c("kurt") > 3, 0.08).otherwise(0.0)
    bimodality = (c("skew") * c("skew") + 1) / F.greatest("kurt", F.lit(0.001))

    def bounded(score: Column, top: float = 0.98) -> Column:
        return v.clamp(score, 0.02, top)

    scores = {
        "Normal": bounded(1 - size / 1.25 - F.abs(c("kurt") - 3) / 4 - F.when(c("peaks") > 1, 0.2).otherwise(0.0)),
        "Left-skew": bounded(F.when(c("skew") < 0, size / 1.15 + heavy).otherwise(0.03)),
        "Right-skew": bounded(F.when(c("skew") > 0, size / 1.15 + heavy).otherwise(0.03)),
        "Bimodal": bounded(F.when(c("peaks") >= 2, 0.48 + (c("peaks") - 1) * 0.12 + F.greatest(F.lit(0.0), bimodality - 0.55)).otherwise(0.02)),
        "Uniform": bounded(1 - size / 0.8 - F.abs(c("kurt") - 1.8) / 1.4 - F.when(c("peaks") > 2, 0.2).otherwise(0.0), 0.82)}
    weighted = base.select("*", F.array(*[F.struct(F.exp(s * 4).alias("w"), F.lit(t).alias("t")) for t, s in scores.items()]).alias("all"))
    best = weighted.select("*", F.array_max("all").alias("top"), F.aggregate("all", F.lit(0.0), lambda acc, x: acc + x["w"]).alias("sum"))
    spread = best.select("n", "peaks", v.tidy("sd", 6).alias("standard_deviation"), v.tidy("skew", 6).alias("skewness"), v.tidy("kurt", 6).alias("kurtosis"),
                         c("top.t").alias("type"), v.tidy(c("top.w") / c("sum") * 100, 4).alias("probability"))
    none = F.lit(0.0)
    equal = moments.filter("n >= 10 AND sd = 0").select(
        "n", F.lit(0).cast("bigint").alias("peaks"), none.alias("standard_deviation"), none.alias("skewness"), none.alias("kurtosis"),
        F.lit("Uniform").alias("type"), F.lit(100.0).alias("probability"))
    return spread.unionByName(equal)


# --- wipes ---------------------------------------------------------------------------------

def scoped_survivability(roster: DataFrame, deaths: DataFrame, summary: DataFrame) -> DataFrame:
    """Deaths per kill and per pull of every player with a kill or death in scope."""
    kill = F.coalesce("is_kill", F.lit(False))
    kills = roster.groupBy("player_name").agg(F.count("*").alias("kills_tracked"), F.max("player_class").alias("player_class"))
    died = deaths.groupBy("player_name").agg(F.count("*").alias("total_deaths"), F.count_if(kill).alias("kill_deaths"), F.count_if(~kill).alias("wipe_deaths"),
                                             F.max("player_class").alias("player_class"))
    nights = roster.select("player_name", "report_code").distinct().join(summary.select("report_code", "total_wipes"), "report_code")
    wiped = nights.groupBy("player_name").agg(F.sum("total_wipes").alias("_wipes"))
    blows = rows.mode_by(deaths, ["player_name"], "killing_blow_name", "most_common_killing_blow", "most_common_killing_blow_count")
    numbers = ("kills_tracked", "total_deaths", "kill_deaths", "wipe_deaths", "_wipes", "most_common_killing_blow_count")
    merged = rows.union_branches([kills, died, wiped, blows]).groupBy("player_name").agg(
        F.max("player_class").alias("player_class"), F.max("most_common_killing_blow").alias("most_common_killing_blow"),
        *[F.coalesce(F.sum(n), F.lit(0).cast("bigint")).alias(n) for n in numbers])
    pulls = merged.withColumn("pulls_tracked", c("kills_tracked") + c("_wipes"))
    return pulls.select(
        "player_name", "player_class", "total_deaths", "wipe_deaths", "kill_deaths", "kills_tracked", "pulls_tracked",
        F.when(c("kills_tracked") > 0, v.tidy(v.ratio("total_deaths", "kills_tracked"), 4)).alias("deaths_per_kill"),
        F.when(c("pulls_tracked") > 0, v.tidy(v.ratio("total_deaths", "pulls_tracked"), 4)).alias("deaths_per_pull"),
        F.coalesce("most_common_killing_blow", F.lit("")).alias("most_common_killing_blow"), "most_common_killing_blow_count")


def cooldown_capacity(utilization: DataFrame) -> DataFrame:
    sums = utilization.groupBy("cooldown_category", "player_name", "ability_id").agg(
        F.max("ability_name").alias("ability_name"), *[F.sum(n).alias(n) for n in ("possible_casts", "actual_casts", "missed_casts")],
        F.count("*").alias("pulls_tracked"))
    return sums.withColumn("cast_efficiency_pct", F.when(c("possible_casts") > 0, v.tidy(c("actual_casts") / c("possible_casts") * 100, 4)).otherwise(0.0))


def top_missed_cooldowns(utilization: DataFrame, category: str, n: int = 8) -> DataFrame:
    own = cooldown_capacity(utilization).filter(c("cooldown_category") == category)
    return own.orderBy(c("missed_casts").desc(), c("possible_casts").desc(), "player_name", "ability_id").limit(n)


def relative_grades(discipline: DataFrame) -> DataFrame:
    """Grades S to F by a score's place among the distinct scores of its scope.

    Scores have one decimal in 0..100, so a scope holds at most 1001 distinct ones.
    """
    scope = ["zone_name", "boss_name", "difficulty_label"]
    # Read twice, for the distinct scores and for the rows that are graded.
    discipline = stored(discipline.select("player_identity_key", *scope, "survival_discipline_score"))
    distinct = discipline.select(*scope, "survival_discipline_score").distinct()
    whole = Window.partitionBy(*scope)
    placed = distinct.select("*", (F.row_number().over(whole.orderBy("survival_discipline_score")) - 1).alias("_i"), F.count("*").over(whole).alias("_n"))
    middle = (c("_i") - 1) / F.greatest(c("_n") - 3, F.lit(1))
    grade = (F.when((c("_n") <= 1) | (c("_i") == c("_n") - 1), "S").when(c("_i") == 0, "F").when(c("_n") <= 3, "A")
             .when(middle >= 0.8, "A").when(middle >= 0.6, "B").when(middle >= 0.4, "C").when(middle >= 0.2, "D").otherwise("E"))
    graded = placed.select(*scope, "survival_discipline_score", grade.alias("survival_grade"))
    return discipline.join(graded, [*scope, "survival_discipline_score"])


_LENGTHS = {"<1 min": "wipes_lt_1min", "1–3 min": "wipes_1_3min", "3–5 min": "wipes_3_5min", "5+ min": "wipes_5plus_min"}


def wipe_kpis(wipes: DataFrame, mechanics: DataFrame, deaths: DataFrame) -> DataFrame:
    """One row: wipes, early and late share, deaths per wipe, and the length that dominates."""
    lost = deaths.filter(~c("is_kill")).agg(F.count("*").alias("n"))
    total = wipes.agg(F.coalesce(F.sum("total_wipes"), F.lit(0)).alias("n"))
    sums = mechanics.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _LENGTHS.values()])
    base = sums.select("*", total.scalar().alias("total_wipes"), lost.scalar().alias("wipe_deaths"))
    entries = F.array(*[F.struct(c(n).alias("w"), F.lit(-i).alias("o"), F.lit(label).alias("l")) for i, (label, n) in enumerate(_LENGTHS.items())])
    top = F.array_max(entries)
    share = v.ratio(top["w"], "total_wipes")
    return base.select("total_wipes", "wipe_deaths", *_LENGTHS.values(), v.tidy(v.ratio("wipes_lt_1min", "total_wipes"), 4).alias("early_wipe_rate"),
                       v.tidy(v.ratio("wipes_5plus_min", "total_wipes"), 4).alias("late_wipe_rate"),
                       v.tidy(v.ratio("wipe_deaths", "total_wipes"), 4).alias("deaths_per_wipe"),
                       F.when((c("total_wipes") > 0) & (share >= 0.4), top["l"]).alias("dominant_length"))


def _named_blows(deaths: DataFrame) -> DataFrame:
    return deaths.filter("killing_blow_name <> '' AND killing_blow_name <> 'null'")


def top_killing_blows(deaths: DataFrame, n: int = 10) -> DataFrame:
    counts = _named_blows(deaths).groupBy("killing_blow_name").agg(F.count("*").alias("deaths"))
    return counts.orderBy(c("deaths").desc(), "killing_blow_name").limit(n)


def recurring_killers(deaths: DataFrame, n: int | None = 10) -> DataFrame:
    """Blows of wipe deaths by how many players and bosses they span."""
    killers = _named_blows(deaths).filter(~c("is_kill")).groupBy("killing_blow_name").agg(
        F.count("*").alias("deaths"), F.countDistinct("player_name").alias("unique_players"), F.countDistinct("boss_name").alias("unique_bosses"))
    order = [c("unique_players").desc(), c("deaths").desc(), c("killing_blow_name").asc()]
    return killers.orderBy(*order).limit(n) if n else killers


def cause_by_boss(deaths: DataFrame, n: int = 5) -> DataFrame:
    """The leading killers with the boss where each strikes most."""
    wipe = _named_blows(deaths).filter(~c("is_kill"))
    bosses = rows.mode_by(wipe, ["killing_blow_name"], "boss_name", "top_boss", "top_boss_deaths")
    return recurring_killers(deaths, n).join(bosses, "killing_blow_name", "left")


def _death_times(deaths: DataFrame) -> DataFrame:
    return deaths.filter(~c("is_kill")).select((c("death_timestamp_ms") - c("fight_start_ms")).alias("ms")).filter("ms >= 0 AND ms < 3600000")


def death_outliers(deaths: DataFrame, **options) -> DataFrame:
    """Times of wipe deaths beyond the whiskers of their box plot, with the number of deaths at each; none below five deaths."""
    after = _death_times(deaths)
    box = ordered.exact_quantiles(after, [], "ms", {"q1": 0.25, "q3": 0.75}, **options).filter("n >= 5")
    reach = (c("q3") - c("q1")) * 1.5
    fences = F.broadcast(box.select(F.lit(1).alias("_one"), (c("q1") - reach).alias("_low"), (c("q3") + reach).alias("_high")))  # one row
    times = after.groupBy("ms").agg(F.count("*").alias("deaths")).withColumn("_one", F.lit(1)).join(fences, "_one")
    side = F.when(c("ms") < c("_low"), "below").when(c("ms") > c("_high"), "above")
    return times.select("ms", "deaths", side.alias("side")).filter("side IS NOT NULL")


def death_timing(deaths: DataFrame, **options) -> DataFrame:
    """Box plot of the time of wipe deaths: quartiles, whiskers and outlier count, from five deaths on."""
    after = _death_times(deaths)
    box = ordered.exact_quantiles(after, [], "ms", {"q1": 0.25, "median": 0.5, "q3": 0.75}, **options).filter("n >= 5")
    low = box.select((c("q1") - (c("q3") - c("q1")) * 1.5).alias("x"))
    high = box.select((c("q3") + (c("q3") - c("q1")) * 1.5).alias("x"))
    # Few distinct times: fences are compared once per time, not per death.
    times = after.groupBy("ms").agg(F.count("*").alias("_k"))
    fenced = times.select("ms", "_k", (c("ms") < low.scalar()).alias("_below"), (c("ms") > high.scalar()).alias("_above"))
    whiskers = fenced.agg(F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"), F.min(F.when(~c("_below"), c("ms"))).alias("lower_whisker"),
                          F.max(F.when(~c("_above"), c("ms"))).alias("upper_whisker"),
                          F.coalesce(F.sum(F.when(c("_below") | c("_above"), c("_k"))), F.lit(0)).alias("outliers"))
    return whiskers.select("*", *[box.select(q).scalar().alias(q) for q in ("n", "q1", "median", "q3")]).filter("n IS NOT NULL")


def first_deaths(deaths: DataFrame) -> DataFrame:
    """First death of each wipe pull: a minimum per pull, combined before the shuffle."""
    wipe = deaths.filter(~c("is_kill") & (c("death_timestamp_ms") > 0))
    first = wipe.groupBy("report_code", "fight_id", "boss_name").agg(
        F.min(F.struct("death_timestamp_ms", "player_name", "player_class", "fight_start_ms", "killing_blow_name")).alias("d"))
    return first.select("report_code", "fight_id", "boss_name", "d.*")


def first_death_leaders(deaths: DataFrame) -> DataFrame:
    return first_deaths(deaths).groupBy("player_name").agg(F.count("*").alias("first_deaths"), F.max("player_class").alias("player_class"))


def first_death_profile(deaths: DataFrame, roster: DataFrame) -> DataFrame:
    """One row: first deaths by role and by time into the pull."""
    roles = roster.groupBy("player_name").agg(F.min_by("role", F.struct("raid_night_date", "report_code", "fight_id")).alias("role"))
    first = first_deaths(deaths).join(roles, "player_name", "left")
    ms = c("death_timestamp_ms") - c("fight_start_ms")
    timed = (c("fight_start_ms") > 0) & (ms >= 0)
    return first.agg(
        F.count("*").alias("total"), *[F.count_if(c("role") == r).alias(f"role_{r}") for r in ("tank", "healer", "dps")],
        F.count_if(c("role").isNull()).alias("role_unknown"), F.count_if(timed & (ms < 30000)).alias("lt_30s"),
        F.count_if(timed & (ms >= 30000) & (ms < 60000)).alias("s30_60"), F.count_if(timed & (ms >= 60000) & (ms < 120000)).alias("m1_2"),
        F.count_if(timed & (ms >= 120000)).alias("gt_2m"))


def first_death_blows(deaths: DataFrame, n: int = 4) -> DataFrame:
    counts = _named_blows(first_deaths(deaths)).groupBy("killing_blow_name").agg(F.count("*").alias("deaths"))
    return counts.orderBy(c("deaths").desc(), "killing_blow_name").limit(n)


def phase_breakdown(wipes: DataFrame) -> DataFrame:
    return wipes.filter("max_phase_reached > 0").groupBy(c("max_phase_reached").alias("phase")).agg(F.sum("total_wipes").alias("wipes"))


def boss_spotlight(wipes: DataFrame, mechanics: DataFrame, n: int = 12) -> DataFrame:
    """Closest wipes first, with the trend of their boss."""
    trend = mechanics.select(*BOSS, "zone_name", "progress_trend", "trend_direction")
    joined = wipes.filter("best_wipe_pct > 0").join(trend, [*BOSS, "zone_name"], "left")
    return joined.select(*BOSS, "boss_name", "zone_name", "best_wipe_pct", "progress_trend", "trend_direction").orderBy(
        "best_wipe_pct", "encounter_id", "difficulty").limit(n)


def most_punished(survivability: DataFrame, n: int = 10) -> DataFrame:
    return survivability.filter("wipe_deaths > 0").select("player_name", "wipe_deaths", "total_deaths").orderBy(c("wipe_deaths").desc(), "player_name").limit(n)


def scope_signals(wipes: DataFrame, progression: DataFrame, deaths: DataFrame) -> DataFrame:
    """One row: top blocker and its share, unresolved bosses, top killer and first-death leader."""
    label = F.concat_ws(" / ", "boss_name", "difficulty_label")
    base = wipes.agg(F.sum("total_wipes").alias("total_wipes"), F.max(F.struct(c("total_wipes").alias("w"), label.alias("l"))).alias("top"))
    killer = recurring_killers(deaths, 1).select("killing_blow_name")
    leader = first_death_leaders(deaths).agg(F.max_by("player_name", F.struct("first_deaths", "player_name")).alias("x"))
    open_bosses = progression.agg(F.count_if(~F.coalesce("is_killed", F.lit(False))).alias("n"))
    return base.select("total_wipes", c("top.l").alias("top_blocker"), v.tidy(v.ratio("top.w", "total_wipes") * 100, 2).alias("top_blocker_pct"),
                       open_bosses.scalar().alias("unresolved"), killer.scalar().alias("top_killer"), leader.scalar().alias("first_death_leader"))
