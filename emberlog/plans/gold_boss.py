"""Gold products about bosses, raids and weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import values as v
from emberlog.operators import rows

BOSS = ["encounter_id", "boss_name", "zone_name", "difficulty", "difficulty_label"]


def _kill() -> Column:
    return F.coalesce(F.col("is_kill"), F.lit(False))


def _when_kill(column: str):
    return F.when(_kill(), F.col(column))


def _when_wipe(column: str):
    return F.when(~_kill(), F.col(column))


def boss_progression(fights: DataFrame) -> DataFrame:
    grouped = fights.groupBy("encounter_id", "boss_name", "zone_id", "zone_name", "difficulty", "difficulty_label").agg(
        F.count(F.lit(1)).alias("total_pulls"), F.count_if(_kill()).alias("total_kills"), F.count_if(~_kill()).alias("total_wipes"),
        F.min(_when_kill("duration_seconds")).alias("best_kill_seconds"),
        v.mean("duration_seconds").alias("avg_pull_duration_seconds"), F.max(F.when(_kill(), F.lit(True))).alias("is_killed"),
        F.min(_when_kill("raid_night_date")).alias("first_kill_date"), F.max("raid_night_date").alias("last_attempt_date"))
    return grouped.withColumn("wipe_to_kill_ratio", v.tidy(v.ratio("total_wipes", "total_kills"), 2))


def raid_summary(reports: DataFrame, fights: DataFrame) -> DataFrame:
    """One row per report; its descriptive columns come from the first pull of the night."""
    opening = F.min(F.struct("fight_id", "zone_id", "zone_name", "raid_night_date", "difficulty_label"))
    stats = fights.groupBy("report_code").agg(
        F.count(F.lit(1)).alias("total_pulls"), F.count_if(_kill()).alias("boss_kills"), F.count_if(~_kill()).alias("total_wipes"),
        F.sum("duration_seconds").alias("total_fight_seconds"), F.countDistinct("encounter_id").alias("unique_bosses_engaged"),
        F.countDistinct(_when_kill("encounter_id")).alias("unique_bosses_killed"), opening.alias("_first"))
    base = reports.select(F.col("code").alias("report_code"), F.col("title").alias("report_title"), "start_time_utc", "end_time_utc")
    return base.join(stats, "report_code", "left").select(
        *base.columns, "_first.zone_id", "_first.zone_name", "_first.raid_night_date",
        F.col("_first.difficulty_label").alias("primary_difficulty"), "total_pulls", "boss_kills", "total_wipes", "total_fight_seconds",
        "unique_bosses_engaged", "unique_bosses_killed")


def progression_timeline(fights: DataFrame) -> DataFrame:
    """First kill per boss and difficulty, with the running number of bosses down.

    Kills are first reduced to one row per boss, then counted per day, so the running window sees
    one row per difficulty and day.
    """
    kills = fights.filter(_kill()).select(*BOSS, "raid_night_date", "report_code", "fight_id")
    first = rows.latest_by(kills, ["encounter_id", "difficulty"],
                           [F.col("raid_night_date").asc(), F.col("report_code").asc(), F.col("fight_id").asc()])
    days = first.groupBy("difficulty", "raid_night_date").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("difficulty").orderBy("raid_night_date").rowsBetween(Window.unboundedPreceding, -1)
    before = days.select("difficulty", "raid_night_date", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    on_day = F.row_number().over(Window.partitionBy("difficulty", "raid_night_date").orderBy("encounter_id"))
    return first.withColumn("_on_day", on_day).join(before, ["difficulty", "raid_night_date"]).select(
        *BOSS, "raid_night_date", (F.col("_before") + F.col("_on_day")).alias("cumulative_kills"))


def best_kills(fights: DataFrame) -> DataFrame:
    grouped = fights.filter(_kill()).groupBy(*BOSS).agg(
        F.min("duration_seconds").alias("best_kill_seconds"), v.mean("duration_seconds").alias("avg_kill_seconds"),
        F.count(F.lit(1)).alias("total_kills"), F.min("raid_night_date").alias("first_kill_date"),
        F.max("raid_night_date").alias("latest_kill_date"))
    return grouped.withColumn("best_kill_mm_ss", v.mm_ss("best_kill_seconds"))


def boss_wipe_analysis(fights: DataFrame) -> DataFrame:
    grouped = fights.filter(~F.col("is_kill")).groupBy(*BOSS).agg(
        F.count(F.lit(1)).alias("total_wipes"), F.min("boss_percentage").alias("best_wipe_pct"),
        v.mean("boss_percentage").alias("avg_wipe_pct"), v.mean("last_phase").alias("avg_last_phase"),
        F.max("last_phase").alias("max_phase_reached"), v.mean("duration_seconds").alias("avg_wipe_duration_seconds"),
        F.max("duration_seconds").alias("longest_wipe_seconds"), F.min("raid_night_date").alias("first_wipe_date"),
        F.max("raid_night_date").alias("latest_wipe_date"), F.countDistinct("raid_night_date").alias("raid_nights_attempted"))
    return grouped.withColumn("avg_wipe_pct_rounded", v.tidy("avg_wipe_pct", 1))


def _report_titles(reports: DataFrame) -> DataFrame:
    return reports.select(F.col("code").alias("report_code"), F.col("title").alias("_title"), "start_time_utc", "end_time_utc")


def boss_progress_history(fights: DataFrame, reports: DataFrame) -> DataFrame:
    nights = fights.groupBy(*BOSS, "raid_night_date", "report_code").agg(
        F.count(F.lit(1)).alias("pulls_on_night"), F.count_if(_kill()).alias("kills_on_night"), F.count_if(~_kill()).alias("wipes_on_night"),
        F.min(_when_wipe("boss_percentage")).alias("best_wipe_pct_on_night"),
        v.tidy(v.mean(_when_wipe("boss_percentage")), 2).alias("avg_wipe_pct_on_night"), F.max(_kill()).alias("is_kill_on_night"),
        F.max("duration_seconds").alias("longest_pull_seconds"), F.max(_when_kill("duration_seconds")).alias("kill_duration_seconds"))
    left = F.when(F.col("is_kill_on_night"), 0.0).otherwise(v.tidy("best_wipe_pct_on_night", 2))
    return nights.join(_report_titles(reports), "report_code", "left").select(
        *BOSS, "raid_night_date", "report_code", F.col("_title").alias("report_title"), "start_time_utc", "end_time_utc",
        "pulls_on_night", "kills_on_night", "wipes_on_night", "best_wipe_pct_on_night", "avg_wipe_pct_on_night",
        left.alias("best_boss_hp_remaining"), "is_kill_on_night", "kill_duration_seconds", "longest_pull_seconds")


def boss_pull_history(fights: DataFrame, reports: DataFrame) -> DataFrame:
    context = fights.drop("start_time_utc").join(_report_titles(reports), "report_code", "left")
    left = F.when(_kill(), 0.0).otherwise(F.col("boss_percentage"))
    return context.select(*BOSS, "raid_night_date", "report_code", F.coalesce("_title", "report_title").alias("report_title"),
                          "start_time_utc", "end_time_utc", "fight_id", "is_kill", "boss_percentage",
                          left.alias("boss_hp_remaining"), "duration_seconds", "last_phase")


def encounter_catalog(catalog: DataFrame) -> DataFrame:
    return catalog.filter(~F.col("zone_frozen")).select("zone_id", "zone_name", "encounter_id", "encounter_name", "difficulty_names")


def boss_mechanics(fights: DataFrame) -> DataFrame:
    """Phase and duration mix of wipes, and the latest week against all time.

    The weekly means come from per-week sums, so the wipes are aggregated once at week grain and
    no window runs over raw rows.
    """
    wipes = fights.filter(~F.col("is_kill") & (F.col("encounter_id") > 0) & F.col("difficulty").isin(*rules.DIFFICULTIES)).select(
        *BOSS, v.week_start("raid_night_date").alias("_week"), v.phase_bucket("last_phase").alias("_phase"),
        v.duration_bucket("duration_seconds").alias("_length"), F.col("boss_percentage").cast("decimal(18,4)").alias("_pct"))
    phases = {"phase_1": "Phase 1", "phase_2": "Phase 2", "phase_3_plus": "Phase 3+"}
    lengths = {"lt_1min": "< 1 min", "1_3min": "1-3 min", "3_5min": "3-5 min", "5plus_min": "5+ min"}
    weekly = wipes.groupBy(*BOSS, "_week").agg(
        F.count(F.lit(1)).alias("_wipes"), F.sum("_pct").alias("_sum"), F.count("_pct").alias("_n"),
        *[F.count_if(F.col("_phase") == t).alias(f"_{n}") for n, t in phases.items()],
        *[F.count_if(F.col("_length") == t).alias(f"wipes_{n}") for n, t in lengths.items()])
    # Latest week per encounter and difficulty over all its labels, as two-step sums.
    by_week = weekly.groupBy("encounter_id", "difficulty", "_week").agg(F.sum("_sum").alias("_wsum"), F.sum("_n").alias("_wn"))
    last = by_week.groupBy("encounter_id", "difficulty").agg(F.max(F.struct("_week", "_wsum", "_wn")).alias("_last"))
    total = weekly.groupBy(*BOSS).agg(*[F.sum(c).alias(c) for c in weekly.columns if c not in (*BOSS, "_week")])
    joined = total.join(last, ["encounter_id", "difficulty"], "left")
    mean = F.col("_sum").cast("double") / F.nullif("_n", F.lit(0))
    recent = F.col("_last._wsum").cast("double") / F.nullif(F.col("_last._wn"), F.lit(0))
    trend = v.tidy(recent - mean, 2)
    return joined.select(
        *BOSS, F.col("_wipes").alias("total_wipes"), v.tidy(mean, 1).alias("avg_boss_pct"),
        *[v.pct(f"_{n}", "_wipes").alias(f"pct_wipes_{n}") for n in phases], *[f"wipes_{n}" for n in lengths],
        v.tidy(recent, 1).alias("last_week_avg_boss_pct"), trend.alias("progress_trend"),
        # The value is boss health left, so a falling one is an improvement.
        F.when(trend < 0, "improving").when(trend > 0, "regressing").when(trend == 0, "flat").alias("trend_direction"))


def weekly_activity(summary: DataFrame) -> DataFrame:
    raids = summary.filter(F.col("zone_name").isNotNull() & ~F.col("zone_name").isin(*rules.EXCLUDED_ZONES))
    sums = {"boss_kills": "total_boss_kills", "total_wipes": "total_wipes", "total_pulls": "total_pulls",
            "total_fight_seconds": "total_raid_seconds"}
    return raids.groupBy(F.date_trunc("week", "start_time_utc").alias("week_start")).agg(
        F.count(F.lit(1)).alias("raid_nights"), *[F.sum(F.coalesce(c, F.lit(0))).alias(n) for c, n in sums.items()],
        F.array_sort(F.collect_set("zone_name")).alias("zones_raided"))
