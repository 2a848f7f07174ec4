"""Gold products about players: attendance, performance, survivability and deaths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import values as v
from emberlog.operators import joins, ordered, rows, scopes
from emberlog.plans.identity import with_identity

PLAYER = ["player_identity_key", "player_name", "player_class", "realm"]


def player_attendance(attendance: DataFrame, actors: DataFrame) -> DataFrame:
    named = with_identity(attendance, actors).withColumnRenamed("realm", "player_realm")
    grouped = named.groupBy("player_identity_key", "player_name", "player_class", "player_realm").agg(
        F.count(F.lit(1)).alias("total_raids_tracked"),
        *[F.count_if(F.col("presence") == code).alias(f"raids_{n}") for code, n in ((1, "present"), (2, "benched"), (3, "absent"))],
        F.max("raid_night_date").alias("last_raid_date"), F.min("raid_night_date").alias("first_raid_date"),
        F.array_sort(F.collect_set("zone_name")).alias("zones_attended"))
    return grouped.withColumn("attendance_rate_pct", v.pct("raids_present", "total_raids_tracked"))


def boss_kill_roster(fact: DataFrame, actors: DataFrame) -> DataFrame:
    return with_identity(fact, actors).select(
        "report_code", "fight_id", "boss_name", "encounter_id", "difficulty", "difficulty_label", "zone_name", "raid_night_date",
        "duration_seconds", *PLAYER, "role", "spec", "avg_item_level", "potion_use", "combat_potion_casts", "combat_potion_names",
        "healthstone_use", "has_food_buff", "food_buff_names", "has_flask_or_phial_buff", "flask_or_phial_names",
        "has_weapon_enhancement", "weapon_enhancement_names", "throughput_per_second", "rank_percent", "bracket_percent", "rank_string")


def _level_stats() -> list[Column]:
    return [v.mean("throughput_per_second").cast("bigint").alias("avg_throughput_per_second"),
            F.max("throughput_per_second").alias("best_throughput_per_second"),
            v.tidy(v.mean("rank_percent"), 1).alias("avg_rank_percent"), v.tidy(F.max("rank_percent"), 1).alias("best_rank_percent"),
            v.tidy(v.mean("avg_item_level"), 1).alias("avg_item_level")]


def player_performance_summary(roster: DataFrame) -> DataFrame:
    grouped = roster.groupBy(*PLAYER, "role").agg(F.count(F.lit(1)).alias("kills_tracked"), *_level_stats(),
                                                  F.max("raid_night_date").alias("last_seen_date"))
    specs = rows.mode_by(roster, ["player_identity_key", "role"], "spec", "primary_spec")
    return grouped.join(specs, ["player_identity_key", "role"], "left").select(
        *PLAYER, "role", "primary_spec", "kills_tracked", "avg_throughput_per_second", "best_throughput_per_second",
        "avg_rank_percent", "best_rank_percent", "avg_item_level", "last_seen_date")


def player_boss_performance(roster: DataFrame) -> DataFrame:
    """Per player, role and boss, in one aggregation; the latest value is the newest of all roles' newest."""
    boss = ["encounter_id", "boss_name", "zone_name", "difficulty", "difficulty_label"]
    when = F.struct("raid_night_date", "report_code", "fight_id")
    newest = F.struct("raid_night_date", "report_code", "fight_id", "throughput_per_second")
    grouped = roster.groupBy(*PLAYER, "role", *boss).agg(
        F.count(F.lit(1)).alias("kills_on_boss"), *_level_stats(), F.min("raid_night_date").alias("first_kill_date"),
        F.max("raid_night_date").alias("latest_kill_date"), F.max(F.when(F.col("throughput_per_second").isNotNull(), newest)).alias("_newest"),
        F.min_by("spec", F.when(F.col("spec").isNotNull(), when)).alias("primary_spec"))
    over_roles = Window.partitionBy("player_identity_key", "encounter_id", "difficulty")
    latest = grouped.withColumn("latest_throughput_per_second", F.max("_newest").over(over_roles)["throughput_per_second"])
    change = (F.col("latest_throughput_per_second") - F.col("avg_throughput_per_second")).cast("double")
    trend = F.when(F.col("kills_on_boss") > 1, v.tidy(v.ratio(change, "avg_throughput_per_second") * 100, 1))
    return latest.select(
        *PLAYER, "role", "primary_spec", *boss, "kills_on_boss", "avg_throughput_per_second", "best_throughput_per_second",
        "latest_throughput_per_second", trend.alias("throughput_trend"), "avg_rank_percent", "best_rank_percent", "avg_item_level",
        "first_kill_date", "latest_kill_date")


def player_survivability(events: DataFrame, roster: DataFrame, actors: DataFrame) -> DataFrame:
    deaths = with_identity(events, actors)
    grouped = deaths.groupBy(*PLAYER).agg(F.count(F.lit(1)).alias("total_deaths"),
                                          F.array_sort(F.collect_set("zone_name")).alias("zones_died_in"),
                                          F.max("death_timestamp_ms").alias("last_death_timestamp_ms"))
    key = ["player_identity_key"]
    blow = rows.mode_by(deaths, key, "killing_blow_name", "most_common_killing_blow", "most_common_killing_blow_count")
    blows = rows.top_values_json(deaths, key, "killing_blow_name", 3, "top_killing_blows_json")
    kills = roster.groupBy(*key).agg(F.count(F.lit(1)).alias("kills_tracked"))
    joined = grouped.join(blow, key, "left").join(blows, key, "left").join(kills, key, "left").fillna(0, ["kills_tracked"])
    return joined.select(*PLAYER, "total_deaths", "kills_tracked", v.tidy(v.ratio("total_deaths", "kills_tracked"), 2).alias("deaths_per_kill"),
                         "most_common_killing_blow", "most_common_killing_blow_count", "top_killing_blows_json", "zones_died_in",
                         "last_death_timestamp_ms")


def player_death_events(events: DataFrame, fights: DataFrame, actors: DataFrame, **options) -> DataFrame:
    """Deaths with boss context and a stable key; equal deaths are told apart by their order.

    Copies are collapsed to a count before they are numbered, so neither a large group of copies
    nor a large key ends up in one task.
    """
    context = fights.select("report_code", "fight_id", "encounter_id", "boss_name", "zone_name", "zone_id", "difficulty",
                            "difficulty_label", "raid_night_date", "is_kill", "fight_start_ms").filter("encounter_id > 0")
    named = with_identity(events.drop("zone_name", "zone_id", "raid_night_date"), actors)
    joined = named.join(context, ["report_code", "fight_id"])
    key = ["report_code", "fight_id", "player_identity_key", "death_timestamp_ms"]
    placed = ordered.running(
        rows.collapse_copies(joined), key,
        [F.col("killing_blow_id").asc_nulls_last(), F.col("killing_blow_name").asc_nulls_last(), F.col("overkill").asc_nulls_last(),
         F.col("player_name").asc(), F.col("player_class").asc()], {"_upto": ("sum", "_copies")}, **options)
    numbered = rows.expand_copies(placed).withColumn("_ordinal", (F.col("_upto") - F.col("_copies") + F.col("_copy") + 1).cast("int"))
    return numbered.select(
        F.format_string("%016x", F.xxhash64(*key, "_ordinal")).alias("death_event_key"), "report_code", "fight_id", "encounter_id",
        "boss_name", "zone_name", "zone_id", "difficulty", "difficulty_label", "raid_night_date", "is_kill", *PLAYER,
        "death_timestamp_ms", "fight_start_ms", "overkill", "killing_blow_name", "killing_blow_id")


def _in_team(df: DataFrame, team: DataFrame) -> DataFrame:
    """Rows of team members; with an empty team all rows stay."""
    names = team.filter("name <> ''").select(F.lower("name").alias("_team")).distinct().withColumn("_in", F.lit(True))
    size = names.agg(F.count(F.lit(1)).alias("n"))
    flagged = joins.lookup(df, names, [(F.lower("player_name"), "_team")], ["_in"])
    return flagged.filter(F.col("_in") | (size.scalar() == 0)).drop("_in")


SCOPE_SETS = (
    ("zone_name", "boss_name", "difficulty_label"), ("zone_name", "difficulty_label"), ("boss_name", "difficulty_label"),
    ("difficulty_label",), ("zone_name", "boss_name"), ("boss_name",), ("zone_name",), ())


def player_survivability_rankings(roster: DataFrame, deaths: DataFrame, team: DataFrame, **options) -> DataFrame:
    """Deaths per kill at eight scopes, ranked within each scope.

    Kills and deaths are summed to the finest grain, united, and rolled up once. Ranks come from
    ordered slices, because the widest scope holds every player.
    """
    dims = ["zone_name", "boss_name", "difficulty_label"]
    grain = ["player_identity_key", *dims, "encounter_id", "difficulty"]

    def counted(df: DataFrame, name: str) -> DataFrame:
        kept = df.filter("player_name <> ''").filter(~F.col("zone_name").isin(*rules.EXCLUDED_ZONES))
        return _in_team(kept, team).groupBy(*grain).agg(
            F.max("player_name").alias("player_name"), F.max("player_class").alias("player_class"), F.count(F.lit(1)).alias(name))

    kills = counted(roster, "kills")
    merged = rows.union_branches([kills, counted(deaths, "deaths")])
    killed = F.col("kills") > 0
    measures = {
        "player_name": F.max(F.when(killed, F.col("player_name"))), "player_class": F.max(F.when(killed, F.col("player_class"))),
        "kills": F.sum("kills"), "deaths": F.coalesce(F.sum("deaths"), F.lit(0).cast("bigint")),
        # The ids of a scope are those of its kills, when there is only one.
        "_boss_id": F.when(F.min(F.when(killed, F.col("encounter_id"))) == F.max(F.when(killed, F.col("encounter_id"))),
                           F.max(F.when(killed, F.col("encounter_id")))),
        "_level_id": F.when(F.min(F.when(killed, F.col("difficulty"))) == F.max(F.when(killed, F.col("difficulty"))),
                            F.max(F.when(killed, F.col("difficulty"))))}
    scoped = scopes.scope_rollup(merged, ["player_identity_key"], dims, SCOPE_SETS, measures, labels=dims).filter("kills > 0")
    scoped = scoped.withColumn("_rate", v.ratio("deaths", "kills"))
    ranked = ordered.ranked(scoped, dims, [F.col("_rate").asc(), F.col("deaths").asc(), F.col("player_identity_key").asc()],
                            "survivability_rank", "survivability_rank_total", **options)
    return ranked.select(
        "player_identity_key", "player_name", "player_class", "zone_name",
        F.when(F.col("boss_name") != scopes.ALL, F.col("_boss_id")).alias("encounter_id"), "boss_name",
        F.when(F.col("difficulty_label") != scopes.ALL, F.col("_level_id")).alias("difficulty"), "difficulty_label", "deaths", "kills",
        v.tidy("_rate", 4).alias("deaths_per_kill"), "survivability_rank", "survivability_rank_total",
        v.rank_percentile("survivability_rank", "survivability_rank_total").alias("survivability_rank_percentile"))
