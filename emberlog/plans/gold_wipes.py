"""Gold products about wipes: utility use, survival, cooldown use and discipline scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import names as nm
from emberlog.functions import values as v
from emberlog.operators import joins, scopes
from emberlog.plans.gold_player import PLAYER
from emberlog.plans.identity import with_identity
from emberlog.session import stored

PULL = ["report_code", "fight_id"]


def _wipe() -> Column:
    return ~F.coalesce(F.col("is_kill"), F.lit(False))


def utility_type(ability_id: Column, ability_name: Column) -> Column:
    """healthstone, health_potion or defensive, by id or by name; null for anything else."""
    name = F.lower(F.coalesce(ability_name, F.lit("")))
    potion = name.contains("healing potion") | name.contains("health potion") | name.contains("healing injector")
    return (F.when(ability_id.isin(*rules.HEALTHSTONE_IDS) | name.contains("healthstone"), "healthstone")
            .when(ability_id.isin(*rules.HEALTH_POTION_IDS) | potion, "health_potion")
            .when(ability_id.isin(*rules.DEFENSIVE_IDS) | name.isin(*rules.DEFENSIVE_NAMES), "defensive"))


def latest_cast_payloads(raw: DataFrame) -> DataFrame:
    """All records of the newest cast landing of each report; a landing may hold several."""
    newest = raw.groupBy("report_code").agg(F.max("_ingested_at").alias("_newest")).withColumnRenamed("report_code", "_report")
    fresh = raw.join(newest, raw["report_code"].eqNullSafe(newest["_report"]) & raw["_ingested_at"].eqNullSafe(newest["_newest"]), "left_semi")
    return fresh


def player_utility_by_pull(fights: DataFrame, actors: DataFrame, casts: DataFrame) -> DataFrame:
    """Healthstones, potions and defensives per player and pull; players without any keep zeros.

    ``casts`` are parsed cast events. Only pulls that have cast events appear.
    """
    who = actors.filter("player_name <> ''").select(
        "report_code", "actor_id", "player_name", "player_class", F.coalesce("realm", F.lit("unknown")).alias("realm"),
        nm.identity_key("player_name", "player_class", "realm").alias("player_identity_key"))
    known = casts.filter("ability_id IS NOT NULL AND event_fight_id IS NOT NULL").withColumnRenamed("event_fight_id", "fight_id")
    pulls = joins.restrict_to(
        fights.select(*PULL, "encounter_id", "boss_name", "zone_name", "difficulty", "difficulty_label", "raid_night_date", "is_kill",
                      F.explode("friendly_player_ids").alias("actor_id")), known, PULL).join(who, ["report_code", "actor_id"])
    names = F.create_map(*[F.lit(x) for pair in rules.ABILITY_NAMES.items() for x in pair])
    label = F.coalesce(F.try_element_at(names, F.col("ability_id").cast("int")), F.col("ability_id").cast("string"))
    used = (known.select(*PULL, "actor_id", label.alias("_name"), utility_type(F.col("ability_id"), label).alias("_type"))
            .filter("_type IS NOT NULL").join(who, ["report_code", "actor_id"]))
    counts = used.groupBy(*PULL, "player_identity_key").agg(
        *[F.count_if(F.col("_type") == t).alias(n) for t, n in (("health_potion", "health_potion_uses"), ("healthstone", "healthstone_casts"),
                                                                ("defensive", "defensive_casts"))],
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("_type") == "defensive", F.col("_name")))), ", ").alias("defensive_abilities"))
    joined = pulls.join(counts, [*PULL, "player_identity_key"], "left")
    return joined.fillna(0, ["health_potion_uses", "healthstone_casts", "defensive_casts"]).fillna("", ["defensive_abilities"]).select(
        *PULL, "encounter_id", "boss_name", "zone_name", "difficulty", "difficulty_label", "raid_night_date", "is_kill", *PLAYER,
        "health_potion_uses", "healthstone_casts", "defensive_casts", "defensive_abilities")


def wipe_survival_events(death_events: DataFrame, capacity: DataFrame, casts: DataFrame, actors: DataFrame,
                         mode: str = "latest_cast") -> DataFrame:
    """Wipe deaths with the state of the player's tracked defensives and recovery items.

    Availability looks at the latest cast before the death and at tracked abilities only.
    ``mode="any_cast"`` keeps the literal older rule, where one old cast is enough and a death
    with no tracked ability counts as available.
    """
    deaths = joins.restrict_to(death_events.filter(_wipe()), casts.filter("fight_id IS NOT NULL"), PULL)
    tracked = with_identity(capacity.filter(F.col("has_tracked_capacity") & F.col("cooldown_category").isin(*rules.PERSONAL)), actors)
    tracked = tracked.select(*PULL, "player_identity_key", "spec_id", "ability_id", "ability_name", "cooldown_seconds", "active_seconds")
    moment = [*PULL, "player_identity_key", "player_name", "death_timestamp_ms"]
    pairs = stored(deaths.select(*moment).distinct().join(tracked, [*PULL, "player_identity_key"]))

    marks = casts.select("report_code", "fight_id", "player_name", "ability_id", "cast_timestamp_ms")
    # one pass finds the last cast on the pull and in the whole report; casts of reports without a wipe death take no part
    state = joins.asof_last(pairs, joins.restrict_to(marks, pairs, ["report_code"]), ["report_code", "player_name", "ability_id"],
                            "death_timestamp_ms", "cast_timestamp_ms", "_any", ["fight_id"], "_on_pull")
    at = F.col("death_timestamp_ms")
    ready_after = F.col("_any") + F.col("cooldown_seconds") * 1000
    if mode == "any_cast":
        first = marks.groupBy("report_code", "player_name", "ability_id").agg(F.min("cast_timestamp_ms").alias("_first"))
        state = state.join(first, ["report_code", "player_name", "ability_id"], "left")
        ready_after = F.col("_first") + F.col("cooldown_seconds") * 1000
    active = F.coalesce(at <= F.col("_on_pull") + F.col("active_seconds") * 1000, F.lit(False))
    available = F.col("_any").isNull() | (at >= ready_after)
    summary = state.groupBy(*moment).agg(
        F.max("spec_id").alias("spec_id"), F.max(active.cast("int")).alias("defensive_active_at_death"),
        F.max(available.cast("int")).alias("defensive_available_at_death"), F.max("_any").alias("last_defensive_cast_before_death_ms"),
        F.array_join(F.array_sort(F.collect_set(F.when(active, F.col("ability_name")))), ", ").alias("active_defensives"),
        F.array_join(F.array_sort(F.collect_set(F.when(available, F.col("ability_name")))), ", ").alias("available_defensives"))

    def first_use(ids: tuple[int, ...]) -> Column:
        return F.min(F.when(F.col("ability_id").isin(*ids), F.col("cast_timestamp_ms")))

    recovery = marks.filter("fight_id IS NOT NULL").groupBy(*PULL, "player_name").agg(
        first_use(rules.HEALTHSTONE_IDS).alias("_stone"), first_use(rules.HEALTH_POTION_IDS).alias("_potion"))
    joined = deaths.join(summary, moment, "left").join(recovery, [*PULL, "player_name"], "left")
    no_tracked = F.lit(1 if mode == "any_cast" else 0)
    ready = F.coalesce("defensive_available_at_death", no_tracked)
    up = F.coalesce("defensive_active_at_death", F.lit(0))
    return joined.select(
        *PULL, "encounter_id", "boss_name", "zone_name", "zone_id", "difficulty", "difficulty_label", "raid_night_date", *PLAYER, "spec_id",
        "death_timestamp_ms", "fight_start_ms", "killing_blow_name", "killing_blow_id", up.alias("defensive_active_at_death"),
        ready.alias("defensive_available_at_death"), ((up == 0) & (ready == 1)).cast("int").alias("available_defensive_unused_at_death"),
        "last_defensive_cast_before_death_ms", F.coalesce("active_defensives", F.lit("")).alias("active_defensives"),
        F.coalesce("available_defensives", F.lit("")).alias("available_defensives"),
        F.coalesce((F.col("_stone") <= at).cast("int"), F.lit(0)).alias("healthstone_before_death"),
        F.coalesce((F.col("_potion") <= at).cast("int"), F.lit(0)).alias("health_potion_before_death"))


def wipe_cooldown_utilization(capacity: DataFrame, actors: DataFrame) -> DataFrame:
    """Use of scored cooldowns on wipes; ``is_kill`` is therefore false in every row."""
    scored = capacity.filter("has_scored_capacity").filter(_wipe()).filter("duration_seconds > 0")
    efficiency = F.when(F.col("possible_casts") > 0, v.pct("actual_casts", "possible_casts")).otherwise(0.0)
    return with_identity(scored, actors).select(
        *PULL, "encounter_id", "boss_name", "zone_name", "difficulty", "difficulty_label", "raid_night_date", F.lit(False).alias("is_kill"), "duration_seconds", *PLAYER,
        "spec_id", "cooldown_category", "ability_id", "ability_name", "cooldown_seconds", "active_seconds", "capacity_model", "max_charges",
        "possible_casts", "observed_casts", "over_capacity_casts", "actual_casts",
        (F.col("possible_casts") - F.col("actual_casts")).alias("missed_casts"), efficiency.alias("cast_efficiency_pct"))


DIMS = ["zone_name", "encounter_id", "boss_name", "difficulty", "difficulty_label"]
LABELS = ["zone_name", "boss_name", "difficulty_label"]
DISCIPLINE_SETS = (
    tuple(DIMS), ("zone_name", "difficulty", "difficulty_label"), ("difficulty", "difficulty_label"),
    ("zone_name", "encounter_id", "boss_name"), ("zone_name",), ())
_ADDITIVE = ("wipe_pulls_tracked", "wipe_deaths", "first_deaths", "early_deaths", "healthstone_uses", "potion_uses",
             "no_healthstone_deaths", "no_health_potion_deaths", "pulls_with_tracked_defensive_capacity", "tracked_defensive_capacity",
             "defensive_casts", "defensive_missed_casts", "kills_tracked", "kill_deaths")


def discipline_counts(utility: DataFrame, survival: DataFrame, utilization: DataFrame, roster: DataFrame, deaths: DataFrame) -> DataFrame:
    """Additive counts of all five sources at player × boss × difficulty, before any roll-up.

    A pull belongs to one boss, so distinct pulls counted here add up at every wider scope; each
    source is aggregated once and no scope needs a distinct count.
    """
    grain = ["player_identity_key", *DIMS]
    who = [F.max(c).alias(c) for c in PLAYER[1:]]
    wipe_pulls = (utility.filter(_wipe()).groupBy(*grain, *PULL).agg(*who).groupBy(*grain)
                  .agg(*who, F.count(F.lit(1)).alias("wipe_pulls_tracked")))
    # The first death of a pull is one small aggregate per pull, not a window over all deaths.
    opening = survival.groupBy(*PULL).agg(F.min(F.struct("death_timestamp_ms", "player_name")).alias("_first"))
    marked = survival.join(opening, PULL)
    is_first = (F.col("death_timestamp_ms") == F.col("_first.death_timestamp_ms")) & (F.col("player_name") == F.col("_first.player_name"))
    # Equal first deaths (same player and time) count once.
    firsts = marked.filter(is_first).select(*grain, *PULL).distinct().groupBy(*grain).agg(F.count(F.lit(1)).alias("first_deaths"))
    stone, potion = F.col("healthstone_before_death") > 0, F.col("health_potion_before_death") > 0
    wipe_deaths = survival.groupBy(*grain).agg(
        *who, F.count(F.lit(1)).alias("wipe_deaths"),
        F.count_if(F.col("death_timestamp_ms") - F.col("fight_start_ms") <= rules.EARLY_DEATH_MS).alias("early_deaths"),
        F.count_if(stone).alias("healthstone_uses"), F.count_if(potion).alias("potion_uses"),
        F.count_if(~stone).alias("no_healthstone_deaths"), F.count_if(~potion).alias("no_health_potion_deaths"))
    per_pull = utilization.filter(F.col("cooldown_category").isin(*rules.PERSONAL)).groupBy(*grain, *PULL).agg(
        *who, *[F.sum(c).alias(c) for c in ("possible_casts", "actual_casts", "missed_casts")])
    capacity = per_pull.groupBy(*grain).agg(
        *who, F.count_if(F.col("possible_casts") > 0).alias("pulls_with_tracked_defensive_capacity"),
        F.sum("possible_casts").alias("tracked_defensive_capacity"), F.sum("actual_casts").alias("defensive_casts"),
        F.sum("missed_casts").alias("defensive_missed_casts"))
    kills = roster.groupBy(*grain, *PULL).agg(*who).groupBy(*grain).agg(*who, F.count(F.lit(1)).alias("kills_tracked"))
    kill_deaths = deaths.filter("is_kill").groupBy(*grain).agg(*who, F.count(F.lit(1)).alias("kill_deaths"))
    sums = {c: F.sum(c) for c in _ADDITIVE} | {c: F.max(c) for c in PLAYER[1:]}
    return scopes.combine_sources([wipe_pulls, wipe_deaths, firsts, capacity, kills, kill_deaths], grain, sums)


def wipe_survival_discipline(utility: DataFrame, survival: DataFrame, utilization: DataFrame, roster: DataFrame, deaths: DataFrame) -> DataFrame:
    """Discipline scores per player at six scopes."""
    key = ["player_identity_key"]
    counts = discipline_counts(utility, survival, utilization, roster, deaths)
    zero = F.lit(0).cast("bigint")
    blows = survival.filter("killing_blow_name <> ''").groupBy(*key, *DIMS, "killing_blow_name").agg(F.count(F.lit(1)).alias("_n"))
    # Counts and killing blows go through one expansion of the scopes; rows of counts have no blow.
    tagged = counts.unionByName(blows, allowMissingColumns=True)
    sums = {c: F.sum(c) for c in (*_ADDITIVE, "_n")} | {c: F.max(c) for c in PLAYER[1:]}
    expanded = scopes.scope_rollup(tagged, key, [*DIMS, "killing_blow_name"], [(*s, "killing_blow_name") for s in DISCIPLINE_SETS], sums, labels=LABELS)
    often = F.min(F.when(F.col("killing_blow_name").isNotNull(), F.struct((-F.col("_n")).alias("less"), "killing_blow_name")))
    scoped = expanded.groupBy(*key, *DIMS).agg(
        *[F.coalesce(F.max(c), zero).alias(c) for c in _ADDITIVE], *[F.max(c).alias(c) for c in PLAYER[1:]], often.alias("_often"))
    roles = roster.groupBy(*key).agg(F.max_by("role", F.struct("raid_night_date", *PULL)).alias("role"))
    base = scoped.filter("player_name <> ''").join(roles, key, "left").select(
        "*", F.col("_often.killing_blow_name").alias("most_common_killing_blow"), (-F.col("_often.less")).alias("most_common_killing_blow_count"))

    c = F.col
    none = F.lit(None).cast("double")
    has_capacity = c("tracked_defensive_capacity") > 0
    died = c("wipe_deaths") > 0
    status = (F.when(has_capacity & (c("defensive_casts") > 0), "tracked_used").when(has_capacity, "tracked_zero_usage")
              .when(c("wipe_pulls_tracked") > 0, "no_tracked_capacity").otherwise("unknown"))
    base = base.select(
        "*", F.when(c("wipe_pulls_tracked") > 0, v.ratio("wipe_deaths", "wipe_pulls_tracked")).otherwise(0.0).alias("_per_wipe"),
        F.when(c("kills_tracked") > 0, v.ratio("kill_deaths", "kills_tracked")).alias("_per_kill"),
        F.when(has_capacity, v.pct("defensive_casts", "tracked_defensive_capacity")).otherwise(none).alias("defensive_usage_rate"),
        F.when(died, v.pct("healthstone_uses", "wipe_deaths")).alias("healthstone_usage_rate"),
        F.when(died, v.pct("potion_uses", "wipe_deaths")).alias("potion_usage_rate"),
        F.when(died, v.pct("no_healthstone_deaths", "wipe_deaths")).otherwise(0.0).alias("no_healthstone_pct"),
        F.when(died, v.pct("no_health_potion_deaths", "wipe_deaths")).otherwise(0.0).alias("no_health_potion_pct"),
        (c("defensive_missed_casts") * 0.5 + c("no_healthstone_deaths") * 0.3 + c("no_health_potion_deaths") * 0.2).cast("double")
        .alias("_points"), status.alias("defensive_tracking_status"))
    # Read twice, by the medians and by the scores, so all that leads up to it is worked out once.
    base = stored(base)
    # Class medians: a mergeable sketch per scope and class, exact for groups below its accuracy.
    peers = [*DIMS, "player_class"]
    medians = base.filter("defensive_usage_rate IS NOT NULL").groupBy(*peers).agg(
        F.percentile_approx("defensive_usage_rate", 0.5).alias("_median"))
    medians = medians.select(*[c(p).alias(f"_m_{p}") for p in peers], "_median")
    base = base.join(medians, [c(p).eqNullSafe(c(f"_m_{p}")) for p in peers], "left")

    gap = c("defensive_usage_rate") - c("_median")
    usage = v.clamp(c("defensive_usage_rate") * 0.7 + v.clamp(F.lit(50) + gap * 1.5) * 0.3)
    tracked = c("defensive_tracking_status").isin("tracked_used", "tracked_zero_usage")
    parts = base.select(
        "*", v.clamp(F.lit(100) - c("_per_wipe") * 250).alias("_pressure"), F.when(tracked, usage).otherwise(50.0).alias("_defensive"),
        F.when(died, v.clamp(F.lit(100) - c("no_healthstone_pct"))).otherwise(100.0).alias("_stone"),
        F.when(died, v.clamp(F.lit(100) - c("no_health_potion_pct"))).otherwise(100.0).alias("_potion"))
    total = v.clamp(c("_defensive") * 0.3 + c("_stone") * 0.3 + c("_potion") * 0.3 + c("_pressure") * 0.1)
    weakest = (F.when(F.least("_defensive", "_stone", "_potion", "_pressure") >= 95, rules.EMPTY_MARK)
               .when(c("_defensive") <= F.least("_stone", "_potion", "_pressure"), "Defensive usage")
               .when(c("_pressure") <= F.least("_stone", "_potion"), "Wipe survival")
               .when(c("_stone") <= c("_potion"), "Healthstone").otherwise("Health potion"))
    scored = parts.filter("wipe_pulls_tracked > 0 OR wipe_deaths > 0")
    return scored.select(
        "player_identity_key", "player_name", F.coalesce("player_class", F.lit("Unknown")).alias("player_class"),
        F.coalesce("realm", F.lit("unknown")).alias("realm"), "role", *DIMS, "wipe_pulls_tracked", "wipe_deaths", "first_deaths",
        "early_deaths", "kill_deaths", "kills_tracked", v.tidy("_per_kill", 4).alias("deaths_per_kill"),
        v.tidy("_per_wipe", 4).alias("deaths_per_wipe"), "pulls_with_tracked_defensive_capacity", "tracked_defensive_capacity",
        "defensive_casts", "defensive_missed_casts", "healthstone_uses", "potion_uses", "no_healthstone_deaths", "no_health_potion_deaths",
        "defensive_usage_rate", "healthstone_usage_rate", "potion_usage_rate", "no_healthstone_pct", "no_health_potion_pct",
        *[v.tidy(f"_{s}", 1).alias(f"{n}_score") for s, n in (("pressure", "death_pressure"), ("defensive", "defensive_component"),
                                                             ("stone", "healthstone_component"), ("potion", "potion_component"))],
        v.tidy("_median", 1).alias("defensive_class_baseline_pct"), v.tidy(gap, 1).alias("defensive_class_delta_pct"),
        v.tidy("_points", 1).alias("weighted_failure_points"), v.tidy(total, 1).alias("survival_failure_score"),
        v.tidy(total, 1).alias("survival_discipline_score"), weakest.alias("top_improvement_area"), weakest.alias("top_missing_category"),
        "defensive_tracking_status", tracked.alias("has_defensive_capacity_tracked"),
        F.coalesce("most_common_killing_blow", F.lit("")).alias("most_common_killing_blow"),
        F.coalesce("most_common_killing_blow_count", zero).alias("most_common_killing_blow_count"))
