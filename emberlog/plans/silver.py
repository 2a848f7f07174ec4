"""Silver tables: typed, flattened and deduplicated rows from the landing tables.

Each function takes frames and returns a frame. Those for reports, fights, attendance and actors
also take streams: they are stateless but for the deduplication.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import names as nm
from emberlog.functions import values as v
from emberlog.operators import joins, rows
from emberlog.quality.expectations import hold
from emberlog.sources import payloads
from emberlog.sources.sheet import parse_sheet


def once(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("_ingested_at",)) -> DataFrame:
    """One row per key, the newest. A stream cannot take back what it has written, so it drops only
    versions that it has seen lately and keeps all others; the newest is taken on read (``tables.read_silver``)."""
    return rows.drop_repeats(df, keys, order) if df.isStreaming else rows.dedup_ordered(df, keys, order)


def report_context(reports: DataFrame) -> DataFrame:
    return reports.select(F.col("code").alias("report_code"), "zone_id", "zone_name", "start_time_utc",
                          F.to_date("start_time_utc").alias("raid_night_date"))


# --- reports, fights, attendance, actors ---------------------------------------------------

def guild_reports(raw: DataFrame) -> DataFrame:
    flat = raw.select("code", "title", v.epoch_ms("startTime").alias("start_time_utc"),
                      v.epoch_ms("endTime").alias("end_time_utc"), F.col("zone.id").alias("zone_id"),
                      F.col("zone.name").alias("zone_name"), "_ingested_at", "_source")
    return hold(once(hold(flat, "silver_guild_reports", "drop"), ["code"]), "silver_guild_reports", "warn")


def exploded_fights(raw: DataFrame) -> DataFrame:
    """Boss pulls of raid difficulty, one row each, not yet joined to their report."""
    fight = raw.select(F.col("code").alias("report_code"), F.col("title").alias("report_title"),
                       F.explode("fights").alias("f"), "_ingested_at")
    seconds = F.floor((F.col("f.endTime") - F.col("f.startTime")) / 1000).cast("int")
    flat = fight.select(
        "report_code", "report_title", F.col("f.id").alias("fight_id"), F.col("f.name").alias("boss_name"),
        F.col("f.encounterID").alias("encounter_id"), F.col("f.kill").alias("is_kill"), F.col("f.difficulty").alias("difficulty"),
        F.col("f.startTime").alias("fight_start_ms"), seconds.alias("duration_seconds"),
        F.col("f.bossPercentage").alias("boss_percentage"), F.col("f.lastPhase").alias("last_phase"),
        F.col("f.size").alias("fight_size"), F.col("f.friendlyPlayers").alias("friendly_player_ids"), "_ingested_at")
    kept = hold(flat, "silver_fight_events", "drop")
    return kept.select("*", v.label("difficulty", rules.DIFFICULTIES, "Unknown").alias("difficulty_label"),
                       v.outcome("is_kill").alias("outcome"))


def fight_events(raw: DataFrame, reports: DataFrame) -> DataFrame:
    """Pulls with report context. A report landed twice keeps one row per (report, fight)."""
    fights = hold(once(exploded_fights(raw), ["report_code", "fight_id"]), "silver_fight_events", "warn")
    return fights.join(report_context(reports), "report_code", "left")


def attendance_rows(raw: DataFrame) -> DataFrame:
    """One row per player of a report, not yet joined to the report."""
    flat = raw.select(F.col("code").alias("report_code"), F.explode("players").alias("p"), "_ingested_at").select(
        "report_code", F.trim("p.name").alias("player_name"), F.col("p.presence").cast("int").alias("presence"),
        F.trim("p.type").alias("player_class"), "_ingested_at")
    flat = flat.withColumn("presence_status", v.label("presence", rules.PRESENCE, "absent"))
    kept = hold(flat, "silver_raid_attendance", "drop")
    return hold(once(kept, ["report_code", "player_name"]), "silver_raid_attendance", "warn")


def attendance_context(reports: DataFrame) -> DataFrame:
    return report_context(reports).withColumnRenamed("start_time_utc", "report_start_utc")


def raid_attendance(raw: DataFrame, reports: DataFrame) -> DataFrame:
    return attendance_rows(raw).join(attendance_context(reports), "report_code", "left")


def actor_roster(raw: DataFrame) -> DataFrame:
    flat = raw.select("report_code", F.explode("actors").alias("a"), "_ingested_at").select(
        "report_code", F.col("a.id").alias("actor_id"), F.trim("a.name").alias("player_name"),
        F.trim("a.subType").alias("player_class"), F.col("a.server").alias("realm"), "_ingested_at")
    kept = hold(flat, "silver_actor_roster", "drop")
    return hold(once(kept, ["report_code", "actor_id"]), "silver_actor_roster", "warn")


# --- per-fight player payloads -------------------------------------------------------------

def player_performance(raw: DataFrame) -> DataFrame:
    def of_all_roles(payload: Column) -> Column:
        return v.tagged_items({role: payload["data"]["playerDetails"][group] for group, role in (("dps", "dps"), ("healers", "healer"), ("tanks", "tank"))}, "role", "p")

    players = payloads.exploded(raw, "player_details_json", "player_details", of_all_roles, "_player", "report_code", "fight_id", "boss_name", "encounter_id", "difficulty",
                                "zone_id", "zone_name", "duration_ms", "_ingested_at").select("*", "_player.*")
    weapons = nm.classify_names(nm.weapon_names(F.col("p.combatantInfo.gear"), rules.IMBUES), rules.WEAPON_NAMES, rules.WEAPON_KEYWORDS)
    stats = [F.col(f"p.combatantInfo.stats.{s}.min").alias(f"{s.lower()}_rating") for s in ("Crit", "Haste", "Mastery", "Versatility")]
    flat = players.withColumn("_weapons", weapons).select(
        "report_code", "fight_id", "boss_name", "encounter_id", "difficulty",
        v.label("difficulty", rules.DIFFICULTIES, "Unknown").alias("difficulty_label"), "zone_id", "zone_name", "duration_ms",
        "role", F.col("p.id").alias("actor_id"), F.trim("p.name").alias("player_name"), F.col("p.type").alias("player_class"),
        F.get("p.specs", F.lit(0))["spec"].alias("spec"),
        v.tidy((F.col("p.minItemLevel") + F.col("p.maxItemLevel")) / 2, 1).alias("avg_item_level"),
        F.col("p.potionUse").alias("potion_use"), F.col("p.healthstoneUse").alias("healthstone_use"),
        F.coalesce(F.size("_weapons") > 0, F.lit(False)).alias("has_weapon_enhancement"),
        nm.join_names("_weapons").alias("weapon_enhancement_names"), *stats, "_ingested_at")
    kept = hold(flat, "silver_player_performance", "drop")
    single = rows.dedup_ordered(kept, ["report_code", "fight_id", "player_name"], ["_ingested_at"], count_as="_duplicate_count")
    return hold(single, "silver_player_performance", "warn")


def newest_rankings(raw: DataFrame) -> DataFrame:
    """The newest landing of each report; of landings equal in time the greater payloads, first metric before second."""
    if "rankings_hps_json" not in raw.columns:
        raw = raw.withColumn("rankings_hps_json", F.lit(None).cast("string"))
    return rows.latest_by(raw, ["report_code"], ["_ingested_at", "rankings_json", "rankings_hps_json"])


def player_rankings(raw: DataFrame) -> DataFrame:
    """Newest payload per report; tanks and damage dealers from the first metric, healers from the second."""
    latest = newest_rankings(raw)

    def branch(text: str, groups: dict[str, str]) -> DataFrame:
        fights = payloads.exploded(latest, text, "rankings", lambda p: p["data"], "f", "report_code", "_ingested_at")
        characters = F.explode_outer(v.tagged_items({role: F.col(f"f.roles.{group}.characters") for group, role in groups.items()}, "role", "c"))
        return fights.select("report_code", F.col("f.fightID").alias("fight_id"), F.col("f.encounter.id").alias("encounter_id"),
                             F.col("f.encounter.name").alias("encounter_name"), F.col("f.difficulty").alias("difficulty"),
                             F.col("f.size").alias("fight_size"), "_ingested_at", characters.alias("_character")).filter("_character IS NOT NULL").select("*", "_character.*")

    players = rows.union_branches([branch("rankings_json", {"tanks": "tank", "dps": "dps"}), branch("rankings_hps_json", {"healers": "healer"})])
    flat = players.select(
        "report_code", "fight_id", "encounter_id", "encounter_name", "difficulty", "fight_size", "role",
        F.col("c.name").alias("player_name"), F.col("c.class").alias("player_class"), F.col("c.spec").alias("spec"),
        F.col("c.amount").alias("amount"), F.col("c.rankPercent").alias("rank_percent"),
        F.col("c.bracketPercent").alias("bracket_percent"), F.col("c.rank").alias("rank_string"),
        F.col("c.totalParses").alias("total_parses"), "_ingested_at")
    kept = hold(flat, "silver_player_rankings", "drop")
    single = rows.dedup_ordered(kept, ["report_code", "fight_id", "player_name"], ["rank_percent", "amount"], count_as="_duplicate_count")
    return hold(single, "silver_player_rankings", "warn")


def player_deaths(raw: DataFrame) -> DataFrame:
    """Deaths with their killing blow. A report with single-fight records drops its older multi-fight ones."""
    current = rows.prefer_flagged(raw, ["report_code"], F.coalesce(F.size("fight_ids") == 1, F.lit(False)))
    entries = payloads.exploded(current, "table_json", "deaths", lambda p: p["data"]["entries"], "e", "report_code", "_ingested_at")
    flat = entries.select(
        "report_code", F.col("e.fight").alias("fight_id"), F.col("e.name").alias("player_name"),
        F.col("e.type").alias("player_class"), F.col("e.timestamp").alias("death_timestamp_ms"),
        F.col("e.overkill").alias("overkill"), "_ingested_at", v.killing_blow("e.events")["ability"].alias("_blow"))
    named = flat.select("*", F.col("_blow.name").alias("killing_blow_name"), F.col("_blow.guid").alias("killing_blow_id"))
    counted = rows.with_duplicate_count(hold(named.drop("_blow"), "silver_player_deaths", "drop"),
                                        ["report_code", "fight_id", "player_name", "death_timestamp_ms"])
    return hold(counted, "silver_player_deaths", "warn")


def fight_windows(fights: DataFrame) -> DataFrame:
    return fights.select("report_code", "fight_id", F.col("fight_start_ms").alias("start_ms"),
                         (F.col("fight_start_ms") + F.col("duration_seconds") * 1000).alias("end_ms"))


def parsed_casts(raw: DataFrame) -> DataFrame:
    """Cast events of the payloads; written once, it serves every product that reads casts."""
    event = payloads.exploded(raw, "events_json", "casts", lambda p: p["data"], "e", "report_code", "_ingested_at")
    return event.select(
        "report_code", F.col("e.fight").alias("event_fight_id"), F.col("e.timestamp").alias("cast_timestamp_ms"),
        F.col("e.sourceID").alias("actor_id"), F.col("e.targetID").alias("target_actor_id"),
        F.col("e.ability.name").alias("ability_name"),
        F.coalesce("e.ability.guid", "e.abilityGameID").alias("ability_id"),
        F.col("e.ability.abilityIcon").alias("ability_icon"), "_ingested_at",
    ).filter("actor_id IS NOT NULL AND (ability_name IS NOT NULL OR ability_id IS NOT NULL)")


def parsed_buffs(raw: DataFrame) -> DataFrame:
    event = payloads.exploded(raw, "buffs_json", "casts", lambda p: p["data"], "e", "report_code")
    return event.select(
        "report_code", F.col("e.fight").alias("fight_id"), F.col("e.timestamp").alias("timestamp_ms"),
        F.coalesce("e.targetID", "e.sourceID").alias("actor_id"), F.col("e.ability.name").alias("ability_name"),
        F.coalesce("e.ability.guid", "e.abilityGameID").alias("ability_id"))


def parsed_combatants(raw: DataFrame) -> DataFrame:
    event = payloads.exploded(raw, "combatant_info_json", "combatants", lambda p: p["data"], "e", "report_code", "_ingested_at")
    ids = F.transform("e.talentTree", lambda t: F.coalesce(t["spellID"], t["id"], t["talentID"]).cast("string"))
    flat = event.select(
        "report_code", F.col("e.fight").alias("event_fight_id"), F.col("e.timestamp").alias("combatant_timestamp_ms"),
        F.coalesce("e.sourceID", "e.source.id").alias("actor_id"), F.col("e.specID").alias("spec_id"),
        F.transform("e.auras", lambda a: F.trim(a["name"])).alias("aura_names"),
        F.filter(ids, lambda i: i.isNotNull()).alias("talent_spell_ids"), "_ingested_at")
    return rows.dedup_ordered(flat.filter("actor_id IS NOT NULL"),
                              ["report_code", "event_fight_id", "combatant_timestamp_ms", "actor_id"], ["_ingested_at"])


def _named_in_fight(events: DataFrame, fights: DataFrame, actors: DataFrame, at: str) -> DataFrame:
    placed = joins.resolve_interval_id(events, fight_windows(fights), ["report_code"], "event_fight_id", "fight_id",
                                       at, "start_ms", "end_ms")
    return placed.join(actors.select("report_code", "actor_id", "player_name", "player_class"), ["report_code", "actor_id"])


def player_cast_events(casts: DataFrame, fights: DataFrame, actors: DataFrame) -> DataFrame:
    named = _named_in_fight(casts, fights, actors, "cast_timestamp_ms")
    single = rows.dedup_ordered(named, ["report_code", "fight_id", "cast_timestamp_ms", "actor_id", "ability_id"], ["_ingested_at"])
    return hold(single, "silver_player_cast_events", "warn")


def player_combatant_buffs(combatants: DataFrame, fights: DataFrame, actors: DataFrame) -> DataFrame:
    """Preparation signals per player and pull.

    Names are classified before they are collected, so a group holds each matching name once, and
    copies collapse on the map side.
    """
    named = _named_in_fight(combatants, fights, actors, "combatant_timestamp_ms")
    kinds = {"food_buff": (rules.FOOD_NAMES, rules.FOOD_KEYWORDS), "flask_or_phial": (rules.FLASK_NAMES, rules.FLASK_KEYWORDS),
             "weapon": (rules.WEAPON_NAMES, rules.WEAPON_KEYWORDS)}

    def tagged(kind: str, names: Column) -> Column:
        known = F.coalesce(names, F.array().cast("array<string>"))
        return F.transform(known, lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("name")))

    found = F.concat(tagged("talent", F.col("talent_spell_ids")), *[tagged(k, nm.classify_names("aura_names", *lists)) for k, lists in kinds.items()])
    keys = ["report_code", "fight_id", "player_name", "player_class"]
    each = named.select(*keys, "spec_id", "_ingested_at", F.explode_outer(found).alias("_item"))
    grouped = each.groupBy(*keys).agg(F.max("spec_id").alias("spec_id"), F.max("_ingested_at").alias("_ingested_at"), F.collect_set("_item").alias("_items"))

    def of(kind: str) -> Column:
        own = F.filter("_items", lambda i: i["kind"] == kind)
        return F.array_sort(F.transform(own, lambda i: i["name"]))

    split = grouped.select(*keys, "spec_id", "_ingested_at", of("talent").alias("talent_spell_ids"), *[of(k).alias(f"_{k}") for k in kinds])
    prepared = split.select(
        *keys, "spec_id", "talent_spell_ids",
        (F.size("_food_buff") > 0).alias("has_food_buff"), nm.join_names("_food_buff").alias("food_buff_names"),
        (F.size("_flask_or_phial") > 0).alias("has_flask_or_phial_buff"),
        nm.join_names("_flask_or_phial").alias("flask_or_phial_names"),
        (F.size("_weapon") > 0).alias("has_weapon_enhancement_aura"),
        nm.join_names("_weapon").alias("weapon_enhancement_aura_names"), "_ingested_at")
    return hold(prepared, "silver_player_combatant_buffs", "warn")


def cooldown_rules(spark) -> DataFrame:
    """The fixed rule table; a few dozen rows, so broadcasting it is safe at any scale."""
    fields = ("cooldown_category STRING, player_class STRING, ability_id BIGINT, ability_name STRING, cooldown_seconds BIGINT, "
              "active_seconds BIGINT, allowed_spec_ids STRING, required_talent_spell_ids STRING, capacity_model STRING, "
              "max_charges BIGINT, capacity_score_eligible INT")
    return spark.createDataFrame([tuple(r) for r in rules.COOLDOWN_RULES], fields)


def _id_in(ids: Column, wanted: Column) -> Column:
    """Whether a ``1|2|3`` list holds an id."""
    return F.array_contains(F.split(ids, r"\|"), wanted)


def player_cooldown_capacity(fights: DataFrame, actors: DataFrame, casts: DataFrame, buffs: DataFrame) -> DataFrame:
    """Player-pull × rule of the player's class: tracking state, possible and observed casts.

    Everything is joined per player and pull, before rules multiply the rows: nothing is shuffled after that. A
    player's casts stand in one row of counts by ability, as long as the rule table at most.
    """
    spark = fights.sparkSession
    ruled_ids = sorted({r.ability_id for r in rules.COOLDOWN_RULES})
    # Casts are summed per pull first; the report level is a set of those sums' abilities.
    per_pull = casts.filter(F.col("ability_id").isin(ruled_ids)).groupBy("report_code", "fight_id", "player_name", "ability_id").agg(
        F.count(F.lit(1)).alias("_casts"), F.max("cast_timestamp_ms").alias("last_cast_on_pull_ms"))
    entry = F.struct(F.col("ability_id"), F.struct("_casts", "last_cast_on_pull_ms"))
    on_pull = per_pull.filter("fight_id IS NOT NULL").groupBy("report_code", "fight_id", "player_name").agg(F.map_from_entries(F.collect_list(entry)).alias("_on_pull"))
    in_report = per_pull.groupBy("report_code", "player_name").agg(F.collect_set("ability_id").alias("_in_report"))
    known = actors.select("report_code", "actor_id", "player_name", "player_class").join(in_report, ["report_code", "player_name"], "left")
    pulls = joins.restrict_to(fights, casts.filter("fight_id IS NOT NULL"), ["report_code", "fight_id"]).select(
        "report_code", "fight_id", "encounter_id", "boss_name", "zone_name", "zone_id", "difficulty", "difficulty_label", "raid_night_date",
        "duration_seconds", "is_kill", "_ingested_at", F.explode("friendly_player_ids").alias("actor_id"))
    players = pulls.join(known, ["report_code", "actor_id"]).drop("actor_id")
    info_of = buffs.select("report_code", "fight_id", "player_name", "spec_id", "talent_spell_ids", F.lit(True).alias("has_combatant_info"))
    keys = ["report_code", "fight_id", "player_name"]
    state = players.join(info_of, keys, "left").join(on_pull, keys, "left")
    ruled = state.join(F.broadcast(cooldown_rules(spark)), "player_class")
    cast = F.col("_on_pull")[F.col("ability_id")]
    joined = ruled.select("report_code", "fight_id", "player_name", "ability_id", *[c for c in ruled.columns if c not in (
        *keys, "ability_id", "_in_report", "_on_pull")], F.array_contains("_in_report", F.col("ability_id")).alias("_seen"),
        cast["_casts"].alias("_casts"), cast["last_cast_on_pull_ms"].alias("last_cast_on_pull_ms"))

    info = F.coalesce("has_combatant_info", F.lit(False))
    seen = F.coalesce("_seen", F.lit(False))
    any_spec = F.col("allowed_spec_ids") == ""
    no_talent = F.col("required_talent_spell_ids") == ""
    spec_ok = any_spec | _id_in(F.col("allowed_spec_ids"), F.col("spec_id").cast("string"))
    has_talent = F.arrays_overlap(F.split("required_talent_spell_ids", r"\|"), F.col("talent_spell_ids"))
    state_name = (F.when(~info | F.col("spec_id").isNull(), "unknown_missing_combatant_info")
                  .when(~spec_ok, "untracked_spec_ineligible")
                  .when(~(no_talent | F.coalesce(has_talent, F.lit(False)) | seen), "untracked_talent_missing")
                  .otherwise("tracked"))
    scored = F.col("capacity_score_eligible") == 1
    possible = F.when((F.coalesce("duration_seconds", F.lit(0)) > 0) & scored,
                      F.floor(F.col("duration_seconds") / F.col("cooldown_seconds")) + F.greatest("max_charges", F.lit(1)))
    full = joined.select(
        "*", info.alias("_info"), F.when(F.col("spec_id").isNotNull(), spec_ok).alias("spec_eligible"),
        F.when(no_talent, F.lit(True)).otherwise(has_talent).alias("talent_present"), seen.alias("cast_seen_in_report"),
        F.coalesce("_casts", F.lit(0).cast("bigint")).alias("observed_casts"),
        F.coalesce(possible.cast("bigint"), F.lit(0).cast("bigint")).alias("possible_casts"),
        state_name.alias("cooldown_tracking_state"))
    tracked = F.col("cooldown_tracking_state") == "tracked"
    capacity = full.select(
        *[c for c in full.columns if c not in ("has_combatant_info", "_seen", "_casts", "_info")],
        F.col("_info").alias("has_combatant_info"), tracked.alias("has_tracked_capacity"),
        (tracked & scored).alias("has_scored_capacity"), F.least("observed_casts", "possible_casts").alias("actual_casts"),
        F.greatest(F.col("observed_casts") - F.col("possible_casts"), F.lit(0)).alias("over_capacity_casts"))
    return hold(capacity, "silver_player_cooldown_capacity", "warn")


# --- catalog, members, profiles ------------------------------------------------------------

def zone_catalog(raw: DataFrame) -> DataFrame:
    flat = raw.select(F.col("id").alias("zone_id"), F.col("name").alias("zone_name"), F.col("frozen").alias("zone_frozen"),
                      F.explode("encounters").alias("e"), "difficulties", "_ingested_at").select(
        "zone_id", "zone_name", "zone_frozen", F.col("e.id").alias("encounter_id"), F.col("e.name").alias("encounter_name"),
        F.transform("difficulties", lambda d: d["name"]).alias("difficulty_names"), "_ingested_at")
    kept = hold(flat, "silver_zone_catalog", "drop")
    return once(kept, ["zone_id", "encounter_id"])


def guild_members(raw: DataFrame) -> DataFrame:
    latest = rows.latest_by(raw, ["name"], ["_ingested_at", "realm_slug"])
    kept = hold(latest, "silver_guild_members", "drop")
    labels = {code: pair[0] for code, pair in rules.RANKS.items()}
    groups = {code: pair[1] for code, pair in rules.RANKS.items()}
    return kept.select(
        "name", "realm_slug", "rank", v.label("rank", labels, F.concat(F.lit("Rank "), F.col("rank").cast("string"))).alias("rank_label"),
        v.label("rank", groups, "Social").alias("rank_category"), F.col("rank").isin(*rules.RAID_TEAM_RANKS).alias("is_raid_team"),
        "class_id", v.label("class_id", rules.CLASSES).alias("class_name"), "level", "_ingested_at")


def _snapshot(raw: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Newest payload per key with its time."""
    return rows.latest_by(raw, list(keys), ["_ingested_at", text]).withColumn("snapshot_at", F.to_timestamp("_ingested_at"))


def guild_zone_ranks(raw: DataFrame) -> DataFrame:
    latest = _snapshot(raw, ["zone_id"], "progress_json")
    return hold(latest, "silver_guild_zone_ranks", "drop").select("zone_id", "zone_name", "progress_json", "snapshot_at", "_ingested_at")


def character_media(raw: DataFrame) -> DataFrame:
    latest = _snapshot(hold(raw, "silver_character_media", "drop"), ["player_name", "realm_slug"], "media_json")
    parsed = latest.withColumn("m", F.from_json("media_json", payloads.payload_ddl("media")))
    urls = [v.keyed_value("m.assets", k).alias(f"{k.replace('-', '_')}_url") for k in ("avatar", "inset", "main", "main-raw")]
    return parsed.select("player_name", "realm_slug", *urls, "snapshot_at", "_ingested_at")


def item_media(raw: DataFrame) -> DataFrame:
    parsed = _snapshot(hold(raw, "silver_item_media", "drop"), ["item_id"], "media_json").withColumn("m", F.from_json("media_json", payloads.payload_ddl("media")))
    return parsed.select("item_id", v.keyed_value("m.assets", "icon").alias("icon_url"), "snapshot_at", "_ingested_at")


def character_equipment(raw: DataFrame) -> DataFrame:
    latest = _snapshot(hold(raw, "silver_character_equipment", "drop"), ["player_name", "realm_slug"], "equipment_json")
    parsed = latest.withColumn("q", F.from_json("equipment_json", payloads.payload_ddl("equipment")))
    return parsed.select("player_name", "realm_slug", "equipment_json",
                         v.array_mean("q.equipped_items", lambda i: i["level"]["value"]).alias("avg_item_level"),
                         F.size("q.equipped_items").alias("equipped_item_count"), "snapshot_at", "_ingested_at")


def character_achievements(raw: DataFrame) -> DataFrame:
    latest = _snapshot(hold(raw, "silver_character_achievements", "drop"), ["player_name", "realm_slug"], "achievements_json")
    parsed = latest.withColumn("a", F.from_json("achievements_json", payloads.payload_ddl("achievement_totals")))
    return parsed.select("player_name", "realm_slug", "achievements_json", "a.total_quantity", "a.total_points",
                         "snapshot_at", "_ingested_at")


def _profiles(raw: DataFrame) -> DataFrame:
    parsed = payloads.parse(raw, "profile_json", "profile", "p")
    return parsed.select(
        "player_name", "realm_slug", F.lower(F.coalesce("region", "p.region")).alias("region"),
        F.coalesce("profile_url", "p.profile_url").alias("profile_url"), F.lit("current").alias("season"), "p",
        F.to_timestamp("_ingested_at").alias("snapshot_at"), "_ingested_at")


def mplus_scores(raw: DataFrame) -> DataFrame:
    season = _profiles(raw).withColumn("s", F.explode_outer("p.mythic_plus_scores_by_season"))
    scores = [F.col(f"s.scores.`{r}`").alias(f"score_{r}") for r in ("all", "dps", "healer", "tank")]
    places = [F.col(f"p.mythic_plus_ranks.overall.{r}").alias(f"{r}_rank") for r in ("world", "region", "realm")]
    flat = season.select("player_name", "realm_slug", "region", "profile_url", "season", *scores, *places,
                         F.col("p.last_crawled_at").alias("raiderio_last_crawled_at"), "snapshot_at", "_ingested_at")
    return hold(flat, "silver_raiderio_player_scores", "drop")


RUN_KEY = ["player_name", "realm_slug", "region", "dungeon", "completed_at", "mythic_level"]


def mplus_runs(raw: DataFrame) -> DataFrame:
    """Runs of both lists; a run in both counts once, as 'best', in its newest snapshot."""
    profiles = _profiles(raw)
    runs = rows.union_branches([profiles.withColumn("r", F.explode(f"p.mythic_plus_{s}_runs")).withColumn("source", F.lit(s))
                                for s in ("recent", "best")])
    plain = ("clear_time_ms", "par_time_ms", "num_keystone_upgrades", "map_challenge_mode_id", "zone_id", "score", "url")
    flat = runs.select(
        "player_name", "realm_slug", "region", "season", "source", "r.dungeon", "r.short_name", "r.mythic_level",
        F.to_timestamp("r.completed_at").alias("completed_at"), *[f"r.{c}" for c in plain],
        v.timed_run(F.col("source"), F.col("r.clear_time_ms"), F.col("r.par_time_ms"), F.col("r.num_keystone_upgrades")).alias("timed"),
        "snapshot_at", "_ingested_at")
    return dedup_runs(hold(flat, "silver_raiderio_player_runs", "drop"))


def dedup_runs(flat: DataFrame) -> DataFrame:
    return rows.latest_by(flat, RUN_KEY, [(F.col("source") == "best").desc(), F.col("snapshot_at").desc_nulls_last(),
                                          F.col("score").desc_nulls_last(), F.col("clear_time_ms").asc_nulls_last()])


def live_raid_roster(raw: DataFrame) -> DataFrame:
    latest = rows.latest_by(raw, ["sheet_id", "gid"], ["_ingested_at", "csv_text"])
    parsed = parse_sheet(latest, "csv_text", keep=("sheet_id", "gid", "_ingested_at"))
    named = rows.latest_by(hold(parsed, "silver_live_raid_roster", "drop"), ["sheet_id", "gid", "_ingested_at", F.lower("name")], [F.col("_line").asc()])
    return named.select("name", "roster_rank", "player_class", "race", "note", "source_refreshed_at",
                        F.to_timestamp("_ingested_at").alias("snapshot_at"), "_ingested_at")
