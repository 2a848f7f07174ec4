"""Gold product: preparation readiness of the current tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import values as v
from emberlog.session import stored

c = F.col


def _text(value: Column | str) -> Column:
    """Null for blank text."""
    return F.nullif(c(value) if isinstance(value, str) else value, F.lit(""))


def required_weapon(player_class: str, spec: str, names: str, has_any: str) -> Column:
    """Whether the weapon rule of the class and spec is met; one class needs named imbues."""
    listed = F.lower(F.coalesce(names, F.lit("")))
    flame, wind, earth = (listed.contains(f"{n} weapon") for n in ("flametongue", "windfury", "earthliving"))
    any_kind = F.coalesce(has_any, F.lit(False))
    spec_name = F.lower(F.coalesce(spec, F.lit("")))
    named = (F.when(spec_name == "enhancement", flame & wind).when(spec_name == "restoration", earth)
             .when(spec_name == "elemental", flame | any_kind).otherwise(flame | wind | earth | any_kind))
    return F.when(F.lower(F.coalesce(player_class, F.lit(""))) == "shaman", named).otherwise(any_kind)


def override_characters(overrides: DataFrame) -> DataFrame:
    """One row per character of an enabled override."""
    listed = F.when(c("mode") == "replace", F.array("source_character", "target_character")).otherwise(
        F.split(F.coalesce("characters", F.lit("")), r"\|"))
    flat = overrides.filter(F.coalesce("enabled", F.lit(True))).select("*", F.explode(listed).alias("character_name"))
    return flat.filter("trim(character_name) <> ''").select(
        F.concat(F.lit("override:"), c("id")).alias("identity_key"),
        F.coalesce(_text("display_name"), _text("source_character"), _text("target_character"), "character_name").alias("display_name"),
        "mode", F.lower(F.trim("character_name")).alias("_character"))


def team_with_fallback(live: DataFrame, team: DataFrame) -> DataFrame:
    """The live roster, or the raid team when the live roster is empty."""
    named = live.filter("name <> ''")
    size = named.agg(F.count(F.lit(1)).alias("n"))

    def shaped(df: DataFrame, rank: str, active: Column, source: str) -> DataFrame:
        return df.select("name", F.coalesce(_text("player_class"), F.lit("Unknown")).alias("player_class"),
                         F.coalesce(_text(rank), F.lit("Raider")).alias("rank_label"), active.alias("is_active"),
                         F.lit(source).alias("roster_source"))

    fallback = team.filter("name <> ''").filter(size.scalar() == 0)
    return shaped(named, "roster_rank", F.lit(True), "live_raid_roster").unionByName(
        shaped(fallback, "rank_label", F.coalesce("is_active", F.lit(False)), "gold_raid_team"))


def readiness_rates(roster: DataFrame, identities: DataFrame) -> DataFrame:
    """Per identity: kills, consumable counts and the newest non-blank values."""
    kills = roster.join(identities, F.lower("player_name") == c("_character"))
    when = F.struct("raid_night_date", "report_code", "fight_id", "player_name")

    def newest(column: str) -> Column:
        value = _text(F.trim(column))
        return F.max_by(value, F.when(value.isNotNull(), when))

    ok = required_weapon("player_class", "spec", "weapon_enhancement_names", "has_weapon_enhancement")
    return kills.groupBy("identity_key").agg(
        F.max_by("player_class", when).alias("_class"), F.lower(F.max_by("role", when)).alias("_role"), F.max_by("spec", when).alias("_spec"),
        F.max_by("avg_item_level", when).alias("_level"), F.max("raid_night_date").alias("_last"), F.count(F.lit(1)).alias("kills_tracked"),
        F.count_if("has_food_buff").alias("_food"), F.count_if("has_flask_or_phial_buff").alias("_flask"), F.count_if(ok).alias("_weapon"),
        F.count_if(c("potion_use") > 0).alias("_potion"), F.countDistinct("raid_night_date").alias("raids_present"),
        *[newest(n).alias(f"recent_{k}_names") for k, n in (("food", "food_buff_names"), ("flask", "flask_or_phial_names"),
                                                           ("weapon", "weapon_enhancement_names"), ("combat_potion", "combat_potion_names"))])


def preparation_readiness(summary: DataFrame, live: DataFrame, team: DataFrame, overrides: DataFrame, roster: DataFrame) -> DataFrame:
    raids = summary.filter("report_code IS NOT NULL AND raid_night_date IS NOT NULL AND zone_name IS NOT NULL").filter(
        ~c("zone_name").isin(*rules.EXCLUDED_ZONES))
    # Newest zone and its raid nights in one pass over the raids.
    zones = raids.groupBy("zone_name").agg(F.max("raid_night_date").alias("last"), F.countDistinct("raid_night_date").alias("nights"))
    tier = stored(zones.agg(F.max(F.struct("last", "zone_name", "nights")).alias("t")).select(
        F.lit(1).alias("_one"), c("t.zone_name").alias("current_tier"), c("t.nights").alias("total_raids_tracked")))

    members = team_with_fallback(live, team)
    override = override_characters(overrides)
    tagged = members.join(override, F.lower("name") == c("_character"), "left").drop("_character").withColumn(
        "identity_key", F.coalesce("identity_key", F.concat(F.lit("character:"), F.lower("name"))))
    identity = tagged.groupBy("identity_key").agg(
        F.coalesce(F.max("display_name"), F.max("name")).alias("player_name"),
        F.coalesce(F.max_by(F.nullif("player_class", F.lit("Unknown")), F.struct("name", "player_class")), F.max("player_class"), F.lit("Unknown"))
        .alias("_team_class"), F.max("rank_label").alias("rank_label"), F.max("is_active").alias("is_active"),
        F.array_join(F.array_sort(F.collect_set("name")), "|").alias("character_names"), F.max("mode").alias("_mode"),
        F.max("roster_source").alias("roster_source"))
    characters = tagged.select("identity_key", F.lower("name").alias("_character")).distinct()
    rates = readiness_rates(roster.join(F.broadcast(tier), c("zone_name") == c("current_tier"), "left_semi"), characters)

    seen = identity.withColumn("_one", F.lit(1)).join(F.broadcast(tier), "_one", "left")  # the tier is one row
    joined = seen.join(rates.withColumn("_seen", F.lit(True)), "identity_key", "left").fillna(
        0, ["kills_tracked", "raids_present", "_food", "_flask", "_weapon", "_potion"])
    role = F.when(c("_role").isin("healer", "healing"), "healer").when(c("_role").isin("tank", "dps"), c("_role")).otherwise("unknown")
    base = joined.select(
        "*", F.coalesce("_class", "_team_class", F.lit("Unknown")).alias("player_class"), role.alias("role"),
        F.coalesce("_seen", F.lit(False)).alias("has_current_tier_data"))
    base = base.select("*", (v.ratio("raids_present", "total_raids_tracked") * 100).alias("_att"),
                       *[(v.ratio(f"_{k}", "kills_tracked") * 100).alias(f"_{k}_rate") for k in ("food", "flask", "weapon", "potion")])

    w = rules.READINESS_WEIGHTS
    common = (c("_att") * w["attendance"] + c("_food_rate") * w["food"] + c("_flask_rate") * w["flask"] + c("_weapon_rate") * w["weapon"])
    is_dps, fought, any_raid = c("role") == "dps", c("kills_tracked") > 0, c("total_raids_tracked") > 0
    score = (F.when(any_raid & fought & is_dps, common + c("_potion_rate") * w["potion"]).when(any_raid & fought, common / (1 - w["potion"]))
             .when(any_raid, c("_att")).otherwise(0.0))
    weakest = (F.when(is_dps & (c("_potion_rate") <= F.least("_food_rate", "_flask_rate", "_weapon_rate")), "Combat Potion")
               .when(c("_food_rate") <= F.least("_flask_rate", "_weapon_rate"), "Food")
               .when(c("_flask_rate") <= c("_weapon_rate"), "Flask").otherwise("Weapon"))
    notes = F.array_compact(F.array(
        F.when(~c("has_current_tier_data"), "no current-tier logs"),
        F.when((c("_att") > 0) & (c("_att") < 70), "attendance risk"),
        F.when(fought & (c("_food_rate") < 80), "food coverage low"),
        F.when(fought & (c("_flask_rate") < 80), "flask/phial coverage low"),
        F.when(fought & (c("_weapon_rate") < 80), "weapon enhancement coverage low"),
        F.when(is_dps & fought & (c("_potion_rate") < 50), "combat potion usage low"),
        F.when(c("has_current_tier_data") & ~fought, "no tracked boss kills")))
    scored = base.select("*", score.alias("_score"), weakest.alias("weakest_signal_label"), notes.alias("_notes"))
    label = (F.when((c("_score") >= 85) & (F.size("_notes") <= 1), "strong")
             .when((c("_score") < 65) | (F.size("_notes") >= 3), "watch").otherwise("steady"))
    blank = F.lit("")
    potion_names = F.coalesce("recent_combat_potion_names", F.when(c("_potion") > 0, "Combat potion used"), blank)
    return scored.select(
        "identity_key", "player_name", "player_class", "role", "rank_label", "is_active", "current_tier", "roster_source",
        "has_current_tier_data", v.tidy("_att", 1).alias("attendance_rate_pct"), "raids_present", "total_raids_tracked", "kills_tracked",
        *[v.tidy(f"_{k}_rate", 1).alias(f"{n}_rate") for k, n in (("food", "food"), ("flask", "flask"), ("weapon", "weapon"), ("potion", "combat_potion"))],
        v.tidy("_score", 1).alias("readiness_score"), label.alias("readiness_label"), F.array_join("_notes", "|").alias("readiness_notes"),
        F.coalesce("_spec", F.lit(rules.EMPTY_MARK)).alias("spec"), v.tidy(F.coalesce("_level", F.lit(0.0)), 1).alias("latest_avg_item_level"),
        F.coalesce(c("_last").cast("string"), blank).alias("latest_kill_date"), "weakest_signal_label",
        *[F.coalesce(f"recent_{k}_names", blank).alias(f"recent_{k}_names") for k in ("food", "flask", "weapon")],
        potion_names.alias("recent_combat_potion_names"), "character_names",
        F.when(c("_mode") == "replace", "Replace").when(c("_mode") == "pool", "Pool").otherwise("").alias("override_label"))
