"""Gold products from character profiles, sheets and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions import names as nm
from emberlog.sources.payloads import payload_ddl

# Fixed value: names of the raid feats that count.
RAID_FEATS = r"cutting edge:|famed slayer|famed bane"


def _key() -> Column:
    return nm.identity_key("player_name", None, "realm_slug").alias("player_identity_key")


def live_raid_roster(roster: DataFrame) -> DataFrame:
    return roster.select("name", "roster_rank", "player_class", "race", "note", "source_refreshed_at")


def guild_zone_ranks(ranks: DataFrame) -> DataFrame:
    parsed = ranks.withColumn("p", F.from_json("progress_json", payload_ddl("zone_progress")))
    return parsed.select("zone_id", "zone_name", *[F.col(f"p.{k}Rank.number").alias(f"{k}_rank") for k in ("world", "region", "server")])


def player_character_media(media: DataFrame) -> DataFrame:
    return media.select(_key(), "player_name", "realm_slug", "avatar_url", "inset_url", "main_url", "main_raw_url")


def _or_blank(column):
    return F.coalesce(column, F.lit(""))


def player_character_equipment(equipment: DataFrame, item_media: DataFrame) -> DataFrame:
    """One row per equipped item; nested lists are written back as compact JSON."""
    parsed = equipment.withColumn("q", F.from_json("equipment_json", payload_ddl("equipment")))
    items = parsed.select(_key(), "player_name", "realm_slug", F.explode("q.equipped_items").alias("it"))
    enchants = F.transform("it.enchantments", lambda e: F.struct(
        _or_blank(e["display_string"]).alias("display_string"), _or_blank(e["source_item"]["name"]).alias("source_item_name"),
        F.coalesce(e["enchantment_id"], e["id"]).alias("enchantment_id")))
    sockets = F.transform("it.sockets", lambda s: F.struct(
        _or_blank(s["socket_type"]["name"]).alias("socket_type"), s["item"]["id"].alias("item_id"),
        _or_blank(s["item"]["name"]).alias("item_name"), _or_blank(s["display_string"]).alias("display_string")))
    stats = F.transform("it.stats", lambda s: F.struct(
        _or_blank(s["type"]["name"]).alias("type"), s["value"].alias("value"), _or_blank(s["display"]["display_string"]).alias("display"),
        F.coalesce(s["is_negated"], F.lit(False)).alias("is_negated")))
    spells = F.transform("it.spells", lambda s: F.struct(
        s["spell"]["id"].alias("spell_id"), _or_blank(s["spell"]["name"]).alias("spell_name"),
        _or_blank(s["description"]).alias("description")))
    details = F.struct(
        _or_blank(F.col("it.name_description.display_string")).alias("name_description"),
        _or_blank(F.col("it.requirements.level.display_string")).alias("requirements_level"),
        _or_blank(F.col("it.durability.display_string")).alias("durability_display"),
        F.col("it.durability.value").alias("durability_value"), _or_blank(F.col("it.limit_category.name")).alias("limit_category"))
    flat = items.select(
        "player_name", "player_identity_key", "realm_slug", F.col("it.slot.type").alias("slot_type"), F.col("it.slot.name").alias("slot_name"),
        F.col("it.item.id").alias("item_id"), F.col("it.name").alias("item_name"), F.col("it.quality.name").alias("quality"),
        F.col("it.level.value").alias("item_level"), F.col("it.inventory_type.name").alias("inventory_type"),
        F.col("it.item_subclass.name").alias("item_subclass"), F.col("it.binding.name").alias("binding"),
        F.col("it.transmog.item.name").alias("transmog_name"), F.to_json(enchants).alias("enchantments_json"),
        F.to_json(sockets).alias("sockets_json"), F.to_json(stats).alias("stats_json"), F.to_json(spells).alias("spells_json"),
        F.to_json(details).alias("raw_details_json"))
    iconed = flat.join(item_media.select("item_id", "icon_url"), "item_id", "left")
    return iconed.select("player_name", "player_identity_key", "realm_slug", "slot_type", "slot_name", "item_id", "item_name",
                         _or_blank(F.col("icon_url")).alias("icon_url"), "quality", "item_level", "inventory_type", "item_subclass",
                         "binding", "transmog_name", "enchantments_json", "sockets_json", "stats_json", "spells_json", "raw_details_json")


def player_raid_achievements(achievements: DataFrame) -> DataFrame:
    parsed = achievements.withColumn("a", F.from_json("achievements_json", payload_ddl("achievements")))
    each = parsed.select(_key(), "player_name", "realm_slug", F.explode("a.achievements").alias("r"))
    flat = each.select("player_identity_key", "player_name", "realm_slug", F.coalesce("r.achievement.id", "r.id").alias("achievement_id"),
                       F.col("r.achievement.name").alias("achievement_name"), F.col("r.completed_timestamp").alias("completed_timestamp"),
                       F.coalesce("r.criteria.is_completed", F.lit(False)).alias("_done"))
    done = flat.filter(F.col("_done") | F.col("completed_timestamp").isNotNull())
    return done.filter(F.lower("achievement_name").rlike(RAID_FEATS)).drop("_done")
