"""Schemas of the JSON payloads kept as text in the landing tables, and their parsing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CORRUPT = "_corrupt"


def _struct(**fields: str) -> str:
    return "STRUCT<" + ", ".join(f"`{n}`: {t}" for n, t in fields.items()) + ">"


def _array(item: str) -> str:
    return f"ARRAY<{item}>"


_RANGE = _struct(min="BIGINT", max="BIGINT")
_STAT_NAMES = ("Crit", "Haste", "Mastery", "Versatility", "Strength", "Agility", "Intellect", "Stamina")
_GEAR = _struct(slot="BIGINT", name="STRING", temporaryEnchant="BIGINT", temporaryEnchantName="STRING",
                permanentEnchant="BIGINT", permanentEnchantName="STRING")
_PLAYER = _struct(
    id="BIGINT", name="STRING", type="STRING", icon="STRING", specs=_array(_struct(spec="STRING", count="BIGINT")),
    minItemLevel="DOUBLE", maxItemLevel="DOUBLE", potionUse="BIGINT", healthstoneUse="BIGINT",
    combatantInfo=_struct(stats=_struct(**{n: _RANGE for n in _STAT_NAMES}), gear=_array(_GEAR)))
_PARSE = _struct(**{"id": "BIGINT", "name": "STRING", "class": "STRING", "spec": "STRING", "amount": "DOUBLE",
                    "rankPercent": "DOUBLE", "bracketPercent": "DOUBLE", "rank": "STRING", "totalParses": "BIGINT"})
_ROLE = _struct(name="STRING", characters=_array(_PARSE))
_DEATH_EVENT = _struct(timestamp="BIGINT", type="STRING", sourceIsFriendly="BOOLEAN",
                       ability=_struct(name="STRING", guid="BIGINT"))
_CAST = _struct(timestamp="BIGINT", type="STRING", sourceID="BIGINT", targetID="BIGINT", fight="BIGINT",
                abilityGameID="BIGINT",
                ability=_struct(name="STRING", guid="BIGINT", type="BIGINT", abilityIcon="STRING"))
_COMBATANT = _struct(
    timestamp="BIGINT", type="STRING", sourceID="BIGINT", source=_struct(id="BIGINT"), fight="BIGINT", specID="BIGINT",
    talentTree=_array(_struct(spellID="BIGINT", id="BIGINT", talentID="BIGINT")),
    auras=_array(_struct(abilityGameId="BIGINT", icon="STRING", name="STRING", stacks="BIGINT")))
_RUN = _struct(dungeon="STRING", short_name="STRING", mythic_level="BIGINT", completed_at="STRING",
               clear_time_ms="BIGINT", par_time_ms="BIGINT", num_keystone_upgrades="BIGINT",
               map_challenge_mode_id="BIGINT", zone_id="BIGINT", score="DOUBLE", url="STRING")
_PLACES = _struct(world="BIGINT", region="BIGINT", realm="BIGINT")
_NAMED = _struct(type="STRING", name="STRING")
_REF = _struct(id="BIGINT", name="STRING")
_SHOWN = _struct(display_string="STRING")
_ITEM = _struct(
    slot=_NAMED, item=_REF, name="STRING", level=_struct(value="BIGINT"), quality=_NAMED, inventory_type=_NAMED,
    item_subclass=_NAMED, binding=_NAMED, transmog=_struct(item=_REF),
    enchantments=_array(_struct(display_string="STRING", source_item=_REF, enchantment_id="BIGINT", id="BIGINT")),
    sockets=_array(_struct(socket_type=_NAMED, item=_REF, display_string="STRING")),
    stats=_array(_struct(type=_NAMED, value="BIGINT", display=_SHOWN, is_negated="BOOLEAN")),
    spells=_array(_struct(spell=_REF, description="STRING")), name_description=_SHOWN,
    requirements=_struct(level=_SHOWN), durability=_struct(display_string="STRING", value="BIGINT"),
    limit_category=_struct(name="STRING"))

PAYLOADS = {
    "player_details": {"data": _struct(playerDetails=_struct(dps=_array(_PLAYER), healers=_array(_PLAYER), tanks=_array(_PLAYER)))},
    "rankings": {"data": _array(_struct(fightID="BIGINT", difficulty="BIGINT", zone="BIGINT", encounter=_REF, size="BIGINT",
                                        duration="BIGINT", roles=_struct(tanks=_ROLE, healers=_ROLE, dps=_ROLE)))},
    "deaths": {"data": _struct(entries=_array(_struct(
        name="STRING", id="BIGINT", type="STRING", icon="STRING", timestamp="BIGINT", fight="BIGINT", overkill="BIGINT",
        events=_array(_DEATH_EVENT))))},
    "casts": {"data": _array(_CAST)},
    "combatants": {"data": _array(_COMBATANT)},
    "media": {"assets": _array(_struct(key="STRING", value="STRING"))},
    "equipment": {"equipped_items": _array(_ITEM)},
    "achievement_totals": {"total_quantity": "BIGINT", "total_points": "BIGINT"},
    "achievements": {"achievements": _array(_struct(id="BIGINT", achievement=_REF, criteria=_struct(is_completed="BOOLEAN"),
                                                    completed_timestamp="BIGINT"))},
    "zone_progress": {f"{p}Rank": _struct(number="BIGINT") for p in ("world", "region", "server")},
    "profile": {
        "name": "STRING", "region": "STRING", "realm": "STRING", "profile_url": "STRING", "last_crawled_at": "STRING",
        "mythic_plus_scores_by_season": _array(_struct(season="STRING", scores=_struct(
            all="DOUBLE", dps="DOUBLE", healer="DOUBLE", tank="DOUBLE"))),
        "mythic_plus_ranks": _struct(**{"overall": _PLACES, "class": _PLACES, "class_dps": _PLACES,
                                        "class_healer": _PLACES, "class_tank": _PLACES}),
        "mythic_plus_recent_runs": _array(_RUN), "mythic_plus_best_runs": _array(_RUN)},
}


def payload_ddl(kind: str, corrupt: bool = False) -> str:
    fields = dict(PAYLOADS[kind])
    if corrupt:
        fields[_CORRUPT] = "STRING"
    return ", ".join(f"`{n}` {t}" for n, t in fields.items())


def parse(df: DataFrame, text: str, kind: str, name: str = "payload") -> DataFrame:
    """Rows with a readable payload, parsed; null and malformed text is left out."""
    parsed = df.withColumn(name, F.from_json(text, payload_ddl(kind, corrupt=True), {"columnNameOfCorruptRecord": _CORRUPT}))
    return parsed.filter(F.col(text).isNotNull() & F.col(f"{name}.{_CORRUPT}").isNull())


def readable(text: str, kind: str) -> Column:
    """The parsed payload, null where there is none or it is malformed."""
    parsed = F.from_json(text, payload_ddl(kind, corrupt=True), {"columnNameOfCorruptRecord": _CORRUPT})
    return F.when(parsed[_CORRUPT].isNull(), parsed)


def exploded(df: DataFrame, text: str, kind: str, items: Callable[[Column], Column], name: str, *keep: str) -> DataFrame:
    """``keep`` and one row per item of the readable payloads; null items are left out.

    The payload is parsed once: neither a filter on it nor one that the optimiser derives from an
    inner explode is pushed below the projection that parses it.
    """
    parsed = df.select(*keep, F.from_json(text, payload_ddl(kind, corrupt=True), {"columnNameOfCorruptRecord": _CORRUPT}).alias("_payload"))
    readable = F.when(F.col(f"_payload.{_CORRUPT}").isNull(), items(F.col("_payload")))
    return parsed.select(*keep, F.explode_outer(readable).alias(name)).filter(F.col(name).isNotNull())


def corrupt_rows(df: DataFrame, text: str, kind: str) -> DataFrame:
    """Side table of rows whose payload is present but malformed or blank."""
    parsed = df.withColumn("_p", F.from_json(text, payload_ddl(kind, corrupt=True), {"columnNameOfCorruptRecord": _CORRUPT}))
    return parsed.filter(F.col(f"_p.{_CORRUPT}").isNotNull() | (F.trim(text) == "")).drop("_p")
