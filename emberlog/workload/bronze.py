"""Landing rows, with JSON payloads, rebuilt from the flat domain tables.

Lists of one report hold at most its fifty users, six pulls, or both; event payloads are cut by
``event_id`` into records of at most ``CHUNK`` events. So no record grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.workload.domain import Domain

CHUNK = 64


def _stamp() -> Column:
    return F.max("_ingested_at").alias("_ingested_at")


def _source() -> Column:
    return F.lit("events").alias("_source")


def _list(*fields: Column | str) -> Column:
    return F.sort_array(F.collect_list(F.struct(*fields)))


def _chunk() -> Column:
    return F.floor(F.col("event_id") / CHUNK).alias("_chunk")


def _zone() -> Column:
    return F.struct(F.col("zone_id").alias("id"), F.col("zone_name").alias("name")).alias("zone")


def guild_reports(dom: Domain) -> DataFrame:
    rows = dom["reports"].select("code", "title", F.col("start_ms").alias("startTime"), F.col("end_ms").alias("endTime"), _zone(),
                                 _source(), "_ingested_at")
    blank = rows.withColumn("code", F.lit(""))  # bad rows for the drop rule
    # Every report lands twice; the second landing is the newer one.
    return rows.withColumn("title", F.lit("stale")).withColumn("_ingested_at", F.lit("2023-01-01T00:00:00")).unionByName(rows).unionByName(blank)


def report_fights(dom: Domain) -> DataFrame:
    f = dom.fights().join(dom["fights"].select("report_code", "fight_id", "fight_end_ms"), ["report_code", "fight_id"])
    fight = F.struct(F.col("fight_id").alias("id"), F.col("boss_name").alias("name"), F.col("encounter_id").alias("encounterID"),
                     F.col("is_kill").alias("kill"), F.col("fight_start_ms").alias("startTime"), F.col("fight_end_ms").alias("endTime"),
                     F.col("difficulty"), F.lit(None).cast("double").alias("fightPercentage"), F.col("boss_percentage").alias("bossPercentage"),
                     F.col("last_phase").alias("lastPhase"), F.col("fight_size").alias("size"),
                     F.col("friendly_player_ids").alias("friendlyPlayers"))
    grouped = f.groupBy(F.col("report_code").alias("code"), F.col("report_title").alias("title")).agg(
        F.sort_array(F.collect_list(fight)).alias("fights"), _stamp())
    # Pulls outside the raid rules, which must be filtered.
    extra = F.transform("fights", lambda x: x.withField("id", x["id"] + 100).withField("difficulty", F.lit(10).cast("bigint")))
    trash = F.transform("fights", lambda x: x.withField("id", x["id"] + 200).withField("encounterID", F.lit(0).cast("bigint")))
    return grouped.withColumn("fights", F.concat("fights", extra, trash)).withColumn("_source", _source())


def raid_attendance(dom: Domain) -> DataFrame:
    a = dom["attendance"]
    player = _list(F.concat(F.lit(" "), "player_name", F.lit(" ")).alias("name"), F.col("presence").cast("bigint").alias("presence"),
                   F.col("player_class").alias("type"))
    return a.groupBy(F.col("report_code").alias("code")).agg(player.alias("players"), _stamp()).withColumn("_source", _source())


def actor_roster(dom: Domain) -> DataFrame:
    actor = _list(F.col("actor_id").alias("id"), F.concat("player_name", F.lit(" ")).alias("name"), F.lit("Player").alias("type"),
                  F.col("player_class").alias("subType"), F.col("realm").alias("server"))
    return dom["actors"].groupBy("report_code").agg(actor.alias("actors"), _stamp()).withColumn("_source", _source())


def player_details(dom: Domain) -> DataFrame:
    """Per pull: players by role, with gear that carries the weapon enchant by name or by id."""
    p = dom["perf"]
    weapon = F.col("weapon_enhancement_names")
    by_id = weapon == "Flametongue Weapon"
    gear = F.array(F.struct(F.lit(16).alias("slot"), F.when(by_id, 5400).alias("temporaryEnchant"),
                            F.when(by_id, "").otherwise(weapon).alias("temporaryEnchantName")))
    stat = [F.struct(F.col(f"{n.lower()}_rating").alias("min")).alias(n) for n in ("Crit", "Haste", "Mastery", "Versatility")]
    player = F.struct(F.col("actor_id").alias("id"), F.col("player_name").alias("name"), F.col("player_class").alias("type"),
                      F.array(F.struct(F.col("spec"), F.lit(1).alias("count"))).alias("specs"),
                      (F.col("avg_item_level") - 2).alias("minItemLevel"), (F.col("avg_item_level") + 2).alias("maxItemLevel"),
                      F.col("potion_use").alias("potionUse"), F.col("healthstone_use").alias("healthstoneUse"),
                      F.struct(F.struct(*stat).alias("stats"), gear.alias("gear")).alias("combatantInfo"))
    keys = ["report_code", "fight_id", "boss_name", "encounter_id", "difficulty", "zone_id", "zone_name", "duration_ms"]
    groups = p.groupBy(*keys).agg(_stamp(), *[F.sort_array(F.collect_list(F.when(F.col("role") == r, player))).alias(n)
                                           for r, n in (("dps", "dps"), ("healer", "healers"), ("tank", "tanks"))])
    details = F.struct(F.struct(F.struct("dps", "healers", "tanks").alias("playerDetails")).alias("data"))
    return groups.select(*keys, F.lit(True).alias("is_kill"), F.to_json(details).alias("player_details_json"), _source(), "_ingested_at")


def fight_rankings(dom: Domain) -> DataFrame:
    """One payload pair per report. Each metric also lists the other roles, with values to ignore."""
    r = dom["rankings"]
    parse = F.struct(F.col("player_name").alias("name"), F.col("player_class").alias("class"), "spec", "amount",
                     F.col("rank_percent").alias("rankPercent"), F.col("bracket_percent").alias("bracketPercent"),
                     F.col("rank_string").alias("rank"), F.col("total_parses").alias("totalParses"))
    fights = r.groupBy("report_code", "fight_id").agg(_stamp(), *[
        F.struct(F.sort_array(F.collect_list(F.when(F.col("role") == role, parse))).alias("characters")).alias(group)
        for role, group in (("tank", "tanks"), ("healer", "healers"), ("dps", "dps"))])
    wrong = F.transform("healers.characters", lambda c: c.withField("amount", F.lit(-1.0)))
    first = F.struct(F.col("fight_id").alias("fightID"), F.struct("tanks", F.struct(wrong.alias("characters")).alias("healers"), "dps").alias("roles"))
    second = F.struct(F.col("fight_id").alias("fightID"), F.struct("healers").alias("roles"))
    reports = fights.groupBy("report_code").agg(
        _stamp(), F.to_json(F.struct(F.sort_array(F.collect_list(first)).alias("data"))).alias("rankings_json"),
        F.to_json(F.struct(F.sort_array(F.collect_list(second)).alias("data"))).alias("rankings_hps_json"))
    new = reports.withColumn("_source", _source())
    stale = new.withColumn("rankings_json", F.lit('{"data": []}')).withColumn("_ingested_at", F.lit("2023-01-01T00:00:00"))
    # As new as the newest and equal in the first metric: the second one, empty here, decides.
    twin = new.withColumn("rankings_hps_json", F.lit('{"data": []}'))
    return new.unionByName(stale).unionByName(twin)


def fight_deaths(dom: Domain) -> DataFrame:
    """Single-fight records in chunks, and one older multi-fight record per report to be dropped."""
    d = dom["deaths"]
    hit = F.struct(F.lit("damage").alias("type"), F.lit(False).alias("sourceIsFriendly"),
                   F.struct(F.col("killing_blow_name").alias("name"), F.col("killing_blow_id").alias("guid")).alias("ability"))
    heal = F.struct(F.lit("heal").alias("type"), F.lit(True).alias("sourceIsFriendly"),
                    F.struct(F.lit("Mend").alias("name"), F.lit(7).cast("bigint").alias("guid")).alias("ability"))
    entry = F.struct(F.col("player_name").alias("name"), F.col("player_class").alias("type"), F.col("death_timestamp_ms").alias("timestamp"),
                     F.col("fight_id").alias("fight"), "overkill", F.array(heal, hit).alias("events"))
    single = d.groupBy("report_code", "fight_id", _chunk()).agg(_stamp(), F.sort_array(F.collect_list(entry)).alias("entries")).select(
        "report_code", F.array("fight_id").alias("fight_ids"), F.to_json(F.struct(F.struct("entries").alias("data"))).alias("table_json"),
        _source(), "_ingested_at")
    old = single.withColumn("fight_ids", F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint")))
    bad = single.withColumn("table_json", F.lit('{"data": '))
    return single.unionByName(old).unionByName(bad)


def _payload(rows: DataFrame, event: Column, name: str) -> DataFrame:
    grouped = rows.groupBy("report_code", _chunk()).agg(F.sort_array(F.collect_list(event)).alias("data"))
    return grouped.select("report_code", F.to_json(F.struct("data")).alias(name))


def fight_casts(dom: Domain) -> DataFrame:
    """Cast, buff and combatant payloads in chunks, each kind in records of its own."""
    at = F.col("cast_timestamp_ms").alias("timestamp")
    cast = F.struct(at, F.lit("cast").alias("type"), F.col("actor_id").alias("sourceID"), F.col("event_fight_id").alias("fight"),
                    F.when(F.col("ability_id") % 2 == 0, F.col("ability_id")).alias("abilityGameID"),
                    F.when(F.col("ability_id") % 2 == 1, F.struct(F.col("ability_id").alias("guid"))).alias("ability"))
    buff = F.struct(F.col("timestamp_ms").alias("timestamp"), F.col("actor_id").alias("targetID"), F.col("fight_id").alias("fight"),
                    F.struct(F.col("ability_name").alias("name"), F.col("ability_id").alias("guid")).alias("ability"))
    odd = F.col("actor_id") % 2 == 1
    combatant = F.struct(F.col("combatant_timestamp_ms").alias("timestamp"), F.when(odd, F.col("actor_id")).alias("sourceID"),
                         F.when(~odd, F.struct(F.col("actor_id").alias("id"))).alias("source"), F.col("event_fight_id").alias("fight"),
                         F.col("spec_id").alias("specID"), F.array(F.struct(F.col("talent_id").alias("spellID"))).alias("talentTree"),
                         F.array(F.struct(F.concat(F.lit(" "), "aura_name").alias("name"))).alias("auras"))
    parts = [_payload(dom["raw_casts"], cast, "events_json"), _payload(dom["buff_events"], buff, "buffs_json"),
             _payload(dom["combatants"], combatant, "combatant_info_json")]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.select("*", F.lit("2024-02-01T00:00:00").alias("_ingested_at"), _source(), F.lit("casts").alias("_file_path"))


def zone_catalog(dom: Domain) -> DataFrame:
    levels = F.array(*[F.struct(F.lit(n).alias("name")) for n in ("Normal", "Heroic", "Mythic")])
    encounter = _list(F.col("encounter_id").alias("id"), F.col("encounter_name").alias("name"))
    return dom["zones"].groupBy(F.col("zone_id").alias("id"), F.col("zone_name").alias("name"), F.col("zone_frozen").alias("frozen")).agg(
        F.concat(encounter, encounter).alias("encounters"), _stamp()).withColumn("difficulties", levels)


def guild_members(dom: Domain) -> DataFrame:
    now = dom["members"].drop("user_id").withColumn("class_name", F.lit(None).cast("string"))
    stale = now.withColumn("rank", F.lit(99).cast("bigint")).withColumn("_ingested_at", F.lit("2023-01-01T00:00:00"))
    return now.unionByName(stale)


def _signups(dom: Domain) -> DataFrame:
    return dom["e"].filter("event_type = 'signup'").select("event_id", "player_name", "realm_slug", "k", "user_id",
                                                           F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingested_at"))


def character_media(dom: Domain) -> DataFrame:
    keys = F.when(F.col("k") % 3 == 0, F.array(F.lit("avatar"))).otherwise(F.array(F.lit("avatar"), F.lit("inset"), F.lit("main"), F.lit("main-raw")))
    assets = F.transform(keys, lambda x: F.struct(x.alias("key"), F.concat(x, F.lit("/"), F.col("k").cast("string")).alias("value")))
    return _signups(dom).select("player_name", "realm_slug", F.to_json(F.struct(assets.alias("assets"))).alias("media_json"), "_ingested_at")


def item_media(dom: Domain) -> DataFrame:
    icon = F.array(F.struct(F.lit("icon").alias("key"), F.concat(F.lit("icon/"), F.col("k").cast("string")).alias("value")))
    return _signups(dom).select((F.col("k") % 20).alias("item_id"), F.to_json(F.struct(icon.alias("assets"))).alias("media_json"), "_ingested_at")


def character_equipment(dom: Domain) -> DataFrame:
    """One to three items per snapshot."""
    def item(i: Column) -> Column:
        ref = F.struct(((F.col("k") + i) % 25).alias("id"))
        return F.struct(
            F.struct(F.concat(F.lit("SLOT"), i.cast("string")).alias("type"), F.concat(F.lit("Slot "), i.cast("string")).alias("name")).alias("slot"),
            ref.alias("item"), F.concat(F.lit("Item "), ((F.col("k") + i) % 25).cast("string")).alias("name"),
            F.struct((600 + F.col("k") + i).alias("value")).alias("level"), F.struct(F.lit("Epic").alias("name")).alias("quality"),
            F.array(F.struct(F.lit("+10").alias("display_string"), i.alias("id"))).alias("enchantments"))

    items = F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("k") % 3 + 1), item)
    return _signups(dom).select("player_name", "realm_slug", F.to_json(F.struct(items.alias("equipped_items"))).alias("equipment_json"), "_ingested_at")


def character_achievements(dom: Domain) -> DataFrame:
    names = ("Cutting Edge: Boss", "Famed Slayer of Bosses", "Common Feat")
    rows = F.array(*[F.struct(F.lit(i).alias("id"), F.struct(F.lit(100 + i).alias("id"), F.lit(n).alias("name")).alias("achievement"),
                              F.struct((F.col("k") % 2 == i % 2).alias("is_completed")).alias("criteria"),
                              F.when(F.col("k") % 3 == i, F.col("k") * 1000).alias("completed_timestamp")) for i, n in enumerate(names)])
    payload = F.struct(F.col("k").alias("total_quantity"), (F.col("k") * 10).alias("total_points"), rows.alias("achievements"))
    return _signups(dom).select("player_name", "realm_slug", F.to_json(payload).alias("achievements_json"), "_ingested_at")


def guild_zone_ranks(dom: Domain) -> DataFrame:
    progress = F.struct(*[F.struct((F.col("k") * m).alias("number")).alias(f"{n}Rank") for n, m in (("world", 100), ("region", 10), ("server", 1))])
    return dom["e"].filter("event_type = 'signup'").select(
        (F.col("user_id") % 4).alias("zone_id"), F.concat(F.lit("ZONE_"), (F.col("user_id") % 4).cast("string")).alias("zone_name"),
        F.to_json(progress).alias("progress_json"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingested_at"))


def character_profiles(dom: Domain) -> DataFrame:
    """One profile per dungeon run or score snapshot; best runs also sit in the recent list."""
    runs = dom["runs"].select("player_name", "realm_slug", F.upper("region").alias("region"), "_ingested_at", F.struct(
        "dungeon", "short_name", "mythic_level", F.date_format("completed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("completed_at"),
        "clear_time_ms", "par_time_ms", "num_keystone_upgrades", "map_challenge_mode_id", "zone_id", "score", "url").alias("run"), "source")
    empty = F.array().cast(f"array<{runs.schema['run'].dataType.simpleString()}>")
    profile = F.struct(F.array("run").alias("mythic_plus_recent_runs"),
                       F.when(F.col("source") == "best", F.array("run")).otherwise(empty).alias("mythic_plus_best_runs"))
    return runs.select("player_name", "realm_slug", "region", F.lit(None).cast("string").alias("profile_url"),
                       F.to_json(profile).alias("profile_json"), "_ingested_at")


def score_profiles(dom: Domain) -> DataFrame:
    s = dom["scores"]
    season = F.array(F.struct(F.lit("season-1").alias("season"), F.struct(*[F.col(f"score_{r}").alias(r) for r in ("all", "dps", "healer", "tank")]).alias("scores")))
    places = F.struct(F.struct(*[F.col(f"{r}_rank").alias(r) for r in ("world", "region", "realm")]).alias("overall"))
    profile = F.struct("profile_url", F.upper("region").alias("region"), F.col("raiderio_last_crawled_at").alias("last_crawled_at"),
                       season.alias("mythic_plus_scores_by_season"), places.alias("mythic_plus_ranks"))
    return s.select("player_name", "realm_slug", F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("profile_url"),
                    F.to_json(profile).alias("profile_json"), "_ingested_at")


def live_raid_roster(dom: Domain) -> DataFrame:
    """One sheet per fifty members: two header lines, quoted notes, and the rows again in lower case."""
    from emberlog.sources.sheet import POSITIONS

    member = dom["members"].select((F.floor(F.col("user_id") / 50)).alias("_g"), "name").join(dom["live_roster"], "name")
    gap = {a: POSITIONS[b] - POSITIONS[a] for a, b in zip(list(POSITIONS), list(POSITIONS)[1:])}
    line = F.concat("name", F.lit("," * gap["name"]), "roster_rank", F.lit("," * gap["roster_rank"]), "player_class",
                    F.lit("," * gap["player_class"]), "race", F.lit(","), F.concat(F.lit('"'), F.replace("note", F.lit('"'), F.lit('""')), F.lit('"')))
    sheets = member.groupBy("_g", "source_refreshed_at").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    text = F.concat(F.lit("Title\nRefreshed,"), "source_refreshed_at", F.lit("\n"), F.array_join("lines", "\n"), F.lit("\n"),
                    F.array_join(F.transform("lines", F.lower), "\n"), F.lit("\n,,,\n"))
    new = sheets.select(F.lit("sheet").alias("sheet_id"), F.col("_g").cast("string").alias("gid"), text.alias("csv_text"),
                        F.lit("2024-02-01T00:00:00").alias("_ingested_at"))
    return new.unionByName(new.withColumn("csv_text", F.lit("old")).withColumn("_ingested_at", F.lit("2023-01-01T00:00:00")))


BUILDERS = {"guild_reports": guild_reports, "report_fights": report_fights, "raid_attendance": raid_attendance,
    "actor_roster": actor_roster, "player_details": player_details, "zone_catalog": zone_catalog,
    "fight_rankings": fight_rankings, "fight_deaths": fight_deaths, "fight_casts": fight_casts,
    "guild_zone_ranks": guild_zone_ranks, "guild_members": guild_members, "character_media": character_media,
    "character_equipment": character_equipment, "character_achievements": character_achievements,
    "item_media": item_media, "raiderio_character_profiles": character_profiles, "live_raid_roster": live_raid_roster}
