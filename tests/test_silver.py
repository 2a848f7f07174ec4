"""Silver tables on hand-made payloads that the driver tables lack."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from emberlog.plans import gold_core, gold_profile, gold_wipes, silver
from emberlog.quality.completeness import backfill_decision, file_ages, parse_completeness, stale_landings
from emberlog.sources import payloads
from emberlog.sources.landing import FOLDERS, landing_rules, landing_schema


def landed(spark, folder, *records):
    """Landing rows through JSON text, as files would give them."""
    lines = [(json.dumps({"_ingested_at": "2024-01-01T00:00:00", "_source": "t", **r}),) for r in records]
    parsed = spark.createDataFrame(lines, "t STRING").select(F.from_json("t", landing_schema(folder)).alias("r"))
    return parsed.select("r.*").withColumn("_file_path", F.lit("f"))


def flat(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_all_landing_folders_have_a_schema(spark):
    assert len(FOLDERS) == 17
    for folder in FOLDERS:
        names = landing_schema(folder).names
        assert "_ingested_at" in names and set(r.split()[0] for r in landing_rules(folder).values()) <= set(names)


def test_fights_filter_null_outcome_and_reland(spark):
    fight = {"id": 1, "name": "B", "encounterID": 5, "kill": None, "startTime": 1000, "endTime": 61900, "difficulty": 4, "friendlyPlayers": [1]}
    record = {"code": "R", "title": "T", "fights": [fight, {**fight, "id": 2, "encounterID": None}, {**fight, "id": 3, "encounterID": 0},
                                                  {**fight, "id": 4, "difficulty": 10}, {**fight, "id": 5, "kill": True, "difficulty": 5}]}
    raw = landed(spark, "report_fights", record, {**record, "_ingested_at": "2024-01-02T00:00:00", "title": "T2"})
    reports = silver.guild_reports(landed(spark, "guild_reports", {"code": "R", "startTime": 1704067200000, "zone": {"id": 1, "name": "Z"}}, {"code": ""}, {"code": None}))
    assert reports.count() == 1
    got = silver.fight_events(raw, reports)
    assert flat(got, "fight_id", "outcome", "difficulty_label", "duration_seconds", "zone_name", "report_title") == [
        (1, "wipe", "Heroic", 60, "Z", "T2"), (5, "kill", "Mythic", 60, "Z", "T2")]
    assert str(got.first().raid_night_date) == "2024-01-01"


def test_attendance_labels(spark):
    raw = landed(spark, "raid_attendance", {"code": "R", "players": [{"name": " Ann ", "presence": 1}, {"name": "Bob", "presence": 2}, {"name": "Cy", "presence": 3},
                                                                     {"name": "Di", "presence": None}, {"name": " ", "presence": 1}]}, {"code": "R", "players": None})
    reports = silver.guild_reports(landed(spark, "guild_reports", {"code": "Q"}))
    assert flat(silver.raid_attendance(raw, reports), "player_name", "presence_status", "zone_name") == [
        ("Ann", "present", None), ("Bob", "benched", None), ("Cy", "absent", None), ("Di", "absent", None)]


def details(**roles):
    return {"report_code": "R", "fight_id": 1, "difficulty": 5, "player_details_json": json.dumps({"data": {"playerDetails": roles}})}


def test_player_details(spark):
    ann = {"id": 1, "name": "Ann ", "type": "Shaman", "specs": [], "minItemLevel": 600, "maxItemLevel": 605,
           "combatantInfo": {"stats": {"Crit": {"min": 7}}, "gear": [{"temporaryEnchant": 5400, "temporaryEnchantName": ""}, {"temporaryEnchantName": " Oil of Dawn "},
                                                                     {"temporaryEnchantName": "Plain"}, {"temporaryEnchant": 1}]}}
    bob = {"id": 2, "name": "Bob", "type": "Mage", "specs": [{"spec": "Frost"}]}
    raw = landed(spark, "player_details", details(dps=[ann, bob], healers=[], tanks=[{**bob, "specs": [{"spec": "Arcane"}]}]), details(dps=None) | {"player_details_json": "{bad"})
    got = silver.player_performance(raw)
    assert flat(got, "player_name", "spec", "avg_item_level", "has_weapon_enhancement", "weapon_enhancement_names", "crit_rating", "_duplicate_count") == [
        ("Ann", None, 602.5, True, "Oil of Dawn | Flametongue Weapon", 7, 1), ("Bob", "Arcane", None, False, None, None, 2)]
    assert payloads.corrupt_rows(raw, "player_details_json", "player_details").count() == 1


def rankings(code, dps, hps="same", when="2024-01-01T00:00:00"):
    def payload(chars):
        return json.dumps({"data": [{"fightID": 1, "roles": chars}]})

    return {"report_code": code, "rankings_json": payload(dps), "rankings_hps_json": None if hps is None else payload(hps if hps != "same" else {}), "_ingested_at": when}


def chars(*percents):
    return {"characters": [{"name": f"p{i}{p}", "rank": "~1265", "rankPercent": p} for i, p in enumerate(percents)]}


def test_rankings_take_healers_from_second_metric_and_newest_landing(spark):
    raw = landed(spark, "fight_rankings", rankings("R", {"dps": chars(1.0), "healers": chars(9.0)}, {"healers": chars(50.0)}, "2024-01-02T00:00:00"),
                 rankings("R", {"dps": chars(2.0, 3.0)}), rankings("L", {"tanks": chars(None), "healers": chars(4.0)}, None))
    assert flat(silver.player_rankings(raw), "report_code", "role", "rank_percent", "rank_string") == [
        ("L", "tank", None, "~1265"), ("R", "dps", 1.0, "~1265"), ("R", "healer", 50.0, "~1265")]
    assert silver.player_rankings(raw.drop("rankings_hps_json")).filter("role = 'healer'").count() == 0


def test_parse_completeness_and_decision(spark):
    raw = landed(spark, "fight_rankings", rankings("null", {"dps": chars(None, None)}), rankings("part", {"dps": chars(*[1.0] * 9, None)}, {"healers": chars(None)}),
                 rankings("full", {"dps": chars(*[1.0] * 9, None)}, {"healers": chars(5.0)}), rankings("legacy", {"dps": chars(1.0)}, None))
    got = parse_completeness(raw)
    assert flat(got, "report_code", "incomplete_fights", "total_fights", "null_chars", "total_chars") == [
        ("full", 0, 1, 1, 11), ("legacy", 1, 1, 0, 0), ("null", 1, 1, 2, 2), ("part", 1, 1, 2, 11)]
    aged = got.withColumn("file_age_days", F.when(F.col("report_code") == "part", 14).otherwise(1))
    assert flat(backfill_decision(aged), "report_code", "decision") == [("full", "skip_complete"), ("legacy", "refetch"), ("null", "refetch"), ("part", "accept_final")]


def deaths(ids, *entries):
    return {"report_code": "R", "fight_ids": ids, "table_json": json.dumps({"data": {"entries": list(entries)}})}


def test_deaths(spark):
    hit = {"type": "damage", "sourceIsFriendly": False, "ability": {"name": "Smash", "guid": 9}}
    ann = {"name": "Ann", "fight": 1, "timestamp": 50, "events": [{"type": "heal"}, {**hit, "sourceIsFriendly": True}, hit, {**hit, "ability": {"name": "Old"}}]}
    raw = landed(spark, "fight_deaths", deaths([1], ann, {"name": "Bob", "fight": 1, "timestamp": 60, "events": []}, {"name": None}), deaths([1], ann),
                 deaths([1, 2], {"name": "Gone", "fight": 2, "timestamp": 1}), {"report_code": "S", "fight_ids": None, "table_json": json.dumps({"data": {"entries": [{"name": "Kept"}]}})})
    assert flat(silver.player_deaths(raw), "report_code", "player_name", "killing_blow_name", "_duplicate_count") == [
        ("R", "Ann", "Smash", 2), ("R", "Ann", "Smash", 2), ("R", "Bob", None, 1), ("S", "Kept", None, 1)]


@pytest.fixture(scope="module")
def fight_world(spark):
    fights = spark.createDataFrame([("R", 1, 0, 100, [1, 2]), ("R", 2, 200000, 100, [1, 2])],
                                   "report_code STRING, fight_id BIGINT, fight_start_ms BIGINT, duration_seconds INT, friendly_player_ids ARRAY<BIGINT>")
    for name, value in (("encounter_id", 5), ("difficulty", 4), ("zone_id", 1)):
        fights = fights.withColumn(name, F.lit(value).cast("bigint"))
    for name in ("boss_name", "zone_name", "difficulty_label", "_ingested_at"):
        fights = fights.withColumn(name, F.lit(name))
    fights = fights.withColumn("raid_night_date", F.lit("2024-01-01").cast("date")).withColumn("is_kill", F.lit(False))
    actors = spark.createDataFrame([("R", 1, "Ann", "DemonHunter", "X"), ("R", 2, "Bob", "Warrior", None)], "report_code STRING, actor_id BIGINT, player_name STRING, player_class STRING, realm STRING")
    return fights, actors


def casts_record(casts=(), combatants=()):
    return {"report_code": "R", "fight_ids": [1, 2], "events_json": json.dumps({"data": list(casts)}), "buffs_json": json.dumps({"data": []}),
            "combatant_info_json": json.dumps({"data": list(combatants)})}


def test_casts_find_their_pull_by_id_or_time(spark, fight_world):
    fights, actors = fight_world
    raw = landed(spark, "fight_casts", casts_record([
        {"timestamp": 5, "sourceID": 1, "fight": 2, "abilityGameID": 7}, {"timestamp": 200001, "sourceID": 1, "abilityGameID": 8}, {"timestamp": 150000, "sourceID": 2, "ability": {"guid": 9, "name": "n"}},
        {"timestamp": 5, "sourceID": 77, "fight": 1, "abilityGameID": 7}, {"timestamp": 5, "sourceID": 1, "fight": 1}, {"timestamp": 5, "sourceID": 1, "fight": 2, "abilityGameID": 7}]))
    got = silver.player_cast_events(silver.parsed_casts(raw), fights, actors)
    assert flat(got, "fight_id", "cast_timestamp_ms", "player_name", "ability_id") == [(2, 200001, "Ann", 8), (2, 5, "Ann", 7), (None, 150000, "Bob", 9)]


def capacity(spark, fight_world, casts, combatants):
    fights, actors = fight_world
    raw = landed(spark, "fight_casts", casts_record(casts, combatants))
    done = silver.player_cast_events(silver.parsed_casts(raw), fights, actors)
    buffs = silver.player_combatant_buffs(silver.parsed_combatants(raw), fights, actors)
    return silver.player_cooldown_capacity(fights, actors, done, buffs), done


def test_cooldown_states(spark, fight_world):
    # Only pull 1 has casts. Ann: spec 581 with no talents; Bob: no combatant info.
    got, _ = capacity(spark, fight_world, [{"timestamp": 10, "sourceID": 1, "fight": 1, "abilityGameID": 203720}, {"timestamp": 20, "sourceID": 1, "fight": 1, "abilityGameID": 196718}],
                      [{"timestamp": 1, "source": {"id": 1}, "fight": 1, "specID": 581, "talentTree": [], "auras": [{"name": "Well Fed"}]}])
    rows = {(r.player_name, r.ability_id): r for r in got.collect()}
    assert {r.fight_id for r in rows.values()} == {1}
    assert rows["Ann", 203720].cooldown_tracking_state == "tracked"
    assert (rows["Ann", 203720].possible_casts, rows["Ann", 203720].actual_casts, rows["Ann", 203720].over_capacity_casts) == (8, 1, 0)  # 100 // 15 + 2
    assert rows["Ann", 198589].cooldown_tracking_state == "untracked_spec_ineligible"
    assert rows["Ann", 196718].cooldown_tracking_state == "tracked"  # talent missing, but cast seen
    assert (rows["Ann", 187827].has_tracked_capacity, rows["Ann", 187827].has_scored_capacity, rows["Ann", 187827].possible_casts) == (True, False, 0)
    assert rows["Bob", 97462].cooldown_tracking_state == "unknown_missing_combatant_info"


def test_talent_missing_is_untracked(spark, fight_world):
    got, _ = capacity(spark, fight_world, [{"timestamp": 10, "sourceID": 1, "fight": 1, "abilityGameID": 1}],
                      [{"timestamp": 1, "sourceID": 1, "fight": 1, "specID": 581, "talentTree": [{"id": 5}]}, {"timestamp": 2, "sourceID": 2, "fight": 1, "specID": 71, "talentTree": [{"talentID": 118038}]}])
    states = {(r.player_name, r.ability_id): r.cooldown_tracking_state for r in got.collect()}
    assert states["Ann", 196718] == "untracked_talent_missing"
    assert states["Bob", 118038] == "tracked" and states["Bob", 184364] == "untracked_spec_ineligible"


@pytest.mark.parametrize("mode,available", [("latest_cast", 0), ("any_cast", 1)])
def test_survival_modes(spark, fight_world, mode, available):
    # Cast long ago and just now: only the literal older rule calls it available.
    fights, actors = fight_world
    capacity_rows, done = capacity(spark, fight_world, [{"timestamp": 0, "sourceID": 1, "fight": 1, "abilityGameID": 204021}, {"timestamp": 95000, "sourceID": 1, "fight": 1, "abilityGameID": 204021}],
                                   [{"timestamp": 1, "sourceID": 1, "fight": 1, "specID": 581}])
    capacity_rows = capacity_rows.filter("ability_id = 204021")
    death = fights.filter("fight_id = 1").select("report_code", "fight_id", "encounter_id", "boss_name", "zone_name", "zone_id", "difficulty", "difficulty_label", "raid_night_date", "is_kill", "fight_start_ms").select(
        "*", F.lit("ann:demonhunter:x").alias("player_identity_key"), F.lit("Ann").alias("player_name"), F.lit("DemonHunter").alias("player_class"), F.lit("X").alias("realm"),
        F.lit(99000).cast("bigint").alias("death_timestamp_ms"), F.lit("b").alias("killing_blow_name"), F.lit(1).cast("bigint").alias("killing_blow_id"))
    row = gold_wipes.wipe_survival_events(death, capacity_rows, done, actors, mode).first()
    assert (row.defensive_active_at_death, row.defensive_available_at_death, row.last_defensive_cast_before_death_ms) == (1, available, 95000)


def test_latest_cast_payload(spark):
    raw = landed(spark, "fight_casts", casts_record(), {**casts_record(), "_ingested_at": "2024-02-01T00:00:00", "fight_ids": [9]})
    assert [r.fight_ids for r in gold_wipes.latest_cast_payloads(raw).collect()] == [[9]]


def test_zone_catalog_frozen_and_duplicates(spark):
    raw = landed(spark, "zone_catalog", {"id": 1, "name": "Z", "frozen": True, "encounters": [{"id": 5, "name": "A"}, {"id": 5, "name": "A"}, {"id": None}], "difficulties": [{"name": "Normal"}]}, {"id": 2, "encounters": None})
    assert flat(silver.zone_catalog(raw), "zone_id", "encounter_id", "difficulty_names") == [(1, 5, ["Normal"])]


def test_members_unknown_codes_and_newest_snapshot(spark):
    raw = landed(spark, "guild_members", {"name": "Ann", "rank": 10, "class_id": 99}, {"name": "Ann", "rank": 8, "class_id": 7, "_ingested_at": "2024-02-01T00:00:00"},
                 {"name": "Bob", "rank": 10, "class_id": 99}, {"name": None, "rank": 1}, {"name": "Cy"})
    assert flat(silver.guild_members(raw), "name", "rank_label", "rank_category", "is_raid_team", "class_name") == [
        ("Ann", "Trial", "Trial", True, "Shaman"), ("Bob", "Rank 10", "Social", False, None)]


def test_media_with_missing_key(spark):
    raw = landed(spark, "character_media", {"player_name": "Ann", "realm_slug": "x", "media_json": json.dumps({"assets": [{"key": "main", "value": "u"}]})},
                 {"player_name": "Bob", "realm_slug": "x", "media_json": json.dumps({"assets": []})})
    assert flat(silver.character_media(raw), "player_name", "avatar_url", "main_url") == [("Ann", None, "u"), ("Bob", None, None)]


def test_equipment_empty_and_null_levels(spark):
    raw = landed(spark, "character_equipment", {"player_name": "Ann", "equipment_json": json.dumps({"equipped_items": []})},
                 {"player_name": "Bob", "equipment_json": json.dumps({"equipped_items": [{"level": {"value": 10}, "enchantments": [{"id": 3}, {"enchantment_id": 4, "id": 5}], "item": {"id": 7}}, {"level": None}]})})
    equipment = silver.character_equipment(raw)
    assert flat(equipment, "player_name", "avg_item_level", "equipped_item_count") == [("Ann", 0.0, 0), ("Bob", 5.0, 2)]
    icons = spark.createDataFrame([(7, "i")], "item_id BIGINT, icon_url STRING")
    items = gold_profile.player_character_equipment(equipment, icons)
    assert flat(items, "item_id", "icon_url", "enchantments_json")[0] == (
        7, "i", '[{"display_string":"","source_item_name":"","enchantment_id":3},{"display_string":"","source_item_name":"","enchantment_id":4}]')
    assert items.count() == 2


def test_achievements_completed_by_flag_or_time(spark):
    feats = [{"id": 1, "achievement": {"name": "Cutting Edge: A"}, "criteria": {"is_completed": True}}, {"id": 2, "achievement": {"id": 20, "name": "Famed Bane"}, "completed_timestamp": 5},
             {"id": 3, "achievement": {"name": "Famed Slayer"}}, {"id": 4, "achievement": {"name": "Other"}, "completed_timestamp": 5}]
    raw = landed(spark, "character_achievements", {"player_name": "Ann", "achievements_json": json.dumps({"total_points": 3, "achievements": feats})})
    got = silver.character_achievements(raw)
    assert flat(got, "total_quantity", "total_points") == [(None, 3)]
    assert flat(gold_profile.player_raid_achievements(got), "achievement_id", "completed_timestamp") == [(1, None), (20, 5)]


def test_runs_in_both_lists_count_once(spark):
    run = {"dungeon": "D", "mythic_level": 10, "completed_at": "2024-01-01T10:00:00Z", "clear_time_ms": 9, "par_time_ms": 5, "num_keystone_upgrades": 0}
    raw = landed(spark, "raiderio_character_profiles",
                 {"player_name": "Ann", "realm_slug": "x", "region": "EU", "profile_json": json.dumps({"mythic_plus_recent_runs": [run, {**run, "dungeon": "E", "par_time_ms": None}], "mythic_plus_best_runs": [run]})},
                 {"player_name": "Bob", "realm_slug": "x", "profile_json": json.dumps({"region": "US"})})
    assert flat(silver.mplus_runs(raw), "player_name", "dungeon", "source", "timed", "region") == [("Ann", "D", "best", True, "eu"), ("Ann", "E", "recent", False, "eu")]
    assert flat(silver.mplus_scores(raw), "player_name", "region", "score_all") == [("Ann", "eu", None), ("Bob", "us", None)]


def sheet_rows(spark, *texts):
    raw = spark.createDataFrame([("s", str(i), t, "2024-01-01T00:00:00") for i, t in enumerate(texts)], "sheet_id STRING, gid STRING, csv_text STRING, _ingested_at STRING")
    return flat(silver.live_raid_roster(raw), "name", "roster_rank", "player_class", "race", "note", "source_refreshed_at")


def test_sheet(spark):
    row = ["Ann", "", "", "Raider", "", "Mage"] + [""] * 113 + ["Elf", '"late, ""often"""']
    texts = ["a,b", "title\nrefreshed, now ,x\n" + ",".join(row) + "\nann,,,Other\n\n Bob ,,,Trial\n,,,x", "", None]
    assert sheet_rows(spark, *texts) == [("Ann", "Raider", "Mage", "Elf", 'late, "often"', "now"), ("Bob", "Trial", "", "", "", "now")]


def test_sheet_agrees_with_a_csv_reader(spark):
    import csv
    import io
    import random

    from emberlog.sources.sheet import POSITIONS

    draw = random.Random(2)
    texts = []
    for _ in range(40):
        lines = [["".join(draw.choice('ab ,"\n\r') for _ in range(draw.randrange(5))) for _ in range(122)] for _ in range(4)]
        out = io.StringIO()
        csv.writer(out, lineterminator=draw.choice(["\n", "\r\n"])).writerows([["title"], ["x", "today"], *lines])
        texts.append(out.getvalue())
    want = []
    for text in texts:
        seen = set()
        for cells in list(csv.reader(io.StringIO(text, newline="")))[2:]:
            cells = [c.strip() for c in cells] + [""] * 122
            if cells[0] and cells[0].lower() not in seen:
                seen.add(cells[0].lower())
                want.append((*(cells[i] for i in POSITIONS.values()), "today"))
    assert sorted(sheet_rows(spark, *texts)) == sorted(want)


def test_combat_potions_by_name_or_id(spark, fight_world):
    _, actors = fight_world
    events = spark.createDataFrame([("R", 1, 5, 1, "Light's  Potential", 0), ("R", 1, 5, 1, "Light's  Potential", 0), ("R", 1, 9, 1, "?", 1237154), ("R", 1, 9, 1, "No", 3), ("R", 1, 9, 55, "x", 1237154)],
                                   "report_code STRING, fight_id BIGINT, timestamp_ms BIGINT, actor_id BIGINT, ability_name STRING, ability_id BIGINT")
    assert flat(gold_core.combat_potions(events, actors), "player_name", "combat_potion_casts", "combat_potion_names") == [("Ann", 2, "? | Light's  Potential")]


def test_stale_landings(spark):
    wanted = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("d", 1)], "report_code STRING, fight_id BIGINT")
    have = spark.createDataFrame([("a", [1], "x"), ("b", [1], None), ("d", [1], "x")], "report_code STRING, fight_ids ARRAY<BIGINT>, buffs STRING")
    assert flat(stale_landings(wanted, have, ("buffs",)), "report_code", "missing_fights", "never_landed", "payload_absent") == [
        ("a", 1, False, False), ("b", 0, False, True), ("c", 1, True, False)]


def test_item_level_falls_back(spark):
    from emberlog.plans.views import item_levels

    gear = spark.createDataFrame([("Ann", "HEAD", 10), ("Ann", "SHIRT", 900), ("Bob", "TABARD", 900)], "player_name STRING, slot_type STRING, item_level BIGINT")
    roster = spark.createDataFrame([("Bob", 20.0, "2024-01-01", "a", 1), ("Bob", 0.0, "2024-01-02", "b", 1), ("Ann", 5.0, "2024-01-01", "a", 1)],
                                   "player_name STRING, avg_item_level DOUBLE, raid_night_date STRING, report_code STRING, fight_id INT")
    summary = spark.createDataFrame([("Cy", 30.0), ("Bob", 7.0)], "player_name STRING, avg_item_level DOUBLE")
    assert flat(item_levels(gear, roster, summary), "player_name", "item_level") == [("Ann", 10.0), ("Bob", 20.0), ("Cy", 30.0)]


def test_missing_auras_or_talents_keep_the_other(spark, fight_world):
    fights, actors = fight_world
    raw = landed(spark, "fight_casts", casts_record((), [{"timestamp": 1, "sourceID": 1, "fight": 1, "talentTree": [{"id": 5}]}, {"timestamp": 1, "sourceID": 2, "fight": 1, "auras": [{"name": "Well Fed"}]},
                                                         {"timestamp": 1, "sourceID": 2, "fight": 2}]))
    got = silver.player_combatant_buffs(silver.parsed_combatants(raw), fights, actors)
    assert flat(got, "player_name", "fight_id", "talent_spell_ids", "has_food_buff", "food_buff_names") == [
        ("Ann", 1, ["5"], False, None), ("Bob", 1, [], True, "Well Fed"), ("Bob", 2, [], False, None)]


def test_completeness_counts_the_newest_landing_of_a_report_only(spark):
    old, new = "2023-05-01T00:00:00", "2023-06-01T00:00:00"
    raw = landed(spark, "fight_rankings", rankings("early", {"dps": chars(1.0, 2.0)}, when=old), rankings("twice", {"dps": chars(None, None)}, when=old),
                 rankings("twice", {"dps": chars(5.0)}, when=new), rankings("twice", {"dps": chars(5.0)}, when=new))
    got = parse_completeness(raw)
    assert flat(got, "report_code", "incomplete_fights", "total_fights", "null_chars", "total_chars") == [("early", 0, 1, 0, 2), ("twice", 0, 1, 0, 1)]
    ages = file_ages(raw, F.lit("2023-06-11").cast("date"))
    assert flat(got.join(ages, "report_code"), "report_code", "file_age_days") == [("early", 41), ("twice", 10)]
