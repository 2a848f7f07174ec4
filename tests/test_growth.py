"""Steps whose work must grow no faster than their input: what is shuffled, stored and held in memory."""

from __future__ import annotations

import contextlib
import io
import os
import time

import pytest

from emberlog import rules, session
from emberlog.plans import gold_wipes, pipeline, publish, silver, views
from emberlog.sources import sinks
from emberlog.workload import q_gold, q_quality
from emberlog.workload.domain import Domain


def explained(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


FIGHTS = ("report_code STRING, fight_id BIGINT, encounter_id BIGINT, boss_name STRING, zone_name STRING, zone_id BIGINT, difficulty BIGINT, "
          "difficulty_label STRING, raid_night_date STRING, duration_seconds INT, is_kill BOOLEAN, _ingested_at STRING, friendly_player_ids ARRAY<BIGINT>")


def capacity(spark):
    fight = ("b", "z", 1, 3, "Normal", "2024-01-01", 200, False, "t")
    fights = spark.createDataFrame([("r", 1, 1, *fight, [1, 2, 3]), ("r", 2, 1, *fight, [1]), (None, 3, 1, *fight, [1])], FIGHTS)
    actors = spark.createDataFrame([("r", 1, "Ann", "DemonHunter"), ("r", 2, "Bob", "DemonHunter"), ("r", 2, "Bob", "DemonHunter"), ("r", 3, None, "DemonHunter")],
                                   "report_code STRING, actor_id BIGINT, player_name STRING, player_class STRING")
    casts = spark.createDataFrame([("r", 1, "Ann", 198589, 5), ("r", 1, "Ann", 198589, 9), ("r", None, "Bob", 198589, 7), ("r", 2, "Ann", None, 1), ("r", 2, "Ann", 6262, 1)],
                                  "report_code STRING, fight_id BIGINT, player_name STRING, ability_id BIGINT, cast_timestamp_ms BIGINT")
    buffs = spark.createDataFrame([("r", 1, "Ann", 577, ["1"]), ("r", 1, "Ann", 581, None)],
                                  "report_code STRING, fight_id BIGINT, player_name STRING, spec_id BIGINT, talent_spell_ids ARRAY<STRING>")
    return silver.player_cooldown_capacity(fights, actors, casts, buffs)


def test_capacity_counts_casts_with_null_and_repeated_keys(spark):
    found = capacity(spark).filter("ability_id = 198589").select("fight_id", "player_name", "spec_id", "observed_casts", "last_cast_on_pull_ms", "cast_seen_in_report")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        (1, "Ann", 577, 2, 9, True), (1, "Ann", 581, 2, 9, True), (1, "Bob", None, 0, None, True), (1, "Bob", None, 0, None, True),
        (1, None, None, 0, None, False), (2, "Ann", None, 0, None, True)], key=str)


def test_nothing_is_shuffled_once_rules_multiply_the_rows(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = explained(capacity(spark)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    ruled = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "player_class" in line)
    assert not any("hashpartitioning" in line for line in lines[:ruled])
    assert sum("ability_id" in line for line in lines if "Exchange hashpartitioning" in line) <= 2


def test_published_files_are_short_enough_to_be_hashed_whole(spark, tmp_path):
    root, rows = str(tmp_path), 2 * rules.MAX_FILE_ROWS + 1
    sinks.write_json(spark.range(rows).coalesce(1), f"{root}/snapshots/snapshot_id=s1/ids")
    listed = publish.data_files(spark, root, "s1").first()
    assert listed["dataset"] == "ids" and len(listed["files"]) == 3
    for f in listed["files"]:
        assert spark.read.text(f"{root}/snapshots/snapshot_id=s1/ids/{f['name']}").count() <= rules.MAX_FILE_ROWS
    assert spark.read.json(f"{root}/snapshots/snapshot_id=s1/ids").distinct().count() == rows


def test_scores_are_worked_out_once_before_they_are_graded(spark):
    scores = spark.range(9).selectExpr("concat('p', id) AS player_identity_key", "'z' AS zone_name", "'b' AS boss_name", "'All' AS difficulty_label", "CAST(id AS DOUBLE) AS survival_discipline_score")
    graded = views.relative_grades(scores)
    assert "Range" not in explained(graded)
    assert [r[0] for r in graded.orderBy("survival_discipline_score").select("survival_grade").collect()] == list("FEEDCBAAS")


def test_shared_tables_are_worked_out_once(spark, sf_dir, monkeypatch):
    made = []
    monkeypatch.setattr(pipeline, "stored", lambda df: made.append(df) or df)
    tables = q_quality._shared_tables(Domain(spark, sf_dir))
    assert set(tables.store) == set(pipeline.TABLES)
    for name in ("gold_guild_roster", "gold_raid_team", "dim_guild_member", "gold_raid_summary", "gold_weekly_activity"):
        tables[name]
    # two dimensions, reports, fights, actors, members, attendance, performance, and the four gold tables
    assert len(made) == len({id(df) for df in made}) == 12
    assert {"gold_raid_team", "silver_actor_roster"} <= set(q_gold.SHARED)


def test_discipline_inputs_are_read_once(spark, monkeypatch):
    keys = "player_identity_key STRING, player_name STRING, player_class STRING, realm STRING, zone_name STRING, encounter_id BIGINT, boss_name STRING, difficulty BIGINT, difficulty_label STRING"
    counts = spark.range(2).selectExpr("concat('p', id) AS player_identity_key", "'P' AS player_name", "'Mage' AS player_class", "'r' AS realm", "'z' AS zone_name", "1L AS encounter_id",
                                       "'b' AS boss_name", "3L AS difficulty", "'Normal' AS difficulty_label", *[f"4L AS {c}" for c in gold_wipes._ADDITIVE])
    monkeypatch.setattr(gold_wipes, "discipline_counts", lambda *_: counts)
    survival = spark.createDataFrame([], f"{keys}, killing_blow_name STRING")
    roster = spark.createDataFrame([], "player_identity_key STRING, role STRING, raid_night_date STRING, report_code STRING, fight_id BIGINT")
    scored = gold_wipes.wipe_survival_discipline(None, survival, None, roster, None)
    assert "Range" not in explained(scored)
    assert scored.count() == 2 * len(gold_wipes.DISCIPLINE_SETS)


def test_stored_tables_leave_no_shuffle_files(spark):
    """A job of many steps must not hold the shuffles of all of them."""
    def files():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    before = files()
    table = session.stored(spark.range(1000).repartition(7))
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before and table.count() == 1000
    assert spark.conf.get(session.FREE_SHUFFLES, None) != "true"


def test_discarded_tables_leave_no_files(spark):
    with session.collected() as made:
        table = session.stored(spark.range(5))
    path = table.stored_path.removeprefix("file:")
    assert made == [table] and os.path.isdir(path)
    session.discard(table, table, spark.range(1))
    assert not os.path.exists(path)


def test_tables_go_after_their_last_reader(spark):
    made = []

    def build(*inputs):
        made.append(len(inputs))
        return session.stored(inputs[0]) if inputs else spark.range(3)  # a step of its own

    t = pipeline.Catalog(store=("base", "left", "right", "top"))
    t.builds = {"base": (build, ()), "left": (build, ("base",)), "right": (build, ("base", "left")), "top": (build, ("right", "right"))}
    t.only_for(["left", "top", "top"])
    folder = {n: t[n].stored_path.removeprefix("file:") for n in ("base", "left")}
    assert all(map(os.path.isdir, folder.values()))
    t.release("left")
    folder["right"] = t["right"].stored_path.removeprefix("file:")
    assert "base" not in t and "left" not in t and not os.path.exists(folder["base"]) and not os.path.exists(folder["left"])
    assert t["top"].count() == 3 and not os.path.exists(folder["right"])
    t.release("top")
    assert t["top"].count() == 3 and len(made) == 4
    t.release("top")
    assert "top" not in t
    with pytest.raises(ValueError, match="not stored"):
        pipeline.Catalog().only_for(["gold_raid_team"])


def test_text_is_counted_slice_by_slice(spark, tmp_path, monkeypatch):
    sizes, real = [], publish.write_json
    monkeypatch.setattr(publish, "write_json", lambda df, path: (real(df, path), sizes.append(publish.files.byte_count(spark, path))))
    table = session.stored(spark.range(3000).selectExpr("id", "md5(CAST(id AS STRING)) AS text").repartition(6))
    whole = publish.dataset_sizes({"a": table}).first()["byte_size"]
    assert publish.written_bytes(table, f"{tmp_path}/a", 1) + 1 == whole
    assert len(sizes) == 6 and max(sizes) < whole / 3 and not os.path.exists(f"{tmp_path}/a")
    assert publish.written_bytes(table, f"{tmp_path}/b") + 1 == whole and len(sizes) == 7


def test_publish_releases_a_table_after_its_dataset(spark, tmp_path, monkeypatch):
    released, at = [], []
    monkeypatch.setattr(publish, "DATASETS", {"a": ("one", lambda df: df), "b": ("two", lambda df: df)})
    monkeypatch.setattr(publish, "REQUIRED", {})
    real = publish.write_json
    monkeypatch.setattr(publish, "write_json", lambda df, path: (real(df, path), at.append(list(released))))
    listed = publish.publish(spark, {"one": spark.range(3), "two": spark.range(4)}, str(tmp_path), "s1", "t", ("a", "b"), release=released.append)
    assert released == ["one", "two"] and at == [[], ["one"]]
    assert {r["dataset"]: r["row_count"] for r in listed.collect()} == {"a": 3, "b": 4}
