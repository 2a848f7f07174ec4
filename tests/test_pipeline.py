"""Contracts, publishing, streams and the whole build."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from emberlog.operators import rows
from emberlog.plans import pipeline, publish, silver
from emberlog.quality import contracts
from emberlog.quality.contracts import Contract, Field
from emberlog.quality.expectations import expect, expect_or_drop, expectation_report
from emberlog.sources import sinks
from emberlog.streaming import tables as stream
from emberlog.workload.domain import Domain
from emberlog.workload.q_operators import _BUILDERS


def found(df, contract):
    return {(r.check, r.subject): r.violations for r in contracts.failed(contracts.contract_report(df, contract)).collect()}


@pytest.mark.parametrize("data,want", [
    ([(1, "Normal", "5")], {}),
    ([(None, "Normal", "5")], {("null", "id"): 1, ("null_key", "id"): 1}),
    ([(1, "", "5")], {("empty", "level"): 1, ("enum", "level"): 1}),
    ([(1, "Normal", ""), (2, "Normal", None)], {}),
    ([(1, "Normal", "x"), (2, "Normal", "1.5")], {("type", "n"): 1}),
    ([(1, "Normal", "1"), (1, "Heroic", "2")], {("duplicate_key", "id"): 1}),
    ([(1, "Easy", "1")], {("enum", "level"): 1}),
    ([(-1, "Normal", "1")], {("rule", "positive"): 1}),
])
def test_contract_checks(spark, data, want):
    contract = Contract("t", "1", {"id": Field("integer"), "level": Field("string"), "n": Field("number", True, True)}, ("id",),
                        {"level": ("Normal", "Heroic")}, {"positive": "id is None or max(id, 0) == id"})
    assert found(spark.createDataFrame(data, "id INT, level STRING, n STRING"), contract) == want


def test_contract_missing_column_and_projection(spark):
    contract = Contract("t", "1", {"a": Field("integer"), "b": Field("integer")}, ("a", "b"), {}, {"sum": "a + b > 0", "own": "a != 3"})
    df = spark.createDataFrame([(3,)], "a INT")
    assert found(df, contract) == {("missing_column", "b"): 1, ("rule", "own"): 1}
    assert found(df, contract.project(["a"])) == {("rule", "own"): 1}
    with pytest.raises(ValueError):
        contracts.row_condition("len(a) > 0")
    rows = spark.createDataFrame([(-3, "min", None), (5, "x == 'y'", 1)], "a int, s string, n int")
    for rule, want in {"s == 'min'": [True, False], "n == None": [True, False], "n != None": [False, True], "0 <= a < 6": [False, True], "a % 4 == 1": [True, True],
                       "max(a, 0) == 0 or not a > 1": [True, False], "abs(-a) == 3 and s != \"x == 'y'\"": [True, False]}.items():
        assert [r.ok for r in rows.select(contracts.row_condition(rule).alias("ok")).collect()] == want, rule
    assert contracts.names_in('a != "b" or max(c, 1) == 2') == {"a", "c"}


def test_table_rules_are_observed_while_written(spark, tmp_path):
    from emberlog.quality.expectations import METRICS, TABLE_RULES, collecting, hold
    from emberlog.sources.landing import FOLDERS

    assert {n for n in pipeline.SILVER if "payload" not in n} | {f"bronze_{f}" for f in FOLDERS} == set(TABLE_RULES)
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 3)], "name STRING, x INT")
    with collecting() as seen:
        kept = hold(df, "silver_live_raid_roster", "drop")
    kept.write.parquet(f"{tmp_path}/kept")
    assert seen.rows() == [("silver_live_raid_roster", "drop", "valid_name", 3, 2, 2)]
    assert spark.createDataFrame(seen.rows(), METRICS).count() == 1
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 1
    assert hold(df, "silver_live_raid_roster", "drop").count() == 1  # outside nothing is observed


def test_stream_progress_reports_the_rules(spark, tmp_path):
    write_lines(f"{tmp_path}/landing/actor_roster", "a.json", actors("R", 1), {"report_code": None, "actors": []}, {"report_code": "S", "_ingested_at": None})
    seen = stream.ingest_bronze(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", ("actor_roster",))
    assert sorted((r.table_name, r.action, r.rule, r.total_rows, r.failed_rows) for r in seen.collect()) == [
        ("bronze_actor_roster", "warn", "has_ingested_at", 3, 1), ("bronze_actor_roster", "warn", "has_report_code", 3, 1)]
    query = stream.run_available(stream.stream_actors(spark, f"{tmp_path}/bronze"), f"{tmp_path}/silver", f"{tmp_path}/state")
    from emberlog.quality.expectations import streamed_rows

    assert {(r[0], r[1], r[2]): r[3:] for r in streamed_rows(query)}["silver_actor_roster", "drop", "valid_player_name"] == (1, 0, 0)


def test_expectations_count_and_drop(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1,), (None,), (5,)], "x INT")
    seen = Observation("t")
    assert expect(df, {"small": "x < 3"}, seen).count() == 3 and seen.get == {"rows": 3, "small": 2}
    assert [r.x for r in expect_or_drop(df, {"small": "x < 3"}).collect()] == [1]
    assert expectation_report(df, {"small": "x < 3"}).first().failed_rows == 2


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("Z", 1, ["a"], 1704067200)], "zone_name STRING, n INT, l ARRAY<STRING>, s BIGINT").select(
        "zone_name", F.col("n").cast("decimal(5,2)").alias("n"), "l", F.timestamp_seconds("s").alias("at"), F.lit(None).cast("string").alias("gone"))
    sinks.write_json(df, f"{tmp_path}/j")
    lines = [json.loads(x) for f in os.listdir(f"{tmp_path}/j") if f.endswith(".json") for x in open(f"{tmp_path}/j/{f}")]
    assert lines == [{"zone_name": "Z", "n": 1.0, "l": ["a"], "at": "2024-01-01T00:00:00Z", "gone": None}]
    sinks.write_csv(df.unionByName(df.withColumn("zone_name", F.lit("Blackrock Depths"))), f"{tmp_path}/c")
    back = spark.read.option("header", "true").option("escape", "\"").csv(f"{tmp_path}/c").collect()  # quotes are doubled, as CSV readers expect
    assert [(r.zone_name, r.l) for r in back] == [("Z", '["a"]')]
    sinks.write_clustered(spark.range(1000), f"{tmp_path}/r", ["id"], parts=4)
    spans = spark.read.parquet(f"{tmp_path}/r").groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert len(spans) == 4 and all(x.b < y.a for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("second", ["b", "word"])
def test_z_order_keeps_files_narrow_in_the_second_column(spark, tmp_path, second):
    import pyarrow.parquet as pq

    df = spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104_729 % 1009).alias("b"))
    df = df.withColumn("word", F.concat(F.lit("w"), F.lpad(F.col("b").cast("string"), 5, "0"))).withColumn("a", F.when(F.col("a") > 3, F.col("a")))
    sinks.write_clustered(df, f"{tmp_path}/z", ["a", second], parts=16)
    df.repartitionByRange(16, "a", second).sortWithinPartitions("a", second).write.parquet(f"{tmp_path}/plain")
    wanted = 500 if second == "b" else "w00500"

    def groups_read(folder):
        """Row groups whose statistics let the filter through, and the rows that the scan then reads."""
        hit = 0
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                for i in range((meta := pq.ParquetFile(f"{folder}/{name}").metadata).num_row_groups):
                    column = next(c for j in range(meta.num_columns) if (c := meta.row_group(i).column(j)).path_in_schema == second)
                    hit += column.statistics.min <= wanted <= column.statistics.max
        scan = spark.read.parquet(folder).filter(F.col(second) == F.lit(wanted))
        rows_found = scan.collect()
        plan = scan._jdf.queryExecution().executedPlan()
        while plan.children().size():
            plan = plan.children().head()
        return hit, plan.metrics().apply("numOutputRows").value(), sorted(map(str, rows_found))

    z, plain = groups_read(f"{tmp_path}/z"), groups_read(f"{tmp_path}/plain")
    assert z[2] == plain[2] and z[0] <= 8 < plain[0] and z[1] < plain[1]
    assert spark.read.parquet(f"{tmp_path}/z").count() == 20_000


def test_sample_dump_reports_tables_that_fail(spark, tmp_path):
    def broken():
        raise RuntimeError("no access")

    tables = {"few": lambda: spark.range(3), "none": lambda: spark.range(0), "many": lambda: spark.range(1000), "lost": lambda: spark.read.parquet(f"{tmp_path}/nowhere"), "shut": broken,
              "late": lambda: spark.range(3).select(F.raise_error(F.lit("bad row")).cast("bigint").alias("id"))}
    got = {r.table_name: r for r in sinks.dump_samples(spark, tables, {t: ("id",) for t in tables}, f"{tmp_path}/dump", n=5).collect()}
    assert {t: (r.status, r.row_count) for t, r in got.items()} == {"few": ("ok", 3), "none": ("ok", 0), "many": ("ok", 1000), "lost": ("error", -1), "shut": ("error", -1), "late": ("error", -1)}
    assert got["shut"].note == "no access" and len(got["lost"].note) <= 120
    import hashlib

    want = sorted(range(1000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:5]
    assert [int(r.id) for r in spark.read.option("header", "true").csv(f"{tmp_path}/dump/many").collect()] == want


def write_lines(folder, name, *records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines(json.dumps({"_ingested_at": "2024-01-01T00:00:00", **r}) + "\n" for r in records)


def actors(code, *ids):
    return {"report_code": code, "actors": [{"id": i, "name": f"P{i}", "subType": "Mage"} for i in ids]}


def test_stream_in_two_drops_equals_batch(spark, tmp_path):
    landing, out = f"{tmp_path}/landing", f"{tmp_path}/bronze"

    def run():
        stream.ingest_bronze(spark, landing, out, ("actor_roster",))
        stream.run_available(stream.stream_actors(spark, out), f"{tmp_path}/silver", f"{tmp_path}/state")
        return {tuple(r) for r in spark.read.parquet(f"{tmp_path}/silver").select("report_code", "actor_id").collect()}, spark.read.parquet(f"{tmp_path}/silver").count()

    write_lines(f"{landing}/actor_roster", "a.json", actors("R", 1, 2), actors("R", 2))
    assert run() == ({("R", 1), ("R", 2)}, 2)
    write_lines(f"{landing}/actor_roster", "b.json", actors("R", 2, 3))
    assert run() == ({("R", 1), ("R", 2), ("R", 3)}, 3)  # state survives the restart
    assert run()[1] == 3  # nothing new, nothing read again
    batch = silver.actor_roster(spark.read.schema(stream.landing_schema("actor_roster")).json(f"{landing}/actor_roster"))
    assert batch.count() == 3


def test_rewritten_files_are_read_again(spark, tmp_path, monkeypatch):
    landing, out, ledger = f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/ledger"
    path = f"{landing}/actor_roster"

    def codes():
        count = stream.ingest_rewritten(spark, landing, "actor_roster", out, ledger)
        return count, sorted(r.report_code for r in spark.read.parquet(f"{out}/actor_roster").collect())

    write_lines(path, "a.json", actors("one", 1))
    write_lines(path, "b.json", actors("two", 1))
    assert codes() == (2, ["one", "two"])
    write_lines(path, "a.json", actors("one, corrected", 1))
    os.utime(f"{path}/a.json", (2_000_000_000, 2_000_000_000))
    assert codes() == (1, ["one", "one, corrected", "two"])
    monkeypatch.setattr(stream, "read_versions", lambda *a: pytest.fail("a file was opened"))
    assert codes() == (0, ["one", "one, corrected", "two"])


def test_rewritten_files_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "FILES_PER_READ", 2)
    for i in range(5):
        write_lines(f"{tmp_path}/landing/actor_roster", f"{i}.json", actors(f"R{i}", 1))
    args = (spark, f"{tmp_path}/landing", "actor_roster", f"{tmp_path}/bronze", f"{tmp_path}/ledger")
    assert [stream.ingest_rewritten(*args) for _ in range(2)] == [5, 0]
    assert spark.read.parquet(f"{tmp_path}/bronze/actor_roster").count() == 5
    assert spark.read.parquet(f"{tmp_path}/ledger").count() == 5


def test_newest_row_of_a_rewritten_file_by_file_time(spark):
    rows = spark.createDataFrame([("R", "t", 1, "old"), ("R", "t", 2, "new"), ("S", "u", 1, "only")], "code string, _ingested_at string, _modified_at int, title string")
    assert sorted((r.code, r.title) for r in stream.newest_rows(rows, ("code",)).collect()) == [("R", "new"), ("S", "only")]


def test_dedup_state_is_bounded_and_loses_nothing(spark, tmp_path):
    """Once the watermark has passed a key's arrival by the delay, it leaves the state, and its repeat comes through."""
    schema = "k STRING, _ingested_at STRING, at TIMESTAMP"
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def land(name, *lines):
        os.makedirs(source, exist_ok=True)
        with open(f"{source}/{name}", "w") as file:
            file.writelines(json.dumps(dict(zip(("k", "_ingested_at", "at"), x))) + "\n" for x in lines)
        frame = spark.readStream.schema(schema).json(source)
        once = rows.drop_repeats(frame, ["k"], ["_ingested_at"], "1 day", F.col("at")).drop("at")
        query = stream.run_available(once, out, f"{tmp_path}/state")
        states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return states[-1], sorted(tuple(r) for r in spark.read.parquet(out).select("k", "_ingested_at").collect())

    day = "2024-01-0{}T00:00:00Z".format
    assert land("a", ("x", "v1", day(1)), ("x", "v1", day(1)), ("y", "v1", day(1))) == (2, [("x", "v1"), ("y", "v1")])
    assert land("b", ("x", "v1", day(1)), ("x", "v0", day(1))) == (3, [("x", "v0"), ("x", "v1"), ("y", "v1")])  # an older version is one of its own
    land("c", ("z", "v1", day(4)))
    states, found = land("d", ("w", "v1", day(4)))
    assert states == 2 and {("w", "v1"), ("z", "v1")} < set(found)  # only what arrived within the delay is held
    assert land("e", ("x", "v1", day(5)))[1].count(("x", "v1")) == 2  # repeated after the delay; taken once on read
    newest = rows.dedup_ordered(spark.read.parquet(out), ["k"], ["_ingested_at"])
    assert sorted((r.k, r._ingested_at) for r in newest.collect()) == [("w", "v1"), ("x", "v1"), ("y", "v1"), ("z", "v1")]


def test_state_store_settings_are_put_back(spark):
    key = next(iter(stream.STATE))
    before = spark.conf.get(key, None)
    with stream.state_on_disk(spark):
        assert spark.conf.get(key) == stream.STATE[key]
    assert spark.conf.get(key, None) == before


def attendance(code, *names):
    return {"code": code, "players": [{"name": n, "presence": 1, "type": "Mage"} for n in names]}


def test_late_context_is_filled_in(spark, tmp_path):
    landing, bronze, path = f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/silver"
    reports = []

    def context():
        return spark.createDataFrame(reports, "code string, zone_id int, zone_name string, start_time_utc timestamp")

    def run():
        stream.ingest_bronze(spark, landing, bronze, ("raid_attendance",))
        table = stream.settled_attendance(spark, bronze, path, context)
        table.run(stream.stream_attendance(spark, bronze), f"{tmp_path}/state")
        return sorted((r.report_code, r.player_name, r.zone_name) for r in table.read().collect())

    write_lines(f"{landing}/raid_attendance", "a.json", attendance("R", "A", "B"), attendance("never", "C"))
    assert run() == [("R", "A", None), ("R", "B", None), ("never", "C", None)]
    reports.append(("R", 1, "Zone", None))
    assert run() == [("R", "A", "Zone"), ("R", "B", "Zone"), ("never", "C", None)]  # the report came alone
    assert run() == run()
    reports.append(("S", 2, "Other", None))
    write_lines(f"{landing}/raid_attendance", "b.json", attendance("S", "A"))
    assert run() == [("R", "A", "Zone"), ("R", "B", "Zone"), ("S", "A", "Other"), ("never", "C", None)]
    table = stream.settled_attendance(spark, bronze, path, context)
    before, last = sorted(map(tuple, table.read().collect()), key=repr), table._steps()[-1].removeprefix("step=")
    table.take(table.empty, last)  # a repeated step writes the same folder again
    assert sorted(map(tuple, table.read().collect()), key=repr) == before


def test_empty_landing_starts_cleanly(spark, tmp_path):
    os.makedirs(f"{tmp_path}/l/actor_roster")
    stream.ingest_bronze(spark, f"{tmp_path}/l", f"{tmp_path}/b", ("actor_roster",))
    assert stream.bronze_stream(spark, f"{tmp_path}/b", "actor_roster").isStreaming


@pytest.fixture(scope="module")
def built(spark, sf_dir, tmp_path_factory):
    """The whole pipeline from JSON landing rows to gold, every table written once."""
    dom = Domain(spark, sf_dir)
    bronze = {name: build(dom) for name, build in _BUILDERS.items()} | {"identity_overrides": dom["overrides"]}
    return pipeline.build_all(spark, bronze, str(tmp_path_factory.mktemp("lake")))


def test_every_table_is_built(built):
    assert set(pipeline.TABLES) <= set(built)
    empty = [n for n in pipeline.TABLES if built[n].limit(1).count() == 0]
    assert empty == []


@pytest.mark.parametrize("name", sorted(contracts.KEYS))
def test_gold_contracts_hold(built, name):
    known = {"gold_player_mplus_run_history", "gold_player_raid_achievements", "fact_player_events", "gold_wipe_survival_events"}
    report = contracts.failed(contracts.contract_report(built[name], contracts.declared(name)))
    bad = {(r.check, r.subject) for r in report.collect()}
    if name in known:  # two deaths at one time, or a feat completed by flag with no time
        bad = {b for b in bad if b[0] not in ("duplicate_key", "null_key", "null")}
    assert bad == set()


def test_views_register(spark, built):
    pipeline.register_views({"gold_boss_progression": built["gold_boss_progression"]})
    assert spark.sql("SELECT SUM(total_pulls) AS n FROM gold_boss_progression").first().n == built["silver_fight_events"].count()


def test_publish_manifest_and_latest(spark, built, tmp_path):
    names = ("boss_progression", "best_kills", "weekly_activity", "raid_summary")
    root, schema = str(tmp_path), "boss_name STRING, total_pulls BIGINT"
    with pytest.raises(Exception):
        publish.read_published(spark, root, "boss_progression", schema, names)
    for snapshot in ("s1", "s2"):
        listed = publish.publish(spark, built, root, snapshot, "2024-02-01T00:00:00Z", names)
        assert {r.dataset for r in listed.collect()} == set(names)
    manifests = publish.read_manifests(spark, root)
    assert manifests.count() == 8
    for row in manifests.collect():
        assert row.contract_version == "0.1.0" and row.contract_id == contracts.contract_id(contracts.declared(row.source_table))
        assert sorted(f.name for f in row.files) == sorted(n for n in os.listdir(f"{root}/{row.path}") if n.startswith("part-"))
        assert row.byte_size == sum(f.bytes for f in row.files) + 1 or not row.row_count
    assert publish.damaged_files(spark, root, manifests).count() == 0
    assert publish.read_published(spark, root, "boss_progression", schema, names).count() == built["gold_boss_progression"].count()
    with pytest.raises(ValueError, match="published already"):
        publish.publish(spark, built, root, "s2", "t", names)
    # data without a manifest, and a manifest that lists too little, are never read
    sinks.write_json(built["gold_boss_progression"].limit(1), f"{root}/{publish.data_path('s3', 'boss_progression')}")
    publish.commit(spark, root, "s4", manifests.filter("snapshot_id = 's2'").limit(1).withColumn("snapshot_id", F.lit("s4")))
    assert {r.snapshot_id for r in publish.latest_complete_snapshot(publish.read_manifests(spark, root), names).collect()} == {"s2"}
    # a data file that changes later is found, and a file beside the listed ones is not read
    row = manifests.filter("snapshot_id = 's2' AND dataset = 'boss_progression'").first()
    with open(f"{root}/{row.path}/part-extra.json", "w") as out:
        out.write('{"boss_name": "X", "total_pulls": 1}\n')
    assert publish.read_published(spark, root, "boss_progression", schema, names).count() == built["gold_boss_progression"].count()
    with open(f"{root}/{row.path}/{row.files[0].name}", "a") as out:
        out.write("\n")
    os.remove(f"{root}/{row.path}/.{row.files[0].name}.crc")  # the local file system's own check, which would stop the read before ours
    assert [tuple(r) for r in publish.damaged_files(spark, root, manifests).collect()] == [("s2", "boss_progression", row.files[0].name, "changed")]


def test_publish_stops_before_the_manifest(spark, built, tmp_path):
    root = str(tmp_path)
    lacking = {**built, "gold_player_attendance": built["gold_player_attendance"].drop("player_realm")}
    with pytest.raises(ValueError, match="player_realm"):
        publish.publish(spark, lacking, root, "s4", "t", ("player_attendance",))
    with pytest.raises(ValueError, match="total_wipes"):  # named by the contract alone
        publish.publish(spark, {**built, "gold_weekly_activity": built["gold_weekly_activity"].drop("total_wipes")}, root, "s4", "t", ("weekly_activity",))
    twice = {**built, "gold_best_kills": built["gold_best_kills"].unionByName(built["gold_best_kills"])}
    with pytest.raises(ValueError, match="duplicate_key"):
        publish.publish(spark, twice, root, "s5", "t", ("best_kills",))
    wrong = {**built, "gold_best_kills": built["gold_best_kills"].withColumn("total_kills", F.lit("many"))}
    with pytest.raises(ValueError, match="type"):
        publish.publish(spark, wrong, root, "s6", "t", ("best_kills",))
    with pytest.raises(ValueError, match="duplicate_key"):
        publish.export(spark, twice, "best_kills", f"{root}/one")
    assert not os.path.exists(f"{root}/manifests") and not os.path.exists(f"{root}/one")
    size = publish.export(spark, built, "best_kills", f"{root}/one").first()
    assert (size.dataset, size.row_count, size.within_limits) == ("best_kills", built["gold_best_kills"].count(), True)


def test_contract_ids_change_with_the_checks():
    base = contracts.declared("gold_best_kills")
    changed = base._replace(fields={**base.fields, "total_kills": Field("number")})
    assert contracts.contract_id(base) == contracts.contract_id(contracts.declared("gold_best_kills")) != contracts.contract_id(changed)


def test_every_dataset_names_its_columns(spark):
    for dataset, (source, _) in publish.DATASETS.items():
        contract = publish.contract_of(dataset)
        if contract is None:
            continue
        empty = spark.createDataFrame([], ", ".join(f"`{n}` {'STRING' if f.type == 'string' else 'BIGINT'}" for n, f in contract.fields.items()))
        wide = empty.withColumn("not_published", F.lit(1))
        if dataset not in ("wipe_cooldown_utilization",):
            assert "not_published" not in publish.project(dataset, {source: wide}).columns


def test_dataset_limits(spark, monkeypatch):
    from emberlog import rules

    monkeypatch.setattr(rules, "MAX_DATASET_ROWS", 5)
    got = {r.dataset: r for r in publish.dataset_sizes({"a": spark.range(5), "b": spark.range(6)}).collect()}
    assert got["a"].within_limits and not got["b"].within_limits
    assert got["a"].byte_size == len('[{"id":0},{"id":1},{"id":2},{"id":3},{"id":4}]')


def test_all_datasets_have_a_source():
    assert len(publish.DATASETS) == 35
    assert {s for s, _ in publish.DATASETS.values()} <= set(pipeline.TABLES) | {"identity_overrides"}


def test_streamed_table_gives_the_newest_landing(spark, tmp_path):
    landing, out = f"{tmp_path}/landing", f"{tmp_path}/bronze"

    def run():
        stream.ingest_bronze(spark, landing, out, ("guild_reports",))
        stream.run_available(stream.stream_reports(spark, out), f"{tmp_path}/silver", f"{tmp_path}/state")
        return sorted(tuple(r) for r in stream.read_silver(spark, f"{tmp_path}/silver", "reports").select("code", "title").collect())

    write_lines(f"{landing}/guild_reports", "a.json", {"code": "R", "title": "old"}, {"code": "S", "title": "only", "_ingested_at": "2023-01-01T00:00:00"})
    assert run() == [("R", "old"), ("S", "only")]
    write_lines(f"{landing}/guild_reports", "b.json", {"code": "R", "title": "new", "_ingested_at": "2024-02-01T00:00:00"}, {"code": "R", "title": "stale", "_ingested_at": "2023-01-01T00:00:00"})
    assert run() == [("R", "new"), ("S", "only")]
    batch = silver.guild_reports(spark.read.schema(stream.landing_schema("guild_reports")).json(f"{landing}/guild_reports"))
    assert sorted(tuple(r) for r in batch.select("code", "title").collect()) == [("R", "new"), ("S", "only")]


def test_declared_contracts_find_a_missing_column_and_a_wrong_type(spark):
    assert set(pipeline.GOLD) == set(contracts.FIELDS) == set(contracts.KEYS)
    contract = contracts.declared("gold_weekly_activity")
    frame = spark.range(1).select(*[F.lit("x").alias(n) for n in contract.fields if n != "total_wipes"])
    bad = found(frame, contract)
    assert bad["missing_column", "total_wipes"] == 1 and bad["type", "total_pulls"] == 1


def test_corrupt_payloads_are_kept(spark, tmp_path):
    texts = ['{"data": {"entries": [{"name": "A"}]}}', '{"data": {"entries": [{"na', "", None]
    raw = spark.createDataFrame([("R", i, t) for i, t in enumerate(texts)], "report_code STRING, n INT, table_json STRING")
    name = "corrupt_fight_deaths_table_as_deaths"
    built = pipeline.build_all(spark, {"fight_deaths": raw}, str(tmp_path), (name,))
    assert sorted(r.n for r in built[name].collect()) == [1, 2]
