"""Queries over data quality, contracts, completeness and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.operators import rows
from emberlog.plans import pipeline, publish
from emberlog.plans.pipeline import Catalog
from emberlog.quality import completeness, contracts
from emberlog.quality.contracts import Contract, Field
from emberlog.quality.expectations import RULES, expect_or_drop, expectation_report
from emberlog.session import discard, stored, work_folder
from emberlog.sources import sinks
from emberlog.workload import bronze
from emberlog.workload.domain import Domain
from emberlog.workload.q_gold import SHARED, catalog
from emberlog.workload.registry import query, statement


@query("expectation_report", """SELECT rule, (SELECT COUNT(*) FROM rankings) AS total_rows, failed_rows, ROUND(failed_rows / (SELECT COUNT(*) FROM rankings), 4) AS failed_share
    FROM (SELECT 'rank_percent_present' AS rule, COUNT(*) FILTER (rank_percent IS NULL) AS failed_rows FROM rankings UNION ALL SELECT 'high_amount', COUNT(*) FILTER (NOT amount > 1000) FROM rankings
    UNION ALL SELECT 'ingested_at_present', COUNT(*) FILTER (_ingested_at IS NULL) FROM rankings) t""")
def expectations(dom: Domain) -> DataFrame:
    return expectation_report(dom["rankings"], {"rank_percent_present": "rank_percent IS NOT NULL", "high_amount": "amount > 1000",
                                                "ingested_at_present": RULES["ingested_at_present"]})


@query("expect_or_drop", "SELECT report_code, fight_id, player_name FROM rankings WHERE rank_percent > 20")
def dropped(dom: Domain) -> DataFrame:
    """A null condition fails too."""
    return expect_or_drop(dom["rankings"], {"ranked": "rank_percent > 20"}).select("report_code", "fight_id", "player_name")


_SHARED = {
    "valid_id": "NOT user_id > 0", "valid_timestamp": "_ingested_at IS NULL", "no_future_dates": "FALSE", "valid_name": "name IS NULL OR LENGTH(TRIM(name)) = 0",
    "unique_player_per_fight": "(SELECT COUNT(*) FROM members o WHERE o.rank = m.rank) <> 1", "ingested_at_present": "_ingested_at IS NULL", "freshness_within_48h": "TRUE"}


@query("shared_rules", " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, COUNT(*) AS total_rows, COUNT(*) FILTER ({bad}) AS failed_rows, ROUND(COUNT(*) FILTER ({bad}) / GREATEST(COUNT(*), 1), 4) AS failed_share FROM members m"
    for rule, bad in _SHARED.items()))
def shared_rules(dom: Domain) -> DataFrame:
    """All shared rules; the landings are years old, and members of one rank stand for the rows of one key."""
    counted = rows.with_duplicate_count(dom["members"], ["rank"])
    return expectation_report(counted.withColumn("id", F.col("user_id")).withColumn("created_at", F.to_timestamp("_ingested_at")), RULES)


def _rule(table: str, action: str, rule: str, total: str, failed: str = "SELECT 0", dropped: str = "SELECT 0") -> str:
    return (f"SELECT '{table}' AS table_name, '{action}' AS action, '{rule}' AS rule, CAST(({total}) AS BIGINT) AS total_rows, "
            f"CAST(({failed}) AS BIGINT) AS failed_rows, CAST(({dropped}) AS BIGINT) AS dropped_rows")


def _count(table: str, times: int = 1, where: str = "TRUE") -> str:
    return f"SELECT {times} * COUNT(*) FROM {table} WHERE {where}"


_ONCE_DEAD = """SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM deaths GROUP BY report_code, fight_id, player_name, death_timestamp_ms HAVING COUNT(*) > 1) t"""
# what each rule meets in the fixture: rows held to it, rows that break it, rows that the table drops
_RULED = [
    _rule("silver_guild_reports", "drop", "valid_report_code", _count("reports", 3), _count("reports"), _count("reports")),
    *[_rule("silver_guild_reports", "warn", r, _count("reports")) for r in ("valid_start_time", "ingested_at_present")],
    *[_rule("silver_fight_events", "drop", r, _count("fights", 3), bad, _count("fights", 2)) for r, bad in (
        ("valid_fight_id", "SELECT 0"), ("valid_report_code", "SELECT 0"), ("is_raid_encounter", _count("fights")), ("is_raid_difficulty", _count("fights")))],
    _rule("silver_fight_events", "warn", "ingested_at_present", _count("fights")),
    *[_rule("silver_raid_attendance", "drop", r, _count("attendance")) for r in ("valid_report_code", "valid_player_name")],
    _rule("silver_raid_attendance", "warn", "ingested_at_present", _count("attendance")),
    *[_rule("silver_actor_roster", "drop", r, _count("actors")) for r in ("valid_report_code", "valid_actor_id", "valid_player_name")],
    _rule("silver_actor_roster", "warn", "ingested_at_present", _count("actors")),
    *[_rule("silver_player_performance", "drop", r, _count("perf")) for r in ("valid_fight_ref", "valid_player_name")],
    *[_rule("silver_player_performance", "warn", r, _count("perf")) for r in ("unique_player_per_fight", "ingested_at_present")],
    *[_rule("silver_player_rankings", "drop", r, _count("rankings")) for r in ("valid_ranking_ref", "valid_player_name")],
    *[_rule("silver_player_rankings", "warn", r, _count("rankings"), bad) for r, bad in (
        ("unique_player_per_fight", "SELECT 0"), ("ingested_at_present", "SELECT 0"), ("rank_percent_present", _count("rankings", 1, "rank_percent IS NULL")))],
    _rule("silver_player_deaths", "drop", "valid_player_name", _count("deaths")),
    _rule("silver_player_deaths", "warn", "unique_player_per_fight", _count("deaths"), _ONCE_DEAD),
    *[_rule("silver_zone_catalog", "drop", r, _count("zones", 2)) for r in ("valid_zone_id", "valid_encounter_id")],
    *[_rule("silver_guild_members", "drop", r, _count("members")) for r in ("valid_name", "valid_rank")],
    *[_rule("silver_guild_zone_ranks", "drop", r, "SELECT COUNT(DISTINCT user_id % 4) FROM e WHERE event_type = 'signup'") for r in ("valid_zone_id", "valid_progress")],
    *[_rule(f"silver_character_{t}", "drop", "valid_player_name", _count("e", 1, "event_type = 'signup'")) for t in ("media", "equipment", "achievements")],
    _rule("silver_item_media", "drop", "valid_item_id", _count("e", 1, "event_type = 'signup'")),
    *[_rule("silver_raiderio_player_runs", "drop", r, "SELECT COUNT(*) + COUNT(*) FILTER (source = 'best') FROM runs") for r in ("valid_player_name", "valid_dungeon")]]
_MEASURED = ("silver_guild_reports", "silver_fight_events", "silver_raid_attendance", "silver_actor_roster", "silver_player_performance", "silver_player_rankings",
             "silver_player_deaths", "silver_zone_catalog", "silver_guild_members", "silver_guild_zone_ranks", "silver_character_media", "silver_character_equipment",
             "silver_character_achievements", "silver_item_media", "silver_raiderio_player_runs")


@query("table_expectations", " UNION ALL ".join(_RULED))
def table_expectations(dom: Domain) -> DataFrame:
    """What the rules of the silver tables found, observed while the tables were written."""
    landed = {name: build(dom) for name, build in bronze.BUILDERS.items()}
    built = pipeline.build_all(dom.spark, landed, work_folder(dom.spark), _MEASURED)
    return built[pipeline.EXPECTATIONS].drop("measured_at")


_ORDERS = Contract("orders", "1", {
    "o_orderkey": Field("integer"), "o_custkey": Field("integer"), "o_orderstatus": Field("string"), "o_orderpriority": Field("number"),
    "o_orderdate": Field("date"), "o_comment": Field("string", True)},
    key=("o_custkey",), enums={"o_orderstatus": ("F", "O")}, expressions={"price": "o_orderkey >= 0 and max(o_custkey, 5) > 5", "dear": "o_orderkey % 2 == 0 or o_custkey != 7"})
_ORDER_CHECKS = " UNION ALL ".join([
    *[f"SELECT 'missing_column' AS \"check\", '{c}' AS subject, {int(c == 'o_comment')} AS violations" for c in _ORDERS.fields],
    *[f"SELECT 'null', '{c}', COUNT(*) FILTER ({c} IS NULL) FROM orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")],
    *[f"SELECT 'empty', '{c}', COUNT(*) FILTER ({c} = '') FROM orders" for c in ("o_orderstatus", "o_orderpriority")],
    *[f"SELECT 'type', '{c}', 0" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")],
    "SELECT 'type', 'o_orderpriority', COUNT(*) FILTER (o_orderpriority IS NOT NULL AND o_orderpriority <> '' AND TRY_CAST(o_orderpriority AS DOUBLE) IS NULL) FROM orders",
    "SELECT 'enum', 'o_orderstatus', COUNT(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders",
    "SELECT 'rule', 'price', COUNT(*) FILTER (NOT (o_orderkey >= 0 AND GREATEST(o_custkey, 5) > 5)) FROM orders",
    "SELECT 'rule', 'dear', COUNT(*) FILTER (NOT (o_orderkey % 2 = 0 OR o_custkey <> 7)) FROM orders",
    "SELECT 'null_key', 'o_custkey', COUNT(*) FILTER (o_custkey IS NULL) FROM orders",
    "SELECT 'duplicate_key', 'o_custkey', COUNT(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1) t"])


@query("contract_report", f"SELECT 'orders' AS table_name, * FROM ({_ORDER_CHECKS}) t")
def contract_report(dom: Domain) -> DataFrame:
    return contracts.contract_report(dom.table("orders"), _ORDERS)


@query("contract_projection", f"""SELECT 'orders' AS table_name, * FROM ({_ORDER_CHECKS}) t WHERE "check" IN ('missing_column', 'null', 'empty', 'type', 'enum')
    AND subject IN ('o_orderkey', 'o_orderstatus')""")
def contract_projection(dom: Domain) -> DataFrame:
    """Only the checks the projected columns can be held to."""
    frame = dom.table("orders").select("o_orderkey", "o_orderstatus")
    return contracts.contract_report(frame, _ORDERS.project(frame.columns))


# columns that the statement of a table leaves out, because its value is Spark's own
_LEFT_OUT = {"death_event_key", "_ingested_at"}


def _rule_sql(expression: str) -> str:
    return expression.replace("==", "=").replace("!=", "<>").replace('"', "'")


def _contract_sql(table: str) -> str:
    """The rows of a table's own statement, held to the declared contract."""
    contract = contracts.declared(table)
    present = {n: f for n, f in contract.fields.items() if n not in _LEFT_OUT}

    def total(conditions: list[str]) -> str:
        return " + ".join(f"COUNT(*) FILTER ({c})" for c in conditions) or "0"

    keyed = set(contract.key) <= set(present)
    twice = f"(SELECT COUNT(*) FROM (SELECT 1 FROM t GROUP BY {', '.join(contract.key)} HAVING COUNT(*) > 1) k)" if keyed else "0"
    allowed = [f"{n} IS NOT NULL AND {n} NOT IN ({', '.join(repr(v) for v in values)})" for n, values in contract.enums.items()]
    return f"""(WITH t AS MATERIALIZED ({statement(table)}) SELECT '{table}' AS table_name, COUNT(*) AS row_count, 0 AS schema_failures,
        CAST({total([f'{n} IS NULL' for n, f in present.items() if not f.nullable])} AS BIGINT) AS null_fields,
        CAST({total([f"{n} = ''" for n, f in present.items() if f.type == 'string' and not f.allow_empty])} AS BIGINT) AS empty_texts,
        CAST({total(allowed)} AS BIGINT) AS wrong_values, CAST({total([f'NOT COALESCE({_rule_sql(e)}, FALSE)' for e in contract.expressions.values()])} AS BIGINT) AS broken_rules,
        CAST({total([' OR '.join(f'{k} IS NULL' for k in contract.key)]) if keyed else '0'} AS BIGINT) AS null_keys, CAST({twice} AS BIGINT) AS duplicate_keys FROM t)"""


@query("gold_contracts", " UNION ALL ".join(f"SELECT * FROM {_contract_sql(t)} c" for t in pipeline.GOLD))
def gold_contracts(dom: Domain) -> DataFrame:
    """All tables against their declared contracts: violations by kind of check.

    Each table is stored when first used, so that it is worked out once and no plan spans more than one.
    """
    t = catalog(dom, tuple(pipeline.TABLES))
    kinds = {"null_fields": ("null",), "empty_texts": ("empty",), "wrong_values": ("enum",), "broken_rules": ("rule",), "null_keys": ("null_key",), "duplicate_keys": ("duplicate_key",)}
    reports = []
    for name in pipeline.GOLD:
        frame = t[name]
        report = contracts.contract_report(frame, contracts.declared(name))
        shape = F.col("check").isin("missing_column", "type")
        sums = report.groupBy("table_name").agg(F.sum(F.when(shape, F.col("violations")).otherwise(0)).alias("schema_failures"), *[
            F.sum(F.when(F.col("check").isin(*checks), F.col("violations")).otherwise(0)).alias(kind) for kind, checks in kinds.items()])
        reports.append(sums.join(sinks.row_counts({name: frame}), "table_name"))
    return rows.union_branches(reports)


@query("unique_key_check", """SELECT 'null_key' AS "check", 'text_hash' AS subject, CAST(0 AS BIGINT) AS violations UNION ALL
    SELECT 'duplicate_key', 'text_hash', COUNT(*) FROM (SELECT md5(text) FROM documents GROUP BY md5(text) HAVING COUNT(*) > 1) t""")
def unique_key_check(dom: Domain) -> DataFrame:
    return contracts.key_violations(dom.table("documents").select(F.md5("text").alias("text_hash")), ("text_hash",))


@query("parse_completeness", """SELECT report_code, CAST(SUM(CASE WHEN n / a > 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS incomplete_fights, COUNT(*) AS total_fights,
    CAST(SUM(n) AS BIGINT) AS null_chars, CAST(SUM(a) AS BIGINT) AS total_chars FROM (SELECT report_code, fight_id, COUNT(*) AS a, COUNT(*) FILTER (rank_percent IS NULL) AS n
    FROM rankings GROUP BY report_code, fight_id) t GROUP BY report_code""")
def parse_completeness(dom: Domain) -> DataFrame:
    """Over all landings; the newest of each report counts."""
    return completeness.parse_completeness(bronze.fight_rankings(dom))


@query("backfill_decisions", """SELECT report_code, incomplete_fights, file_age_days, CASE WHEN incomplete_fights = 0 THEN 'skip_complete' WHEN file_age_days >= 14 THEN 'accept_final' ELSE 'refetch' END AS decision
    FROM (SELECT report_code, CAST(SUM(CASE WHEN n / a > 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS incomplete_fights, CAST(date_diff('day', MAX(d), DATE '2024-01-31') AS INT) AS file_age_days FROM
    (SELECT r.report_code, fight_id, MAX(CAST(substr(_ingested_at, 1, 10) AS DATE)) AS d, COUNT(*) AS a, COUNT(*) FILTER (rank_percent IS NULL) AS n FROM rankings r GROUP BY r.report_code, fight_id) t GROUP BY report_code) x""")
def backfill_decisions(dom: Domain) -> DataFrame:
    landed = bronze.fight_rankings(dom)
    ages = completeness.file_ages(landed, F.lit("2024-01-31").cast("date"))
    decided = completeness.backfill_decision(completeness.parse_completeness(landed).join(ages, "report_code"))
    return decided.select("report_code", "incomplete_fights", "file_age_days", "decision")


_SIGNUPS, _CHUNKS = "SELECT COUNT(*) AS n FROM e WHERE event_type = 'signup'", "SELECT COUNT(*) AS n FROM (SELECT DISTINCT report_code, event_id // 64 FROM {}) t"
_PLANTED_SQL = {
    "corrupt_player_details_player_details_as_player_details": "SELECT COUNT(*) AS n FROM (SELECT DISTINCT report_code, fight_id FROM perf) t",
    **{f"corrupt_fight_rankings_{c}_as_rankings": "SELECT 3 * COUNT(DISTINCT report_code) AS n FROM rankings" for c in ("rankings", "rankings_hps")},
    # the fixture lands every record three times, once malformed
    "corrupt_fight_deaths_table_as_deaths": "SELECT 4 * COUNT(*) AS n FROM (SELECT DISTINCT report_code, fight_id, event_id // 64 FROM deaths) t",
    "corrupt_fight_casts_events_as_casts": _CHUNKS.format("raw_casts"), "corrupt_fight_casts_buffs_as_casts": _CHUNKS.format("buff_events"),
    "corrupt_fight_casts_combatant_info_as_combatants": _CHUNKS.format("combatants"), "corrupt_guild_zone_ranks_progress_as_zone_progress": _SIGNUPS,
    "corrupt_character_media_media_as_media": _SIGNUPS, "corrupt_item_media_media_as_media": _SIGNUPS, "corrupt_character_equipment_equipment_as_equipment": _SIGNUPS,
    "corrupt_character_achievements_achievements_as_achievement_totals": _SIGNUPS, "corrupt_character_achievements_achievements_as_achievements": _SIGNUPS,
    "corrupt_raiderio_character_profiles_profile_as_profile": "SELECT COUNT(*) AS n FROM runs"}


@query("corrupt_payloads", " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(n AS BIGINT) AS row_count FROM ({s}) t" for t, s in _PLANTED_SQL.items()))
def corrupt_payloads(dom: Domain) -> DataFrame:
    """Rows of every side table of corrupt payloads, with each landed payload once more, cut by its last character."""
    counts = {}
    for (folder, column, _), (name, (build, _)) in zip(pipeline.PAYLOAD_COLUMNS, pipeline.CORRUPT.items()):
        landed = getattr(bronze, {"raiderio_character_profiles": "character_profiles"}.get(folder, folder))(dom)
        cut = landed.filter(F.col(column).isNotNull()).withColumn(column, F.expr(f"left({column}, length({column}) - 1)"))
        counts[name] = build(landed.unionByName(cut))
    return sinks.row_counts(counts)


@query("stale_landings", """SELECT f.report_code, COUNT(*) FILTER (d.fight_id IS NULL) AS missing_fights, COUNT(d.fight_id) = 0 AS never_landed, FALSE AS payload_absent, FALSE AS multi_fight_records
    FROM fights f LEFT JOIN (SELECT DISTINCT report_code, fight_id FROM bought) d ON f.report_code = d.report_code AND f.fight_id = d.fight_id
    GROUP BY f.report_code HAVING COUNT(*) FILTER (d.fight_id IS NULL) > 0""")
def stale_landings(dom: Domain) -> DataFrame:
    """Reports whose landed player details do not cover their fights."""
    landed = dom["bought"].select("report_code", "fight_id").distinct().select("report_code", F.array("fight_id").alias("fight_ids"), F.lit("x").alias("payload"))
    return completeness.stale_landings(dom["fights"].select("report_code", "fight_id"), landed, ("payload",), allow_multi=False)


def _on_night(table: str) -> str:
    return f"SELECT DISTINCT CONCAT(report_code, '/', player_name) AS n FROM {table}"


@query("data_gap_report", f"""SELECT p.n AS player_name, array_to_string(list_filter([CASE WHEN a.n IS NULL THEN 'deaths' END, CASE WHEN b.n IS NULL THEN 'kills' END,
    CASE WHEN c.n IS NULL THEN 'casts' END], lambda x: x IS NOT NULL), ',') AS gaps FROM ({_on_night('actors')}) p LEFT JOIN ({_on_night('deaths')}) a ON p.n = a.n
    LEFT JOIN ({_on_night('perf')}) b ON p.n = b.n LEFT JOIN ({_on_night('raw_casts JOIN actors USING (report_code, actor_id)')}) c ON p.n = c.n
    WHERE a.n IS NULL OR b.n IS NULL OR c.n IS NULL""")
def data_gap_report(dom: Domain) -> DataFrame:
    """Players of a night and the products that lack them on that night."""
    def named(df: DataFrame) -> DataFrame:
        return df.select(F.concat_ws("/", "report_code", "player_name").alias("player_name"))

    casts = dom["raw_casts"].join(dom["actors"].select("report_code", "actor_id", "player_name"), ["report_code", "actor_id"])
    products = {"deaths": named(dom["deaths"]), "kills": named(dom["perf"]), "casts": named(casts)}
    return completeness.data_gaps(named(dom["actors"]).distinct(), products).withColumn("gaps", F.array_join("gaps", ","))


@query("landed_fights", """SELECT report_code, string_agg(CAST(fight_id AS VARCHAR), ',' ORDER BY fight_id) AS fight_ids, COUNT(*) AS fights
    FROM (SELECT DISTINCT report_code, fight_id FROM deaths) t GROUP BY report_code""")
def landed_fights(dom: Domain) -> DataFrame:
    found = completeness.landed_fights(bronze.fight_deaths(dom))
    return found.withColumn("fight_ids", F.array_join("fight_ids", ","))


@query("required_source_columns", """SELECT 'player_attendance' AS dataset, 'player_realm' AS "column", COUNT(*) AS source_rows FROM attendance""")
def required_source_columns(dom: Domain) -> DataFrame:
    """A source without a required column is found from its schema."""
    source = dom["attendance"].withColumn("player_identity_key", F.col("player_name"))
    lacking = publish.missing_columns({"gold_player_attendance": source})
    counted = source.agg(F.count(F.lit(1)).alias("source_rows"))
    return counted.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dataset"), F.lit(c).alias("column")) for d, c in lacking])).alias("m"), "source_rows").select("m.*", "source_rows")


_DISTINCT_PULLS = "report_code, fight_id, boss_name, zone_name, difficulty_label, is_kill, player_name, player_class"
_ABILITY = "boss_name, zone_name, difficulty_label, cooldown_category, player_identity_key, player_name, player_class, realm, ability_id, ability_name"
# datasets that leave out or sum rows of their table; all others publish every row
_ROWS_SQL = {
    "raid_summary": "SELECT * FROM raid_summary WHERE TRIM(zone_name) <> ''",
    "player_attendance": f"SELECT * FROM ({statement('gold_player_attendance')}) a WHERE TRIM(player_name) <> '' AND LOWER(TRIM(player_name)) <> 'nil'",
    "player_utility_by_pull": f"SELECT DISTINCT {_DISTINCT_PULLS} FROM utility", "wipe_cooldown_utilization": f"SELECT DISTINCT {_ABILITY} FROM utilization",
    "preparation_overrides": "SELECT * FROM overrides"}
_DATASET_ROWS = " UNION ALL ".join(f"SELECT '{d}' AS dataset, '{t}' AS source_table, (SELECT COUNT(*) FROM ({_ROWS_SQL.get(d) or statement(t)}) r) AS row_count"
                                   for d, (t, _) in publish.DATASETS.items())


def _shared_tables(dom: Domain) -> Catalog:
    """All tables, each stored when first used, so that none is worked out again for another."""
    t = catalog(dom, tuple(pipeline.TABLES))
    t["identity_overrides"] = stored(dom["overrides"])
    return t


@query("publish_sizes", f"SELECT dataset, row_count, row_count <= {rules.MAX_DATASET_ROWS} AS within_limits, TRUE AS bytes_as_written FROM ({_DATASET_ROWS}) t")
def publish_sizes(dom: Domain) -> DataFrame:
    """Rows and bytes of all datasets; the bytes counted from the rows are those of the files written from them.

    Files go once they are counted, and a table once no other dataset needs it.
    """
    t, root, sizes = _shared_tables(dom), work_folder(dom.spark), []
    t.only_for(source for source, _ in publish.DATASETS.values())
    for name, (source, _) in publish.DATASETS.items():
        frame = stored(publish.project(name, t))
        t.release(source)
        # a JSON array has one bracket more than its rows as lines have line ends
        written = F.lit(publish.written_bytes(frame, f"{root}/{name}") + 1)
        size = publish.dataset_sizes({name: frame})
        sizes.append(stored(size.select("dataset", "row_count", "within_limits", ((F.col("byte_size") == written) | (F.col("row_count") == 0)).alias("bytes_as_written"))))
        discard(frame)
    return rows.union_branches(sizes)


@query("publish_manifest", f"""SELECT 's2' AS snapshot_id, '2024-02-02T00:00:00Z' AS generated_at, dataset, CONCAT('snapshots/snapshot_id=s2/', dataset) AS path, row_count, source_table,
    CASE WHEN source_table <> 'identity_overrides' THEN '{contracts.VERSION}' END AS contract_version, CAST(0 AS BIGINT) AS damaged FROM ({_DATASET_ROWS}) t""")
def publish_manifest(dom: Domain) -> DataFrame:
    """All datasets published as a snapshot; a later one is written but not committed, and a reader still gets the first."""
    root, t = work_folder(dom.spark), _shared_tables(dom)
    t.only_for([*(source for source, _ in publish.DATASETS.values()), "gold_raid_summary"])
    publish.publish(dom.spark, {source: t[source] for source, _ in publish.DATASETS.values()}, root, "s2", "2024-02-02T00:00:00Z", strict=False, release=t.release)
    sinks.write_json(publish.project("raid_summary", t).limit(1), f"{root}/{publish.data_path('s3', 'raid_summary')}")
    newest = publish.latest_complete_snapshot(publish.read_manifests(dom.spark, root), tuple(publish.DATASETS))
    damaged = publish.damaged_files(dom.spark, root, newest).groupBy("dataset").agg(F.count(F.lit(1)).alias("damaged"))
    return newest.join(damaged, "dataset", "left").select(
        "snapshot_id", "generated_at", "dataset", "path", "row_count", "source_table", "contract_version", F.coalesce("damaged", F.lit(0).cast("bigint")).alias("damaged"))


@query("export_dataset", "SELECT * EXCLUDE (start_time_utc, end_time_utc) FROM raid_summary WHERE TRIM(zone_name) <> ''")
def export_dataset(dom: Domain) -> DataFrame:
    """One dataset checked, written and read back; published times are whole seconds."""
    path, t = work_folder(dom.spark), catalog(dom)
    publish.export(dom.spark, t, "raid_summary", path)
    return dom.spark.read.schema(publish.project("raid_summary", t).schema).json(path).drop("start_time_utc", "end_time_utc")


_ORDER_JSON = """LENGTH(CONCAT('{"o_orderkey":', o_orderkey, ',"o_orderstatus":"', o_orderstatus, '"}')) + 1"""


@query("publish_bytes", f"""SELECT 'orders' AS dataset, COUNT(*) AS row_count, CAST(SUM({_ORDER_JSON}) + 1 AS BIGINT) AS byte_size,
    COUNT(*) <= {rules.MAX_DATASET_ROWS} AND SUM({_ORDER_JSON}) + 1 <= {rules.MAX_DATASET_BYTES} AS within_limits FROM orders""")
def publish_bytes(dom: Domain) -> DataFrame:
    return publish.dataset_sizes({"orders": dom.table("orders").select("o_orderkey", "o_orderstatus")})


@query("manifest_mismatch", """SELECT report_code AS dataset, 'missing' AS problem FROM (SELECT DISTINCT report_code FROM fights WHERE is_kill) a WHERE report_code NOT IN
    (SELECT report_code FROM deaths WHERE killing_blow_id IS NULL) UNION ALL SELECT report_code, 'extra' FROM (SELECT DISTINCT report_code FROM deaths WHERE killing_blow_id IS NULL) b
    WHERE report_code NOT IN (SELECT report_code FROM fights WHERE is_kill)""")
def manifest_mismatch(dom: Domain) -> DataFrame:
    """Names wanted: reports with a kill; names listed: reports with a death of unknown cause."""
    wanted = dom["fights"].filter("is_kill").select(F.col("report_code").alias("dataset")).distinct()
    listed = dom["deaths"].filter("killing_blow_id IS NULL").select(F.col("report_code").alias("dataset"))
    return publish.manifest_mismatch(listed, wanted)


_NUMBERED = """(SELECT report_code AS snapshot_id, CAST(ROW_NUMBER() OVER (PARTITION BY report_code ORDER BY fight_id) AS VARCHAR) AS dataset FROM fights WHERE NOT is_kill)"""


@query("latest_snapshot", f"""SELECT * FROM {_NUMBERED} n WHERE snapshot_id = (SELECT MAX(snapshot_id) FROM
    (SELECT snapshot_id FROM {_NUMBERED} m GROUP BY snapshot_id HAVING LIST_SORT(LIST(dataset)) = ['1', '2', '3', '4']) t)""")
def latest_snapshot(dom: Domain) -> DataFrame:
    """Reports as snapshots and their numbered wipes as datasets: the newest with exactly the first four."""
    number = F.row_number().over(Window.partitionBy("report_code").orderBy("fight_id"))
    manifests = dom["fights"].filter("NOT is_kill").select(F.col("report_code").alias("snapshot_id"), number.cast("string").alias("dataset"))
    return publish.latest_complete_snapshot(manifests, ("1", "2", "3", "4"))


@query("published_cooldown_totals", """SELECT boss_name, zone_name, difficulty_label, cooldown_category, player_identity_key, player_name, player_class, realm, ability_id, ability_name,
    CAST(SUM(possible_casts) AS BIGINT) AS possible_casts, CAST(SUM(observed_casts) AS BIGINT) AS observed_casts, CAST(SUM(actual_casts) AS BIGINT) AS actual_casts,
    CAST(SUM(over_capacity_casts) AS BIGINT) AS over_capacity_casts, CAST(SUM(missed_casts) AS BIGINT) AS missed_casts FROM utilization
    GROUP BY boss_name, zone_name, difficulty_label, cooldown_category, player_identity_key, player_name, player_class, realm, ability_id, ability_name""")
def published_cooldowns(dom: Domain) -> DataFrame:
    return publish.project("wipe_cooldown_utilization", catalog(dom, SHARED[:4]))


@query("published_utility_pulls", "SELECT DISTINCT report_code, fight_id, boss_name, zone_name, difficulty_label, is_kill, player_name, player_class FROM utility")
def published_utility(dom: Domain) -> DataFrame:
    return publish.project("player_utility_by_pull", catalog(dom))


@query("published_attendance", "SELECT player_name, COUNT(*) AS total_raids_tracked FROM attendance WHERE TRIM(player_name) <> '' GROUP BY player_name")
def published_attendance(dom: Domain) -> DataFrame:
    return publish.project("player_attendance", catalog(dom)).select("player_name", "total_raids_tracked")
