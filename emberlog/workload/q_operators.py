"""Queries over the reusable operators, on whole driver tables and whole texts."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog import session
from emberlog.functions import names as nm
from emberlog.functions import values as v
from emberlog.operators import joins, ordered, rows, scopes
from emberlog.plans import publish, silver
from emberlog.sources import files, sinks
from emberlog.streaming import tables as stream
from emberlog.workload import bronze
from emberlog.workload.domain import Domain
from emberlog.workload.q_gold import catalog, parsed_casts
from emberlog.workload.registry import query

_CENTS = "CAST(ROUND({c} * 100) AS BIGINT)"


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def folder(dom: Domain) -> str:
    """A new folder of its own inside the shared checkpoint folder."""
    return session.work_folder(dom.spark)


# --- scans, sinks, streams -----------------------------------------------------------------

@query("scan_pruned", """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1998-01-01'""")
def scan_pruned(dom: Domain) -> DataFrame:
    """Two columns and two filters, both left to the parquet scan."""
    return dom.table("orders").filter("o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ '1998-01-01'").select("o_orderkey", "o_custkey")


@query("json_export_round_trip", "SELECT * EXCLUDE (start_time_utc, end_time_utc) FROM raid_summary WHERE TRIM(zone_name) <> ''")
def json_round_trip(dom: Domain) -> DataFrame:
    frame = publish.project("raid_summary", catalog(dom)).drop("start_time_utc", "end_time_utc")
    path = folder(dom)
    sinks.write_json(frame, path)
    return dom.spark.read.schema(frame.schema).json(path)


@query("csv_export_round_trip", """SELECT encounter_id, boss_name, zone_name, difficulty, difficulty_label, COUNT(*) AS total_kills FROM fights
    WHERE is_kill AND zone_name <> 'Blackrock Depths' GROUP BY encounter_id, boss_name, zone_name, difficulty, difficulty_label""")
def csv_round_trip(dom: Domain) -> DataFrame:
    frame = catalog(dom)["gold_best_kills"].select("encounter_id", "boss_name", "zone_name", "difficulty", "difficulty_label", "total_kills")
    path = folder(dom)
    sinks.write_csv(frame, path)
    return dom.spark.read.schema(frame.schema).option("header", "true").csv(path)


_TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part", "region", "supplier")


@query("table_row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _TABLES))
def table_row_counts(dom: Domain) -> DataFrame:
    return sinks.row_counts({t: dom.table(t) for t in _TABLES})


# tables of the dump with their keys; the last one is not there
_DUMPED = {"benchmark": ("item_id",), "conversations": ("conv_id", "turn"), "customer": ("c_custkey",), "documents": ("doc_id",), "embeddings": ("vec_id",), "events": ("event_id",),
           "labels": ("doc_id",), "lineitem": ("l_orderkey", "l_linenumber"), "nation": ("n_nationkey",), "orders": ("o_orderkey",), "pages": ("page_id",), "part": ("p_partkey",),
           "region": ("r_regionkey",), "supplier": ("s_suppkey",), "missing_table": ("id",)}


def _key_text(keys: tuple[str, ...]) -> str:
    return " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)


def _dump_sql(table: str, keys: tuple[str, ...]) -> str:
    if table == "missing_table":
        return "SELECT 'missing_table' AS table_name, 'error' AS status, CAST(-1 AS BIGINT) AS row_count, CAST(NULL AS BIGINT) AS place, CAST(NULL AS VARCHAR) AS row_key"
    return f"""SELECT '{table}' AS table_name, 'ok' AS status, (SELECT COUNT(*) FROM {table}) AS row_count, place, row_key FROM
        (SELECT row_number() OVER (ORDER BY md5({_key_text(keys)}), {', '.join(keys)}) AS place, {_key_text(keys)} AS row_key FROM {table}) t WHERE place <= 50"""


@query("sample_dump", " UNION ALL ".join(_dump_sql(t, k) for t, k in _DUMPED.items()))
def sample_dump(dom: Domain) -> DataFrame:
    """Samples of all tables, read back from the dump in its order, with the status of each table."""
    root = folder(dom)
    read = {t: (lambda t=t: dom.spark.read.parquet(f"{dom.sf_dir}/{t}.parquet")) for t in _DUMPED}
    status = sinks.dump_samples(dom.spark, read, _DUMPED, root).drop("note")
    parts = []
    for table, keys in list(_DUMPED.items())[:-1]:
        dumped = dom.spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(f"{root}/{table}")
        text = F.concat_ws("|", *keys)
        numbered = dumped.select(text.alias("row_key")).withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("bigint"))
        parts.append(numbered.select(F.lit(table).alias("table_name"), "place", "row_key"))
    return status.join(rows.union_branches(parts), "table_name", "left")


@query("upsert_overrides", """SELECT id, mode, source_character, target_character, characters, CONCAT('New ', id) AS display_name, enabled, notes, 'draft' AS updated_by, updated_at
    FROM overrides WHERE mode = 'pool' UNION ALL SELECT CONCAT('n', id), mode, source_character, target_character, characters, display_name, enabled, notes, updated_by, updated_at
    FROM overrides WHERE mode = 'pool' UNION ALL SELECT id, mode, source_character, target_character, characters, display_name, enabled, notes, updated_by, updated_at
    FROM overrides WHERE mode = 'replace'""")
def upsert_overrides(dom: Domain) -> DataFrame:
    stored = dom["overrides"]
    drafts = stored.filter("mode = 'pool'")
    changed = drafts.withColumn("display_name", F.concat(F.lit("New "), "id")).withColumn("updated_by", F.lit("draft"))
    added = drafts.withColumn("id", F.concat(F.lit("n"), "id"))
    return sinks.upsert(stored, changed.unionByName(added), ["id"])


def _landed(dom: Domain, name: str, frame: DataFrame) -> str:
    """Land rows as JSON files in two drops; the second repeats the first, as a re-landed source does."""
    root = folder(dom)
    frame.write.mode("append").json(f"{root}/{name}")
    frame.write.mode("append").json(f"{root}/{name}")
    return root


@query("stream_guild_reports", "SELECT code, zone_id, zone_name, start_time_utc FROM reports")
def stream_guild_reports(dom: Domain) -> DataFrame:
    root = _landed(dom, "guild_reports", bronze.guild_reports(dom))
    stream.ingest_bronze(dom.spark, root, f"{root}/bronze", ("guild_reports",))
    out = stream.stream_reports(dom.spark, f"{root}/bronze")
    stream.run_available(out, f"{root}/silver", f"{root}/state")
    return stream.read_silver(dom.spark, f"{root}/silver", "reports").select("code", "zone_id", "zone_name", "start_time_utc")


@query("stream_fight_events", "SELECT report_code, fight_id, boss_name, is_kill, difficulty_label, duration_seconds, zone_name, raid_night_date FROM fights")
def stream_fight_events(dom: Domain) -> DataFrame:
    root = _landed(dom, "report_fights", bronze.report_fights(dom))
    stream.ingest_bronze(dom.spark, root, f"{root}/bronze", ("report_fights",))
    stream.run_available(stream.stream_fights(dom.spark, f"{root}/bronze"), f"{root}/silver", f"{root}/state")
    stored = stream.with_report_context(stream.read_silver(dom.spark, f"{root}/silver", "fights"), dom["reports"].drop("raid_night_date"))
    return stored.select("report_code", "fight_id", "boss_name", "is_kill", "difficulty_label", "duration_seconds", "zone_name", "raid_night_date")


@query("stream_raid_attendance", "SELECT report_code, player_name, presence_status, zone_name, raid_night_date FROM attendance")
def stream_raid_attendance(dom: Domain) -> DataFrame:
    """Two of three reports land after their attendance, when no new attendance comes any more."""
    root = _landed(dom, "raid_attendance", bronze.raid_attendance(dom))
    stream.ingest_bronze(dom.spark, root, f"{root}/bronze", ("raid_attendance",))
    reports = dom["reports"].drop("raid_night_date")
    landed = reports.filter("pmod(xxhash64(code), 3) = 0")
    table = stream.settled_attendance(dom.spark, f"{root}/bronze", f"{root}/silver", lambda: landed)
    table.run(stream.stream_attendance(dom.spark, f"{root}/bronze"), f"{root}/state")
    landed = reports
    table.run(stream.stream_attendance(dom.spark, f"{root}/bronze"), f"{root}/state")
    return silver.once(table.read(), stream.KEYS["attendance"]).select("report_code", "player_name", "presence_status", "zone_name", "raid_night_date")


@query("stream_actor_roster", "SELECT report_code, actor_id, player_name, player_class, realm FROM actors")
def stream_actor_roster(dom: Domain) -> DataFrame:
    """Two drops, and a run that stops by itself after each: the second goes on from the checkpoint."""
    root, actors = folder(dom), bronze.actor_roster(dom)
    for _ in range(2):
        actors.write.mode("append").json(f"{root}/actor_roster")
        stream.ingest_bronze(dom.spark, root, f"{root}/bronze", ("actor_roster",))
        stream.run_available(stream.stream_actors(dom.spark, f"{root}/bronze"), f"{root}/silver", f"{root}/state")
    return stream.read_silver(dom.spark, f"{root}/silver", "actors").drop("_ingested_at")


@query("rewritten_reports", "SELECT code, title, zone_id, zone_name, start_time_utc, 2 AS landings FROM reports")
def rewritten_reports(dom: Domain) -> DataFrame:
    """Every landed file is rewritten in place; of three runs the last finds nothing new and opens no file."""
    root = folder(dom)
    good = bronze.guild_reports(dom).filter("title <> 'stale'")
    good.filter("code <> ''").withColumns({"title": F.lit("first"), "_ingested_at": F.lit("2023-01-01T00:00:00")}).coalesce(8).write.json(f"{root}/guild_reports")
    read = [stream.ingest_rewritten(dom.spark, root, "guild_reports", f"{root}/bronze", f"{root}/ledger")]
    landed = [n for n in files.names(dom.spark, f"{root}/guild_reports") if n.startswith("part-")]
    good.filter("code <> ''").repartition(len(landed)).write.json(f"{root}/rewritten")
    written = [n for n in files.names(dom.spark, f"{root}/rewritten") if n.startswith("part-")]
    for i, new in enumerate(written):
        files.replace(dom.spark, f"{root}/rewritten/{new}", f"{root}/guild_reports/{landed[i] if i < len(landed) else new}")
    read += [stream.ingest_rewritten(dom.spark, root, "guild_reports", f"{root}/bronze", f"{root}/ledger") for _ in range(2)]
    if read[2]:
        raise ValueError("a run without new files has read some")
    table = dom.spark.read.parquet(f"{root}/bronze/guild_reports")
    newest = silver.guild_reports(stream.newest_rows(table, ("code",)))
    landings = table.groupBy("code").agg(F.count(F.lit(1)).cast("int").alias("landings"))
    return newest.join(landings, "code").select("code", "title", "zone_id", "zone_name", "start_time_utc", "landings")


_BUILDERS = bronze.BUILDERS
_CHUNKS = {t: f"SELECT DISTINCT report_code, event_id // {bronze.CHUNK} AS c FROM {t}" for t in ("raw_casts", "buff_events", "combatants")}
_SIGNUPS = "SELECT COUNT(*) FROM e WHERE event_type = 'signup'"
# rows of each landing folder, and the violations of its rules, as the fixture lands them
_LANDED = {
    "guild_reports": ("SELECT 3 * COUNT(*) FROM reports", "0"), "report_fights": ("SELECT COUNT(DISTINCT report_code) FROM fights", "0"),
    "raid_attendance": ("SELECT COUNT(DISTINCT report_code) FROM attendance", "0"), "actor_roster": ("SELECT COUNT(DISTINCT report_code) FROM actors", "0"),
    "player_details": ("SELECT COUNT(*) FROM (SELECT DISTINCT report_code, fight_id FROM perf)", "0"),
    "zone_catalog": ("SELECT COUNT(*) FROM (SELECT DISTINCT zone_id, zone_name FROM zones)", "0"),
    "fight_rankings": ("SELECT 3 * COUNT(DISTINCT report_code) FROM rankings", "0"),
    "fight_deaths": (f"SELECT 3 * COUNT(*) FROM (SELECT DISTINCT report_code, fight_id, event_id // {bronze.CHUNK} AS c FROM deaths)", "0"),
    "fight_casts": ("SELECT COUNT(*) FROM (" + " UNION ALL ".join(_CHUNKS.values()) + ")", f"SELECT COUNT(*) FROM ({_CHUNKS['buff_events']} UNION ALL {_CHUNKS['combatants']})"),
    "guild_zone_ranks": (_SIGNUPS, "0"), "guild_members": ("SELECT 2 * COUNT(*) FROM members", "0"), "character_media": (_SIGNUPS, "0"),
    "character_equipment": (_SIGNUPS, "0"), "character_achievements": (_SIGNUPS, "0"), "item_media": (_SIGNUPS, "0"),
    "raiderio_character_profiles": ("SELECT COUNT(*) FROM runs", "0"),
    "live_raid_roster": ("SELECT 2 * COUNT(DISTINCT m.user_id // 50) FROM members m JOIN live_roster l ON m.name = l.name", "0")}


@query("bronze_ingest_all", " UNION ALL ".join(f"SELECT '{t}' AS table_name, ({n}) AS rows, ({bad}) AS violations" for t, (n, bad) in _LANDED.items()))
def bronze_ingest_all(dom: Domain) -> DataFrame:
    """All seventeen landing folders through file streams side by side: rows, and violations as the streams observed them."""
    root = folder(dom)
    for name, build in _BUILDERS.items():
        build(dom).write.json(f"{root}/{name}")
    seen = stream.ingest_bronze(dom.spark, root, f"{root}/bronze")
    broken = seen.groupBy("table_name").agg(F.sum("failed_rows").alias("violations")).withColumn("table_name", F.replace("table_name", F.lit("bronze_"), F.lit("")))
    landed = sinks.row_counts({name: stream.read_bronze(dom.spark, f"{root}/bronze", name) for name in _BUILDERS})
    return landed.join(broken, "table_name", "left").select("table_name", F.col("row_count").alias("rows"), F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations"))


# --- joins ---------------------------------------------------------------------------------

@query("interval_join_casts", """SELECT c.event_id, c.report_code, c.cast_timestamp_ms, f.fight_id FROM raw_casts c LEFT JOIN fights f ON c.report_code = f.report_code
    AND c.cast_timestamp_ms >= f.fight_start_ms AND c.cast_timestamp_ms <= f.fight_start_ms + CAST(f.duration_seconds AS BIGINT) * 1000""")
def interval_join_casts(dom: Domain) -> DataFrame:
    """All casts placed by time alone; casts outside every pull stay, with no pull."""
    casts = dom["raw_casts"].select("event_id", "report_code", "cast_timestamp_ms")
    return joins.interval_join(casts, silver.fight_windows(dom["fights"]), ["report_code"], "cast_timestamp_ms", "start_ms", "end_ms", ["fight_id"])


@query("resolve_fight_id", """SELECT c.event_id, COALESCE(c.event_fight_id, f.fight_id) AS fight_id FROM raw_casts c LEFT JOIN fights f ON c.report_code = f.report_code
    AND c.event_fight_id IS NULL AND c.cast_timestamp_ms >= f.fight_start_ms AND c.cast_timestamp_ms <= f.fight_start_ms + CAST(f.duration_seconds AS BIGINT) * 1000""")
def resolve_fight_id(dom: Domain) -> DataFrame:
    casts = dom["raw_casts"].select("event_id", "report_code", "event_fight_id", "cast_timestamp_ms")
    return joins.resolve_interval_id(casts, silver.fight_windows(dom["fights"]), ["report_code"], "event_fight_id", "fight_id",
                                     "cast_timestamp_ms", "start_ms", "end_ms").select("event_id", "fight_id")


@query("asof_last_event", """SELECT a.event_id, (SELECT MAX(b.ms) FROM ev b WHERE b.event_type = 'click' AND b.user_id = a.user_id AND b.ms <= a.ms) AS last_click_ms
    FROM ev a WHERE a.event_type = 'error'""")
def asof_last_event(dom: Domain) -> DataFrame:
    """For each error the user's last click at or before it, over days."""
    e = dom["ev"].select("event_id", "user_id", "ms", "event_type")
    left = e.filter("event_type = 'error'").select("event_id", "user_id", "ms")
    right = e.filter("event_type = 'click'").select("user_id", "ms")
    return joins.asof_last(left, right, ["user_id"], "ms", "ms", "last_click_ms").select("event_id", "last_click_ms")


@query("hot_key_join", "SELECT l_orderkey, l_linenumber, l_returnflag, n FROM lineitem JOIN (SELECT l_returnflag AS f, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag) d ON l_returnflag = f")
def hot_key_join(dom: Domain) -> DataFrame:
    """Every line joined to a table of three keys, each of which holds a third of the lines."""
    lines = dom.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    flags = dom.table("lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return joins.split_hot_join(lines, flags, ["l_returnflag"], how="inner")


@query("semi_join_restriction", "SELECT report_code, fight_id, encounter_id FROM fights f WHERE EXISTS (SELECT 1 FROM casts c WHERE c.report_code = f.report_code AND c.fight_id = f.fight_id)")
def semi_join_restriction(dom: Domain) -> DataFrame:
    t = catalog(dom)
    fights = dom["fights"].select("report_code", "fight_id", "encounter_id")
    casts = silver.player_cast_events(parsed_casts(dom), t["silver_fight_events"], dom["actors"])
    return joins.restrict_to(fights, casts, ["report_code", "fight_id"])


@query("case_insensitive_lookup", """SELECT p.player_name, m.rank_label FROM (SELECT DISTINCT player_name FROM actors) p LEFT JOIN labelled_members m
    ON LOWER(p.player_name) = LOWER(m.name)""")
def case_insensitive_lookup(dom: Domain) -> DataFrame:
    players = dom["actors"].select("player_name").distinct()
    return joins.lookup(players, dom["labelled_members"], [(F.lower("player_name"), F.lower("name"))], ["rank_label"])


@query("full_outer_as_union", """SELECT COALESCE(a.user_id, b.user_id) AS user_id, COALESCE(a.d, b.d) AS d, COALESCE(errors, 0) AS errors, COALESCE(buys, 0) AS buys
    FROM (SELECT user_id, d, COUNT(*) AS errors FROM ev WHERE event_type = 'error' GROUP BY user_id, d) a FULL OUTER JOIN
    (SELECT user_id, d, COUNT(*) AS buys FROM ev WHERE event_type = 'purchase' GROUP BY user_id, d) b ON a.user_id = b.user_id AND a.d = b.d""")
def full_outer_as_union(dom: Domain) -> DataFrame:
    """Days with errors only, buys only, or both."""
    e, key = dom["ev"], ["user_id", "d"]
    zero = F.lit(0).cast("bigint")
    errors = e.filter("event_type = 'error'").groupBy(*key).agg(F.count("*").alias("errors"))
    buys = e.filter("event_type = 'purchase'").groupBy(*key).agg(F.count("*").alias("buys"))
    return scopes.combine_sources([errors, buys], key, {c: F.coalesce(F.sum(c), zero) for c in ("errors", "buys")})


@query("prefer_flagged_rows", """SELECT o_orderkey, o_custkey, o_orderstatus FROM (SELECT *, MAX(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS f
    FROM orders) t WHERE f = 0 OR o_orderstatus = 'F'""")
def prefer_flagged_rows(dom: Domain) -> DataFrame:
    o = dom.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return rows.prefer_flagged(o, ["o_custkey"], F.col("o_orderstatus") == "F")


@query("null_equal_join", """SELECT a.realm, a.n, b.m FROM (SELECT realm, COUNT(*) AS n FROM e WHERE event_type = 'error' GROUP BY realm) a LEFT JOIN
    (SELECT realm, COUNT(*) AS m FROM e WHERE event_type = 'click' GROUP BY realm) b ON a.realm IS NOT DISTINCT FROM b.realm""")
def null_equal_join(dom: Domain) -> DataFrame:
    e = dom["e"]
    a = e.filter("event_type = 'error'").groupBy("realm").agg(F.count(F.lit(1)).alias("n"))
    b = e.filter("event_type = 'click'").groupBy(F.col("realm").alias("_realm")).agg(F.count(F.lit(1)).alias("m"))
    return a.join(b, F.col("realm").eqNullSafe(F.col("_realm")), "left").drop("_realm")


# --- aggregations --------------------------------------------------------------------------

@query("pricing_summary", f"""SELECT l_returnflag, l_linestatus, COUNT(*) AS lines, CAST(SUM({_CENTS.format(c='l_extendedprice')}) AS BIGINT) AS price_cents,
    CAST(SUM(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted, MIN(l_shipdate) AS first_ship, MAX(l_quantity) AS max_quantity,
    MAX(CASE WHEN l_discount > 0.05 THEN l_quantity END) AS max_discounted, COUNT(DISTINCT l_suppkey) AS suppliers,
    COUNT(DISTINCT CASE WHEN l_discount > 0.05 THEN l_suppkey END) AS discount_suppliers FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def pricing_summary(dom: Domain) -> DataFrame:
    cheap = F.col("l_discount") > 0.05
    return dom.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(cents("l_extendedprice")).alias("price_cents"), F.count_if(cheap).alias("discounted"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_quantity").alias("max_quantity"), F.max(F.when(cheap, F.col("l_quantity"))).alias("max_discounted"),
        F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct(F.when(cheap, F.col("l_suppkey"))).alias("discount_suppliers"))


@query("collected_names", "SELECT p_type, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands, COUNT(DISTINCT p_brand) AS n FROM part GROUP BY p_type")
def collected_names(dom: Domain) -> DataFrame:
    sets = dom.table("part").groupBy("p_type").agg(F.array_sort(F.collect_set("p_brand")).alias("s"))
    return sets.select("p_type", F.array_join("s", ", ").alias("brands"), F.size("s").cast("bigint").alias("n"))


@query("union_of_arrays", """SELECT report_code, string_agg(DISTINCT CAST(user_id AS VARCHAR), ',' ORDER BY CAST(user_id AS VARCHAR)) AS players FROM fight_players GROUP BY report_code""")
def union_of_arrays(dom: Domain) -> DataFrame:
    """Pull members of a report: at most fifty users per report."""
    lists = dom.fights().groupBy("report_code").agg(F.array_distinct(F.flatten(F.collect_set("friendly_player_ids"))).alias("ids"))
    return lists.select("report_code", F.array_join(F.array_sort(F.transform("ids", lambda i: i.cast("string"))), ",").alias("players"))


@query("latest_order_value", """SELECT o_custkey, ARG_MAX(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status, ARG_MAX(o_orderkey, (o_orderdate, o_orderkey)) AS last_order,
    ARG_MAX(o_orderkey, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = 'F') AS last_finished FROM orders GROUP BY o_custkey""")
def latest_order_value(dom: Domain) -> DataFrame:
    when = F.struct("o_orderdate", "o_orderkey")
    return dom.table("orders").groupBy("o_custkey").agg(
        F.max_by("o_orderstatus", when).alias("last_status"), F.max_by("o_orderkey", when).alias("last_order"),
        F.max_by("o_orderkey", F.when(F.col("o_orderstatus") == "F", when)).alias("last_finished"))


@query("first_value_by_order", "SELECT o_custkey, ARG_MIN(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority FROM orders GROUP BY o_custkey")
def first_value_by_order(dom: Domain) -> DataFrame:
    return dom.table("orders").groupBy("o_custkey").agg(F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"))


@query("mode_per_key", """SELECT o_custkey, o_orderpriority AS priority, n FROM (SELECT o_custkey, o_orderpriority, COUNT(*) AS n,
    ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY COUNT(*) DESC, o_orderpriority) AS rn FROM orders GROUP BY o_custkey, o_orderpriority) t WHERE rn = 1""")
def mode_per_key(dom: Domain) -> DataFrame:
    return rows.mode_by(dom.table("orders"), ["o_custkey"], "o_orderpriority", "priority", "n")


@query("scope_rollup_orders", f"""SELECT o_custkey, CASE WHEN GROUPING(o_orderstatus) = 1 THEN 'All' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN GROUPING(o_orderpriority) = 1 THEN 'All' ELSE o_orderpriority END AS o_orderpriority, COUNT(*) AS orders, CAST(SUM({_CENTS.format(c='o_totalprice')}) AS BIGINT) AS price_cents
    FROM orders GROUP BY GROUPING SETS ((o_custkey, o_orderstatus, o_orderpriority), (o_custkey, o_orderstatus), (o_custkey, o_orderpriority), (o_custkey))""")
def scope_rollup_orders(dom: Domain) -> DataFrame:
    dims = ["o_orderstatus", "o_orderpriority"]
    fine = dom.table("orders").groupBy("o_custkey", *dims).agg(F.count(F.lit(1)).alias("orders"), F.sum(cents("o_totalprice")).alias("price_cents"))
    return scopes.scope_rollup(fine, ["o_custkey"], dims, [tuple(dims), ("o_orderstatus",), ("o_orderpriority",), ()],
                               {"orders": F.sum("orders"), "price_cents": F.sum("price_cents")}, labels=dims)


@query("approximate_median", "SELECT p_brand, quantile_disc(p_retailprice, 0.5) AS median_price, COUNT(*) AS parts FROM part GROUP BY p_brand")
def approximate_median(dom: Domain) -> DataFrame:
    return dom.table("part").groupBy("p_brand").agg(F.percentile_approx("p_retailprice", 0.5).alias("median_price"), F.count(F.lit(1)).alias("parts"))


@query("exact_quantiles", """SELECT l_returnflag, COUNT(*) AS n, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
    quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag""")
def exact_quantiles(dom: Domain) -> DataFrame:
    return ordered.exact_quantiles(dom.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"q1": 0.25, "median": 0.5, "q3": 0.75})


@query("ratio_with_guard", """SELECT user_id, COUNT(*) FILTER (event_type = 'error') / GREATEST(COUNT(*) FILTER (event_type = 'click' AND k > 95), 1) AS errors_per_click,
    ROUND(COUNT(*) FILTER (event_type = 'error') / GREATEST(COUNT(*), 1) * 100, 1) AS error_pct FROM ev GROUP BY user_id""")
def ratio_with_guard(dom: Domain) -> DataFrame:
    counted = dom["ev"].groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"),
                                               F.count_if((F.col("event_type") == "click") & (F.col("k") > 95)).alias("clicks"))
    return counted.select("user_id", v.ratio("errors", "clicks").alias("errors_per_click"), v.pct("errors", "n").alias("error_pct"))


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(dom: Domain) -> DataFrame:
    return dom.table("orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("dedup_ordered_rows", """SELECT user_id, event_type, event_id, k, n AS copies FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY k DESC, event_id DESC) AS rn,
    COUNT(*) OVER (PARTITION BY user_id, event_type) AS n FROM ev) t WHERE rn = 1""")
def dedup_ordered_rows(dom: Domain) -> DataFrame:
    return rows.dedup_ordered(dom["ev"].select("user_id", "event_type", "event_id", "k"), ["user_id", "event_type"], ["k", "event_id"], count_as="copies")


# --- windows -------------------------------------------------------------------------------

@query("latest_per_key", "SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ev) t WHERE rn = 1")
def latest_per_key(dom: Domain) -> DataFrame:
    return rows.latest_by(dom["ev"], ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("top_n_per_key", f"""SELECT o_custkey, o_orderkey, rn AS place FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY {_CENTS.format(c='o_totalprice')} DESC, o_orderkey) AS rn
    FROM orders) t WHERE rn <= 3""")
def top_n_per_key(dom: Domain) -> DataFrame:
    return rows.top_n_by(dom.table("orders"), ["o_custkey"], [cents("o_totalprice").desc(), F.col("o_orderkey").asc()], 3, rank_as="place").select(
        "o_custkey", "o_orderkey", F.col("place").cast("bigint").alias("place"))


@query("duplicate_counts", "SELECT doc_id, COUNT(*) OVER (PARTITION BY md5(text)) AS copies FROM documents")
def duplicate_counts(dom: Domain) -> DataFrame:
    hashed = dom.table("documents").select("doc_id", F.md5("text").alias("_h"))
    return rows.with_duplicate_count(hashed, ["_h"], "copies").drop("_h")


@query("duplicate_ordinals", "SELECT md5(text) AS text_hash, ROW_NUMBER() OVER (PARTITION BY md5(text) ORDER BY lang) AS copy_no, lang FROM documents")
def duplicate_ordinals(dom: Domain) -> DataFrame:
    """Equal rows collapse to a count, are numbered as runs, and expand again."""
    copies = rows.collapse_copies(dom.table("documents").select(F.md5("text").alias("text_hash"), "lang"))
    placed = ordered.running(copies, ["text_hash"], [F.col("lang").asc()], {"_upto": ("sum", "_copies")})
    expanded = rows.expand_copies(placed, chunk=2)
    return expanded.select("text_hash", (F.col("_upto") - F.col("_copies") + F.col("_copy") + 1).alias("copy_no"), "lang")


@query("rank_in_scope", f"""SELECT c_mktsegment, c_custkey, ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY {_CENTS.format(c='c_acctbal')} DESC, c_custkey) AS place,
    COUNT(*) OVER (PARTITION BY c_mktsegment) AS total, CASE WHEN COUNT(*) OVER (PARTITION BY c_mktsegment) <= 1 THEN 100.0::DOUBLE ELSE
    ROUND((COUNT(*) OVER (PARTITION BY c_mktsegment) - ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY {_CENTS.format(c='c_acctbal')} DESC, c_custkey))
    / (COUNT(*) OVER (PARTITION BY c_mktsegment) - 1) * 100, 1) END AS percentile FROM customer""")
def rank_in_scope(dom: Domain) -> DataFrame:
    placed = ordered.ranked(dom.table("customer").select("c_mktsegment", "c_custkey", "c_acctbal"), ["c_mktsegment"],
                            [cents("c_acctbal").desc(), F.col("c_custkey").asc()], "place", "total")
    return placed.select("c_mktsegment", "c_custkey", F.col("place").cast("bigint").alias("place"), "total", v.rank_percentile("place", "total").alias("percentile"))


_SO_FAR = "OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


@query("running_values", f"""SELECT event_id, COUNT(*) {_SO_FAR} AS seen, CAST(SUM(cents) {_SO_FAR} AS BIGINT) AS total_cents, MIN(cents) {_SO_FAR} AS low, MAX(cents) {_SO_FAR} AS high,
    LAG(k) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before, LAST_VALUE(CASE WHEN k % 10 = 0 THEN k END IGNORE NULLS) {_SO_FAR} AS last_round FROM ev""")
def running_values(dom: Domain) -> DataFrame:
    """Five keys hold all events, so the scan is cut into ordered slices."""
    e = dom["ev"].select("event_id", "event_type", "ts", "cents", "k", F.when(F.col("k") % 10 == 0, F.col("k")).alias("_round"))
    done = ordered.running(e, ["event_type"], [F.col("ts").asc(), F.col("event_id").asc()], {
        "seen": ("count", None), "total_cents": ("sum", "cents"), "low": ("min", "cents"), "high": ("max", "cents"), "before": ("prev", "k"),
        "last_round": ("last", "_round")})
    return done.select("event_id", "seen", "total_cents", "low", "high", "before", "last_round")


@query("source_priority_dedup", """SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END,
    ts DESC, event_id DESC) AS rn FROM ev) t WHERE rn = 1""")
def source_priority_dedup(dom: Domain) -> DataFrame:
    return rows.latest_by(dom["ev"], ["user_id"], [(F.col("event_type") == "purchase").desc(), "ts", "event_id"]).select("user_id", "event_id", "event_type")


# --- sorts, sets, names --------------------------------------------------------------------

@query("profile_candidates", """SELECT player_name, realm FROM (SELECT name AS player_name, realm, TRUE AS t, 0 AS k, last_raid_date AS d FROM raid_team UNION ALL
    SELECT player_name, 'home', FALSE, COUNT(*), MAX(raid_night_date) FROM kill_roster GROUP BY player_name) x GROUP BY player_name, realm
    ORDER BY MAX(t) DESC, MAX(k) DESC, MAX(d) DESC NULLS LAST, player_name, realm LIMIT 100""")
def profile_candidates(dom: Domain) -> DataFrame:
    """The capped list is the job's own feature."""
    t = catalog(dom)
    return publish.profile_candidates(t["gold_raid_team"], t["gold_boss_kill_roster"], "home", cap=100)


@query("run_candidates", """SELECT player_name, realm_slug, 'eu' AS region FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY LOWER(player_name), realm_slug ORDER BY src, player_name) AS rn FROM
    (SELECT name AS player_name, realm_slug, 0 AS src FROM labelled_members UNION ALL SELECT name, realm_slug, 1 FROM dim_member WHERE is_active UNION ALL
    SELECT name, realm, 2 FROM raid_team UNION ALL SELECT player_name, 'realm-9', 3 FROM dim_player WHERE is_raid_team) x) y WHERE rn = 1 AND src < 3""")
def run_candidates(dom: Domain) -> DataFrame:
    t = catalog(dom)
    return publish.run_candidates(t["silver_guild_members"], t["gold_guild_roster"], t["gold_raid_team"], "home", "eu")


@query("union_of_branches", """SELECT user_id, CAST(k AS DOUBLE) AS score, 'click' AS branch FROM ev WHERE event_type = 'click' UNION ALL
    SELECT user_id, NULL, 'error' FROM ev WHERE event_type = 'error'""")
def union_of_branches(dom: Domain) -> DataFrame:
    e = dom["ev"]
    clicks = e.filter("event_type = 'click'").select("user_id", F.col("k").cast("double").alias("score"), F.lit("click").alias("branch"))
    errors = e.filter("event_type = 'error'").select(F.lit("error").alias("branch"), "user_id")
    return rows.union_branches([clicks, errors])


@query("union_distinct_names", "SELECT player_name FROM actors UNION SELECT name FROM members")
def union_distinct_names(dom: Domain) -> DataFrame:
    return dom["actors"].select("player_name").union(dom["members"].select("name")).distinct()


_NORMAL = "TRIM(regexp_replace(replace(LOWER({c}), '''', ''), '\\s+', ' ', 'g'), ' ')"


@query("normalized_text", f"SELECT doc_id, md5({_NORMAL.format(c='text')}) AS text_hash FROM documents")
def normalized_text(dom: Domain) -> DataFrame:
    return dom.table("documents").select("doc_id", F.md5(nm.normalize_name("text")).alias("text_hash"))


@query("classified_words", """SELECT doc_id, COUNT(*) AS hits, COUNT(DISTINCT w) AS words FROM (SELECT doc_id, UNNEST(string_split(text, ' ')) AS w FROM documents) t
    WHERE TRIM(regexp_replace(replace(LOWER(w), '''', ''), '\\s+', ' ', 'g'), ' ') IN ('the', 'and') OR LOWER(replace(w, '''', '')) LIKE '%tion%' GROUP BY doc_id""")
def classified_words(dom: Domain) -> DataFrame:
    words = dom.table("documents").select("doc_id", nm.classify_names(F.split("text", " ", -1), ("the", "and"), ("tion",)).alias("w"))
    return words.filter(F.size("w") > 0).select("doc_id", F.size("w").cast("bigint").alias("hits"), F.size(F.array_distinct("w")).cast("bigint").alias("words"))


@query("merged_names", """SELECT report_code, fight_id, player_name, CASE WHEN weapon_enhancement_names = 'Oil of Dawn' THEN 'Oil of Dawn | Flametongue Weapon'
    WHEN weapon_enhancement_names IS NULL THEN 'Oil of Dawn | Flametongue Weapon' ELSE 'Flametongue Weapon | Oil of Dawn' END AS names FROM perf""")
def merged_names(dom: Domain) -> DataFrame:
    return dom["perf"].select("report_code", "fight_id", "player_name",
                              nm.merge_name_columns("weapon_enhancement_names", F.lit(" Oil of Dawn ||Flametongue Weapon")).alias("names"))


@query("minutes_and_seconds", "SELECT report_code, fight_id, printf('%dm %02ds', duration_seconds // 60, duration_seconds % 60) AS shown FROM fights")
def minutes_and_seconds(dom: Domain) -> DataFrame:
    return dom["fights"].select("report_code", "fight_id", v.mm_ss("duration_seconds").alias("shown"))


@query("identity_keys", "SELECT DISTINCT LOWER(CONCAT(player_name, ':', player_class, ':', COALESCE(realm, 'unknown'))) AS player_identity_key FROM e")
def identity_keys(dom: Domain) -> DataFrame:
    return dom["actors"].select(nm.identity_key("player_name", "player_class", "realm").alias("player_identity_key")).distinct()


@query("realm_slugs", """SELECT p_partkey, CASE WHEN replace(p_name, ' ', '') = 'redwidget' THEN 'Red-Widget!' ELSE replace(p_name, ' ', '-') END AS slug FROM part""")
def realm_slugs(dom: Domain) -> DataFrame:
    """Part names in capitals and spaces turned to slugs, with one override."""
    titled = F.initcap(F.concat(F.lit(" "), "p_name"))
    return dom.table("part").select("p_partkey", nm.realm_slug(titled, "home", {"redwidget": "Red-Widget!"}).alias("slug"))


@query("loose_search", r"""SELECT doc_id, source FROM documents WHERE contains(regexp_replace(strip_accents(LOWER(text)), '[^a-z0-9]', '', 'g'), 'theand') OR
    (starts_with(regexp_replace(strip_accents(LOWER(text)), '[^a-z0-9]', '', 'g'), 'the') AND regexp_matches(regexp_replace(strip_accents(LOWER(text)), '[^a-z0-9]', '', 'g'), '^t.*h.*e.*a.*n.*d'))""")
def loose_search(dom: Domain) -> DataFrame:
    """Whole document texts, accents folded."""
    return dom.table("documents").filter(nm.loose_match("text", "Thé And")).select("doc_id", "source")


@query("bucketed_wipes", """SELECT report_code, fight_id, CASE WHEN last_phase <= 1 THEN 'Phase 1' WHEN last_phase = 2 THEN 'Phase 2' ELSE 'Phase 3+' END AS phase,
    CASE WHEN duration_seconds < 60 THEN '< 1 min' WHEN duration_seconds < 180 THEN '1-3 min' WHEN duration_seconds < 300 THEN '3-5 min' ELSE '5+ min' END AS length
    FROM fights WHERE NOT is_kill""")
def bucketed_wipes(dom: Domain) -> DataFrame:
    return dom["fights"].filter("NOT is_kill").select("report_code", "fight_id", v.phase_bucket("last_phase").alias("phase"), v.duration_bucket("duration_seconds").alias("length"))


