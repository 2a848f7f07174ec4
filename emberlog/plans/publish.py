"""Snapshot publishing: dataset projections, checks, limits, manifest, and the newest full snapshot.

A snapshot is published in two steps. First its data is written and checked where no reader looks: readers
follow manifests only. Then one manifest file, which names every data file with its size and hash and the
contract it was held to, is moved into place. A run that fails before that leaves the earlier snapshot in
force, and a reader sees either all of a snapshot or nothing of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import names as nm
from emberlog.operators import rows
from emberlog.quality import contracts
from emberlog.quality.contracts import contract_report, declared
from emberlog.session import stored
from emberlog.sources import files
from emberlog.sources.sinks import JSON_OPTIONS, plain_numbers, write_json

Projection = Callable[[DataFrame], DataFrame]


def _columns(text: str) -> Projection:
    names = text.split()
    return lambda df: df.select(*names)


def _fields(table: str, *left_out: str) -> Projection:
    """The columns that the table's contract names, but for those left out."""
    return _columns(" ".join(f for f in contracts.FIELDS[table] if f not in left_out))


def named_zone(df: DataFrame) -> DataFrame:
    return df.filter("trim(zone_name) <> ''")


def real_players(df: DataFrame) -> DataFrame:
    return df.filter("trim(player_name) <> '' AND lower(trim(player_name)) <> 'nil'")


def _then(first: Projection, second: Projection) -> Projection:
    return lambda df: second(first(df))


_CAPACITY = ("possible_casts", "observed_casts", "actual_casts", "over_capacity_casts", "missed_casts")


def ability_totals(df: DataFrame) -> DataFrame:
    """Cooldown rows of single pulls summed per boss, player and ability."""
    keys = ("boss_name", "zone_name", "difficulty_label", "cooldown_category", "player_identity_key", "player_name", "player_class",
            "realm", "ability_id", "ability_name")
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _CAPACITY])


def distinct_pulls(df: DataFrame) -> DataFrame:
    return df.select("report_code", "fight_id", "boss_name", "zone_name", "difficulty_label", "is_kill", "player_name", "player_class").distinct()


def blank_texts(*names: str) -> Projection:
    return lambda df: df.fillna("", list(names))


# dataset -> (source table, projection)
DATASETS: dict[str, tuple[str, Projection]] = {
    "raid_summary": ("gold_raid_summary", _then(named_zone, _fields("gold_raid_summary"))),
    "player_attendance": ("gold_player_attendance", _then(real_players, _fields("gold_player_attendance"))),
    "boss_wipe_analysis": ("gold_boss_wipe_analysis", _fields("gold_boss_wipe_analysis")),
    "player_survivability": ("gold_player_survivability", _fields("gold_player_survivability")),
    "boss_progression": ("gold_boss_progression", _fields("gold_boss_progression")),
    "best_kills": ("gold_best_kills", _fields("gold_best_kills")),
    "player_performance_summary": ("gold_player_performance_summary", _fields("gold_player_performance_summary")),
    "boss_kill_roster": ("gold_boss_kill_roster", _fields("gold_boss_kill_roster", "combat_potion_casts", "healthstone_use", "bracket_percent", "rank_string")),
    "raid_team": ("gold_raid_team", _fields("gold_raid_team")),
    "preparation_readiness": ("gold_preparation_readiness", _then(
        blank_texts("readiness_notes", "latest_kill_date", "weakest_signal_label"), _fields("gold_preparation_readiness"))),
    "live_raid_roster": ("gold_live_raid_roster", _fields("gold_live_raid_roster")),
    "player_mplus_summary": ("gold_player_mplus_summary", _fields("gold_player_mplus_summary")),
    "weekly_activity": ("gold_weekly_activity", _fields("gold_weekly_activity")),
    "guild_roster": ("gold_guild_roster", _fields("gold_guild_roster")),
    "boss_mechanics": ("gold_boss_mechanics", _fields("gold_boss_mechanics")),
    "progression_timeline": ("gold_progression_timeline", _fields("gold_progression_timeline")),
    "guild_zone_ranks": ("gold_guild_zone_ranks", _fields("gold_guild_zone_ranks")),
    "player_character_media": ("gold_player_character_media", _fields("gold_player_character_media")),
    "player_character_equipment": ("gold_player_character_equipment", _fields("gold_player_character_equipment")),
    "player_raid_achievements": ("gold_player_raid_achievements", _fields("gold_player_raid_achievements")),
    "player_mplus_score_history": ("gold_player_mplus_score_history", _fields("gold_player_mplus_score_history")),
    "player_mplus_run_history": ("gold_player_mplus_run_history", _fields("gold_player_mplus_run_history")),
    "player_mplus_weekly_activity": ("gold_player_mplus_weekly_activity", _fields("gold_player_mplus_weekly_activity")),
    "player_mplus_dungeon_breakdown": ("gold_player_mplus_dungeon_breakdown", _fields("gold_player_mplus_dungeon_breakdown")),
    "boss_progress_history": ("gold_boss_progress_history", _fields("gold_boss_progress_history")),
    "boss_pull_history": ("gold_boss_pull_history", _fields("gold_boss_pull_history")),
    "encounter_catalog": ("gold_encounter_catalog", _fields("gold_encounter_catalog")),
    "player_utility_by_pull": ("gold_player_utility_by_pull", distinct_pulls),
    "wipe_survival_events": ("gold_wipe_survival_events", _columns(
        "boss_name zone_name difficulty_label player_name player_class killing_blow_name healthstone_before_death health_potion_before_death")),
    "wipe_cooldown_utilization": ("gold_wipe_cooldown_utilization", ability_totals),
    "wipe_survival_discipline": ("gold_wipe_survival_discipline", _fields("gold_wipe_survival_discipline")),
    "player_boss_performance": ("gold_player_boss_performance", _fields(
        "gold_player_boss_performance", "primary_spec", "avg_item_level", "first_kill_date", "latest_kill_date")),
    "player_death_events": ("gold_player_death_events", _fields("gold_player_death_events")),
    "player_survivability_rankings": ("gold_player_survivability_rankings", _fields("gold_player_survivability_rankings")),
    "preparation_overrides": ("identity_overrides", _columns(
        "id mode source_character target_character characters display_name enabled notes updated_by updated_at")),
}

# Columns a source must have before its dataset is published.
REQUIRED = {
    "wipe_cooldown_utilization": ("player_identity_key", *_CAPACITY),
    "wipe_survival_discipline": ("player_identity_key", "survival_discipline_score", "defensive_tracking_status", "defensive_component_score",
                                 "healthstone_component_score", "potion_component_score"),
    "preparation_readiness": ("readiness_score", "readiness_label", "readiness_notes", "weakest_signal_label"),
    "player_attendance": ("player_identity_key", "player_realm"), "player_performance_summary": ("player_identity_key",),
    "boss_kill_roster": ("player_identity_key", "realm"), "player_mplus_summary": ("player_identity_key",),
    "player_survivability_rankings": ("player_identity_key",),
}


def missing_columns(sources: Mapping[str, DataFrame]) -> list[tuple[str, str]]:
    """(dataset, column) pairs a source lacks; from the schema alone."""
    return [(d, c) for d, needed in REQUIRED.items() if DATASETS[d][0] in sources
            for c in needed if c not in sources[DATASETS[d][0]].columns]


def project(dataset: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    source, projection = DATASETS[dataset]
    return projection(tables[source])


def dataset_sizes(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and JSON bytes per dataset, with whether they pass the limits; one aggregation each."""
    def size(name: str, df: DataFrame):
        plain = plain_numbers(df)
        text = F.to_json(F.struct(*[F.col(c) for c in plain.columns]), JSON_OPTIONS)
        limit = rules.DATASET_BYTE_LIMITS.get(name, rules.MAX_DATASET_BYTES)
        # A JSON array: its rows, a comma or bracket after each, and one bracket.
        counted = plain.agg(F.count(F.lit(1)).alias("row_count"), (F.coalesce(F.sum(F.octet_length(text) + 1), F.lit(1)) + 1).cast("bigint").alias("byte_size"))
        return counted.select(F.lit(name).alias("dataset"), "row_count", "byte_size",
                              ((F.col("row_count") <= rules.MAX_DATASET_ROWS) & (F.col("byte_size") <= limit)).alias("within_limits"))
    return rows.union_branches([size(n, d) for n, d in datasets.items()])


SLICE_BYTES = 8 << 20


def written_bytes(table: DataFrame, path: str, slice_bytes: int = SLICE_BYTES) -> int:
    """Bytes of the JSON files of a stored table, all written below ``path`` and counted.

    The text can be sixty times as long as the table, so it is written and deleted slice by slice of the table's files.
    """
    spark, found = table.sparkSession, 0
    for part in files.slices(spark, table.stored_path, slice_bytes):
        write_json(spark.read.schema(table.schema).parquet(*part), path)
        found += files.byte_count(spark, path)
        files.remove(spark, path)
    return found


MANIFEST = ("snapshot_id STRING, generated_at STRING, dataset STRING, path STRING, row_count BIGINT, byte_size BIGINT, source_table STRING, "
            "contract_id STRING, contract_version STRING, files ARRAY<STRUCT<name: STRING, bytes: BIGINT, sha256: STRING>>")


def data_path(snapshot_id: str, dataset: str) -> str:
    """Where a dataset of a snapshot lies, seen from the root."""
    return f"snapshots/snapshot_id={snapshot_id}/{dataset}"


def contract_of(dataset: str) -> contracts.Contract | None:
    """The contract of the table that a dataset is made from; what users enter themselves has none."""
    source = DATASETS[dataset][0]
    return declared(source) if source in contracts.FIELDS else None


def data_files(spark: SparkSession, root: str, snapshot_id: str) -> DataFrame:
    """``dataset, files`` of a snapshot: name, bytes and SHA-256 of each data file, read by the executors.

    A task holds one file at a time; ``write_json`` keeps files short enough for that.
    """
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/snapshots/snapshot_id={snapshot_id}")
    each = landed.select(F.element_at(F.split("path", "/"), -2).alias("dataset"), F.struct(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).alias("f"))
    return each.groupBy("dataset").agg(F.array_sort(F.collect_list("f")).alias("files"))


def manifest(spark: SparkSession, sizes: DataFrame, snapshot_id: str, generated_at: str, listed: DataFrame | None = None) -> DataFrame:
    """One row per dataset of a snapshot: where it is, its size, its source, its contract and its files."""
    held = [(d, t, data_path(snapshot_id, d), *((contracts.contract_id(c), c.version) if (c := contract_of(d)) else (None, None))) for d, (t, _) in DATASETS.items()]
    sources = spark.createDataFrame(held, "dataset STRING, source_table STRING, path STRING, contract_id STRING, contract_version STRING")
    joined = sizes.drop("within_limits").join(F.broadcast(sources), "dataset", "left")
    joined = joined.join(listed, "dataset", "left") if listed is not None else joined
    names = ["dataset", "path", "row_count", "byte_size", "source_table", "contract_id", "contract_version", *(["files"] if listed is not None else [])]
    return joined.select(F.lit(snapshot_id).alias("snapshot_id"), F.lit(generated_at).alias("generated_at"), *names)


def manifest_path(root: str, snapshot_id: str) -> str:
    return f"{root}/manifests/{snapshot_id}.json"


def commit(spark: SparkSession, root: str, snapshot_id: str, listed: DataFrame) -> None:
    """Move the manifest of a snapshot into place, as one file under one name: the step that publishes it."""
    target = manifest_path(root, snapshot_id)
    staging = f"{root}/staging/{snapshot_id}"
    listed.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(staging)
    part = next(n for n in files.names(spark, staging) if n.startswith("part-"))
    files.move_new(spark, f"{staging}/{part}", target)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{root}/manifests")


def damaged_files(spark: SparkSession, root: str, listed: DataFrame) -> DataFrame:
    """``snapshot_id, dataset, name, problem`` of files that a manifest names but that are not there as named."""
    named = listed.select("snapshot_id", "dataset", F.explode("files").alias("f")).select("snapshot_id", "dataset", "f.*")
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/snapshots").select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.element_at(F.split("path", "/"), -2).alias("dataset"),
        F.regexp_extract("path", "snapshot_id=([^/]*)", 1).alias("snapshot_id"), F.sha2("content", 256).alias("found"))
    checked = named.join(there, ["snapshot_id", "dataset", "name"], "left")
    problem = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("sha256"), "changed")
    return checked.select("snapshot_id", "dataset", "name", problem.alias("problem")).filter("problem IS NOT NULL")


def read_published(spark: SparkSession, root: str, dataset: str, schema: str, names: Sequence[str] = ()) -> DataFrame:
    """A dataset of the newest complete snapshot, from exactly the files that its manifest names."""
    newest = latest_complete_snapshot(read_manifests(spark, root), tuple(names or DATASETS))
    found = newest.filter(F.col("dataset") == dataset).first()
    if found is None:
        raise ValueError("no complete snapshot")
    paths = [f"{root}/{found['path']}/{f['name']}" for f in found["files"]]
    return spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)


def manifest_mismatch(listed: DataFrame, expected: DataFrame) -> DataFrame:
    """Datasets that are expected but not listed, or listed but not expected."""
    missing = expected.select("dataset").join(listed.select("dataset"), "dataset", "left_anti").select("dataset", F.lit("missing").alias("problem"))
    extra = listed.select("dataset").distinct().join(expected.select("dataset"), "dataset", "left_anti").select("dataset", F.lit("extra").alias("problem"))
    return missing.unionByName(extra)


def latest_complete_snapshot(manifests: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Manifest rows of the newest snapshot that lists every expected dataset, and no other."""
    known = F.col("dataset").isin(*expected)
    counts = manifests.groupBy("snapshot_id").agg(F.countDistinct(F.when(known, F.col("dataset"))).alias("_n"), F.count_if(~F.coalesce(known, F.lit(False))).alias("_other"))
    complete = counts.filter((F.col("_n") == len(set(expected))) & (F.col("_other") == 0))
    newest = complete.agg(F.max("snapshot_id").alias("snapshot_id"))
    return manifests.join(newest, "snapshot_id", "left_semi")


def violations(tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """Contract rules that datasets break, held to the contracts as declared: one row per dataset and check."""
    reports = []
    for name in names:
        contract = contract_of(name)
        if contract:
            frame = project(name, tables)
            report = contract_report(frame, contract.project(frame.columns))
            reports.append(report.filter("violations > 0").withColumn("dataset", F.lit(name)))
    return rows.union_branches(reports)


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, snapshot_id: str, generated_at: str,
            names: tuple[str, ...] = tuple(DATASETS), enforce_limits: bool = False, strict: bool = True,
            release: Callable[[str], None] | None = None) -> DataFrame:
    """Check, write and list the datasets of one snapshot; returns its manifest.

    Tables are held to the contracts as declared: a column that is missing, of another type, or against a
    rule stops the run before the manifest is written. Without ``strict`` broken rules are only reported. A
    published snapshot is never written again. ``release`` is told the table of each dataset once that dataset
    no longer reads it.
    """
    if files.exists(spark, manifest_path(root, snapshot_id)):
        raise ValueError(f"snapshot {snapshot_id} is published already")
    lacking = missing_columns(tables)
    for name in names:
        contract = contract_of(name)
        lacking += [(name, c) for _, c in contracts.schema_violations(tables[DATASETS[name][0]], contract)] if contract else []
    if lacking:
        raise ValueError(f"Source columns missing: {sorted(set(lacking))}")
    frames, reports = {}, []
    for name in names:
        frame, path = project(name, tables), f"{root}/{data_path(snapshot_id, name)}"
        write_json(frame, path)
        frames[name] = spark.read.schema(plain_numbers(frame).schema).json(path)
        if contract_of(name):
            reports.append(stored(violations(tables, [name])))
        if release:
            release(DATASETS[name][0])
    # one row per broken rule, so no longer than the contracts
    report = rows.union_branches(reports) if reports else None
    broken = report.collect() if reports else []
    if broken:
        report.write.mode("overwrite").parquet(f"{root}/contract_reports/snapshot_id={snapshot_id}")
        if strict:
            raise ValueError(f"{len(broken)} contract rules violated: {[tuple(r) for r in broken]}")
    sizes = stored(dataset_sizes(frames))
    if enforce_limits:
        over = sizes.filter("NOT within_limits").select("dataset").collect()
        total = sizes.agg(F.sum("byte_size")).first()[0]
        if over or total > rules.MAX_TOTAL_BYTES:
            raise ValueError(f"Size limits exceeded: {[r.dataset for r in over]}, total {total}")
    commit(spark, root, snapshot_id, manifest(spark, sizes, snapshot_id, generated_at, data_files(spark, root, snapshot_id)))
    return read_manifests(spark, root).filter(F.col("snapshot_id") == snapshot_id)


def export(spark: SparkSession, tables: Mapping[str, DataFrame], dataset: str, path: str) -> DataFrame:
    """Write one dataset on its own, after the same checks; its row of sizes."""
    contract = contract_of(dataset)
    lacking = [(d, c) for d, c in missing_columns(tables) if d == dataset]
    lacking += [(dataset, c) for _, c in contracts.schema_violations(tables[DATASETS[dataset][0]], contract)] if contract else []
    if lacking:
        raise ValueError(f"Source columns missing: {lacking}")
    broken = violations(tables, [dataset]).collect() if contract else []
    if broken:
        raise ValueError(f"{len(broken)} contract rules violated: {[tuple(r) for r in broken]}")
    frame = project(dataset, tables)
    write_json(frame, path)
    return dataset_sizes({dataset: spark.read.schema(plain_numbers(frame).schema).json(path)})


# --- candidate lists of the profile jobs ---------------------------------------------------

def profile_candidates(team: DataFrame, roster: DataFrame, default_realm: str, cap: int = 0) -> DataFrame:
    """Characters to fetch: team first, then most kills, latest seen and name; ``cap`` is the job's own top-k."""
    own = team.filter("name <> ''").select(
        F.col("name").alias("player_name"), F.coalesce(F.nullif("realm", F.lit("")), F.lit(default_realm)).alias("realm"),
        F.lit(True).alias("is_raid_team"), F.lit(0).cast("bigint").alias("kills_tracked"), F.col("last_raid_date").alias("latest_seen_date"))
    seen = roster.filter("player_name <> ''").groupBy("player_name").agg(
        F.count(F.lit(1)).alias("kills_tracked"), F.max("raid_night_date").alias("latest_seen_date")).select(
        "player_name", F.lit(default_realm).alias("realm"), F.lit(False).alias("is_raid_team"), "kills_tracked", "latest_seen_date")
    merged = own.unionByName(seen).groupBy("player_name", "realm").agg(
        *[F.max(c).alias(c) for c in ("is_raid_team", "kills_tracked", "latest_seen_date")])
    ordered = merged.orderBy(F.col("is_raid_team").desc(), F.col("kills_tracked").desc(), F.col("latest_seen_date").desc_nulls_last(), "player_name", "realm")
    return (ordered.limit(cap) if cap else ordered).select("player_name", "realm")


def run_candidates(members: DataFrame, guild: DataFrame, team: DataFrame, default_realm: str, region: str) -> DataFrame:
    """Characters of three identity tables, the first source winning a name, realm and region."""
    def shaped(df: DataFrame, realm: str) -> DataFrame:
        return df.filter("trim(name) <> ''").select(F.trim("name").alias("player_name"),
                                                    nm.realm_slug(realm, default_realm).alias("realm_slug"), F.lit(region).alias("region"))
    sources = [shaped(members, "realm_slug"), shaped(guild.filter("is_active"), "realm"), shaped(team, "realm")]
    return rows.first_source_wins(sources, [F.lower("player_name"), F.col("realm_slug"), F.col("region")]).drop("_source_no")
