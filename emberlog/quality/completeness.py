"""Landing completeness: payloads to fetch again, and gaps between products."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog import rules
from emberlog.functions import values as v
from emberlog.operators import rows
from emberlog.plans.silver import newest_rankings
from emberlog.sources import payloads


def file_ages(raw: DataFrame, today: Column) -> DataFrame:
    """One row per report: the days from its newest landing to ``today``."""
    return raw.groupBy("report_code").agg(F.datediff(today, F.to_date(F.max("_ingested_at"))).alias("file_age_days"))


def parse_completeness(raw: DataFrame, limit: float = rules.NULL_RANK_SHARE) -> DataFrame:
    """Per report: incomplete fights, fights, null and all parses of its newest rankings landing.

    Tanks and damage dealers count from the first metric, healers from the second. A record
    without the second metric counts all its fights as incomplete and no parses; a record that
    cannot be read counts nothing.
    """
    nothing = F.array().cast("array<double>")

    def ranks(fight: Column, *groups: str) -> Column:
        return F.concat(nothing, *[F.coalesce(F.transform(fight["roles"][g]["characters"], lambda c: c["rankPercent"]), nothing) for g in groups])

    def fights(payload: str, own: int, *groups: str) -> Column:
        counted = F.transform(f"{payload}.data", lambda f: F.struct(f["fightID"].alias("fight_id"), ranks(f, *groups).alias("ranks"), F.lit(own).alias("own")))
        return F.coalesce(counted, F.array().cast("array<struct<fight_id: bigint, ranks: array<double>, own: int>>"))

    landed = newest_rankings(raw).select("report_code", F.col("rankings_hps_json").isNull().alias("_legacy"), *[
        payloads.readable(text, "rankings").alias(name) for text, name in (("rankings_json", "_first"), ("rankings_hps_json", "_second"))])
    # a record counts if the first metric can be read, and the second where there is one
    whole = F.col("_first").isNotNull() & (F.col("_legacy") | F.col("_second").isNotNull())
    both = F.concat(fights("_first", 1, "tanks", "dps"), F.when(F.col("_legacy"), fights("_first", 0)).otherwise(fights("_second", 0, "healers")))
    # an outer explode keeps the optimiser from deriving a filter that would parse the payloads again
    each = landed.select("report_code", "_legacy", F.explode_outer(F.when(whole, both)).alias("f")).filter("f IS NOT NULL")
    per_fight = each.groupBy("report_code", "_legacy", F.col("f.fight_id").alias("fight_id")).agg(
        F.sum(F.size("f.ranks")).alias("_all"), F.sum(F.size(F.filter("f.ranks", lambda r: r.isNull()))).alias("_null"), F.max("f.own").alias("_own")).filter("_own = 1")
    bad = F.col("_legacy") | ((F.col("_all") > 0) & (v.ratio("_null", "_all") > limit))
    kept = F.when(F.col("_legacy"), 0)
    return per_fight.groupBy("report_code").agg(
        F.sum(bad.cast("int")).alias("incomplete_fights"), F.count(F.lit(1)).alias("total_fights"), F.sum(kept.otherwise(F.col("_null"))).alias("null_chars"),
        F.sum(kept.otherwise(F.col("_all"))).alias("total_chars"))


def backfill_decision(completeness: DataFrame, max_age_days: int = rules.BACKFILL_MAX_AGE_DAYS) -> DataFrame:
    """skip_complete, accept_final (too old to change) or refetch, by ``file_age_days``."""
    decision = (F.when(F.col("incomplete_fights") == 0, "skip_complete")
                .when(F.col("file_age_days") >= max_age_days, "accept_final").otherwise("refetch"))
    return completeness.withColumn("decision", decision)


def stale_landings(wanted: DataFrame, landed: DataFrame, payload_columns: tuple[str, ...], allow_multi: bool = True) -> DataFrame:
    """Reports to fetch again: nothing landed, fights not covered, a payload absent, or old multi-fight records.

    ``wanted`` holds (report_code, fight_id); ``landed`` holds report_code, fight_ids and payloads.
    """
    covered = landed.select("report_code", F.explode("fight_ids").alias("fight_id")).distinct()
    missing = wanted.join(covered, ["report_code", "fight_id"], "left_anti").groupBy("report_code").agg(
        F.count(F.lit(1)).alias("missing_fights"))
    absent = F.lit(False)
    for column in payload_columns:
        absent = absent | F.col(column).isNull()
    multi = F.size("fight_ids") > 1
    state = landed.groupBy("report_code").agg(F.max(absent).alias("_absent"), F.max(multi).alias("_multi"), F.lit(True).alias("_landed"))
    joined = wanted.select("report_code").distinct().join(missing, "report_code", "left").join(state, "report_code", "left")
    off = F.lit(False)
    flags = joined.select(
        "report_code", F.coalesce("missing_fights", F.lit(0)).alias("missing_fights"), F.col("_landed").isNull().alias("never_landed"),
        F.coalesce("_absent", off).alias("payload_absent"), (F.coalesce("_multi", off) & F.lit(not allow_multi)).alias("multi_fight_records"))
    return flags.filter("never_landed OR missing_fights > 0 OR payload_absent OR multi_fight_records")


def data_gaps(names: DataFrame, products: Mapping[str, DataFrame]) -> DataFrame:
    """Per player the products that hold no row for them; players with no gap are left out.

    The products are united as tags, so one aggregation replaces a join per product.
    """
    tags = [df.select("player_name", F.lit(label).alias("_has")) for label, df in products.items()]
    present = rows.union_branches([names.select("player_name", F.lit(None).cast("string").alias("_has"), F.lit(True).alias("_own")), *tags])
    found = present.groupBy("player_name").agg(F.collect_set("_has").alias("_found"), F.max("_own").alias("_own")).filter("_own")
    wanted = F.array(*[F.lit(label) for label in products])
    gaps = found.select("player_name", F.array_except(wanted, "_found").alias("gaps"))
    return gaps.filter(F.size("gaps") > 0)


def landed_fights(deaths: DataFrame) -> DataFrame:
    """Per report: fights landed one by one, as a sorted list, and their number."""
    single = deaths.filter(F.size("fight_ids") == 1).select("report_code", F.get("fight_ids", F.lit(0)).alias("fight_id")).distinct()
    return single.groupBy("report_code").agg(F.array_sort(F.collect_set("fight_id")).alias("fight_ids"), F.count(F.lit(1)).alias("fights"))
