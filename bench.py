"""Time headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query's time covers planning and running it, its result fully computed but not collected.
"""

from __future__ import annotations

import json
import os
import time

from emberlog.session import build_session
from emberlog.workload.registry import queries

HEADLINE = (
    "pricing_summary", "top_n_per_key", "latest_per_key", "mode_per_key", "scope_rollup_orders", "exact_quantiles", "running_values",
    "rank_in_scope", "interval_join_casts", "asof_last_event", "hot_key_join", "duplicate_counts", "normalized_text", "loose_search",
    "silver_player_rankings", "silver_player_deaths", "silver_player_cast_events", "silver_player_combatant_buffs", "gold_boss_progression",
    "gold_raid_summary", "gold_boss_mechanics", "gold_player_attendance", "gold_boss_kill_roster", "gold_player_boss_performance",
    "gold_player_survivability_rankings", "gold_player_mplus_summary", "gold_player_utility_by_pull", "gold_wipe_survival_events",
    "gold_wipe_survival_discipline", "gold_preparation_readiness", "contract_report", "view_pull_series", "view_parse_shape",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.log.level": "ERROR"})
    spark.sparkContext.setLogLevel("ERROR")
    known, times = queries(), {}
    known["pricing_summary"](spark, sf_dir).count()  # start the session's classes before the clock
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
