"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from scoutlake.catalog import registry  # noqa: E402

HEADLINE = [
    "flagship_last_five_percentiles", "s4_lineup_unfold", "s10_event_scan", "p5_team_rows", "p15_pass_map",
    "j3_outer_match", "a2_team_from_players", "a3_entity_aggregate", "a5_pass_aggregate", "a12_nested_collection",
    "m1_player_metrics", "m3_window_aggregates", "w1_next_actor", "w4_percentile_rank", "w4_percentile_rank_global",
    "w7_running_index", "w9_period_buckets", "e4_closure", "e5_unify_stats", "e6_merge_identities",
    "r1_elo_final", "r2_match_rating", "r4_player_value", "c4_nearest_role", "n2_similar_pairs", "n3_top_similar",
    "n6_squad_similarity", "n7_heatmap_correlation", "n9_fit_score", "v1_density_field", "v5_match_series",
]


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("scoutlake-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='bench-')}").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    spark.read.parquet(f"{sf}/nation.parquet").count()
    times = {}
    for name in (sorted(queries) if names == ["all"] else names):
        start = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
