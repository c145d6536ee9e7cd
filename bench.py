"""Headline queries, timed from raw tables: prints one JSON line.

Every run starts with no shared tables (`forget_staged`), so each number holds the full cost of its query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tradeweave.plans.registry import registered
from tradeweave.session import build_session
from tradeweave.sources.mart import forget_staged

HEADLINE = [
    "table_nodes", "table_edges", "table_time_series", "table_shipments", "table_lc_transactions",
    "p2_derived_columns", "j11_document_vs_observation", "a4_describe_by_port", "w1_w2_rolling_mean_std",
    "w3_exponential_means", "w4_w5_w13_forecast_windows", "w8_edge_holdout_by_relation", "c2_c5_shipment_scores",
    "k9_stacked_feature_matrix", "k9_ranked_letters_of_credit", "k10_double_pledge", "k11_scenario_stress",
    "e1_shipment_delay_auc", "e11_j9_concordance", "e13_population_stability", "g1_degrees", "g4_pagerank",
    "g5_clustering", "g8_neighbour_propagation", "m5_ccc_component_models", "m9_shipment_multi_task", "x1_daily_totals_stream"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = registered()
    # warm session: code paths are compiled once on the first query, untimed
    queries[names[0]](spark, folder).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            forget_staged()
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs) if len(runs) < 3 else statistics.median(runs), 3)
        print(f"{name}: {[round(r, 2) for r in runs]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
