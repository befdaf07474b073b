"""Times headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local threads.
"""

from __future__ import annotations

import json
import os
import time

from shelfwise.plans import all_queries
from shelfwise.plans.data import stored
from shelfwise.session import build_session

HEADLINE = (
    "p11_integrity_audit", "a1_row_count", "a2_distinct_valid", "a3_flag_totals", "a5_review_panel", "a6_collapse_panel",
    "a9_price_histogram", "a10_owners_by_flag", "a11_hits_by_quarter", "a12_success_prior", "a14_posterior", "a15_null_profile",
    "a17_near_constant", "p1_dedupe_keep_first", "w1_group_totals", "w3_top_k_per_group", "x20_pseudonym", "t8_seeded_sample",
    "m3_stratified_split", "j10_nearest_vectors", "l1_master", "l1_stage1", "m1_select_features", "s9_typed_export", "s11_master_export",
    "st1_review_stream", "st2_incremental_ingest",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    run, times = all_queries().QUERIES, {}
    # Session start and the first scan are not part of any query.
    spark.read.parquet(f"{sf}/orders.parquet").selectExpr("sum(o_totalprice)").collect()
    # Nor are the feature tables that several queries read; l1_master and l1_stage1 time them.
    for name in ("master", "stage1"):
        stored(spark, sf, name)
    for name in HEADLINE:
        start = time.perf_counter()
        run[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
