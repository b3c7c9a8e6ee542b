"""Headline queries at one scale factor; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "a01_spot_qc", "a04_distribution", "a06_group_summaries", "a09_state_and_reason_counts", "a13_roi_pseudobulk",
    "a14_roi_effects", "a19_factorial_effects", "a27_qc_score", "j04_roi_match", "j07_hex_neighbours",
    "j09_join_summary", "p06_eligibility_reasons", "w01_barcode_rank", "w08_benjamini_hochberg", "w12_threshold_warnings",
    "m01_highly_variable_genes", "m03_principal_components", "m05_nearest_neighbors", "m09_normalized_mutual_information",
    "m13_connected_components", "m18_moran", "m26_size_factors", "m27_replicated_effects", "m31_enrichment_score",
    "v21_forbidden_text",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [x for x in os.environ.get("BENCH_QUERIES", "").split(",") if x] or list(HEADLINE)
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from spotweave.functions.runtime import durable_scope, own_checkpoint_dir
    from spotweave.plans import catalog

    own_checkpoint_dir(spark)
    seconds: dict[str, float] = {}
    # One untimed query starts the JVM's compilers and the file cache.
    catalog.QUERIES["a01_spot_qc"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        start = time.time()
        with durable_scope(spark):
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
