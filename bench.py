"""Headline queries, timed. Prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all), BENCH_QUERIES
    (comma-separated names, default: the headline list, ``all``: every registered query)
"""

from __future__ import annotations

import json
import os
import tempfile
import time

HEADLINE = (
    "delta_inventory",
    "scan_inventory",
    "facility_prefix_scan",
    "facility_subset",
    "lookback_filter",
    "object_hash",
    "identity_duplicates",
    "latest_per_key",
    "upsert_by_hash",
    "upsert_merge",
    "dedupe_last_write",
    "scan_as_of",
    "greedy_batches",
    "greedy_batches_lines",
    "batch_digest",
    "structured_rows",
    "unstructured_rows",
    "extract_or_dead_letter",
    "cast_failures",
    "split_load",
    "schema_counts",
    "schema_prefixes",
    "missing_variables",
    "variance_report",
    "corpus_totals",
    "collection_sizes",
    "quantile_bins_lines",
    "fixed_bins",
    "describe_by_group",
    "payload_paths",
    "field_coverage",
    "mapping_correctness",
    "similar_attribute_pairs",
    "attribute_clusters",
    "prefix_summary",
    "category_summary",
    "stale_products",
    "collection_id",
    "pick_axes",
    "bbox_geometry",
    "dim_steps",
    "extent_rollup",
    "changed_objects",
    "item_documents",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    from fathom.session import build_session

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="fathom-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from suite import views
    from suite.catalog import QUERIES

    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else list(HEADLINE)

    # Inputs are stored tables, as on a cluster; writing them is timed on its own.
    start = time.time()
    views.header(spark, sf_dir)
    prepare = round(time.time() - start, 3)
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "prepare_header_table": prepare,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
