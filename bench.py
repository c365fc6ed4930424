"""Time the headline queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated names, or ``all``)
choose the data, the cores and the queries.
"""

from __future__ import annotations

import json
import os
import time

from flowlark.queries import QUERIES
from flowlark.session import build_session

HEADLINE = [
    "attribute_moments", "bytes_transferred", "moments_rollup", "interval_moments", "with_stats",
    "tumbling_window", "running_tumbling", "anchored_tumbling", "batch_wait", "batch_wait_varying",
    "identify_duplicate", "dedupe_ttl", "add_if_absent", "cache_contains",
    "route_bitmask", "split_dataflow", "retry_counter",
    "md5_attributes", "attributes_to_json_text", "create_json_content", "parse_tags_strict",
    "doc_find", "doc_aggregate", "doc_insert_unordered", "doc_insert_ordered", "doc_update_set",
    "doc_upsert", "bulk_lines", "bulk_apply", "bulk_response",
    "influx_lines", "series_query", "hierarchy_rollup", "metric_requests",
    "file_splits", "page_snapshots",
    "stream_tumbling", "stream_dedupe_ttl",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    parallel = str(max(8, int(cpus)) if cpus != "*" else 8)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": parallel,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Compile and start Python workers before the clock runs.
    QUERIES["attribute_moments"](spark, folder).write.format("noop").mode("overwrite").save()
    idle = spark.range(0, 1000, 1, 8).mapInArrow(lambda batches: batches, "id long")
    idle.write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
