"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidefold.queries import QUERIES
from tidefold.session import local_session

HEADLINE = [
    "agg1_latest_wins_fold",
    "agg1_fold_hot_documents",
    "prj1_normalise_events",
    "prj7_canonical_json",
    "prj8_typed_projection",
    "agg2_column_kinds",
    "agg3_bronze_types",
    "agg14_routed_counts",
    "str1_apply_changes_by_document",
    "jn5_manifest_diff",
    "jn9_longest_prefix",
    "src11_content_inventory",
    "win1_latest_checkpoint",
    "mon2_sync_summary",
    "mon5_table_row_counts",
    "str8_full_rebuild",
    "str9_incremental_staging",
    "str1_streaming_apply_changes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up, class loading and the first compilation are not the queries' cost.
    QUERIES["agg1_current_state"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
