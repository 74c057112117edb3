"""Times headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "findings_by_code",
    "nearest_label",
    "overruns_blank",
    "iou_match",
    "nms",
    "snap_to_rule",
    "blank_snap",
    "table_cells",
    "assign_names",
    "reading_order",
    "proximity_components",
    "validate_types",
    "validate_recompute",
    "resolve_fields",
    "fill_if_blank",
    "top_forms",
    "search_forms",
    "mention_cites",
    "guard_decision",
    "run_state",
    "verify_chain",
    "vote_consensus",
    "snapshot_drift",
    "quality_report",
)


def main() -> int:
    from formloom.plans import registry
    from formloom.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    registry.load()
    spark = local_session(cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the JVM's threads
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())
