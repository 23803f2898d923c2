"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from casewright.plans import registry  # noqa: E402
from casewright.session import clear_scratch, local_session  # noqa: E402

HEADLINE = (
    "s2_case_form_scan", "p6_suspect_rows", "p8_narrative", "p18_features", "a4_arrest_rows",
    "l3_propagate_closing", "c13_all_scores", "l8_case_roll_up", "n6_bulk_import",
    "n11_link_stats", "a7_multi_match", "m7_train", "e1_run_v3", "e2_run_v2",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cores, "bench", memory="16g")
    registry.QUERIES["s5_incident_notes"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names.split(",") if names else HEADLINE:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
