"""Headline-query timings.

Runs the main registered queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is executed in full with the ``noop`` sink (every row is produced,
nothing is collected to the driver).  Before timing, every headline query runs
once on the smallest tables (``$BENCH_WARMUP_DIR``, default sf0.001) so JVM JIT
and generated-code compilation are warm; the timed runs then measure the
target scale.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "unified_dataset",
    "unified_from_nested",
    "tax_by_property",
    "nested_left_prefix",
    "person_index",
    "match_type_theta",
    "upsert_properties",
    "refresh_manifest",
    "url_status_histogram",
    "sync_fold",
    "fk_integrity_counts",
    "attachment_plan",
    "quality_trend",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from parcelspark.session import get_session
    from parcelspark.plans.registry import all_queries

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        shared=tempfile.mkdtemp(prefix="bench-shared-", dir="/tmp"))
    qs = all_queries()
    times: dict[str, float] = {}
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for key in HEADLINE:  # warm-up: JIT and codegen of the same plans on tiny inputs
        qs[key](spark, warm_dir).write.format("noop").mode("overwrite").save()
    for key in HEADLINE:
        t0 = time.perf_counter()
        qs[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
