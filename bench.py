"""Benchmark the headline KPI reports and datasets.

Runs each query fully (``write.format("noop")`` executes every stage without
collecting rows to the driver) on ``$BENCH_SF_DIR`` (default sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# the dimensions first, each cold (what it needs that is not written yet is part of its time);
# the reports then read them
HEADLINE = [
    "dim_staff_hierarchy", "dim_salons_regions", "dim_educators", "union_all_places", "join_theta_residual", "dim_program_salons",
    "report_kpi", "report_kpi_brand", "report_education_star", "report_legacy_kpi", "report_legacy_salon",
    "report_coach_events", "report_role_roster", "fact_seminars", "fact_participations",
    "agg_distinct_participants", "window_sum_case", "window_running_count", "audit_fanout",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    from kpistar.session import build_session
    from kpistar.registry import QUERIES

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=parts,
                          extra={"spark.driver.memory": "16g"})
    keys = only or HEADLINE
    times = {}
    for k in keys:
        # timed from plan construction: includes writing any dimension the query is
        # the first to need (later queries of the session reuse it)
        t0 = time.perf_counter()
        df = QUERIES[k](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
           "spark": spark.version}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
