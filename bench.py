"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose tables and cores.
One warm-up and three timed runs per query, the median counts. A run builds the plan and computes every row of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollbook.catalog import QUERIES  # noqa: E402
from rollbook.session import local_session  # noqa: E402

HEADLINE = [
    "job_faculty_enrolment", "job_programme_enrolment", "job_course_mart", "job_finance_long", "job_finance_names", "job_staff_fte",
    "job_timetable_workload", "job_payload_finance", "job_payload_staff", "job_payload_faculty", "job_payload_programme_students",
    "job_payload_programme", "job_payload_course", "job_validate_programme", "job_validate_courses",
    "src_csv_skip_preamble", "join_left_renamed_keys", "join_checked_cardinality", "join_contains_canonicalise", "agg_workload_ratio",
    "agg_list_histogram", "agg_string_collapse", "win_row_number_global", "win_rank_in_group", "win_top_k", "win_fill_down_up",
    "win_group_total", "win_keep_first", "pivot_wide_multi_value", "pivot_wide_list_cells", "unnest_parallel", "str_to_ascii",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "rollbook-bench")
    seconds, errors = {}, {}
    for name in HEADLINE:
        try:
            run(spark, name, sf_dir)
            seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(3)), 3)
        except Exception as error:  # noqa: BLE001 - the other queries are still measured
            errors[name] = str(error).splitlines()[0][:300]
    print(json.dumps({"metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
                      "errors": errors, "spark": spark.version, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions")}))
    spark.stop()
    if errors:
        sys.exit(1)


if __name__ == "__main__":
    main()
