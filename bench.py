"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs fully (a no-op sink forces every stage) once to warm up and
then three times; the median is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trustgrid.plans.catalog import REGISTRY  # noqa: E402
from trustgrid.session import get_session  # noqa: E402

HEADLINE = (
    "facility_verdicts", "facility_scorecard", "join_safe_lookup", "code_enrichment", "need_ranking",
    "survey_cells_parsed", "admin_long", "state_summary", "customer_trust_verdict", "trust_verdict_long",
    "fix_ranking", "before_after", "corroboration_bands", "completeness_by_source", "contract_results",
    "coverage_prediction", "point_in_polygon", "geo_resolution", "capability_extraction",
    "pipeline_checks", "district_fix_ranking", "expected_coverage", "fix_priorities", "district_fix_priorities",
    "indicator_trends", "code_counts", "code_values", "geo_conflicts", "facility_fact_profile",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    spark.sparkContext.setJobDescription(f"bench:{name}")   # names the jobs in event logs
    t0 = time.perf_counter()
    REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in REGISTRY]
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    results = {}
    for name in names:
        run_once(spark, name, sf_dir)
        results[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeats)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf}))


if __name__ == "__main__":
    main()
