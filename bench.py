"""Wall time of the headline queries on one scale directory; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from cladegrid.plans.tables import QUERIES
from cladegrid.session import local_session

HEADLINE = (
    "occupancy_class", "membership_copies", "presence_matrix", "rarefaction_exact", "unit_class_distribution", "mode_by_strata",
    "best_alignment_hits", "evidence_intersection", "merged_pairs", "pair_strata_summary", "describe_by_group", "exact_quantiles",
    "kruskal_wallis", "rank_sum_statistics", "element_distribution", "element_counts", "interval_gaps", "interval_overlap_counts",
    "structure_metrics", "longest_per_parent", "expression_zscores", "abundance_summary", "start_windows", "sequence_mass",
    "incremental_reuse", "quality_checks", "hierarchy_violations", "master_table",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores), os.environ.get("BENCH_MEMORY", "16g"))
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    QUERIES["occupancy_class"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up, not timed
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
