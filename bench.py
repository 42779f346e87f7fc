"""Times the queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

One warm-up, then the median of $BENCH_RUNS runs, each written to the noop sink. Set $BENCH_QUERIES
to a comma-separated list to time only some.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from cohortflow.queries import QUERIES
from cohortflow.session import clear_scratch, local_session

# Queries that stand for the stages of the work, from lab tables to release.
HEADLINE = (
    "lims_flat",
    "expand_cohort",
    "expand_cohorts_last_run",
    "run_sheet",
    "sample_summary",
    "across_libs",
    "compile_qc",
    "update_metadata",
    "overwrite_join",
    "new_runs",
    "pending_runs",
    "queue",
    "package_plan",
    "scrub",
    "processed_counts",
    "purge_plan",
    "paste_geno",
    "geno_lines",
    "forge",
    "validate",
    "checksum_rows",
    "params",
    "clip",
    "downsample",
    "mt_ratio",
    "coverage",
    "haploid",
)


def timed(query, spark, sf_dir: str) -> float:
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    chosen = names.split(",") if names else HEADLINE
    spark = local_session(
        os.environ.get("BENCH_CPUS", str(os.cpu_count())), "cohortflow-bench", tempfile.mkdtemp(prefix="bench-")
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        timed(QUERIES[name], spark, sf_dir)
        times = [timed(QUERIES[name], spark, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
