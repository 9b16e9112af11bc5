"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8). Each query is run to completion with the ``noop`` sink, so
the whole result is computed without collecting it to the driver.

Every query runs three times: the first (cold) run pays JVM and
code-generation warm-up; ``queries`` and ``value`` report the better of the
two warm runs (local timings of small jobs vary by several seconds from run
to run); ``cold`` lists the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from slugmend.plans import queries as Q  # noqa: E402
from slugmend.session import get_session  # noqa: E402

HEADLINE = [
    "run_log_rows",      # whole correction run over the queue (flagship)
    "correction_batch",  # the nightly run: next 150 SKUs, catalogue pruned
    "queue_next",        # anti join + top-k batch selection
    "run_summary",       # per-run report aggregates
    "critical_alert",    # bounded top-k per run
    "report_metrics",
    "slug_normalize",    # normalisation over whole documents and titles
    "slug_collisions",
    "wrongful_redirects",
    "redirect_outcome",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(
        f"local[{cpus}]",
        app_name="slugmend-bench",
        shuffle_partitions=max(cpus, 8),
        extra_conf={"spark.driver.memory": "16g"},
    )
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="slugmend-bench-ckpt-"))
    # warm-up: JVM, parquet footers, codegen caches
    Q.QUERIES["latest_run"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    cold: dict[str, float] = {}
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            df = Q.QUERIES[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - t0, 3))
        cold[name], times[name] = runs[0], min(runs[1:])
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold": cold,
                "cold_total": round(sum(cold.values()), 3),
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
