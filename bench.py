"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  Session start and warm-up
queries (on the next smaller scale factor) are excluded.  Prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set; "all" = every query),
BENCH_REPEAT (default 1; the best of N runs is reported per query),
BENCH_LAYERS (default 1): also time one end-to-end run of the layers (land
bronze, silver + gate, gold + gate, publish) into a fresh warehouse under the
local temporary folder, reported as ``layers_end_to_end`` (outside the
headline total, for comparison with the published full-run wall time).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "silver_feed",
    "quarantine_all",
    "silver_catalogue",
    "dim_user",
    "fact_stage",
    "monthly_agg",
    "merge_upsert",
    "merge_guarded",
    "merge_update_only",
    "snapshot_as_of",
    "version_history",
    "version_diff",
    "reconcile_counts",
    "dq_report",
]


def run_layers_once(spark, sf_dir: str) -> float:
    import tempfile

    from layerworks.plans import layers
    from layerworks.sources import fixtures
    from layerworks.sources.warehouse import Warehouse

    wh = Warehouse(spark, tempfile.mkdtemp(prefix="bench-warehouse-"))
    t0 = time.perf_counter()
    layers.land_bronze(
        wh,
        fixtures.feed_text(spark, sf_dir),
        fixtures.catalogue_text(spark, sf_dir),
        fixtures.corrections_text(spark, sf_dir),
    )
    layers.run_layers(spark, wh, clock=fixtures.FIXTURE_CLOCK)
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    from layerworks.plans.queries import QUERIES
    from layerworks.session import local_session

    wanted = os.environ.get("BENCH_QUERIES", "")
    if wanted == "all":
        names = list(QUERIES)
    elif wanted:
        names = [n for n in wanted.split(",") if n in QUERIES]
    else:
        names = HEADLINE

    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus))
    # Untimed warm-up on a smaller scale factor: loads classes and lets the
    # JIT compile the shared code paths (scan, window, aggregate, join, write).
    smaller = re.sub(r"sf[0-9.]+$", "sf0.01", sf_dir.rstrip("/"))
    warm_dir = smaller if os.path.isdir(smaller) else sf_dir
    for warm in ("monthly_agg", "merge_guarded", "version_history", "quarantine_all"):
        QUERIES[warm](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    extra: dict[str, float] = {}
    if os.environ.get("BENCH_LAYERS", "1") == "1":
        extra["layers_end_to_end"] = round(run_layers_once(spark, sf_dir), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "end_to_end": extra,
                "sf": float(sf.group(1)) if sf else None,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
