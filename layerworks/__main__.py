"""Command line: land raw files and run the layers.

    python -m layerworks --root WAREHOUSE [--stage all|bronze|silver|gold]
                         [--ratings ratings.csv --movies movies.csv
                          --corrections rating_corrections.csv]

``--root`` must be a folder every executor can reach.  Exit status 0 on
success, 2 when a quality gate blocks publication (its results are already
in ``dq_results``), 1 on other errors.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from .plans import layers
from .plans.quality import GateBlocked
from .session import get_session
from .sources.ingest import batch_id_now, clock_now
from .sources.warehouse import Warehouse


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="layerworks", description=__doc__.split("\n\n")[0])
    parser.add_argument("--root", required=True, help="warehouse folder on shared storage")
    parser.add_argument("--stage", choices=["all", "bronze", "silver", "gold"], default="all")
    parser.add_argument("--ratings", help="ratings CSV (bronze stage)")
    parser.add_argument("--movies", help="movies CSV (bronze stage)")
    parser.add_argument("--corrections", help="optional corrections CSV (bronze stage)")
    parser.add_argument("--no-expect-quarantine", action="store_true", help="a clean feed may leave quarantine empty")
    parser.add_argument("--no-expect-corrections", action="store_true", help="no correction batch this run")
    args = parser.parse_args(argv)

    owns_session = SparkSession.getActiveSession() is None
    spark = get_session("layerworks")
    wh = Warehouse(spark, args.root)
    batch, clock = batch_id_now(), clock_now()
    stages = ["bronze", "silver", "gold"] if args.stage == "all" else [args.stage]
    started = time.time()
    try:
        for stage in stages:
            t0 = time.time()
            if stage == "bronze":
                if not (args.ratings and args.movies):
                    parser.error("the bronze stage needs --ratings and --movies")
                layers.land_files(spark, wh, args.ratings, args.movies, args.corrections, batch, clock)
            elif stage == "silver":
                layers.run_silver(spark, wh, clock, expect_quarantine=not args.no_expect_quarantine)
            else:
                layers.run_gold(spark, wh, expect_corrections=not args.no_expect_corrections)
            print(f"{stage}: {time.time() - t0:.1f}s")
    except GateBlocked as failure:
        print(f"quality gate failed, nothing published: {failure}", file=sys.stderr)
        return 2
    finally:
        if owns_session:  # never stop a session the caller is still using
            spark.stop()
    print(f"done in {time.time() - started:.1f}s (batch {batch})")
    return 0


if __name__ == "__main__":
    sys.exit(main())
