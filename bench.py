"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully evaluated through the ``noop`` sink (every column
computed, nothing collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from touchline.registry import REGISTRY  # noqa: E402
from touchline.session import local_session  # noqa: E402

HEADLINE = [
    "dim_match",
    "matches_by_team",
    "match_level_player_data",
    "playoff_champions",
    "schedule_html_roundtrip",
    "player_html_roundtrip",
    "page_links",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in REGISTRY]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="touchline-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up (not counted): JIT and codegen caches, once per query, on the
    # smallest scale factor next to the bench directory when there is one.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:
        REGISTRY[name][0](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        fn = REGISTRY[name][0]
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
