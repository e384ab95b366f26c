"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query is fully
evaluated into a no-op sink; the best of ``BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.registry import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def timed(spark, query, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in chosen:
        seconds[name] = round(min(timed(spark, QUERIES[name], sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
