"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) in
``local[$BENCH_CPUS]`` (default 8) into the ``noop`` sink, so the whole plan
executes without collecting to the driver: one warm-up round over all queries,
then ``$BENCH_RUNS`` timed rounds (default 5), each in another order, so that a
query's place in the run doesn't favour it.  Prints one JSON line; ``value`` is
the sum of the per-query medians, ``spread`` each query's fastest and slowest run.
"""

from __future__ import annotations

import json
import os
import random
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arenaflow.plans.registry import QUERIES  # noqa: E402
from arenaflow.session import build_session  # noqa: E402

HEADLINE = (
    "match_view",
    "match_view_wide",
    "qualified_matches",
    "qualified_participants",
    "era_rule",
    "union_all_branches",
    "packed_matches",
    "packed_participants",
    "player_detail",
    "packed_players",
    "monthly_matches",
    "monthly_participants",
    "monthly_players",
)


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="arenaflow-bench")
    times: dict[str, list[float]] = {name: [] for name in names}
    for name in names:
        _run(spark, name, sf_dir)  # warm-up: JIT, file metadata, Python workers
    for k in range(runs):
        for name in random.Random(k).sample(names, len(names)):
            times[name].append(_run(spark, name, sf_dir))
    results = {name: round(statistics.median(t), 3) for name, t in times.items()}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_median_total",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "spread": {name: [round(min(t), 3), round(max(t), 3)] for name, t in times.items()},
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
