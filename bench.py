"""Times every registered query into a no-op sink and prints one JSON line.

Each query runs once on a smaller sibling folder to load classes and generated
code, then on the real folder: once if it is long, otherwise up to
``BENCH_RUNS`` times, reporting the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillflow.registry import QUERIES, delivered  # noqa: E402
from tillflow.schemas import FEEDS  # noqa: E402
from tillflow.session import local_session  # noqa: E402

LONG = 1.5


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measure(spark, name: str, folder: str, small: str, runs: int) -> float:
    run(spark, name, small)
    times = [run(spark, name, folder)]
    while len(times) < runs and max(times) < LONG:
        times.append(run(spark, name, folder))
    return statistics.median(times)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or list(QUERIES)
    sibling = Path(folder).parent / "sf0.01"
    small = str(sibling) if sibling.is_dir() else folder
    spark = local_session(
        cores, **{"spark.sql.shuffle.partitions": cores, "spark.driver.memory": "8g"}
    )
    for source in (small, folder):
        delivered(spark, source, *FEEDS)
    seconds = {name: round(measure(spark, name, folder, small, runs), 4) for name in names}
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(folder).name.removeprefix("sf") or 0),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
