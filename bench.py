"""Time the queries: one JSON line on standard output.

Every query is planned and run to the end by a sink that drops the rows. The best of
BENCH_REPEATS runs counts, after one warm-up query.
"""

import json
import os
import time

from tractscope.registry import QUERIES
from tractscope.session import local_session


def run(spark, name, sf_dir):
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else list(QUERIES)
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    run(spark, "loan_tract_rank", sf_dir)
    seconds = {
        name: round(min(run(spark, name, sf_dir) for _ in range(repeats)), 3) for name in names
    }
    spark.stop()
    result = {
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").split("sf")[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
