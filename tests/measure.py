
from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import bench  # noqa: E402
from goldweave.checks import incremental as inc  # noqa: E402
from goldweave.operators import latest_in_window  # noqa: E402


def shuffled(spark) -> int:
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = bench.session(os.environ.get("BENCH_CPUS", "8"))
    for name in ("upsert_feed_a", "item_load_a", "upsert_small_feed", "insert_new", "catchup_windows"):
        for _ in range(2):
            before, started = shuffled(spark), time.perf_counter()
            entry.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
        time.sleep(1)
        print(f"{name}: {took:.1f} s, {(shuffled(spark) - before) / 2**20:.1f} MiB shuffled", flush=True)

    w = inc.windows(spark, folder)
    log = inc.messages(spark, folder)
    started = time.perf_counter()
    for k in range(w.n):
        start, end = (F.timestamp_micros(F.lit(w.anchor + (k + d) * w.stride)) for d in (-1, 0))
        won = latest_in_window(log, start, end, **inc.NAMES)
        won.write.format("noop").mode("overwrite").save()
    print(f"{w.n} windows one at a time: {time.perf_counter() - started:.1f} s")


if __name__ == "__main__":
    main()
