"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR  input tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local[N] (default 8)
    BENCH_REPEAT  timed runs per query after one warm-up (default 3); the median is kept

Each query is fully materialised through the ``noop`` sink, so every output column is
computed (a ``count()`` could be answered from fewer columns). Streaming entries include
their whole job (publish, stream, read back).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tristar.plans.registry import QUERIES  # noqa: E402
from tristar.session import get_session  # noqa: E402

HEADLINE = ["verified_users_by_id", "enriched_cards", "verified_users_by_name",
            "value_counts", "running_updates", "retract_changelog", "stream_update_counts",
            "stream_snapshot_counts", "two_stage_relay", "stream_stream_join",
            "stream_retract_net", "stream_sql_having", "live_dimension_counts", "relay_dedup"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(f"local[{cpus}]", app="tristar-bench", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        def once() -> float:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            once()  # warm-up: JIT, file listing, Python worker start
            times[name] = round(statistics.median(once() for _ in range(repeat)), 4)
        except Exception as e:  # report the others; the failure is named in the output
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    line = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 4),
            "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat,
            "spark": spark.version}
    if failed:
        line["failed"] = failed
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
