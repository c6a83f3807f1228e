"""Hot-key stress run (not a registered query): reproduces the README's stress table.

    python tools/stress.py [--sf /root/testdata/sf0.1] [--rep 50] [--cpus 8]

Builds, in a fresh folder under ``spark.checkpoint.dir``, a fact table of ``rep`` copies of
every ``lineitem`` row, then moves every third row onto card 7 and user 3: one card and
one user each hold a third of all facts. Then times, on the whole table:

* eager-aggregation counts vs the count over the full three-way join (and checks equality);
* the per-record replay (``running_updates``) vs a plain per-user ``row_number``;
* a stream-static update job over the table, with bucketed dimensions, unsalted and salted.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tristar.operators import enrich, enriched_counts, running_updates, verified_users  # noqa
from tristar.session import get_session, scratch_dir  # noqa: E402
from tristar.sources.roles import batch_star  # noqa: E402
from tristar.streaming import read_final_state, run_updates, stream_enriched  # noqa: E402
from tristar.streaming.jobs import BOUNDED  # noqa: E402


def timed(label: str, build) -> float:
    t = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    dt = time.perf_counter() - t
    print(f"{label:48s} {dt:7.2f} s", flush=True)
    return dt


def main() -> None:
    a = argparse.ArgumentParser()
    a.add_argument("--sf", default="/root/testdata/sf0.1")
    a.add_argument("--rep", type=int, default=50)
    a.add_argument("--cpus", type=int, default=8)
    args = a.parse_args()
    spark = get_session(f"local[{args.cpus}]", shuffle_partitions=64,
                        extra={"spark.driver.memory": "16g"})
    s = batch_star(spark, args.sf)
    work = scratch_dir(spark, "stress")
    hot = F.col("__i") % 3 == 0
    (s.verifications
     .select("card_id", "verified_by", "verification_date",
             F.explode(F.sequence(F.lit(1), F.lit(args.rep))).alias("__r"))
     .withColumn("__i", F.xxhash64("card_id", "verified_by", "verification_date", "__r"))
     .select(F.when(hot, F.lit(7)).otherwise(F.col("card_id")).alias("card_id"),
             F.when(hot, F.lit(3)).otherwise(F.col("verified_by")).alias("verified_by"),
             "verification_date", F.abs(F.col("__i")).alias("id"))
     .write.parquet(f"{work}/fact"))
    fact = spark.read.parquet(f"{work}/fact")
    print("facts", fact.count(), "in", work)

    def eager():
        return verified_users(s.cards, fact, s.users, by="id", threshold=600)

    def direct():
        return enriched_counts(enrich(s.cards, fact, s.users), by="id", threshold=600)

    e = enrich(s.cards, fact, s.users, fact_columns=["id", "verified_by"]).select("user_id", "id")
    for _ in range(2):
        timed("verified_users (eager aggregation)", eager)
        timed("count over the full three-way join", direct)
        timed("running_updates", lambda: running_updates(e, "user_id", "id", 600))
        timed("plain row_number per user", lambda: e.withColumn(
            "n", F.row_number().over(Window.partitionBy("user_id").orderBy("id")))
            .filter("n > 600"))
    same = eager().exceptAll(direct()).count() == 0 and direct().exceptAll(eager()).count() == 0
    print("eager == direct:", same)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for salt in (1, 8):
        facts = spark.readStream.schema(fact.schema).parquet(f"{work}/fact")
        counts = enriched_counts(stream_enriched(facts, s.cards, s.users, broadcast_rows=0,
                                                 salt=salt), by="id_and_name")
        run = scratch_dir(spark, f"stress-salt{salt}")
        t = time.perf_counter()
        run_updates(counts, f"{run}/out", f"{run}/ckpt", BOUNDED).awaitTermination()
        print(f"stream-static, bucketed dimensions, salt={salt:<2d}{'':22s}"
              f"{time.perf_counter() - t:7.2f} s  users:",
              read_final_state(spark, f"{run}/out", ["user_id", "user_name"]).count())
    spark.stop()


if __name__ == "__main__":
    main()
