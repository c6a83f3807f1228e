"""A third of all facts on one card: AQE splits the hot partition of the sort-merge
join (broadcast disabled), and the count is still exact."""

import contextlib
import io

from pyspark.sql import functions as F

from tests.conftest import rows_of
from tristar.operators import enrich, enriched_counts, verified_users

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def skewed_star(spark, n=120_000):
    facts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("card_id"),
        F.lit(None).cast("timestamp_ntz").alias("verification_date"),
        F.when(F.col("id") % 3 == 1, F.lit(3)).otherwise(F.col("id") % 50).alias("verified_by"))
    name = F.col("id").cast("string")
    cards = spark.range(1000).select(F.col("id").alias("card_id"),
                                     F.concat(F.lit("t"), name).alias("title"))
    users = spark.range(50).select(F.col("id").alias("user_id"),
                                   F.concat(F.lit("u"), name).alias("user_name"))
    return cards, facts, users


def test_hot_card_partition_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        s = skewed_star(spark)
        df = verified_users(*s, by="id")
        df.collect()
        got = rows_of(df)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()
        assert got == rows_of(enriched_counts(enrich(*s), by="id"))
        assert sum(r[0] for r in got) == 120_000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
