"""Stored tables with statistics: the star written once for many joins, and create-table-as-select.

``store_star`` writes cards and verifications bucketed and sorted by the card, so every later join
of the two reads its buckets and shuffles neither side, and analyses the join keys, so the planner
knows row counts and distinct values (it broadcasts by the stored size, and orders the joins by
cost where ``spark.sql.cbo.enabled`` and ``spark.sql.cbo.joinReorder.enabled`` are on).

A card with a share of the facts would fill one bucket, which no runtime re-plan splits. Its facts
are therefore dealt over ``salt`` values, and only its card row is copied, once per value.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.operators.enrich import SALT, _is_hot, hot_keys, salt_column
from tristar.session import scratch_dir
from tristar.sources.roles import check_roles
from tristar.sources.tables import duplicate_keys


class StoredStar(NamedTuple):
    """Names of the stored tables."""
    cards: str
    verifications: str
    users: str


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    """Row count and size of a stored table, and statistics of the named columns: one pass."""
    tail = " FOR COLUMNS " + ", ".join(f"`{c}`" for c in columns) if columns else ""
    spark.sql(f"ANALYZE TABLE `{table}` COMPUTE STATISTICS{tail}")


def create_table_as(df: DataFrame, table: str, bucket_by: Sequence[str] = (),
                    buckets: int | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """``CREATE OR REPLACE TABLE table AS df`` with statistics of ``columns``; the stored table.

    Each call writes a fresh folder under the shared work folder and then points the name at it, so
    readers of the replaced table keep their files. ``df`` must not read ``table`` by its name."""
    spark = df.sparkSession
    w = df.write.format("parquet").mode("overwrite").option("path", scratch_dir(spark, table))
    if bucket_by:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        w = (df.repartition(n, *bucket_by).write.format("parquet").mode("overwrite")
             .option("path", scratch_dir(spark, table))
             .bucketBy(n, *bucket_by).sortBy(*bucket_by))
    w.saveAsTable(table)
    analyze(spark, table, columns)
    return spark.table(table)


def store_star(cards: DataFrame, verifications: DataFrame, users: DataFrame, name: str = "star",
               buckets: int | None = None, salt: int = 8, share: float = 0.01) -> StoredStar:
    """The three tables stored under fresh names. Card and user keys must be unique (ValueError);
    cards that hold about ``share`` of the verifications or more are spread over ``salt`` values."""
    check_roles(cards, verifications, users)
    for dim, key in ((cards, "card_id"), (users, "user_id")):
        twice = duplicate_keys(dim.filter(F.col(key).isNotNull()), key).limit(1).collect()
        if twice:
            raise ValueError(f"{key} {twice[0][key]!r} occurs {twice[0]['n']} times")
    spark = cards.sparkSession
    hot = hot_keys(verifications, "card_id", share) if salt > 1 else []
    run = uuid.uuid4().hex[:12]
    stored = StoredStar(*(f"tristar_{name}_{t}_{run}" for t in StoredStar._fields))
    cold = F.lit(0).cast("bigint")
    is_hot = _is_hot(F.col("card_id"), hot)
    copies = F.sequence(cold, F.when(is_hot, F.lit(salt - 1)).otherwise(F.lit(0)).cast("bigint"))
    create_table_as(cards.withColumn(SALT, F.explode(copies)), stored.cards, ["card_id", SALT],
                    buckets, ["card_id"])
    drawn = F.when(is_hot, salt_column(salt)).otherwise(cold)
    create_table_as(verifications.withColumn(SALT, drawn), stored.verifications, ["card_id", SALT],
                    buckets, ["card_id", "verified_by"])
    create_table_as(users, stored.users, columns=["user_id"])
    return stored


def enrich_stored(spark: SparkSession, stored: StoredStar) -> DataFrame:
    """``enrich`` over stored tables: the same columns and rows, the card join without a shuffle."""
    cards, facts, users = (spark.table(t) for t in stored)
    card_cols = [c for c in cards.columns if c != SALT]
    fact_cols = [c for c in facts.columns if c not in (SALT, "card_id")]
    return (facts.join(cards, ["card_id", SALT])
            .join(users, F.col("verified_by") == F.col("user_id"))
            .select(*card_cols, *fact_cols, *users.columns))
