"""foreachBatch sinks and their readers.

Each micro-batch is written to ``<out>/batch_id=<n>`` with overwrite, so a batch that is
replayed after a failure replaces its own earlier attempt instead of adding to it
(idempotent at batch grain). Readers turn the folder back into a table:

* ``read_latest_snapshot``: the newest complete-mode snapshot;
* ``read_final_state``: the newest value per key of an update log;
* ``read_changelog``: every retract/add row with its batch id.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.sources.tables import latest_by_key


def batch_path(out: str, batch_id: int) -> str:
    return f"{out.rstrip('/')}/batch_id={int(batch_id)}"


class BatchDirSink:
    """Write each micro-batch as its own folder (complete snapshot or update rows)."""

    def __init__(self, out: str):
        self.out = out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(self.out, batch_id))


class RetractSink:
    """Micro-batch retract/add changelog from complete-mode snapshots.

    Batch n's snapshot is written first; it is then compared with batch n-1's snapshot by one
    null-safe full outer join on ``key``. A key whose row changed (its value or a carried
    column) gives ``(is_add=false, old row)`` if it was in the old result and
    ``(is_add=true, new row)`` if it is in the new one. The snapshot
    is bounded by the number of keys (users), not by the facts.
    """

    def __init__(self, snapshots: str, changelog: str, key: Sequence[str], value: str = "counts",
                 flag: str = "is_add"):
        self.snapshots, self.changelog = snapshots, changelog
        self.key, self.value, self.flag = list(key), value, flag

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(batch_path(self.snapshots, batch_id))
        cur = spark.read.parquet(batch_path(self.snapshots, batch_id))
        if batch_id > 0:
            prev = spark.read.schema(cur.schema).parquet(batch_path(self.snapshots, batch_id - 1))
        else:
            prev = spark.createDataFrame([], cur.schema)
        cols = cur.columns
        old = prev.select(F.struct(*cols).alias("__old"))
        new = cur.select(F.struct(*cols).alias("__new"))
        same = [F.col(f"__old.{k}").eqNullSafe(F.col(f"__new.{k}")) for k in self.key]
        changed = (old.join(new, same, "full_outer")
                      .filter(~F.col("__old").eqNullSafe(F.col("__new"))))
        moves = F.array(F.struct(F.lit(False).alias(self.flag), F.col("__old").alias("__row")),
                        F.struct(F.lit(True).alias(self.flag), F.col("__new").alias("__row")))
        (changed.select(F.explode(moves).alias("__m")).filter("__m.__row IS NOT NULL")
                .select(*[F.col(f"__m.__row.{c}").alias(c) for c in cols],
                        F.col(f"__m.{self.flag}").alias(self.flag))
                .write.mode("overwrite").parquet(batch_path(self.changelog, batch_id)))


def latest_batch_id(spark: SparkSession, out: str) -> int:
    """Highest ``batch_id=`` folder, from the file listing (no data read). An empty batch
    still counts: Spark writes a schema-only file for an empty result."""
    ids = [int(m.group(1)) for f in spark.read.parquet(out).inputFiles()
           if (m := re.search(r"/batch_id=(\d+)/", f))]
    if not ids:
        raise FileNotFoundError(f"no batch folders under {out}")
    return max(ids)


def read_latest_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The snapshot of the highest batch id, read from its folder alone."""
    last = latest_batch_id(spark, out)
    return spark.read.parquet(batch_path(out, last))


def read_final_state(spark: SparkSession, out: str, key: Sequence[str] | str) -> DataFrame:
    """Newest row per key across all batches of an update log."""
    df = spark.read.parquet(out)
    return latest_by_key(df, key, "batch_id").drop("batch_id")


def read_changelog(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)


def net_changelog(log: DataFrame, key: Sequence[str], value: str = "counts",
                  flag: str = "is_add") -> DataFrame:
    """Apply a retract/add changelog: rows whose adds outnumber their retracts, i.e. the
    result table the changelog describes (independent of how batches were cut)."""
    sign = F.when(F.col(flag), F.lit(1)).otherwise(F.lit(-1))
    return (log.groupBy(*key, value).agg(F.sum(sign).alias("__net"))
               .filter(F.col("__net") > 0).drop("__net"))
