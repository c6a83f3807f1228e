"""Dimension tables: latest value per key (a replicated changelog table), key checks,
SQL registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_by_key(df: DataFrame, key: str | Sequence[str], order: str,
                  value: str | None = None) -> DataFrame:
    """The latest row per key by ``order``; a key whose latest ``value`` is null is deleted.

    ``max_by`` is an ordinary aggregate, so it combines map-side: a hot key reaches the
    shuffle as one row per map task, never as a group in one task.
    """
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    if order not in rest:
        raise ValueError(f"order column {order!r} must be a non-key column")
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__latest"))
    if value is not None:
        latest = latest.filter(F.col(f"__latest.{value}").isNotNull())
    return latest.select(*keys, "__latest.*")


def duplicate_keys(df: DataFrame, key: str | Sequence[str], out: str = "n") -> DataFrame:
    """Keys that occur more than once, with their count (a primary-key check)."""
    keys = _keys(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
              .filter(F.col(out) > 1))


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Name DataFrames (batch or streaming) for SQL text."""
    del spark
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
               mode: str = "overwrite") -> DataFrame:
    """Create-table-as-select: write ``df`` as parquet (replacing an older table) and
    return the stored table. The store is a shared folder; nothing is kept on the driver."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)
