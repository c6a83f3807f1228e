"""Time columns: event time for watermarks and the age of a record in seconds.

Parquet loads wall-clock times as ``timestamp_ntz``. Both helpers read such a value as
UTC whatever the session time zone, so results do not depend on the cluster's setting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c: Column | str) -> Column:
    """Seconds since 1970-01-01 UTC (fraction dropped); ``timestamp_ntz`` read as UTC."""
    return F.unix_timestamp(_col(c))


def event_time(c: Column | str) -> Column:
    """A TIMESTAMP usable by ``withWatermark`` (which rejects ``timestamp_ntz``), at the
    instant the wall-clock value names in UTC, to the microsecond."""
    return F.timestamp_micros(
        F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                        _col(c).cast("timestamp_ntz")))


def with_age(df: DataFrame, ts: str, as_of: int, out: str = "age_s") -> DataFrame:
    """``out = as_of - epoch_seconds(ts)`` as BIGINT.

    ``as_of`` (epoch seconds) is explicit so results repeat; the workload took "now".
    """
    return df.withColumn(out, (F.lit(int(as_of)) - epoch_seconds(ts)).cast("bigint"))
