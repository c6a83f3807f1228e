"""Keyed record sources and the keyed JSON publication of a table.

Every source yields ``(key string, value string, timestamp timestamp)``:

* ``kind="files"``: a folder of parquet files with that schema (what ``publish_keyed``
  writes); as a stream it is a file source, so each new file is a new offset.
* ``kind="kafka"``: a topic, through Spark's Kafka connector, bytes cast to strings.
  The connector jar must be on the classpath; it is not bundled with PySpark.
"""

from __future__ import annotations

from datetime import datetime, timezone
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristar.functions.records import cast_keyed, encode

KEYED_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])


LOG_SCHEMA = T.StructType([*KEYED_SCHEMA.fields, T.StructField("partition", T.IntegerType()),
                           T.StructField("offset", T.LongType())])


def _kafka_start(starting: str) -> dict[str, str]:
    """Kafka options of a start position: earliest, latest, JSON of offsets per partition, or a
    time (ISO text)."""
    if starting in ("earliest", "latest") or starting.lstrip().startswith("{"):
        return {"startingOffsets": starting}
    at = datetime.fromisoformat(starting)
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return {"startingTimestamp": str(int(at.timestamp() * 1000))}


def keyed_source(spark: SparkSession, kind: str, location: str, starting: str = "earliest",
                 max_files: int | None = None, options: dict[str, str] | None = None,
                 stream: bool = True, max_bytes: int | None = None,
                 max_records: int | None = None, log: bool = False) -> DataFrame:
    """Open a keyed record source as a stream (default) or as a bounded batch.

    ``starting``: "earliest", a time (ISO text, UTC unless it names a zone; records of that time
    or later), and for Kafka also "latest" or JSON of offsets; what a files source cannot
    honour is refused. A micro-batch takes at most ``max_files`` files or ``max_bytes`` bytes of
    a files source (the first wins), or ``max_records`` records of a Kafka topic; a limit of
    the other kind of source is refused. With ``log`` the records keep ``partition`` and
    ``offset``, their order in the log.
    """
    options = dict(options or {})
    if kind == "files":
        if max_records:
            raise ValueError("a files source limits batches by files or bytes, not records")
        if starting == "latest" or starting.lstrip().startswith("{"):
            raise ValueError(f"a files source starts at 'earliest' or a time, not {starting!r}")
        reader = spark.readStream if stream else spark.read
        reader = reader.schema(LOG_SCHEMA if log else KEYED_SCHEMA)
        if stream and max_files:
            reader = reader.option("maxFilesPerTrigger", str(max_files))
        elif stream and max_bytes:
            reader = reader.option("maxBytesPerTrigger", str(int(max_bytes)))
        for k, v in options.items():
            reader = reader.option(k, v)
        records = reader.parquet(location)
        if starting != "earliest":
            at = datetime.fromisoformat(starting)
            at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
            records = records.filter(F.col("timestamp") >= F.lit(at))
        return records
    if kind == "kafka":
        if max_files or max_bytes:
            raise ValueError("a Kafka source limits batches by max_records")
        reader = (spark.readStream if stream else spark.read).format("kafka")
        reader = reader.option("subscribe", location)
        if stream and max_records:
            reader = reader.option("maxOffsetsPerTrigger", str(int(max_records)))
        for k, v in {**_kafka_start(starting), **options}.items():
            reader = reader.option(k, v)
        try:
            records = cast_keyed(reader.load())
        except Exception as e:
            msg = str(e).lower()
            if "kafka" in msg and "data source" in msg:
                raise RuntimeError(
                    "the Kafka connector (spark-sql-kafka-0-10 for this Spark version) is "
                    "not on the classpath; add it to the job, or use kind='files'") from e
            raise
        return records if log else records.select("key", "value", "timestamp")
    raise ValueError(f"unknown source kind {kind!r}; use 'files' or 'kafka'")


def read_keyed(spark: SparkSession, location: str, log: bool = False) -> DataFrame:
    """A keyed files folder as a bounded DataFrame."""
    return keyed_source(spark, "files", location, stream=False, log=log)


def publish_log(records: DataFrame, path: str, partitions: int = 4, mode: str = "overwrite") -> None:
    """Write ``(key, value, timestamp, offset)`` records as a log: a key's records share a
    partition (``partition`` = hash of the key), ``offset`` orders them there."""
    (records.withColumn("partition", F.pmod(F.hash("key"), F.lit(int(partitions))).cast("int"))
     .select(*LOG_SCHEMA.names).write.mode(mode).parquet(path))


def keyed_table(records: DataFrame, schema: T.StructType,
                fields: dict[str, str] | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """The current table of a keyed record log (a replicated changelog table).

    Per key, the last record wins: the latest ``timestamp``, then (if ``records`` has those
    columns) ``partition`` and ``offset``, the order of the log. Without them, records of
    one timestamp have no order of their own; the greatest value text wins, a tombstone
    last, so the table does not depend on partitioning. A null value (tombstone) as the
    last record deletes the key. A record whose text does not parse
    (PERMISSIVE gives a struct of nulls) is skipped, so it cannot replace a good value.
    ``fields`` renames wire fields to table columns (only the listed ones are kept). The
    reduction is an aggregate (``max_by``), so a hot key combines map-side.
    """
    from tristar.functions.records import decode
    from tristar.sources.tables import latest_by_key
    log = [c for c in ("partition", "offset") if c in records.columns]
    records = records.withColumn("__order", F.struct("timestamp", *log, "value"))
    dec = decode(records, schema, mode=mode, keep=("key", "__order", "value"), expand=False)
    unparsed = F.col("value").isNotNull() & ~F.greatest(
        *[F.col(f"record.{f.name}").isNotNull() for f in schema.fields], F.lit(False))
    dec = dec.filter(~unparsed).drop("value")
    current = latest_by_key(dec, "key", "__order", value="record")
    names = fields or {f.name: f.name for f in schema.fields}
    return current.select(*[F.col(f"record.{w}").alias(c) for w, c in names.items()])


def publish_keyed(df: DataFrame, key: Column | str, columns: Sequence[str], path: str,
                  names: Sequence[str] | None = None, timestamp: Column | str | None = None,
                  mode: str = "overwrite", kind: str = "files",
                  options: dict[str, str] | None = None) -> None:
    """Write a table as keyed JSON records (one record per row, key = ``key`` as text).

    ``timestamp`` is the record time (an event-time column, or the publish time).
    """
    ts = F.current_timestamp() if timestamp is None else (
        F.col(timestamp) if isinstance(timestamp, str) else timestamp)
    out = encode(df.withColumn("__ts", ts.cast("timestamp")), key, columns, names,
                 keep=("__ts",)).select("key", "value", F.col("__ts").alias("timestamp"))
    if kind == "files":
        out.write.mode(mode).parquet(path)
    elif kind == "kafka":
        w = out.write.format("kafka").option("topic", path)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
    else:
        raise ValueError(f"unknown sink kind {kind!r}")
