"""Streaming jobs.

Plans and the output modes Spark allows for them (PySpark 4.1):

* facts stream x static cards x static users, then ``groupBy().count()``: update or
  complete mode. This is the default shape: a dimension table is static, re-read when
  the job (or, with ``run_live``, each micro-batch) starts.
* three streams joined: append mode only, and an unwindowed count after it is refused.
  ``run_stream_join`` therefore writes the joined rows to a relay and ``run_relay``
  counts the relay in a second query (two-stage relay). Join state keeps every row of
  every side (no watermark bounds a dimension), as in the workload.

Every job needs a checkpoint folder; triggers are a dict passed to ``trigger()``
(``{"availableNow": True}`` for a bounded run, ``{"processingTime": "1 second"}`` for a
continuous one, which matches a one-second commit interval).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tristar.functions.records import decode, require_schema
from tristar.functions.time import epoch_seconds, event_time
from tristar.operators.counts import enriched_counts, verified_users
from tristar.operators.enrich import (
    SALT, enrich, prepare_dimension, salt_column, salted_stream_join,
)
from tristar.sources.keyed import keyed_source, publish_keyed
from tristar.sources.roles import Star, verifications_from_events
from tristar.session import scratch_dir, write_stage
from tristar.streaming.sinks import BatchDirSink, RetractSink, batch_path

CONTINUOUS = {"processingTime": "1 second"}
BOUNDED = {"availableNow": True}

# Broadcast a static dimension in a stream-static join only under this many rows;
# beyond it the dimension becomes a bucketed table (AQE does not run in a streaming plan).
DEFAULT_BROADCAST_ROWS = 2_000_000

# The wire schemas of the keyed JSON records (field names as published).
CARD_WIRE = T.StructType([
    T.StructField("cardId", T.LongType()),
    T.StructField("cardTitle", T.StringType()),
    T.StructField("creationDate", T.LongType()),
    T.StructField("createdByUserId", T.LongType()),
    T.StructField("verificationInterval", T.LongType()),
])
VERIFICATION_WIRE = T.StructType([
    T.StructField("verificationId", T.LongType()),
    T.StructField("cardId", T.LongType()),
    T.StructField("verificationDate", T.LongType()),
    T.StructField("verifiedByUserId", T.LongType()),
])
USER_WIRE = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("userName", T.StringType()),
])


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def state_partitions(spark: SparkSession) -> int:
    """Two tasks per core: the state-store partition count a new query is started with
    in the registry (fixed in its checkpoint from then on)."""
    return 2 * spark.sparkContext.defaultParallelism


def _start(writer, checkpoint: str, trigger: dict | None, spark: SparkSession | None = None,
           partitions: int | None = None) -> StreamingQuery:
    """Start with a checkpoint. With ``partitions`` the query's shuffles (and so its state
    store) use that many partitions; the session setting is restored once the query has
    taken its copy of the configuration at start."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or CONTINUOUS))
    if spark is None or partitions is None:
        return writer.start()
    old = spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(SHUFFLE_PARTITIONS, str(int(partitions)))
    try:
        return writer.start()
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, old)


# ---- sources ---------------------------------------------------------------------------

def event_fact_stream(spark: SparkSession, folder: str, glob: str | None = None,
                      max_files: int | None = None, mode: str = "PERMISSIVE",
                      max_bytes: int | None = None) -> DataFrame:
    """The events files of ``folder`` as a stream of verifications (role columns).

    The schema is taken from the files' footers once at start; a stream source never infers.
    ``glob`` picks the events files when the folder also holds other tables. A micro-batch
    takes at most ``max_files`` files, or else at most ``max_bytes`` bytes of input
    (``tristar.session.batch_bytes`` sizes it to the cluster).
    """
    batch_reader = spark.read
    if glob:
        batch_reader = batch_reader.option("pathGlobFilter", glob)
    schema = batch_reader.parquet(folder).schema
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes)))
    return verifications_from_events(reader.parquet(folder), mode)


def stream_enriched(facts: DataFrame, cards: DataFrame, users: DataFrame,
                    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS, salt: int = 1,
                    hot_cards: Sequence | None = None,
                    hot_users: Sequence | None = None) -> DataFrame:
    """Stream-static enrichment.

    Each dimension is broadcast when a row check proves it under ``broadcast_rows``;
    otherwise it is written once as a bucketed table (``prepare_dimension``) so each
    micro-batch shuffles only itself. With ``salt`` > 1 a bucketed dimension is salted
    so a hot key spreads over ``salt`` tasks (a broadcast one needs no salt); with lists of
    hot keys (``hot_keys`` of a table of facts) only these are spread and copied.
    ``broadcast_rows=None`` leaves the dimensions as given (Spark's size-based choice).
    """
    if broadcast_rows is not None:
        cards = prepare_dimension(cards, "card_id", broadcast_rows, name="cards", salt=salt,
                                  hot=hot_cards)
        users = prepare_dimension(users, "user_id", broadcast_rows, name="users", salt=salt,
                                  hot=hot_users)
    if SALT in cards.columns or SALT in users.columns:
        return salted_stream_join(facts, cards, users, salt, hot_cards, hot_users)
    return enrich(cards, facts, users)


def publish_star(star: Star, folder: str, events_ts: str = "verification_date",
                 roles: Sequence[str] = ("cards", "verifications", "users"),
                 mode: str = "overwrite") -> dict[str, str]:
    """Publish the listed roles as keyed JSON record folders (wire field names), replacing
    what is there or (``mode="append"``) adding to it.

    Returns ``{role: path}`` for the published roles.
    """
    paths = {r: f"{folder.rstrip('/')}/{r}" for r in roles}
    if "cards" in paths:
        publish_keyed(star.cards, "card_id", ["card_id", "title"], paths["cards"],
                      names=["cardId", "cardTitle"], mode=mode)
    if "verifications" in paths:
        v = star.verifications.withColumn("__epoch", epoch_seconds(events_ts))
        publish_keyed(v, "id", ["id", "card_id", "__epoch", "verified_by"],
                      paths["verifications"],
                      names=["verificationId", "cardId", "verificationDate", "verifiedByUserId"],
                      timestamp=event_time(events_ts), mode=mode)
    if "users" in paths:
        publish_keyed(star.users, "user_id", ["user_id", "user_name"], paths["users"],
                      names=["userId", "userName"], mode=mode)
    return paths


def keyed_star_streams(spark: SparkSession, locations: dict[str, str], kind: str = "files",
                       max_files: int | None = None, mode: str = "PERMISSIVE",
                       starting: str = "earliest", max_bytes: int | None = None,
                       options: dict[str, str] | None = None,
                       max_records: int | None = None) -> Star:
    """Open the three keyed record streams and decode them to role columns. ``options`` go to
    each source (for Kafka: at least ``kafka.bootstrap.servers``); ``max_records`` limits a
    Kafka batch."""
    def src(role: str) -> DataFrame:
        return keyed_source(spark, kind, locations[role], starting=starting,
                            max_files=max_files, max_bytes=max_bytes, options=options,
                            max_records=max_records)

    cards = decode(src("cards"), CARD_WIRE, mode=mode, keep=(), timestamp_as="card_ts").select(
        F.col("cardId").alias("card_id"), F.col("cardTitle").alias("title"), "card_ts")
    ver = decode(src("verifications"), VERIFICATION_WIRE, mode=mode, keep=(),
                 timestamp_as="verification_ts").select(
        F.col("verificationId").alias("id"), F.col("cardId").alias("card_id"),
        F.col("verificationDate").alias("verification_date"),
        F.col("verifiedByUserId").alias("verified_by"), "verification_ts")
    users = decode(src("users"), USER_WIRE, mode=mode, keep=(), timestamp_as="user_ts").select(
        F.col("userId").alias("user_id"), F.col("userName").alias("user_name"), "user_ts")
    return Star(cards, ver, users)


# ---- stream-static counts ----------------------------------------------------------------

def run_snapshot(counts: DataFrame, out: str, checkpoint: str,
                 trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Complete mode: the whole result table each batch, as ``out/batch_id=n``."""
    w = counts.writeStream.outputMode("complete").foreachBatch(BatchDirSink(out))
    return _start(w, checkpoint, trigger, counts.sparkSession, partitions)


def run_updates(counts: DataFrame, out: str, checkpoint: str,
                trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Update mode: only the rows whose value changed in each batch."""
    w = counts.writeStream.outputMode("update").foreachBatch(BatchDirSink(out))
    return _start(w, checkpoint, trigger, counts.sparkSession, partitions)


def run_retract(counts: DataFrame, key: Sequence[str], snapshots: str, changelog: str,
                checkpoint: str, value: str = "counts",
                trigger: dict | None = None, partitions: int | None = None) -> StreamingQuery:
    """Retract/add changelog at micro-batch grain (see ``RetractSink``)."""
    w = counts.writeStream.outputMode("complete").foreachBatch(
        RetractSink(snapshots, changelog, key, value))
    return _start(w, checkpoint, trigger, counts.sparkSession, partitions)


def run_sql(spark: SparkSession, views: dict[str, DataFrame], sql: str, out: str,
            checkpoint: str, mode: str = "update", trigger: dict | None = None,
            partitions: int | None = None,
            schemas: dict[str, T.StructType] | None = None) -> StreamingQuery:
    """SQL text over named (streaming and static) DataFrames, written per batch.

    A view named in ``schemas`` must have those columns with those types; the job does not
    start otherwise.

    The names exist only while the text is analysed; the analysed plan holds the
    DataFrames, so afterwards the names are dropped, or given back to the session's own
    temporary views that had them before.
    """
    for name, schema in (schemas or {}).items():
        try:
            require_schema(views[name], schema)
        except TypeError as e:
            raise TypeError(f"view {name}: {e}") from None
    taken = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    own = {name: spark.table(name) for name in views if name.lower() in taken}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    try:
        result = spark.sql(sql)
    finally:
        for name in views:
            if name in own:
                own[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
    w = result.writeStream.outputMode(mode).foreachBatch(BatchDirSink(out))
    return _start(w, checkpoint, trigger, spark, partitions)


def read_state_counts(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The grouping keys and the count that a counting job's checkpoint holds, read through
    Spark's state data source: all counts, also those under the job's threshold, without
    running the job or keeping its output. The grouping columns come as they are; the count
    is ``counts``."""
    state = (spark.read.format("statestore").option("path", checkpoint)
             .option("operatorId", str(operator)).load())
    if len(state.schema["value"].dataType.fields) != 1:
        raise ValueError("the operator's state is not a single count")
    return state.select("key.*", F.col(f"value.{state.schema['value'].dataType.names[0]}")
                        .cast("long").alias("counts"))


# ---- stream-stream join and relay -------------------------------------------------------

RELAY_COLUMNS = ["verification_id", "card_id", "card_title", "user_id", "user_name",
                 "verification_ts"]
RELAY_SCHEMA = T.StructType([
    T.StructField("verification_id", T.LongType()),
    T.StructField("card_id", T.LongType()),
    T.StructField("card_title", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("verification_ts", T.TimestampType()),
])


def stream_join(streams: Star, salt: int = 1) -> DataFrame:
    """cards stream JOIN verifications stream USING card_id, JOIN users stream on the
    verifier (append-only result; every side's rows stay in join state).

    AQE does not run in a streaming plan, so a hot card or user would put its share of
    the join state and work in one task. With ``salt`` > 1 each verification draws a salt
    per row (``salt_column``; identical copies are spread too) and every dimension row is
    replicated once per salt value; a hot key is then spread over ``salt`` tasks. The
    result is unchanged; dimension state grows ``salt`` times.
    """
    cards, ver, users = streams
    if salt > 1:
        replicas = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint")))
        ver = ver.withColumn("__salt", salt_column(salt))
        cards = cards.select("*", replicas.alias("__salt"))
        users = users.select("*", replicas.alias("__salt_u"))
        first = cards.join(ver, ["card_id", "__salt"])
        joined = first.join(users, (F.col("verified_by") == F.col("user_id"))
                            & (F.col("__salt") == F.col("__salt_u")))
    else:
        joined = cards.join(ver, "card_id").join(
            users, F.col("verified_by") == F.col("user_id"))
    return joined.select(F.col("id").alias("verification_id"), "card_id",
                         F.col("title").alias("card_title"), "user_id", "user_name",
                         "verification_ts")


def run_stream_join(streams: Star, relay: str, checkpoint: str,
                    trigger: dict | None = None, kind: str = "files",
                    options: dict[str, str] | None = None, salt: int = 1,
                    partitions: int | None = None) -> StreamingQuery:
    """Write the three-stream join to a relay.

    ``kind="files"``: a parquet relay through the file sink, exactly-once for readers.
    ``kind="kafka"``: topic ``relay``, key = user id, value = the joined row as JSON. The
    Kafka sink is at-least-once; the relay keeps the verification id, so a consumer can
    drop a replayed row (``SeenIds``, or ``relay_stream(dedup=True)``) instead of counting it
    twice.
    """
    joined = stream_join(streams, salt)
    if kind == "files":
        w = joined.writeStream.outputMode("append").format("parquet").option("path", relay)
    elif kind == "kafka":
        wire = joined.select(F.col("user_id").cast("string").alias("key"),
                             F.to_json(F.struct(*RELAY_COLUMNS)).alias("value"))
        w = wire.writeStream.outputMode("append").format("kafka").option("topic", relay)
        for k, v in (options or {}).items():
            w = w.option(k, v)
    else:
        raise ValueError(f"unknown relay kind {kind!r}")
    return _start(w, checkpoint, trigger, joined.sparkSession, partitions)


def relay_stream(spark: SparkSession, relay: str, kind: str = "files",
                 max_files: int | None = None, dedup: bool = False,
                 options: dict[str, str] | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """The relay as a stream of joined rows.

    With ``dedup`` a row whose ``verification_id`` was already seen is dropped, so a batch
    the relay delivered twice (an at-least-once Kafka sink after a failure) is counted once.
    There is no watermark: a first-seen id is never dropped, however late it comes. The
    price is one state row per id (spread over the state partitions by id, on disk).
    """
    if kind == "files":
        reader = spark.readStream.schema(RELAY_SCHEMA)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", str(max_files))
        elif max_bytes:
            reader = reader.option("maxBytesPerTrigger", str(int(max_bytes)))
        rows = reader.parquet(relay)
    elif kind == "kafka":
        wire = keyed_source(spark, "kafka", relay, options=options)
        rows = decode(wire, RELAY_SCHEMA, keep=())
    else:
        raise ValueError(f"unknown relay kind {kind!r}")
    return rows.dropDuplicates(["verification_id"]) if dedup else rows


def run_relay(spark: SparkSession, relay: str, out: str, checkpoint: str, threshold: int,
              by: str = "name", max_files: int | None = None,
              trigger: dict | None = None, kind: str = "files",
              dedup: bool = False,
              options: dict[str, str] | None = None,
              max_bytes: int | None = None, partitions: int | None = None) -> StreamingQuery:
    """Second stage: count the relay per user (complete mode), keep counts > threshold."""
    rows = relay_stream(spark, relay, kind, max_files, dedup, options, max_bytes)
    counts = enriched_counts(rows, by=by, threshold=threshold)
    return run_snapshot(counts, out, checkpoint, trigger, partitions)


def run_two_stage(spark: SparkSession, streams: Star, relay: str, out: str, checkpoint: str,
                  threshold: int, by: str = "name",
                  trigger: dict | None = None, kind: str = "files",
                  options: dict[str, str] | None = None, salt: int = 1,
                  partitions: int | None = None, max_bytes: int | None = None,
                  dedup: bool = False) -> list[StreamingQuery]:
    """Both stages at once (continuous use): the join feeding the relay and the count
    reading it. Returns the two queries; wait with ``await_any`` / ``stop_all``.

    The counting stage reads the file relay through its commit log, so it starts once the
    join has committed its first batch; it never waits for the source to fall silent. A
    Kafka relay (``options`` hold its broker) needs no such wait.
    """
    join_q = run_stream_join(streams, relay, f"{checkpoint}/join", trigger, kind, options, salt,
                             partitions)
    while kind == "files" and join_q.isActive and join_q.lastProgress is None:
        time.sleep(0.05)
    if join_q.exception() is not None:
        raise join_q.exception()
    count_q = run_relay(spark, relay, out, f"{checkpoint}/count", threshold, by, trigger=trigger,
                        kind=kind, options=options, dedup=dedup, max_bytes=max_bytes,
                        partitions=partitions)
    return [join_q, count_q]


def await_any(spark: SparkSession, timeout_s: int | None = None) -> bool | None:
    """Block until a query of the session ends (re-raising its error), or ``timeout_s``
    seconds pass. Queries that ended before the last ``resetTerminated`` do not count."""
    if timeout_s is None:
        return spark.streams.awaitAnyTermination()
    return spark.streams.awaitAnyTermination(int(timeout_s))


def stop_all(queries: Sequence[StreamingQuery]) -> None:
    for q in queries:
        q.stop()


# ---- live dimensions ------------------------------------------------------------------------

class LiveEnrich:
    """foreachBatch: enrich the batch against freshly read dimensions, write the relay.

    A verification is matched against the dimension rows present when its batch runs
    (a replicated table's semantics at micro-batch grain). Inside foreachBatch the join
    is a batch plan, so AQE sizes it (broadcast or shuffle, skew split) per batch.
    With ``by`` the batch is counted per user before it is written (eager aggregation),
    so the relay holds one row per user and batch instead of a copy of every fact.

    ``refresh_every`` = N > 1 reads the dimensions only every N batches and writes the
    reduced tables (latest row per key) once to the shared folder; the batches in between
    join that compact copy, so a long dimension log is not re-reduced per batch. A batch
    then sees dimension changes up to N - 1 batches late.
    """

    def __init__(self, load_dims: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
                 relay: str, by: str | None = None, refresh_every: int = 1):
        self.load_dims, self.relay, self.by = load_dims, relay, by
        self.refresh_every = max(1, int(refresh_every))
        self._dims: tuple[DataFrame, DataFrame] | None = None
        self._loaded_at = -1
        self._slot: str | None = None      # one reusable folder: refreshes overwrite it

    def dims(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, DataFrame]:
        if self.refresh_every == 1:
            return self.load_dims(spark)
        if self._dims is None or batch_id - self._loaded_at >= self.refresh_every \
                or batch_id < self._loaded_at:
            cards, users = self.load_dims(spark)
            self._slot = self._slot or scratch_dir(spark, "live-dims")
            self._dims = (write_stage(cards, "live-cards", f"{self._slot}/cards"),
                          write_stage(users, "live-users", f"{self._slot}/users"))
            self._loaded_at = batch_id
        return self._dims

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        cards, users = self.dims(batch.sparkSession, batch_id)
        if self.by:
            out = verified_users(cards, batch, users, by=self.by)
        else:
            out = enrich(cards, batch, users)
        out.write.mode("overwrite").parquet(batch_path(self.relay, batch_id))


def run_live(facts: DataFrame, load_dims: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
             relay: str, checkpoint: str, trigger: dict | None = None,
             by: str | None = None, refresh_every: int = 1) -> StreamingQuery:
    """Enrich (``by=None``) or count (``by="id"|"name"|"id_and_name"``) each batch against
    freshly read dimensions into ``relay/batch_id=n`` (see ``LiveEnrich``).

    Read the result with a batch job (``combine_counts`` for counts): batch folders may be
    rewritten on replay, which a file stream would count twice.
    """
    w = facts.writeStream.foreachBatch(LiveEnrich(load_dims, relay, by, refresh_every))
    return _start(w, checkpoint, trigger)


def combine_counts(spark: SparkSession, relay: str, by: str, threshold: int | None = None,
                   out: str = "counts") -> DataFrame:
    """Sum per-batch counts written by ``run_live(..., by=...)`` and apply the threshold."""
    from tristar.operators.counts import BY
    group, carry = BY[by]
    parts = spark.read.parquet(relay).drop("batch_id")
    res = parts.groupBy(*group).agg(*[getattr(F, fn)(c).alias(c) for c, fn in carry.items()],
                                    F.sum(out).cast("bigint").alias(out))
    return res if threshold is None else res.filter(F.col(out) > F.lit(threshold))
