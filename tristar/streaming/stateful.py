"""Streaming jobs that keep their state in a ``KeyedStore`` in place of Spark's state stores.

Each is a ``foreachBatch`` sink: a micro-batch is a batch plan (so AQE splits skewed joins), reads
version n - 1 of its tables, writes version n and its output under ``batch_id=n``. A replayed
batch does the same again and replaces both, so results are exactly-once, and a restart from
the checkpoint goes on where the last batch ended.

* ``RunningChangelog``: per input record, the running count of its key as updates or as
  retract/add messages, counting on across batches;
* ``RetractLog``: per micro-batch, the retract/add messages of the keys that the batch changed;
* ``PendingJoin``: three streams joined on unique dimension keys; only facts still without a
  dimension row are kept;
* ``SeenIds``: ids that occurred before, as bitmaps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tristar.operators.changelog import DEFAULT_BLOCK, numbered_from, retractions
from tristar.operators.counts import verified_users
from tristar.operators.enrich import enrich
from tristar.session import write_stage
from tristar.sources.roles import Star
from tristar.streaming.jobs import RELAY_COLUMNS, _start
from tristar.streaming.sinks import batch_path
from tristar.streaming.store import KeyedStore

COUNT_SCHEMA = "user_id long, counts long"


class RunningChangelog:
    """Writes ``out/batch_id=n`` with a message per record of the batch whose user's running
    count is over ``threshold``: ``(event_id, user_id, counts)``, or with ``retract`` also
    ``is_add`` and the message that takes the count before back. Records count in the order of
    batches, then of ``id``. State: one row a user."""

    def __init__(self, cards: DataFrame, users: DataFrame, out: str, state: str, threshold: int,
                 retract: bool = False, block: int = DEFAULT_BLOCK, compact_every: int = 8):
        self.cards, self.users, self.out = cards, users, out
        self.threshold, self.retract, self.block = threshold, retract, block
        self.store = KeyedStore(state, "user_id", COUNT_SCHEMA, compact_every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = enrich(self.cards, batch, self.users, fact_columns=["id", "verified_by"]).select(
            F.col("id").alias("event_id"), "user_id")
        carry = self.store.read(batch.sparkSession, batch_id - 1)
        numbered, totals = numbered_from(rows, "user_id", "event_id", carry, self.block)
        if self.retract:
            messages = retractions(numbered, "user_id", "event_id", self.threshold)
        else:
            messages = numbered.filter(F.col("__n") > self.threshold).select(
                "event_id", "user_id", F.col("__n").alias("counts"))
        messages.write.mode("overwrite").parquet(batch_path(self.out, batch_id))
        self.store.upsert(totals, batch_id)


def run_changelog(facts: DataFrame, cards: DataFrame, users: DataFrame, out: str, state: str,
                  checkpoint: str, threshold: int, retract: bool = False,
                  trigger: dict | None = None, block: int = DEFAULT_BLOCK) -> StreamingQuery:
    """Per-record updates, or retract/add messages, of the counts per user (O-40, O-41)."""
    sink = RunningChangelog(cards, users, out, state, threshold, retract, block)
    return _start(facts.writeStream.foreachBatch(sink), checkpoint, trigger)


class RetractLog:
    """Writes ``out/batch_id=n`` with ``(user_id, user_name, counts, is_add)``: for each user that
    the batch changed, a retraction of the old count if it was over ``threshold`` and an
    addition of the new one if it is. Users without a record in the batch cost nothing but
    the scan of the store."""

    KEY = ["user_id", "user_name"]

    def __init__(self, cards: DataFrame, users: DataFrame, out: str, state: str, threshold: int,
                 compact_every: int = 8):
        self.cards, self.users, self.out, self.threshold = cards, users, out, threshold
        self.store = KeyedStore(state, self.KEY,
                                "user_id long, user_name string, counts long, added long",
                                compact_every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        added = verified_users(self.cards, batch, self.users, by="id_and_name").select(
            *[F.col(k).alias(f"__{k}") for k in self.KEY], F.col("counts").alias("added"))
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.KEY]
        before = self.store.read(spark, batch_id - 1).select(*self.KEY, "counts")
        now = added.join(before, same, "left").select(
            *[F.col(f"__{k}").alias(k) for k in self.KEY],
            (F.coalesce("counts", F.lit(0)) + F.col("added")).alias("counts"), "added")
        self.store.upsert(now, batch_id)
        moves = F.array(
            F.struct(F.lit(False).alias("is_add"), (F.col("counts") - F.col("added")).alias("n")),
            F.struct(F.lit(True).alias("is_add"), F.col("counts").alias("n")))
        (self.store.delta(spark, batch_id).select(*self.KEY, F.explode(moves).alias("__m"))
         .select(*self.KEY, F.col("__m.n").alias("counts"), F.col("__m.is_add").alias("is_add"))
         .filter(F.col("counts") > self.threshold)
         .write.mode("overwrite").parquet(batch_path(self.out, batch_id)))

    def result(self, spark: SparkSession) -> DataFrame:
        """The current result: users over the threshold."""
        return self.store.read(spark).select(*self.KEY, "counts").filter(
            F.col("counts") > self.threshold)


def run_retract_log(facts: DataFrame, cards: DataFrame, users: DataFrame, out: str, state: str,
                    checkpoint: str, threshold: int, trigger: dict | None = None,
                    compact_every: int = 8) -> StreamingQuery:
    """Retract/add changelog of the counts per user, from changed users only (O-42)."""
    sink = RetractLog(cards, users, out, state, threshold, compact_every)
    return _start(facts.writeStream.foreachBatch(sink), checkpoint, trigger)


def _tagged(streams: Star) -> DataFrame:
    """The three streams as one, so that one query takes them batch by batch."""
    cards, facts, users = streams
    parts = (cards.select(F.lit("card").alias("__role"), "card_id", "title"),
             facts.select(F.lit("fact").alias("__role"), "id", "card_id", "verified_by",
                          "verification_ts"),
             users.select(F.lit("user").alias("__role"), "user_id", "user_name"))
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(
        parts[2], allowMissingColumns=True)


class PendingJoin:
    """cards JOIN facts JOIN users over three streams whose dimension keys are unique.

    A fact that meets both its dimension rows is written to ``out/batch_id=n/done=true`` and is
    done with: as keys are unique, no later row can match it again. Facts still without one are
    in ``done=false``, which the next batch takes up; older ones are retired. So the state is
    the dimensions and the unmatched facts, never the facts that were joined. A dimension key
    that comes twice breaks that rule and stops the job."""

    FACT = ["id", "card_id", "verified_by", "verification_ts"]

    def __init__(self, out: str, state: str, compact_every: int = 8):
        self.out = out
        self.cards = KeyedStore(f"{state}/cards", "card_id", "card_id long, title string",
                                compact_every)
        self.users = KeyedStore(f"{state}/users", "user_id", "user_id long, user_name string",
                                compact_every)

    def _add(self, store: KeyedStore, rows: DataFrame, batch_id: int) -> DataFrame:
        key = store.key[0]
        rows = rows.filter(F.col(key).isNotNull())
        old = store.read(rows.sparkSession, batch_id - 1)
        twice = (rows.select(key).unionByName(old.select(key).join(
            rows.select(key).distinct(), key, "left_semi"))
            .groupBy(key).agg(F.count("*").alias("n")).filter("n > 1"))
        if not twice.isEmpty():
            raise ValueError(f"{key} {twice.first()[key]} is not unique: a dimension key may "
                             "come once")
        store.upsert(rows, batch_id)
        return store.read(rows.sparkSession, batch_id)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            cards = self._add(self.cards, batch.filter("__role = 'card'").select(
                "card_id", "title"), batch_id)
            users = self._add(self.users, batch.filter("__role = 'user'").select(
                "user_id", "user_name"), batch_id)
            facts = batch.filter("__role = 'fact'").select(*self.FACT)
            if batch_id > 0:
                facts = facts.unionByName(self.pending(spark, batch_id - 1))
            found = (facts.join(cards.withColumn("__card", F.lit(True)), "card_id", "left")
                     .join(users, F.col("verified_by") == F.col("user_id"), "left"))
            (found.withColumn("done", F.col("__card").isNotNull() & F.col("user_id").isNotNull())
             .drop("__card").write.mode("overwrite").partitionBy("done")
             .parquet(batch_path(self.out, batch_id)))
        finally:
            batch.unpersist()
        fs, path = self.cards._fs(spark, f"{batch_path(self.out, batch_id - 2)}/done=false")
        if batch_id >= 2:
            fs.delete(path, True)

    def pending(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The facts that had no dimension row at the end of a batch."""
        kinds = ("id long, title string, card_id long, verified_by long, verification_ts timestamp, "
                 "user_id long, user_name string, done boolean")
        return (spark.read.schema(kinds).parquet(batch_path(self.out, batch_id))
                .filter("NOT done").select(*self.FACT))


def run_pending_join(streams: Star, out: str, state: str, checkpoint: str,
                     trigger: dict | None = None, compact_every: int = 8) -> StreamingQuery:
    """Joins three keyed streams, keeping only facts that still wait for a dimension row
    (O-32, O-33). Read the result with ``read_joined``."""
    sink = PendingJoin(out, state, compact_every)
    return _start(_tagged(streams).writeStream.foreachBatch(sink), checkpoint, trigger)


def read_joined(spark: SparkSession, out: str) -> DataFrame:
    """The joined rows of all batches, with the columns of the relay."""
    kinds = ("id long, title string, card_id long, verified_by long, verification_ts timestamp, "
             "user_id long, user_name string, done boolean, batch_id long")
    rows = spark.read.schema(kinds).parquet(out).filter("done")
    return rows.select(F.col("id").alias("verification_id"), "card_id",
                       F.col("title").alias("card_title"), "user_id", "user_name",
                       "verification_ts").select(*RELAY_COLUMNS)


class SeenIds:
    """Ids that occurred in an earlier batch, as one bitmap of 32,768 bits per id range.

    A stream's ids are mostly dense, so a seen id costs about a bit in place of a state row; a
    range with a single id costs a bitmap of 4 KB before compression. Null ids are one id."""

    def __init__(self, state: str, compact_every: int = 8):
        self.store = KeyedStore(state, "bucket", "bucket long, bits binary", compact_every)

    @staticmethod
    def bit(bits: Column, position: Column) -> Column:
        """Whether the bit at ``position`` is set."""
        byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
        return F.floor(byte.cast("int") / F.pow(F.lit(2), position % 8)) % 2 == 1

    def fresh(self, rows: DataFrame, id_column: str, batch_id: int) -> DataFrame:
        """One row for each id of the batch that no earlier batch had."""
        bits = self.store.read(rows.sparkSession, batch_id - 1).select(
            F.col("bucket").alias("__bucket"), "bits")
        bucket = F.bitmap_bucket_number(F.coalesce(id_column, F.lit(0)))
        marked = rows.dropDuplicates([id_column]).withColumn(
            "__b", F.when(F.col(id_column).isNotNull(), bucket))
        position = F.bitmap_bit_position(F.coalesce(id_column, F.lit(0))).cast("int")
        seen = F.coalesce(F.when(F.col("__b").isNull(), F.col("bits").isNotNull()).otherwise(
            self.bit(F.col("bits"), position)), F.lit(False))
        return (marked.join(bits, F.col("__b").eqNullSafe(F.col("__bucket")), "left")
                .filter(~seen).drop("__b", "__bucket", "bits"))

    def add(self, rows: DataFrame, id_column: str, batch_id: int) -> None:
        """Marks the ids of ``rows`` as seen."""
        spark, some = rows.sparkSession, F.coalesce(id_column, F.lit(0))
        bucket = F.when(F.col(id_column).isNotNull(), F.bitmap_bucket_number(some))
        new = rows.groupBy(bucket.alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(some)).alias("bits"))
        names = new.select(F.col("bucket").alias("__bucket"))
        old = self.store.read(spark, batch_id - 1).join(
            names, F.col("bucket").eqNullSafe(F.col("__bucket")), "left_semi")
        self.store.upsert(new.unionByName(old).groupBy("bucket").agg(
            F.bitmap_or_agg("bits").alias("bits")), batch_id)


class RelayCounts:
    """Counts relay rows per user name, each id once however often it was delivered; writes the
    counts over ``threshold`` to ``out/batch_id=n``."""

    def __init__(self, out: str, state: str, threshold: int, compact_every: int = 8):
        self.out, self.threshold = out, threshold
        self.seen = SeenIds(f"{state}/seen", compact_every)
        self.store = KeyedStore(f"{state}/counts", "user_name", "user_name string, counts long",
                                compact_every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = write_stage(self.seen.fresh(batch.select("verification_id", "user_name"),
                                            "verification_id", batch_id), "relay-fresh")
        added = fresh.groupBy("user_name").agg(F.count("*").alias("counts"))
        before = self.store.read(spark, batch_id - 1).join(
            added.select(F.col("user_name").alias("__name")),
            F.col("user_name").eqNullSafe(F.col("__name")), "left_semi")
        self.store.upsert(before.unionByName(added).groupBy("user_name").agg(
            F.sum("counts").alias("counts")), batch_id)
        self.seen.add(fresh, "verification_id", batch_id)
        (self.store.delta(spark, batch_id).select("user_name", "counts")
         .filter(F.col("counts") > self.threshold)
         .write.mode("overwrite").parquet(batch_path(self.out, batch_id)))

    def result(self, spark: SparkSession) -> DataFrame:
        return self.store.read(spark).filter(F.col("counts") > self.threshold)


def run_sink(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
             trigger: dict | None = None) -> StreamingQuery:
    """Runs any of the sinks above on a stream."""
    return _start(stream.writeStream.foreachBatch(sink), checkpoint, trigger)
