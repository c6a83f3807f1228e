"""Streaming entries of the registry: each runs its job to completion over the whole
``events`` table (``availableNow``) in a fresh folder under ``spark.checkpoint.dir`` and
returns the job's output read back as a batch DataFrame, so it compares with SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tristar.functions.records import encode, rename_all
from tristar.operators.counts import enriched_counts
from tristar.session import batch_bytes, scratch_dir
from tristar.sources.keyed import keyed_source, keyed_table, read_keyed
from tristar.operators.enrich import enrich, prepare_dimension
from tristar.sources.roles import (
    CARD_SCHEMA, CHANGELOG_THRESHOLD, EVENT_THRESHOLD, RETRACT_THRESHOLD, Star, USER_SCHEMA,
    VERIFICATION_SCHEMA, cards_from_part, event_star, read_table, users_from_customer,
)
from tristar.streaming.jobs import (
    BOUNDED, CARD_WIRE, DEFAULT_BROADCAST_ROWS, USER_WIRE, VERIFICATION_WIRE, combine_counts, event_fact_stream,
    keyed_star_streams,
    publish_star, read_state_counts, relay_stream, run_live, run_relay, run_retract, run_snapshot, run_sql, run_stream_join,
    run_updates,
    state_partitions, stream_enriched,
)
from tristar.streaming.losses import decode_counted, join_counted, observed_totals
from tristar.streaming.stateful import (
    RelayCounts, read_joined, run_changelog, run_pending_join, run_retract_log, run_sink,
)
from tristar.streaming.sinks import (
    BatchDirSink, net_changelog, read_changelog, read_final_state, read_latest_snapshot,
)

USER_COLS = ["user_id", "user_name", "counts"]


BATCHES = 4   # micro-batches of each entry, so that state is merged and rows are retracted
SALT = 4      # state partitions a hot card or user of the stream-stream join is spread over


def _in_ranges(spark: SparkSession, df: DataFrame, order: str) -> tuple[DataFrame, int]:
    """``df`` cut into ranges of ``order`` (at least four files), and the files per micro-batch
    that make about ``BATCHES`` batches."""
    files = max(BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionByRange(files, order), -(-files // BATCHES)


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole events table as a stream, appended to the run folder in id ranges and taken
    in four micro-batches or more."""
    ranges, per_batch = _in_ranges(spark, read_table(spark, sf, "events"), "event_id")
    folder = scratch_dir(spark, "events")
    ranges.write.parquet(folder)
    return event_fact_stream(spark, folder, max_files=per_batch)


def _dims(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return (cards_from_part(read_table(spark, sf, "part")),
            users_from_customer(read_table(spark, sf, "customer")))


def q_stream_snapshot_counts(spark: SparkSession, sf: str) -> DataFrame:
    run = scratch_dir(spark, "stream_snapshot_counts")
    cards, users = _dims(spark, sf)
    counts = enriched_counts(stream_enriched(_facts(spark, sf), cards, users),
                             by="id_and_name", threshold=EVENT_THRESHOLD)
    run_snapshot(counts, f"{run}/out", f"{run}/checkpoint", BOUNDED,
                 partitions=state_partitions(spark)).awaitTermination()
    return read_latest_snapshot(spark, f"{run}/out").select(*USER_COLS)


def q_stream_update_counts(spark: SparkSession, sf: str) -> DataFrame:
    run = scratch_dir(spark, "stream_update_counts")
    cards, users = _dims(spark, sf)
    counts = enriched_counts(stream_enriched(_facts(spark, sf), cards, users),
                             by="id_and_name", threshold=EVENT_THRESHOLD)
    run_updates(counts, f"{run}/out", f"{run}/checkpoint", BOUNDED,
                partitions=state_partitions(spark)).awaitTermination()
    return read_final_state(spark, f"{run}/out", ["user_id", "user_name"]).select(*USER_COLS)


def q_stream_retract_net(spark: SparkSession, sf: str) -> DataFrame:
    """Micro-batch retract/add changelog of the thresholded counts, applied: what remains
    is the final result, whatever the batch boundaries were."""
    run = scratch_dir(spark, "stream_retract_net")
    cards, users = _dims(spark, sf)
    counts = enriched_counts(stream_enriched(_facts(spark, sf), cards, users),
                             by="id_and_name", threshold=EVENT_THRESHOLD)
    run_retract(counts, ["user_id", "user_name"], f"{run}/snapshots", f"{run}/changelog",
                f"{run}/checkpoint", trigger=BOUNDED,
                partitions=state_partitions(spark)).awaitTermination()
    log = read_changelog(spark, f"{run}/changelog")
    return net_changelog(log, ["user_id", "user_name"]).select(*USER_COLS)


def q_stream_sql_having(spark: SparkSession, sf: str) -> DataFrame:
    run = scratch_dir(spark, "stream_sql_having")
    # Views by position, as a SQL script would name its columns; checked when the job starts.
    cards = rename_all(read_table(spark, sf, "part").select("p_partkey", "p_name"),
                       CARD_SCHEMA.names)
    users = rename_all(read_table(spark, sf, "customer").select("c_custkey", "c_name"),
                       USER_SCHEMA.names)
    facts = _facts(spark, sf).withColumn("card_id", F.col("card_id").cast("long"))
    views = {"verifications": facts,
             "cards": prepare_dimension(cards, "card_id", DEFAULT_BROADCAST_ROWS, name="cards"),
             "users": prepare_dimension(users, "user_id", DEFAULT_BROADCAST_ROWS, name="users")}
    schemas = {"verifications": VERIFICATION_SCHEMA, "cards": CARD_SCHEMA, "users": USER_SCHEMA}
    sql = ("SELECT u.user_id, u.user_name, COUNT(*) AS counts "
           "FROM verifications v JOIN cards c ON c.card_id = v.card_id "
           "JOIN users u ON v.verified_by = u.user_id "
           f"GROUP BY u.user_id, u.user_name HAVING COUNT(*) > {EVENT_THRESHOLD}")
    run_sql(spark, views, sql, f"{run}/out", f"{run}/checkpoint",
            trigger=BOUNDED, partitions=state_partitions(spark),
            schemas=schemas).awaitTermination()
    return read_final_state(spark, f"{run}/out", ["user_id", "user_name"]).select(*USER_COLS)


def _published_streams(spark: SparkSession, sf: str, run: str) -> Star:
    star = event_star(spark, sf)
    ranges, per_batch = _in_ranges(spark, star.verifications, "id")
    paths = publish_star(star._replace(verifications=ranges), f"{run}/topics")
    return keyed_star_streams(spark, paths, kind="files", max_files=per_batch)


def q_stream_stream_join(spark: SparkSession, sf: str) -> DataFrame:
    run = scratch_dir(spark, "stream_stream_join")
    streams = _published_streams(spark, sf, run)
    run_stream_join(streams, f"{run}/relay", f"{run}/checkpoint", BOUNDED, salt=SALT,
                    partitions=state_partitions(spark)).awaitTermination()
    return spark.read.parquet(f"{run}/relay").select(
        "verification_id", "card_id", "card_title", "user_id", "user_name")


def q_two_stage_relay(spark: SparkSession, sf: str) -> DataFrame:
    run = scratch_dir(spark, "two_stage_relay")
    streams = _published_streams(spark, sf, run)
    run_stream_join(streams, f"{run}/relay", f"{run}/checkpoint-join", BOUNDED, salt=SALT,
                    partitions=state_partitions(spark)).awaitTermination()
    run_relay(spark, f"{run}/relay", f"{run}/out", f"{run}/checkpoint-count",
              threshold=EVENT_THRESHOLD, by="name", trigger=BOUNDED,
              max_bytes=batch_bytes(spark),
              partitions=state_partitions(spark)).awaitTermination()
    return read_latest_snapshot(spark, f"{run}/out").select("user_name", "counts")


def q_relay_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """A relay that an at-least-once sink filled: the later half of the events first, then the
    earlier half (late rows), then a third of all rows again. Each event counts once."""
    run = scratch_dir(spark, "relay_dedup")
    cards, verifications, users = event_star(spark, sf)
    rows = enrich(cards, verifications, users).select(
        F.col("id").alias("verification_id"), "card_id", F.col("title").alias("card_title"),
        "user_id", "user_name", F.col("verification_date").cast("timestamp").alias(
            "verification_ts"))
    middle = verifications.agg(F.avg("id")).first()[0] or 0
    sink = RelayCounts(f"{run}/out", f"{run}/state", EVENT_THRESHOLD)
    for part in (rows.filter(F.col("verification_id") > middle),
                 rows.filter(F.col("verification_id") <= middle),
                 rows.filter("verification_id % 3 = 0")):
        part.write.mode("append").parquet(f"{run}/relay")
        run_sink(relay_stream(spark, f"{run}/relay"), sink, f"{run}/checkpoint",
                 BOUNDED).awaitTermination()
    return sink.result(spark).select("user_name", "counts")


# ---- state in a keyed store ----------------------------------------------------------------

def _in_id_parts(spark: SparkSession, sf: str, run: str,
                 job: Callable[[DataFrame], StreamingQuery]) -> None:
    """Appends the whole events table part by part (``BATCHES`` equal ranges of ids) and runs the
    job from its checkpoint after each, so every part is one micro-batch and a restart."""
    events = read_table(spark, sf, "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    width = 1 if low is None else high - low + 1
    part = F.expr(f"((event_id - {low or 0}) * {BATCHES}) div {width}")
    for k in range(BATCHES):
        events.filter(part == k).write.mode("append").parquet(f"{run}/events")
        job(event_fact_stream(spark, f"{run}/events")).awaitTermination()


def _run_changelog(spark: SparkSession, sf: str, retract: bool) -> str:
    run = scratch_dir(spark, "stream_changelog")
    cards, users = _dims(spark, sf)
    _in_id_parts(spark, sf, run, lambda facts: run_changelog(
        facts, cards, users, f"{run}/out", f"{run}/state", f"{run}/checkpoint",
        CHANGELOG_THRESHOLD, retract, BOUNDED))
    return f"{run}/out"


def q_stream_running_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Per record: the running count of its user, counted on across batches and restarts."""
    return spark.read.parquet(_run_changelog(spark, sf, False)).select(
        "event_id", "user_id", "counts")


def q_stream_retract_records(spark: SparkSession, sf: str) -> DataFrame:
    """Per record: the retract and add message of its user's count."""
    return spark.read.parquet(_run_changelog(spark, sf, True)).select(
        "event_id", "user_id", "is_add", "counts")


def q_stream_retract_log(spark: SparkSession, sf: str) -> DataFrame:
    """Every retract and add row of every micro-batch."""
    run = scratch_dir(spark, "stream_retract_log")
    cards, users = _dims(spark, sf)
    _in_id_parts(spark, sf, run, lambda facts: run_retract_log(
        facts, cards, users, f"{run}/out", f"{run}/state", f"{run}/checkpoint",
        RETRACT_THRESHOLD, BOUNDED, compact_every=2))
    return read_changelog(spark, f"{run}/out").select(
        F.col("batch_id").cast("long").alias("batch"), *USER_COLS, "is_add")


def q_stream_pending_join(spark: SparkSession, sf: str) -> DataFrame:
    """Three keyed streams joined; each part of the facts comes with a quarter of the cards and
    users, so facts wait for dimension rows that come up to three batches later."""
    run = scratch_dir(spark, "stream_pending_join")
    cards, facts, users = event_star(spark, sf)
    low, high = facts.agg(F.min("id"), F.max("id")).first()
    width = 1 if low is None else high - low + 1
    for k in range(BATCHES):
        publish_star(Star(cards.filter(F.pmod(F.hash("card_id"), F.lit(BATCHES)) == k),
                          facts.filter(F.expr(f"((id - {low or 0}) * {BATCHES}) div {width}") == k),
                          users.filter(F.pmod(F.hash("user_id"), F.lit(BATCHES)) == k)),
                     f"{run}/topics", mode="append")
        streams = keyed_star_streams(spark, {r: f"{run}/topics/{r}" for r in
                                             ("cards", "verifications", "users")})
        run_pending_join(streams, f"{run}/out", f"{run}/state", f"{run}/checkpoint",
                         BOUNDED).awaitTermination()
    return read_joined(spark, f"{run}/out").select(
        "verification_id", "card_id", "card_title", "user_id", "user_name")


def q_state_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Runs the update job, then reads its counts from the state in its checkpoint."""
    run = scratch_dir(spark, "state_counts")
    cards, users = _dims(spark, sf)
    counts = enriched_counts(stream_enriched(_facts(spark, sf), cards, users),
                             by="id_and_name", threshold=EVENT_THRESHOLD)
    run_updates(counts, f"{run}/out", f"{run}/checkpoint", BOUNDED,
                partitions=state_partitions(spark)).awaitTermination()
    return (read_state_counts(spark, f"{run}/checkpoint").select(*USER_COLS)
            .filter(F.col("counts") > EVENT_THRESHOLD))


def q_decode_report(spark: SparkSession, sf: str) -> DataFrame:
    """What a permissive job over a damaged log leaves out: every tenth record's text is cut, every
    tenth is a tombstone; a third of the users and a fifth of the cards are missing."""
    run = scratch_dir(spark, "decode_report")
    cards, facts, users = event_star(spark, sf)
    wire = encode(facts, "id", ["id", "card_id", "verified_by"],
                  names=["verificationId", "cardId", "verifiedByUserId"], keep=("id",))
    kind = F.col("id") % 10
    (wire.select("key", F.when(kind == 0, F.expr("substring(value, 3, 9)"))
                 .when(kind != 1, F.col("value")).alias("value"),
                 F.current_timestamp().alias("timestamp")).write.parquet(f"{run}/topic"))
    records = decode_counted(keyed_source(spark, "files", f"{run}/topic"), VERIFICATION_WIRE)
    joined = join_counted(
        cards.filter("card_id % 5 <> 0"),
        records.select("verificationId", F.col("cardId").alias("card_id"),
                       F.col("verifiedByUserId").alias("verified_by")),
        users.filter("user_id % 3 <> 0"))
    query = run_sink(joined.select("verificationId", "card_id", "user_id"),
                     BatchDirSink(f"{run}/out"), f"{run}/checkpoint", BOUNDED)
    query.awaitTermination()
    lost = observed_totals(query)
    names = ("records", "tombstones", "undecodable", "facts", "no_card", "no_user")
    return spark.read.parquet(f"{run}/out").agg(F.count("*").alias("joined")).select(
        *[F.lit(lost.get(n, 0)).cast("long").alias(n) for n in names], "joined")


def _live_dims(topics: dict[str, str]):
    """Dimensions as replicated tables: the keyed record logs re-read per micro-batch,
    latest record per key, tombstones deleting."""
    def load(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        cards = keyed_table(read_keyed(spark, topics["cards"]), CARD_WIRE,
                            {"cardId": "card_id", "cardTitle": "title"})
        users = keyed_table(read_keyed(spark, topics["users"]), USER_WIRE,
                            {"userId": "user_id", "userName": "user_name"})
        return cards, users
    return load


def q_live_dimension_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Facts stream against dimensions published as keyed records and read back as
    replicated tables each micro-batch; each batch is counted per user before it is
    written, and the per-batch counts are summed by a batch job."""
    run = scratch_dir(spark, "live_dimension_counts")
    topics = publish_star(event_star(spark, sf), f"{run}/topics", roles=("cards", "users"))
    run_live(_facts(spark, sf), _live_dims(topics), f"{run}/relay", f"{run}/checkpoint",
             BOUNDED, by="id_and_name").awaitTermination()
    return combine_counts(spark, f"{run}/relay", "id_and_name",
                          EVENT_THRESHOLD).select(*USER_COLS)


STREAMS = {
    "stream_snapshot_counts": q_stream_snapshot_counts,
    "stream_update_counts": q_stream_update_counts,
    "stream_stream_join": q_stream_stream_join,
    "two_stage_relay": q_two_stage_relay,
    "relay_dedup": q_relay_dedup,
    "stream_sql_having": q_stream_sql_having,
    "stream_retract_net": q_stream_retract_net,
    "stream_running_updates": q_stream_running_updates,
    "stream_retract_records": q_stream_retract_records,
    "stream_retract_log": q_stream_retract_log,
    "stream_pending_join": q_stream_pending_join,
    "state_counts": q_state_counts,
    "decode_report": q_decode_report,
    "live_dimension_counts": q_live_dimension_counts,
}
