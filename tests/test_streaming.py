"""Streaming jobs: each result equals its batch twin after a bounded run over several
micro-batches; restart, retraction, late-dimension and live-refresh fixtures."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF0001, rows_of
from tristar.operators import enriched_counts, verified_users
from tristar.sources import event_star
from tristar.sources.roles import EVENT_THRESHOLD, cards_from_part, read_table, users_from_customer
from tristar.streaming import (
    event_fact_stream, keyed_star_streams, read_changelog, read_final_state,
    read_latest_snapshot, run_live, run_relay, run_retract, run_snapshot, run_sql,
    run_stream_join, run_updates, stream_enriched,
)
from tristar.streaming.jobs import BOUNDED, publish_star

K = EVENT_THRESHOLD


@pytest.fixture(scope="module")
def chunked_events(spark, tmp_path_factory):
    """The sf0.001 events table split into 4 files (4 micro-batches at one file each)."""
    path = str(tmp_path_factory.mktemp("events"))
    (read_table(spark, SF0001, "events").repartitionByRange(4, "event_id")
     .write.mode("overwrite").parquet(path))
    return path


def dims(spark):
    return (cards_from_part(read_table(spark, SF0001, "part")),
            users_from_customer(read_table(spark, SF0001, "customer")))


def batch_twin(spark):
    return verified_users(*event_star(spark, SF0001), by="id_and_name", threshold=K)


def counts_stream(spark, folder):
    cards, users = dims(spark)
    facts = event_fact_stream(spark, folder, max_files=1)
    return enriched_counts(stream_enriched(facts, cards, users), by="id_and_name", threshold=K)


def test_snapshot_equals_batch_and_restart_keeps_totals(spark, chunked_events, tmp_dir):
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    q = run_snapshot(counts_stream(spark, chunked_events), out, ckpt, BOUNDED)
    q.awaitTermination()
    assert len(q.recentProgress) >= 4
    first = rows_of(read_latest_snapshot(spark, out))
    assert first == rows_of(batch_twin(spark))
    run_snapshot(counts_stream(spark, chunked_events), out, ckpt, BOUNDED).awaitTermination()
    assert rows_of(read_latest_snapshot(spark, out)) == first


def test_update_mode_final_state_equals_batch(spark, chunked_events, tmp_dir):
    out = f"{tmp_dir}/out"
    q = run_updates(counts_stream(spark, chunked_events), out, f"{tmp_dir}/ckpt", BOUNDED)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 4
    assert rows_of(read_final_state(spark, out, ["user_id", "user_name"])) == \
        rows_of(batch_twin(spark))


def test_sql_over_streaming_views(spark, chunked_events, tmp_dir):
    cards, users = dims(spark)
    views = {"v": event_fact_stream(spark, chunked_events, max_files=1), "c": cards, "u": users}
    sql = ("SELECT u.user_id, u.user_name, COUNT(*) AS counts FROM v JOIN c ON c.card_id = "
           "v.card_id JOIN u ON v.verified_by = u.user_id GROUP BY u.user_id, u.user_name "
           f"HAVING COUNT(*) > {K}")
    run_sql(spark, views, sql, f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
            trigger=BOUNDED).awaitTermination()
    assert rows_of(read_final_state(spark, f"{tmp_dir}/out", ["user_id", "user_name"])) == \
        rows_of(batch_twin(spark))


def test_micro_batch_retract_changelog(spark, chunked_events, tmp_dir):
    """Replaying the changelog (retract old, add new) ends at the batch result."""
    run_retract(counts_stream(spark, chunked_events), ["user_id", "user_name"],
                f"{tmp_dir}/snap", f"{tmp_dir}/log", f"{tmp_dir}/ckpt",
                trigger=BOUNDED).awaitTermination()
    log = read_changelog(spark, f"{tmp_dir}/log")
    signed = log.select("user_id", "user_name", "counts",
                        F.when(F.col("is_add"), 1).otherwise(-1).alias("s"))
    net = (signed.groupBy("user_id", "user_name", "counts").agg(F.sum("s").alias("s"))
           .filter("s != 0"))
    assert net.filter("s != 1").count() == 0
    assert rows_of(net.drop("s")) == rows_of(batch_twin(spark))


def write_keyed(spark, folder, records):
    """One file of keyed JSON records: [(key, value_dict_or_None, ts)]."""
    rows = [(k, None if v is None else json.dumps(v), ts) for k, v, ts in records]
    spark.createDataFrame(rows, "key string, value string, timestamp timestamp") \
        .coalesce(1).write.mode("append").parquet(folder)


def test_retraction_fixture_three_batches(spark, tmp_dir):
    # k = 1, three micro-batches of one verification each: (add 2), (retract 2), (add 3)
    topics = {r: f"{tmp_dir}/{r}" for r in ("cards", "verifications", "users")}
    t = dt.datetime(2024, 1, 1)
    write_keyed(spark, topics["cards"], [("1", {"cardId": 1, "cardTitle": "a"}, t)])
    write_keyed(spark, topics["users"], [("1", {"userId": 1, "userName": "ann"}, t)])
    cards = spark.createDataFrame([(1, "a")], "card_id long, title string")
    users = spark.createDataFrame([(1, "ann")], "user_id long, user_name string")
    ckpt, snap, log = f"{tmp_dir}/ckpt", f"{tmp_dir}/snap", f"{tmp_dir}/log"
    for i in range(3):
        write_keyed(spark, topics["verifications"], [(
            str(i), {"verificationId": i, "cardId": 1, "verificationDate": 0,
                     "verifiedByUserId": 1}, t)])
        s = keyed_star_streams(spark, topics)
        counts = enriched_counts(stream_enriched(s.verifications, cards, users),
                                 by="id_and_name", threshold=1)
        run_retract(counts, ["user_id", "user_name"], snap, log, ckpt,
                    trigger=BOUNDED).awaitTermination()
    got = [(r.batch_id, r.is_add, r.counts) for r in
           read_changelog(spark, log).orderBy("batch_id", "is_add").collect()]
    assert got == [(1, True, 2), (2, False, 2), (2, True, 3)]


def test_late_dimension_stream_stream_matches(spark, tmp_dir):
    topics = {r: f"{tmp_dir}/{r}" for r in ("cards", "verifications", "users")}
    t = dt.datetime(2024, 1, 1)
    write_keyed(spark, topics["cards"], [("1", {"cardId": 1, "cardTitle": "a"}, t)])
    write_keyed(spark, topics["verifications"], [("10", {
        "verificationId": 10, "cardId": 1, "verificationDate": 0, "verifiedByUserId": 7}, t)])
    write_keyed(spark, topics["users"], [("8", {"userId": 8, "userName": "other"}, t)])
    relay, ckpt = f"{tmp_dir}/relay", f"{tmp_dir}/ckpt"
    run_stream_join(keyed_star_streams(spark, topics), relay, ckpt, BOUNDED).awaitTermination()
    assert spark.read.parquet(relay).count() == 0
    # the user arrives in a later batch: the buffered verification now matches
    write_keyed(spark, topics["users"], [("7", {"userId": 7, "userName": "late"}, t)])
    run_stream_join(keyed_star_streams(spark, topics), relay, ckpt, BOUNDED).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(relay).select(
        "verification_id", "card_id", "card_title", "user_id", "user_name").collect()]
    assert got == [(10, 1, "a", 7, "late")]


def test_late_dimension_stream_static_drops_and_is_not_seen(spark, tmp_dir):
    facts_dir, users_dir = f"{tmp_dir}/facts", f"{tmp_dir}/users"
    spark.createDataFrame([(1, 1, 7)], "id long, card_id long, verified_by long") \
        .write.parquet(facts_dir)
    spark.createDataFrame([(8, "other")], "user_id long, user_name string").write.parquet(users_dir)
    cards = spark.createDataFrame([(1, "a")], "card_id long, title string")
    users = spark.read.parquet(users_dir)
    facts = spark.readStream.schema("id long, card_id long, verified_by long").parquet(facts_dir)
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    enriched = stream_enriched(facts, cards, users, broadcast_rows=None)
    q = enriched.writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 0          # no user 7 yet: dropped
    # a user file added mid-job is not seen by a DataFrame listed before it
    spark.createDataFrame([(7, "late")], "user_id long, user_name string") \
        .write.mode("append").parquet(users_dir)
    assert users.count() == 1
    assert spark.read.parquet(users_dir).count() == 2


def test_two_stage_relay_multi_batch(spark, tmp_dir):
    paths = publish_star(event_star(spark, SF0001), f"{tmp_dir}/topics")
    streams = keyed_star_streams(spark, paths)
    relay = f"{tmp_dir}/relay"
    run_stream_join(streams, relay, f"{tmp_dir}/c1", BOUNDED).awaitTermination()
    run_relay(spark, relay, f"{tmp_dir}/out", f"{tmp_dir}/c2", threshold=K, by="name",
              max_files=1, trigger=BOUNDED).awaitTermination()
    want = verified_users(*event_star(spark, SF0001), by="name", threshold=K)
    assert rows_of(read_latest_snapshot(spark, f"{tmp_dir}/out")) == rows_of(want)
    # the relay carries the verification id: no duplicates even across batches
    r = spark.read.parquet(relay)
    assert r.count() == r.select("verification_id").distinct().count()


def test_live_dimensions_see_new_rows(spark, tmp_dir):
    facts_dir, users_dir = f"{tmp_dir}/facts", f"{tmp_dir}/users"
    schema = "id long, card_id long, verified_by long"
    spark.createDataFrame([(1, 1, 7)], schema).write.parquet(f"{facts_dir}/a")
    spark.createDataFrame([(8, "other")], "user_id long, user_name string").write.parquet(users_dir)
    cards = spark.createDataFrame([(1, "a")], "card_id long, title string")

    def load(s):
        return cards, s.read.parquet(users_dir)

    facts = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(facts_dir)
    relay, ckpt = f"{tmp_dir}/relay", f"{tmp_dir}/ckpt"
    run_live(facts, load, relay, ckpt, BOUNDED).awaitTermination()
    spark.createDataFrame([(7, "late")], "user_id long, user_name string") \
        .write.mode("append").parquet(users_dir)
    spark.createDataFrame([(2, 1, 7)], schema).write.parquet(f"{facts_dir}/b")
    facts = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(facts_dir)
    run_live(facts, load, relay, ckpt, BOUNDED).awaitTermination()
    got = sorted(r.id for r in spark.read.parquet(relay).collect())
    assert got == [2]          # the first fact met no user 7 in its batch; the second did


def test_registry_stream_entries_use_fresh_folders(spark):
    a = E.queries()["stream_update_counts"](spark, SF0001)
    b = E.queries()["stream_update_counts"](spark, SF0001)
    assert rows_of(a) == rows_of(b) == rows_of(batch_twin(spark))
    assert str(uuid.uuid4())  # folders are uuid-named; reruns never collide


def test_two_stage_continuous_trigger(spark, tmp_dir):
    from tristar.streaming import run_two_stage, stop_all
    paths = publish_star(event_star(spark, SF0001), f"{tmp_dir}/topics")
    qs = run_two_stage(spark, keyed_star_streams(spark, paths), f"{tmp_dir}/relay",
                       f"{tmp_dir}/out", f"{tmp_dir}/ckpt", threshold=K,
                       trigger={"processingTime": "1 second"})
    try:
        for q in qs:
            q.processAllAvailable()
    finally:
        stop_all(qs)
    want = verified_users(*event_star(spark, SF0001), by="name", threshold=K)
    assert rows_of(read_latest_snapshot(spark, f"{tmp_dir}/out")) == rows_of(want)


def test_bucketed_dimension_is_not_reshuffled_per_batch(spark, chunked_events, tmp_dir, capsys):
    from tristar.operators import prepare_dimension
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cards, users = dims(spark)
        cb = prepare_dimension(cards, "card_id", max_broadcast_rows=0, name="cards")
        ub = prepare_dimension(users, "user_id", max_broadcast_rows=0, name="users")
        facts = event_fact_stream(spark, chunked_events, max_files=1)
        counts = enriched_counts(stream_enriched(facts, cb, ub, broadcast_rows=None),
                                 by="id_and_name", threshold=K)
        q = run_snapshot(counts, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", BOUNDED)
        q.awaitTermination()
        capsys.readouterr()
        q.explain()
        plan = capsys.readouterr().out
        assert "Bucketed: true" in plan
        # exchanges: the batch to card buckets, the batch to user buckets, the aggregate
        assert plan.count("Exchange hashpartitioning") == 3
        assert rows_of(read_latest_snapshot(spark, f"{tmp_dir}/out")) == \
            rows_of(batch_twin(spark))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_dimension_broadcast(spark):
    from tristar.operators import prepare_dimension
    cards, _ = dims(spark)
    d = prepare_dimension(cards, "card_id", max_broadcast_rows=10_000)
    j = spark.range(3).withColumnRenamed("id", "card_id").join(d, "card_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(j)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_salted_stream_join_equals_plain(spark, tmp_dir):
    paths = publish_star(event_star(spark, SF0001), f"{tmp_dir}/topics")
    plain, salted = f"{tmp_dir}/plain", f"{tmp_dir}/salted"
    run_stream_join(keyed_star_streams(spark, paths), plain, f"{tmp_dir}/c1",
                    BOUNDED).awaitTermination()
    run_stream_join(keyed_star_streams(spark, paths), salted, f"{tmp_dir}/c2", BOUNDED,
                    salt=5).awaitTermination()
    a, b = spark.read.parquet(plain), spark.read.parquet(salted)
    assert a.count() > 0
    assert rows_of(a) == rows_of(b)


def test_run_sql_leaves_no_views(spark, chunked_events, tmp_dir):
    cards, users = dims(spark)
    views = {"sql_v": event_fact_stream(spark, chunked_events), "sql_c": cards, "sql_u": users}
    sql = ("SELECT u.user_id, u.user_name, COUNT(*) AS counts FROM sql_v v JOIN sql_c c "
           "ON c.card_id = v.card_id JOIN sql_u u ON v.verified_by = u.user_id "
           "GROUP BY u.user_id, u.user_name")
    run_sql(spark, views, sql, f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
            trigger=BOUNDED).awaitTermination()
    names = {t.name for t in spark.catalog.listTables()}
    assert not names & set(views)


class _CrashAfterWrite:
    """A sink that writes batch 1 and then fails before the batch commits."""

    def __init__(self, out):
        from tristar.streaming import BatchDirSink
        self.inner = BatchDirSink(out)

    def __call__(self, batch, batch_id):
        self.inner(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("simulated loss after the write")


def test_replayed_batch_is_idempotent(spark, chunked_events, tmp_dir):
    from pyspark.errors import StreamingQueryException

    from tristar.streaming import BatchDirSink
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    cards, users = dims(spark)
    facts = event_fact_stream(spark, chunked_events, max_files=1)
    counts = enriched_counts(stream_enriched(facts, cards, users), by="id_and_name")
    q = (counts.writeStream.outputMode("update").foreachBatch(_CrashAfterWrite(out))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    # restart on the same checkpoint: batch 1 runs again and overwrites its own folder
    q = (counts.writeStream.outputMode("update").foreachBatch(BatchDirSink(out))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.recentProgress[0]["batchId"] == 1
    log = spark.read.parquet(out)
    assert log.groupBy("batch_id", "user_id").count().filter("count > 1").count() == 0
    want = verified_users(*event_star(spark, SF0001), by="id_and_name")
    assert rows_of(read_final_state(spark, out, ["user_id", "user_name"])) == rows_of(want)


def test_relay_dedup_counts_a_replayed_batch_once(spark, tmp_dir):
    """A plain (not file-sink) relay folder holding one batch twice, as an at-least-once
    relay can after a failure: with dedup the counts equal the distinct rows."""
    from tristar.streaming.jobs import RELAY_SCHEMA
    relay = f"{tmp_dir}/relay"
    t = dt.datetime(2024, 1, 1)
    rows = [(i, 1, "a", i % 3, f"u{i % 3}", t + dt.timedelta(seconds=i)) for i in range(30)]
    batch = spark.createDataFrame(rows, RELAY_SCHEMA)
    batch.coalesce(1).write.mode("append").parquet(relay)
    batch.coalesce(1).write.mode("append").parquet(relay)       # the replay
    counted = {}
    for dedup in (False, True):
        out = f"{tmp_dir}/out-{bool(dedup)}"
        run_relay(spark, relay, out, f"{tmp_dir}/ckpt-{bool(dedup)}", threshold=0,
                  trigger=BOUNDED, dedup=dedup).awaitTermination()
        counted[dedup] = sorted(tuple(r) for r in read_latest_snapshot(spark, out).collect())
    assert counted[True] == [("u0", 10), ("u1", 10), ("u2", 10)]
    assert counted[False] == [("u0", 20), ("u1", 20), ("u2", 20)]


def test_live_dimensions_from_keyed_records_update_and_tombstone(spark, tmp_dir):
    from tristar.sources import keyed_table, read_keyed
    from tristar.streaming import combine_counts
    from tristar.streaming.jobs import CARD_WIRE, USER_WIRE
    topics = {r: f"{tmp_dir}/{r}" for r in ("cards", "users")}
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    write_keyed(spark, topics["cards"], [("1", {"cardId": 1, "cardTitle": "a"}, t0)])
    write_keyed(spark, topics["users"], [
        ("7", {"userId": 7, "userName": "ann"}, t0), ("7", {"userId": 7, "userName": "bob"}, t1),
        ("8", {"userId": 8, "userName": "cy"}, t0), ("8", None, t1)])      # 8 deleted

    def load(s):
        return (keyed_table(read_keyed(s, topics["cards"]), CARD_WIRE,
                            {"cardId": "card_id", "cardTitle": "title"}),
                keyed_table(read_keyed(s, topics["users"]), USER_WIRE,
                            {"userId": "user_id", "userName": "user_name"}))

    schema = "id long, card_id long, verified_by long"
    spark.createDataFrame([(1, 1, 7), (2, 1, 7), (3, 1, 8), (4, 2, 7)], schema) \
        .write.parquet(f"{tmp_dir}/facts")
    facts = spark.readStream.schema(schema).parquet(f"{tmp_dir}/facts")
    run_live(facts, load, f"{tmp_dir}/relay", f"{tmp_dir}/ckpt", BOUNDED,
             by="id_and_name").awaitTermination()
    got = [tuple(r) for r in combine_counts(spark, f"{tmp_dir}/relay", "id_and_name")
           .select("user_id", "user_name", "counts").collect()]
    assert got == [(7, "bob", 2)]     # latest name; deleted user and unknown card dropped


def test_byte_bounded_micro_batches(spark, chunked_events, tmp_dir):
    from tristar.session import batch_bytes
    assert batch_bytes(spark) == spark.sparkContext.defaultParallelism * (256 << 20) * 4
    cards, users = dims(spark)
    facts = event_fact_stream(spark, chunked_events, max_bytes=1)      # one file per batch
    counts = enriched_counts(stream_enriched(facts, cards, users), by="id_and_name",
                             threshold=K)
    q = run_snapshot(counts, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", BOUNDED)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 4
    assert rows_of(read_latest_snapshot(spark, f"{tmp_dir}/out")) == rows_of(batch_twin(spark))


def test_nested_records_over_streams(spark, tmp_dir):
    from tristar.operators import flatten_nested, nested_records
    paths = publish_star(event_star(spark, SF0001), f"{tmp_dir}/topics")
    s = keyed_star_streams(spark, paths, max_files=1)
    nested = nested_records(s.cards.drop("card_ts"), s.verifications.drop("verification_ts"),
                            s.users.drop("user_ts"))
    q = (nested.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert [f.name for f in got.schema.fields] == ["verification", "card", "user"]
    want = flatten_nested(nested_records(*event_star(spark, SF0001)))
    assert rows_of(flatten_nested(got)) == rows_of(want)


def test_live_dimensions_refresh_every_n_batches(spark, tmp_dir):
    """With refresh_every=2 the dimension is read at batches 0 and 2: a user added after
    batch 0 is seen from batch 2 on, not at batch 1."""
    from tristar.streaming.jobs import LiveEnrich
    users_dir = f"{tmp_dir}/users"
    spark.createDataFrame([(8, "other")], "user_id long, user_name string").write.parquet(users_dir)
    cards = spark.createDataFrame([(1, "a")], "card_id long, title string")
    sink = LiveEnrich(lambda s: (cards, s.read.parquet(users_dir)), f"{tmp_dir}/relay",
                      refresh_every=2)
    batch = spark.createDataFrame([(1, 1, 7)], "id long, card_id long, verified_by long")
    sink(batch, 0)
    spark.createDataFrame([(7, "late")], "user_id long, user_name string") \
        .write.mode("append").parquet(users_dir)
    sink(batch, 1)
    sink(batch, 2)
    got = sorted(r.batch_id for r in spark.read.parquet(f"{tmp_dir}/relay").collect())
    assert got == [2]


def test_salted_bucketed_stream_static_join(spark, chunked_events, tmp_dir, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cards, users = dims(spark)
        facts = event_fact_stream(spark, chunked_events, max_files=1)
        counts = enriched_counts(stream_enriched(facts, cards, users, broadcast_rows=0, salt=4),
                                 by="id_and_name", threshold=K)
        q = run_snapshot(counts, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", BOUNDED)
        q.awaitTermination()
        capsys.readouterr()
        q.explain()
        plan = capsys.readouterr().out
        assert plan.count("Bucketed: true") == 2
        assert plan.count("Exchange hashpartitioning") == 3    # batch twice, aggregate once
        assert rows_of(read_latest_snapshot(spark, f"{tmp_dir}/out")) == \
            rows_of(batch_twin(spark))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_streaming_counts_by_id_and_by_name(spark, chunked_events, tmp_dir):
    cards, users = dims(spark)
    for by in ("id", "name"):
        facts = event_fact_stream(spark, chunked_events, max_files=1)
        counts = enriched_counts(stream_enriched(facts, cards, users), by=by, threshold=K)
        out = f"{tmp_dir}/{by}"
        run_updates(counts, out, f"{out}-ckpt", BOUNDED).awaitTermination()
        key = ["user_id"] if by == "id" else ["user_name"]
        want = verified_users(*event_star(spark, SF0001), by=by, threshold=K)
        assert rows_of(read_final_state(spark, out, key)) == rows_of(want), by


def test_state_partitions_apply_to_the_query_only(spark, chunked_events, tmp_dir):
    import os
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = run_updates(counts_stream(spark, chunked_events), f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
                    BOUNDED, partitions=3)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert sorted(d for d in os.listdir(f"{tmp_dir}/ckpt/state/0") if d.isdigit()) == \
        ["0", "1", "2"]
    assert rows_of(read_final_state(spark, f"{tmp_dir}/out", ["user_id", "user_name"])) == \
        rows_of(batch_twin(spark))
