"""Counted losses, counts read from a checkpoint, start positions, limits and typed views."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF0001, rows_of
from tristar.functions.records import cast_keyed
from tristar.operators import enriched_counts
from tristar.sources.keyed import keyed_source, keyed_table, publish_log, read_keyed
from tristar.sources.roles import CARD_SCHEMA
from tristar.streaming.jobs import BOUNDED, read_state_counts, run_sql, run_updates
from tristar.streaming.losses import LossListener, decode_counted, join_counted, observed_totals
from tristar.streaming.sinks import BatchDirSink
from tristar.streaming.stateful import run_sink

WIRE = T.StructType([T.StructField("card_id", T.LongType()), T.StructField("verified_by", T.LongType())])
VALUES = ['{"card_id": 1, "verified_by": 1}', '{"card_id": 1, "verified_by": 9}', None, "{bad", "",
          '{"card_id": 8, "verified_by": 1}', '{"card_id": 8}', '{"other": 1}', "[]"]


def test_losses_are_counted_per_query(spark, tmp_dir):
    cards = spark.createDataFrame([(1, "a")], "card_id long, title string")
    users = spark.createDataFrame([(1, "u")], "user_id long, user_name string")
    listener = LossListener()
    spark.streams.addListener(listener)
    try:
        for part in (VALUES, VALUES[:4]):
            spark.createDataFrame([("k", v) for v in part], "key string, value string").withColumn(
                "timestamp", F.current_timestamp()).write.mode("append").parquet(f"{tmp_dir}/topic")
            facts = decode_counted(keyed_source(spark, "files", f"{tmp_dir}/topic"), WIRE)
            query = run_sink(join_counted(cards, facts, users), BatchDirSink(f"{tmp_dir}/out"),
                             f"{tmp_dir}/ckpt", BOUNDED)
            query.awaitTermination()
            want = {"records": len(part), "tombstones": 1, "undecodable": len(part) - 3 - 2 * (
                len(part) > 4), "facts": 4 if len(part) > 4 else 2,
                "no_card": 2 if len(part) > 4 else 0, "no_user": 1}
            assert observed_totals(query) == want
        for _ in range(100):                         # listeners hear of progress a little later
            totals = dict(listener.totals.get(str(query.id), {}))
            if totals.get("records") == len(VALUES) + 4:
                break
            time.sleep(0.1)
        assert totals["records"] == len(VALUES) + 4 and totals["tombstones"] == 2
    finally:
        spark.streams.removeListener(listener)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2


def test_state_holds_all_counts_after_a_restart(spark, tmp_dir):
    cards = spark.createDataFrame([(1, "a")], "card_id long, title string")
    users = spark.createDataFrame([(1, "u"), (2, "v"), (3, None)], "user_id long, user_name string")
    for part in ([1, 1, 2], [1, 3, 4]):
        spark.createDataFrame([(1, u) for u in part], "card_id long, verified_by long").write.mode(
            "append").parquet(f"{tmp_dir}/facts")
        facts = spark.readStream.schema(WIRE).parquet(f"{tmp_dir}/facts")
        counts = enriched_counts(facts.join(cards, "card_id").join(
            users, F.col("verified_by") == F.col("user_id")), by="id_and_name", threshold=1)
        run_updates(counts, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", BOUNDED,
                    partitions=2).awaitTermination()
    state = read_state_counts(spark, f"{tmp_dir}/ckpt")
    assert sorted(map(tuple, state.select("user_id", "user_name", "counts").collect())) == [
        (1, "u", 3), (2, "v", 1), (3, None, 1)]


def test_log_order_decides_between_equal_times(spark, tmp_dir):
    wire = T.StructType([T.StructField("v", T.LongType())])
    log = spark.createDataFrame(
        [("a", '{"v": 9}', 1, 5), ("a", '{"v": 1}', 1, 7), ("b", '{"v": 2}', 1, 1), ("b", None, 1, 2),
         ("c", None, 1, 1), ("c", '{"v": 3}', 1, 2), ("d", '{"v": 4}', 2, 1), ("d", "{bad", 3, 2)],
        "key string, value string, at long, offset long").withColumn(
        "timestamp", F.timestamp_seconds("at"))
    publish_log(log, f"{tmp_dir}/log", partitions=3)
    got = keyed_table(read_keyed(spark, f"{tmp_dir}/log", log=True), wire)
    assert rows_of(got) == [(1,), (3,), (4,)]
    late = keyed_source(spark, "files", f"{tmp_dir}/log", stream=False,
                        starting="1970-01-01T00:00:02+00:00")
    assert {r.key for r in late.collect()} == {"d"} and late.columns == ["key", "value", "timestamp"]
    assert cast_keyed(read_keyed(spark, f"{tmp_dir}/log", log=True)).columns == [
        "key", "value", "timestamp", "partition", "offset"]


class Stub:
    """Records the options a Kafka reader is given."""

    def __init__(self, rows):
        self.rows, self.options = rows, {}

    def format(self, name):
        assert name == "kafka"
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.rows


@pytest.mark.parametrize("starting,option", [
    ("latest", ("startingOffsets", "latest")), ('{"t": {"0": 5}}', ("startingOffsets", '{"t": {"0": 5}}')),
    ("1970-01-01T00:00:05", ("startingTimestamp", "5000")),
    ("1970-01-01T01:00:05+01:00", ("startingTimestamp", "5000"))])
def test_kafka_options_arrive(spark, starting, option):
    rows = spark.createDataFrame([(b"k", b"v", 3, 8)], "key binary, value binary, partition int, "
                                 "offset long").withColumn("timestamp", F.current_timestamp())
    session = type("Session", (), {"readStream": Stub(rows), "read": Stub(rows)})()
    got = keyed_source(session, "kafka", "t", starting=starting, max_records=70, log=True)
    assert session.readStream.options["maxOffsetsPerTrigger"] == "70"
    assert session.readStream.options[option[0]] == option[1]
    assert tuple(got.drop("timestamp").first()) == ("k", "v", 3, 8)


def test_what_a_source_cannot_honour_is_refused(spark, tmp_dir):
    for bad in ({"starting": "latest"}, {"starting": '{"t": {"0": 5}}'}, {"max_records": 5},
                {"starting": "soon"}):
        with pytest.raises(ValueError):
            keyed_source(spark, "files", tmp_dir, **bad)
    for bad in ({"max_files": 1}, {"max_bytes": 1}):
        with pytest.raises(ValueError):
            keyed_source(spark, "kafka", "t", **bad)


def test_a_view_of_another_type_stops_the_job(spark, tmp_dir):
    part = spark.read.parquet(f"{SF0001}/part.parquet")
    wrong = part.select(F.col("p_partkey").cast("int").alias("card_id"), F.col("p_name").alias("title"))
    with pytest.raises(TypeError, match="view cards: .*card_id: int != bigint"):
        run_sql(spark, {"cards": wrong}, "SELECT * FROM cards", f"{tmp_dir}/o", f"{tmp_dir}/c",
                schemas={"cards": CARD_SCHEMA})
