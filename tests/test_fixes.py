"""Regression tests for review findings: table layouts, timeouts, changelog rows that carry
columns, empty snapshots, corrupt dimension records, size bounds and salt spread."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF0001, rows_of
from tristar.operators import verified_users
from tristar.sources import event_star, read_table


def test_folder_form_events_table(spark, tmp_path):
    """A table stored as a folder of part files (the form at scale) streams too."""
    sf = str(tmp_path / "sf")
    for t in ("part", "customer"):
        read_table(spark, SF0001, t).write.parquet(f"{sf}/{t}.parquet")
    read_table(spark, SF0001, "events").repartition(3).write.parquet(f"{sf}/events.parquet")
    want = rows_of(verified_users(*event_star(spark, sf), by="id_and_name", threshold=66))
    for name in ("stream_update_counts", "stream_snapshot_counts", "live_dimension_counts"):
        assert rows_of(E.queries()[name](spark, sf)) == want, name


def test_await_any_timeout_is_seconds(spark, tmp_path):
    import time

    from tristar.streaming import await_any, stop_all
    spark.streams.resetTerminated()
    q = (spark.readStream.format("rate").option("rowsPerSecond", 1).load()
         .writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start())
    try:
        t = time.time()
        assert await_any(spark, 2) is False
        assert time.time() - t < 30
    finally:
        stop_all([q])


def test_retract_rows_carry_their_own_columns(spark, tmp_path):
    from tristar.streaming import RetractSink, read_changelog
    sink = RetractSink(str(tmp_path / "snap"), str(tmp_path / "log"), ["user_id"])
    schema = "user_id long, user_name string, counts long"
    sink(spark.createDataFrame([(1, "ann", 5)], schema), 0)
    sink(spark.createDataFrame([(1, "bob", 6)], schema), 1)
    got = sorted((r.batch_id, r.is_add, r.user_name, r.counts)
                 for r in read_changelog(spark, str(tmp_path / "log")).collect())
    assert got == [(0, True, "ann", 5), (1, False, "ann", 5), (1, True, "bob", 6)]


def test_latest_snapshot_may_be_empty(spark, tmp_path):
    from tristar.streaming import BatchDirSink, read_latest_snapshot
    out = str(tmp_path / "out")
    sink = BatchDirSink(out)
    sink(spark.createDataFrame([(1, 5)], "user_id long, counts long"), 0)
    sink(spark.createDataFrame([], "user_id long, counts long"), 1)
    assert read_latest_snapshot(spark, out).count() == 0


def test_corrupt_latest_dimension_record_is_skipped(spark, tmp_path):
    from tristar.sources import keyed_table, read_keyed
    from tristar.streaming.jobs import CARD_WIRE
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [("5", json.dumps({"cardId": 5, "cardTitle": "a"}), t0), ("5", "{bad", t1)]
    path = str(tmp_path / "cards")
    spark.createDataFrame(rows, "key string, value string, timestamp timestamp") \
        .write.parquet(path)
    got = [tuple(r) for r in keyed_table(read_keyed(spark, path), CARD_WIRE,
                                          {"cardId": "card_id", "cardTitle": "title"}).collect()]
    assert got == [(5, "a")]


def test_pile_of_copies_counts_consecutively(spark):
    from tristar.operators import running_counts
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "event_id long, user_id long")
    got = sorted(tuple(r) for r in running_counts(df, "user_id", "event_id", block=1)
                 .select("event_id", "counts").collect())
    assert got == [(1, 1), (1, 2), (2, 3)]


def test_broadcast_bound_counts_bytes(spark):
    from tristar.operators.enrich import fits_rows
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("blob"))
    assert fits_rows(wide, max_rows=1000, max_bytes=10 << 20)
    assert not fits_rows(wide, max_rows=1000, max_bytes=100_000)      # 1 MB of strings


def test_salt_spreads_identical_copies(spark):
    from tristar.operators.enrich import salt_column
    copies = spark.createDataFrame([(7, 3)] * 2000, "card_id long, verified_by long")
    salts = {r[0] for r in copies.select(salt_column(8)).distinct().collect()}
    assert salts == set(range(8))
