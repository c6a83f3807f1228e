"""Property tests (hypothesis): the eager-aggregation counts equal the direct count over
the full join, and the block-decomposed replay equals ``row_number``, for arbitrary small
inputs with duplicate keys, nulls and hot keys."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tristar.operators import enrich, enriched_counts, running_counts, verified_users

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(0, 6))
names = st.one_of(st.none(), st.sampled_from(["ann", "bob", "cy"]))


@SETTINGS
@given(cards=st.lists(st.tuples(keys, names), max_size=10),
       users=st.lists(st.tuples(keys, names), max_size=10),
       facts=st.lists(st.tuples(keys, keys), max_size=60),
       by=st.sampled_from(["id", "name", "id_and_name"]),
       k=st.one_of(st.none(), st.integers(0, 4)))
def test_eager_counts_equal_join_counts(spark, cards, users, facts, by, k):
    c = spark.createDataFrame(cards, "card_id long, title string")
    u = spark.createDataFrame(users, "user_id long, user_name string")
    v = spark.createDataFrame([(a, None, b) for a, b in facts],
                              "card_id long, verification_date timestamp_ntz, verified_by long")
    want = rows_of(enriched_counts(enrich(c, v, u), by=by, threshold=k))
    assert rows_of(verified_users(c, v, u, by=by, threshold=k)) == want
    assert rows_of(verified_users(c, v, u, by=by, threshold=k, pre_aggregate=True)) == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 40), st.sampled_from([0, 0, 0, 1, 2])),
                     min_size=1, max_size=120),
       block=st.integers(1, 9), min_count=st.integers(1, 6))
def test_block_replay_equals_row_number(spark, rows, block, min_count):
    df = spark.createDataFrame(rows, "event_id long, user_id long")
    w = Window.partitionBy("user_id").orderBy("event_id")
    ref = (df.withColumn("counts", F.row_number().over(w).cast("bigint"))
             .filter(F.col("counts") >= min_count))
    got = running_counts(df, "user_id", "event_id", min_count=min_count, block=block)
    assert rows_of(got) == rows_of(ref)


snapshots = st.lists(st.dictionaries(st.integers(0, 5), st.integers(1, 9), max_size=5),
                     min_size=1, max_size=4)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seq=snapshots)
def test_retract_sink_diffs_and_nets_to_last_snapshot(spark, tmp_path_factory, seq):
    from tristar.streaming import RetractSink, net_changelog, read_changelog
    base = str(tmp_path_factory.mktemp("retract"))
    sink = RetractSink(f"{base}/snap", f"{base}/log", ["user_id"])
    schema = "user_id long, counts long"
    for i, snap in enumerate(seq):
        sink(spark.createDataFrame(sorted(snap.items()), schema), i)
    log = read_changelog(spark, f"{base}/log")
    prev: dict[int, int] = {}
    for i, snap in enumerate(seq):
        want = sorted([(k, False, v) for k, v in prev.items() if snap.get(k) != v]
                      + [(k, True, v) for k, v in snap.items() if prev.get(k) != v])
        got = sorted((r.user_id, r.is_add, r.counts)
                     for r in log.filter(F.col("batch_id") == i).collect())
        assert got == want, i
        prev = snap
    net = sorted(tuple(r) for r in net_changelog(log.drop("batch_id"), ["user_id"])
                 .select("user_id", "counts").collect())
    assert net == sorted(seq[-1].items())


record = st.one_of(st.none(), st.just("corrupt"), st.sampled_from(["ann", "bob", "cy"]))


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(log=st.lists(st.tuples(st.integers(0, 4), record), min_size=1, max_size=25))
def test_keyed_table_equals_log_replay(spark, tmp_path_factory, log):
    """Latest parsed record per key wins; a tombstone deletes; corrupt text is skipped."""
    import datetime as dt
    import json

    from tristar.sources import keyed_table, read_keyed
    from tristar.streaming.jobs import USER_WIRE
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i, (k, v) in enumerate(log):               # distinct, increasing record times
        text = None if v is None else "{oops" if v == "corrupt" else \
            json.dumps({"userId": k, "userName": v})
        rows.append((str(k), text, t0 + dt.timedelta(seconds=i)))
    path = str(tmp_path_factory.mktemp("log") / "users")
    spark.createDataFrame(rows, "key string, value string, timestamp timestamp") \
        .write.parquet(path)
    state: dict[int, str] = {}
    for k, v in log:
        if v is None:
            state.pop(k, None)
        elif v != "corrupt":
            state[k] = v
    got = sorted(tuple(r) for r in keyed_table(read_keyed(spark, path), USER_WIRE,
                                                {"userId": "user_id", "userName": "user_name"})
                 .collect())
    assert got == sorted(state.items())
