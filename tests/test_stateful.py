"""Streaming sinks over keyed stores: state across batches and replays, bounded size on disk,
late dimensions, hot users. Sinks are called batch by batch; the registry tests run them as
streaming jobs with restarts."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tristar.streaming.stateful import (
    PendingJoin, RelayCounts, RetractLog, RunningChangelog, SeenIds, read_joined,
)
from tristar.streaming.store import KeyedStore

CARDS = [(c, f"card {c}") for c in range(5)]
USERS = [(u, f"user {u}") for u in range(6)]


@pytest.fixture(scope="module")
def dims(spark):
    return (spark.createDataFrame(CARDS, "card_id long, title string"),
            spark.createDataFrame(USERS, "user_id long, user_name string"))


def facts(spark, rows):
    """Rows (id, card_id, verified_by)."""
    return spark.createDataFrame(rows, "id long, card_id long, verified_by long").withColumn(
        "verification_ts", F.lit(None).cast("timestamp"))


def on_disk(path):
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]
    return sum(map(os.path.getsize, files)), len(files)


# ---- the store ----

def test_store_is_a_versioned_table(spark, tmp_dir):
    store = KeyedStore(f"{tmp_dir}/s", ["k", "l"], "k long, l string, v long", compact_every=3)
    model, rng = {}, random.Random(3)
    assert store.read(spark).count() == 0 and store.latest_version(spark) is None
    for n in range(14):
        some = {(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "a"])): rng.randint(0, 99)
                for _ in range(4)}
        gone = {k: rng.random() < 0.3 for k in some}
        before = dict(model)
        for _ in range(2):                              # the second call replays the batch
            store.upsert(spark.createDataFrame(
                [(*k, v, gone[k]) for k, v in some.items()],
                "k long, l string, v long, __gone boolean"), n)
            assert {(r.k, r.l): r.v for r in store.read(spark, n - 1).collect()} == before
        model.update(some)
        model = {k: v for k, v in model.items() if not gone.get(k)}
        rows = store.read(spark).collect()
        assert {(r.k, r.l): r.v for r in rows} == model and len(rows) == len(model)
        assert store.delta(spark, n).count() == len(some)
    assert store.latest_version(spark) == 13


def test_store_keeps_its_size_over_50_batches(spark, tmp_dir):
    store, sizes = KeyedStore(f"{tmp_dir}/s", "k", "k long, v long", compact_every=2), []
    for n in range(50):
        store.upsert(spark.range(20).select(F.col("id").alias("k"), F.lit(n).alias("v"))
                     .coalesce(1), n)
        sizes.append(on_disk(store.root))
    assert rows_of(store.read(spark)) == [(k, 49) for k in range(20)]
    assert max(s[1] for s in sizes[40:]) <= max(s[1] for s in sizes[4:10])
    assert max(s[0] for s in sizes[40:]) <= 1.2 * max(s[0] for s in sizes[4:10])
    with pytest.raises(ValueError):
        KeyedStore(tmp_dir, "x", "k long")


# ---- per-record changelog ----

def brute_changelog(batches, k, retract):
    n, out = Counter(), []
    for batch in batches:
        for i, card, user in sorted(batch):
            if card < len(CARDS) and user < len(USERS):
                n[user] += 1
                out.append((i, user, True, n[user]))
                out.append((i, user, False, n[user] - 1))
    out = [m for m in out if m[3] > k]
    return sorted((m if retract else (m[0], m[1], m[3]) for m in out if retract or m[2]))


@pytest.mark.parametrize("retract", [False, True])
def test_counts_go_on_across_batches_and_replays_with_a_hot_user(spark, dims, tmp_dir, retract):
    rng = random.Random(8)
    ids = iter(range(10_000))
    batches = [[(next(ids), rng.randint(0, 5), rng.choice([1, 1, 1, 0, 2, 7]))
                for _ in range(rng.choice([0, 1, 60]))] for _ in range(6)]
    sink = RunningChangelog(*dims, f"{tmp_dir}/out", f"{tmp_dir}/state", 3, retract, block=4,
                            compact_every=2)
    for n, batch in enumerate(batches):
        for _ in range(1 + n % 2):                      # every other batch is replayed
            sink(facts(spark, batch), n)
        sink = RunningChangelog(*dims, f"{tmp_dir}/out", f"{tmp_dir}/state", 3, retract, block=4,
                                compact_every=2)        # a restart knows only the folders
    cols = ["event_id", "user_id", *(["is_add"] if retract else []), "counts"]
    got = sorted(tuple(r[c] for c in cols) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == brute_changelog(batches, 3, retract) and got


# ---- micro-batch changelog ----

def test_retract_log_names_changed_users_only(spark, dims, tmp_dir):
    batches = [[(i, 0, u) for i, u in enumerate(b)] for b in
               ([0, 0, 1], [0, 2, 2], [], [1, 1, 2, 9], [0])]
    sink, total = RetractLog(*dims, f"{tmp_dir}/out", f"{tmp_dir}/state", 1, compact_every=2), Counter()
    for n, batch in enumerate(batches):
        sink(facts(spark, batch), n)
        sink(facts(spark, batch), n)
        old = Counter(total)
        total.update(u for _, _, u in batch if u < len(USERS))
        want = [(u, c, add) for u in {u for _, _, u in batch if u < len(USERS)}
                for c, add in ((old[u], False), (total[u], True)) if c > 1]
        log = spark.read.parquet(f"{tmp_dir}/out/batch_id={n}").collect()
        assert sorted((r.user_id, r.counts, r.is_add) for r in log) == sorted(want)
        assert all(r.user_name == f"user {r.user_id}" for r in log)
    assert sorted((r.user_id, r.counts) for r in sink.result(spark).collect()) == sorted(
        (u, c) for u, c in total.items() if c > 1)


# ---- pending join ----

def tagged(spark, cards=(), rows=(), users=()):
    schema = ("__role string, card_id long, title string, id long, verified_by long, "
              "verification_ts timestamp, user_id long, user_name string")
    return spark.createDataFrame(
        [("card", c, t, None, None, None, None, None) for c, t in cards]
        + [("fact", c, None, i, u, None, None, None) for i, c, u in rows]
        + [("user", None, None, None, None, None, u, n) for u, n in users], schema)


def test_facts_wait_only_while_a_dimension_row_is_missing(spark, tmp_dir):
    sink = PendingJoin(f"{tmp_dir}/out", f"{tmp_dir}/state", compact_every=2)
    steps = [dict(cards=CARDS[:2], rows=[(i, i % 5, i % 7) for i in range(70)]),
             dict(users=USERS[:3]), dict(cards=CARDS[2:], rows=[(70, 0, 0), (70, 0, 0)]),
             dict(users=USERS[3:]), dict(rows=[(71, 4, 5), (72, None, 1), (73, 9, 9)])]
    cards, users, seen = set(), set(), []
    for n, step in enumerate(steps):
        for _ in range(2):
            sink(tagged(spark, **step), n)
        cards |= {c for c, _ in step.get("cards", ())}
        users |= {u for u, _ in step.get("users", ())}
        seen += step.get("rows", [])
        met = sorted(i for i, c, u in seen if c in cards and u in users)
        out = read_joined(spark, f"{tmp_dir}/out").collect()
        assert sorted(r.verification_id for r in out) == met
        assert all(r.card_title == f"card {r.card_id}" and r.user_name == f"user {r.user_id}"
                   for r in out)
        assert sink.pending(spark, n).count() == len(seen) - len(met)
    kept = [n for n in range(len(steps)) if os.path.isdir(f"{tmp_dir}/out/batch_id={n}/done=false")]
    assert kept == [3, 4]                               # the last, and the one before for a replay


def test_pending_join_refuses_a_key_that_comes_twice(spark, tmp_dir):
    sink = PendingJoin(f"{tmp_dir}/out", f"{tmp_dir}/state")
    with pytest.raises(ValueError, match="not unique"):
        sink(tagged(spark, cards=[(1, "a"), (1, "b")]), 0)
    sink(tagged(spark, cards=[(1, "a")]), 0)
    with pytest.raises(ValueError, match="card_id 1"):
        sink(tagged(spark, cards=[(1, "b")]), 1)


# ---- bitmap id set ----

def test_seen_ids_equal_a_set(spark, tmp_dir):
    rng, seen = random.Random(4), set()
    ids = SeenIds(f"{tmp_dir}/ids", compact_every=2)
    pool = [None, 0, 1, 32767, 32768, 32769, 65536, -1, -32768, 1 << 40, *range(100, 160)]
    for n in range(6):
        batch = [rng.choice(pool) for _ in range(25)]
        rows = spark.createDataFrame([(i, "x") for i in batch], "id long, bits string").drop("bits")
        for _ in range(2):
            fresh = [r.id for r in ids.fresh(rows, "id", n).collect()]
            assert len(fresh) == len(set(fresh)) and set(fresh) == set(batch) - seen
            ids.add(rows, "id", n)
        seen |= set(batch)


def test_a_dense_id_costs_about_a_bit(spark, tmp_dir):
    ids = SeenIds(f"{tmp_dir}/ids")
    n = 2_000_000
    rows = spark.range(1, n + 1)
    ids.add(rows.filter("id % 2 = 0"), "id", 0)
    assert ids.fresh(rows, "id", 1).count() == n // 2
    ids.add(rows, "id", 1)
    assert ids.fresh(rows, "id", 2).count() == 0
    assert on_disk(f"{tmp_dir}/ids")[0] < n             # two versions: under a byte an id


def test_relay_counts_each_id_once(spark, tmp_dir):
    sink = RelayCounts(f"{tmp_dir}/out", f"{tmp_dir}/state", 1, compact_every=2)
    batches = [[(1, "a"), (2, "a"), (2, "a"), (3, None)], [(2, "a"), (4, None)], [(1, "a"), (5, "b")]]
    for n, batch in enumerate(batches):
        for _ in range(2):
            sink(spark.createDataFrame(batch, "verification_id long, user_name string"), n)
    assert sorted(map(tuple, sink.result(spark).collect()), key=str) == [("a", 2), (None, 2)]
