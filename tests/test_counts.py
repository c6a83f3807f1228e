"""Joins and counts: hand-written cases for each semantic trap, and the eager-aggregation
plan checked against the direct count over the full three-way join."""

import random

from pyspark.sql import functions as F

from tests.conftest import rows_of
from tristar.operators import (
    enrich, enriched_counts, grouped_counts, qualifying_total, value_counts, verified_users,
)

CARD = "card_id long, title string"
VER = "card_id long, verification_date timestamp_ntz, verified_by long"
USER = "user_id long, user_name string"


def star(spark, cards, vers, users):
    return (spark.createDataFrame(cards, CARD), spark.createDataFrame(vers, VER),
            spark.createDataFrame(users, USER))


def v(card, user):
    return (card, None, user)


def test_threshold_is_strict(spark):
    cards = [(1, "a")]
    vers = [v(1, 1)] * 3 + [v(1, 2)] * 4
    users = [(1, "ann"), (2, "bob")]
    res = verified_users(*star(spark, cards, vers, users), by="id", threshold=3)
    assert rows_of(res) == [(4, 2, "bob")]


def test_name_collision_by_name_merges_by_id_does_not(spark):
    cards = [(1, "a")]
    vers = [v(1, 1)] * 3 + [v(1, 2)] * 3
    users = [(1, "ann"), (2, "ann")]
    s = star(spark, cards, vers, users)
    assert rows_of(verified_users(*s, by="name", threshold=4)) == [(6, "ann")]
    assert rows_of(verified_users(*s, by="id", threshold=4)) == []
    assert rows_of(verified_users(*s, by="id_and_name", threshold=4)) == []


def test_dangling_user_and_card_are_dropped(spark):
    cards = [(1, "a"), (2, "b"), (3, "c")]
    vers = [v(1, 0), v(99, 1), v(2, 1)]
    users = [(1, "ann"), (2, "bob"), (3, "cy")]
    s = star(spark, cards, vers, users)
    assert enrich(*s).count() == 1
    assert rows_of(verified_users(*s, by="id")) == [(1, 1, "ann")]


def test_same_card_twice_counts_twice(spark):
    s = star(spark, [(1, "a")], [v(1, 1), v(1, 1)], [(1, "ann")])
    assert rows_of(verified_users(*s, by="id")) == [(2, 1, "ann")]


def test_null_name_value_counts_drops_grouped_count_keeps(spark):
    s = star(spark, [(1, "a")], [v(1, 4)] * 3 + [v(1, 1)], [(4, None), (1, "ann")])
    assert rows_of(value_counts(*s)) == [(1, "ann")]
    assert rows_of(verified_users(*s, by="name")) == [(1, "ann"), (3, None)]


def test_value_counts_sorted_descending(spark):
    vers = [v(1, 1)] + [v(1, 2)] * 3 + [v(1, 3)] * 2
    s = star(spark, [(1, "a")], vers, [(1, "x"), (2, "y"), (3, "z")])
    assert [tuple(r) for r in value_counts(*s).collect()] == [("y", 3), ("z", 2), ("x", 1)]


def test_qualifying_total(spark):
    vers = [v(1, 1)] * 5 + [v(1, 2)] * 2
    s = star(spark, [(1, "a")], vers, [(1, "x"), (2, "y")])
    assert qualifying_total(verified_users(*s, by="id", threshold=2)).first()[0] == 1


def test_enrich_columns_follow_the_ctas(spark):
    s = star(spark, [(1, "a")], [v(1, 1)], [(1, "x")])
    assert enrich(*s).columns == ["card_id", "title", "verification_date", "verified_by",
                                  "user_id", "user_name"]


def random_star(spark, seed):
    rnd = random.Random(seed)
    # duplicate dimension keys, null names, dangling keys on both sides, null fact keys
    cards = [(rnd.randint(0, 30), rnd.choice(["t1", "t2", "t3", None])) for _ in range(40)]
    users = [(rnd.randint(0, 12), rnd.choice(["ann", "bob", "cy", None])) for _ in range(15)]
    vers = [(rnd.choice([None] + list(range(35))), None, rnd.choice([None] + list(range(15))))
            for _ in range(400)]
    return star(spark, cards, vers, users)


def test_eager_aggregation_equals_direct_count(spark):
    for seed in range(3):
        s = random_star(spark, seed)
        e = enrich(*s)
        for by in ("id", "name", "id_and_name"):
            for k in (None, 5):
                assert rows_of(verified_users(*s, by=by, threshold=k)) == \
                    rows_of(enriched_counts(e, by=by, threshold=k)), (seed, by, k)
        direct = e.groupBy("title").agg(F.count(F.lit(1)).alias("counts"))
        assert rows_of(grouped_counts(*s, group=["title"])) == rows_of(direct)


def test_sql_form_equals_dataframe_form(spark):
    s = random_star(spark, 7)
    for name, df in zip(("cards", "verifications", "users"), s):
        df.createOrReplaceTempView(name)
    sql = spark.sql(
        "SELECT u.user_id, MIN(u.user_name) AS user_name, COUNT(*) AS counts FROM cards c "
        "JOIN verifications v ON c.card_id = v.card_id JOIN users u ON v.verified_by = u.user_id "
        "GROUP BY u.user_id HAVING COUNT(*) > 3")
    df = verified_users(*s, by="id", threshold=3)
    assert df.exceptAll(sql).count() == 0 and sql.exceptAll(df).count() == 0


def test_role_check_at_job_start(spark):
    import pytest
    cards = spark.createDataFrame([("1", "a")], "card_id string, title string")
    vers = spark.createDataFrame([(1, 1)], "card_id long, verified_by long")
    users = spark.createDataFrame([(1, "x")], "user_id long, user_name string")
    with pytest.raises(TypeError, match="cards.card_id is string"):
        verified_users(cards, vers, users)
    with pytest.raises(TypeError, match="verifications lacks column verified_by"):
        enrich(spark.createDataFrame([(1, "a")], CARD), vers.drop("verified_by"), users)


def test_salted_join_equals_enrich(spark):
    from tristar.operators import prepare_dimension, salted_stream_join
    c, v, u = random_star(spark, 11)
    sc = prepare_dimension(c, "card_id", max_broadcast_rows=0, name="c", salt=3)
    su = prepare_dimension(u, "user_id", max_broadcast_rows=None, name="u", salt=3)
    bu = prepare_dimension(u, "user_id", max_broadcast_rows=10_000, name="u")   # broadcast
    want = rows_of(enrich(c, v, u))
    assert rows_of(salted_stream_join(v, sc, su, 3)) == want
    assert rows_of(salted_stream_join(v, sc, bu, 3)) == want
    assert salted_stream_join(v, sc, su, 3).columns == enrich(c, v, u).columns
