"""Stored tables: equal rows, no shuffle of the facts on cards, statistics, replacement, hot cards."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001, SF001, oracle, rows_of, sql_rows
from tristar.operators.enrich import SALT, enrich
from tristar.operators.stored import create_table_as, enrich_stored, store_star
from tristar.plans.inspect import count_nodes, plan_text
from tristar.plans.registry import ORACLE_SQL, QUERIES
from tristar.sources import batch_star


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                               "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def star(spark):
    n = F.col("id")
    facts = spark.range(6000).select(
        n.alias("id"), F.when(n % 3 == 0, 7).when(n % 11 != 0, n % 420).cast("long").alias("card_id"),
        F.when(n % 101 != 0, n % 500).cast("long").alias("verified_by"))
    return (spark.range(400).select(n.alias("card_id"), F.concat(F.lit("c"), n).alias("title")), facts,
            spark.range(450).select(n.alias("user_id"), F.concat(F.lit("u"), n).alias("user_name")))


@pytest.mark.parametrize("salt", [1, 4])
def test_rows_equal_and_facts_are_not_shuffled_on_cards(spark, no_broadcast, salt):
    stored = store_star(*star(spark), name="st", buckets=6, salt=salt, share=0.1)
    got, want = enrich_stored(spark, stored), enrich(*star(spark))
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    # What is exchanged: the joined rows and the users, both on the user.
    assert count_nodes(plan_text(enrich_stored(spark, stored)), "Exchange hashpartitioning") == 2
    copies = spark.table(stored.cards).filter("card_id = 7").count()
    spread = spark.table(stored.verifications).filter("card_id = 7").select(SALT).distinct().count()
    assert copies == spread == salt
    assert spark.table(stored.cards).count() == 400 + salt - 1


def test_statistics_and_replacement(spark):
    create_table_as(spark.range(3), "tristar_st_replace")
    old = spark.table("tristar_st_replace")
    new = create_table_as(spark.range(50).select((F.col("id") % 7).alias("k")), "tristar_st_replace",
                          columns=["k"])
    assert new.columns == ["k"] and new.count() == 50 and old.count() == 3
    spark.conf.set("spark.sql.cbo.planStats.enabled", "true")
    try:
        assert "rowCount=50" in plan_text(spark.table("tristar_st_replace"), "cost")
    finally:
        spark.conf.unset("spark.sql.cbo.planStats.enabled")
    k = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED tristar_st_replace k").collect()}
    assert k["distinct_count"] == "7" and k["max"] == "6"


def test_join_order_by_cost(spark, no_broadcast):
    stored = store_star(*star(spark), name="st", buckets=4)
    for k in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled"):
        spark.conf.set(k, "true")
    try:
        assert rows_of(enrich_stored(spark, stored)) == rows_of(enrich(*star(spark)))
    finally:
        for k in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled"):
            spark.conf.unset(k)


def test_repeated_keys_and_empty_tables(spark):
    cards, facts, users = star(spark)
    with pytest.raises(ValueError, match="card_id"):
        store_star(cards.union(cards.limit(1)), facts, users)
    empty = store_star(cards.limit(0), facts.limit(0), users.limit(0))
    assert enrich_stored(spark, empty).count() == 0


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_oracle(spark, sf):
    cols, want = sql_rows(oracle(sf), ORACLE_SQL["stored_enriched"])
    assert rows_of(QUERIES["stored_enriched"](spark, sf), cols) == want
    assert rows_of(enrich_stored(spark, store_star(*batch_star(spark, sf))), cols) == want
