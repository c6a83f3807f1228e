"""Salting by measured hot keys: the same rows, copies of hot dimension rows only, spread facts."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tristar.operators.enrich import (
    SALT, enrich, hot_keys, prepare_dimension, salt_column, salted_stream_join,
)
from tristar.streaming.jobs import BOUNDED, stream_enriched


@pytest.fixture(scope="module")
def star(spark):
    n = F.col("id")
    facts = spark.range(6000).select(
        n.alias("id"), F.when(n % 3 == 0, 7).otherwise(n % 400).cast("long").alias("card_id"),
        F.when(n % 2 == 0, 3).when(n % 101 != 0, n % 500).cast("long").alias("verified_by"))
    return (spark.range(400).select(n.alias("card_id"), F.concat(F.lit("c"), n).alias("title")), facts,
            spark.range(500).select(n.alias("user_id"), F.concat(F.lit("u"), n).alias("user_name")))


def test_hot_keys_are_those_over_the_share(star):
    _, facts, _ = star
    assert hot_keys(facts, "card_id", 0.1) == [7]
    assert hot_keys(facts, "verified_by", 0.1) == [3]
    assert hot_keys(facts.limit(0), "card_id") == []
    with pytest.raises(ValueError):
        hot_keys(facts, "card_id", 0)


@pytest.mark.parametrize("share", [0.1, 1.0, None])
def test_rows_are_equal_and_only_hot_rows_are_copied(spark, star, share):
    cards, facts, users = star
    hot = [None if share is None else hot_keys(facts, k, share) for k in ("card_id", "verified_by")]
    c = prepare_dimension(cards, "card_id", 0, name="hc", salt=4, hot=hot[0])
    u = prepare_dimension(users, "user_id", 0, name="hu", salt=4, hot=hot[1])
    assert c.count() == 400 + 3 * (400 if hot[0] is None else len(hot[0]))
    assert u.count() == 500 + 3 * (500 if hot[1] is None else len(hot[1]))
    got = salted_stream_join(facts, c, u, 4, *hot)
    want = enrich(cards, facts, users)
    assert rows_of(got, want.columns) == rows_of(want)


def test_a_hot_key_spreads(star):
    _, facts, _ = star
    drawn = facts.withColumn(SALT, salt_column(8)).groupBy("card_id").agg(
        F.count_distinct(SALT).alias("n"), F.max(F.col(SALT)).alias("m")).filter("card_id = 7").first()
    assert drawn["n"] == 8 and drawn["m"] == 7


def test_a_stream_with_hot_keys_equals_the_batch_join(spark, star, tmp_dir):
    cards, facts, users = star
    facts.write.parquet(f"{tmp_dir}/facts")
    stream = spark.readStream.schema(facts.schema).parquet(f"{tmp_dir}/facts")
    joined = stream_enriched(stream, cards, users, broadcast_rows=0, salt=4,
                             hot_cards=hot_keys(facts, "card_id", 0.1),
                             hot_users=hot_keys(facts, "verified_by", 0.1))
    (joined.select("id", "card_id", "user_id").writeStream.format("parquet")
     .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ckpt")
     .trigger(**BOUNDED).start().awaitTermination())
    want = enrich(cards, facts, users).select("id", "card_id", "user_id")
    assert rows_of(spark.read.parquet(f"{tmp_dir}/out")) == rows_of(want)
