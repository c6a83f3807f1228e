"""Latest value per key (replicated changelog table) and primary-key checks."""

from tristar.sources import duplicate_keys, latest_by_key

SCHEMA = "user_id long, offset long, user_name string"


def rows(df):
    return sorted(tuple(r) for r in df.select("user_id", "offset", "user_name").collect())


def test_dimension_update_latest_wins(spark):
    df = spark.createDataFrame([(1, 0, "ann"), (1, 1, "bob"), (2, 0, "cy")], SCHEMA)
    assert rows(latest_by_key(df, "user_id", "offset", "user_name")) == [
        (1, 1, "bob"), (2, 0, "cy")]


def test_tombstone_removes_key(spark):
    df = spark.createDataFrame([(1, 0, "ann"), (1, 1, None), (2, 0, "cy")], SCHEMA)
    assert rows(latest_by_key(df, "user_id", "offset", "user_name")) == [(2, 0, "cy")]
    # without a tombstone column the null row is simply the latest value
    assert rows(latest_by_key(df, "user_id", "offset")) == [(1, 1, None), (2, 0, "cy")]


def test_hot_key_latest(spark):
    data = [(1, i, f"n{i}") for i in range(5000)] + [(2, 0, "x")]
    df = spark.createDataFrame(data, SCHEMA).repartition(8)
    assert rows(latest_by_key(df, "user_id", "offset")) == [(1, 4999, "n4999"), (2, 0, "x")]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "a long, b long")
    assert [tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_save_table_replaces(spark, tmp_path):
    from tristar.sources import save_table
    path = str(tmp_path / "enriched")
    save_table(spark.range(3), path)
    assert save_table(spark.range(5), path).count() == 5


def test_scale_conf():
    from tristar.session import scale_conf
    c = scale_conf(100 * (1 << 40), 8000)            # 100 TiB on 8,000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"
