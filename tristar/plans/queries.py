"""Query registry: ``name -> (spark, sf_dir) -> DataFrame`` over the driver's tables,
plus the oracle SQL each one must match.

Batch queries use mapping M1 (part / lineitem / supplier, threshold 600) or M2 (part /
events / customer, threshold 66 for counts, 60 for changelogs). Streaming queries run
their job to completion (``availableNow``) over the whole ``events`` table and return the
job's output read back as a batch DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristar.functions.records import decode, encode
from tristar.functions.time import with_age
from tristar.operators.changelog import retract_changelog, running_updates
from tristar.operators.counts import (
    grouped_counts, qualifying_total, value_counts, verified_users,
)
from tristar.operators.enrich import card_verifications, enrich, flatten_nested, nested_records
from tristar.operators.stored import create_table_as, enrich_stored, store_star
from tristar.session import scratch_dir
from tristar.sources.keyed import keyed_table, publish_log, read_keyed
from tristar.sources.roles import (
    BATCH_THRESHOLD, CHANGELOG_THRESHOLD, COLLIDING_THRESHOLD, EVENT_THRESHOLD, RETRACT_THRESHOLD,
    batch_star, event_star, read_table, users_from_customer,
)
from tristar.sources.tables import duplicate_keys, latest_by_key

Query = Callable[[SparkSession, str], DataFrame]

# Fixed value: the "as of" instant of the age column, 2025-01-01T00:00:00Z.
AS_OF = 1735689600

ORDER_WIRE = T.StructType([T.StructField("custKey", T.LongType()),
                           T.StructField("orderKey", T.LongType()),
                           T.StructField("status", T.StringType())])


# ---- batch, mapping M1 -------------------------------------------------------------

def q_card_verifications(spark: SparkSession, sf: str) -> DataFrame:
    s = batch_star(spark, sf)
    return card_verifications(s.cards, s.verifications).select(
        "card_id", "title", "verified_by", "verification_date")


def q_enriched_cards(spark: SparkSession, sf: str) -> DataFrame:
    s = batch_star(spark, sf)
    return enrich(s.cards, s.verifications, s.users)


def q_stored_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """The star stored in buckets with statistics, the joined table created from it, read back."""
    stored = store_star(*batch_star(spark, sf))
    return create_table_as(enrich_stored(spark, stored), f"{stored.verifications}_enriched",
                           columns=["user_id"])


def q_verified_users_by_id(spark: SparkSession, sf: str) -> DataFrame:
    s = batch_star(spark, sf)
    return verified_users(*s, by="id", threshold=BATCH_THRESHOLD)


def q_verified_users_by_name(spark: SparkSession, sf: str) -> DataFrame:
    s = batch_star(spark, sf)
    return verified_users(*s, by="name", threshold=BATCH_THRESHOLD)


def q_verified_users_by_id_and_name(spark: SparkSession, sf: str) -> DataFrame:
    s = batch_star(spark, sf)
    return verified_users(*s, by="id_and_name", threshold=BATCH_THRESHOLD)


def q_colliding_names(spark: SparkSession, sf: str) -> DataFrame:
    """Grouping by a name that collides (card titles: 64 names over 2,000 keys at sf0.01)."""
    s = batch_star(spark, sf)
    return (grouped_counts(*s, group=["title"], threshold=COLLIDING_THRESHOLD)
            .select(F.col("title").alias("user_name"), "counts"))


def q_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    s = batch_star(spark, sf)
    return value_counts(*s, column="user_name")


def q_qualifying_user_total(spark: SparkSession, sf: str) -> DataFrame:
    s = batch_star(spark, sf)
    return qualifying_total(verified_users(*s, by="id", threshold=BATCH_THRESHOLD))


def q_dangling_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Users numbered from 1 while facts name users from 0: facts of user 0 vanish."""
    s = batch_star(spark, sf)
    users = s.users.filter(F.col("user_id") > 0)
    return (grouped_counts(s.cards, s.verifications, users, group=["user_id"])
            .select("user_id", "counts"))


def q_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_latest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return latest_by_key(orders, "o_custkey", "o_orderkey")


# ---- batch, mapping M2 -------------------------------------------------------------

def q_events_verified_users(spark: SparkSession, sf: str) -> DataFrame:
    s = event_star(spark, sf)
    return verified_users(*s, by="id_and_name", threshold=EVENT_THRESHOLD)


def q_nested_records(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_nested(nested_records(*event_star(spark, sf)))


def q_keyed_json(spark: SparkSession, sf: str) -> DataFrame:
    users = users_from_customer(read_table(spark, sf, "customer"))
    return encode(users, "user_id", ["user_id", "user_name"], names=["userId", "userName"])


def q_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Encode each verification as a keyed JSON record, then decode it again."""
    v = event_star(spark, sf).verifications
    wire = encode(v, "id", ["id", "card_id"], names=["id", "cardId"])
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("cardId", T.IntegerType())])
    return decode(wire, schema, keep=()).select("id", F.col("cardId").alias("card_id"))


def q_card_age(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events").select("event_id", "ts")
    return with_age(ev, "ts", AS_OF, "age_s").select("event_id", "age_s")


def _event_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(*event_star(spark, sf), fact_columns=["id", "verified_by"]).select(
        F.col("id").alias("event_id"), "user_id")


def q_running_updates(spark: SparkSession, sf: str) -> DataFrame:
    return running_updates(_event_enriched(spark, sf), "user_id", "event_id", CHANGELOG_THRESHOLD)


def q_retract_changelog(spark: SparkSession, sf: str) -> DataFrame:
    return retract_changelog(_event_enriched(spark, sf), "user_id", "event_id",
                             CHANGELOG_THRESHOLD)


def q_replicated_table(spark: SparkSession, sf: str) -> DataFrame:
    """The table that a published log stands for: orders as records of their customer, many of one
    timestamp (the log's offsets decide), every seventh a tombstone."""
    orders = read_table(spark, sf, "orders")
    log = encode(orders.withColumn("offset", F.col("o_orderkey")), "o_custkey",
                 ["o_custkey", "o_orderkey", "o_orderstatus"], names=["custKey", "orderKey", "status"],
                 keep=("offset",))
    topic = scratch_dir(spark, "orders-log")
    publish_log(log.select(
        "key", F.when(F.col("offset") % 7 != 0, F.col("value")).alias("value"),
        F.timestamp_seconds(F.expr("offset div 1000")).alias("timestamp"), "offset"), topic)
    return keyed_table(read_keyed(spark, topic, log=True), ORDER_WIRE, {
        "custKey": "o_custkey", "orderKey": "o_orderkey", "status": "o_orderstatus"})


BATCH: dict[str, Query] = {
    "replicated_table": q_replicated_table,
    "card_verifications": q_card_verifications,
    "enriched_cards": q_enriched_cards,
    "stored_enriched": q_stored_enriched,
    "verified_users_by_id": q_verified_users_by_id,
    "verified_users_by_name": q_verified_users_by_name,
    "verified_users_by_id_and_name": q_verified_users_by_id_and_name,
    "colliding_names": q_colliding_names,
    "value_counts": q_value_counts,
    "qualifying_user_total": q_qualifying_user_total,
    "dangling_keys": q_dangling_keys,
    "events_verified_users": q_events_verified_users,
    "nested_records": q_nested_records,
    "keyed_json": q_keyed_json,
    "json_roundtrip": q_json_roundtrip,
    "latest_by_key": q_latest_by_key,
    "duplicate_keys": q_duplicate_keys,
    "card_age": q_card_age,
    "running_updates": q_running_updates,
    "retract_changelog": q_retract_changelog,
}


# ---- oracle SQL (DuckDB, tables pre-registered as views) ----------------------------

_E = ("FROM part JOIN lineitem ON p_partkey = l_partkey "
      "JOIN supplier ON l_suppkey = s_suppkey")
_EV = ("FROM (SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS INT) "
       "AS card_id FROM events) v JOIN part ON p_partkey = v.card_id "
       "JOIN customer ON c_custkey = v.user_id")
_RUN = (f"SELECT v.event_id, c_custkey AS user_id, ROW_NUMBER() OVER "
        f"(PARTITION BY c_custkey ORDER BY v.event_id) AS n {_EV}")
_BY_ID = (f"SELECT s_suppkey AS user_id, MIN(s_name) AS user_name, COUNT(*) AS counts {_E} "
          f"GROUP BY s_suppkey HAVING COUNT(*) > {BATCH_THRESHOLD}")
_EV_BY_ID_NAME = (f"SELECT c_custkey AS user_id, c_name AS user_name, COUNT(*) AS counts {_EV} "
                  f"GROUP BY c_custkey, c_name HAVING COUNT(*) > {EVENT_THRESHOLD}")
_NESTED = (f"SELECT v.event_id AS verification_id, p_partkey AS card_id, p_name AS card_title, "
           f"c_custkey AS user_id, c_name AS user_name {_EV}")
_K = CHANGELOG_THRESHOLD

ORACLE: dict[str, str] = {
    "replicated_table": (
        "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
        "o_custkey ORDER BY o_orderkey // 1000 DESC, o_orderkey DESC) AS rn FROM orders) t "
        "WHERE rn = 1 AND o_orderkey % 7 <> 0"),
    "card_verifications": (
        "SELECT p_partkey AS card_id, p_name AS title, l_suppkey AS verified_by, "
        "l_shipdate AS verification_date FROM part JOIN lineitem ON p_partkey = l_partkey"),
    "enriched_cards": (
        f"SELECT p_partkey AS card_id, p_name AS title, l_shipdate AS verification_date, "
        f"l_suppkey AS verified_by, s_suppkey AS user_id, s_name AS user_name {_E}"),
    "verified_users_by_id": _BY_ID,
    "verified_users_by_name": (
        f"SELECT s_name AS user_name, COUNT(*) AS counts {_E} GROUP BY s_name "
        f"HAVING COUNT(*) > {BATCH_THRESHOLD}"),
    "verified_users_by_id_and_name": (
        f"SELECT s_suppkey AS user_id, s_name AS user_name, COUNT(*) AS counts {_E} "
        f"GROUP BY s_suppkey, s_name HAVING COUNT(*) > {BATCH_THRESHOLD}"),
    "colliding_names": (
        f"SELECT p_name AS user_name, COUNT(*) AS counts {_E} GROUP BY p_name "
        f"HAVING COUNT(*) > {COLLIDING_THRESHOLD}"),
    "value_counts": (
        f"SELECT s_name AS user_name, COUNT(*) AS counts {_E} WHERE s_name IS NOT NULL "
        f"GROUP BY s_name ORDER BY counts DESC, user_name"),
    "qualifying_user_total": f"SELECT COUNT(*) AS total_users FROM ({_BY_ID}) t",
    "dangling_keys": (
        "SELECT s_suppkey AS user_id, COUNT(*) AS counts FROM part JOIN lineitem "
        "ON p_partkey = l_partkey JOIN (SELECT * FROM supplier WHERE s_suppkey > 0) s "
        "ON l_suppkey = s.s_suppkey GROUP BY s_suppkey"),
    "events_verified_users": _EV_BY_ID_NAME,
    "nested_records": _NESTED,
    "keyed_json": (
        "SELECT CAST(c_custkey AS VARCHAR) AS key, CAST(json_object('userId', c_custkey, "
        "'userName', c_name) AS VARCHAR) AS value FROM customer"),
    "json_roundtrip": (
        "SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS INT) AS card_id "
        "FROM events"),
    "latest_by_key": (
        "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, ROW_NUMBER() OVER "
        "(PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) t WHERE rn = 1"),
    "duplicate_keys": (
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"),
    "card_age": (
        f"SELECT event_id, CAST({AS_OF} - date_diff('second', TIMESTAMP '1970-01-01', "
        f"date_trunc('second', ts)) AS BIGINT) AS age_s FROM events"),
    "running_updates": (
        f"SELECT event_id, user_id, CAST(n AS BIGINT) AS counts FROM ({_RUN}) r WHERE n > {_K}"),
    "retract_changelog": (
        f"SELECT event_id, user_id, is_add, counts FROM ("
        f"SELECT event_id, user_id, TRUE AS is_add, CAST(n AS BIGINT) AS counts FROM ({_RUN}) a "
        f"UNION ALL SELECT event_id, user_id, FALSE AS is_add, CAST(n - 1 AS BIGINT) AS counts "
        f"FROM ({_RUN}) b) u WHERE counts > {_K}"),
}
ORACLE["stored_enriched"] = ORACLE["enriched_cards"]

EVENT_COUNTS_SQL = _EV_BY_ID_NAME
NESTED_SQL = _NESTED
RELAY_SQL = (f"SELECT c_name AS user_name, COUNT(*) AS counts {_EV} GROUP BY c_name "
             f"HAVING COUNT(*) > {EVENT_THRESHOLD}")
# Counts per user after each quarter of the ids; a changed count retracts the one before.
_PARTS = (f"SELECT c_custkey AS user_id, c_name AS user_name, "
          f"CAST((v.event_id - lo) * 4 // w AS BIGINT) AS batch, COUNT(*) AS n {_EV} "
          f"CROSS JOIN (SELECT MIN(event_id) AS lo, MAX(event_id) - MIN(event_id) + 1 AS w "
          f"FROM events) b GROUP BY ALL")
_SUMS = (f"SELECT *, SUM(n) OVER (PARTITION BY user_id, user_name ORDER BY batch) AS total "
         f"FROM ({_PARTS}) p")
RETRACT_LOG_SQL = (
    f"SELECT batch, user_id, user_name, CAST(total AS BIGINT) AS counts, TRUE AS is_add "
    f"FROM ({_SUMS}) a WHERE total > {RETRACT_THRESHOLD} UNION ALL "
    f"SELECT batch, user_id, user_name, CAST(total - n AS BIGINT) AS counts, FALSE AS is_add "
    f"FROM ({_SUMS}) r WHERE total - n > {RETRACT_THRESHOLD}")
_LOG = ("SELECT f.event_id % 10 AS kind, p_partkey AS card, c_custkey AS usr FROM (SELECT *, "
        "CAST(json_extract_string(props, '$.k') AS INT) AS card_id FROM events) f "
        "LEFT JOIN (SELECT * FROM part WHERE p_partkey % 5 <> 0) p ON p_partkey = f.card_id "
        "LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON c_custkey = f.user_id")
DECODE_REPORT_SQL = (
    "SELECT COUNT(*) AS records, COUNT(*) FILTER (kind = 1) AS tombstones, "
    "COUNT(*) FILTER (kind = 0) AS undecodable, COUNT(*) FILTER (kind > 1) AS facts, "
    "COUNT(*) FILTER (kind > 1 AND card IS NULL) AS no_card, "
    "COUNT(*) FILTER (kind > 1 AND card IS NOT NULL AND usr IS NULL) AS no_user, "
    f"COUNT(*) FILTER (kind > 1 AND card IS NOT NULL AND usr IS NOT NULL) AS joined FROM ({_LOG}) l")
