"""Role schemas and adapters from the test tables to cards / verifications / users.

The workload is a star: verifications are the fact, cards and users the dimensions.
Column names follow the batch SQL schema of the workload:

    cards          card_id, title [, creation_date, created_by, verification_interval]
    verifications  [id,] card_id, verification_date, verified_by
    users          user_id, user_name

Two mappings onto the driver's tables exist (every adapter is a plain ``select``, so
Catalyst prunes the scan to the mapped columns and pushes filters into it):

    batch  (M1)  cards = part, verifications = lineitem, users = supplier
    events (M2)  cards = part, verifications = events (card = JSON props.k), users = customer
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristar.functions.records import decode_column

# The per-user threshold of the workload, and the thresholds that put the
# cut at the mean on the driver's tables.
WORKLOAD_THRESHOLD = 200
BATCH_THRESHOLD = 600          # M1: mean verifications per supplier
EVENT_THRESHOLD = 66           # M2: final counts per customer
CHANGELOG_THRESHOLD = 60       # M2: per-record changelogs
RETRACT_THRESHOLD = 30         # M2: micro-batch changelog, passed in the middle of the table
COLLIDING_THRESHOLD = 200      # grouping by (colliding) card titles

CARD_SCHEMA = T.StructType([
    T.StructField("card_id", T.LongType()),
    T.StructField("title", T.StringType()),
])
VERIFICATION_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("card_id", T.LongType()),
    T.StructField("verification_date", T.TimestampNTZType()),
    T.StructField("verified_by", T.LongType()),
])
USER_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("user_name", T.StringType()),
])

# The JSON payload of an event's ``props``: {"k": <card id>}.
EVENT_PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


ROLE_COLUMNS = {
    "cards": ("card_id",),
    "verifications": ("card_id", "verified_by"),
    "users": ("user_id",),
}
INTEGRAL_TYPES = ("tinyint", "smallint", "int", "bigint")


def check_roles(cards: DataFrame, verifications: DataFrame, users: DataFrame) -> None:
    """Job-start check of the three inputs (schema only, no data read): each has its role
    key columns, and every key is an integer type, so the joins compare numbers."""
    problems = []
    for role, df in (("cards", cards), ("verifications", verifications), ("users", users)):
        types = dict(df.dtypes)
        for c in ROLE_COLUMNS[role]:
            if c not in types:
                problems.append(f"{role} lacks column {c}")
            elif types[c] not in INTEGRAL_TYPES:
                problems.append(f"{role}.{c} is {types[c]}, not an integer type")
    if problems:
        raise TypeError("role check failed: " + "; ".join(problems))


class Star(NamedTuple):
    """The three inputs of the enrichment."""
    cards: DataFrame
    verifications: DataFrame
    users: DataFrame


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stream_location(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str | None]:
    """``(folder, glob)`` for streaming table ``name``: a folder-form table (part files
    under ``name.parquet/``, the only form at scale) streams from its own folder; a
    single-file table streams from ``sf_dir`` with a file-name glob (a stream source
    needs a directory). Decided from the file listing, no data read."""
    path = table_path(sf_dir, name)
    files = spark.read.parquet(path).inputFiles()
    if len(files) == 1 and files[0].rstrip("/").endswith(f"/{name}.parquet"):
        return sf_dir, f"{name}.parquet"
    return path, None


def cards_from_part(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("card_id"), F.col("p_name").alias("title"))


def users_from_supplier(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("user_id"),
                           F.col("s_name").alias("user_name"))


def users_from_customer(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("user_id"),
                           F.col("c_name").alias("user_name"))


def verifications_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem has no unique id; the batch SQL path never reads one."""
    return lineitem.select(F.col("l_partkey").alias("card_id"),
                           F.col("l_shipdate").alias("verification_date"),
                           F.col("l_suppkey").alias("verified_by"))


def verifications_from_events(events: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """Events as verifications; the card id is ``k`` of the JSON ``props`` (``{"k": n}``).

    PERMISSIVE reads ``k`` with ``json_tuple`` and ``try_cast`` to INT: bad JSON or a
    non-integer ``k`` gives null (the row then drops out of the inner join). ``json_tuple``
    is a generator, so the text is parsed once per row; a ``from_json`` column would be
    parsed twice, once for the null filter Catalyst infers from the join and once for the
    projection. FAILFAST decodes with ``from_json`` and fails the job on malformed text.
    """
    if mode.upper() == "FAILFAST":
        card = decode_column("props", EVENT_PROPS_SCHEMA, mode="FAILFAST").getField("k")
        return events.select(F.col("event_id").alias("id"), card.alias("card_id"),
                             F.col("ts").alias("verification_date"),
                             F.col("user_id").alias("verified_by"))
    parsed = events.select("event_id", "ts", "user_id", F.json_tuple("props", "k").alias("__k"))
    return parsed.select(F.col("event_id").alias("id"),
                         F.col("__k").try_cast("int").alias("card_id"),
                         F.col("ts").alias("verification_date"),
                         F.col("user_id").alias("verified_by"))


def batch_star(spark: SparkSession, sf_dir: str) -> Star:
    """M1: part / lineitem / supplier."""
    return Star(cards_from_part(read_table(spark, sf_dir, "part")),
                verifications_from_lineitem(read_table(spark, sf_dir, "lineitem")),
                users_from_supplier(read_table(spark, sf_dir, "supplier")))


def event_star(spark: SparkSession, sf_dir: str) -> Star:
    """M2: part / events / customer (static form; streaming jobs read events as a stream)."""
    return Star(cards_from_part(read_table(spark, sf_dir, "part")),
                verifications_from_events(read_table(spark, sf_dir, "events")),
                users_from_customer(read_table(spark, sf_dir, "customer")))
