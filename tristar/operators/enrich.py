"""The three-way enrichment: verifications joined to their cards, then to their users.

All joins are inner equi-joins, so a verification whose card or user is missing is dropped.
The join strategy is Catalyst's: a dimension is broadcast only when its plan statistics
are under ``spark.sql.autoBroadcastJoinThreshold`` (or, with AQE, when its real shuffle
output is under the adaptive threshold); otherwise both sides shuffle on the key and AQE
splits a hot key's partition. For stream-static joins, where AQE does not run,
``bounded_broadcast`` and ``prepare_dimension`` broadcast only under a counted row bound
and otherwise bucket the dimension once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristar.session import scratch_dir
from tristar.sources.roles import check_roles


DEFAULT_BROADCAST_BYTES = 256 << 20


def fits_rows(dim: DataFrame, max_rows: int,
              max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``dim`` has at most ``max_rows`` rows and about ``max_bytes`` of data.

    One aggregate gives the row count and the bytes of its variable-width columns
    (strings and binaries as they are, arrays, maps and structs as the text they print
    as; 8 bytes are counted for every other value, 16 per row for the row overhead). It is a map-side partial aggregate (one row per task), so the check
    stays distributed on any size; a ``limit(n).count()`` would funnel up to n rows per
    partition into one task.
    """
    var = [f.name for f in dim.schema.fields
           if f.dataType.simpleString() in ("string", "binary")
           or f.dataType.simpleString().startswith(("array", "map", "struct"))]
    flat = {f.name for f in dim.schema.fields
            if f.dataType.simpleString() in ("string", "binary")}
    fixed = 16 + 8 * (len(dim.columns) - len(var))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.coalesce(F.sum(F.octet_length(
        F.col(c) if c in flat else F.to_json(F.struct(F.col(c))))), F.lit(0)).alias(f"b{i}")
             for i, c in enumerate(var)]
    row = dim.agg(*aggs).first()
    n = row["n"]
    size = n * fixed + sum(row[f"b{i}"] for i in range(len(var)))
    return n <= max_rows and size <= max_bytes


def bounded_broadcast(dim: DataFrame, max_rows: int | None) -> DataFrame:
    """Mark ``dim`` for broadcast only under the row and byte bounds; past them it is
    returned unmarked and the join shuffles instead."""
    if max_rows is None or dim.isStreaming:
        return dim
    return F.broadcast(dim) if fits_rows(dim, max_rows) else dim


SALT = "__salt"
SALT_SEED = 20_241_202


def salt_column(salt: int) -> Column:
    """A salt in [0, salt) per row. ``rand`` with a fixed seed is seeded per partition, so
    a retried task over the same input draws the same values; any value is correct
    anyway, because every dimension row exists once per salt."""
    return F.floor(F.rand(SALT_SEED) * F.lit(salt)).cast("bigint")


def hot_keys(facts: DataFrame, key: str, share: float = 0.01) -> list:
    """The values of ``key`` that hold about ``share`` of the rows or more (at most 1 / share).

    One pass with a frequent-items sketch (``approx_top_k``), a few KB a task, of a table or a
    stream's first batch. Any list is correct for salting: a hot key that is missed is
    not spread, a cold one that is named only has needless copies."""
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    k = int(1 / share)
    row = (facts.filter(F.col(key).isNotNull()).select(F.col(key).alias("__key"))
           .agg(F.count(F.lit(1)).alias("n"),
                F.expr(f"approx_top_k(__key, {k}, {min(10 * k, 1_000_000)})").alias("top")).first())
    return sorted(t["item"] for t in row["top"] or () if t["count"] >= share * row["n"])


def _is_hot(key: Column, hot: Sequence | None) -> Column:
    return F.lit(True) if hot is None else key.isin(*hot) if len(hot) else F.lit(False)


def prepare_dimension(dim: DataFrame, key: str, max_broadcast_rows: int | None,
                      buckets: int | None = None, name: str = "dimension",
                      salt: int = 1, hot: Sequence | None = None) -> DataFrame:
    """A static dimension made ready for a long-running stream-static join.

    Under the row bound it is marked for broadcast (``bounded_broadcast``). Past it, it
    is written once, bucketed and sorted by ``key``, as a table under the shared work
    folder: a join against the bucketed scan shuffles only each micro-batch to the
    bucket count, instead of re-shuffling the whole dimension in every batch.

    With ``salt`` = S > 1 the bucketed table holds S copies of each row, one per value of
    a ``__salt`` column, bucketed by ``(key, __salt)``. Joined on both with salted facts
    (``salted_stream_join``), a hot key spreads over S bucket tasks instead of one. With
    ``hot`` (see ``hot_keys``) only the rows of these keys are copied.
    """
    if max_broadcast_rows is not None and fits_rows(dim, max_broadcast_rows):
        return F.broadcast(dim)
    spark = dim.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"tristar_{name}_{uuid.uuid4().hex[:12]}"
    cols = [key]
    if salt > 1:
        last = F.when(_is_hot(F.col(key), hot), F.lit(salt - 1)).otherwise(F.lit(0)).cast("bigint")
        dim = dim.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias(SALT))
        cols.append(SALT)
    # Repartitioning by the bucket columns first gives one file per bucket (the bucket
    # id is the same hash modulo n), instead of up to n files from every write task.
    (dim.repartition(n, *cols).write.bucketBy(n, *cols).sortBy(*cols)
        .option("path", scratch_dir(spark, table)).saveAsTable(table))
    return spark.table(table)


def salted_stream_join(facts: DataFrame, cards: DataFrame, users: DataFrame, salt: int,
                       hot_cards: Sequence | None = None,
                       hot_users: Sequence | None = None) -> DataFrame:
    """``enrich`` for dimensions from ``prepare_dimension(..., salt=salt)``, with the same lists of
    hot keys (None: all keys are salted).

    Each fact gets a ``__salt`` in [0, salt) and joins a salted dimension on
    ``(key, __salt)``; an unsalted (broadcast) dimension joins on the key alone. Each fact
    meets exactly one copy of each dimension row whatever its salt, so the result equals
    ``enrich``. The salt is drawn per row (``salt_column``), so even identical copies of
    one fact, a pile a content hash would send to one task, are spread.
    """
    check_roles(cards, facts, users)
    f = facts.withColumn(SALT, salt_column(salt))
    c = cards.withColumnRenamed(SALT, "__cs") if SALT in cards.columns else cards
    u = users.withColumnRenamed(SALT, "__us") if SALT in users.columns else users
    cold = F.lit(0).cast("bigint")
    on_card = F.col("fc.card_id") == F.col("c.card_id")
    if "__cs" in c.columns:
        drawn = F.when(_is_hot(F.col("fc.card_id"), hot_cards), F.col(f"fc.{SALT}")).otherwise(cold)
        on_card = on_card & (drawn == F.col("c.__cs"))
    j = f.alias("fc").join(c.alias("c"), on_card)
    on_user = F.col("fc.verified_by") == F.col("u.user_id")
    if "__us" in u.columns:
        drawn = F.when(_is_hot(F.col("fc.verified_by"), hot_users),
                       F.col(f"fc.{SALT}")).otherwise(cold)
        on_user = on_user & (drawn == F.col("u.__us"))
    j = j.join(u.alias("u"), on_user)
    card_cols = [x for x in cards.columns if x != SALT]
    user_cols = [x for x in users.columns if x != SALT]
    fact_cols = [x for x in facts.columns if x != "card_id"]
    return j.select(*[F.col(f"c.{x}") for x in card_cols],
                    *[F.col(f"fc.{x}") for x in fact_cols],
                    *[F.col(f"u.{x}") for x in user_cols])


def card_verifications(cards: DataFrame, verifications: DataFrame,
                       fact_columns: Sequence[str] | None = None) -> DataFrame:
    """cards JOIN verifications USING (card_id): card columns, then fact columns."""
    cols = [c for c in (fact_columns or verifications.columns) if c != "card_id"]
    return cards.join(verifications.select("card_id", *cols), "card_id")


def enrich(cards: DataFrame, verifications: DataFrame, users: DataFrame,
           fact_columns: Sequence[str] | None = None,
           broadcast_rows: int | None = None) -> DataFrame:
    """``cards.*, <fact columns>, users.*`` for every verification with a card and a user.

    ``fact_columns`` defaults to every verification column except ``card_id``.
    ``broadcast_rows`` (stream-static jobs) broadcasts a dimension under that row bound.
    """
    check_roles(cards, verifications, users)
    cols = [c for c in (fact_columns or verifications.columns) if c != "card_id"]
    if "verified_by" not in cols:
        cols.append("verified_by")
    cards = bounded_broadcast(cards, broadcast_rows)
    users = bounded_broadcast(users, broadcast_rows)
    cv = card_verifications(cards, verifications, cols)
    out = cv.join(users, F.col("verified_by") == F.col("user_id"))
    return out.select(*cards.columns, *cols, *users.columns)


def nested_records(cards: DataFrame, verifications: DataFrame, users: DataFrame,
                   broadcast_rows: int | None = None) -> DataFrame:
    """One row per joined verification: ``(verification struct, card struct, user struct)``."""
    v = verifications.select(F.struct(*verifications.columns).alias("verification"),
                             F.col("card_id").alias("__card"),
                             F.col("verified_by").alias("__user"))
    c = bounded_broadcast(cards, broadcast_rows)
    c = c.select(F.struct(*cards.columns).alias("card"), F.col("card_id").alias("__cid"))
    u = bounded_broadcast(users, broadcast_rows)
    u = u.select(F.struct(*users.columns).alias("user"), F.col("user_id").alias("__uid"))
    return (v.join(c, F.col("__card") == F.col("__cid"))
             .join(u, F.col("__user") == F.col("__uid"))
             .select("verification", "card", "user"))


def flatten_nested(nested: DataFrame) -> DataFrame:
    """Dotted projection of ``nested_records`` to flat, oracle-comparable columns."""
    return nested.select(F.col("verification.id").alias("verification_id"),
                         F.col("card.card_id").alias("card_id"),
                         F.col("card.title").alias("card_title"),
                         F.col("user.user_id").alias("user_id"),
                         F.col("user.user_name").alias("user_name"))
