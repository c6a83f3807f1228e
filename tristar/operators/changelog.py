"""Per-record replay of a continuously updated count: the update stream and the
retract/add changelog an incremental engine emits for ``COUNT(*) ... HAVING > k``.

For every input row of a key, in ``order``, the running count n of that key is:

    running_updates    (row, n)                        for n > k
    retract_changelog  (row, add, n) for n > k, and (row, retract, n - 1) for n - 1 > k

A plain ``row_number() OVER (PARTITION BY key ORDER BY order)`` would put every row of a
hot key in one task. ``running_counts`` computes the same numbers with bounded work:

1. rows are range-partitioned by ``(key, order, random tiebreak)`` (sampled bounds, so a
   hot key, sparse order values and even a pile of identical copies spread over many
   partitions), sorted within each partition, and numbered by their position there
   (``monotonically_increasing_id``); ``block`` = position div ``block``. This is written
   once to the shared folder (positions are only stable once written; this also cuts
   the lineage);
2. per ``(key, block)`` (at most ``block`` rows each, by construction) the row count and
   first position are aggregated, and block counts are prefix-summed per key: a key has
   at most rows / ``block`` + partitions blocks;
3. a row's count is its block's prefix plus its offset from the block's first position.
   No window runs over the rows themselves, and only counts above the threshold are kept.

``order`` must be integral (ids, epoch seconds). Ties in ``order`` within a key get
consecutive counts in arbitrary order, exactly as ``row_number`` gives them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tristar.session import write_stage

DEFAULT_BLOCK = 1 << 20
TIEBREAK_SEED = 4242
ROWS_PER_PARTITION = 8_000_000  # two longs and a double each: about 200 MB
INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _positions(df: DataFrame, key: str, order: str, block: int) -> tuple[DataFrame, DataFrame]:
    """Written ``(key, order, __pos, __b)`` rows and ``(key, __b, __before, __first)`` blocks."""
    kind = dict(df.dtypes)[order]
    if kind not in INTEGRAL:
        raise TypeError(f"order column {order!r} must be integral, not {kind}; "
                        "use an id or epoch seconds/micros")
    if not 1 <= block <= 1 << 32:
        raise ValueError("block must be in [1, 2^32]")
    spark = df.sparkSession
    # Written first: range partitioning samples its input, so the upstream joins would run
    # twice, and a tiebreak drawn above a shuffle could differ on a retried task.
    source = write_stage(df.select(key, order).filter(F.col(key).isNotNull()), "replay-input")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                source.count() // ROWS_PER_PARTITION + 1)
    place = [F.col(key), F.col(order).asc_nulls_last(), F.col("__t")]
    rows = (source.withColumn("__t", F.rand(TIEBREAK_SEED))
              .repartitionByRange(parts, *place).sortWithinPartitions(*place)
              .select(key, order, F.monotonically_increasing_id().alias("__pos"))
              .withColumn("__b", F.expr(f"__pos div {int(block)}")))
    # Positions are only stable once written: the range bounds come from a sample.
    rows = write_stage(rows, "running-counts")
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    # Read once, by the final join: computed from the written rows, not written itself.
    blocks = (rows.groupBy(key, "__b").agg(F.count(F.lit(1)).alias("__bt"),
                                           F.min("__pos").alias("__first"))
                  .select(key, "__b", "__bt", "__first",
                          F.coalesce(F.sum("__bt").over(before), F.lit(0)).cast("bigint")
                          .alias("__before")))
    return rows, blocks


def _count_rows(rows: DataFrame, blocks: DataFrame, key: str, order: str) -> DataFrame:
    return (rows.join(blocks, [key, "__b"])
                .select(key, order, (F.col("__before") + F.col("__pos") - F.col("__first") + 1)
                        .cast("bigint").alias("__n")))


def _numbered(df: DataFrame, key: str, order: str, block: int) -> DataFrame:
    """``(key, order, __n)``: every row with its running count within its key."""
    return _count_rows(*_positions(df, key, order, block), key, order)


def numbered_from(df: DataFrame, key: str, order: str, carry: DataFrame,
                  block: int = DEFAULT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """Running counts that go on from ``carry`` (key, ``counts`` so far; one row a key): the
    rows as ``(key, order, __n)``, and ``(key, counts)`` of the keys that occur in ``df``.

    The carry is added to the blocks, not to the rows, so a hot key's rows still meet only
    their own block."""
    rows, blocks = _positions(df, key, order, block)
    blocks = (blocks.join(carry.select(key, F.col("counts").alias("__carry")), key, "left")
              .withColumn("__before", F.col("__before") + F.coalesce("__carry", F.lit(0))))
    totals = blocks.groupBy(key).agg(F.max(F.col("__before") + F.col("__bt")).cast("bigint")
                                     .alias("counts"))
    return _count_rows(rows, blocks, key, order), totals


def running_counts(df: DataFrame, key: str, order: str, min_count: int = 1,
                   block: int = DEFAULT_BLOCK, out: str = "counts") -> DataFrame:
    """``(key, order, out)``: one row per input row whose running count is ``>= min_count``."""
    n = _numbered(df, key, order, block)
    return n.filter(F.col("__n") >= min_count).select(key, order, F.col("__n").alias(out))


def running_updates(df: DataFrame, key: str, order: str, threshold: int,
                    block: int = DEFAULT_BLOCK, out: str = "counts") -> DataFrame:
    """The update stream of a count per ``key``, filtered ``> threshold``: ``(order, key, out)``."""
    res = running_counts(df, key, order, threshold + 1, block, out)
    return res.select(order, key, out)


def retract_changelog(df: DataFrame, key: str, order: str, threshold: int,
                      block: int = DEFAULT_BLOCK, out: str = "counts",
                      flag: str = "is_add") -> DataFrame:
    """``(order, key, flag, out)``: per row, add n if n > k and retract n - 1 if n - 1 > k.

    Both messages of a row come from one pass (a two-element flag array).
    """
    return retractions(_numbered(df, key, order, block), key, order, threshold, out, flag)


def retractions(numbered: DataFrame, key: str, order: str, threshold: int, out: str = "counts",
                flag: str = "is_add") -> DataFrame:
    """The retract/add messages of rows that are numbered already (``__n``)."""
    shift = F.when(F.col(flag), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    n = numbered.select(
        key, order, "__n", F.explode(F.array(F.lit(True), F.lit(False))).alias(flag))
    return (n.select(order, key, flag, (F.col("__n") - shift).alias(out))
             .filter(F.col(out) > threshold))
