"""Row numbers that stay the same from one read of a table to the next, and a sieve on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIEVE_BITS = 25
_PIN = "spark.sql.files.minPartitionNum"


def row_number_of(df: DataFrame) -> Column:
    """A number for each row of a table by its place in the files.

    How files are cut into partitions depends on the number of cores unless the session says
    otherwise; the number at the first call is kept in the session, so that executors that
    come or go between two reads do not renumber the rows."""
    spark = df.sparkSession
    if spark.conf.get(_PIN, None) is None:
        spark.conf.set(_PIN, str(max(spark.sparkContext.defaultParallelism, 1)))
    return F.monotonically_increasing_id()


def sieve(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``column`` is in the first column of ``wanted``, and a few more.

    A broadcast bitmap of 2**SIEVE_BITS hashed values (4 MB, whatever the tables' size) tells
    rows that are surely not wanted before the exact join that must follow shuffles them. Of
    more wanted values than it has bits it drops little, but never a wanted row."""
    cell = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(1 << SIEVE_BITS))
    bits = (wanted.select(cell(wanted.columns[0]).alias("sieve_cell"))
            .groupBy(F.shiftright("sieve_cell", 15).alias("sieve_part"))
            .agg(F.bitmap_construct_agg(F.expr("sieve_cell % 32768")).alias("sieve_bits")))
    return (df.withColumn("sieve_cell", cell(column))
            .join(F.broadcast(bits), F.shiftright("sieve_cell", 15) == F.col("sieve_part"))
            .filter("shiftright(CAST(conv(hex(substring(sieve_bits, CAST(sieve_cell % 32768 DIV 8 AS INT) + 1, 1)),"
                    " 16, 10) AS INT), CAST(sieve_cell % 8 AS INT)) % 2 = 1").select(*df.columns))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of the table is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
