"""Keyed records: casts, JSON decode / encode, schema checks, renames.

A keyed record is ``(key string, value string, timestamp timestamp)`` whatever carried it
(a Kafka topic or files). Decoding is ``from_json`` with a declared schema, in one of two
modes:

* ``PERMISSIVE`` (Spark's default): malformed text gives a non-null struct of nulls, a
  null value (a tombstone) gives a null struct, unknown fields are ignored.
* ``FAILFAST``: malformed text fails the job, as a strict object mapper would.

Encoding is ``to_json(struct(...))``, which leaves out null fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("PERMISSIVE", "FAILFAST")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_keyed(df: DataFrame) -> DataFrame:
    """Bytes key/value to strings and the record time to TIMESTAMP; the place in the log
    (``partition``, ``offset``) is kept where the records have one."""
    place = [F.col(c).cast(t).alias(c) for c, t in (("partition", "int"), ("offset", "long"))
             if c in df.columns]
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     F.col("timestamp").cast("timestamp").alias("timestamp"), *place)


def decode_column(value: Column | str, schema: T.StructType, mode: str = "PERMISSIVE") -> Column:
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return F.from_json(_col(value), schema, {"mode": mode})


def decode(df: DataFrame, schema: T.StructType, value: str = "value", mode: str = "PERMISSIVE",
           keep: Sequence[str] = ("key",), timestamp_as: str | None = None,
           expand: bool = True, record: str = "record") -> DataFrame:
    """Decode the JSON column ``value`` with ``schema``.

    ``keep`` columns ride along; the record ``timestamp`` is kept under ``timestamp_as``
    when given. With ``expand`` the struct's fields become top-level columns, otherwise
    the struct stays in ``record`` (null for a tombstone).
    """
    cols = [F.col(c) for c in keep]
    if timestamp_as:
        cols.append(F.col("timestamp").alias(timestamp_as))
    # A one-element explode makes the decode a generator: filters Catalyst infers on the
    # decoded fields (e.g. a join key IS NOT NULL) stay above it, so the text is parsed
    # once per record instead of once in the filter and again in the projection. A null
    # struct (tombstone) still yields its row.
    parsed = F.explode(F.array(decode_column(value, schema, mode))).alias(record)
    out = df.select(*cols, parsed)
    if expand:
        out = out.select(*[F.col(c) for c in out.columns if c != record], f"{record}.*")
    return out


def encode(df: DataFrame, key: Column | str, columns: Sequence[str] | None = None,
           names: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``(key string, value json string)`` from a key column and the listed columns.

    ``names`` renames the fields inside the JSON (e.g. to camelCase wire names).
    """
    columns = list(columns or df.columns)
    names = list(names or columns)
    if len(names) != len(columns):
        raise ValueError("names and columns differ in length")
    fields = [F.col(c).alias(n) for c, n in zip(columns, names)]
    return df.select(*[F.col(c) for c in keep],
                     _col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*fields)).alias("value"))


def key_as_number(key: Column | str = "key", type_: str = "bigint") -> Column:
    """Record key back to a number; a non-numeric key gives null instead of an error."""
    return _col(key).try_cast(type_)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename of every column (a table alias with a full column list)."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def require_schema(df: DataFrame, schema: T.StructType,
                   exact_nullability: bool = False) -> DataFrame:
    """Fail fast at job start if ``df`` lacks a field of ``schema`` or has it with another type.

    Extra columns are allowed; this is the typed-view check of a Dataset, for Python.
    """
    have = {f.name: f for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        g = have.get(f.name)
        if g is None:
            problems.append(f"missing column {f.name}")
        elif g.dataType != f.dataType:
            problems.append(f"{f.name}: {g.dataType.simpleString()} != {f.dataType.simpleString()}")
        elif exact_nullability and g.nullable != f.nullable:
            problems.append(f"{f.name}: nullable {g.nullable} != {f.nullable}")
    if problems:
        raise TypeError("schema check failed: " + "; ".join(problems))
    return df
