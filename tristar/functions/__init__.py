"""Column-level helpers; all are built-in Spark expressions (no Python UDFs)."""

from tristar.functions.records import (
    cast_keyed, decode, decode_column, encode, key_as_number, rename_all, require_schema,
)
from tristar.functions.time import epoch_seconds, event_time, with_age

__all__ = ["cast_keyed", "decode", "decode_column", "encode", "key_as_number",
           "rename_all", "require_schema", "epoch_seconds", "event_time", "with_age"]
