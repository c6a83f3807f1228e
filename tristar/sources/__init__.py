"""Inputs: role adapters over the parquet tables, keyed record sources, dimension tables."""

from tristar.sources.roles import (
    Star, read_table, batch_star, event_star, cards_from_part, users_from_supplier,
    users_from_customer, verifications_from_lineitem, verifications_from_events,
)
from tristar.sources.keyed import (
    KEYED_SCHEMA, keyed_source, keyed_table, publish_keyed, read_keyed,
)
from tristar.sources.tables import duplicate_keys, latest_by_key, register_views, save_table

__all__ = [
    "Star", "read_table", "batch_star", "event_star", "cards_from_part",
    "users_from_supplier", "users_from_customer", "verifications_from_lineitem",
    "verifications_from_events", "KEYED_SCHEMA", "keyed_source", "keyed_table", "publish_keyed",
    "read_keyed", "latest_by_key", "duplicate_keys", "register_views", "save_table",
]
