"""Joins and counts. Every function takes and returns DataFrames; the enrichment and the
grouped counts work unchanged on batch and streaming inputs."""

from tristar.operators.enrich import (
    bounded_broadcast, card_verifications, enrich, flatten_nested, nested_records,
    prepare_dimension, salted_stream_join,
)
from tristar.operators.counts import (
    enriched_counts, grouped_counts, qualifying_total, value_counts, verified_users,
)
from tristar.operators.changelog import retract_changelog, running_counts, running_updates

__all__ = [
    "bounded_broadcast", "card_verifications", "enrich", "flatten_nested", "nested_records",
    "prepare_dimension", "salted_stream_join",
    "enriched_counts", "grouped_counts", "qualifying_total", "value_counts", "verified_users",
    "retract_changelog", "running_counts", "running_updates",
]
