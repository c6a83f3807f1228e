"""The registry as the driver sees it: batch queries and streaming jobs in one table."""

from __future__ import annotations

from tristar.plans.queries import (
    BATCH, DECODE_REPORT_SQL, EVENT_COUNTS_SQL, NESTED_SQL, ORACLE, RELAY_SQL, RETRACT_LOG_SQL,
)
from tristar.plans.streams import STREAMS

QUERIES = {**BATCH, **STREAMS}

ORACLE_SQL = {
    **ORACLE,
    "stream_snapshot_counts": EVENT_COUNTS_SQL,
    "stream_update_counts": EVENT_COUNTS_SQL,
    "stream_stream_join": NESTED_SQL,
    "two_stage_relay": RELAY_SQL,
    "relay_dedup": RELAY_SQL,
    "stream_sql_having": EVENT_COUNTS_SQL,
    "stream_retract_net": EVENT_COUNTS_SQL,
    "stream_running_updates": ORACLE["running_updates"],
    "stream_retract_records": ORACLE["retract_changelog"],
    "stream_retract_log": RETRACT_LOG_SQL,
    "stream_pending_join": NESTED_SQL,
    "state_counts": EVENT_COUNTS_SQL,
    "decode_report": DECODE_REPORT_SQL,
    "live_dimension_counts": EVENT_COUNTS_SQL,
}
