"""Structured Streaming jobs: stream-static snapshot / update counts, micro-batch retract
changelog, stream-stream join with a two-stage relay, SQL over streaming views, and live
dimension refresh. Every job takes its checkpoint folder explicitly."""

from tristar.streaming.sinks import (
    BatchDirSink, RetractSink, net_changelog, read_changelog, read_final_state,
    read_latest_snapshot,
)
from tristar.streaming.jobs import (
    await_any, combine_counts, event_fact_stream, keyed_star_streams, publish_star,
    relay_stream, run_live, run_relay, run_retract, run_snapshot, run_sql, run_stream_join,
    run_two_stage, run_updates, stop_all, stream_enriched, stream_join,
)

__all__ = [
    "BatchDirSink", "RetractSink", "net_changelog", "read_changelog", "read_final_state",
    "read_latest_snapshot",
    "await_any", "combine_counts", "event_fact_stream", "keyed_star_streams", "publish_star",
    "relay_stream", "run_live", "run_relay", "run_retract", "run_snapshot", "run_sql",
    "run_stream_join", "run_two_stage", "run_updates", "stop_all", "stream_enriched",
    "stream_join",
]
