"""tristar: a three-way star enrichment (facts x two dimensions) and thresholded
per-actor counts on Spark, delivered as batch tables and as Structured Streaming
snapshot, update, retract and two-stage relay jobs.

Layout
------
sources/    role adapters over the parquet tables, keyed (key, value, timestamp) sources,
            latest-value-per-key dimension tables, key checks
functions/  column-level helpers: JSON decode/encode, casts, schema checks, age column
operators/  joins (enrichment, nested records) and counts (grouped, value_counts, changelogs)
plans/      the query registry used by __spark_entry__.py, its oracle SQL, plan inspection
streaming/  streaming jobs and their foreachBatch sinks
"""

from tristar.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
