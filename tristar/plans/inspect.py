"""Plan inspection through the public ``explain`` output (for tests, the CLI and reviews)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints. After an action on ``df`` itself, AQE's
    final plan (``isFinalPlan=true``) is shown."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def read_schemas(plan: str) -> list[str]:
    """``ReadSchema`` of every file scan, e.g. ``struct<l_partkey:bigint,l_suppkey:bigint>``."""
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def pushed_filters(plan: str) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan)


def count_nodes(plan: str, name: str) -> int:
    """How many plan lines show operator ``name`` (e.g. ``Exchange hashpartitioning``)."""
    return sum(1 for line in plan.splitlines() if name in line)


def final_plan(plan: str) -> str:
    """The ``== Final Plan ==`` part of an executed adaptive plan (all of it otherwise)."""
    return plan.split("== Initial Plan ==")[0]
