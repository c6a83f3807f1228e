"""Counted losses: what a job leaves out, counted where it is left out.

Records without a value (tombstones), records whose text cannot be decoded, and facts that
meet no dimension row drop out of a permissive job. ``observed_facts`` counts them with
``DataFrame.observe``: the counts come with the batch's own pass over the data, with no second
read and no shuffle. They are scalars per batch, read from the query's progress
(``observed_totals``) or by a ``LossListener`` while a query runs on.
"""

from __future__ import annotations

from collections import Counter
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tristar.functions.records import decode

DECODED, JOINED = "decode_losses", "join_losses"


def decode_counted(records: DataFrame, schema: T.StructType, name: str = DECODED) -> DataFrame:
    """The decodable records' fields; observes ``records``, ``tombstones`` and ``undecodable`` (no
    field of the text could be read)."""
    parsed = decode(records, schema, keep=("value",), expand=False)
    read = F.greatest(*[F.col(f"record.{f.name}").isNotNull() for f in schema.fields], F.lit(False))
    read = F.coalesce(read, F.lit(False))
    counted = parsed.withColumn("__read", read).observe(
        name, F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("value").isNull()).alias("tombstones"),
        F.count_if(F.col("value").isNotNull() & ~F.col("__read")).alias("undecodable"))
    return counted.filter("__read").select("record.*")


def join_counted(cards: DataFrame, facts: DataFrame, users: DataFrame,
                 name: str = JOINED) -> DataFrame:
    """Facts (``card_id``, ``verified_by``) with both dimension rows; observes ``facts`` and those
    without a card (``no_card``) or with a card but no user (``no_user``). Dimension keys must
    be unique."""
    met = (facts.join(cards.withColumn("__card", F.lit(True)), "card_id", "left")
           .join(users.withColumn("__user", F.lit(True)),
                 F.col("verified_by") == F.col("user_id"), "left"))
    counted = met.observe(
        name, F.count(F.lit(1)).alias("facts"), F.count_if(F.col("__card").isNull()).alias("no_card"),
        F.count_if(F.col("__card").isNotNull() & F.col("__user").isNull()).alias("no_user"))
    return counted.filter("__card AND __user").drop("__card", "__user")


def _add(total: Counter, progress) -> None:
    for row in (progress.observedMetrics or {}).values():
        total.update({k: int(v or 0) for k, v in row.asDict().items()})


def observed_totals(query: StreamingQuery) -> dict[str, int]:
    """Sums of the observed counts over the batches in the query's progress (the session keeps
    ``spark.sql.streaming.numRecentProgressUpdates`` of them; for longer runs listen)."""
    total: Counter = Counter()
    for p in query.recentProgress:
        _add(total, p)
    return dict(total)


class LossListener(StreamingQueryListener):
    """Sums the observed counts of all queries of a session by query name (or id)."""

    def __init__(self):
        self._lock, self.totals = Lock(), {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            _add(self.totals.setdefault(p.name or str(p.id), Counter()), p)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
