"""Thresholded counts of verifications per user (or per any dimension attribute).

``grouped_counts`` is the batch plan. It counts *before* the second dimension is joined
(eager aggregation): the fact is joined to the dimension it does not group on (only the
join key is read, so the join acts as a filter with multiplicity), counted per key of the
grouping dimension with a map-side partial aggregate, and only then joined to that
dimension and summed per group. The result equals ``count(*)`` over the full three-way
inner join, also with duplicate dimension keys: a fact row matching a card a times and a
user b times adds a*b either way. The fact is shuffled at most once (for the first join,
and not at all when that dimension is broadcast); the second join sees one row per key.

``enriched_counts`` is the direct form (group an enriched DataFrame); streaming jobs use
it, and tests use it to check ``grouped_counts``.

A count is a verification count, not a distinct-card count, and the threshold is strict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristar.operators.enrich import enrich
from tristar.sources.roles import check_roles

BY = {
    "id": (["user_id"], {"user_name": "min"}),   # GROUP BY id; the name rides along
    "name": (["user_name"], {}),
    "id_and_name": (["user_id", "user_name"], {}),
}


def _threshold(df: DataFrame, out: str, threshold: int | None) -> DataFrame:
    return df if threshold is None else df.filter(F.col(out) > F.lit(threshold))


def _carried(carry: dict[str, str]) -> list[Column]:
    return [getattr(F, fn)(c).alias(c) for c, fn in carry.items()]


def grouped_counts(cards: DataFrame, verifications: DataFrame, users: DataFrame,
                   group: Sequence[str], threshold: int | None = None, out: str = "counts",
                   carry: dict[str, str] | None = None,
                   pre_aggregate: bool = False) -> DataFrame:
    """``group..., [carried...], out`` = count of enriched rows per group, ``> threshold``.

    ``carry`` maps a column to an aggregate name (``{"user_name": "min"}``) for columns
    that ride along with the group without being part of it.

    ``pre_aggregate`` first counts facts per (card, user) with a map-side combine, so the
    fact shuffle carries distinct pairs. It pays when pairs repeat a lot (few cards or few
    users per partition); with nearly unique pairs the extra aggregate only costs, so it
    is off by default. Either way the result is exact.
    """
    check_roles(cards, verifications, users)
    group, carry = list(group), dict(carry or {})
    needed = set(group) | set(carry)
    v = verifications.select("card_id", "verified_by")
    if pre_aggregate:
        v = v.groupBy("card_id", "verified_by").agg(F.count(F.lit(1)).alias("__m"))
        weight = F.sum("__m")
    else:
        weight = F.count(F.lit(1))
    if needed <= set(users.columns):
        card_keys = cards.select("card_id")
        per_key = (v.join(card_keys, "card_id")
                    .groupBy("verified_by").agg(weight.alias("__n")))
        joined = per_key.join(users, F.col("verified_by") == F.col("user_id"))
    elif needed <= set(cards.columns):
        user_keys = users.select(F.col("user_id"))
        per_key = (v.join(user_keys, F.col("verified_by") == F.col("user_id"))
                    .groupBy("card_id").agg(weight.alias("__n")))
        joined = per_key.join(cards, "card_id")
    else:
        res = (enrich(cards, verifications, users).groupBy(*group)
               .agg(*_carried(carry), F.count(F.lit(1)).alias(out)))
        return _threshold(res, out, threshold)
    res = joined.groupBy(*group).agg(*_carried(carry), F.sum("__n").cast("bigint").alias(out))
    return _threshold(res, out, threshold)


def verified_users(cards: DataFrame, verifications: DataFrame, users: DataFrame,
                   by: str = "id", threshold: int | None = None, out: str = "counts",
                   pre_aggregate: bool = False) -> DataFrame:
    """Users with more than ``threshold`` verifications, grouped ``by``:

    * ``"id"``: per user id, name carried as ``min(user_name)`` (unique per id in a keyed
      users table);
    * ``"name"``: per user name; two users with one name are merged;
    * ``"id_and_name"``: per (id, name).
    """
    group, carry = BY[by]
    return grouped_counts(cards, verifications, users, group, threshold, out, carry,
                          pre_aggregate)


def enriched_counts(enriched: DataFrame, by: str = "id_and_name", threshold: int | None = None,
                    out: str = "counts") -> DataFrame:
    """The same counts over an already enriched DataFrame (batch or streaming)."""
    group, carry = BY[by]
    res = enriched.groupBy(*group).agg(*_carried(carry), F.count(F.lit(1)).alias(out))
    return _threshold(res, out, threshold)


def value_counts(cards: DataFrame, verifications: DataFrame, users: DataFrame,
                 column: str = "user_name", out: str = "counts") -> DataFrame:
    """Count per value of ``column``, null values dropped, largest count first (ties by value)."""
    if column in users.columns:
        users = users.filter(F.col(column).isNotNull())
    elif column in cards.columns:
        cards = cards.filter(F.col(column).isNotNull())
    res = grouped_counts(cards, verifications, users, [column], None, out)
    return res.filter(F.col(column).isNotNull()).orderBy(F.desc(out), F.asc(column))


def qualifying_total(counts: DataFrame, out: str = "total_users") -> DataFrame:
    """Number of rows (qualifying users) of a counts result, as one BIGINT row."""
    return counts.agg(F.count(F.lit(1)).alias(out))
