"""Every registry entry against its DuckDB oracle (the driver's gate), on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001, oracle, rows_of, sql_rows
from tristar.plans.registry import QUERIES

NAMES = sorted(QUERIES)  # the corpus queries have tests of their own


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "user_name", "counts"]
    assert df.count() == 6


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    con = oracle(SF0001)
    df = E.queries()[name](spark, SF0001)
    cols, expected = sql_rows(con, E.oracle_sql()[name])
    assert sorted(df.columns) == cols
    assert rows_of(df) == expected


def test_value_counts_order(spark):
    got = [tuple(r) for r in E.queries()["value_counts"](spark, SF0001).collect()]
    want = oracle(SF0001).sql(E.oracle_sql()["value_counts"]).fetchall()
    assert got == [tuple(r) for r in want]


def test_counts_are_bigint(spark):
    for name in ("verified_users_by_id", "running_updates", "retract_changelog",
                 "stream_update_counts"):
        types = dict(E.queries()[name](spark, SF0001).dtypes)
        assert types["counts"] == "bigint", name
