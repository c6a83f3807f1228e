import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tristar.session import get_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    # Tests set their own work folder: the session has none configured.
    ckpt = tempfile.mkdtemp(prefix="tristar-test-")
    s = get_session("local[4]", app="tristar-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)


def oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


def _key(t):
    return tuple((x is None, 0 if x is None else x) for x in t)


def rows_of(df, cols=None):
    cols = sorted(cols or df.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()),
                  key=_key)


def sql_rows(con, sql):
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    idx = [rel.columns.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
