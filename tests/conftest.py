import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from adsphere.session import build_session, ensure_checkpoint_dir
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="adsphere-test-ckpt-")})
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def _duck(sf_dir):
    import duckdb
    from adsphere.sources.tables import TABLES, table_path
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


@pytest.fixture(scope="session")
def duck():
    return _duck(SF01)


@pytest.fixture(scope="session")
def duck_small():
    return _duck(SF001)


def sorted_rows(rows, ndigits=9):
    def norm(v):
        if isinstance(v, float):
            return f"{v:.{ndigits}g}"
        if isinstance(v, (list, tuple)):
            return tuple(norm(x) for x in v)
        return "" if v is None else str(v)
    return sorted(tuple(norm(x) for x in r) for r in rows)


def assert_matches_oracle(spark, duck, name, sf_dir=SF01):
    import __spark_entry__ as entry
    df = entry.queries()[name](spark, sf_dir)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(cols) == sorted(ocols), (cols, ocols)
    idx = [ocols.index(c) for c in cols]
    exp = [tuple(r[i] for i in idx) for r in exp]
    assert len(got) == len(exp)
    assert sorted_rows(got) == sorted_rows(exp)
    return got
