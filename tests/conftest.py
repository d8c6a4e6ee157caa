import glob
import os

import duckdb
import pytest

from textloom.session import local_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "3g", "tests")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return DATA


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, float) or hasattr(v, "as_tuple"):
        return round(float(v), 5)
    return v


@pytest.fixture(scope="session")
def agrees(spark):
    """Whether a query and its SQL give the same columns and rows on the smallest tables."""
    duck = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        duck.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")

    def compare(query, sql):
        df = query(spark, DATA)
        cols = sorted(df.columns)
        rel = duck.execute(sql)
        names = [x[0] for x in rel.description]
        want = sorted(repr([plain(dict(zip(names, r))[c]) for c in cols]) for r in rel.fetchall())
        assert sorted(names) == cols
        assert sorted(repr([plain(r[c]) for c in cols]) for r in df.collect()) == want

    return compare
