"""Every named query against its SQL counterpart, on the smallest tables."""

import os

import pytest

import __spark_entry__
from ridgeline.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    cell = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(cell(v) for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, FOLDER)
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    if name in registry.ORACLES:
        quoted = ", ".join(f'"{n}"' for n in names)
        assert plain(rows) == plain(duck.execute(f"SELECT {quoted} FROM ({registry.ORACLES[name]})").fetchall())
    else:
        assert rows


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["tile", "row", "col", "chm"]
