"""Every text query that has a SQL counterpart against it, on the smallest tables."""

import os

import pytest

import __spark_entry__
from ridgeline.llm import queries as text_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(text_queries.ORACLES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    db = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = __spark_entry__.queries()[name](spark, FOLDER)
    names = sorted(df.columns)
    rows = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert rows == sorted(db.execute(f"SELECT {', '.join(names)} FROM ({text_queries.ORACLES[name]})").fetchall(), key=repr)


def test_disclosing_terms_match_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    letters = "abcdefghij"
    filler = [f"plain words {''.join(letters[int(c)] for c in str(i))} in row {i}" for i in range(1000)]
    held = ["Ask Zébulon Quimby: ZQ@example.org, or +1 (555) 010-9999 now", "zq@example.org belongs to Quimby", "Quimby, Zébulon (zq@EXAMPLE.org) 10.0.0.1", "see zq@example.org\nQuimby again"]
    texts = [*filler, *held, *held[:2], "Zébulon alone", None, "", "x " * 60 + "Quimby " + "y " * 20 + "zq@example.org", "Quimby éQuimby@x.org a@b.orgQuimby zq@example.org. éa@b.c_d@e.f.gé Quimby"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    df = text_queries.QUERIES["op9_private_data"](spark, str(tmp_path))
    names = sorted(df.columns)
    rows = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert rows == sorted(db.execute(f"SELECT {', '.join(names)} FROM ({text_queries.ORACLES['op9_private_data']})").fetchall(), key=repr)
    assert sum("term" in r[names.index("spans")] for r in rows) >= 6
