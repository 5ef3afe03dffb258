"""Every query of the entry module that has SQL against DuckDB, and the rest for rows, over the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def normal(rows):
    return sorted((tuple(None if v is None or v != v else round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


REFERENCE = [n for n in entry.queries() if not n.startswith("op") or n == "oneof_dispatch"]


@pytest.mark.parametrize("name", [n for n in REFERENCE if n != "pipeline"])
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = normal(tuple(r[c] for c in columns) for r in df.collect())
    if name in entry.oracle_sql():
        answer = duck.execute(entry.oracle_sql()[name])
        names = [d[0] for d in answer.description]
        assert sorted(names) == columns
        want = normal(tuple(r[names.index(c)] for c in columns) for r in answer.fetchall())
        assert got == want
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
