"""Driver contract: entry smoke, and every query against its DuckDB oracle at sf0.001."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "game_name" in df.columns


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLES)
    assert set(E.queries()) == {*E.QUERIES, *E.TEXT_QUERIES}
    assert set(E.oracle_sql()) == {*E.ORACLES, *E.TEXT_ORACLES}


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = Counter(repr(tuple(r[c] for c in cols)) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    exp = Counter(repr(tuple(r[i] for i in idx)) for r in res.fetchall())
    assert got == exp


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name] + " LIMIT 0") if "LIMIT" not in E.oracle_sql()[name] \
        else con.execute(E.oracle_sql()[name])
    otypes = {d[0]: str(d[1]) for d in res.description}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK[f.dataType.simpleString()] == otypes[f.name], (name, f.name)
