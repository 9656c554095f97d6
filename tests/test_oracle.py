"""Every registered query against its SQL, row for row, on whole tables."""

import datetime
import math

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="session")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


OWN = {**entry.loads.QUERIES, **entry.columns.QUERIES, **entry.landing.QUERIES}


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql(spark, sf_dir, oracle, name):
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) > 0
    assert len(got) == len(want)
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    assert not diff, diff[:3]


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert {r["action"] for r in entry.entry(spark).collect()} == {"insert", "update", "keep"}
