"""Registered queries next to their expected SQL on the smallest data. MATCHLAKE_ALL=1 runs all of them."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from matchlake.verification import load
from matchlake.verification.oracle import compose
from verify import TABLES, rows_of

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = load()
CORE = [n for n in QUERIES if n.split("_")[0] in {
    "g01", "g05", "g06", "g16", "g17", "g18", "g19", "q04", "q06", "q15", "q22", "q27", "q40", "q43", "q54", "q58", "q65", "q71", "m20",
    "m26", "m36", "src03", "src06", "j05", "j06", "w06", "u02", "u14", "ar10", "dq", "st01"}]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("MATCHLAKE_ALL") else CORE)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    rel = duck.execute(ORACLE[name])
    assert got == rows_of([d[0] for d in rel.description], rel.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_unknown_expressions_are_refused():
    with pytest.raises(KeyError):
        compose("SELECT * FROM z_no_such_thing")


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["rank", "team"]
