"""Every registered query against its DuckDB oracle at sf0.001."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

TABLES = "documents conversations labels benchmark embeddings pages".split()
SLOW = {"sweep", "select_best", "comparison_table"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    assert [rel.columns[i] for i in idx] == cols
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert {r.split for r in rows} == {"train", "eval"}


def test_every_query_has_a_callable(spark):
    qs = E.queries()
    missing = set(E.oracle_sql()) - set(qs)
    assert not missing
    for name in sorted(set(qs) - set(E.oracle_sql()) - SLOW):
        assert qs[name](spark, SF001).count() >= 0


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert [f.name for f in a.schema.fields] == ["split", "rows", "unique_hashes"]
    assert sum(r.rows for r in a.collect()) == sum(r.rows for r in b.collect()) > 0
