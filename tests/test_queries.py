"""Every registered query against its check SQL on the small test tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from veilmark.plans import check_sql
from veilmark.plans.queries import registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, CHECKS = registered(), check_sql.checks()


@pytest.fixture(scope="module")
def checker(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    yield con
    con.close()


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_check(spark, sf_dir, checker, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = checker.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in columns]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    if name.startswith(("orphans_", "load_", "drg_lookup")):
        assert got


def test_entry(spark):
    assert contract.entry(spark).count() > 0
