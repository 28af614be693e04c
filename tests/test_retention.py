"""Purges: what stays, which files change, what a repetition does."""

import os
from datetime import date

import pytest

from tests.conftest import rows
from veilmark.operators.retention import OVERWRITE_MODE, Purge, purge

ROWS = [
    (1, date(2020, 1, 5), "2020-01", "a"),
    (2, date(2020, 2, 9), "2020-02", "a"),
    (3, date(2020, 2, 20), "2020-02", "a"),
    (4, None, None, "a"),
    (5, date(2020, 2, 1), "2020-02", "it's"),
    (6, date(2020, 3, 1), "2020-03", "a"),
    (7, date(2020, 2, 20), "2020-02", None),
    (8, None, "2020-02", "b"),
    (9, date(2020, 1, 1), None, "a"),
]


@pytest.fixture
def table(spark, request):
    name = f"purged_{request.node.name.replace('[', '_').replace(']', '')}"
    df = spark.createDataFrame(ROWS, "id int, day date, month string, kind string")
    df.write.partitionBy("month", "kind").format("parquet").saveAsTable(name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def files(spark, name):
    found = {}
    for path in spark.table(name).inputFiles():
        local = path.removeprefix("file://").replace("%2520", "%20")
        found[path] = os.stat(local).st_mtime_ns if os.path.exists(local) else None
    return found


def test_purge(spark, table):
    before = files(spark, table)
    mode = spark.conf.get(OVERWRITE_MODE)
    assert purge(spark, table, "day", date(2020, 2, 15)) == Purge(9, 4, 2, 2, 3)
    assert sorted(r["id"] for r in spark.table(table).collect()) == [3, 4, 6, 7, 8]
    assert spark.conf.get(OVERWRITE_MODE) == mode
    after = files(spark, table)
    same = {p for p in after if before.get(p, 0) == after[p]}
    # Those of March, of February's other kinds and of the row without a day nor month stay.
    assert len(same) >= 3 and len(set(after) - same) <= 2
    assert purge(spark, table, "day", date(2020, 2, 15)) == Purge(5, 0, 0, 0, 5)
    assert files(spark, table) == after


def test_purge_of_everything_and_nothing(spark, table):
    assert purge(spark, table, "day", date(1990, 1, 1)).n_removed == 0
    assert rows(spark.table(table).select("id")) == [(i,) for i in range(1, 10)]
    done = purge(spark, table, "day", date(2090, 1, 1))
    assert done.n_removed == 7 and rows(spark.table(table).select("id")) == [(4,), (8,)]
    assert done.n_rows - done.n_removed == 2


def test_a_table_without_partitions(spark):
    spark.range(3).write.format("parquet").mode("overwrite").saveAsTable("unpartitioned")
    with pytest.raises(ValueError, match="partitions"):
        purge(spark, "unpartitioned", "id", date(2020, 1, 1))
