"""Joins against brute force, with hot keys, NULL keys and orphans."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from veilmark.operators import joins
from veilmark.operators.masking import masked
from veilmark.plans.payer_views import payer_table

# A third of the rows has one key, a third has none.
KEYS = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 50}") for i in range(3000)]
PARENTS = [("hot", "h1"), ("hot", "h2"), ("k2", "a"), ("k5", "b"), ("lonely", "c"), (None, "d")]


@pytest.fixture(scope="module")
def sides(spark):
    many = spark.createDataFrame(list(enumerate(KEYS)), "id int, fk string")
    one = spark.createDataFrame(PARENTS, "pk string, label string")
    return many, one


def brute_force(how):
    out = []
    for i, key in enumerate(KEYS):
        hits = [(i, key, pk, label) for pk, label in PARENTS if key is not None and pk == key]
        out += hits or ([(i, key, None, None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.fixture
def nothing_is_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


FEW = {"rows_per_slice": 100}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("probe", [{"one_in": 1, **FEW}, {"one_in": 4, **FEW}, {}])
def test_spread_join_equals_brute_force(sides, nothing_is_broadcast, how, probe):
    many, one = sides
    joined = joins.spread_join(many, one, "fk", "pk", ["id"], how, **probe)
    assert rows(joined) == brute_force(how)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_small_side_is_left_to_spark(spark, sides, tmp_path, how):
    many, one = sides
    one.write.parquet(str(tmp_path / "one"))
    stored = spark.read.parquet(str(tmp_path / "one"))
    assert joins.estimated_bytes(stored) < 10_000
    joined = joins.spread_join(many, stored, "fk", "pk", ["id"], how)
    text = plan(joined)
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text
    assert rows(joined) == brute_force(how)


def test_hot_keys_are_found_and_bounded(sides):
    many, _ = sides
    assert rows(joins.hot_keys(many, "fk", ["id"], 999, one_in=1)) == [("hot", 2)]
    assert rows(joins.hot_keys(many, "fk", ["id"], 1000, one_in=1)) == []
    assert [r[0] for r in rows(joins.hot_keys(many, "fk", ["id"], 500, one_in=8))] == ["hot"]
    assert joins.hot_keys(many, "fk", ["id"], 1, one_in=1).count() == 51
    # At most ten keys can have more than a tenth of all rows.
    assert rows(joins.hot_keys(many, "fk", ["id"], 1, one_in=1, most=10)) == [("hot", 4)]


def test_a_key_with_a_small_share_is_cut(spark):
    """0.4% of the rows are too many for a task if they are many."""
    many = spark.range(100_000).selectExpr(
        "id", "CASE WHEN id % 250 = 0 THEN 'warm' ELSE CAST(id AS STRING) END AS fk"
    )
    hot = joins.hot_keys(many, "fk", ["id"], 50, one_in=1)
    assert rows(hot) == [("warm", 8)]
    cut = joins.sliced(many, "fk", hot, ["id"], "s").where("fk = 'warm'")
    sizes = [r["count"] for r in cut.groupBy("s").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 100


def test_a_hot_key_fills_many_slices(spark, sides, nothing_is_broadcast):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        many, one = sides
        joined = joins.spread_join(many, one, "fk", "pk", ["id"], "left", one_in=1, rows_per_slice=20)
        sizes = [
            r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()
        ]
        assert rows(joined) == brute_force("left")
        assert "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 12
    assert max(sizes) < sum(sizes) / 4


def test_unsupported_kind(sides):
    with pytest.raises(ValueError):
        joins.spread_join(*sides, "fk", "pk", ["id"], "full")


def test_deid_join_says_if_rows_multiply(spark, sf_dir):
    claims, fills = (payer_table(spark, sf_dir, t) for t in ("claims", "pharmacy_claims"))
    sides = claims, "claims", fills, "pharmacy_claims", "none", "s"
    with pytest.raises(ValueError, match="many_to_many"):
        joins.deid_join(*sides)
    on = claims.select("member_id").join(fills.select("member_id"), "member_id")
    assert joins.deid_join(*sides, many_to_many=True).count() == on.count() > 0


def test_deid_join_equals_the_join_on_hashes(spark, sf_dir):
    claims, members = (payer_table(spark, sf_dir, t) for t in ("claims", "members"))
    for tier in ("full", "partial", "none"):
        left = masked(claims, "claims", tier, "s")
        right = masked(members, "members", tier, "s")
        right = right.select(*[F.col(c).alias(f"members_{c}") for c in right.columns])
        expected = left.join(right, F.col("member_id") == F.col("members_member_id"))
        got = joins.deid_join(claims, "claims", members, "members", tier, "s")
        assert rows(got) == rows(expected.select(*got.columns))
    clear = claims.join(members.select("member_id"), "member_id").count()
    assert got.count() == clear > 0


def test_deid_join_of_large_sides(spark, sf_dir, monkeypatch):
    claims, members = (payer_table(spark, sf_dir, t) for t in ("claims", "members"))
    small = rows(joins.deid_join(claims, "claims", members, "members", "none", "s"))
    monkeypatch.setattr(joins, "estimated_bytes", lambda df: 2**60)
    large = joins.deid_join(claims, "claims", members, "members", "none", "s")
    assert "join_slice" in plan(large)
    assert rows(large) == small


def test_deid_join_reads_only_what_is_asked_for(spark, sf_dir):
    claims, members = (payer_table(spark, sf_dir, t) for t in ("claims", "members"))
    joined = joins.deid_join(claims, "claims", members, "members", "none", "s")
    text = plan(joined.select("claim_id"))
    assert "o_totalprice" not in text
    assert "c_acctbal" not in text


def test_orphans_ignore_null(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "pk string")
    assert rows(joins.orphans(child, "fk", parent, "pk")) == [("x", 2)]
