"""Groups within groups against a walk through the graph."""

import pytest

from tests.conftest import rows
from veilmark.operators.groups import granting_groups, nested_group_tiers

EDGES = [
    ("a", "phi_full_access"),
    ("b", "a"),
    ("b", "b"),
    ("c", "b"),
    ("a", "c"),  # a circle that reaches a grant
    ("d", "phi_partial_access"),
    ("d", "e"),
    ("e", "d"),
    ("f", "e"),
    ("f", "c"),
    ("x", "y"),
    ("y", "x"),  # one that reaches none
    ("phi_partial_access", "g"),
    (None, "a"),
    ("h", None),
    ("PHI_full_access", "other"),
    *[("wide", f"w{i}") for i in range(50)],
    *[(f"n{i}", "phi_partial_access") for i in range(300)],
]
HELD = [
    ("ana", "c"), ("ben", "e"), ("cy", "f"), ("dee", "x"), ("eli", None), ("flo", "unknown"),
    ("gus", "phi_partial_access"), ("gus", "b"), ("hal", "n7"), ("ida", "PHI_full_access"),
    ("jo", "wide"), ("kim", "g"),
]


@pytest.fixture(scope="module")
def nested(spark):
    return spark.createDataFrame(EDGES, "group_name string, parent_group string")


def test_nested_tiers(spark, nested):
    held = spark.createDataFrame(HELD, "principal string, group_name string")
    assert dict(rows(nested_group_tiers(held, nested))) == {
        "ana": "full", "ben": "partial", "cy": "full", "dee": "none", "eli": "none",
        "flo": "none", "gus": "full", "hal": "partial", "ida": "none", "jo": "none",
        "kim": "none",
    }


def test_granting_groups_by_walking(nested):
    found = set()
    for name in {e[0] for e in EDGES if e[0]} | {"phi_full_access", "phi_partial_access"}:
        seen, todo = set(), [name]
        while todo:
            at = todo.pop()
            if at is not None and at not in seen:
                seen.add(at)
                todo += [p for g, p in EDGES if g == at]
        found |= {(name, t) for t in ("full", "partial") if f"phi_{t}_access" in seen}
    assert rows(granting_groups(nested)) == sorted(found, key=repr)


def test_too_deep_is_an_error(spark):
    chain = [("g0", "phi_full_access")] + [(f"g{i + 1}", f"g{i}") for i in range(4)]
    deep = spark.createDataFrame(chain, "group_name string, parent_group string")
    assert granting_groups(deep, 6).count() == 7
    with pytest.raises(RuntimeError, match="nested"):
        granting_groups(deep, 4)


def test_no_groups(spark, nested):
    none = nested.where("false")
    held = spark.createDataFrame(HELD, "principal string, group_name string")
    assert dict(rows(nested_group_tiers(held, none)))["gus"] == "partial"
    assert nested_group_tiers(held.where("false"), nested).count() == 0
