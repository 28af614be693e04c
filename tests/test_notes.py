"""Notes without their member's names, against a regular expression per row."""

import re

import pytest

from tests.conftest import plan, rows
from veilmark.operators.notes import notes_linked

MEMBERS = [
    ("m1", "Ana", "O'Neil"),
    ("m1", "Ann", "O'Neil"),
    ("m2", "Jörg", "de la Cruz"),
    ("m3", "A", None),
    ("m4", None, "C++ (x)"),
    (None, "Nobody", "Known"),
]
NOTES = [
    (1, "m1", "ANA o'neil and Anabel; O'NEIL, ana; ann. Bananas, ana1, _ana_"),
    (2, "m2", "seen jörg DE  LA\ncruz, JÖRG; jörgen stays, la cruz too"),
    (3, "m3", "a note by A about a"),
    (4, "m4", "knows c++ (X) but not C+ (x)"),
    (5, None, "Nobody known"),
    (6, "m9", "ana, 123-45-6789 and John Smith"),
    (7, "m1", None),
    (8, "m1", ""),
]


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffled"])
def sides(spark, request):
    if not request.param:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    notes = spark.createDataFrame(NOTES, "auth_id int, member_id string, clinical_notes string")
    yield notes, spark.createDataFrame(MEMBERS, "member_id string, first_name string, last_name string")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_names_of_the_very_member(sides):
    got = {r["auth_id"]: r["clinical_notes"] for r in notes_linked(*sides, "partial").collect()}
    assert got == {
        1: "[NAME] and Anabel; [NAME]; [NAME]. Bananas, ana1, _[NAME]_",
        2: "seen [NAME] [NAME]; jörgen stays, la cruz too",
        3: "a note by A about a",
        4: "knows [NAME] but not C+ (x)",
        5: "Nobody known",
        6: "ana, [SSN] and [NAME]",
        7: None,
        8: "",
    }


def test_recall_of_planted_names(spark):
    """Every planted name in any case goes; a misspelled one stays."""
    names = [(f"m{i}", f"First{i}", f"van Last{i}") for i in range(40)]
    cases = [str.lower, str.upper, str.title, str.swapcase]
    notes = [
        (i * 10 + j, m, f"x {case(first)} y, {case(last)}; {case(first + ' ' + last)} {first[:-1]}q")
        for i, (m, first, last) in enumerate(names)
        for j, case in enumerate(cases)
    ]
    found = notes_linked(
        spark.createDataFrame(notes, "auth_id int, member_id string, clinical_notes string"),
        spark.createDataFrame(names, "member_id string, first_name string, last_name string"),
        "partial",
    )
    texts = [r["clinical_notes"] for r in found.collect()]
    assert not any(re.search(r"(?i)first\d+\b(?!q)|last\d", t) for t in texts)
    assert all(t.count("[NAME]") == 3 and t.endswith("q") for t in texts)


def test_other_tiers_join_nothing(sides):
    notes, members = sides
    for tier in ("full", "none"):
        df = notes_linked(notes, members, tier)
        assert "Join" not in plan(df)
        assert df.columns == notes.columns
    assert rows(notes_linked(notes, members, "full")) == rows(notes)
    assert notes_linked(notes.where("false"), members, "partial").count() == 0
