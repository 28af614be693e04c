from datetime import date

from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_masks import hid
from veilmark.functions import safe_harbor as sh
from veilmark.functions.masks import hash_identifier
from veilmark.operators.audit import (
    retention_report,
    tag_value_sketches,
    tags_with_many_values_sketched,
)
from veilmark.operators.tags import table_tags


def test_ages_of_ninety_and_over(spark):
    df = spark.createDataFrame(
        [(date(1936, 12, 3),), (date(1936, 12, 4),), (date(1900, 1, 1),), (None,)], "d date"
    )
    as_of = date(2026, 12, 3)
    shown = [sh.capped_birth_date("d", t, as_of).alias(t) for t in ("full", "partial", "none")]
    assert [tuple(r) for r in df.select(*shown).collect()] == [
        ("1936-12-03", "90+", "90+"),
        ("1936-12-04", "1936-12", "1936-XX-XX"),
        ("1900-01-01", "90+", "90+"),
        (None, None, None),
    ]


def test_leap_day_birthday(spark):
    df = spark.createDataFrame([(date(1936, 2, 29),)], "d date")
    for as_of, label in ((date(2026, 2, 28), "1936-02"), (date(2026, 3, 1), "90+")):
        assert df.select(sh.capped_birth_date("d", "partial", as_of)).first()[0] == label


def test_zip3(spark):
    df = spark.createDataFrame(
        [(1, "40202"), (2, "99901"), (3, "12"), (4, None), (5, "abc99")], "id int, zip string"
    )
    people = spark.createDataFrame(
        [("402", 20_000), ("402", 5), ("999", 19_999), ("12", 50_000), ("abc", 50_000)],
        "zip3 string, population long",
    )
    out = sh.zip3_by_population(df, "zip", "partial", people)
    assert rows(out) == [(1, "402**"), (2, "000**"), (3, "000**"), (4, None), (5, "000**")]
    assert rows(sh.zip3_by_population(df, "zip", "none", people)) == [
        (i, "XXXXX") for i in range(1, 6)
    ]


def test_rotation(spark):
    df = spark.createDataFrame([("M-1",), ("M-1",), ("M-2",), (None,)], "id string")
    crosswalk = sh.salt_crosswalk(df, "id", "old", "new")
    assert rows(crosswalk) == sorted(
        (hid(i, "old"), hid(i, "new")) for i in ("M-1", "M-2")
    )
    extra = df.unionAll(spark.createDataFrame([("M-9",)], "id string"))
    hashed = extra.select(
        hash_identifier("id", "none", "old").alias("hid"), extra["id"].alias("clear")
    )
    moved = sh.rekey(hashed, "hid", crosswalk, ["clear"])
    assert rows(moved) == sorted(
        [
            (hid("M-1", "new"), "M-1"),
            (hid("M-1", "new"), "M-1"),
            (hid("M-2", "new"), "M-2"),
            (None, "M-9"),
            (None, None),
        ],
        key=repr,
    )


def test_drg(spark):
    df = spark.createDataFrame([(1, "291"), (2, "999"), (3, None)], "id int, drg string")
    lookup = spark.createDataFrame(
        [("291", "MDC 05"), ("291", "MDC 05"), ("x", "MDC 00")], "drg_code string, mdc string"
    )
    assert rows(sh.drg_category(df, "drg", "partial", lookup)) == [
        (1, "MDC 05"),
        (2, "REDACTED"),
        (3, None),
    ]
    assert rows(sh.drg_category(df, "drg", "none", lookup, "mdc").select("mdc")) == [
        ("REDACTED",)
    ] * 3
    assert rows(sh.drg_category(df, "drg", "full", lookup)) == rows(df)


def test_drg_codes_of_other_forms_and_contradictions(spark):
    df = spark.createDataFrame(
        [(1, "MS-291"), (2, "292"), (3, "293"), (4, None), (5, "293")], "id int, drg string"
    )
    lookup = spark.createDataFrame(
        [("MS-291", "MDC 05"), ("292", "MDC 05"), ("292", "MDC 06"), (None, "MDC 00")],
        "drg_code string, mdc string",
    )
    assert rows(sh.drg_category(df, "drg", "partial", lookup)) == [
        (1, "MDC 05"),
        (2, "REDACTED"),
        (3, "REDACTED"),
        (4, None),
        (5, "REDACTED"),
    ]
    assert rows(sh.lookup_report(df, "drg", lookup, "drg_code", "mdc")) == [
        ("292", "several values", 2),
        ("293", "not listed", 2),
    ]


def test_retention_of_one_schema_and_the_longest(spark):
    day = spark.createDataFrame([(date(2018, 1, 1),)], "d date")
    tag = "schema_name string, table_name string, tag_name string, tag_value string"
    tags = spark.createDataFrame(
        [
            ("a", "t", "retention", "7_year"),
            ("a", "t", "retention", "10_year"),
            ("b", "t", "retention", "1_year"),
            ("b", "t", "retention", "indefinite"),
        ],
        tag,
    )
    for schema, expected in (("a", "10_year"), ("b", "indefinite")):
        report = retention_report({"t": (day, "d")}, tags, date(2026, 12, 3), schema)
        assert [(r["retention"], r["n_expired"]) for r in report.collect()] == [(expected, 0)]


def test_retention(spark):
    claims = spark.createDataFrame(
        [(date(2016, 12, 2),), (date(2016, 12, 3),), (date(2020, 1, 1),), (None,)], "d date"
    )
    unknown = spark.createDataFrame([(date(1990, 1, 1),)], "d date")
    report = retention_report(
        {"claims": (claims, "d"), "members": (claims, "d"), "scratch": (unknown, "d")},
        table_tags(spark),
        date(2026, 12, 3),
    )
    assert rows(report) == [
        ("claims", "10_year", date(2016, 12, 3), 4, 1),
        ("members", "7_year", date(2019, 12, 3), 4, 2),
        ("scratch", None, None, 1, 0),
    ]


def chain(spark, *steps):
    kind = "salt_version int, old_hid string, next_version int, new_hid string"
    return spark.createDataFrame(list(steps), kind)


def test_hashes_of_many_salts_move_at_once(spark):
    last = 9
    steps = [(v, f"a{v}", v + 1, f"a{v + 1}") for v in range(last)]
    steps += [(v, f"b{v}", v + 1, f"b{v + 1}") for v in range(last) if v != 4]  # breaks off
    steps += [(0, "c0", 7, "c7"), (7, "c7", 9, "c9")]  # skips versions
    steps += [(3, "d3", 4, "d4"), (3, "d3", 4, "e4"), (4, "d4", 9, "d9")]  # two successors
    steps += [(5, "a5", 6, "a6"), (2, None, 9, "x"), (2, "f2", 9, None), (6, "g6", 6, "g9")]
    found = rows(sh.latest_crosswalk(chain(spark, *steps), last))
    expected = [(v, f"a{v}", "a9") for v in range(last)]
    expected += [(v, f"b{v}", "b9") for v in range(5, last)]
    expected += [(0, "c0", "c9"), (7, "c7", "c9"), (4, "d4", "d9")]
    assert found == sorted(expected, key=repr)

    held = [(1, "a0", 0), (2, "a8", 8), (3, "z9", 9), (4, "b3", 3), (5, "a5", None), (6, None, 2)]
    df = spark.createDataFrame(held, "id int, hid string, salt int")
    moved = sh.rekey_versions(df, "hid", "salt", chain(spark, *steps), last, ["id"])
    assert rows(moved) == [
        (1, "a9", 9), (2, "a9", 9), (3, "z9", 9), (4, None, 9), (5, None, 9), (6, None, 9)
    ]
    nothing = chain(spark).where("false")
    assert rows(sh.rekey_versions(df, "hid", "salt", nothing, last, ["id"]))[2] == (3, "z9", 9)


def test_sketches_of_days(spark):
    """Exact for few values, within three standard errors for many, day by day."""
    log = spark.range(60_000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN 'other' ELSE 'health_plan' END AS schema_name",
        "CASE WHEN id % 3 = 0 THEN 'few' ELSE 'many' END AS tag_name",
        "CAST(CASE WHEN id % 3 = 0 THEN id % 180 ELSE id % 20011 END AS STRING) AS tag_value",
        "timestamp_seconds(id * 60) AS ts",
    )
    sketches = tag_value_sketches(log, "ts")
    assert sketches.select("day").distinct().count() == 42
    found = {r[0]: r[1] for r in tags_with_many_values_sketched(sketches).collect()}
    exact = {
        r["tag_name"]: r["n"]
        for r in log.where("schema_name = 'health_plan'")
        .groupBy("tag_name")
        .agg(F.count_distinct("tag_value").alias("n"))
        .collect()
    }
    assert found["few"] == exact["few"] == 60
    assert 0 < abs(found["many"] - exact["many"]) < 3 * 0.01625 * exact["many"]
    assert tags_with_many_values_sketched(sketches, limit=60).count() == 1
