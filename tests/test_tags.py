from datetime import datetime

from tests.conftest import rows
from veilmark.operators import audit, tags

TAG = "tag_name string, tag_value string"
COLUMN = f"schema_name string, table_name string, column_name string, {TAG}"


def test_set_tags_overwrites_and_adds(spark):
    current = spark.createDataFrame([("g", "t", "c", "masking_rule", "none")], COLUMN)
    after = tags.set_column_tags(
        current, "g", "t", "c", {"masking_rule": "hash", "contains_phi": "true"}
    )
    again = tags.set_column_tags(
        after, "g", "t", "c", {"masking_rule": "hash", "contains_phi": "true"}
    )
    assert rows(after) == rows(again) == [
        ("g", "t", "c", "contains_phi", "true"),
        ("g", "t", "c", "masking_rule", "hash"),
    ]
    table = spark.createDataFrame([], f"schema_name string, table_name string, {TAG}")
    assert rows(tags.set_table_tags(table, "g", "t", {"retention": "7_year"})) == [
        ("g", "t", "retention", "7_year")
    ]
    schema = spark.createDataFrame([("g", "compliance", "sox")], f"schema_name string, {TAG}")
    assert rows(tags.set_schema_tags(schema, "g", {"compliance": "hipaa"})) == [
        ("g", "compliance", "hipaa")
    ]


def test_violations(spark):
    df = spark.createDataFrame(
        [
            ("g", "t", "c", "masking_rule", "hash"),
            ("g", "t", "c", "masking_rule", "Hash"),
            ("g", "t", "c", "masking_rule", None),
            ("g", "t", "c", "hipaa_type", "anything goes"),
            ("g", "t", "c", "Owner", "x"),
        ],
        COLUMN,
    )
    assert rows(tags.tag_value_violations(df).select("tag_value")) == [("Hash",), (None,)]
    assert rows(tags.naming_violations(df).select("tag_name", "tag_value")) == [
        ("Owner", "x"),
        ("hipaa_type", "anything goes"),
        ("masking_rule", "Hash"),
    ]
    assert rows(audit.bad_tag_names(df, "g")) == [("Owner",)]
    assert rows(audit.bad_tag_names(df, None)) == [("Owner",)]


def test_inheritance(spark):
    tables = spark.createDataFrame(
        [("g", "old"), ("g", "new"), ("h", "other")], "schema_name string, table_name string"
    )
    own = spark.createDataFrame(
        [("g", "old", "compliance", "sox"), ("g", "old", "retention", "7_year")],
        "schema_name string, table_name string, tag_name string, tag_value string",
    )
    schema = spark.createDataFrame(
        [("g", "compliance", "hipaa")], "schema_name string, tag_name string, tag_value string"
    )
    assert rows(tags.effective_table_tags(tables, own, schema)) == [
        ("g", "new", "compliance", "hipaa", True),
        ("g", "old", "compliance", "sox", False),
        ("g", "old", "retention", "7_year", False),
    ]


def test_class_mismatches(spark):
    dictionary = spark.createDataFrame(
        [
            ("g", "t", "ok", "PHI"),
            ("g", "t", "untagged", "PII"),
            ("g", "t", "plain", "Non-sensitive"),
            ("g", "t", "overtagged", "Non-sensitive"),
            ("g", "t", "unclear", None),
        ],
        "schema_name string, table_name string, column_name string, column_class string",
    )
    df = spark.createDataFrame(
        [
            ("g", "t", "ok", "contains_phi", "true"),
            ("g", "t", "overtagged", "masking_rule", "hash"),
            ("g", "t", "gone", "contains_pii", "true"),
        ],
        COLUMN,
    )
    assert rows(tags.class_tag_mismatches(dictionary, df)) == [
        ("g", "t", "gone", False, None, "PII"),
        ("g", "t", "overtagged", True, "Non-sensitive", "Sensitive"),
        ("g", "t", "unclear", True, None, "Non-sensitive"),
        ("g", "t", "untagged", True, "PII", "Non-sensitive"),
    ]
    found = dict(tags.masking_rules(dictionary, df).select("column_name", "masking_rule").collect())
    assert found == {
        "ok": "none",
        "untagged": "none",
        "plain": "none",
        "overtagged": "hash",
        "unclear": "none",
        "gone": "none",
    }


def test_log_of_assignments(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS tag_log")
    for day, value in ((2, "hash"), (1, "none"), (3, "redact")):
        row = spark.createDataFrame([("g", "t", "c", "masking_rule", value)], COLUMN)
        tags.append_assignments(row, "tag_log.column_tags", datetime(2026, 1, day))
    log = spark.table("tag_log.column_tags")
    now = tags.latest_tags(log, ["assigned_at"], tags.COLUMN_KEYS)
    assert rows(now) == [("g", "t", "c", "masking_rule", "redact")]
    earlier = log.where("assigned_at < '2026-01-03'")
    then = tags.latest_tags(earlier, ["assigned_at"], tags.COLUMN_KEYS)
    assert rows(then) == [("g", "t", "c", "masking_rule", "hash")]


def test_policy_of_two_schemas(spark):
    tags_of = spark.createDataFrame(
        [("a", "t", "c", "contains_phi", "true"), ("b", "t", "d", "contains_phi", "true")],
        f"schema_name string, table_name string, column_name string, {TAG}",
    )
    bound = spark.createDataFrame(
        [("a", "t", "d"), ("b", "t", "d")],
        "schema_name string, table_name string, column_name string",
    )
    assert rows(audit.policy_coverage(tags_of, bound)) == [
        ("a", "t", "c", "tagged without mask"),
        ("a", "t", "d", "mask without tag"),
    ]
    without = bound.where("schema_name = 'a'").drop("schema_name")
    assert rows(audit.policy_coverage(tags_of, without, "b")) == []
