"""The model's tables, classes, tags and bindings agree with each other."""

from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import rows
from veilmark.functions.masks import MASKS
from veilmark.operators import audit, tags
from veilmark.sources import model


def test_shape_of_the_tables():
    sizes = {name: len(t.columns) for name, t in model.TABLES.items()}
    assert sizes == {
        "members": 33,
        "claims": 34,
        "providers": 25,
        "eligibility": 19,
        "pharmacy_claims": 22,
        "prior_authorizations": 21,
    }
    types = Counter(c.type for t in model.TABLES.values() for c in t.columns)
    assert types == {
        "string": 99,
        "date": 19,
        "timestamp": 12,
        "decimal(12,2)": 7,
        "decimal(10,2)": 7,
        "boolean": 6,
        "int": 4,
    }
    assert {n: t.contains_phi for n, t in model.TABLES.items() if not t.contains_phi} == {
        "providers": False
    }


def test_classes_tags_and_masks_per_column():
    columns = [c for t in model.TABLES.values() for c in t.columns]
    classes = Counter(c.klass for c in columns)
    assert classes == {"Non-sensitive": 95, "Sensitive": 27, "PHI": 26, "PII": 6}
    for c in columns:
        assert bool(c.mask) == bool(c.tags) == (c.klass != "Non-sensitive")
        assert c.mask is None or c.mask in MASKS


def test_tag_counts(spark):
    column_tags = tags.column_tags(spark)
    per_table = {
        r["table_name"]: (r["n_columns"], r["n_tags"])
        for r in column_tags.groupBy("table_name")
        .agg(F.count_distinct("column_name").alias("n_columns"), F.count("*").alias("n_tags"))
        .collect()
    }
    assert per_table == {
        "members": (20, 76),
        "claims": (18, 48),
        "providers": (2, 6),
        "eligibility": (4, 12),
        "pharmacy_claims": (9, 22),
        "prior_authorizations": (6, 18),
    }
    assert tags.table_tags(spark).count() == 12
    assert rows(tags.schema_tags(spark)) == [("health_plan", "compliance", "hipaa")]
    values = {
        (r["tag_name"], r["tag_value"]): r["count"]
        for r in column_tags.groupBy("tag_name", "tag_value").count().collect()
    }
    assert values == {
        ("sensitivity_level", "critical"): 32,
        ("sensitivity_level", "high"): 27,
        ("masking_rule", "redact"): 28,
        ("masking_rule", "full_mask"): 12,
        ("masking_rule", "partial_mask"): 11,
        ("masking_rule", "hash"): 8,
        ("contains_phi", "true"): 26,
        ("contains_pii", "true"): 6,
        ("hipaa_type", "unique_identifier"): 8,
        ("hipaa_type", "date_element"): 7,
        ("hipaa_type", "geographic"): 5,
        ("hipaa_type", "name"): 3,
        ("hipaa_type", "telephone"): 2,
        ("hipaa_type", "health_plan_beneficiary"): 2,
        ("hipaa_type", "ssn"): 1,
        ("hipaa_type", "government_id"): 1,
        ("hipaa_type", "email_address"): 1,
        ("hipaa_type", "tax_id"): 1,
        ("hipaa_type", "medical_record"): 1,
    }


def test_reports_over_the_model(spark):
    schema = model.SCHEMA_NAME
    column_tags, table_tags = tags.column_tags(spark), tags.table_tags(spark)
    assert audit.tables_near_tag_limit(table_tags, schema).count() == 0
    assert audit.tables_near_column_tag_limit(column_tags, schema).count() == 0
    assert audit.tags_with_many_values(column_tags, schema).count() == 0
    assert audit.bad_tag_names(column_tags, schema).count() == 0
    assert {tuple(r) for r in audit.tables_near_tag_limit(table_tags, schema, 1).collect()} == {
        (name, 2) for name in model.TABLES
    }
    assert [
        tuple(r) for r in audit.tables_near_column_tag_limit(column_tags, schema, 20).collect()
    ] == [("members", 76), ("claims", 48), ("pharmacy_claims", 22)]
    assert [tuple(r) for r in audit.tags_with_many_values(column_tags, schema, 1).collect()] == [
        ("hipaa_type", 11),
        ("masking_rule", 4),
        ("sensitivity_level", 2),
    ]
    inventory = [tuple(r) for r in audit.hipaa_inventory(column_tags, schema).collect()]
    assert len(inventory) == 32
    assert inventory == sorted(inventory)
    masking = [tuple(r) for r in audit.masking_inventory(column_tags, schema).collect()]
    assert [r[3] for r in masking] == ["high"] * 27 + ["critical"] * 32
    assert [r[0] for r in masking[:27]] == sorted(r[0] for r in masking[:27])
    assert ("members", "ssn", "full_mask", "critical") in masking
    assert audit.hipaa_inventory(column_tags, "elsewhere").count() == 0


def test_tags_of_the_model_are_valid_and_consistent(spark):
    column_tags = tags.column_tags(spark)
    dictionary = model.data_dictionary(spark)
    assert dictionary.count() == 154
    assert dictionary.where(F.col("column_class").isNull()).count() == 0
    assert tags.tag_value_violations(column_tags).count() == 0
    assert tags.tag_value_violations(tags.table_tags(spark)).count() == 0
    assert tags.tag_value_violations(tags.schema_tags(spark)).count() == 0
    assert tags.naming_violations(column_tags).count() == 0
    assert tags.class_tag_mismatches(dictionary, column_tags).count() == 0
    rules = tags.masking_rules(dictionary, column_tags)
    assert rules.where("masking_rule = 'none'").count() == 95


def test_coverage_of_the_policy(spark):
    column_tags = tags.column_tags(spark)
    assert audit.policy_coverage(column_tags, model.masking_policy(spark)).count() == 0
    without = audit.policy_coverage(column_tags, model.masking_policy(spark, with_redact=False))
    assert rows(without) == [
        ("claims", "procedure_code", "tagged without mask"),
        ("members", "ethnicity", "tagged without mask"),
        ("members", "race", "tagged without mask"),
        ("prior_authorizations", "denial_reason", "tagged without mask"),
        ("prior_authorizations", "procedure_code", "tagged without mask"),
    ]


def test_class_is_read_from_the_second_sentence(spark):
    cases = [
        ("Two letters. Non-sensitive - a state is not PHI.", "Non-sensitive"),
        ("Code (e.g., HMO, A.B). PHI - identifier.", "PHI"),
        ("Number. PII. Must be masked. PHI.", "PII"),
        ("Amount. Sensitive financial.", "Sensitive"),
        ("PHI without a class", None),
        ("One. Two. PHI.", None),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame(cases, "comment string, expected string")
    for r in model.with_class(df).collect():
        assert r["column_class"] == r["expected"], r


def test_properties(spark):
    assert model.table_properties(spark).count() == 18
    assert model.PROVIDERS.properties == {
        "quality": "gold",
        "domain": "provider",
        "phi_contains": "false",
    }
