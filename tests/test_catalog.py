"""The live catalog against the model."""

from tests.conftest import rows
from veilmark.operators import catalog
from veilmark.sources import ingest, model


def test_a_fresh_deployment_has_no_drift(spark):
    ingest.create_schema(spark, "gov_fresh")
    for table in model.TABLES:
        ingest.replace_table(spark, table, schema="gov_fresh")
    assert rows(catalog.catalog_drift(spark, "gov_fresh")) == []
    listed = catalog.live_columns(spark, "gov_fresh")
    wanted = model.data_dictionary(spark).select(*listed.columns)
    assert rows(listed) == rows(wanted)
    properties = catalog.live_properties(spark, "gov_fresh").where("property <> 'comment'")
    known = model.table_properties(spark).select("table_name", "property", "value")
    assert rows(properties.join(known, ["table_name", "property", "value"])) == rows(known)


def test_drift_of_types_places_and_tables(spark):
    ingest.create_schema(spark, "gov_drift")
    spark.sql("CREATE TABLE gov_drift.members (subscriber_id INT, member_id STRING) USING parquet")
    spark.sql("CREATE VIEW gov_drift.claims AS SELECT 1 AS claim_id")
    found = rows(catalog.catalog_drift(spark, "gov_drift").where("fact <> 'comment'"))
    assert ("members", "member_id", "position", "1", "2") in found
    assert ("members", "subscriber_id", "type", "string", "int") in found
    assert ("members", "ssn", "column", "ssn", None) in found
    assert ("claims", None, "table", "claims", None) in found
    assert ("members", "quality", "property", "gold", None) in found
    assert sum(r[2] == "table" for r in found) == 5


def test_an_empty_schema(spark):
    ingest.create_schema(spark, "gov_nothing")
    found = rows(catalog.catalog_drift(spark, "gov_nothing"))
    assert [r[2] for r in found] == ["table"] * 6
    assert catalog.live_columns(spark, "gov_nothing").count() == 0
