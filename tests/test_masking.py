"""Masked tables, policies, exports and streams."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from veilmark.operators.masking import (
    bind_mask,
    by_partition,
    masked,
    policy_of,
    save_masked,
    write_masked,
)
from veilmark.plans.payer_views import payer_table
from veilmark.sources import model
from veilmark.sources.model import masking_policy
from veilmark.streaming.masked_stream import read_stream, start_masked_export

SALT = "s"


@pytest.mark.parametrize("table", sorted(model.TABLES))
def test_all_tiers_share_one_schema(spark, sf_dir, table):
    df = payer_table(spark, sf_dir, table)
    schemas = [
        [(f.name, f.dataType) for f in masked(df, table, tier, SALT).schema]
        for tier in ("full", "partial", "none")
    ]
    assert schemas[0] == schemas[1] == schemas[2]
    policy = model.TABLES[table].policy
    for name, data_type in schemas[0]:
        if name in policy:
            assert data_type.simpleString() == "string"
        else:
            assert data_type == df.schema[name].dataType


def test_full_tier_is_the_table_as_text(spark, sf_dir):
    df = payer_table(spark, sf_dir, "claims")
    policy = model.CLAIMS.policy
    expected = df.select(
        *[F.col(c).cast("string").alias(c) if c in policy else F.col(c) for c in df.columns]
    )
    assert rows(masked(df, "claims", "full")) == rows(expected)


def test_spelling_does_not_dodge_a_binding(spark):
    df = spark.createDataFrame([("423-55-6789", 1)], "SSN string, n int")
    assert rows(masked(df, "members", "none", SALT, projected=True)) == [("XXX-XX-XXXX", 1)]


def test_hashing_needs_a_salt(spark, sf_dir):
    with pytest.raises(ValueError):
        masked(payer_table(spark, sf_dir, "claims"), "claims", "none")


def test_policy_rows(spark):
    policy = model.masking_policy(spark)
    assert policy.count() == 59
    assert policy_of(policy, "providers") == {
        "tax_id": "mask_tax_id",
        "dea_number": "mask_drug_info",
    }
    changed = bind_mask(policy, "providers", "dea_number", "mask_redact")
    changed = bind_mask(changed, "providers", "phone", "mask_phone")
    assert policy_of(changed, "providers") == {
        "tax_id": "mask_tax_id",
        "dea_number": "mask_redact",
        "phone": "mask_phone",
    }
    df = spark.createDataFrame([("BX1", "502-555-0101")], "dea_number string, phone string")
    assert rows(masked(df, policy_of(changed, "providers"), "partial", projected=True)) == [
        ("REDACTED", "(***) ***-0101")
    ]


def test_filters_and_pruning_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "claims")
    payer_table(spark, sf_dir, "claims").write.parquet(path)
    df = masked(spark.read.parquet(path), "claims", "partial", SALT)
    text = plan(df.where("claim_status = 'Paid'").select("claim_id", "paid_amount"))
    assert "EqualTo(claim_status,Paid)" in text
    read = "claim_id:string,claim_status:string,paid_amount:decimal(12,2)"
    assert f"ReadSchema: struct<{read}>" in text
    assert "Exchange" not in text
    assert "EvalPython" not in text


def test_a_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(0, 300_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("member_id"),
        F.expr("CASE WHEN id % 10 < 8 THEN 'hot' ELSE 'k' || id % 3 END").alias("k"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        out = str(tmp_path / "out")
        write_masked(df, {}, "none", out, partition_by=("k",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(out)
    files = [f.split("k=")[1].split("/")[0] for f in back.inputFiles()]
    assert back.count() == 300_000
    assert files.count("hot") >= 3
    assert files.count("k0") <= 2
    assert "Exchange" not in plan(by_partition(df, ()))


def test_written_copy(spark, sf_dir, tmp_path):
    df = payer_table(spark, sf_dir, "claims")
    path = str(tmp_path / "out")
    for _ in range(2):
        write_masked(df, "claims", "none", path, SALT, partition_by=("claim_status",))
    back = spark.read.parquet(path)
    expected = masked(df, "claims", "none", SALT)
    assert rows(back.select(*expected.columns)) == rows(expected)


def test_bucketed_copies_join_on_the_hash_without_shuffle(spark, sf_dir):
    spark.sql("CREATE SCHEMA IF NOT EXISTS masked_copies")
    for t in ("claims", "members"):
        save_masked(
            payer_table(spark, sf_dir, t), t, "none", f"masked_copies.{t}", SALT, "member_id", 4
        )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("masked_copies.claims").join(
            spark.table("masked_copies.members").select("member_id", "state_code"), "member_id"
        )
        assert "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    clear = payer_table(spark, sf_dir, "claims").join(
        payer_table(spark, sf_dir, "members").select("member_id"), "member_id"
    )
    assert joined.count() == clear.count()


def test_stream_equals_batch_and_continues(spark, sf_dir, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    claims = payer_table(spark, sf_dir, "claims")
    is_even = F.xxhash64("claim_id") % 2 == 0
    for half in (claims.where(is_even), claims.where(~is_even)):
        half.write.mode("append").parquet(source)
        stream = read_stream(spark, source, model.CLAIMS.schema, files_per_batch=1)
        query = start_masked_export(stream, "claims", "partial", out, state, SALT)
        query.awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(masked(claims, "claims", "partial", SALT))


def test_a_binding_without_its_column_is_refused(spark):
    df = spark.createDataFrame([("123-45-6789", 1)], "ssn string, n int")
    with pytest.raises(ValueError, match="snn"):
        masked(df, {"snn": "mask_ssn"}, "none", SALT)
    left_out = masked(df, {"SSN": "mask_ssn", "tax": "mask_tax_id"}, "none", SALT, projected=True)
    assert rows(left_out) == [("XXX-XX-XXXX", 1)]


def test_policy_by_schema(spark):
    policy = masking_policy(spark, schema="a")
    both = bind_mask(policy, "Members", "ssn", "mask_redact", "b")
    assert policy_of(both, "MEMBERS", "B") == {"ssn": "mask_redact"}
    assert policy_of(both, "members", "a") == policy_of(masking_policy(spark), "members")
    again = bind_mask(both, "members", "SSN", "mask_ssn", "b")
    assert policy_of(again, "members", "b") == {"ssn": "mask_ssn"}
    for asked, schema in ((both, None), (masking_policy(spark), "a")):
        with pytest.raises(ValueError, match="schemas"):
            policy_of(asked, "members", schema)


def test_policies_that_would_show_values_are_refused(spark):
    policy = masking_policy(spark)
    with pytest.raises(ValueError, match="binds no column"):
        policy_of(policy, "menbers")
    double = policy.unionByName(
        spark.createDataFrame([("MEMBERS", "SSN", "mask_redact")], policy.schema)
    )
    with pytest.raises(ValueError, match="several functions"):
        policy_of(double, "members")
    assert policy_of(policy.unionByName(policy), "members") == policy_of(policy, "members")


def test_renamed_columns_of_the_model_are_refused(spark, sf_dir):
    members = payer_table(spark, sf_dir, "members").withColumnRenamed("ssn", "ssn_no")
    with pytest.raises(ValueError, match="ssn"):
        masked(members, "members", "none", SALT)
    with pytest.raises(ValueError, match="ssn"):
        write_masked(members, "members", "none", "unused", SALT)
    shown = masked(members, "members", "none", SALT, projected=True)
    assert shown.columns == members.columns
