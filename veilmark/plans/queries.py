"""The registered queries: every operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.functions import sql_functions
from veilmark.functions.masks import MASKS, apply_mask, hash_identifier
from veilmark.functions.safe_harbor import (
    capped_birth_date,
    drg_category,
    lookup_report,
    rekey,
    rekey_versions,
    salt_crosswalk,
    zip3_by_population,
)
from veilmark.functions.sql_functions import register_functions
from veilmark.functions.tiers import FULL_GROUP, PARTIAL_GROUP, TIERS, group_tiers
from veilmark.operators import audit, catalog, dated, groups, joins, tags
from veilmark.operators.masking import bind_mask, masked, policy_of, write_masked
from veilmark.operators.notes import notes_linked
from veilmark.operators.retention import purge
from veilmark.plans import analytics
from veilmark.plans.dated_views import SALT_VERSIONS, dated_view
from veilmark.plans.payer_views import (
    BROKEN_CSV,
    DAMAGED_CSV,
    DAMAGED_JSON,
    OPEN_CSV,
    csv_line,
    damaged,
    json_line,
    payer_table,
    read,
)
from veilmark.plans.tag_views import tag_view
from veilmark.session import kept, prepare, scratch_path
from veilmark.sources import ingest
from veilmark.sources.model import FOREIGN_KEYS, TABLES, masking_policy, with_class
from veilmark.streaming.masked_stream import read_stream, start_masked_export

Query = Callable[[SparkSession, str], DataFrame]

SALT = "test_salt"
NEW_SALT = "next_test_salt"
AS_OF = date(2026, 12, 3)
PURGED_BEFORE = date(1996, 5, 17)
EXACT_VALUES = 100

# Query -> (payer table, key column, masked columns).
MASK_QUERIES = {
    "mask_ssn": ("members", "member_id", ("ssn", "drivers_license")),
    "mask_name": ("members", "member_id", ("first_name", "last_name", "middle_initial")),
    "mask_email": ("members", "member_id", ("email",)),
    "mask_phone": ("members", "member_id", ("phone_home", "phone_mobile")),
    "mask_date_of_birth": (
        "claims",
        "claim_id",
        ("service_date_from", "service_date_to", "admission_date", "discharge_date"),
    ),
    "mask_zip_code": ("members", "member_id", ("zip_code",)),
    "mask_address": (
        "members",
        "member_id",
        ("address_line1", "address_line2", "city", "county"),
    ),
    "hash_identifier": ("claims", "claim_id", ("member_id", "subscriber_id")),
    "mask_financial_amount": (
        "claims",
        "claim_id",
        (
            "billed_amount",
            "allowed_amount",
            "paid_amount",
            "member_liability",
            "copay_amount",
            "coinsurance_amount",
            "deductible_amount",
        ),
    ),
    "mask_diagnosis_code": (
        "claims",
        "claim_id",
        ("diagnosis_code_primary", "diagnosis_code_2", "diagnosis_code_3", "drg_code"),
    ),
    "mask_drug_info": ("pharmacy_claims", "rx_claim_id", ("ndc_code", "drug_name", "drug_class")),
    "mask_clinical_notes": ("prior_authorizations", "auth_id", ("clinical_notes",)),
    "mask_tax_id": ("providers", "provider_id", ("tax_id",)),
    "mask_beneficiary_id": (
        "members",
        "member_id",
        ("medicare_beneficiary_id", "medicaid_id"),
    ),
    "mask_redact": ("members", "member_id", ("race", "ethnicity")),
}

# Bindings of the providers' columns that change after deployment.
NEW_BINDINGS = {"npi": "hash_identifier", "tax_id": "mask_redact"}

DRG_LOOKUP = {
    "drg_code": "CASE WHEN n_nationkey < 3 THEN 'MS-' ELSE '' END "
    "|| CAST(n_nationkey + 100 AS STRING)",
    "mdc": "'MDC ' || CAST(n_regionkey AS STRING)",
}

# Text columns of the raw rows that do not fit their type now and then.
SPOILED = {
    "effective_date": ("effective_date = '2020-01-08'", "'08.01.2020 '"),
    "cobra_flag": ("group_number = 'GRP-9'", "'maybe'"),
    "premium_amount": ("group_number = 'GRP-7'", "'12,50 EUR'"),
}


def as_text(df: DataFrame) -> DataFrame:
    """Dates, times, decimals, flags and integers as text, for comparison."""
    return df.selectExpr(
        *[
            f.name if f.dataType == T.StringType() else f"CAST({f.name} AS STRING) AS {f.name}"
            for f in df.schema
        ]
    )


def _mask_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    table, key, columns = MASK_QUERIES[name]
    shown = [
        apply_mask(name, c, tier, SALT).alias(f"{c}_{tier}") for c in columns for tier in TIERS
    ]
    key_column = F.col(key).alias("key")
    return payer_table(spark, sf_dir, table).select(key_column, *shown)


def _masked_table(table: str, tier: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(masked(payer_table(spark, sf_dir, table), table, tier, SALT))


def _masked_by_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims masked by a tier that differs from row to row."""
    claims = payer_table(spark, sf_dir, "claims")
    tier = F.when(F.col("claim_status") == "Paid", "full").when(
        F.col("claim_status") == "Denied", "partial"
    ).otherwise("unknown")
    rows = masked(claims, "claims", tier, SALT)
    return rows.select(
        "claim_id", "member_id", "service_date_from", "diagnosis_code_primary", "paid_amount"
    )


def _sql_masks(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL functions over a table and all tiers, called from SQL expressions."""
    register_functions(spark, SALT)
    calls = [
        F.expr(f"{function}({column}, '{tier}')").alias(f"{column}_{tier}")
        for column, function in TABLES[table].policy.items()
        for tier in TIERS
    ]
    key = F.col(TABLES[table].key).alias("key")
    return payer_table(spark, sf_dir, table).select(key, *calls)


def _masked_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers masked by policy rows, with one binding added and one replaced."""
    policy = masking_policy(spark)
    for column, function in NEW_BINDINGS.items():
        policy = bind_mask(policy, "providers", column, function)
    providers = payer_table(spark, sf_dir, "providers")
    return as_text(masked(providers, policy_of(policy, "providers"), "partial", SALT))


def _masked_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of one name in two schemas, masked by one policy that names both."""
    policy = masking_policy(spark, schema="health_plan")
    for column, function in NEW_BINDINGS.items():
        policy = bind_mask(policy, "providers", column, function, "sandbox")
    providers = payer_table(spark, sf_dir, "providers")
    found = [
        masked(providers, policy_of(policy, "PROVIDERS", schema), "none", SALT).select(
            F.lit(schema).alias("schema_name"), "provider_id", "npi", "tax_id", "dea_number"
        )
        for schema in ("health_plan", "sandbox")
    ]
    return found[0].unionByName(found[1])


def _masked_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A masked copy written twice to one place and read back."""
    path = scratch_path(spark, "masked-eligibility")
    rows = payer_table(spark, sf_dir, "eligibility")
    for _ in range(2):
        write_masked(rows, "eligibility", "partial", path, SALT)
    return as_text(spark.read.parquet(path))


def _masked_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders masked while they stream from files to files."""
    policy = {"o_custkey": "hash_identifier", "o_totalprice": "mask_financial_amount"}
    # A pattern, as a streaming source takes a plain path for a folder.
    source = f"{sf_dir}/{{orders}}.parquet"
    schema = read(spark, sf_dir, "orders").schema
    path = scratch_path(spark, "masked-orders")
    query = start_masked_export(
        read_stream(spark, source, schema),
        policy,
        "partial",
        f"{path}/rows",
        f"{path}/checkpoint",
        SALT,
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{path}/rows")
    return rows.select(F.col("o_orderkey").alias("key"), "o_custkey", "o_totalprice")


def _masked_view(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored view over a stored table, by functions stored beside them."""
    schema = _own_schema(spark)
    ingest.replace_table(spark, table, payer_table(spark, sf_dir, table), schema)
    register_functions(spark, SALT, schema)
    view = sql_functions.create_masked_views(spark, table, schema, ("partial",))[0]
    return as_text(spark.table(view))


SHOWN = "claim_id, {} AS service_date_from, {} AS diagnosis_code_primary, {} AS member_id"


def _claims_by_reader(spark: SparkSession, sf_dir: str, readers: dict, tier: str) -> DataFrame:
    """Claims as one SQL text shows them to one reader after another."""
    payer_table(spark, sf_dir, "claims").createOrReplaceTempView("veilmark_claims")
    calls = [
        f"{function}({column}{tier})"
        for function, column in (
            ("mask_date_of_birth", "service_date_from"),
            ("mask_diagnosis_code", "diagnosis_code_primary"),
            ("hash_identifier", "member_id"),
        )
    ]
    found = None
    for reader, become in readers.items():
        become()
        text = f"SELECT '{reader}' AS reader, {SHOWN.format(*calls)} FROM veilmark_claims"
        rows = spark.sql(text)
        found = rows if found is None else found.unionByName(rows)
    spark.catalog.dropTempView("veilmark_claims")
    return found


def _group_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL functions that ask for the groups of the session themselves."""
    register_functions(spark, SALT)
    sql_functions.register_group_function(spark)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION reader_tier() RETURNS STRING RETURN CASE "
        f"WHEN is_account_group_member('{FULL_GROUP}') THEN 'full' "
        f"WHEN is_account_group_member('{PARTIAL_GROUP}') THEN 'partial' ELSE 'none' END"
    )
    held = {
        "ana": [PARTIAL_GROUP, FULL_GROUP],
        "ben": ["analysts", PARTIAL_GROUP],
        "cy": ["PHI_FULL_ACCESS"],
        "dee": [],
    }
    readers = {
        name: partial(sql_functions.set_session_groups, spark, names)
        for name, names in held.items()
    }
    return _claims_by_reader(spark, sf_dir, readers, ", reader_tier()")


def _session_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL functions that follow the tier of the session."""
    sql_functions.register_session_functions(spark, SALT)
    readers = {
        tier: partial(sql_functions.set_session_tier, spark, tier)
        for tier in ("full", "partial", "none", "boss")
    }
    return _claims_by_reader(spark, sf_dir, readers, "")


def _deployed(spark: SparkSession, sf_dir: str) -> str:
    """All tables of the model, loaded from the test tables."""
    schema = _own_schema(spark)
    for table in TABLES:
        ingest.replace_table(spark, table, payer_table(spark, sf_dir, table), schema)
    return schema


def _table_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties and row count of every stored table, read back from the catalog."""
    schema = _deployed(spark, sf_dir)
    counts = [
        spark.table(f"`{schema}`.`{t}`").agg(F.lit(t).alias("counted"), F.count("*").alias("n_rows"))
        for t in TABLES
    ]
    known = F.col("property").isin("quality", "domain", "phi_contains", "comment")
    properties = catalog.live_properties(spark, schema).where(known)
    rows = reduce(DataFrame.unionByName, counts)
    return properties.join(rows, F.col("table_name") == F.col("counted")).drop("counted")


def _catalog_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog against the model after somebody has changed it by hand."""
    schema = _deployed(spark, sf_dir)
    for change in (
        "ALTER TABLE {}.members ALTER COLUMN ssn COMMENT 'A number'",
        "ALTER TABLE {}.claims ADD COLUMN note STRING",
        "ALTER TABLE {}.claims SET TBLPROPERTIES ('quality' = 'bronze')",
        "ALTER TABLE {}.providers UNSET TBLPROPERTIES ('domain')",
        "COMMENT ON TABLE {}.eligibility IS 'Spans'",
        "DROP TABLE {}.pharmacy_claims",
    ):
        spark.sql(change.format(f"`{schema}`"))
    return catalog.catalog_drift(spark, schema)


def _notes_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = payer_table(spark, sf_dir, "members")
    notes = dated_view(spark, sf_dir, "linked_notes")
    return notes_linked(notes, members, "partial")


def _raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return as_text(payer_table(spark, sf_dir, table))


def _load(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, table).drop(*ingest.STAMPS)
    typed = ingest.checked(raw, table, datetime(2025, 6, 1))
    return as_text(ingest.accepted(typed))


def _spoiled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, "eligibility")
    for column, (condition, text) in SPOILED.items():
        raw = raw.withColumn(
            column, F.when(F.expr(condition), F.expr(text)).otherwise(F.col(column))
        )
    return ingest.checked(raw, "eligibility")


def _ingest_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(ingest.accepted(_spoiled_rows(spark, sf_dir)))


def _ingest_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.rejected(_spoiled_rows(spark, sf_dir))
    return rows.select("eligibility_id", F.col(ingest.REASONS).alias("reasons"))


def _raw_file(spark: SparkSession, sf_dir: str, line: str, damage: tuple) -> str:
    """All eligibility rows as lines of text, some of them damaged."""
    path = scratch_path(spark, "raw-eligibility")
    rows = _raw(spark, sf_dir, "eligibility").withColumn("line", F.expr(line))
    rows.select(F.expr(damaged(damage)).alias("value")).write.text(path)
    return path


def _csv_file(spark: SparkSession, sf_dir: str, damage: tuple) -> str:
    condition, text, broken = BROKEN_CSV
    split = (condition, "", f"replace(line, {text}, {broken})")
    return _raw_file(spark, sf_dir, csv_line("eligibility"), (*damage, split))


def _refused(raw: DataFrame) -> DataFrame:
    rows = ingest.rejected(ingest.checked(raw, "eligibility"))
    return rows.select(F.col(ingest.REASONS).alias("reasons"), ingest.RECORD)


def _load_csv_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a CSV file with quoted line breaks, short and long records left out."""
    path = _csv_file(spark, sf_dir, DAMAGED_CSV)
    raw = ingest.read_csv(spark, "eligibility", path, quoted_newlines=True)
    return as_text(ingest.accepted(ingest.checked(raw, "eligibility")))


def _load_csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short, long, unclosed and broken lines of a CSV file."""
    path = _csv_file(spark, sf_dir, (*DAMAGED_CSV, OPEN_CSV))
    return _refused(ingest.read_csv(spark, "eligibility", path))


def _json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _raw_file(spark, sf_dir, json_line("eligibility"), DAMAGED_JSON)
    return ingest.read_json(spark, "eligibility", path)


def _load_json_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(ingest.accepted(ingest.checked(_json_rows(spark, sf_dir), "eligibility")))


def _load_json_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut lines, lists, text behind the object and fields nobody knows."""
    return _refused(_json_rows(spark, sf_dir))


def _own_schema(spark: SparkSession) -> str:
    """A schema nobody else uses, whose tables go to the shared folder."""
    schema = f"veilmark_check_{uuid.uuid4().hex}"
    ingest.create_schema(spark, schema, scratch_path(spark, schema))
    return schema


def _replace_and_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced twice and appended to once: two copies remain."""
    schema = _own_schema(spark)
    rows = payer_table(spark, sf_dir, "eligibility")
    for _ in range(2):
        name = ingest.replace_table(spark, "eligibility", rows, schema)
    ingest.append_rows(spark, "eligibility", rows, schema)
    return as_text(spark.table(name))


def _failed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose second load fails on a late row: what a reader sees then."""
    schema = _own_schema(spark)
    rows = payer_table(spark, sf_dir, "eligibility")
    name = ingest.replace_table(spark, "eligibility", rows, schema)
    fails = F.when(F.col("premium_amount").isNull(), F.col("plan_code")).otherwise(
        F.raise_error(F.lit("a row that cannot be loaded"))
    )
    try:
        ingest.replace_table(spark, "eligibility", rows.withColumn("plan_code", fails), schema)
    except Exception as error:
        if "a row that cannot be loaded" not in str(error):
            raise
    comment = spark.catalog.getTable(name).description
    return as_text(spark.table(name)).withColumn("table_comment", F.lit(comment))


def _column_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tag_view(spark, sf_dir, "column_tag_log")
    return tags.latest_tags(log, ["ts", "event_id"], tags.COLUMN_KEYS)


def _table_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = tag_view(spark, sf_dir, "table_tag_log")
    return tags.latest_tags(log, ["p_partkey"], tags.TABLE_KEYS)


def _schema_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags set on the schemas of a catalog, over those of the log."""
    current = tag_view(spark, sf_dir, "schema_tag_rows")
    new = (
        tag_view(spark, sf_dir, "catalog_tables")
        .select("schema_name")
        .distinct()
        .withColumn("tag_name", F.lit("compliance"))
        .withColumn("tag_value", F.lit("hitech"))
    )
    return tags.set_tags(current, new, tags.SCHEMA_KEYS)


def _audit(report: Callable, source: Query, *limit: int) -> Query:
    return lambda spark, sf_dir: report(source(spark, sf_dir), "health_plan", *limit)


def _inheritance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(
        tags.effective_table_tags(
            tag_view(spark, sf_dir, "catalog_tables"),
            tag_view(spark, sf_dir, "own_table_tags"),
            tag_view(spark, sf_dir, "schema_tag_rows"),
        )
    )


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_class(tag_view(spark, sf_dir, "dictionary"))


def _masking_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags.masking_rules(
        _dictionary(spark, sf_dir), tag_view(spark, sf_dir, "dictionary_tags")
    )


def _class_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tags.class_tag_mismatches(
        _dictionary(spark, sf_dir), tag_view(spark, sf_dir, "dictionary_tags")
    )
    return as_text(found)


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.policy_coverage(
        tag_view(spark, sf_dir, "dictionary_tags"), tag_view(spark, sf_dir, "bindings")
    )


def _orphans(fk: tuple[str, str, str, str], spark: SparkSession, sf_dir: str) -> DataFrame:
    child, child_key, parent, parent_key = fk
    return joins.orphans(
        payer_table(spark, sf_dir, child),
        child_key,
        payer_table(spark, sf_dir, parent),
        parent_key,
    )


def _deid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = joins.deid_join(
        payer_table(spark, sf_dir, "claims"),
        "claims",
        payer_table(spark, sf_dir, "members"),
        "members",
        "none",
        SALT,
    )
    return rows.select(
        "claim_id",
        "member_id",
        "service_date_from",
        "members_date_of_birth",
        "members_state_code",
        "members_ssn",
    )


def _masked_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two masked copies joined on the hash, as a reader of both would do."""
    claims = masked(payer_table(spark, sf_dir, "claims"), "claims", "partial", SALT)
    members = masked(payer_table(spark, sf_dir, "members"), "members", "partial", SALT)
    rows = joins.spread_join(
        claims.select("claim_id", "member_id", "billed_amount"),
        members.select(F.col("member_id").alias("m_id"), "zip_code", "state_code"),
        "member_id",
        "m_id",
        ["claim_id"],
    )
    return rows.drop("m_id")


def _member_rows(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    key = TABLES[table].key
    rows = joins.member_rows(
        payer_table(spark, sf_dir, table).select(key, "member_id"),
        payer_table(spark, sf_dir, "members"),
        ["state_code", "plan_code", "is_active"],
        [key],
    )
    return as_text(rows)


def _claim_authorizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.claim_authorizations(
        payer_table(spark, sf_dir, "claims"), payer_table(spark, sf_dir, "prior_authorizations")
    )


def _nested_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.nested_group_tiers(
        dated_view(spark, sf_dir, "memberships"), dated_view(spark, sf_dir, "nested_groups")
    )


def _claims_in_authorization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of members with several authorizations, one member with a third of all."""
    return dated.claims_in_authorization(
        dated_view(spark, sf_dir, "claims"), dated_view(spark, sf_dir, "authorizations")
    )


def _coverage_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(dated.coverage_spans(dated_view(spark, sf_dir, "coverage")))


def _coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = dated.coverage_spans(dated_view(spark, sf_dir, "coverage"))
    return as_text(dated.coverage_gaps(spans))


def _claims_uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims, coverage = (dated_view(spark, sf_dir, n) for n in ("claims", "coverage"))
    return as_text(dated.claims_uncovered(claims, coverage))


def _on_claims(report: Callable, **options) -> Query:
    return lambda spark, sf_dir: report(payer_table(spark, sf_dir, "claims"), **options)


def _on_members(report: Callable, **options) -> Query:
    return lambda spark, sf_dir: report(payer_table(spark, sf_dir, "members"), **options)


def _across(report: Callable, **options) -> Query:
    return lambda spark, sf_dir: report(
        payer_table(spark, sf_dir, "claims"), payer_table(spark, sf_dir, "members"), **options
    )


def _verify_last4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analytics.verify_by_masked_value(
        payer_table(spark, sf_dir, "members"), "members", "ssn", "***-**-0343"
    )
    return masked(found, "members", "partial", SALT).select("member_id", "last_name", "ssn")


def _age_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = [
        capped_birth_date("date_of_birth", tier, AS_OF).alias(f"birth_{tier}") for tier in TIERS
    ]
    return payer_table(spark, sf_dir, "members").select(F.col("member_id").alias("key"), *shown)


def _zip3_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = payer_table(spark, sf_dir, "members")
    prefix = F.substring("zip_code", 1, 3).alias("zip3")
    people = members.groupBy(prefix).agg((F.count("*") * 10_000).alias("population"))
    rows = zip3_by_population(members, "zip_code", "partial", people)
    return rows.select(F.col("member_id").alias("key"), "zip_code")


def _salt_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = payer_table(spark, sf_dir, "claims")
    return salt_crosswalk(claims, "member_id", SALT, NEW_SALT)


def _rekey(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = masked(payer_table(spark, sf_dir, "claims"), "claims", "none", SALT)
    members = payer_table(spark, sf_dir, "members")
    crosswalk = salt_crosswalk(members, "member_id", SALT, NEW_SALT)
    return rekey(claims.select("claim_id", "member_id"), "member_id", crosswalk, ["claim_id"])


def _salt(version: int) -> str:
    return f"{SALT}_{version}"


def _rekey_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims hashed under six salts, moved to the last one without the identifiers."""
    members = payer_table(spark, sf_dir, "members").select("member_id")
    steps = [
        salt_crosswalk(
            members.where("member_id <> 'M-5'") if v == 2 else members,
            "member_id",
            _salt(v),
            _salt(v + 1),
        ).select(
            F.lit(v).alias("salt_version"),
            "old_hid",
            F.lit(v + 1).alias("next_version"),
            "new_hid",
        )
        for v in range(SALT_VERSIONS - 1)
    ]
    hashed = F.coalesce(
        *[
            F.when(F.col("salt_version") == v, hash_identifier("member_id", "none", _salt(v)))
            for v in range(SALT_VERSIONS)
        ]
    )
    claims = dated_view(spark, sf_dir, "versioned_claims").withColumn("member_id", hashed)
    crosswalk = reduce(DataFrame.unionByName, steps)
    last = SALT_VERSIONS - 1
    return rekey_versions(claims, "member_id", "salt_version", crosswalk, last, ["claim_id"])


def _drg_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories by code: some in another form, some contradicting each other."""
    nation = read(spark, sf_dir, "nation")
    return nation.selectExpr(*[f"{e} AS {n}" for n, e in DRG_LOOKUP.items()]).unionByName(
        nation.where("n_nationkey = 7").selectExpr("'107' AS drg_code", "'MDC X' AS mdc")
    )


def _drg_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payer_table(spark, sf_dir, "claims").select("claim_id", "drg_code")


def _drg_to_mdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = _drg_lookup(spark, sf_dir)
    return drg_category(_drg_claims(spark, sf_dir), "drg_code", "partial", lookup, into="drg_mdc")


def _drg_lookup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = _drg_lookup(spark, sf_dir)
    return lookup_report(_drg_claims(spark, sf_dir), "drg_code", lookup, "drg_code", "mdc")


def _retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "claims": (payer_table(spark, sf_dir, "claims"), "received_date"),
        "pharmacy_claims": (payer_table(spark, sf_dir, "pharmacy_claims"), "fill_date"),
        "prior_authorizations": (
            payer_table(spark, sf_dir, "prior_authorizations"),
            "request_date",
        ),
    }
    report = audit.retention_report(tables, tags.table_tags(spark), date(2008, 6, 1))
    text = F.col("keep_from").cast("string").alias("keep_from")
    return report.select("table_name", "retention", text, "n_rows", "n_expired")


def _purged(spark: SparkSession, sf_dir: str) -> tuple:
    """Pharmacy claims by month of dispensing, purged of those before a day in a month."""
    schema = _own_schema(spark)
    name = f"`{schema}`.`fills`"
    rows = payer_table(spark, sf_dir, "pharmacy_claims").select("rx_claim_id", "fill_date")
    month = F.date_format("fill_date", "yyyy-MM").alias("fill_month")
    by_month = rows.select("*", month).hint("rebalance", "fill_month")
    by_month.write.partitionBy("fill_month").format("parquet").saveAsTable(name)
    return name, purge(spark, name, "fill_date", PURGED_BEFORE)


def _retention_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, _ = _purged(spark, sf_dir)
    return as_text(spark.table(name))


def _retention_purge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, done = _purged(spark, sf_dir)
    return spark.createDataFrame(
        [(done.n_rows, done.n_removed, done.dropped, done.rewritten, done.untouched)],
        "n_rows long, n_removed long, dropped long, rewritten long, untouched long",
    )


def _sketched_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values per tag from the stored sketches of days, beside the exact number."""
    log = tag_view(spark, sf_dir, "column_tag_log")
    sketches = kept(audit.tag_value_sketches(log, "ts"), "tag-sketches")
    estimated = audit.tags_with_many_values_sketched(sketches, limit=1)
    exact = log.where("schema_name = 'health_plan'").groupBy(F.col("tag_name").alias("exact_tag"))
    counts = exact.agg(F.count_distinct("tag_value").alias("n_values"))
    off = F.abs(F.col("distinct_values") - F.col("n_values"))
    return estimated.join(counts, F.col("tag_name") == F.col("exact_tag")).select(
        "tag_name",
        F.when(F.col("n_values") <= EXACT_VALUES, F.col("distinct_values")).alias("few_values"),
        (off <= 0.05 * F.col("n_values")).alias("is_within"),
    )


def registered() -> dict[str, Query]:
    """Name to query."""
    found: dict[str, Query] = {name: partial(_mask_query, name) for name in MASKS}
    for table in TABLES:
        found[f"load_{table}"] = partial(_load, table)
        if table != "members":
            found[f"sql_function_masks_{table}"] = partial(_sql_masks, table)
        found[f"masked_view_{table}"] = partial(_masked_view, table)
        for tier in TIERS:
            found[f"masked_{table}_{tier}"] = partial(_masked_table, table, tier)
    for fk in FOREIGN_KEYS:
        found[f"orphans_{fk[0]}_{fk[1]}"] = partial(_orphans, fk)
    for child, fk, parent, _ in FOREIGN_KEYS:
        if fk == "member_id" and parent == "members":
            found[f"member_of_{child}"] = partial(_member_rows, child)
    column_reports = {
        "audit_b2": (audit.tables_near_column_tag_limit, 100),
        "audit_b3": (audit.tags_with_many_values, 1),
    }
    for name, (report, low) in column_reports.items():
        found[name] = _audit(report, _column_tags)
        found[f"{name}_low"] = _audit(report, _column_tags, low)
    found |= {
        "tier_resolution": lambda s, d: group_tiers(tag_view(s, d, "principal_groups")),
        "tier_resolution_nested": _nested_tiers,
        "masked_by_reader": _masked_by_reader,
        "sql_function_masks": partial(_sql_masks, "members"),
        "masked_by_policy": _masked_by_policy,
        "masked_by_schema": _masked_by_schema,
        "group_function": _group_function,
        "session_tier": _session_tier,
        "notes_linked": _notes_linked,
        "table_properties": _table_properties,
        "catalog_drift": _catalog_drift,
        "masked_export": _masked_export,
        "masked_stream": _masked_stream,
        "replace_and_append": _replace_and_append,
        "failed_replace": _failed_replace,
        "ingest_accepted": _ingest_accepted,
        "ingest_rejected": _ingest_rejected,
        "load_csv_accepted": _load_csv_accepted,
        "load_csv_rejected": _load_csv_rejected,
        "load_json_accepted": _load_json_accepted,
        "load_json_rejected": _load_json_rejected,
        "set_column_tags": _column_tags,
        "set_table_tags": _table_tags,
        "set_schema_tags": _schema_tags,
        "audit_b1": _audit(audit.tables_near_tag_limit, _table_tags),
        "audit_b1_low": _audit(audit.tables_near_tag_limit, _table_tags, 1),
        "audit_b4": _audit(audit.bad_tag_names, _column_tags),
        "audit_b5": _audit(audit.hipaa_inventory, _column_tags),
        "audit_b6": _audit(audit.masking_inventory, _column_tags),
        "tag_value_violations": lambda s, d: tags.tag_value_violations(_column_tags(s, d)),
        "tag_naming_violations": lambda s, d: tags.naming_violations(_column_tags(s, d)),
        "tag_inheritance": _inheritance,
        "data_dictionary": _dictionary,
        "masking_rules": _masking_rules,
        "class_tag_consistency": _class_tags,
        "policy_coverage": _coverage,
        "deid_join": _deid_join,
        "masked_join": _masked_join,
        "deid_cost_by_state": _across(analytics.deid_cost_by_state),
        "claim_authorizations": _claim_authorizations,
        "claims_in_authorization": _claims_in_authorization,
        "coverage_spans": _coverage_spans,
        "coverage_gaps": _coverage_gaps,
        "claims_uncovered": _claims_uncovered,
        "cost_trend": _on_claims(analytics.cost_trend),
        "cohort_by_month": _on_members(analytics.birth_cohorts),
        "cohort_by_year": _on_members(analytics.birth_cohorts, tier="none"),
        "dx_prevalence": _on_claims(analytics.diagnosis_prevalence),
        "zip3_counts": _on_members(analytics.zip3_counts),
        "deid_cohort": _across(analytics.deid_cohort),
        "verify_last4": _verify_last4,
        "age_cap": _age_cap,
        "zip3_population": _zip3_population,
        "salt_rotation": _salt_rotation,
        "salt_rekey": _rekey,
        "drg_to_mdc": _drg_to_mdc,
        "drg_lookup_report": _drg_lookup_report,
        "retention_report": _retention,
        "retention_purge": _retention_purge,
        "retention_purge_report": _retention_purge_report,
        "audit_b3_sketched": _sketched_values,
        "salt_rekey_versions": _rekey_versions,
    }
    return {name: _prepared(query) for name, query in found.items()}


def _prepared(query: Query) -> Query:
    """The query in a session with the library's runtime settings."""
    return lambda spark, sf_dir: query(prepare(spark), sf_dir)
