"""Tag catalogs of a large organization, projected from the test tables.

Every row of a test table stands for one tag assignment, table or column, so
the catalogs grow with the data. As in `payer_views`, the expressions use only
syntax that Spark SQL and ANSI SQL share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilmark.plans.payer_views import read


def _str(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


_E, _K = "event_id", "p_partkey"

# A log of column-tag assignments; the last one per column and tag counts.
COLUMN_TAG_LOG = {
    "schema_name": "CASE WHEN user_id % 9 = 8 THEN 'sandbox' ELSE 'health_plan' END",
    "table_name": f"'t_' || {_str('user_id % 5')}",
    "column_name": f"'c_' || {_str(f'{_E} % 700')}",
    "tag_name": f"CASE event_type WHEN 'click' THEN 'sensitivity_level' "
    f"WHEN 'view' THEN 'masking_rule' WHEN 'signup' THEN 'hipaa_type' "
    f"WHEN 'error' THEN 'contains_phi' "
    f"ELSE CASE WHEN {_E} % 50 = 0 THEN 'Cost Center' WHEN {_E} % 51 = 0 THEN 'data-owner' "
    f"ELSE 'steward' END END",
    "tag_value": f"CASE event_type "
    f"WHEN 'click' THEN CASE {_E} % 4 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' "
    f"WHEN 2 THEN 'medium' ELSE 'Secret' END "
    f"WHEN 'view' THEN CASE {_E} % 4 WHEN 0 THEN 'hash' WHEN 1 THEN 'redact' "
    f"WHEN 2 THEN 'none' ELSE 'blur' END "
    f"WHEN 'signup' THEN 'type_' || {_str(f'{_E} % 60')} "
    f"WHEN 'error' THEN 'true' ELSE 'Team ' || {_str('user_id')} END",
    "ts": "ts",
    "event_id": _E,
}

TABLE_TAG_LOG = {
    "schema_name": "CASE WHEN p_size % 10 = 9 THEN 'sandbox' ELSE 'health_plan' END",
    "table_name": "lower(p_brand)",
    "tag_name": f"'tag_' || {_str('p_size')}",
    "tag_value": "lower(p_type)",
    "p_partkey": _K,
}

# Tables with tags of their own, and the tags of the five schemas.
TABLES_IN_SCHEMAS = {
    "schema_name": f"'s_' || {_str(f'{_K} % 7')}",
    "table_name": f"'table_' || {_str(_K)}",
}
OWN_TABLE_TAGS = {
    **TABLES_IN_SCHEMAS,
    "tag_name": f"CASE WHEN {_K} % 2 = 0 THEN 'retention' ELSE 'business_domain' END",
    "tag_value": f"CASE WHEN {_K} % 2 = 0 THEN '10_year' ELSE 'claims' END",
}
SCHEMA_TAG_ROWS = {
    "schema_name": f"'s_' || {_str('r_regionkey')}",
    "tag_name": "CASE WHEN r_regionkey % 2 = 0 THEN 'retention' ELSE 'compliance' END",
    "tag_value": "CASE WHEN r_regionkey % 2 = 0 THEN '7_year' ELSE 'hipaa' END",
}

# A data dictionary, tags for it and mask bindings, with gaps and errors.
DICTIONARY = {
    "schema_name": "'health_plan'",
    "table_name": "lower(p_brand)",
    "column_name": f"'col_' || {_str(_K)}",
    "comment": f"CASE {_K} % 8 WHEN 0 THEN 'Name of the ' || p_name || ' (e.g., A.B). PHI - name.' "
    f"WHEN 1 THEN 'Number of the ' || p_name || '. PII - number.' "
    f"WHEN 2 THEN 'Cost of the ' || p_name || '. Sensitive financial.' "
    f"WHEN 3 THEN 'State. Non-sensitive - a state is not PHI.' "
    f"WHEN 4 THEN 'PHI and PII by way of the ' || p_name "
    f"WHEN 5 THEN 'Size. Unclassified. PHI is not known.' "
    f"WHEN 6 THEN 'Code of the ' || p_name || '. PHI.' ELSE 'Type. Non-sensitive.' END",
}
DICTIONARY_TAGS = {
    "schema_name": "'health_plan'",
    "table_name": "lower(p_brand)",
    "column_name": f"CASE WHEN {_K} % 97 = 5 THEN 'gone_' || {_str(_K)} "
    f"ELSE 'col_' || {_str(_K)} END",
    "tag_name": f"CASE WHEN {_K} % 8 = 1 THEN 'contains_pii' WHEN {_K} % 8 = 2 THEN 'masking_rule' "
    f"WHEN {_K} % 8 = 3 AND {_K} % 5 = 0 THEN 'sensitivity_level' "
    f"WHEN {_K} % 8 IN (0, 6) AND {_K} % 11 <> 0 THEN 'contains_phi' END",
    "tag_value": f"CASE WHEN {_K} % 8 = 2 THEN 'redact' WHEN {_K} % 8 = 3 THEN 'high' "
    f"ELSE 'true' END",
}
BINDINGS = {
    "table_name": "lower(p_brand)",
    "column_name": f"'col_' || {_str(_K)}",
    "function_name": f"CASE WHEN {_K} % 8 IN (0, 2, 5) AND {_K} % 13 <> 0 THEN 'mask_redact' END",
}

# Who belongs to which account group.
PRINCIPAL_GROUPS = {
    "principal": f"{_str('user_id')} || '/' || {_str(f'{_E} % 60')}",
    "group_name": f"CASE WHEN event_type = 'purchase' AND {_E} % 2 = 0 THEN 'phi_full_access' "
    f"WHEN event_type = 'click' THEN 'phi_partial_access' "
    f"WHEN event_type = 'view' THEN 'PHI_FULL_ACCESS' "
    f"WHEN event_type = 'signup' THEN NULL ELSE 'analysts' END",
}

SOURCES = {
    "column_tag_log": ("events", COLUMN_TAG_LOG),
    "table_tag_log": ("part", TABLE_TAG_LOG),
    "catalog_tables": ("part", TABLES_IN_SCHEMAS),
    "own_table_tags": ("part", OWN_TABLE_TAGS),
    "schema_tag_rows": ("region", SCHEMA_TAG_ROWS),
    "dictionary": ("part", DICTIONARY),
    "dictionary_tags": ("part", DICTIONARY_TAGS),
    "bindings": ("part", BINDINGS),
    "principal_groups": ("events", PRINCIPAL_GROUPS),
}
# Rows of these sources exist only where the named column is not NULL.
PRESENT = {"dictionary_tags": "tag_name", "bindings": "function_name"}


def tag_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = SOURCES[name]
    items = [f"{expr} AS {alias}" for alias, expr in columns.items()]
    df = read(spark, sf_dir, source).selectExpr(*items)
    return df.where(F.col(PRESENT[name]).isNotNull()) if name in PRESENT else df


def tag_sql(name: str) -> str:
    source, columns = SOURCES[name]
    text = "SELECT " + ", ".join(f"{e} AS {a}" for a, e in columns.items()) + f" FROM {source}"
    if name in PRESENT:
        text = f"SELECT * FROM ({text}) v WHERE {PRESENT[name]} IS NOT NULL"
    return text
