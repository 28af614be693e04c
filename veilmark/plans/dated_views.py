"""Tables with dates and nesting that the payer projections lack.

Claims, coverage and authorizations of members who have several, one of whom holds
a third of all rows, and account groups within groups. As in `payer_views`, every row
of a test table is one row, and the expressions are shared by Spark SQL and ANSI SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilmark.plans.payer_views import read

_K = "o_orderkey"
_DAY = "CAST(o_orderdate AS DATE)"
_MEMBER = (
    f"CASE WHEN {_K} % 3 = 0 THEN 'M-1' WHEN {_K} % 50 = 49 THEN NULL "
    f"ELSE 'M-' || CAST(o_custkey AS STRING) END"
)


def _later(day: str, expr: str) -> str:
    return f"{day} + CAST({expr} AS INT)"


_FROM = _later(_DAY, f"{_K} * 7 % 90 - 45")

CLAIMS = {
    "claim_id": f"'C-' || CAST({_K} AS STRING)",
    "member_id": _MEMBER,
    "service_date_from": f"CASE WHEN {_K} % 61 = 7 THEN NULL ELSE {_DAY} END",
}
AUTHORIZATIONS = {
    "auth_id": f"'A-' || CAST({_K} AS STRING)",
    "member_id": _MEMBER,
    "effective_date": f"CASE WHEN {_K} % 47 = 5 THEN NULL ELSE {_FROM} END",
    "expiration_date": f"CASE WHEN {_K} % 23 = 0 THEN NULL "
    f"ELSE {_later(_FROM, f'{_K} * 11 % 70 - 4')} END",
}
# Dense for most members; of the one with a third of all rows, only a few.
COVERAGE = {
    "member_id": f"CASE WHEN {_K} % 3 = 0 AND {_K} % 60 <> 0 THEN NULL ELSE {_MEMBER} END",
    "coverage_type": f"CASE WHEN {_K} % 19 = 0 THEN NULL WHEN {_K} % 4 = 0 THEN 'Dental' "
    f"ELSE 'Medical' END",
    "effective_date": f"CASE WHEN {_K} % 47 = 5 THEN NULL ELSE {_FROM} END",
    "termination_date": f"CASE WHEN {_K} % 67 = 1 THEN NULL WHEN {_K} % 5 = 0 THEN {_FROM} "
    f"ELSE {_later(_FROM, f'{_K} * 13 % 200 - 4')} END",
}

# Accounts in groups, and groups in groups: trees, two cycles and a long chain.
_G = "p_partkey"
NESTED_GROUPS = {
    "group_name": f"CASE WHEN {_G} % 3 = 0 THEN 'G-1' ELSE 'G-' || CAST({_G} AS STRING) END",
    "parent_group": f"CASE WHEN {_G} % 97 = 1 THEN 'phi_full_access' "
    f"WHEN {_G} % 89 = 2 THEN 'phi_partial_access' WHEN {_G} % 53 = 4 THEN NULL "
    f"WHEN {_G} % 10 = 7 THEN 'G-' || CAST({_G} + 20 AS STRING) "
    f"WHEN {_G} % 10 = 4 THEN 'G-' || CAST({_G} + 1 AS STRING) "
    f"WHEN {_G} % 10 = 5 THEN 'G-' || CAST({_G} - 1 AS STRING) "
    f"ELSE 'G-' || CAST({_G} - {_G} % 7 - 1 AS STRING) END",
}
MEMBERSHIPS = {
    "principal": "'U-' || CAST(user_id AS STRING) || '/' || CAST(event_id % 40 AS STRING)",
    "group_name": "CASE WHEN event_id % 3 = 0 THEN 'G-8' WHEN event_id % 101 = 1 THEN NULL "
    "WHEN event_id % 103 = 1 THEN 'phi_full_access' "
    "ELSE 'G-' || CAST(event_id % 900 AS STRING) END",
}

# Notes that name their member, in several spellings, and others.
_D = "doc_id"
_NUMBER = f"lpad(CAST({_D} AS STRING), 9, '0')"
LINKED_NOTES = {
    "auth_id": f"'A-' || CAST({_D} AS STRING)",
    "member_id": f"CASE WHEN {_D} % 3 = 0 THEN 'M-1' WHEN {_D} % 29 = 1 THEN NULL "
    f"ELSE 'M-' || CAST({_D} AS STRING) END",
    "clinical_notes": f"CASE WHEN {_D} % 37 = 5 THEN NULL WHEN {_D} % 3 = 0 "
    f"THEN text || ' customer#000000001, seen (CUSTOMER#000000001). Xcustomer#000000001' "
    f"ELSE text || ' BUILDING and furniture for Customer#' || {_NUMBER} || ', cUSTOMER#' "
    f"|| {_NUMBER} || '; not customer#000000001' END",
}
# Claims hashed under salts of several versions; one step of one member is lost.
SALT_VERSIONS = 6
VERSIONED_CLAIMS = {
    "claim_id": f"'C-' || CAST({_K} AS STRING)",
    "member_id": _MEMBER,
    "salt_version": f"CASE WHEN {_K} % 43 = 9 THEN NULL ELSE CAST({_K} % {SALT_VERSIONS} AS INT) END",
}

SOURCES = {
    "linked_notes": ("documents", LINKED_NOTES),
    "versioned_claims": ("orders", VERSIONED_CLAIMS),
    "claims": ("orders", CLAIMS),
    "authorizations": ("orders", AUTHORIZATIONS),
    "coverage": ("orders", COVERAGE),
    "nested_groups": ("part", NESTED_GROUPS),
    "memberships": ("events", MEMBERSHIPS),
}


def dated_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = SOURCES[name]
    return read(spark, sf_dir, source).selectExpr(*[f"{e} AS {a}" for a, e in columns.items()])


def dated_sql(name: str) -> str:
    source, columns = SOURCES[name]
    return "SELECT " + ", ".join(f"{e} AS {a}" for a, e in columns.items()) + f" FROM {source}"
