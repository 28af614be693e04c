"""The masks as SQL functions, so that SQL users can call them by name.

Each becomes a SQL function that Spark inlines into the calling plan; no
Python runs. Two forms:

* ``register_functions``: ``mask_x(value, tier)``. With a literal tier the
  other arms fold away. Can be stored in a schema and used in stored views.
* ``register_session_functions``: ``mask_x(value)``, with the tier taken from a
  session variable. For interactive use; a stored view cannot refer to it.

The salt becomes part of the function text. Whoever may describe the function
can read it, so keep stored functions in a schema readers cannot browse.
"""

from __future__ import annotations

from collections.abc import Mapping

from collections.abc import Iterable

from pyspark.sql import SparkSession

from veilmark.functions import masks as m
from veilmark.functions.tiers import FULL, NONE, PARTIAL, TIERS
from veilmark.sources.model import SCHEMA_NAME, TABLES

TIER_VARIABLE = "veilmark_tier"
GROUPS_VARIABLE = "veilmark_groups"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bodies(salt: str) -> dict[str, tuple[str, str, str, str]]:
    """Function name to (argument type, full, partial, none) over ``value``."""
    if not salt:
        raise ValueError("SQL masks need a non-empty salt")

    def ends(prefix, n):
        return f"{_lit(prefix)} || right(value, {n})"

    def starts(n, suffix):
        return f"substr(value, 1, {n}) || {_lit(suffix)}"

    digest = (
        f"{_lit(m.HASH_PREFIX)} || substr(sha2(value || {_lit(salt)}, 256), 1, {m.HASH_CHARS})"
    )
    buckets = " ".join(f"WHEN value < {top} THEN {_lit(name)}" for top, name in m.AMOUNT_BUCKETS)
    amount = (
        f"CASE WHEN value IS NOT NULL THEN "
        f"CASE {buckets} ELSE {_lit(m.AMOUNT_TOP_BUCKET)} END END"
    )
    notes = "value"
    for pattern, label in m.NOTE_PATTERNS:
        notes = f"regexp_replace({notes}, {_lit(pattern)}, {_lit(label)})"
    digits = "regexp_replace(value, '[^0-9]+', '')"
    email = (
        f"substr(get(split(value, '@', 3), 0), 1, 1) || {_lit(m.EMAIL_INFIX)} "
        f"|| get(split(value, '@', 3), 1)"
    )
    dx = "if(contains(value, '.'), substring_index(value, '.', 1), substr(value, 1, 0))"
    redacted = _lit(m.REDACTED)
    text = "STRING", "value"
    return {
        "mask_ssn": (*text, ends(m.SSN_PREFIX, 4), _lit(m.SSN_TOKEN)),
        "mask_name": (*text, starts(1, m.NAME_SUFFIX), redacted),
        "mask_email": (*text, email, redacted),
        "mask_phone": (*text, f"{_lit(m.PHONE_PREFIX)} || right({digits}, 4)", _lit(m.PHONE_TOKEN)),
        "mask_date_of_birth": (
            "DATE",
            "cast(value AS STRING)",
            "date_format(value, 'yyyy-MM')",
            f"cast(year(value) AS STRING) || {_lit(m.YEAR_SUFFIX)}",
        ),
        "mask_zip_code": (*text, starts(3, m.ZIP_SUFFIX), _lit(m.ZIP_TOKEN)),
        "mask_address": (*text, _lit(m.ADDRESS_PLACEHOLDER), redacted),
        "hash_identifier": (*text, digest, digest),
        "mask_financial_amount": (
            m.AMOUNT_TYPE.upper(),
            "cast(value AS STRING)",
            amount,
            redacted,
        ),
        "mask_diagnosis_code": (*text, f"{dx} || {_lit(m.DIAGNOSIS_SUFFIX)}", redacted),
        "mask_drug_info": (*text, _lit(m.DRUG_PLACEHOLDER), redacted),
        "mask_clinical_notes": (*text, notes, _lit(m.NOTES_TOKEN)),
        "mask_tax_id": (*text, ends(m.TAX_ID_PREFIX, 4), _lit(m.TAX_ID_TOKEN)),
        "mask_beneficiary_id": (*text, starts(3, m.BENEFICIARY_SUFFIX), _lit(m.BENEFICIARY_TOKEN)),
        "mask_redact": (*text, redacted, redacted),
    }


def _arms(tier: str, full: str, partial: str, none: str) -> str:
    return (
        f"CASE {tier} WHEN {_lit(FULL)} THEN {full} "
        f"WHEN {_lit(PARTIAL)} THEN {partial} ELSE {none} END"
    )


def register_functions(spark: SparkSession, salt: str, schema: str | None = None) -> list[str]:
    """Create ``mask_x(value, tier)``: temporary, or stored in ``schema``."""
    names = []
    for name, (type_, full, partial, none) in _bodies(salt).items():
        kind, target = ("", f"`{schema}`.{name}") if schema else ("TEMPORARY ", name)
        spark.sql(
            f"CREATE OR REPLACE {kind}FUNCTION {target}(value {type_}, tier STRING) "
            f"RETURNS STRING RETURN {_arms('tier', full, partial, none)}"
        )
        names.append(target)
    return names


def register_session_functions(spark: SparkSession, salt: str) -> None:
    """Create temporary ``mask_x(value)`` that follow the session's tier."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {TIER_VARIABLE} STRING DEFAULT {_lit(NONE)}")
    for name, (type_, full, partial, none) in _bodies(salt).items():
        body = _arms(f"session.{TIER_VARIABLE}", full, partial, none)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value {type_}) "
            f"RETURNS STRING RETURN {body}"
        )


def set_session_tier(spark: SparkSession, tier: str) -> None:
    """Switch the tier of the session functions; anything unknown means none."""
    tier = tier if tier in TIERS else NONE
    spark.sql(f"SET VAR {TIER_VARIABLE} = {_lit(tier)}")


def register_group_function(spark: SparkSession) -> None:
    """Create ``is_account_group_member(group)`` over the session's groups.

    Functions that test groups themselves then run unchanged, as temporary
    functions. A session starts without groups.
    """
    spark.sql(
        f"DECLARE OR REPLACE VARIABLE {GROUPS_VARIABLE} ARRAY<STRING> "
        f"DEFAULT CAST(array() AS ARRAY<STRING>)"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION is_account_group_member(group_name STRING) "
        f"RETURNS BOOLEAN RETURN array_contains(session.{GROUPS_VARIABLE}, group_name)"
    )


def set_session_groups(spark: SparkSession, groups: Iterable[str]) -> None:
    """Replace the groups of the session."""
    names = ", ".join(_lit(g) for g in groups)
    spark.sql(f"SET VAR {GROUPS_VARIABLE} = CAST(array({names}) AS ARRAY<STRING>)")


def create_masked_views(
    spark: SparkSession,
    table: str,
    schema: str = SCHEMA_NAME,
    tiers: tuple[str, ...] = TIERS,
    policy: Mapping[str, str] | None = None,
) -> list[str]:
    """Stored views ``<table>_<tier>`` over a table; needs the stored functions.

    ``policy`` binds columns to functions, e.g. what `policy_of` reads from the
    stored policy; without it the bindings of the model hold.
    """
    spec = TABLES[table]
    bound = spec.policy if policy is None else policy
    lacking = set(bound) - {c.name for c in spec.columns}
    if lacking:
        raise ValueError(f"masks are bound to columns that are not there: {sorted(lacking)}")
    views = []
    for tier in tiers:
        columns = ", ".join(
            f"`{schema}`.{bound[c.name]}({c.name}, {_lit(tier)}) AS {c.name}"
            if c.name in bound
            else c.name
            for c in spec.columns
        )
        view = f"`{schema}`.`{table}_{tier}`"
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM `{schema}`.`{table}`")
        views.append(view)
    return views
