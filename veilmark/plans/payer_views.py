"""The six payer tables as projections of the star-schema test tables.

Every payer table is one projection of one whole table, so it grows with it.
The expressions use only syntax that Spark SQL and ANSI SQL share; the check
queries build the same inputs from them. NULLs, codes without a dot, short
values and amounts on bucket limits occur in each at a fixed rate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilmark.sources.model import TABLES


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _digits(expr: str, width: int) -> str:
    return f"lpad({_text(expr)}, {width}, '0')"


def _letter(expr: str) -> str:
    return f"chr(CAST(65 + {expr} % 26 AS INT))"


def _strayed(expr: str, prefix: str, k: str, rest: int) -> str:
    """A reference that now and then names nobody, at every scale."""
    gone = f"'{prefix}-gone-' || {_text(f'{k} % 6')}"
    return f"CASE WHEN {k} % 41 = {rest} THEN {gone} ELSE {expr} END"


def _unless(condition: str, expr: str) -> str:
    return f"CASE WHEN {condition} THEN NULL ELSE {expr} END"


def _days(start: str, expr: str) -> str:
    return f"CAST('{start}' AS DATE) + CAST({expr} AS INT)"


def _phone(k: str) -> str:
    area, line = _digits(f"{k} % 800 + 200", 3), _digits(f"{k} * 31 % 10000", 4)
    return (
        f"CASE WHEN {k} % 30 = 0 THEN NULL "
        f"WHEN {k} % 4 = 0 THEN '(' || {area} || ') 555-' || {line} "
        f"WHEN {k} % 4 = 1 THEN {area} || '-555-' || {line} || ' x' || {_text(f'{k} % 100')} "
        f"WHEN {k} % 31 = 0 THEN 'unlisted' "
        f"ELSE {area} || '-555-' || {line} END"
    )


def _code(k: str) -> str:
    dotless = f"{_letter(k)} || {_digits(f'{k} % 100', 2)}"
    return f"CASE WHEN {k} % 4 = 0 THEN {dotless} ELSE {dotless} || '.' || {_text(f'{k} % 10')} END"


def _limits(k: str, otherwise: str) -> str:
    """Amounts on and beside the bucket limits for some rows."""
    return (
        f"CASE {k} % 20 WHEN 0 THEN CAST(99.99 AS DECIMAL(12,2)) "
        f"WHEN 1 THEN CAST(100 AS DECIMAL(12,2)) WHEN 2 THEN CAST(500 AS DECIMAL(12,2)) "
        f"WHEN 3 THEN CAST(1000 AS DECIMAL(12,2)) WHEN 4 THEN CAST(5000 AS DECIMAL(12,2)) "
        f"WHEN 5 THEN CAST(10000 AS DECIMAL(12,2)) WHEN 6 THEN CAST(50000 AS DECIMAL(12,2)) "
        f"WHEN 7 THEN CAST(-0.01 AS DECIMAL(12,2)) WHEN 8 THEN CAST(NULL AS DECIMAL(12,2)) "
        f"ELSE {otherwise} END"
    )


_STAMP = "CAST('2026-01-01 00:00:00' AS TIMESTAMP)"


def _members() -> dict[str, str]:
    k = "c_custkey"
    return {
        "member_id": f"'M-' || {_text(k)}",
        "subscriber_id": f"'S-' || {_text(f'{k} - {k} % 3')}",
        "first_name": _unless(f"{k} % 60 = 59", "lower(c_mktsegment)"),
        "last_name": f"CASE WHEN {k} % 45 = 44 THEN '' ELSE c_name END",
        "middle_initial": _unless(f"{k} % 4 = 0", _letter(k)),
        "date_of_birth": _unless(f"{k} % 50 = 7", _days("1930-01-01", f"{k} * 37 % 29000")),
        "gender": f"CASE {k} % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' ELSE 'Unknown' END",
        "ssn": _unless(
            f"{k} % 50 = 0",
            f"{_digits(f'{k} % 900 + 100', 3)} || '-' || {_digits(f'{k} % 100', 2)} "
            f"|| '-' || {_digits(f'{k} * 7 % 10000', 4)}",
        ),
        "drivers_license": _unless(f"{k} % 6 = 1", f"'D' || {_text(k)}"),
        "address_line1": f"{_text(k)} || ' Main Street'",
        "address_line2": _unless(f"{k} % 5 <> 0", f"'Apt ' || {_text(k)}"),
        "city": "'City ' || CAST(c_nationkey AS STRING)",
        "state_code": f"{_letter('c_nationkey')} || {_letter('c_nationkey * 7')}",
        "zip_code": f"CASE WHEN {k} % 40 = 3 THEN NULL WHEN {k} % 45 = 5 THEN '12' "
        f"ELSE {_digits(f'{k} * 613 % 100000', 5)} END",
        "county": "'County ' || CAST(c_nationkey AS STRING)",
        "phone_home": _phone(k),
        "phone_mobile": _phone(f"({k} + 1)"),
        "email": f"CASE WHEN {k} % 25 = 24 THEN NULL "
        f"WHEN {k} % 20 = 0 THEN lower(c_mktsegment) "
        f"WHEN {k} % 33 = 1 THEN 'a@' || {_text(k)} || '@c' "
        f"WHEN {k} % 37 = 2 THEN '@d' || {_text(k)} "
        f"ELSE lower(c_mktsegment) || {_text(k)} || '@d' || {_text(f'{k} % 5')} "
        f"|| '.example.com' END",
        "preferred_language": f"CASE WHEN {k} % 4 = 0 THEN 'Spanish' ELSE 'English' END",
        "race": _unless(f"{k} % 9 = 0", f"'Race ' || {_text(f'{k} % 5')}"),
        "ethnicity": f"'Ethnicity ' || {_text(f'{k} % 2')}",
        "marital_status": f"CASE WHEN {k} % 2 = 0 THEN 'Married' ELSE 'Single' END",
        "pcp_npi": _unless(
            f"{k} % 3 = 0", _strayed(f"'N-' || {_text(f'{k} % 120')}", "N", k, 1)
        ),
        "medicare_beneficiary_id": _unless(
            f"{k} % 3 = 1", f"{_text(f'{k} % 9')} || 'AB' || {_digits(k, 8)}"
        ),
        "medicaid_id": _unless(f"{k} % 5 <> 1", f"'KY-MC-' || {_text(k)}"),
        "group_number": f"'GRP-' || {_text(f'{k} % 40')}",
        "plan_code": f"'PLAN-' || {_text(f'{k} % 8')}",
        "effective_date": _days("2020-01-01", f"{k} % 1500"),
        "termination_date": _unless(f"{k} % 7 <> 0", _days("2024-06-30", f"{k} % 600")),
        "is_active": f"{k} % 7 <> 0",
        "created_at": _STAMP,
        "updated_at": _STAMP,
        "source_system": f"'SRC' || {_text(f'{k} % 3')}",
    }


def _claims() -> dict[str, str]:
    k = "o_orderkey"
    day = "CAST(o_orderdate AS DATE)"
    price = "CAST(o_totalprice AS DECIMAL(12,2))"
    small = f"CAST({k} * 13 % 90000 AS DECIMAL(12,2))"
    stay = f"{k} % 6 <> 0"
    pending = "o_orderstatus = 'P'"
    return {
        "claim_id": f"'C-' || {_text(k)}",
        "member_id": _unless(
            f"{k} % 100 = 99", _strayed("'M-' || CAST(o_custkey AS STRING)", "M", k, 2)
        ),
        "subscriber_id": "'S-' || CAST(o_custkey - o_custkey % 3 AS STRING)",
        "claim_type": f"CASE WHEN {stay} THEN 'Professional' ELSE 'Institutional' END",
        "claim_status": "CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'F' THEN 'Paid' "
        "ELSE 'Denied' END",
        "service_date_from": day,
        "service_date_to": f"{day} + CAST({k} % 5 AS INT)",
        "admission_date": _unless(stay, day),
        "discharge_date": _unless(stay, f"{day} + CAST({k} % 5 AS INT)"),
        "diagnosis_code_primary": _code(k),
        "diagnosis_code_2": _unless(f"{k} % 3 <> 0", _code(f"({k} + 1)")),
        "diagnosis_code_3": _unless(f"{k} % 10 <> 0", _code(f"({k} + 2)")),
        "procedure_code": _unless(f"{k} % 40 = 0", _digits(f"{k} * 11 % 100000", 5)),
        "procedure_modifier": _unless(f"{k} % 2 = 0", "'25'"),
        "revenue_code": _unless(stay, _digits(f"{k} % 1000", 4)),
        "place_of_service": f"CASE {k} % 3 WHEN 0 THEN '11' WHEN 1 THEN '21' ELSE '23' END",
        "rendering_provider_npi": _strayed(f"'N-' || {_text(f'{k} % 90')}", "N", k, 3),
        "billing_provider_npi": _strayed(f"'N-' || {_text(f'{k} % 110')}", "N", k, 4),
        "referring_provider_npi": _unless(
            f"{k} % 2 = 1", _strayed(f"'N-' || {_text(f'{k} % 100')}", "N", k, 5)
        ),
        "facility_name": f"'Facility ' || {_text(f'{k} % 30')}",
        "billed_amount": _limits(k, price),
        "allowed_amount": _unless(pending, price),
        "paid_amount": _unless(pending, _limits(f"({k} + 3)", small)),
        "member_liability": _unless(pending, small),
        "copay_amount": _unless(pending, f"CAST({k} % 700 AS DECIMAL(12,2))"),
        "coinsurance_amount": _unless(pending, f"CAST({k} % 6000 AS DECIMAL(12,2))"),
        "deductible_amount": _unless(pending, f"CAST({k} % 1200 AS DECIMAL(12,2))"),
        "drg_code": _unless(stay, _digits(f"100 + {k} % 50", 3)),
        "authorization_number": _unless(
            f"{k} % 20 <> 0", _strayed(f"'A-' || {_text(f'{k} % 1300')}", "A", k, 0)
        ),
        "received_date": f"{day} + 7",
        "adjudicated_date": _unless(pending, f"{day} + 21"),
        "paid_date": _unless("o_orderstatus <> 'F'", f"{day} + 30"),
        "created_at": _STAMP,
        "updated_at": _STAMP,
    }


def _providers() -> dict[str, str]:
    k = "s_suppkey"
    return {
        "provider_id": f"'P-' || {_text(k)}",
        "npi": f"'N-' || {_text(k)}",
        "tax_id": _unless(
            f"{k} % 25 = 24", f"{_digits(f'{k} % 90 + 10', 2)} || '-' || {_digits(k, 7)}"
        ),
        "first_name": _unless(f"{k} % 3 = 0", f"'First' || {_text(k)}"),
        "last_name": _unless(f"{k} % 3 = 0", f"'Last' || {_text(k)}"),
        "organization_name": "s_name",
        "specialty_code": _digits(f"{k} % 100", 2),
        "specialty_desc": f"'Specialty ' || {_text(f'{k} % 100')}",
        "provider_type": f"CASE WHEN {k} % 3 = 0 THEN 'Organization' ELSE 'Individual' END",
        "network_status": f"CASE WHEN {k} % 4 = 0 THEN 'Out-of-Network' ELSE 'In-Network' END",
        "credential": _unless(f"{k} % 3 = 0", "'MD'"),
        "dea_number": _unless(f"{k} % 3 = 0", f"'BX' || {_digits(k, 7)}"),
        "license_number": f"'L' || {_text(k)}",
        "license_state": _letter("s_nationkey"),
        "address_line1": f"{_text(k)} || ' Clinic Road'",
        "city": "'City ' || CAST(s_nationkey AS STRING)",
        "state_code": _letter("s_nationkey"),
        "zip_code": _digits(f"{k} * 877 % 100000", 5),
        "phone": _phone(k),
        "fax": _phone(f"({k} + 2)"),
        "accepting_patients": "s_acctbal > 0",
        "effective_date": _days("2015-01-01", f"{k} % 2000"),
        "termination_date": _unless(f"{k} % 10 <> 9", _days("2025-01-01", f"{k} % 300")),
        "created_at": _STAMP,
        "updated_at": _STAMP,
    }


def _eligibility() -> dict[str, str]:
    k = "c_custkey"
    return {
        "eligibility_id": f"'E-' || {_text(k)}",
        "member_id": _strayed(f"'M-' || {_text(k)}", "M", k, 6),
        "subscriber_id": f"'S-' || {_text(f'{k} - {k} % 3')}",
        "plan_code": f"'PLAN-' || {_text(f'{k} % 8')}",
        "plan_description": f"'Plan number ' || {_text(f'{k} % 8')}",
        "line_of_business": "c_mktsegment",
        "coverage_type": f"CASE WHEN {k} % 4 = 0 THEN 'Dental' ELSE 'Medical' END",
        "benefit_package": f"CASE WHEN {k} % 2 = 0 THEN 'Gold' ELSE 'Silver' END",
        "effective_date": _days("2020-01-01", f"{k} % 1500"),
        "termination_date": _unless(f"{k} % 7 <> 0", _days("2024-06-30", f"{k} % 600")),
        "termination_reason": _unless(f"{k} % 7 <> 0", "'Moved'"),
        "group_number": f"'GRP-' || {_text(f'{k} % 40')}",
        "group_name": f"'Employer ' || {_text(f'{k} % 40')}",
        "cobra_flag": f"{k} % 11 = 0",
        "exchange_flag": f"{k} % 13 = 0",
        "premium_amount": "CAST(c_acctbal AS DECIMAL(10,2))",
        "subsidy_amount": _unless(f"{k} % 3 = 0", f"CAST({k} % 900 AS DECIMAL(10,2))"),
        "created_at": _STAMP,
        "updated_at": _STAMP,
    }


def _pharmacy_claims() -> dict[str, str]:
    k = "l_partkey"
    cost, fee = "CAST(l_extendedprice AS DECIMAL(10,2))", "CAST(l_tax * 100 AS DECIMAL(10,2))"
    return {
        "rx_claim_id": f"'RX-' || {_text('l_orderkey')} || '-' || {_text('l_linenumber')}",
        "member_id": f"'M-' || {_text(k)}",
        "fill_date": "CAST(l_shipdate AS DATE)",
        "ndc_code": _digits(k, 11),
        "drug_name": f"'Drug ' || {_text(k)}",
        "drug_class": _unless(f"{k} % 15 = 0", f"'Class ' || {_text(f'{k} % 40')}"),
        "quantity_dispensed": "CAST(l_quantity AS DECIMAL(10,2))",
        "days_supply": "CAST(l_linenumber * 15 AS INT)",
        "refill_number": "CAST(l_linenumber - 1 AS INT)",
        "prescriber_npi": _strayed(f"'N-' || {_text('l_suppkey')}", "N", k, 8),
        "pharmacy_npi": _strayed(f"'N-' || {_text('l_suppkey % 60')}", "N", k, 9),
        "pharmacy_name": f"'Pharmacy ' || {_text('l_suppkey % 60')}",
        "formulary_tier": _text(f"{k} % 4 + 1"),
        "daw_code": "'0'",
        "ingredient_cost": cost,
        "dispensing_fee": fee,
        "paid_amount": f"CAST({cost} + {fee} AS DECIMAL(10,2))",
        "member_copay": _unless("l_returnflag = 'R'", "CAST(l_quantity * 3 AS DECIMAL(10,2))"),
        "prior_auth_required": "l_returnflag = 'A'",
        "specialty_drug_flag": "l_linestatus = 'O'",
        "created_at": _STAMP,
        "updated_at": _STAMP,
    }


def _prior_authorizations() -> dict[str, str]:
    k = "doc_id"
    area = _digits(f"{k} % 900 + 100", 3)
    person = (
        f"'. Call John Smith, ssn ' || {area} || '-45-6789 or ' || {area} || '-555-0101, "
        f"ref 1234-55-67890, 555-123-4567-89-0123.'"
    )
    return {
        "auth_id": f"'A-' || {_text(k)}",
        "member_id": _strayed(f"'M-' || {_text(k)}", "M", k, 10),
        "auth_type": "source",
        "auth_status": f"CASE WHEN {k} % 5 = 0 THEN 'Denied' ELSE 'Approved' END",
        "request_date": _unless(f"{k} % 30 = 0", _days("2023-01-01", f"{k} % 900")),
        "decision_date": _days("2023-01-05", f"{k} % 900"),
        "effective_date": _days("2023-01-05", f"{k} % 900"),
        "expiration_date": _days("2023-07-05", f"{k} % 900"),
        "diagnosis_code": _unless(f"{k} % 25 = 1", _code(k)),
        "procedure_code": _digits(f"{k} * 17 % 100000", 5),
        "requesting_provider_npi": _strayed(f"'N-' || {_text(f'{k} % 100')}", "N", k, 11),
        "servicing_provider_npi": _strayed(f"'N-' || {_text(f'{k} % 105')}", "N", k, 12),
        "facility_name": "lang",
        "units_requested": f"CAST({k} % 30 AS INT)",
        "units_approved": _unless(f"{k} % 5 = 0", f"CAST({k} % 20 AS INT)"),
        "denial_reason": _unless(f"{k} % 5 <> 0", "'Not medically necessary'"),
        "clinical_notes": f"CASE WHEN {k} % 40 = 0 THEN NULL WHEN {k} % 2 = 0 THEN text "
        f"ELSE text || {person} END",
        "peer_reviewer": _unless(f"{k} % 5 <> 0", "'Reviewer'"),
        "urgency": f"CASE WHEN {k} % 6 = 0 THEN 'Urgent' ELSE 'Routine' END",
        "created_at": _STAMP,
        "updated_at": _STAMP,
    }


# Payer table -> (test table it is projected from, expression per column).
PROJECTIONS: dict[str, tuple[str, dict[str, str]]] = {
    "members": ("customer", _members()),
    "claims": ("orders", _claims()),
    "providers": ("supplier", _providers()),
    "eligibility": ("customer", _eligibility()),
    "pharmacy_claims": ("lineitem", _pharmacy_claims()),
    "prior_authorizations": ("documents", _prior_authorizations()),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One test table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def payer_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One payer table with the types of the model."""
    return read(spark, sf_dir, PROJECTIONS[table][0]).selectExpr(*_items(table))


def _items(table: str) -> list[str]:
    types = {c.name: c.type.upper() for c in TABLES[table].columns}
    return [f"CAST({expr} AS {types[n]}) AS {n}" for n, expr in PROJECTIONS[table][1].items()]


def payer_sql(table: str) -> str:
    """The same projection as SQL text."""
    return f"SELECT {', '.join(_items(table))} FROM {PROJECTIONS[table][0]}"


# Damaged records of a raw file: condition, kind, and the line made of ``line``.
DAMAGED_CSV = (
    ("group_number = 'GRP-9'", "number of fields", "line || ',\"more\",\"values\"'"),
    ("group_number = 'GRP-7'", "number of fields", "eligibility_id || ',\"M-1\",,\"PLAN-1\"'"),
)
OPEN_CSV = ("group_number = 'GRP-5'", "open quote", "line || ',\"more'")
# A quoted line break: one row where these are allowed, else two rejects.
BROKEN_CSV = ("group_number = 'GRP-3'", "'Plan number'", "'Plan' || chr(10) || 'number'")
DAMAGED_JSON = (
    ("group_number = 'GRP-9'", "not one object", "line || ' {\"eligibility_id\": \"E-0\"}'"),
    ("group_number = 'GRP-7'", "not one object", "left(line, 60)"),
    ("group_number = 'GRP-5'", "unknown fields", "replace(line, '}', ', \"surplus\": \"1\"}')"),
    ("group_number = 'GRP-3'", "not one object", "'[' || line || ']'"),
)


def csv_line(table: str) -> str:
    """A row of text columns as a CSV line, in SQL."""
    return " || ',' || ".join(
        f"coalesce('\"' || replace({c.name}, '\"', '\"\"') || '\"', '')"
        for c in TABLES[table].columns
    )


def json_line(table: str) -> str:
    """A row of text columns as a JSON line, in SQL; for values without quotes."""
    fields = " || ', ' || ".join(
        f"'\"{c.name}\": ' || coalesce('\"' || {c.name} || '\"', 'null')"
        for c in TABLES[table].columns
    )
    return f"'{{' || {fields} || '}}'"


def damaged(damage: tuple[tuple[str, str, str], ...]) -> str:
    """``line`` or what became of it, in SQL."""
    return f"CASE {' '.join(f'WHEN {c} THEN {text}' for c, _, text in damage)} ELSE line END"
