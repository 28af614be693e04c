"""ANSI SQL (DuckDB dialect) that checks the registered queries.

Inputs come from the shared projections; everything else is written
independently of the Spark code.
"""

from __future__ import annotations

from veilmark.functions.tiers import TIERS
from veilmark.plans.dated_views import SALT_VERSIONS, dated_sql
from veilmark.plans.payer_views import (
    BROKEN_CSV,
    DAMAGED_CSV,
    DAMAGED_JSON,
    OPEN_CSV,
    csv_line,
    damaged,
    json_line,
    payer_sql,
)
from veilmark.plans.queries import (
    EXACT_VALUES,
    MASK_QUERIES,
    NEW_BINDINGS,
    NEW_SALT,
    PURGED_BEFORE,
    SALT,
)
from veilmark.plans.tag_views import tag_sql
from veilmark.sources.model import ALLOWED_TAG_VALUES, FOREIGN_KEYS, TABLES


def _hash(c: str, salt: str = SALT) -> str:
    return f"'HID-' || left(sha256({c} || '{salt}'), 16)"


def _scrub(c: str) -> str:
    for pattern, label in (
        ("[A-Z][a-z]+ [A-Z][a-z]+", "[NAME]"),
        ("[0-9]{3}-[0-9]{2}-[0-9]{4}", "[SSN]"),
        ("[0-9]{3}-[0-9]{3}-[0-9]{4}", "[PHONE]"),
    ):
        c = f"regexp_replace({c}, '{pattern}', '{label}', 'g')"
    return c


def _range(c: str) -> str:
    return (
        f"CASE WHEN {c} >= 50000 THEN '$50K+' WHEN {c} >= 10000 THEN '$10K-$50K' "
        f"WHEN {c} >= 5000 THEN '$5K-$10K' WHEN {c} >= 1000 THEN '$1K-$5K' "
        f"WHEN {c} >= 500 THEN '$500-$1K' WHEN {c} >= 100 THEN '$100-$500' "
        f"WHEN {c} IS NOT NULL THEN '$0-$100' END"
    )


def _partial(function: str, c: str) -> str:
    return {
        "mask_ssn": f"'***-**-' || right({c}, 4)",
        "mask_name": f"left({c}, 1) || '****'",
        "mask_email": f"CASE WHEN contains({c}, '@') THEN left(split_part({c}, '@', 1), 1) "
        f"|| '***@' || split_part({c}, '@', 2) END",
        "mask_phone": f"'(***) ***-' || right(regexp_replace({c}, '[^0-9]', '', 'g'), 4)",
        "mask_date_of_birth": f"strftime({c}, '%Y-%m')",
        "mask_zip_code": f"left({c}, 3) || '**'",
        "mask_address": "'*** REDACTED ***'",
        "hash_identifier": _hash(c),
        "mask_financial_amount": _range(c),
        "mask_diagnosis_code": f"CASE WHEN contains({c}, '.') THEN split_part({c}, '.', 1) "
        f"|| '.x' WHEN {c} IS NOT NULL THEN '.x' END",
        "mask_drug_info": "'[Therapeutic Class]'",
        "mask_clinical_notes": _scrub(c),
        "mask_tax_id": f"'**-***' || right({c}, 4)",
        "mask_beneficiary_id": f"left({c}, 3) || '********'",
        "mask_redact": "'REDACTED'",
    }[function]


def _none(function: str, c: str) -> str:
    return {
        "mask_ssn": "'XXX-XX-XXXX'",
        "mask_phone": "'XXX-XXX-XXXX'",
        "mask_date_of_birth": f"strftime({c}, '%Y') || '-XX-XX'",
        "mask_zip_code": "'XXXXX'",
        "hash_identifier": _hash(c),
        "mask_clinical_notes": "'[CLINICAL NOTES REDACTED - REQUEST PHI ACCESS]'",
        "mask_tax_id": "'XX-XXXXXXX'",
        "mask_beneficiary_id": "'XXXXXXXXXXX'",
    }.get(function, "'REDACTED'")


def mask_sql(function: str, c: str, tier: str) -> str:
    """A mask as SQL over the column ``c``."""
    if tier == "full":
        return f"CAST({c} AS VARCHAR)"
    return _partial(function, c) if tier == "partial" else _none(function, c)


def _cte(*tables: str) -> str:
    return "WITH " + ", ".join(f"{t} AS ({payer_sql(t)})" for t in tables)


def _mask(name: str) -> str:
    table, key, columns = MASK_QUERIES[name]
    items = [f"{mask_sql(name, c, tier)} AS {c}_{tier}" for c in columns for tier in TIERS]
    return f"SELECT {key} AS key, {', '.join(items)} FROM ({payer_sql(table)}) t"


def masked_columns(table: str, tier: str) -> str:
    """All columns of a table as text, masked for a tier."""
    items = []
    for c in TABLES[table].columns:
        value = mask_sql(c.mask, c.name, tier) if c.mask else f"CAST({c.name} AS VARCHAR)"
        items.append(f"{value} AS {c.name}")
    return ", ".join(items)


def _masked(table: str, tier: str) -> str:
    return f"SELECT {masked_columns(table, tier)} FROM ({payer_sql(table)}) t"


def _load(table: str) -> str:
    items = [
        f"{'TIMESTAMP ' if c.type == 'timestamp' else ''}"
        f"{chr(39) + '2025-06-01' + chr(39) if c.type == 'timestamp' else c.name}"
        for c in TABLES[table].columns
    ]
    shown = ", ".join(
        f"CAST({item} AS VARCHAR) AS {c.name}"
        for item, c in zip(items, TABLES[table].columns, strict=True)
    )
    return f"SELECT {shown} FROM ({payer_sql(table)}) t"


def _orphans(child: str, fk: str, parent: str, pk: str) -> str:
    return (
        f"SELECT {fk} AS key_value, count(*) AS n_rows FROM ({payer_sql(child)}) c "
        f"WHERE {fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({payer_sql(parent)}) p "
        f"WHERE p.{pk} = c.{fk}) GROUP BY {fk}"
    )


def _member_rows(table: str, key: str) -> str:
    return (
        f"{_cte(table, 'members')} "
        f"SELECT t.{key}, t.member_id, m.state_code AS member_state_code, "
        f"m.plan_code AS member_plan_code, CAST(m.is_active AS VARCHAR) AS member_is_active "
        f"FROM {table} t LEFT JOIN members m ON m.member_id = t.member_id"
    )


def _latest(source: str, order: str, *keys: str) -> str:
    names = ", ".join(keys)
    return (
        f"SELECT {names}, tag_value FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {names} ORDER BY {order}) AS rn FROM ({tag_sql(source)}) l) r WHERE rn = 1"
    )


_COLUMN_TAGS = _latest(
    "column_tag_log",
    "ts DESC, event_id DESC, tag_value DESC",
    "schema_name",
    "table_name",
    "column_name",
    "tag_name",
)
_TABLE_TAGS = _latest(
    "table_tag_log", "p_partkey DESC, tag_value DESC", "schema_name", "table_name", "tag_name"
)


def _governed(text: str) -> str:
    return f"(SELECT * FROM ({text}) s WHERE schema_name = 'health_plan') g"


def _b1(limit: int) -> str:
    return (
        f"SELECT table_name, count(DISTINCT tag_name) AS tag_count FROM {_governed(_TABLE_TAGS)} "
        f"GROUP BY table_name HAVING count(DISTINCT tag_name) > {limit}"
    )


def _b2(limit: int) -> str:
    return (
        f"SELECT table_name, count(*) AS total_column_tags FROM {_governed(_COLUMN_TAGS)} "
        f"GROUP BY table_name HAVING count(*) > {limit}"
    )


def _b3(limit: int) -> str:
    return (
        f"SELECT tag_name, count(DISTINCT tag_value) AS distinct_values "
        f"FROM {_governed(_COLUMN_TAGS)} "
        f"GROUP BY tag_name HAVING count(DISTINCT tag_value) > {limit}"
    )


def _values(allowed: dict) -> str:
    rows = ", ".join(f"('{n}', '{v}')" for n, values in allowed.items() for v in values)
    return f"(VALUES {rows}) a(tag_name, tag_value)"


_CLASS = (
    "CASE WHEN second LIKE 'Non-sensitive%' THEN 'Non-sensitive' "
    "WHEN second LIKE 'Sensitive%' THEN 'Sensitive' WHEN second LIKE 'PHI%' THEN 'PHI' "
    "WHEN second LIKE 'PII%' THEN 'PII' END"
)
_DICTIONARY = (
    f"SELECT schema_name, table_name, column_name, comment, {_CLASS} AS column_class "
    f"FROM (SELECT *, CASE WHEN contains(comment, '. ') "
    f"THEN ltrim(substr(comment, position('. ' IN comment) + 2)) END AS second "
    f"FROM ({tag_sql('dictionary')}) d0) d1"
)
_KEYS = "schema_name, table_name, column_name"


def _class_tags() -> str:
    pivot = (
        f"SELECT {_KEYS}, bool_or(tag_name = 'contains_phi' AND tag_value = 'true') AS phi, "
        f"bool_or(tag_name = 'contains_pii' AND tag_value = 'true') AS pii "
        f"FROM ({tag_sql('dictionary_tags')}) t GROUP BY ALL"
    )
    implied = (
        "CASE WHEN phi AND pii THEN 'PHI and PII' WHEN phi THEN 'PHI' WHEN pii THEN 'PII' "
        "WHEN phi IS NOT NULL THEN 'Sensitive' ELSE 'Non-sensitive' END"
    )
    return (
        f"SELECT {_KEYS}, CAST(d.known IS NOT NULL AS VARCHAR) AS in_dictionary, "
        f"column_class, {implied} AS tag_class "
        f"FROM (SELECT *, 1 AS known FROM ({_DICTIONARY}) x) d "
        f"FULL JOIN ({pivot}) p USING ({_KEYS}) "
        f"WHERE d.known IS NULL OR column_class IS DISTINCT FROM {implied}"
    )


def _coverage() -> str:
    tagged = f"SELECT DISTINCT table_name, column_name FROM ({tag_sql('dictionary_tags')}) t"
    bound = f"SELECT DISTINCT table_name, column_name FROM ({tag_sql('bindings')}) b"
    return (
        f"SELECT *, 'tagged without mask' AS finding FROM ({tagged} EXCEPT {bound}) x "
        f"UNION ALL SELECT *, 'mask without tag' AS finding FROM ({bound} EXCEPT {tagged}) y"
    )


def _masking_rules() -> str:
    return (
        f"SELECT {_KEYS}, coalesce(max(CASE WHEN tag_name = 'masking_rule' THEN tag_value END), "
        f"'none') AS masking_rule FROM (SELECT {_KEYS}, NULL::VARCHAR AS tag_name, "
        f"NULL::VARCHAR AS tag_value FROM ({_DICTIONARY}) d UNION ALL "
        f"SELECT {_KEYS}, tag_name, tag_value FROM ({tag_sql('dictionary_tags')}) t) u "
        f"GROUP BY ALL"
    )


def _inheritance() -> str:
    return (
        f"WITH own AS ({tag_sql('own_table_tags')}) "
        f"SELECT schema_name, table_name, tag_name, tag_value, 'false' AS is_inherited FROM own "
        f"UNION ALL SELECT t.schema_name, t.table_name, s.tag_name, s.tag_value, 'true' "
        f"FROM ({tag_sql('catalog_tables')}) t JOIN ({tag_sql('schema_tag_rows')}) s "
        f"ON s.schema_name = t.schema_name WHERE NOT EXISTS (SELECT 1 FROM own o "
        f"WHERE o.schema_name = t.schema_name AND o.table_name = t.table_name "
        f"AND o.tag_name = s.tag_name)"
    )


def _schema_tags() -> str:
    return (
        f"WITH new AS (SELECT DISTINCT schema_name, 'compliance' AS tag_name, "
        f"'hitech' AS tag_value FROM ({tag_sql('catalog_tables')}) c) SELECT * FROM new "
        f"UNION ALL SELECT * FROM ({tag_sql('schema_tag_rows')}) s WHERE NOT EXISTS "
        f"(SELECT 1 FROM new n WHERE n.schema_name = s.schema_name AND n.tag_name = s.tag_name)"
    )


def _tiers() -> str:
    return (
        f"SELECT principal, CASE WHEN max(g) = 2 THEN 'full' WHEN max(g) = 1 THEN 'partial' "
        f"ELSE 'none' END AS tier FROM (SELECT principal, CASE group_name "
        f"WHEN 'phi_full_access' THEN 2 WHEN 'phi_partial_access' THEN 1 ELSE 0 END AS g "
        f"FROM ({tag_sql('principal_groups')}) p) r GROUP BY principal"
    )


def _by_reader() -> str:
    columns = (
        ("member_id", "hash_identifier"),
        ("service_date_from", "mask_date_of_birth"),
        ("diagnosis_code_primary", "mask_diagnosis_code"),
        ("paid_amount", "mask_financial_amount"),
    )
    items = ", ".join(
        f"CASE claim_status WHEN 'Paid' THEN {mask_sql(f, c, 'full')} "
        f"WHEN 'Denied' THEN {mask_sql(f, c, 'partial')} ELSE {mask_sql(f, c, 'none')} END AS {c}"
        for c, f in columns
    )
    return f"SELECT claim_id, {items} FROM ({payer_sql('claims')}) t"


def _sql_masks(table: str) -> str:
    items = ", ".join(
        f"{mask_sql(function, column, tier)} AS {column}_{tier}"
        for column, function in TABLES[table].policy.items()
        for tier in TIERS
    )
    return f"SELECT {TABLES[table].key} AS key, {items} FROM ({payer_sql(table)}) t"


def _by_policy() -> str:
    bound = {c.name: c.mask for c in TABLES["providers"].columns} | NEW_BINDINGS
    items = [
        f"{mask_sql(f, n, 'partial') if f else f'CAST({n} AS VARCHAR)'} AS {n}"
        for n, f in bound.items()
    ]
    return f"SELECT {', '.join(items)} FROM ({payer_sql('providers')}) t"


_SPOILED = (
    "effective_date = DATE '2020-01-08' OR group_number = 'GRP-7' OR group_number = 'GRP-9'"
)


def _rejected() -> str:
    bad = (
        "CASE WHEN effective_date = DATE '2020-01-08' THEN 'effective_date' END, "
        "CASE WHEN group_number = 'GRP-9' THEN 'cobra_flag' END, "
        "CASE WHEN group_number = 'GRP-7' THEN 'premium_amount' END"
    )
    return (
        f"SELECT eligibility_id, concat_ws(',', {bad}) AS reasons "
        f"FROM ({payer_sql('eligibility')}) t WHERE {_SPOILED}"
    )


def _lines(line: str) -> str:
    texts = ", ".join(f"CAST({c.name} AS VARCHAR) AS {c.name}" for c in TABLES["eligibility"].columns)
    return (
        f"t AS (SELECT {texts} FROM ({payer_sql('eligibility')}) e), "
        f"l AS (SELECT *, {line} AS line FROM t)"
    )


def _raw_accepted(damage: tuple, *, broken: bool) -> str:
    condition, old, new = BROKEN_CSV
    spoilt = " OR ".join(c for c, _, _ in damage)
    names = [c.name for c in TABLES["eligibility"].columns]
    shown = [
        f"CASE WHEN {condition} THEN replace({n}, {old}, {new}) ELSE {n} END AS {n}"
        if broken and n == "plan_description"
        else n
        for n in names
    ]
    return f"WITH {_lines(csv_line('eligibility'))} SELECT {', '.join(shown)} FROM l WHERE NOT ({spoilt})"


def _raw_rejected(line: str, damage: tuple) -> str:
    spoilt = " OR ".join(c for c, _, _ in damage)
    kinds = " ".join(f"WHEN {c} THEN '{kind}'" for c, kind, _ in damage)
    return (
        f"WITH {_lines(line)} SELECT CASE {kinds} END AS reasons, "
        f"{damaged(damage)} AS raw_record FROM l WHERE {spoilt}"
    )


def _csv_rejected() -> str:
    condition, old, new = BROKEN_CSV
    halves = (
        f"SELECT 'open quote' AS reasons, unnest(string_split(replace(line, {old}, {new}), chr(10))) "
        f"AS raw_record FROM l WHERE {condition}"
    )
    return f"{_raw_rejected(csv_line('eligibility'), (*DAMAGED_CSV, OPEN_CSV))} UNION ALL {halves}"


def _deid_join() -> str:
    return (
        f"{_cte('claims', 'members')}, c AS (SELECT claim_id, {_hash('member_id')} AS member_id, "
        f"{_none('mask_date_of_birth', 'service_date_from')} AS service_date_from FROM claims), "
        f"m AS (SELECT {_hash('member_id')} AS m_id, "
        f"{_none('mask_date_of_birth', 'date_of_birth')} AS members_date_of_birth, "
        f"state_code AS members_state_code, 'XXX-XX-XXXX' AS members_ssn FROM members) "
        f"SELECT claim_id, member_id, service_date_from, members_date_of_birth, "
        f"members_state_code, members_ssn FROM c JOIN m ON m_id = member_id"
    )


def _masked_join() -> str:
    return (
        f"{_cte('claims', 'members')}, c AS (SELECT claim_id, {_hash('member_id')} AS member_id, "
        f"{_range('billed_amount')} AS billed_amount FROM claims), "
        f"m AS (SELECT {_hash('member_id')} AS m_id, left(zip_code, 3) || '**' AS zip_code, "
        f"state_code FROM members) "
        f"SELECT claim_id, member_id, billed_amount, zip_code, state_code "
        f"FROM c JOIN m ON m_id = member_id"
    )


def _cost_by_state() -> str:
    return (
        f"{_cte('claims', 'members')} "
        f"SELECT state_code, {_range('billed_amount')} AS amount_range, "
        f"count(*) AS n_claims, count(DISTINCT {_hash('c.member_id')}) AS n_members "
        f"FROM claims c JOIN members m ON {_hash('c.member_id')} = {_hash('m.member_id')} "
        f"GROUP BY ALL"
    )


def _cohort() -> str:
    dx = _partial("mask_diagnosis_code", "diagnosis_code_primary")
    return (
        f"{_cte('claims', 'members')} SELECT strftime(date_of_birth, '%Y-%m') AS cohort, "
        f"{dx} AS diagnosis, count(*) AS n_claims, "
        f"count(DISTINCT {_hash('c.member_id')}) AS n_members "
        f"FROM claims c JOIN members m ON {_hash('c.member_id')} = {_hash('m.member_id')} "
        f"GROUP BY ALL"
    )


def _authorizations() -> str:
    return (
        f"{_cte('claims', 'prior_authorizations')} SELECT claim_id, claim_status, "
        f"authorization_number, auth_id, auth_type, auth_status "
        f"FROM claims LEFT JOIN prior_authorizations ON auth_id = authorization_number"
    )


def _nested_tiers() -> str:
    return (
        f"WITH RECURSIVE e AS ({dated_sql('nested_groups')}), p AS ({dated_sql('memberships')}), "
        f"r(g, tier) AS (SELECT * FROM (VALUES ('phi_full_access', 2), "
        f"('phi_partial_access', 1)) v UNION SELECT e.group_name, r.tier FROM e JOIN r "
        f"ON e.parent_group = r.g WHERE e.group_name IS NOT NULL) "
        f"SELECT principal, CASE max(tier) WHEN 2 THEN 'full' WHEN 1 THEN 'partial' ELSE 'none' "
        f"END AS tier FROM p LEFT JOIN r ON r.g = p.group_name GROUP BY principal"
    )


def _by_schema() -> str:
    bound = {c.name: c.mask for c in TABLES["providers"].columns if c.mask}
    shown = ("provider_id", "npi", "tax_id", "dea_number")

    def one(schema: str, functions: dict) -> str:
        items = [mask_sql(functions[n], n, "none") if n in functions else n for n in shown]
        named = ", ".join(f"{i} AS {n}" for i, n in zip(items, shown, strict=True))
        return f"SELECT '{schema}' AS schema_name, {named} FROM ({payer_sql('providers')}) t"

    # The sandbox has the two new bindings and no others.
    return f"{one('health_plan', bound)} UNION ALL {one('sandbox', NEW_BINDINGS)}"


def _by_readers(readers: dict[str, str]) -> str:
    columns = (
        ("service_date_from", "mask_date_of_birth"),
        ("diagnosis_code_primary", "mask_diagnosis_code"),
        ("member_id", "hash_identifier"),
    )
    return " UNION ALL ".join(
        f"SELECT '{reader}' AS reader, claim_id, "
        + ", ".join(f"{mask_sql(f, c, tier)} AS {c}" for c, f in columns)
        + f" FROM ({payer_sql('claims')}) t"
        for reader, tier in readers.items()
    )


def _notes_linked() -> str:
    """Replaced by whole words of the full name, the last and the first name."""

    def gone(text: str, name: str) -> str:
        return (
            f"CASE WHEN length({name}) >= 2 THEN regexp_replace({text}, '\\b' || "
            f"regexp_escape({name}) || '\\b', '[NAME]', 'gi') ELSE {text} END"
        )

    return (
        f"WITH n AS ({dated_sql('linked_notes')}), m AS ({payer_sql('members')}), "
        f"j AS (SELECT n.*, coalesce(last_name, '') AS l, coalesce(first_name, '') AS f "
        f"FROM n LEFT JOIN m USING (member_id)), "
        f"a AS (SELECT *, {gone('clinical_notes', 'l')} AS once FROM j), "
        f"b AS (SELECT *, {gone('once', 'f')} AS twice FROM a) "
        f"SELECT auth_id, member_id, {_scrub('twice')} AS clinical_notes FROM b"
    )


def _properties() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t.name}' AS table_name, '{key}' AS property, '{value}' AS value, "
        f"(SELECT count(*) FROM ({payer_sql(t.name)}) t) AS n_rows"
        for t in TABLES.values()
        for key, value in {**t.properties, "comment": t.comment}.items()
    )


def _drift() -> str:
    ssn = next(c.comment for c in TABLES["members"].columns if c.name == "ssn")
    rows = (
        ("members", "ssn", "comment", ssn, "A number"),
        ("claims", "note", "column", None, "note"),
        ("claims", "quality", "property", "gold", "bronze"),
        ("providers", "domain", "property", "provider", None),
        ("eligibility", "comment", "property", TABLES["eligibility"].comment, "Spans"),
        ("pharmacy_claims", None, "table", "pharmacy_claims", None),
    )
    texts = ", ".join(
        "(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in rows
    )
    return f"SELECT * FROM (VALUES {texts}) d(table_name, item, fact, expected, found)"


def _rekey_versions() -> str:
    last = SALT_VERSIONS - 1
    new = _hash("c.member_id", f"{SALT}_{last}")
    return (
        f"WITH c AS ({dated_sql('versioned_claims')}), m AS ({payer_sql('members')}) "
        f"SELECT claim_id, CASE WHEN salt_version = {last} THEN {new} "
        f"WHEN salt_version <= 2 AND c.member_id = 'M-5' THEN NULL "
        f"WHEN salt_version IS NOT NULL AND m.member_id IS NOT NULL THEN {new} END AS member_id, "
        f"{last} AS salt_version FROM c LEFT JOIN m ON m.member_id = c.member_id"
    )


def _purge_report() -> str:
    day = f"DATE '{PURGED_BEFORE}'"
    return (
        f"WITH t AS ({payer_sql('pharmacy_claims')}), p AS (SELECT strftime(fill_date, '%Y-%m') "
        f"AS m, count(*) AS n, count(*) FILTER (WHERE fill_date < {day}) AS e FROM t GROUP BY 1) "
        f"SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(e) AS BIGINT) AS n_removed, "
        f"count(*) FILTER (WHERE n = e) AS dropped, "
        f"count(*) FILTER (WHERE e > 0 AND e < n) AS rewritten, "
        f"count(*) FILTER (WHERE e = 0) AS untouched FROM p"
    )


def _sketched() -> str:
    return (
        f"SELECT tag_name, CASE WHEN count(DISTINCT tag_value) <= {EXACT_VALUES} "
        f"THEN count(DISTINCT tag_value) END AS few_values, true AS is_within "
        f"FROM ({tag_sql('column_tag_log')}) l WHERE schema_name = 'health_plan' "
        f"GROUP BY tag_name HAVING count(DISTINCT tag_value) > 1"
    )


def _in_authorization() -> str:
    """Every pair of a claim and an authorization of its member."""
    return (
        f"WITH c AS ({dated_sql('claims')}), a AS ({dated_sql('authorizations')}), "
        f"v AS (SELECT claim_id, auth_id, effective_date FROM c JOIN a USING (member_id) "
        f"WHERE service_date_from >= effective_date "
        f"AND service_date_from <= coalesce(expiration_date, DATE '9999-12-31')), "
        f"r AS (SELECT claim_id, count(*) AS n, arg_max(auth_id, (effective_date, auth_id)) AS a "
        f"FROM v GROUP BY claim_id) "
        f"SELECT claim_id, coalesce(n, 0) AS n_valid, a AS auth_id FROM c LEFT JOIN r USING (claim_id)"
    )


def _covered_days(by: str) -> str:
    """Islands of single days: independent of how spans are merged."""
    return (
        f"e AS ({dated_sql('coverage')}), "
        f"open AS (SELECT {by}, min(effective_date) AS open_from FROM e WHERE member_id IS NOT NULL "
        f"AND termination_date IS NULL AND effective_date IS NOT NULL GROUP BY {by}), "
        f"days AS (SELECT DISTINCT {by}, CAST(unnest(generate_series(effective_date, "
        f"termination_date, INTERVAL 1 DAY)) AS DATE) AS day FROM e WHERE member_id IS NOT NULL "
        f"AND effective_date IS NOT NULL AND termination_date IS NOT NULL), "
        f"all_days AS (SELECT d.* FROM days d WHERE NOT EXISTS (SELECT 1 FROM open o WHERE "
        f"{' AND '.join(f'o.{k.strip()} IS NOT DISTINCT FROM d.{k.strip()}' for k in by.split(','))} "
        f"AND d.day >= open_from) UNION ALL SELECT * FROM open), "
        f"runs AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY {by} ORDER BY day) AS INT) "
        f"AS run FROM all_days), "
        f"plain AS (SELECT {by}, min(day) AS span_start, max(day) AS last_day FROM runs "
        f"GROUP BY {by}, run), "
        f"spans AS (SELECT p.* EXCLUDE (last_day), CASE WHEN open_from = last_day THEN NULL ELSE "
        f"last_day END AS span_end FROM plain p LEFT JOIN open o ON "
        f"{' AND '.join(f'o.{k.strip()} IS NOT DISTINCT FROM p.{k.strip()}' for k in by.split(','))})"
    )


_MEMBER_TYPE = "member_id, coverage_type"


def _spans() -> str:
    return (
        f"WITH {_covered_days(_MEMBER_TYPE)} SELECT member_id, coverage_type, "
        f"CAST(span_start AS VARCHAR) AS span_start, CAST(span_end AS VARCHAR) AS span_end, "
        f"CAST((SELECT count(*) FROM e WHERE e.member_id = s.member_id "
        f"AND e.coverage_type IS NOT DISTINCT FROM s.coverage_type "
        f"AND effective_date >= span_start AND effective_date <= coalesce(span_end, "
        f"DATE '9999-12-31') AND effective_date <= coalesce(termination_date, effective_date)) "
        f"AS VARCHAR) AS n_rows FROM spans s"
    )


def _gaps() -> str:
    return (
        f"WITH {_covered_days(_MEMBER_TYPE)}, g AS (SELECT member_id, coverage_type, "
        f"span_end + 1 AS gap_start, (SELECT min(n.span_start) FROM spans n "
        f"WHERE n.member_id = s.member_id AND n.coverage_type IS NOT DISTINCT FROM s.coverage_type "
        f"AND n.span_start > s.span_start) - 1 AS gap_end FROM spans s) "
        f"SELECT member_id, coverage_type, CAST(gap_start AS VARCHAR) AS gap_start, "
        f"CAST(gap_end AS VARCHAR) AS gap_end, CAST(gap_end - gap_start + 1 AS VARCHAR) AS n_days "
        f"FROM g WHERE gap_end IS NOT NULL"
    )


def _uncovered() -> str:
    return (
        f"WITH {_covered_days('member_id')}, c AS ({dated_sql('claims')}), "
        f"l AS (SELECT c.*, (SELECT max(s.span_start) FROM spans s WHERE s.member_id = c.member_id "
        f"AND s.span_start <= service_date_from) AS latest FROM c), "
        f"r AS (SELECT l.*, span_end, CASE WHEN l.member_id IS NULL THEN 'no member' "
        f"WHEN service_date_from IS NULL THEN 'no date' WHEN latest IS NULL THEN 'never covered' "
        f"WHEN span_end < service_date_from THEN 'not covered' END AS reason FROM l "
        f"LEFT JOIN spans s ON s.member_id = l.member_id AND s.span_start = latest) "
        f"SELECT claim_id, member_id, CAST(service_date_from AS VARCHAR) AS service_date_from, "
        f"CAST(span_end AS VARCHAR) AS last_covered, reason FROM r WHERE reason IS NOT NULL"
    )


def _age_cap() -> str:
    def capped(value):
        return f"CASE WHEN date_of_birth <= DATE '1936-12-03' THEN '90+' ELSE {value} END"

    return (
        f"SELECT member_id AS key, CAST(date_of_birth AS VARCHAR) AS birth_full, "
        f"{capped(_partial('mask_date_of_birth', 'date_of_birth'))} AS birth_partial, "
        f"{capped(_none('mask_date_of_birth', 'date_of_birth'))} AS birth_none "
        f"FROM ({payer_sql('members')}) t"
    )


def _zip3() -> str:
    return (
        f"{_cte('members')}, people AS (SELECT left(zip_code, 3) AS zip3, "
        f"count(*) * 10000 AS population FROM members GROUP BY 1) "
        f"SELECT member_id AS key, CASE WHEN zip_code IS NULL THEN NULL "
        f"WHEN population >= 20000 AND regexp_full_match(zip3, '[0-9]{{3}}') "
        f"THEN zip3 || '**' ELSE '000**' END AS zip_code "
        f"FROM members LEFT JOIN people ON zip3 = left(zip_code, 3)"
    )


def _rotation() -> str:
    return (
        f"SELECT DISTINCT {_hash('member_id')} AS old_hid, "
        f"{_hash('member_id', NEW_SALT)} AS new_hid "
        f"FROM ({payer_sql('claims')}) t WHERE member_id IS NOT NULL"
    )


def _rekey() -> str:
    return (
        f"{_cte('claims', 'members')} SELECT claim_id, "
        f"{_hash('m.member_id', NEW_SALT)} AS member_id "
        f"FROM claims c LEFT JOIN members m ON m.member_id = c.member_id"
    )


_DRG_LISTED = (
    "(SELECT CASE WHEN n_nationkey < 3 THEN 'MS-' ELSE '' END || (n_nationkey + 100) AS code, "
    "'MDC ' || n_regionkey AS mdc FROM nation "
    "UNION ALL SELECT '107', 'MDC X' FROM nation WHERE n_nationkey = 7)"
)


def _mdc() -> str:
    return (
        f"SELECT claim_id, drg_code, CASE WHEN drg_code IS NOT NULL THEN "
        f"coalesce(mdc, 'REDACTED') END AS drg_mdc FROM ({payer_sql('claims')}) t "
        f"LEFT JOIN (SELECT code, any_value(mdc) AS mdc FROM {_DRG_LISTED} x GROUP BY code "
        f"HAVING count(DISTINCT mdc) = 1) l ON code = drg_code"
    )


def _drg_report() -> str:
    return (
        f"SELECT drg_code AS code, 'not listed' AS problem, count(*) AS n_rows "
        f"FROM ({payer_sql('claims')}) t WHERE drg_code IS NOT NULL "
        f"AND drg_code NOT IN (SELECT code FROM {_DRG_LISTED} x) GROUP BY drg_code "
        f"UNION ALL SELECT code, 'several values', count(*) FROM {_DRG_LISTED} x "
        f"GROUP BY code HAVING count(DISTINCT mdc) > 1"
    )


def _retention() -> str:
    parts = (
        ("claims", "received_date", "10_year", "1998-06-01"),
        ("pharmacy_claims", "fill_date", "10_year", "1998-06-01"),
        ("prior_authorizations", "request_date", "7_year", "2001-06-01"),
    )
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS retention, '{start}' AS keep_from, "
        f"count(*) AS n_rows, count(*) FILTER (WHERE {day} < DATE '{start}') AS n_expired "
        f"FROM ({payer_sql(t)}) t"
        for t, day, rule, start in parts
    )


def _counts(table: str, items: dict[str, str], count: str) -> str:
    keys = ", ".join(f"{expr} AS {name}" for name, expr in items.items())
    return f"SELECT {keys}, {count} FROM ({payer_sql(table)}) t GROUP BY ALL"


def checks() -> dict[str, str]:
    """Query name to check SQL."""
    found = {name: _mask(name) for name in MASK_QUERIES}
    for table in TABLES:
        found[f"load_{table}"] = _load(table)
        found[f"masked_view_{table}"] = _masked(table, "partial")
        for tier in TIERS:
            found[f"masked_{table}_{tier}"] = _masked(table, tier)
    for child, fk, parent, pk in FOREIGN_KEYS:
        found[f"orphans_{child}_{fk}"] = _orphans(child, fk, parent, pk)
        if parent == "members":
            found[f"member_of_{child}"] = _member_rows(child, TABLES[child].key)
    dx = _partial("mask_diagnosis_code", "diagnosis_code_primary")
    n_members = "count(*) AS n_members"
    found |= {
        "tier_resolution": _tiers(),
        "tier_resolution_nested": _nested_tiers(),
        "masked_by_reader": _by_reader(),
        "sql_function_masks": _sql_masks("members"),
        **{f"sql_function_masks_{t}": _sql_masks(t) for t in TABLES if t != "members"},
        "masked_by_policy": _by_policy(),
        "masked_by_schema": _by_schema(),
        "group_function": _by_readers(
            {"ana": "full", "ben": "partial", "cy": "none", "dee": "none"}
        ),
        "session_tier": _by_readers(
            {"full": "full", "partial": "partial", "none": "none", "boss": "none"}
        ),
        "notes_linked": _notes_linked(),
        "table_properties": _properties(),
        "catalog_drift": _drift(),
        "masked_export": _masked("eligibility", "partial"),
        "masked_stream": f"SELECT o_orderkey AS key, "
        f"{_hash('CAST(o_custkey AS VARCHAR)')} AS o_custkey, "
        f"{_range('CAST(o_totalprice AS DECIMAL(12,2))')} AS o_totalprice FROM orders",
        "replace_and_append": f"SELECT {masked_columns('eligibility', 'full')} "
        f"FROM (SELECT * FROM ({payer_sql('eligibility')}) a "
        f"UNION ALL SELECT * FROM ({payer_sql('eligibility')}) b) t",
        "failed_replace": f"SELECT {masked_columns('eligibility', 'full')}, "
        f"'{TABLES['eligibility'].comment}' AS table_comment "
        f"FROM ({payer_sql('eligibility')}) t",
        "ingest_accepted": "SELECT "
        + ", ".join(f"CAST({c.name} AS VARCHAR) AS {c.name}" for c in TABLES["eligibility"].columns)
        + f" FROM ({payer_sql('eligibility')}) t WHERE NOT ({_SPOILED})",
        "ingest_rejected": _rejected(),
        "load_csv_accepted": _raw_accepted(DAMAGED_CSV, broken=True),
        "load_csv_rejected": _csv_rejected(),
        "load_json_accepted": _raw_accepted(DAMAGED_JSON, broken=False),
        "load_json_rejected": _raw_rejected(json_line("eligibility"), DAMAGED_JSON),
        "set_column_tags": _COLUMN_TAGS,
        "set_table_tags": _TABLE_TAGS,
        "set_schema_tags": _schema_tags(),
        "audit_b1": _b1(40),
        "audit_b1_low": _b1(1),
        "audit_b2": _b2(800),
        "audit_b2_low": _b2(100),
        "audit_b3": _b3(50),
        "audit_b3_low": _b3(1),
        "audit_b4": f"SELECT DISTINCT tag_name FROM {_governed(_COLUMN_TAGS)} "
        f"WHERE NOT regexp_full_match(tag_name, '[a-z0-9_]+')",
        "audit_b5": f"SELECT table_name, column_name, tag_value AS hipaa_identifier_type "
        f"FROM {_governed(_COLUMN_TAGS)} WHERE tag_name = 'hipaa_type'",
        "audit_b6": f"SELECT table_name, column_name, "
        f"max(tag_value) FILTER (WHERE tag_name = 'masking_rule') AS masking_rule, "
        f"max(tag_value) FILTER (WHERE tag_name = 'sensitivity_level') AS sensitivity "
        f"FROM {_governed(_COLUMN_TAGS)} "
        f"WHERE tag_name IN ('masking_rule', 'sensitivity_level') GROUP BY ALL",
        "tag_value_violations": f"SELECT * FROM ({_COLUMN_TAGS}) t "
        f"WHERE tag_name IN (SELECT tag_name FROM {_values(ALLOWED_TAG_VALUES)}) "
        f"AND NOT EXISTS (SELECT 1 FROM {_values(ALLOWED_TAG_VALUES)} "
        f"WHERE a.tag_name = t.tag_name AND a.tag_value = t.tag_value)",
        "tag_naming_violations": f"SELECT * FROM ({_COLUMN_TAGS}) t "
        f"WHERE NOT regexp_full_match(tag_name, '[a-z0-9_]+') "
        f"OR NOT regexp_full_match(tag_value, '[a-z0-9_]+')",
        "tag_inheritance": _inheritance(),
        "data_dictionary": _DICTIONARY,
        "masking_rules": _masking_rules(),
        "class_tag_consistency": _class_tags(),
        "policy_coverage": _coverage(),
        "deid_join": _deid_join(),
        "masked_join": _masked_join(),
        "deid_cost_by_state": _cost_by_state(),
        "claim_authorizations": _authorizations(),
        "claims_in_authorization": _in_authorization(),
        "coverage_spans": _spans(),
        "coverage_gaps": _gaps(),
        "claims_uncovered": _uncovered(),
        "cost_trend": _counts(
            "claims",
            {
                "service_month": "strftime(service_date_from, '%Y-%m')",
                "amount_range": _range("paid_amount"),
            },
            "count(*) AS n_claims",
        ),
        "cohort_by_month": _counts(
            "members", {"cohort": "strftime(date_of_birth, '%Y-%m')"}, n_members
        ),
        "cohort_by_year": _counts(
            "members", {"cohort": "strftime(date_of_birth, '%Y') || '-XX-XX'"}, n_members
        ),
        "dx_prevalence": _counts(
            "claims",
            {"diagnosis": dx},
            "count(*) AS n_claims, count(DISTINCT member_id) AS n_members",
        ),
        "zip3_counts": _counts(
            "members", {"state_code": "state_code", "zip3": "left(zip_code, 3) || '**'"}, n_members
        ),
        "deid_cohort": _cohort(),
        "verify_last4": f"SELECT {_hash('member_id')} AS member_id, "
        f"left(last_name, 1) || '****' AS last_name, '***-**-' || right(ssn, 4) AS ssn "
        f"FROM ({payer_sql('members')}) t WHERE right(ssn, 4) = '0343'",
        "age_cap": _age_cap(),
        "zip3_population": _zip3(),
        "salt_rotation": _rotation(),
        "salt_rekey": _rekey(),
        "drg_to_mdc": _mdc(),
        "drg_lookup_report": _drg_report(),
        "retention_report": _retention(),
        "retention_purge": f"SELECT rx_claim_id, CAST(fill_date AS VARCHAR) AS fill_date, "
        f"strftime(fill_date, '%Y-%m') AS fill_month FROM ({payer_sql('pharmacy_claims')}) t "
        f"WHERE fill_date >= DATE '{PURGED_BEFORE}'",
        "retention_purge_report": _purge_report(),
        "audit_b3_sketched": _sketched(),
        "salt_rekey_versions": _rekey_versions(),
    }
    return found
