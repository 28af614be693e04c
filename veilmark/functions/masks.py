"""Masking functions: value column and tier in, STRING column out.

All are compositions of built-in expressions, so they stay inside generated
code, run on batch and streaming DataFrames alike, and let a filter on an
unmasked column reach the scan. A NULL input is NULL at tier ``full``; at
tier ``none`` a constant token also replaces NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilmark.functions.tiers import pick

# Tokens, labels, bucket limits and patterns of masked output.
REDACTED = "REDACTED"
SSN_TOKEN = "XXX-XX-XXXX"
SSN_PREFIX = "***-**-"
NAME_SUFFIX = "****"
EMAIL_INFIX = "***@"
PHONE_TOKEN = "XXX-XXX-XXXX"
PHONE_PREFIX = "(***) ***-"
YEAR_SUFFIX = "-XX-XX"
ZIP_TOKEN = "XXXXX"
ZIP_SUFFIX = "**"
ADDRESS_PLACEHOLDER = "*** REDACTED ***"
HASH_PREFIX = "HID-"
HASH_CHARS = 16
DIAGNOSIS_SUFFIX = ".x"
DRUG_PLACEHOLDER = "[Therapeutic Class]"
NOTES_TOKEN = "[CLINICAL NOTES REDACTED - REQUEST PHI ACCESS]"
TAX_ID_TOKEN = "XX-XXXXXXX"
TAX_ID_PREFIX = "**-***"
BENEFICIARY_TOKEN = "XXXXXXXXXXX"
BENEFICIARY_SUFFIX = "********"
AMOUNT_BUCKETS = (
    (100, "$0-$100"),
    (500, "$100-$500"),
    (1000, "$500-$1K"),
    (5000, "$1K-$5K"),
    (10000, "$5K-$10K"),
    (50000, "$10K-$50K"),
)
AMOUNT_TOP_BUCKET = "$50K+"
NOTE_PATTERNS = (
    (r"[A-Z][a-z]+ [A-Z][a-z]+", "[NAME]"),
    (r"\d{3}-\d{2}-\d{4}", "[SSN]"),
    (r"\d{3}-\d{3}-\d{4}", "[PHONE]"),
)

AMOUNT_TYPE = "decimal(12,2)"


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _first(value: Column, chars: int) -> Column:
    return F.substring(value, 1, chars)


def _last(value: Column, chars: int) -> Column:
    return F.right(value, F.lit(chars))


def mask_ssn(value: Column | str, tier: str | Column) -> Column:
    """Last four characters at tier partial."""
    text = _text(value)
    return pick(
        tier,
        lambda: text,
        lambda: F.concat(F.lit(SSN_PREFIX), _last(text, 4)),
        lambda: F.lit(SSN_TOKEN),
    )


def mask_name(value: Column | str, tier: str | Column) -> Column:
    """First character at tier partial, whatever the length of the name."""
    text = _text(value)
    return pick(
        tier,
        lambda: text,
        lambda: F.concat(_first(text, 1), F.lit(NAME_SUFFIX)),
        lambda: F.lit(REDACTED),
    )


def mask_email(value: Column | str, tier: str | Column) -> Column:
    """First character and domain at tier partial; NULL without an ``@``.

    Of an address with several ``@`` only the part between the first two is
    kept as domain.
    """
    text = _text(value)

    def partial():
        parts = F.split(text, "@", 3)
        return F.concat(_first(F.get(parts, 0), 1), F.lit(EMAIL_INFIX), F.get(parts, 1))

    return pick(tier, lambda: text, partial, lambda: F.lit(REDACTED))


def mask_phone(value: Column | str, tier: str | Column) -> Column:
    """Last four digits at tier partial; everything but ASCII digits is ignored."""
    text = _text(value)

    def partial():
        digits = F.regexp_replace(text, r"[^0-9]+", "")
        return F.concat(F.lit(PHONE_PREFIX), _last(digits, 4))

    return pick(tier, lambda: text, partial, lambda: F.lit(PHONE_TOKEN))


def mask_date_of_birth(value: Column | str, tier: str | Column) -> Column:
    """ISO date, year and month, or year only; NULL stays NULL in every tier."""
    day = (F.col(value) if isinstance(value, str) else value).cast("date")
    return pick(
        tier,
        lambda: day.cast("string"),
        lambda: F.date_format(day, "yyyy-MM"),
        lambda: F.concat(F.year(day).cast("string"), F.lit(YEAR_SUFFIX)),
    )


def mask_zip_code(value: Column | str, tier: str | Column) -> Column:
    """Three leading characters at tier partial."""
    text = _text(value)
    return pick(
        tier,
        lambda: text,
        lambda: F.concat(_first(text, 3), F.lit(ZIP_SUFFIX)),
        lambda: F.lit(ZIP_TOKEN),
    )


def mask_address(value: Column | str, tier: str | Column) -> Column:
    """Constants below tier full, also for NULL, so the column need not be read."""
    return pick(
        tier,
        lambda: _text(value),
        lambda: F.lit(ADDRESS_PLACEHOLDER),
        lambda: F.lit(REDACTED),
    )


def hash_identifier(
    value: Column | str,
    tier: str | Column,
    salt: str | None = None,
    digest_chars: int = HASH_CHARS,
) -> Column:
    """Salted SHA-256 below tier full; equal inputs stay equal across tables.

    16 hex characters are 64 bits: about a 3% chance of one collision among
    10^9 distinct identifiers. Raise ``digest_chars`` (at most 64) beyond that.
    """
    text = _text(value)
    if isinstance(tier, str) and tier == "full":
        return text
    if not salt:
        raise ValueError("hash_identifier needs a non-empty salt below tier full")
    if not 1 <= digest_chars <= 64:
        raise ValueError("digest_chars must be between 1 and 64")

    def hashed():
        digest = F.sha2(F.concat(text, F.lit(salt)), 256)
        return F.concat(F.lit(HASH_PREFIX), _first(digest, digest_chars))

    return pick(tier, lambda: text, hashed, hashed)


def amount_bucket(amount: Column) -> Column:
    """Label of the half-open range an amount falls into; NULL stays NULL."""
    label = F.when(amount.isNull(), None)
    for limit, name in AMOUNT_BUCKETS:
        label = label.when(amount < limit, name)
    return label.otherwise(AMOUNT_TOP_BUCKET)


def mask_financial_amount(value: Column | str, tier: str | Column) -> Column:
    """Range label at tier partial; the exact amount as text at tier full."""
    amount = (F.col(value) if isinstance(value, str) else value).cast(AMOUNT_TYPE)
    return pick(
        tier,
        lambda: amount.cast("string"),
        lambda: amount_bucket(amount),
        lambda: F.lit(REDACTED),
    )


def mask_diagnosis_code(
    value: Column | str, tier: str | Column, keep_undotted: bool = False
) -> Column:
    """Category (the text before the first dot) at tier partial.

    A code without a dot has an empty category and becomes ``.x``. With
    ``keep_undotted`` a three-character code keeps its text as category when
    it starts with a letter, and anything else without a dot is redacted.
    """
    text = _text(value)

    def partial():
        category = F.concat(F.substring_index(text, ".", 1), F.lit(DIAGNOSIS_SUFFIX))
        whole = text.isNull() | text.contains(".")
        undotted = F.lit(DIAGNOSIS_SUFFIX)
        if keep_undotted:
            whole = whole | text.rlike(r"^[A-Za-z][0-9A-Za-z]{2}$")
            undotted = F.lit(REDACTED)
        return F.when(whole, category).otherwise(undotted)

    return pick(tier, lambda: text, partial, lambda: F.lit(REDACTED))


def mask_drug_info(value: Column | str, tier: str | Column) -> Column:
    """Constants below tier full, also for NULL."""
    return pick(
        tier,
        lambda: _text(value),
        lambda: F.lit(DRUG_PLACEHOLDER),
        lambda: F.lit(REDACTED),
    )


def mask_clinical_notes(value: Column | str, tier: str | Column) -> Column:
    """Patterns of names, SSNs and phone numbers replaced at tier partial.

    The patterns run one after the other over the whole text: a digit run that
    could be read as both an SSN and a phone number is taken as an SSN. Numbers
    need a hyphen, which no name pattern touches, so text without one is spared
    the passes for them.
    """
    text = _text(value)

    def partial():
        (name, name_label), *numbers = NOTE_PATTERNS
        nameless = F.regexp_replace(text, name, name_label)
        scrubbed = nameless
        for pattern, label in numbers:
            scrubbed = F.regexp_replace(scrubbed, pattern, label)
        return F.when(text.contains("-"), scrubbed).otherwise(nameless)

    return pick(tier, lambda: text, partial, lambda: F.lit(NOTES_TOKEN))


def mask_tax_id(value: Column | str, tier: str | Column) -> Column:
    """Last four characters at tier partial."""
    text = _text(value)
    return pick(
        tier,
        lambda: text,
        lambda: F.concat(F.lit(TAX_ID_PREFIX), _last(text, 4)),
        lambda: F.lit(TAX_ID_TOKEN),
    )


def mask_beneficiary_id(value: Column | str, tier: str | Column) -> Column:
    """Three leading characters at tier partial."""
    text = _text(value)
    return pick(
        tier,
        lambda: text,
        lambda: F.concat(_first(text, 3), F.lit(BENEFICIARY_SUFFIX)),
        lambda: F.lit(BENEFICIARY_TOKEN),
    )


def mask_redact(value: Column | str, tier: str | Column) -> Column:
    """Redaction of tagged columns that no other function is meant for."""
    return pick(
        tier, lambda: _text(value), lambda: F.lit(REDACTED), lambda: F.lit(REDACTED)
    )


MASKS: dict[str, Callable[..., Column]] = {
    fn.__name__: fn
    for fn in (
        mask_ssn,
        mask_name,
        mask_email,
        mask_phone,
        mask_date_of_birth,
        mask_zip_code,
        mask_address,
        hash_identifier,
        mask_financial_amount,
        mask_diagnosis_code,
        mask_drug_info,
        mask_clinical_notes,
        mask_tax_id,
        mask_beneficiary_id,
        mask_redact,
    )
}


def apply_mask(
    function: str, value: Column | str, tier: str | Column, salt: str | None = None
) -> Column:
    """The masked column for a function given by name."""
    if function not in MASKS:
        raise ValueError(f"unknown masking function: {function}")
    if function == hash_identifier.__name__:
        return hash_identifier(value, tier, salt)
    return MASKS[function](value, tier)
