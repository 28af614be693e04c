"""Clinical notes without the names of the members they are about."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark.functions.masks import NOTE_PATTERNS, mask_clinical_notes
from veilmark.operators.joins import spread_join

MIN_TERM = 2
NAME_LABEL = NOTE_PATTERNS[0][1]
# No letter or digit of any script before and after.
BEFORE, AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"


def terms_of(names: Column) -> Column:
    """Distinct names worth looking for, in lower case, the longest first."""
    spelled = F.transform(names, lambda n: F.lower(F.trim(n)))
    worth = F.array_distinct(F.filter(spelled, lambda n: F.length(n) >= MIN_TERM))
    by_length = F.array_sort(F.transform(worth, lambda n: F.struct(-F.length(n), n.alias("term"))))
    return F.transform(by_length, lambda s: s["term"])


def without_terms(text: Column, terms: Column, label: str = NAME_LABEL) -> Column:
    """A text with every whole-word occurrence of the terms replaced, in any case."""

    def replaced(so_far: Column, term: Column) -> Column:
        literal = F.regexp_replace(term, r"([^\p{L}\p{N} ])", r"\\$1")
        # Any white space between the words of a name.
        spaced = F.regexp_replace(literal, " +", r"\\s+")
        pattern = F.concat(F.lit("(?iu)" + BEFORE), spaced, F.lit(AFTER))
        return F.regexp_replace(so_far, pattern, F.lit(label))

    return F.aggregate(terms, text, replaced)


def notes_linked(
    rows: DataFrame,
    members: DataFrame,
    tier: str,
    notes: str = "clinical_notes",
    names: Sequence[str] = ("first_name", "last_name"),
    row_id: str = "auth_id",
) -> DataFrame:
    """`mask_clinical_notes`, and at tier partial without the names of the row's member.

    The patterns of `mask_clinical_notes` know names by their capitals; here every
    row gets the names of its own member, which are taken out in any spelling case,
    as whole words, the full name first, before the patterns run. Names of one letter
    and names misspelled, shortened or inflected stay. Rows whose member is unknown
    get the patterns alone. Members that occur several times give all their names.
    The other tiers need no names, so nothing is joined.
    """
    if tier != "partial":
        return rows.withColumn(notes, mask_clinical_notes(F.col(notes), tier))
    listed = F.array(F.concat_ws(" ", *names), F.concat_ws(", ", *reversed(names)), *names)
    known = (
        members.where(F.col("member_id").isNotNull())
        .groupBy(F.col("member_id").alias("named_member"))
        .agg(F.flatten(F.collect_set(F.array_compact(listed))).alias("member_names"))
    )
    joined = spread_join(rows, known, "member_id", "named_member", [row_id], "left")
    terms = F.coalesce(terms_of(F.col("member_names")), F.array().cast("array<string>"))
    scrubbed = mask_clinical_notes(without_terms(F.col(notes), terms), tier)
    return joined.withColumn(notes, scrubbed).select(*rows.columns)
