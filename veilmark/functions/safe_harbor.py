"""Extensions for de-identification rules beyond the plain masks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark.functions.masks import (
    REDACTED,
    ZIP_SUFFIX,
    hash_identifier,
    mask_date_of_birth,
    mask_zip_code,
)
from veilmark.functions.tiers import pick
from veilmark.operators.joins import spread_join
from veilmark.session import kept

# Age from which birth dates collapse, population a ZIP prefix
# needs, replacement of a prefix with fewer people.
AGE_CAP = 90
AGE_LABEL = "90+"
MIN_ZIP3_POPULATION = 20_000
SMALL_ZIP3 = "000"


def capped_birth_date(value: Column | str, tier: str | Column, as_of: date | None = None) -> Column:
    """`mask_date_of_birth` with all ages of 90 and over as one label.

    A person is 90 on the 90th birthday. The comparison is with one constant
    date, so a filter on it can reach the scan.
    """
    day = (F.col(value) if isinstance(value, str) else value).cast("date")
    today = F.lit(as_of) if as_of else F.current_date()
    is_old = day <= F.add_months(today, -12 * AGE_CAP)

    def capped(level):
        return F.when(is_old, F.lit(AGE_LABEL)).otherwise(mask_date_of_birth(day, level))

    return pick(
        tier,
        lambda: mask_date_of_birth(day, "full"),
        lambda: capped("partial"),
        lambda: capped("none"),
    )


def zip3(column: str) -> Column:
    """The three digits a ZIP code starts with, else NULL."""
    prefix = F.substring(F.col(column), 1, 3)
    return F.when(prefix.rlike("^[0-9]{3}$"), prefix)


def lookup_report(
    used: DataFrame, code: str, lookup: DataFrame, lookup_code: str, value: str
) -> DataFrame:
    """What a lookup leaves masked: (code, problem, n_rows).

    ``not listed``: codes of ``used`` without an entry and how many rows have them.
    ``several values``: entries that contradict each other, whether used or not, and
    how many there are. Codes are reduced to one row each before they are joined.
    """
    codes = (
        used.where(F.col(code).isNotNull())
        .groupBy(F.col(code).alias("code"))
        .agg(F.count("*").alias("n_rows"))
    )
    entries = (
        lookup.where(F.col(lookup_code).isNotNull())
        .groupBy(F.col(lookup_code).alias("code"))
        .agg(
            F.count("*").alias("n_rows"),
            (F.min(value) != F.max(value)).alias("differs"),
        )
    )
    absent = codes.join(entries.select("code"), "code", "left_anti").select(
        "code", F.lit("not listed").alias("problem"), "n_rows"
    )
    double = entries.where("differs").select(
        "code", F.lit("several values").alias("problem"), "n_rows"
    )
    return absent.unionByName(double)


def zip3_by_population(
    df: DataFrame,
    column: str,
    tier: str,
    populations: DataFrame,
    threshold: int = MIN_ZIP3_POPULATION,
) -> DataFrame:
    """`mask_zip_code` that keeps only prefixes of enough people at tier partial.

    ``populations`` has (zip3, population). Prefixes below the threshold, not
    listed or other than three digits become 000; `lookup_report` tells which are
    not listed. How the lookup is joined is left to Spark.
    """
    if tier != "partial":
        return df.withColumn(column, mask_zip_code(column, tier))
    large = (
        populations.groupBy(F.col("zip3").alias("large_zip3"))
        .agg(F.max("population").alias("population"))
        .where(F.col("population") >= threshold)
        .select("large_zip3")
    )
    prefix = zip3(column)
    kept = F.coalesce(F.col("large_zip3"), F.lit(SMALL_ZIP3))
    value = F.when(F.col(column).isNotNull(), F.concat(kept, F.lit(ZIP_SUFFIX)))
    names = df.columns
    return (
        df.join(large, prefix == F.col("large_zip3"), "left")
        .withColumn(column, value)
        .select(*names)
    )


def salt_crosswalk(df: DataFrame, id_column: str, old_salt: str, new_salt: str) -> DataFrame:
    """Old and new hash of every identifier; keep it as closely as the salts."""
    ids = df.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("string").alias("id"))
    return ids.distinct().select(
        hash_identifier("id", "none", old_salt).alias("old_hid"),
        hash_identifier("id", "none", new_salt).alias("new_hid"),
    )


def rekey(
    df: DataFrame, hid_column: str, crosswalk: DataFrame, row_id: Sequence[str]
) -> DataFrame:
    """A masked table moved from the old salt to the new one.

    Hashes that the crosswalk does not know, or that two identifiers share,
    become NULL rather than staying readable under the old salt.
    """
    names = df.columns
    only = F.when(F.min("new_hid") == F.max("new_hid"), F.min("new_hid"))
    pairs = crosswalk.groupBy("old_hid").agg(only.alias("new_hid"))
    joined = spread_join(df, pairs, hid_column, "old_hid", row_id, "left")
    return joined.withColumn(hid_column, F.col("new_hid")).select(*names)


def latest_crosswalk(steps: DataFrame, latest: int) -> DataFrame:
    """From the hash of every older salt straight to that of the newest.

    ``steps`` has ``salt_version``, ``old_hid``, ``next_version`` and ``new_hid``: crosswalks
    from one salt to a newer one. Returns ``salt_version``, ``old_hid`` and ``new_hid`` under
    ``latest``. Every round joins the table with itself, so the stretch that a row
    leads over doubles and the rounds are the logarithm of the number of
    versions. A hash with several successors, or whose way breaks off, is left out.
    """
    only = F.when(
        (F.min("new_hid") == F.max("new_hid")) & (F.min("next_version") == F.max("next_version")),
        F.struct(F.min("next_version").alias("next_version"), F.min("new_hid").alias("new_hid")),
    )
    known = (
        steps.where("salt_version < next_version AND old_hid IS NOT NULL AND new_hid IS NOT NULL")
        .groupBy("salt_version", "old_hid")
        .agg(only.alias("to"))
        .where("to IS NOT NULL")
        .select("salt_version", "old_hid", "to.next_version", "to.new_hid")
    )
    oldest = known.agg(F.min("salt_version")).first()[0]
    reach = 1
    while oldest is not None and reach < latest - oldest:
        known = kept(known, "crosswalk")
        on = known.select(
            F.col("salt_version").alias("next_version"),
            F.col("old_hid").alias("new_hid"),
            F.col("next_version").alias("far_version"),
            F.col("new_hid").alias("far_hid"),
        )
        known = known.join(on, ["next_version", "new_hid"], "left").select(
            "salt_version",
            "old_hid",
            F.coalesce("far_version", "next_version").alias("next_version"),
            F.coalesce("far_hid", "new_hid").alias("new_hid"),
        )
        reach *= 2
    return known.where(F.col("next_version") == latest).select("salt_version", "old_hid", "new_hid")


def rekey_versions(
    df: DataFrame,
    hid_column: str,
    version_column: str,
    steps: DataFrame,
    latest: int,
    row_id: Sequence[str],
) -> DataFrame:
    """A masked table whose rows have hashes of many salts, moved to the newest at once.

    Rows of the newest salt stay. Hashes without a way there become NULL, and so do
    those without a version; afterwards every row has the newest version.
    """
    pairs = latest_crosswalk(steps, latest).select(
        F.struct(F.col("salt_version"), F.col("old_hid")).alias("old_key"), "new_hid"
    )
    key = F.struct(F.col(version_column).alias("salt_version"), F.col(hid_column).alias("old_hid"))
    is_old = F.col(version_column).isNotNull() & F.col(hid_column).isNotNull()
    is_old &= F.col(version_column) != latest
    keyed = df.withColumn("hid_key", F.when(is_old, key))
    joined = spread_join(keyed, pairs, "hid_key", "old_key", row_id, "left")
    stays = F.when(F.col(version_column) == latest, F.col(hid_column))
    return joined.select(
        *[
            F.coalesce(stays, "new_hid").alias(c)
            if c == hid_column
            else F.lit(latest).cast(df.schema[c].dataType).alias(c)
            if c == version_column
            else F.col(c)
            for c in df.columns
        ]
    )


def drg_category(
    df: DataFrame, column: str, tier: str, lookup: DataFrame, into: str | None = None
) -> DataFrame:
    """A DRG code as its major category at tier partial, from a lookup table.

    ``lookup`` has (drg_code, mdc), codes in the form of the column. Codes that are
    not listed, or listed with several categories, are redacted; `lookup_report`
    tells which. How the lookup is joined is left to Spark.
    """
    into = into or column
    if tier != "partial":
        token = F.col(column) if tier == "full" else F.lit(REDACTED)
        return df.withColumn(into, token)
    only = F.when(F.min("mdc") == F.max("mdc"), F.min("mdc"))
    known = lookup.groupBy(F.col("drg_code").alias("known_drg")).agg(only.alias("known_mdc"))
    value = F.when(
        F.col(column).isNotNull(), F.coalesce(F.col("known_mdc"), F.lit(REDACTED))
    )
    names = df.columns if into in df.columns else [*df.columns, into]
    return (
        df.join(known, F.col(column) == F.col("known_drg"), "left")
        .withColumn(into, value)
        .select(*names)
    )

