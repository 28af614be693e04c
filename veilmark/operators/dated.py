"""Coverage over time: spans and gaps, what was valid on a day, what was not covered.

A member may hold a large part of all rows. Intervals are reduced per day before they
move, so what one key can have is bounded by days; points of a hot key are cut
into slices as `spread_join` does.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilmark.operators.joins import hot_keys, repeated, sliced, spread_join

BUCKET_DAYS = 32
OPEN_END = date(9999, 12, 31)


def _is_interval(start: str, end: str) -> Column:
    return F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start)))


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS)


def _first_day(bucket: Column) -> Column:
    return F.date_from_unix_date((bucket * BUCKET_DAYS).cast("int"))


def valid_on(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    interval_id: str,
    row_id: str,
    **probe: int,
) -> DataFrame:
    """Per point how many intervals of its key hold its day, and the latest of them.

    Returns ``row_id``, ``n_valid`` and ``interval_id``: of several intervals the one
    that starts last, then the greatest id; NULL without one. Both ends belong to an
    interval; an open end never passes, one without a start or that ends
    before it starts holds nothing, and a point without key or day is in none.

    Both sides meet by key and bucket of days. In a bucket, intervals that hold all of
    it are one row, and so are those with the same first and last day: a key and bucket
    has at most 1 + 32 * 33 / 2 rows, however many intervals there are. Only the days
    asked for meet them, each once per key and however many its points, so a key and
    bucket has at most 32 times as many pairs; points take the one row of their day.
    """
    days = points.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    lo, hi = days.select("lo").scalar(), days.select("hi").scalar()
    clipped = intervals.where(_is_interval(start, end) & F.col(key).isNotNull()).select(
        F.col(key).alias("i_key"),
        F.greatest(F.col(start), lo).alias("first"),
        F.least(F.coalesce(F.col(end), hi), hi).alias("last"),
        F.struct(F.col(start), F.col(interval_id)).alias("found"),
    )
    cut = clipped.where("first <= last").withColumn(
        "bucket", F.explode(F.sequence(_bucket(F.col("first")), _bucket(F.col("last"))))
    )
    holds_all = (F.col("first") <= F.greatest(_first_day(F.col("bucket")), lo)) & (
        F.col("last") >= F.least(F.date_sub(_first_day(F.col("bucket") + 1), 1), hi)
    )
    held = cut.groupBy(
        F.struct("i_key", "bucket").alias("i_place"),
        F.when(~holds_all, F.greatest(F.col("first"), _first_day(F.col("bucket")))).alias("first"),
        F.when(~holds_all, F.least(F.col("last"), F.date_sub(_first_day(F.col("bucket") + 1), 1)))
        .alias("last"),
    ).agg(F.count("*").alias("n"), F.max("found").alias("found"))
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    asked = points.where(known).select(F.col(key).alias("a_key"), F.col(at).alias("a_at"))
    place = F.struct(F.col("a_key").alias("i_key"), _bucket(F.col("a_at")).alias("bucket"))
    met = held.join(asked.distinct().withColumn("a_place", place), F.col("a_place") == F.col("i_place"))
    told = (
        met.where("first IS NULL OR a_at BETWEEN first AND last")
        .groupBy("i_place", "a_at")
        .agg(F.sum("n").alias("n"), F.max("found").alias("found"))
        .select(F.struct(F.col("i_place.i_key").alias("key"), "a_at").alias("i_day"), "n", "found")
    )
    day = F.struct(F.col(key).alias("key"), F.col(at).alias("a_at"))
    rows = points.select(row_id, F.when(known, day).alias("p_day"))
    # One that is in no interval stays, and rows of one ``row_id`` are one point.
    return (
        spread_join(rows, told, "p_day", "i_day", [row_id], "left", **probe)
        .groupBy(row_id)
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_valid"), F.max("found").alias("found"))
        .select(row_id, "n_valid", F.col(f"found.{interval_id}").alias(interval_id))
    )


def claims_in_authorization(
    claims: DataFrame, authorizations: DataFrame, **probe: int
) -> DataFrame:
    """Every claim with the authorization of its member valid on its service date.

    For claims that name no authorization number; see `valid_on` for several.
    """
    return valid_on(
        claims,
        authorizations,
        "member_id",
        "service_date_from",
        "effective_date",
        "expiration_date",
        "auth_id",
        "claim_id",
        **probe,
    )


def coverage_spans(
    eligibility: DataFrame,
    by: Sequence[str] = ("member_id", "coverage_type"),
    start: str = "effective_date",
    end: str = "termination_date",
) -> DataFrame:
    """Rows of coverage put together where they overlap or follow day on day.

    Returns ``by``, ``span_start``, ``span_end`` (NULL: open) and ``n_rows``. Rows without
    a member (the first of ``by``), without a start or that end before they start cover
    nothing. A NULL type is a type of its own. Rows are reduced to one per start day
    before they move, so a member has as many as there are days, not rows.
    """
    until = F.max(F.coalesce(F.col(end), F.lit(OPEN_END))).alias("until")
    days = (
        eligibility.where(_is_interval(start, end) & F.col(by[0]).isNotNull())
        .groupBy(*by, F.col(start).alias("from"))
        .agg(until, F.count("*").alias("n"))
    )
    along = Window.partitionBy(*by).orderBy("from")
    before = F.max("until").over(along.rowsBetween(Window.unboundedPreceding, -1))
    is_new = F.when(F.date_diff(F.col("from"), before) > 1, 1).otherwise(0)
    ends = F.max("until")
    return (
        days.withColumn("is_new", is_new)
        .withColumn("nth", F.sum("is_new").over(along))
        .groupBy(*by, "nth")
        .agg(
            F.min("from").alias("span_start"),
            F.when(ends < F.lit(OPEN_END), ends).alias("span_end"),
            F.sum("n").alias("n_rows"),
        )
        .drop("nth")
    )


def coverage_gaps(
    spans: DataFrame, by: Sequence[str] = ("member_id", "coverage_type")
) -> DataFrame:
    """Days between one span and the next: ``gap_start``, ``gap_end``, ``n_days``."""
    following = F.lead("span_start").over(Window.partitionBy(*by).orderBy("span_start"))
    gaps = spans.withColumn("following", following).where("following IS NOT NULL")
    return gaps.select(
        *by,
        F.date_add("span_end", 1).alias("gap_start"),
        F.date_sub("following", 1).alias("gap_end"),
        (F.date_diff("following", "span_end") - 1).alias("n_days"),
    )


def last_before(
    points: DataFrame,
    events: DataFrame,
    key: str,
    at: str,
    event_at: str,
    values: Sequence[str],
    row_id: Sequence[str],
    **probe: int,
) -> DataFrame:
    """Points with the values of their key's last event on or before their day.

    An as-of join without a join: both sides are put in one order per key, and every
    point takes the last event above it. A hot key is cut into slices, each in its
    own order, and its events are repeated per slice; there should be few per key
    and one per day. Points without key or day, and those before the first event,
    get NULLs.
    """
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    hot = hot_keys(points, key, row_id, **probe)
    rows = sliced(points.where(known), key, hot, row_id, "order_slice")
    found = F.struct(*[F.col(v) for v in values])
    kind = events.select(found.alias("found")).schema["found"].dataType
    rows = rows.withColumn("order_day", F.col(at)).withColumn("found", F.lit(None).cast(kind))
    told = repeated(
        events.where(F.col(key).isNotNull() & F.col(event_at).isNotNull()), key, hot, "order_slice"
    ).select(key, "order_slice", F.col(event_at).alias("order_day"), found.alias("found"))
    line = rows.withColumn("is_point", F.lit(1)).unionByName(
        told.withColumn("is_point", F.lit(0)), allowMissingColumns=True
    )
    above = Window.partitionBy(key, "order_slice").orderBy("order_day", "is_point")
    above = above.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = F.last("found", ignorenulls=True).over(above)
    placed = line.withColumn("latest", latest).where("is_point = 1")
    shown = [F.col(f"latest.{v}").alias(v) for v in values]
    unknown = [F.lit(None).cast(kind[v].dataType).alias(v) for v in values]
    return placed.select(*points.columns, *shown).unionByName(
        points.where(~known).select(*points.columns, *unknown)
    )


def claims_uncovered(claims: DataFrame, eligibility: DataFrame, **probe: int) -> DataFrame:
    """Claims whose member has no coverage on the service date, with its last one.

    Returns ``claim_id``, ``member_id``, ``service_date_from``, ``last_covered`` (the last
    day of the latest span that began before; NULL without one) and ``reason``:
    ``no member``, ``no date``, ``never covered`` or ``not covered``.
    """
    spans = coverage_spans(eligibility, ["member_id"])
    points = claims.select("claim_id", "member_id", "service_date_from")
    rows = last_before(
        points,
        spans,
        "member_id",
        "service_date_from",
        "span_start",
        ["span_start", "span_end"],
        ["claim_id"],
        **probe,
    )
    day = F.col("service_date_from")
    reason = (
        F.when(F.col("member_id").isNull(), "no member")
        .when(day.isNull(), "no date")
        .when(F.col("span_start").isNull(), "never covered")
        .when(day > F.col("span_end"), "not covered")
    )
    return (
        rows.withColumn("reason", reason)
        .where("reason IS NOT NULL")
        .select(*points.columns, F.col("span_end").alias("last_covered"), "reason")
    )
