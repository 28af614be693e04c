"""Order MinHash fingerprints.

The k-mers of a text are runs of K pieces, a piece being at most PIECE characters
of a word. A stretch of more than WHOLE characters without white space gives a piece
at every character instead, so that an edit touches only the pieces around it, as it
does between words. Equal k-mers are numbered by occurrence, so repetitions count. A hash
of k-mer and number names one of the FUNCTIONS and a rank within it; each function
keeps its MINIMA smallest, puts them back into text order and hashes that tuple.
Two texts agree in a function if they share its minimal k-mers in the same order,
which edits and moved passages both lower.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilmark.llm.common import let, one_row, parts_for, stored, words_of
from veilmark.llm.sharding import MOST_RANGES, RANGE, ROWS_PER_RANGE, range_of, splitters

FUNCTION_BITS = 5
MINIMA = 2
K = 2
PIECE = 8
WHOLE = 32
BLANK = r"\x20\x09-\x0D"
# A long holds 40 bits of hash and 24 of place; later places count as the last.
PLACE_BITS = 24
LAST_PLACE = 2**PLACE_BITS - 1
TUPLE_BITS = 32
PIECE_SEED, NUMBER_SEED, TUPLE_SEED = 61, 67, 71


def _head(value: Column) -> Column:
    return F.shiftright(value, PLACE_BITS)


def _place(value: Column) -> Column:
    return value.bitwiseAND(F.lit(LAST_PLACE).cast("long"))


def _packed(value: Column, place: Column) -> Column:
    return F.shiftleft(_head(value), PLACE_BITS).bitwiseOR(place)


def _function(value: Column) -> Column:
    return F.shiftright(value, 64 - FUNCTION_BITS)


def _empty() -> Column:
    return F.array().cast("array<bigint>")


def _pieces(body: Column) -> Column:
    """Words cut into pieces from their start, long stretches into overlapping ones.

    Only texts that hold a long stretch are taken apart word by word.
    """
    cut = F.lit(r"[^%s]{1,%d}" % (BLANK, PIECE))
    every = F.lit(r"(?s)(?=(.{%d}))." % PIECE)

    def of_word(word: Column) -> Column:
        return F.when(
            F.length(word) > WHOLE, F.regexp_extract_all(word, every, F.lit(1))
        ).otherwise(F.regexp_extract_all(word, cut, F.lit(0)))

    has_long = body.rlike(r"(?<![^%s])[^%s]{%d}" % (BLANK, BLANK, WHOLE + 1))
    return F.when(has_long, F.flatten(F.transform(words_of(body), of_word))).otherwise(
        F.regexp_extract_all(body, cut, F.lit(0))
    )


def _kmers(pieces: str) -> Column:
    """A long per k-mer; a text of fewer than K pieces is one k-mer."""
    n = F.size(pieces)

    def kmer(i: Column) -> Column:
        h = F.xxhash64(*[F.get(F.col(pieces), i + j) for j in range(K)], F.lit(PIECE_SEED))
        return _packed(h, F.least(i, F.lit(LAST_PLACE)).cast("long"))

    places = F.sequence(F.lit(0), F.greatest(n - K, F.lit(0)))
    return F.when(n > 0, F.transform(places, kmer)).otherwise(_empty())


def _numbered(kmers: str) -> Column:
    """The k-mers hashed anew with their occurrence numbers.

    ``kmers`` is sorted: equal ones are a run in text order, and an occurrence's
    number is its distance from the first of its run.
    """
    n = F.size(kmers)
    at = lambda i: F.get(F.col(kmers), i)
    firsts = F.filter(
        F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (_head(at(i)) != _head(at(i - 1)))
    )

    def renumbered(i: Column, number: Column) -> Column:
        h = F.xxhash64(_head(at(i)), number, F.lit(NUMBER_SEED))
        return _packed(h, _place(at(i)))

    def run(first: Column, end: Column) -> Column:
        return F.when(end - first == 1, F.array(renumbered(first, F.lit(0)))).otherwise(
            F.transform(F.sequence(first, end - 1), lambda i: renumbered(i, i - first))
        )

    def runs(starts: Column) -> Column:
        return F.flatten(
            F.transform(
                starts, lambda first, r: run(first, F.coalesce(F.get(starts, r + 1), n))
            )
        )

    return F.when(n > 0, let(firsts, runs)).otherwise(_empty())


def _minima(numbered: str) -> Column:
    """The MINIMA smallest of each function, in the order of ``numbered``."""
    return F.filter(
        numbered,
        lambda v, i: F.when(i < MINIMA, True).otherwise(
            _function(v) != _function(F.get(F.col(numbered), i - MINIMA))
        ),
    )


def _sketch(minima: str) -> Column:
    """One long per function that has k-mers: its number, then its tuple's hash."""
    at = lambda i: F.get(F.col(minima), i)
    firsts = F.filter(
        F.sequence(F.lit(0), F.size(minima) - 1),
        lambda i: F.when(i == 0, True).otherwise(_function(at(i)) != _function(at(i - 1))),
    )

    def member(first: Column, j: int) -> Column:
        value = at(first + j)
        same = _function(value) == _function(at(first))
        return F.when(same, F.struct(_place(value).alias("place"), _head(value).alias("head")))

    def tuple_hash(first: Column) -> Column:
        members = F.sort_array(F.filter(
            F.array(*[member(first, j) for j in range(MINIMA)]), lambda m: m.isNotNull()
        ))
        h = F.xxhash64(F.transform(members, lambda m: m["head"]), F.lit(TUPLE_SEED))
        function = _function(at(first)) + 2 ** (FUNCTION_BITS - 1)
        return F.shiftleft(function, TUPLE_BITS).bitwiseOR(
            F.shiftrightunsigned(h, 64 - TUPLE_BITS)
        )

    return F.when(F.size(minima) > 0, F.transform(firsts, tuple_hash)).otherwise(_empty())


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the sketch of a text column as an array of longs.

    NULL and texts without a word have an empty sketch. Time grows with
    n log n; the sketch has at most 2 ** FUNCTION_BITS longs. Each step is a
    projection of its own, so that none is computed more than once.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    step = df.select(*kept, _pieces(F.coalesce(F.col(text), F.lit(""))).alias("_p"))
    step = step.select(*kept, F.sort_array(_kmers("_p")).alias("_p"))
    step = step.select(*kept, F.sort_array(_numbered("_p")).alias("_p"))
    step = step.select(*kept, _minima("_p").alias("_p"))
    return step.select(*kept, _sketch("_p").alias(name))


def fingerprint(sketch: Column) -> Column:
    """The sketch as text: ten hex digits per function."""
    return F.lower(F.array_join(F.transform(sketch, lambda v: F.lpad(F.hex(v), 10, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of the functions either text has in which both agree; 1 if both have none."""
    of = lambda s: F.transform(s, lambda v: F.shiftright(v, TUPLE_BITS))
    either = F.size(F.array_union(of(a), of(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)) / F.greatest(either, F.lit(1))
    )


def with_next(
    rows: DataFrame,
    doc_id: str,
    payload: list[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Adds ``next``, a struct of the payload of the row that follows by ``doc_id``.

    ``prepare`` adds columns of the payload to rows on their way.

    After the last row comes the first; a lone row follows itself. NULL ids come
    first, rows with equal ids are ordered by the payload. Rows are dealt into
    ranges of ids and a range is sorted in one task; the last row of a range
    takes the first of the next range, found by a join of one row per range.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)).cast("long"))
    keyed = rows.withColumn("_key", key)
    totals = one_row(keyed.agg(F.count("*").alias("rows")))
    n_ranges = parts_for(totals["rows"], ROWS_PER_RANGE, MOST_RANGES)
    slim = keyed.select("_key", F.lit(1).cast("long").alias("one"))
    cuts = splitters(slim, "_key", "one", "_key", n_ranges, totals["rows"])
    dealt = keyed.withColumn(RANGE, range_of(F.col("_key"), cuts))
    firsts = stored(dealt.groupBy(RANGE).agg(F.min("_key").alias("_first")), "range-firsts")
    every = Window.orderBy("_r")  # one row per range
    # The range whose last row is followed by this one's first; round the end.
    before = F.coalesce(
        F.lag("_r").over(every),
        F.max("_r").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    after = firsts.select(F.col(RANGE).alias("_r"), F.col("_first").alias("_f")).withColumn(
        "_before", before
    )
    content = F.struct(*payload)
    heads = (
        prepare(dealt.join(after, (F.col(RANGE) == F.col("_r")) & (F.col("_key") == F.col("_f"))))
        .groupBy("_before")
        .agg(F.min(content).alias("_head"))
    )
    inside = Window.partitionBy(RANGE).orderBy("_key", *payload)
    led = prepare(dealt).withColumn("_lead", F.lead(content).over(inside))
    on = (F.col(RANGE) == F.col("_before")) & F.col("_lead").isNull()
    return (
        led.join(heads, on, "left")
        .withColumn("next", F.coalesce("_lead", "_head"))
        .drop("_key", RANGE, "_before", "_head", "_lead")
    )


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text ends with the beginning of the next document instead of its
    own last quarter. NULL texts count as empty.
    """
    text = F.coalesce("text", F.lit(""))
    rows = with_next(
        docs.select("doc_id", text.alias("text")),
        "doc_id",
        ["text", "sketch"],
        lambda df: with_sketch(df, "text", "sketch"),
    )
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next.text", F.lit(1), cut))
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "sketch",
        F.col("next.sketch").alias("next_sketch"),
        edited.alias("edited"),
    )
    rows = with_sketch(rows, "edited", "edited_sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
