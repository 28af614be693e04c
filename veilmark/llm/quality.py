"""Quality rules with adaptive thresholds.

Each metric of a text is an integer. Its distribution per language and source is
kept as a mergeable sketch: counts of buckets that hold the seven leading bits of
a value, so quantiles are right within 1/64 and sketches add up bucket by bucket,
in any order. Fences around the middle half of a group replace fixed cutoffs;
groups too small for their own take those of their language, or of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilmark.llm.common import PACKED, packed, stored, unpacked, words_of

LEADING_BITS = 7
MIN_GROUP = 200
SPREADS = 3
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Metric -> the least spread that is taken for real, in the metric's unit.
# Word length in 1/1000 characters, the rest in millionths.
METRICS = {
    "word_length": 500,
    "symbols": 20_000,
    "marks": 50_000,
    "dup_lines": 150_000,
    "repeats": 150_000,
}
LOWER_TOO = ("word_length",)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
MARKS = "!?"


def _places(words: str) -> Column:
    """Three-word windows as longs: the leading bits of a hash, then the place.

    A place takes as many bits as the text needs, the hash all the others.
    """
    n = F.size(words) - 2
    bits = F.length(F.bin(F.size(words).cast("long")))

    def packed(i: Column) -> Column:
        h = F.xxhash64(*[F.get(F.col(words), i + k) for k in range(3)])
        return F.call_function(
            "shiftleft", F.call_function("shiftright", h, bits), bits
        ).bitwiseOR(i.cast("long"))

    return F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 1), packed)).otherwise(
        F.array().cast("array<bigint>")
    )


def _repeated(words: str, places: str) -> Column:
    """Places of the windows that equal another one, ascending.

    Windows with equal hash bits lie side by side in ``places``; their words are
    compared, so a collision cannot count as a repetition.
    """
    bits = F.length(F.bin(F.size(words).cast("long")))
    n = F.size(places)

    def place(value: Column) -> Column:
        head = F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)
        return (value - head).cast("int")

    def same(a: Column, b: Column) -> Column:
        head = F.call_function("shiftright", a.bitwiseXOR(b), bits) == 0
        for k in range(3):
            head = head & (
                F.get(F.col(words), place(a) + k) == F.get(F.col(words), place(b) + k)
            )
        return head

    found = F.filter(
        places,
        lambda v, i: F.when((i > 0) & same(v, F.get(F.col(places), i - 1)), True)
        .when(i + 1 < n, same(v, F.get(F.col(places), i + 1)))
        .otherwise(False),
    )
    return F.sort_array(F.transform(found, place))


def _covered(starts: str) -> Column:
    """Words in windows of three that begin at the given places."""
    last = F.size(starts) - 1
    return F.aggregate(
        F.transform(
            starts,
            lambda p, i: F.when(i < last, F.least(F.get(F.col(starts), i + 1) - p, F.lit(3)))
            .otherwise(3),
        ),
        F.lit(0).cast("long"),
        lambda a, v: a + v,
    )


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def base_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts as ``_q``: words, characters, symbols, repetitions.

    NULL and empty texts count as no words. Texts of any length are measured
    whole, in time that grows with n log n.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    step = docs.select(
        *kept,
        words_of(F.col(text)).alias("_words"),
        lines.alias("_lines"),
        F.length(body).alias("_chars"),
        _without(body, "\x20\t\n\x0b\x0c\r").alias("_dense"),
        _without(body, SYMBOLS).alias("_plain"),
        _without(body, MARKS).alias("_calm"),
    )
    others = [F.col(c) for c in ("_words", "_lines", "_chars", "_dense", "_plain", "_calm")]
    step = step.select(*kept, *others, F.sort_array(_places("_words")).alias("_places"))
    step = step.select(*kept, *others, _repeated("_words", "_places").alias("_starts"))
    counts = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.col("_dense").cast("long").alias("word_chars"),
        (F.col("_chars") - F.col("_plain")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered("_starts").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.col("_chars") - F.col("_calm")).cast("long").alias("n_marks"),
    )
    return step.select(*kept, counts.alias("_q"))


def base_failed() -> Column:
    q = F.col("_q")
    return (q["n_words"] < MIN_WORDS) | (
        q["n_repeat_words"] * 100 > q["n_words"] * MOST_REPEATED_PERCENT
    )


def _share(part: str, whole: str, unit: int) -> Column:
    q = F.col("_q")
    # Integer division, as the rest is taken off first.
    scaled = q[part] * unit
    return ((scaled - scaled % F.greatest(q[whole], F.lit(1))) / F.greatest(q[whole], F.lit(1))).cast(
        "long"
    )


def metric_values() -> dict[str, Column]:
    return {
        "word_length": _share("word_chars", "n_words", 1000),
        "symbols": _share("n_symbols", "n_words", 1_000_000),
        "marks": _share("n_marks", "word_chars", 1_000_000),
        "dup_lines": _share("n_dup_lines", "n_lines", 1_000_000),
        "repeats": _share("n_repeat_words", "n_words", 1_000_000),
    }


def _bucket(value: Column) -> Column:
    shift = F.greatest(F.length(F.bin(value)) - LEADING_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def _key(column: str) -> Column:
    """NULL is a group of its own."""
    name = F.col(column).cast("string")
    return F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), name))


def sketches(measured: DataFrame) -> DataFrame:
    """Bucket counts per language, source and metric of texts that pass the base.

    Combined before the shuffle: a group has a few hundred buckets however many
    rows it holds.
    """
    pairs = F.array(
        *[F.struct(F.lit(m).alias("m"), v.alias("v")) for m, v in metric_values().items()]
    )
    values = measured.where(~base_failed()).select(
        _key("lang").alias("lang"), _key("source").alias("source"), F.explode(pairs).alias("p")
    )
    return values.groupBy(
        "lang", "source", F.col("p.m").alias("metric"), _bucket(F.col("p.v")).alias("bucket")
    ).agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """Fences per language and source, one row each, from merged sketches."""

    def fences(level: list[str], at: str) -> DataFrame:
        merged = sketch.groupBy(*level, "metric", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*level, "metric")
        upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        ranked = merged.select(
            *level,
            "metric",
            "bucket",
            F.sum("n").over(upto).alias("upto"),
            F.sum("n").over(group).alias("total"),
        )
        quartile = {
            q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket")))
            for q in (1, 3)
        }
        rows = ranked.groupBy(*level, "metric").agg(
            quartile[1].alias("q1"), quartile[3].alias("q3"), F.first("total").alias("total")
        )
        least = F.lit(0)
        for metric, slack in METRICS.items():
            least = F.when(F.col("metric") == metric, F.lit(slack)).otherwise(least)
        spread = F.greatest(F.col("q3") - F.col("q1"), least) * SPREADS
        rows = rows.select(
            *level,
            "metric",
            F.struct(
                (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"), "total"
            ).alias(at),
        )
        return rows

    own = fences(["lang", "source"], "own")
    of_lang = fences(["lang"], "of_lang")
    of_all = fences([], "of_all")
    big = lambda c: F.when(F.col(c)["total"] >= MIN_GROUP, F.col(c))
    chosen = (
        own.join(of_lang, ["lang", "metric"])
        .join(of_all, ["metric"])
        .select(
            "lang", "source", "metric", F.coalesce(big("own"), big("of_lang"), "of_all").alias("t")
        )
    )
    per_metric = [
        F.max(F.when(F.col("metric") == m, F.struct(F.col("t.low"), F.col("t.high")))).alias(m)
        for m in METRICS
    ]
    return chosen.groupBy("lang", "source").agg(*per_metric).select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.struct(*METRICS).alias("_t")
    )


def _judged(docs: DataFrame, shown: list[str]) -> DataFrame:
    """`packed` rows of the columns ``shown``, ``_q``, ``base_failed`` and ``kept``."""
    rows = packed(docs, shown)
    if "text" in shown:
        rows = rows.withColumn("text", F.col(PACKED)["text"])
    else:
        rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in shown]).alias(PACKED))
    measured = stored(base_metrics(rows).select(PACKED, "_q"), "quality-measured")
    groups = {"lang": F.col(PACKED)["lang"], "source": F.col(PACKED)["source"]}
    measured = measured.withColumns(groups)
    fences = stored(thresholds(sketches(measured)), "quality-fences")
    values = metric_values()
    fine = F.lit(True)
    for metric, value in values.items():
        fine = fine & (value <= F.col("_t")[metric]["high"])
        if metric in LOWER_TOO:
            fine = fine & (value >= F.col("_t")[metric]["low"])
    joined = measured.join(
        fences, (_key("lang") == F.col("_lang")) & (_key("source") == F.col("_source")), "left"
    )
    # A group without fences has only rows that fail the base.
    return joined.select(
        PACKED,
        "_q",
        base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(fine, F.lit(False))).alias("kept"),
    )


def judged(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """All rows with ``_q`` (base counts), ``base_failed`` and ``kept``.

    Needs ``text``, ``lang`` and ``source``, each of which may be NULL; NULL
    languages and sources are groups of their own. Columns of the added names are
    replaced, and no others. Repeated rows all count and are all judged; an empty
    table stays empty. A text at its fence is kept. The fences are computed once,
    from stored rows, and joined; the join is on a few values per group, which
    Spark broadcasts if they are small.
    """
    rows = _judged(docs, [c for c in docs.columns if keep_text or c != "text"])
    added = ("_q", "base_failed", "kept")
    return rows.select(*unpacked(rows, added), *added)


def document_quality(docs: DataFrame) -> DataFrame:
    rows = judged(docs.select("doc_id", "text", "lang", "source"), keep_text=False)
    return rows.select("doc_id", *[F.col("_q")[c].alias(c) for c in BASE], "base_failed", "kept")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows that pass, with the columns they came with, whatever their names."""
    rows = _judged(docs, docs.columns).where("kept")
    return rows.select(*unpacked(rows))
