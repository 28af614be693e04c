"""License notices found by voting on diagonals.

Rolling word k-grams of all documents are joined by hash to their places in the
license templates. A match at word ``p`` of a document and word ``t`` of a template
votes for the diagonal ``p - t``: an unbroken copy puts all its votes on one, and an
inserted or left-out word moves on to a neighbouring one, so neighbours are merged.
A merged span is verified if the words it covers, compared as words and not as
hashes, make up most of the template and most of the span.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilmark.llm.common import let, stored

GRAM = 3
VERIFIED = 0.8
# Diagonals this share of the template's words apart are one span, at most MOST_SHIFT.
SHIFT_SHARE, MOST_SHIFT = 4, 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public notices by which works state their license, by label.
NOTICES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
}


def words_of(text: Column) -> Column:
    """Runs of letters, digits and all signs beyond ASCII; only A-Z are lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def grams_of(words: Column, k: int) -> Column:
    """All runs of ``k`` consecutive words, joined by spaces; none if there are fewer."""

    def runs(listed: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(listed) - k)
        gram = lambda i: F.concat_ws(" ", *[F.get(listed, i + j) for j in range(k)])
        return F.when(F.size(listed) >= k, F.transform(places, gram))

    return let(words, runs)


def template_grams(
    spark: SparkSession, templates: Mapping[str, Sequence[str]], k: int
) -> DataFrame:
    """One row per word k-gram of every template: a table as small as the templates.

    A template must have ``k`` words at least.
    """
    rows = [(label, i, text) for label, texts in templates.items() for i, text in enumerate(texts)]
    listed = spark.createDataFrame(rows, "label string, nth int, notice string")
    listed = listed.withColumn("words", words_of(F.col("notice")))
    return listed.select(
        "label",
        "nth",
        F.size("words").alias("length"),
        F.posexplode(grams_of(F.col("words"), k)).alias("t_pos", "t_gram"),
    ).withColumn("t_hash", F.xxhash64("t_gram"))


def row_key(seed: int) -> Column:
    """Half of a row's 128-bit key, made of its id and text."""
    return F.xxhash64("doc_id", "text", F.lit(seed))


def license_spans(
    docs: DataFrame,
    templates: Mapping[str, Sequence[str]] = NOTICES,
    k: int = GRAM,
    verified: float = VERIFIED,
) -> DataFrame:
    """Spans of documents that share k-grams with a template, with their score.

    Rows: ``key_1`` and ``key_2`` (of `row_key`), ``doc_id``, ``label``, ``nth`` (which
    template), ``first`` and ``last`` word, ``votes``, ``score`` and ``is_license``. The score
    is the number of the template's words covered, over the template's or the span's
    length, whichever is larger. Rows that repeat id and text share their spans. NULL
    and short texts have none. Templates are broadcast: their size is not the data's.
    """
    grams = docs.select(
        "doc_id",
        row_key(1).alias("key_1"),
        row_key(2).alias("key_2"),
        F.posexplode(grams_of(words_of(F.col("text")), k)).alias("pos", "gram"),
    ).withColumn("hash", F.xxhash64("gram"))
    places = F.broadcast(template_grams(docs.sparkSession, templates, k))
    on = (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram"))
    span = ["key_1", "key_2", "doc_id", "label", "nth", "length"]
    hits = grams.join(places, on).select(
        *span, "pos", "t_pos", (F.col("pos") - F.col("t_pos")).alias("diagonal")
    )
    # Few rows, as most grams are in no template; repeated rows vote once.
    hits = stored(hits.distinct(), "license-hits")
    votes = hits.groupBy(*span, "diagonal").agg(
        F.count("*").alias("votes"),
        F.collect_set("t_pos").alias("places"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
    )
    along = Window.partitionBy(*span).orderBy("diagonal")
    shift = F.least(F.greatest(F.floor(F.col("length") / SHIFT_SHARE), F.lit(1)), F.lit(MOST_SHIFT))
    is_far = F.col("diagonal") - F.lag("diagonal").over(along) > shift
    spans = (
        votes.withColumn("far", F.when(is_far, 1).otherwise(0))
        .withColumn("nth_span", F.sum("far").over(along))
        .groupBy(*span, "nth_span")
        .agg(
            F.sum("votes").alias("votes"),
            # No more places than the template has words.
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
            F.min("first").alias("first"),
            (F.max("last") + (k - 1)).alias("last"),
        )
    )
    start = F.struct(F.lit(-k).alias("at"), F.lit(0).alias("covered"))
    covered = F.aggregate(
        "places",
        start,
        lambda acc, p: F.struct(
            p.alias("at"), (acc["covered"] + F.least(F.lit(k), p - acc["at"])).alias("covered")
        ),
        lambda acc: acc["covered"],
    )
    score = covered / F.greatest("length", F.col("last") - F.col("first") + 1)
    return spans.select(
        *[c for c in span if c != "length"], "first", "last", "votes", score.alias("score")
    ).withColumn("is_license", F.col("score") >= verified)


def _starts(words: Column, phrase: str) -> Column:
    """Places where the phrase's words stand consecutively; looked for if all are there."""
    parts = phrase.split()

    def stands(i: Column) -> Column:
        tests = [F.get(words, i + j) == part for j, part in enumerate(parts)]
        return reduce(Column.__and__, tests)

    holds = reduce(Column.__and__, [F.array_contains(words, part) for part in parts])
    places = F.sequence(F.lit(0), F.size(words) - 1)
    return F.when(holds, F.filter(places, stands)).otherwise(F.array().cast("array<int>"))


def named_licenses(docs: DataFrame, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """Per row its keys, number of words, and the places and labels of the phrases."""

    def counted(words: Column) -> Column:
        starts = F.array(*[_starts(words, phrase) for phrase in phrases])
        return F.struct(F.size(words).cast("long").alias("n_words"), starts.alias("starts"))

    rows = docs.select(
        "doc_id",
        row_key(1).alias("key_1"),
        row_key(2).alias("key_2"),
        let(words_of(F.col("text")), counted).alias("own"),
    ).select("doc_id", "key_1", "key_2", "own.*")
    found = [
        F.when(F.size(F.col("starts")[i]) > 0, F.lit(label))
        for i, label in enumerate(phrases.values())
    ]
    places = F.flatten("starts")
    return rows.select(
        "doc_id",
        "key_1",
        "key_2",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array_distinct(F.array(*found)))).alias("base"),
    )


def document_licenses(docs: DataFrame) -> DataFrame:
    """Every document with the licenses it names and those its spans were verified for.

    ``score`` is the best score of any span, 0 without one. NULL texts are empty. Rows
    that repeat id and text each have a row with the same answer; ids may be NULL. An
    empty table gives no rows. Other columns are not read.
    """
    spans = license_spans(docs)
    label = F.when(F.col("is_license"), F.col("label"))
    of_row = spans.groupBy("key_1", "key_2").agg(
        F.collect_set(label).alias("found"), F.max("score").alias("best")
    )
    rows = named_licenses(docs).join(of_row, ["key_1", "key_2"], "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", none)))
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )
