"""Toxicity as an ordinal regression with a cumulative link.

P(grade >= k) = sigmoid(w x - t_k): one weight per word, shared by all ordered
thresholds t_1 < t_2 < ... The features are the distinct words of a text and the
beginnings of longer ones, as insults are inflected, out of a vocabulary chosen on
the labelled sample. Labels only say toxic or not, so the
grade of a toxic row is set by how many of the words that mark toxic rows it has:
the lower, middle or upper third of the toxic rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.llm.common import map_arrow, sliced, stored, texts_of, with_arrow_columns

GRADES = 3  # besides 0, not toxic
SAMPLE_ROWS = {0: 1800, 1: 900}  # by label
FEATURES = 1000
MIN_ROWS = 3
MIN_INFORMATION = 12.0
EVIDENCE_ODDS = 3.0
PENALTY = 0.0005
STEPS, RATE = 500, 0.1
TOXIC_FROM = 0.5
PREFIXES = (4, 5)
WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class OrdinalModel:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) per row and k from 1."""
        return _sigmoid(np.asarray(scores)[:, None] - np.array(self.thresholds)[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def words_in(text: str) -> set[str]:
    """Distinct words, and the beginnings of longer ones with a mark behind."""
    words = set(WORDS.findall(text.lower()))
    heads = [{w[:k] + "~" for w in words if len(w) > k} for k in PREFIXES]
    return words.union(*heads)


def _information(k: Column, n: Column, m: Column, total: Column) -> Column:
    """Twice the log-likelihood ratio of k out of n where m out of all have it."""
    cells = (
        (k, n * m),
        (n - k, n * (total - m)),
        (m - k, (total - n) * m),
        (total - n - m + k, (total - n) * (total - m)),
    )
    terms = [F.when(o > 0, o * F.log(o * total / e)).otherwise(0.0) for o, e in cells]
    return 2 * sum(terms[1:], terms[0])


def choose_features(sample: DataFrame) -> dict[str, float]:
    """The most informative words, with the log of their odds ratio.

    ``sample`` has ``toxic`` (0 or 1) and ``words``, the distinct words of whole texts.
    Words are counted in Spark; only the FEATURES chosen ones reach the driver.
    """
    rows = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("n_toxic"))
    total, toxic = rows.select("n").scalar(), rows.select("n_toxic").scalar()
    counts = (
        sample.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("k"), F.count("*").alias("m"))
        .where(F.col("m") >= MIN_ROWS)
    )
    k, m = F.col("k").cast("double"), F.col("m").cast("double")
    n, all_rows = toxic.cast("double"), total.cast("double")
    odds = F.log((k + 0.5) * (all_rows - n - m + k + 0.5)) - F.log(
        (n - k + 0.5) * (m - k + 0.5)
    )
    rated = counts.select("word", _information(k, n, m, all_rows).alias("gain"), odds.alias("odds"))
    rated = rated.where(F.col("gain") >= MIN_INFORMATION).orderBy(F.desc("gain"), "word")
    return {r["word"]: r["odds"] for r in rated.limit(FEATURES).collect()}


def grade_rows(rows: list[tuple[int, set[str]]], odds: dict[str, float]) -> np.ndarray:
    """0 for rows that are not toxic, else 1 to GRADES by their evidence."""
    marks = {w for w, v in odds.items() if v >= EVIDENCE_ODDS}
    evidence = np.array([len(words & marks) for _, words in rows])
    toxic = np.array([label == 1 for label, _ in rows])
    grades = np.zeros(len(rows), int)
    if toxic.any():
        cuts = np.quantile(evidence[toxic], [k / GRADES for k in range(1, GRADES)])
        grades[toxic] = 1 + (evidence[toxic][:, None] > cuts[None, :]).sum(1)
    return grades


def fit_ordinal(x: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by gradient steps on the likelihood.

    The likelihood is that of a cumulative link: a row of grade g lies between
    its thresholds g and g + 1. Thresholds are a first one and positive steps.
    """
    rows, width = x.shape
    weights = np.zeros(width)
    raw = np.concatenate(([0.0], np.zeros(GRADES - 1)))
    mean = np.zeros(width + GRADES)
    square = np.zeros(width + GRADES)
    for step in range(1, STEPS + 1):
        cuts = raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))
        score = (x @ weights.astype(x.dtype)).astype(float)
        above = _sigmoid(score[:, None] - cuts[None, :])  # P(grade >= k)
        full = np.hstack([np.ones((rows, 1)), above, np.zeros((rows, 1))])
        slope = full * (1 - full)
        take = np.arange(rows)
        chance = np.maximum(full[take, grades] - full[take, grades + 1], 1e-9)
        d_score = (slope[take, grades] - slope[take, grades + 1]) / chance
        d_cuts = np.zeros((rows, GRADES + 2))
        d_cuts[take, grades] -= slope[take, grades] / chance
        d_cuts[take, grades + 1] += slope[take, grades + 1] / chance
        d_cuts = d_cuts[:, 1:-1].mean(0)
        d_raw = np.concatenate(
            ([d_cuts.sum()], np.cumsum(d_cuts[::-1])[::-1][1:] * np.exp(raw[1:]))
        )
        gradient = np.concatenate(((d_score.astype(x.dtype) @ x) / rows - PENALTY * weights, d_raw))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights += move[:width]
        raw += move[width:]
    return weights, raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        rows = [sorted(words_in(t)) for t in texts_of(batch)]
        label = batch.column(batch.schema.get_field_index("toxic"))
        yield pa.RecordBatch.from_arrays(
            [label, pa.array(rows, pa.list_(pa.string()))], ["toxic", "words"]
        )


def fit(docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    """Fit on at most SAMPLE_ROWS rows of each label, those of lowest hash.

    Rows without a label are left out; a document labelled twice counts as toxic
    if one label says so. Of a sampled text all words count; the driver gets only those
    among the features. Without labels of both kinds every score is 0 and no row is
    called toxic.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    chosen = [
        known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for k, n in SAMPLE_ROWS.items()
    ]
    sample = docs.select("doc_id", "text").join(chosen[0].union(chosen[1]), "doc_id")
    schema = "toxic int, words array<string>"
    found = stored(map_arrow(sample.select("toxic", "text"), _words, schema), "toxicity-sample")
    if found.select("toxic").distinct().count() < 2:
        return OrdinalModel({}, tuple(float(k) for k in range(1, GRADES + 1)))
    odds = choose_features(found)
    features = F.array(*[F.lit(w) for w in odds]).cast("array<string>")
    got = found.select("toxic", F.array_intersect("words", features).alias("words")).collect()
    rows = sorted(((r["toxic"], set(r["words"])) for r in got), key=lambda r: (r[0], sorted(r[1])))
    grades = grade_rows(rows, odds)
    names = sorted(odds)
    column = {w: i for i, w in enumerate(names)}
    x = np.zeros((len(rows), len(names)), np.float32)
    for i, (_, words) in enumerate(rows):
        x[i, [column[w] for w in words if w in column]] = 1
    weights, cuts = fit_ordinal(x, grades)
    return OrdinalModel(dict(zip(names, weights.tolist(), strict=True)), tuple(cuts.tolist()))


def _grade(batch: pa.RecordBatch, model: OrdinalModel) -> list[pa.Array]:
    known = model.weights.keys()
    # Sorted, as a sum in another order could differ in its last digit.
    scores = [
        sum(model.weights[w] for w in sorted(known & words_in(t))) for t in texts_of(batch)
    ]
    at_least = model.at_least(np.array(scores, float).reshape(-1))
    return [
        pa.array(at_least[:, k]) for k in range(GRADES)
    ] + [pa.array(at_least.sum(1)), pa.array(at_least[:, 0] >= TOXIC_FROM)]


def graded(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """All rows with P(grade >= k), expected severity (0 to GRADES) and ``toxic``.

    NULL and empty texts have no features and score as such a text does.
    Columns of the added names are replaced.
    """
    fields = T.StructType()
    for k in range(1, GRADES + 1):
        fields = fields.add(f"p_grade_{k}", "double")
    fields = fields.add("severity", "double").add("toxic", "boolean")
    return with_arrow_columns(docs, fields, partial(_grade, model=model))


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    return graded(docs.select("doc_id", "text"), model).drop("text")
