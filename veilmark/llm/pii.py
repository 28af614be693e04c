"""Personal data: rules, and a character BiLSTM-CRF that adds to them.

The rules find emails, IP addresses, card and phone numbers. Their spans in a
bounded sample label windows of characters, some of them written in other ways;
a network trained on these tags all texts. Windows overlap by half. The scores
that a character gets in its windows are averaged, and one best tag sequence is
found for each stretch of windows, so a span at the edge of one window is settled
by all. A span must hold a digit or an at sign, so only windows with one are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.llm.char_crf import CharCrf, best_tags, codes_of
from veilmark.llm.common import map_arrow, sliced, texts_of, with_arrow_columns

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
SECTION = 512  # windows; longer stretches are settled in sections
SHARED = 8  # windows that a section has in common with the one before
SAMPLE_DOCS = 1500
WINDOWS_PER_DOC = 6  # of a sampled document, for the training alone
TRAIN_WINDOWS = 2400
STEPS, BATCH, RATE, SEED = 360, 48, 0.02, 5
REWRITTEN = 0.3

TRIGGER = re.compile(r"[0-9@]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match begins with its whole first number, as the number must reach the dot.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def is_card(text: str) -> bool:
    digits = NOT_DIGIT.sub("", text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 10 <= len(NOT_DIGIT.sub("", text)) <= 15


def emails(text: str) -> Iterator[Span]:
    """As the pattern's leftmost matches, in time linear in the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done, "email"
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the rules: leftmost, not overlapping within a kind, validated."""
    if not TRIGGER.search(text):
        return []
    found = list(emails(text))
    for kind, pattern, valid in (
        ("ip", IP, is_ip),
        ("card", CARD, is_card),
        ("phone", PHONE, is_phone),
    ):
        found += [(*m.span(), kind) for m in pattern.finditer(text) if valid(m[0])]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def digest(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign, on a fixed grid."""
    starts: dict[int, None] = {}
    for m in TRIGGER.finditer(text):
        k = m.start() // STRIDE
        for start in ((k - 1) * STRIDE, k * STRIDE):
            if start >= 0:
                starts[start] = None
    return sorted(starts)


def tags_of(spans: list[Span], length: int) -> np.ndarray:
    """0 outside, 2k + 1 where kind k begins, 2k + 2 inside it."""
    tags = np.zeros(length, np.int64)
    for start, end, kind in spans:
        k = KINDS.index(kind)
        tags[start:end] = 2 * k + 2
        tags[start] = 2 * k + 1
    return tags


def spans_of(tags: np.ndarray) -> list[Span]:
    out, start, kind = [], 0, -1
    for i, tag in enumerate([*tags.tolist(), 0]):
        k = (tag - 1) // 2 if tag else -1
        if k != kind or tag % 2 == 1:
            if kind >= 0:
                out.append((start, i, KINDS[kind]))
            start, kind = i, k
    return out


def rewritten(text: str, span: Span, rng: np.random.Generator) -> str:
    """Another way to write a span, of the same length."""
    part = text[span[0] : span[1]]
    if span[2] == "phone":
        return " " + part[1:]
    if span[2] == "card":
        return re.sub(r"[\x20-]", ".", part)
    if span[2] == "email":
        return part.upper()
    return part


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around spans and around other numbers, with the rules' tags."""
    for batch in sliced(batches):
        windows, tags = [], []
        for text in texts_of(batch):
            spans = base_spans(text)
            chosen = window_starts(text)
            every = max(1, -(-len(chosen) // WINDOWS_PER_DOC))
            for start in chosen[::every]:
                # Spans cut by the window's edge are tagged as far as it goes.
                inside = [
                    (max(s - start, 0), min(e - start, WINDOW), kind)
                    for s, e, kind in spans
                    if s < start + WINDOW and e > start
                ]
                window = text[start : start + WINDOW]
                if len(window) == WINDOW:
                    windows.append(window)
                    tags.append(bytes(tags_of(inside, WINDOW).astype(np.uint8)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(windows, pa.string()), pa.array(tags, pa.binary())], ["window", "tags"]
        )


def fit(docs: DataFrame, text: str = "text") -> CharCrf | None:
    """Trained on windows of at most SAMPLE_DOCS different texts, those of lowest hash.

    None if no text has a digit or an at sign.
    """
    body = docs.select(F.col(text).alias("text")).where("text RLIKE '[0-9@]'")
    # Copies of a text count once, however many there are.
    hashes = body.select(F.xxhash64("text").alias("h")).distinct().orderBy("h").limit(SAMPLE_DOCS)
    last = hashes.agg(F.max("h")).first()[0]
    if last is None:
        return None
    sample = body.where(F.xxhash64("text") <= last).distinct()
    rows = map_arrow(sample, _sample_windows, "window string, tags binary").collect()
    rows = sorted({(r["window"], bytes(r["tags"])) for r in rows})
    if not rows:
        return None
    rng = np.random.default_rng(SEED)
    rows = [rows[i] for i in sorted(rng.permutation(len(rows))[:TRAIN_WINDOWS])]
    codes, tags = [], []
    for window, marks in rows:
        known = np.frombuffer(marks, np.uint8).astype(np.int64)
        if rng.random() < REWRITTEN:
            for span in spans_of(known):
                new = rewritten(window, span, rng)
                window = window[: span[0]] + new + window[span[1] :]
                if span[2] == "phone" and known[span[0]] % 2 == 1 and span[1] - span[0] > 1:
                    known = known.copy()
                    known[span[0] + 1] = known[span[0]]
                    known[span[0]] = 0
        codes.append(codes_of(window))
        tags.append(known)
    model = CharCrf.start(1 + 2 * len(KINDS), SEED)
    model.fit(np.array(codes), np.array(tags), STEPS, BATCH, RATE, SEED)
    return model


def valid_addition(text: str, kind: str) -> bool:
    """What the network adds must be possible as its kind."""
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@.]+", text))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]+([. ]{1,3}[0-9]+){3}", text)) and is_ip(
            re.sub(r"[. ]+", ".", text)
        )
    if kind == "card":
        return is_card(text) and not re.search(r"[A-Za-z]", text)
    return is_phone(text) and bool(re.fullmatch(r"[0-9(][0-9().\x20-]*[().\x20-][0-9().\x20-]*[0-9]", text))


class Tagger:
    """Tags batches of texts with bounded memory."""

    def __init__(self, model: CharCrf):
        self.model = model
        edge = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1.0
        self.weight = (edge / edge.max()).astype(np.float32)

    def sections(self, text: str) -> list[list[int]]:
        """Runs of windows that overlap, in sections of bounded length.

        A section begins with the last windows of the one before, so what one of them
        sees cut short at its edge, the other sees whole.
        """
        runs: list[list[int]] = []
        for start in window_starts(text):
            goes_on = runs and start - runs[-1][-1] == STRIDE
            if goes_on and len(runs[-1]) < SECTION:
                runs[-1].append(start)
            else:
                runs.append([*runs[-1][-SHARED:], start] if goes_on else [start])
        return runs

    def spans(self, texts: list[str]) -> list[list[Span]]:
        out: list[list[Span]] = [[] for _ in texts]
        waiting: list[tuple[int, list[int]]] = []
        size = 0
        for i, text in enumerate(texts):
            for run in self.sections(text):
                waiting.append((i, run))
                size += len(run)
                if size >= 4 * SECTION:
                    self._settle(texts, waiting, out)
                    waiting, size = [], 0
        self._settle(texts, waiting, out)
        return out

    def _settle(self, texts: list[str], runs: list[tuple[int, list[int]]], out: list) -> None:
        if not runs:
            return
        runs = sorted(runs, key=lambda r: len(r[1]))
        codes = np.full((sum(len(r) for _, r in runs), WINDOW), 98)
        row = 0
        for i, run in runs:
            for start in run:
                part = codes_of(texts[i][start : start + WINDOW])
                codes[row, : len(part)] = part
                row += 1
        scores = self.model.scores(codes) * self.weight[None, :, None]
        row = at = 0
        while at < len(runs):
            n = len(runs[at][1])
            same = [r for r in runs[at:] if len(r[1]) == n]
            length = (n - 1) * STRIDE + WINDOW
            block = scores[row : row + n * len(same)].reshape(len(same), n, WINDOW, -1)
            joined = np.zeros((len(same), length, block.shape[3]), np.float32)
            total = np.zeros(length, np.float32)
            for k in range(n):
                joined[:, k * STRIDE : k * STRIDE + WINDOW] += block[:, k]
                total[k * STRIDE : k * STRIDE + WINDOW] += self.weight
            tags = best_tags(joined / total[None, :, None], self.model.weights["pairs"])
            for (i, run), line in zip(same, tags, strict=True):
                self._keep(texts[i], run[0], line, out[i])
            row += n * len(same)
            at += len(same)

    def _keep(self, text: str, first: int, tags: np.ndarray, out: list[Span]) -> None:
        for start, end, kind in spans_of(tags):
            start, end = first + start, min(first + end, len(text))
            while start < end and text[start] in " \t\n,;:":
                start += 1
            while end > start and text[end - 1] in " \t\n,;:.":
                end -= 1
            if valid_addition(text[start:end], kind):
                out.append((start, end, kind))


def all_spans(texts: list[str], model: CharCrf | None) -> list[tuple[list[Span], list[Span]]]:
    """Per text the rules' spans, and those with the network's that overlap none."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, b) for b in base]
    out = []
    for rules, tagged in zip(base, Tagger(model).spans(texts), strict=True):
        spans = list(rules)
        # The longer of two additions that overlap, as the other one was cut short.
        for start, end, kind in sorted(set(tagged), key=lambda s: (s[0] - s[1], s)):
            if all(end <= s or start >= e for s, e, _ in spans):
                spans.append((start, end, kind))
        out.append((rules, sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))))
    return out


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("by_rule", T.BooleanType()),
    ]
)
SPAN_ARROW = pa.struct(
    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("by_rule", pa.bool_())]
)


def _find(batch: pa.RecordBatch, model: CharCrf | None, text: str) -> list[pa.Array]:
    rows = []
    for rules, spans in all_spans(texts_of(batch, text), model):
        known = set(rules)
        rows.append(
            [
                {"kind": s[2], "start": s[0], "end": s[1], "by_rule": s in known}
                for s in spans
            ]
        )
    return [pa.array(rows, pa.list_(SPAN_ARROW))]


def with_spans(docs: DataFrame, model: CharCrf | None, text: str = "text") -> DataFrame:
    """All rows with ``pii``: spans in code points, by start, then kind.

    NULL and empty texts have none. A column named ``pii`` is replaced.
    """
    fields = T.StructType([T.StructField("pii", T.ArrayType(SPAN))])
    return with_arrow_columns(docs, fields, partial(_find, model=model, text=text), text)


def _redact(batch: pa.RecordBatch, model: CharCrf | None) -> list[pa.Array]:
    column = batch.column(batch.schema.get_field_index("text")).to_pylist()
    out = []
    for text, (_, spans) in zip(column, all_spans([t or "" for t in column], model), strict=True):
        parts, done = [], 0
        for start, end, kind in spans:
            if start >= done:
                parts += [text[done:start], f"[{kind.upper()}]"]
            done = max(done, end)
        out.append(text if text is None else "".join([*parts, text[done:]]))
    return [pa.array(out, pa.string())]


def redacted(docs: DataFrame) -> DataFrame:
    """All rows, spans in ``text`` replaced by their kind; overlapping ones by the first.

    ``n_chars`` follows the new text where there is such a column.
    """
    names = docs.columns
    fields = T.StructType([T.StructField("text", T.StringType())])
    rows = with_arrow_columns(docs, fields, partial(_redact, model=fit(docs)))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.length("text").cast(kind))
    return rows.select(*[F.col(f"`{c}`") for c in names])


def document_pii(docs: DataFrame) -> DataFrame:
    rows = with_spans(docs.select("doc_id", "text"), fit(docs)).drop("text")

    def shown(spans: Column) -> Column:
        parts = F.transform(spans, lambda p: F.concat_ws(":", p["kind"], p["start"], p["end"]))
        return F.array_join(parts, ",")

    ruled = F.filter("pii", lambda p: p["by_rule"])

    def count(kind: str) -> Column:
        return F.size(F.filter(ruled, lambda p: p["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(shown(ruled), 256).alias("base_sha256"),
        shown(F.col("pii")).alias("spans"),
    )
