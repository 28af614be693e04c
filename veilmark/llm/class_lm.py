"""Brown class-based bigrams.

P(w | v) = P(class of w | class of v) P(w | class of w). The most frequent words
are assigned to classes by exchange: each word in turn moves to the class that
raises the likelihood of the class bigrams most. All other numbered words that are
not too rare to tell then join these classes: pairs of words are counted once, and tasks
choose each word's best class from its neighbours and the table of all classes, for some
rounds. What
is rarer belongs to tail classes by its ending. Every word is counted, whatever its
class; counts of rare words meet the texts in a join, those of frequent words are few
and known to all tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.llm.common import map_arrow, sliced, stored

CLUSTERED = 500
CLASSES = 32
TAILS = 16
ENDING = 3
ROUNDS = 8
# Words of fewer occurrences have too few neighbours to choose a class by.
LEAST = 5
PASSES = 4
CELLS_AT_ONCE = 1 << 22
WORDS_AT_ONCE = 256
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FREQUENT = 100_000
HELD_MOD, HELD_REST = 7, 2
MOST_KEPT = 300_000
# A word that occurs several times in one slice of texts is looked up once.
CODED_BYTES = 8 << 20


def held_out(doc_id: str) -> Column:
    """Whether a row is kept out of the counts; NULL ids are not."""
    digits = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % HELD_MOD == HELD_REST


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % TAILS


def words_of_batch(batch: pa.RecordBatch, text: str = "text") -> list[list[bytes]]:
    """Words of each text as UTF-8 with A-Z lowered; none for NULL.

    Both methods of bytes know ASCII only: exactly these letters, and exactly
    the six white-space characters that part words.
    """
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    return [(t or b"").lower().split() for t in column.to_pylist()]


@dataclass(frozen=True)
class Coded:
    """Texts of a batch as places of words: text i has those from offset i to i + 1."""

    distinct: pa.Array  # words as `words_of_batch` gives them, and maybe an unused empty one
    which: np.ndarray  # the word at each place
    offsets: np.ndarray

    def line(self, values: np.ndarray, end: int) -> np.ndarray:
        """A value per place, with ``end`` before and after each text."""
        n_texts = len(self.offsets) - 1
        line = np.full(len(values) + n_texts + 1, end)
        text = np.repeat(np.arange(n_texts), np.diff(self.offsets))
        line[np.arange(len(values)) + text + 1] = values
        return line


def coded_words(batch: pa.RecordBatch, text: str = "text") -> Coded:
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    coded = parts.flatten().dictionary_encode()
    distinct, which = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy()
    offsets = parts.offsets.to_numpy()
    # White space around a text and a text without words leave empty parts.
    empty = distinct.index(b"").as_py()
    if empty >= 0:
        filled = which != empty
        offsets = np.append(0, np.cumsum(filled))[offsets]
        which = which[filled]
    return Coded(distinct, which, offsets)


COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def _added_up(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    counts = pa.Table.from_batches(held, COUNTS).group_by("word", use_threads=False)
    counts = counts.aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
    return counts.select(COUNTS.names).combine_chunks().to_batches()[0]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their number; the end of a text is the word NULL."""
    held, size, n_texts = [], 0, 0
    for batch in sliced(batches, at_once=CODED_BYTES):
        n_texts += batch.num_rows
        coded = coded_words(batch)
        times = np.bincount(coded.which, minlength=len(coded.distinct))
        counts = pa.RecordBatch.from_arrays([coded.distinct, pa.array(times)], schema=COUNTS)
        held.append(counts.filter(pa.array(times > 0)))
        size += len(held[-1])
        if size > 2 * MOST_KEPT:
            held = [_added_up(held)]
            size = len(held[0])
            if size > MOST_KEPT:
                yield held[0]
                held, size = [], 0
    if size:
        yield _added_up(held)
    if n_texts:
        ends = [pa.array([None], pa.binary()), pa.array([n_texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(ends, schema=COUNTS)


def word_counts(training: DataFrame) -> DataFrame:
    """``word`` (UTF-8, NULL for the end) and ``n``, over all training rows."""
    partial_counts = map_arrow(training.select("text"), _count_words, "word binary, n long")
    return partial_counts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach, found from counts of counts."""
    by_count = counts.where("word IS NOT NULL").groupBy("n").agg(F.count("*").alias("words"))
    # One row per distinct count, which are few beside the words.
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    upto = by_count.select("n", F.sum("words").over(above).alias("upto"))
    least, greatest = upto.agg(
        F.min(F.when(F.col("upto") <= most, F.col("n"))), F.max("n")
    ).first()
    return least if least is not None else (greatest or 0) + 1


def numbered_words(number: dict[bytes, int]) -> pa.Array:
    """The words in the order of their numbers, which are 0 and on."""
    return pa.array(number, pa.binary())


def _symbols(words: pa.Array, numbered: pa.Array) -> np.ndarray:
    """Numbers of the words; a tail class follows the numbered words."""
    found = pc.fill_null(pc.index_in(words, numbered), -1).to_numpy().astype(np.int64)
    rest = np.flatnonzero(found < 0)
    if len(rest):
        endings = pc.binary_slice(words.take(pa.array(rest)), -ENDING).dictionary_encode()
        tails = [tail_class(e) for e in endings.dictionary.to_pylist()]
        found[rest] = len(numbered) + np.array(tails)[endings.indices.to_numpy()]
    return found


def _lines(
    batches: Iterator[pa.RecordBatch], number: dict[bytes, int]
) -> Iterator[np.ndarray]:
    """Symbols of some texts in a row, with the end before and after each text."""
    numbered = numbered_words(number)
    for batch in sliced(batches, at_once=CODED_BYTES):
        coded = coded_words(batch)
        yield coded.line(_symbols(coded.distinct, numbered)[coded.which], len(number) + TAILS)


def _bincounts(parts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct numbers with how often they occur, many parts at once."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= CELLS_AT_ONCE:
            yield np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
    if size:
        yield np.unique(np.concatenate(held), return_counts=True)


def _cells(counted: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for cells, n in counted:
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], ["cell", "n"])


def _count_pairs(
    batches: Iterator[pa.RecordBatch], number: dict[bytes, int]
) -> Iterator[pa.RecordBatch]:
    """Pairs of symbols in a row, as one number each."""
    n_symbols = len(number) + TAILS + 1
    lines = _lines(batches, number)
    yield from _cells(_bincounts(line[:-1] * n_symbols + line[1:] for line in lines))


def neighbours(training: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """``word`` and ``others``: what follows it and, from ``n_symbols`` on, what precedes it.

    Symbols are the numbered words, the tails and the end. Pairs are counted once; every
    later count of classes follows from them. A list has two entries per symbol at most.
    """
    n_symbols = len(number) + TAILS + 1
    counter = partial(_count_pairs, number=number)
    pairs = map_arrow(training.select("text"), counter, "cell long, n long")
    pairs = pairs.groupBy("cell").agg(F.sum("n").alias("n"))
    first, second = F.expr(f"cell div {n_symbols}"), F.col("cell") % n_symbols
    sides = F.array(
        F.struct(first.alias("word"), second.alias("other"), "n"),
        F.struct(second.alias("word"), (first + n_symbols).alias("other"), "n"),
    )
    return pairs.select(F.inline(sides)).groupBy("word").agg(
        F.collect_list(F.struct("other", "n")).alias("others")
    )


@contextmanager
def _few_rows_at_once(spark: SparkSession) -> Iterator[None]:
    """Lists of neighbours go to Python by so many words, as a list can be long."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(WORDS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and of all their neighbours the row, the symbol and the count."""
    words, lists = batch.column(0).to_numpy(), batch.column(1)
    row = np.repeat(np.arange(len(words)), np.diff(lists.offsets.to_numpy()))
    flat = lists.flatten()
    return words, row, flat.field("other").to_numpy(), flat.field("n").to_numpy()


def _count_classes(
    batches: Iterator[pa.RecordBatch], classes: np.ndarray, width: int
) -> Iterator[pa.RecordBatch]:
    """Bigrams of classes; the last of ``classes`` is that of the end."""
    sums = np.zeros(width * width)
    for batch in batches:
        words, row, other, n = _flat(batch)
        follows = other < len(classes)
        cell = classes[words][row[follows]] * width + classes[other[follows]]
        sums += np.bincount(cell, n[follows], width * width)
    cells = np.flatnonzero(sums)
    yield from _cells([(cells, sums[cells].astype(np.int64))])


def _table(near: DataFrame, classes: np.ndarray, width: int) -> np.ndarray:
    """The class bigrams of all training rows; bounded by the number of classes."""
    cells = map_arrow(near, partial(_count_classes, classes=classes, width=width), "cell long, n long")
    with _few_rows_at_once(near.sparkSession):
        counted = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(width * width)
    table[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    return table.reshape(width, width)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_clusters(bigrams: np.ndarray, n_words: int, classes: int = CLASSES) -> np.ndarray:
    """Class of every symbol; the first ``n_words`` symbols move between classes.

    The other symbols are classes of their own, after the clusters. A word goes
    where sum N(a,b) log N(a,b) - sum N(a.) log N(a.) - sum N(.b) log N(.b) is
    largest, which is the likelihood of the class bigrams but for a constant.
    """
    width = len(bigrams)
    k = classes + width - n_words
    place = np.concatenate((np.arange(n_words) % classes, classes + np.arange(width - n_words)))
    member = np.zeros((width, k))
    member[np.arange(width), place] = 1
    table = member.T @ bigrams @ member
    for _ in range(ROUNDS):
        moved = 0
        for w in range(n_words):
            own = place[w]
            alone = bigrams[w, w]
            member[w, own] = 0
            right, left = bigrams[w] @ member, bigrams[:, w] @ member
            table[own] -= right
            table[:, own] -= left
            table[own, own] -= alone
            sums_l, sums_r = table.sum(1)[:classes], table.sum(0)[:classes]
            rows, columns = table[:classes], table[:, :classes].T
            gain = (_xlogx(rows + right) - _xlogx(rows)).sum(1)
            gain += (_xlogx(columns + left) - _xlogx(columns)).sum(1)
            c = np.arange(classes)
            diagonal = table[c, c]
            # The cell of a class with itself is in both sums; count it once.
            gain -= _xlogx(diagonal + right[:classes]) + _xlogx(diagonal + left[:classes])
            gain += _xlogx(diagonal) + _xlogx(diagonal + right[:classes] + left[:classes] + alone)
            gain -= _xlogx(sums_l + right.sum() + alone) - _xlogx(sums_l)
            gain -= _xlogx(sums_r + left.sum() + alone) - _xlogx(sums_r)
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9:
                best = own
            moved += best != own
            place[w] = best
            member[w, best] = 1
            table[best] += right
            table[:, best] += left
            table[best, best] += alone
        if not moved:
            break
    return place


def likelihood(table: np.ndarray) -> float:
    """Log likelihood of the class bigrams but for a constant."""
    return _xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum()


def best_classes(
    own: np.ndarray,
    right: np.ndarray,
    left: np.ndarray,
    alone: np.ndarray,
    table: np.ndarray,
    classes: int = CLASSES,
) -> np.ndarray:
    """The best class of each word while all others stay where they are.

    A row per word: its class, how often each class follows and precedes it, and how
    often it follows itself. Ties stay; a word from a tail always moves.
    """
    b, c = np.arange(len(own)), np.arange(classes)
    right, left = right.astype(float), left.astype(float)
    right[b, own] -= alone
    left[b, own] -= alone
    rest = np.repeat(table[None].astype(float), len(own), 0)
    rest[b, own] -= right
    rest[b, :, own] -= left
    rest[b, own, own] -= alone
    sums_l, sums_r = rest.sum(2)[:, :classes], rest.sum(1)[:, :classes]
    rows, columns = rest[:, :classes], rest[:, :, :classes].transpose(0, 2, 1)
    gain = (_xlogx(rows + right[:, None]) - _xlogx(rows)).sum(2)
    gain += (_xlogx(columns + left[:, None]) - _xlogx(columns)).sum(2)
    diagonal, r, l = rest[:, c, c], right[:, :classes], left[:, :classes]
    self_pairs = alone[:, None]
    gain -= _xlogx(diagonal + r) + _xlogx(diagonal + l)
    gain += _xlogx(diagonal) + _xlogx(diagonal + r + l + self_pairs)
    # The word comes back as a neighbour too, whatever its class.
    sums_l, sums_r = sums_l + l, sums_r + r
    gain -= _xlogx(sums_l + right.sum(1)[:, None] + self_pairs) - _xlogx(sums_l)
    gain -= _xlogx(sums_r + left.sum(1)[:, None] + self_pairs) - _xlogx(sums_r)
    best = gain.argmax(1)
    placed = own < classes
    stays = placed & (gain[b, best] <= gain[b, np.where(placed, own, 0)] + 1e-9)
    return np.where(stays, own, best)


def _choose(
    batches: Iterator[pa.RecordBatch], classes: np.ndarray, table: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The best class of each word, by the classes of its neighbours."""
    width, n_symbols = len(table), len(classes)
    span = 2 * width + 1
    for batch in batches:
        words, row, other, n = _flat(batch)
        precedes = other >= n_symbols
        code = classes[other - n_symbols * precedes] + width * precedes
        itself = other == words[row]
        place = np.concatenate((row * span + code, row[itself] * span + 2 * width))
        counts = np.bincount(place, np.concatenate((n, n[itself])), len(words) * span)
        counts = counts.reshape(len(words), span)
        best = best_classes(
            classes[words],
            counts[:, :width],
            counts[:, width : 2 * width],
            counts[:, 2 * width],
            table,
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(words), pa.array(best.astype(np.int64))], ["word", "class"]
        )


def spread_clusters(
    near: DataFrame, classes: np.ndarray, n_words: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Class of every symbol and the class bigrams, with the first ``n_words`` moving.

    ``near`` is what `neighbours` returns. Words choose at the same time, so after the
    first pass only every second one does; a pass that lowers the likelihood is taken
    back and ends the rounds.
    """
    table = _table(near, classes, width)
    reached = None
    for turn in range(PASSES):
        movers = near.where(F.col("word") < n_words)
        if turn:
            movers = movers.where(F.col("word") % 2 == turn % 2)
        chooser = partial(_choose, classes=classes, table=table)
        with _few_rows_at_once(near.sparkSession):
            chosen = map_arrow(movers, chooser, "word long, class long").toArrow()
        moved = classes.copy()
        moved[chosen["word"].to_numpy()] = chosen["class"].to_numpy()
        if (moved == classes).all():
            break
        new_table = _table(near, moved, width)
        new = likelihood(new_table)
        if reached is not None and new <= reached:
            break
        classes, table, reached = moved, new_table, new
    return classes, table


@dataclass(frozen=True)
class ClassModel:
    """What every scoring task needs; its size is bounded by the parameters."""

    number: dict[bytes, int]  # frequent words, the clustered ones first
    n_clustered: int
    log_count: np.ndarray  # log10(n + 1) of the frequent words
    place: np.ndarray  # class of each clustered word, tail and the end
    log_transition: np.ndarray
    log_weight: np.ndarray  # log10 of a class's denominator
    n_tokens: int
    n_distinct: int
    n_ends: int


def fit(training: DataFrame, counts: DataFrame) -> tuple[ClassModel, DataFrame]:
    """The model, and the counts of all words that are not frequent."""
    from_count = frequent_from(counts, FREQUENT)
    known = counts.where("word IS NOT NULL")
    top = known.where(F.col("n") >= from_count).collect()
    top = sorted(top, key=lambda r: (-r["n"], bytes(r["word"])))
    words = [bytes(r["word"]) for r in top]
    numbers = np.array([r["n"] for r in top], np.int64)
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count("*"),
        F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)),
    ).first()
    number = {w: i for i, w in enumerate(words)}
    n_seeds = min(CLUSTERED, len(words))
    n_clustered = max(n_seeds, int((numbers >= LEAST).sum()))
    # The seeds by themselves, all else by endings, the end.
    endings = np.array([tail_class(w) for w in words[n_seeds:]], np.int64)
    tails_end = np.arange(TAILS + 1)
    width = n_seeds + TAILS + 1
    apart = np.concatenate((np.arange(n_seeds), n_seeds + endings, n_seeds + tails_end))
    near = stored(neighbours(training, number), "lm-neighbours")
    bigrams = _table(near, apart, width)
    place = exchange_clusters(bigrams, n_seeds)
    k = CLASSES + TAILS + 1
    classes = place[apart]
    if n_clustered > n_seeds:
        classes, table = spread_clusters(near, classes, n_clustered, k)
    else:
        member = np.zeros((width, k))
        member[np.arange(width), place] = 1
        table = member.T @ bigrams @ member
    place = classes
    transition = (table + 1) / (table.sum(1, keepdims=True) + k)

    # Tokens and distinct words of each class; a tail has room for one unseen word.
    rest = known.where(F.col("n") < from_count)
    tails = map_arrow(rest, _tail_sums, "tail int, n long, words long").groupBy("tail").agg(
        F.sum("n").alias("n"), F.sum("words").alias("words")
    )
    weight = np.zeros(k)
    for i in range(n_clustered):
        weight[place[i]] += numbers[i] + 1
    for w, n in zip(words[n_clustered:], numbers[n_clustered:], strict=True):
        weight[CLASSES + tail_class(w)] += n + 1
    for row in tails.collect():
        weight[CLASSES + row["tail"]] += row["n"] + row["words"]
    weight[CLASSES : CLASSES + TAILS] += 1
    model = ClassModel(
        number=number,
        n_clustered=n_clustered,
        log_count=np.log10(numbers + 1.0),
        place=place,
        log_transition=np.log10(transition),
        log_weight=np.log10(np.maximum(weight, 1)),
        n_tokens=int(total[0]),
        n_distinct=int(total[1]),
        n_ends=int(total[2]),
    )
    return model, rest


def _tail_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, words = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
    for batch in batches:
        tails = [tail_class(w) for w in batch.column(0).to_pylist()]
        if tails:
            n += np.bincount(tails, batch.column(1).to_numpy(), TAILS).astype(np.int64)
            words += np.bincount(tails, minlength=TAILS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(TAILS, dtype=np.int32)), pa.array(n), pa.array(words)],
        ["tail", "n", "words"],
    )


SCORED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("frequent_known", T.LongType()),
        T.StructField("frequent_log", T.DoubleType()),
        T.StructField("class_log", T.DoubleType()),
        T.StructField("rare_words", T.ArrayType(T.BinaryType())),
        T.StructField("rare_times", T.ArrayType(T.IntegerType())),
    ]
)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each text's values."""
    return np.array([values[a:b].sum() for a, b in pairwise(offsets.tolist())], float)


def _rare_words(coded: Coded, rare: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Each text's distinct words among the ``rare`` places, and how often they occur there."""
    n_texts = len(coded.offsets) - 1
    text = np.repeat(np.arange(n_texts), np.diff(coded.offsets))[rare]
    n_words = max(1, len(coded.distinct))
    pairs, times = np.unique(text * n_words + coded.which[rare], return_counts=True)
    ends = np.cumsum(np.bincount(pairs // n_words, minlength=n_texts))
    offsets = pa.array(np.append(0, ends).astype(np.int32))
    words = coded.distinct.take(pa.array(pairs % n_words))
    return (
        pa.ListArray.from_arrays(offsets, words),
        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
    )


def _score(
    batches: Iterator[pa.RecordBatch], model: ClassModel, kept: list[str]
) -> Iterator[pa.RecordBatch]:
    n_numbered, n_clustered = len(model.number), model.n_clustered
    numbered = numbered_words(model.number)
    # Symbol -> class: frequent words beyond the clustered ones are in tails too.
    of_tail = [CLASSES + tail_class(w) for w in list(model.number)[n_clustered:]]
    tails = CLASSES + np.arange(TAILS)
    classes = np.concatenate((model.place[:n_clustered], of_tail, tails)).astype(np.int64)
    end = CLASSES + TAILS
    for batch in sliced(batches, at_once=CODED_BYTES):
        coded = coded_words(batch)
        symbols = _symbols(coded.distinct, numbered)[coded.which]
        known = symbols < n_numbered
        known_offsets = np.append(0, np.cumsum(known))[coded.offsets]
        line = coded.line(classes[symbols], end)
        # Between two texts stands one end, from which the second goes on.
        turns = coded.offsets + np.arange(len(coded.offsets))
        made = [
            pa.array(np.diff(turns)),
            pa.array(np.diff(known_offsets)),
            pa.array(_sums(model.log_count[symbols[known]], known_offsets)),
            pa.array(
                _sums(model.log_transition[line[:-1], line[1:]], turns)
                - _sums(model.log_weight[classes[symbols]], coded.offsets)
            ),
            *_rare_words(coded, ~known),
        ]
        same = [batch.column(batch.schema.get_field_index(c)) for c in kept]
        yield pa.RecordBatch.from_arrays([*same, *made], names=[*kept, *SCORED.names])


def scored(docs: DataFrame) -> DataFrame:
    """Unigram base score and class-bigram score of every row.

    Needs ``doc_id`` and ``text``; rows whose id's checksum falls on HELD_REST
    are scored but not counted. NULL and empty texts have the end alone. A word
    never counted belongs to the tail class of its ending and shares the room
    left there. Repeated rows are scored one by one. Without any counted row
    the base score is 0 for each token.
    """
    rows = docs.select("doc_id", "text", held_out("doc_id").alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = stored(word_counts(training), "lm-counts")
    model, rest = fit(training, counts)
    kept = ["row", "doc_id", "held_out"]
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("held_out", T.BooleanType()),
            *SCORED,
        ]
    )
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    # Stored, so that the row numbers stay what they are.
    first = stored(
        map_arrow(numbered, partial(_score, model=model, kept=kept), schema), "lm-scored"
    )
    pairs = first.select("row", F.explode(F.arrays_zip("rare_words", "rare_times")).alias("p"))
    pairs = pairs.select(
        "row", F.col("p.rare_words").alias("word"), F.col("p.rare_times").alias("times")
    )
    rare = (
        pairs.join(rest, "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log"),
            F.sum("times").alias("rare_known"),
        )
    )
    room = float(np.log10(model.n_tokens + model.n_distinct + 1))
    end_log = float(np.log10(model.n_ends + 1))
    word_log = F.col("frequent_log") + F.coalesce("rare_log", F.lit(0.0))
    score = F.col("class_log") + word_log
    return first.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (
            F.col("frequent_known")
            + F.coalesce("rare_known", F.lit(0))
            + F.lit(int(model.n_ends > 0))
        ).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (word_log + end_log - F.col("n_tokens") * room).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
