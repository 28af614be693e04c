"""N-gram Jaccard self-join with prefix filters under several token orders.

The tokens of a text are hashes of its n-word shingles. Under any global order of
the tokens, two sets of the wanted similarity share a token among the first few of
each (the prefix). One order, rarest words first, is indexed and gives the
candidates; they must share prefix tokens under every other order too before their
sets are compared.

Which tokens are common is told by their words at first. The lists that these
prefixes would give are counted over all texts, and the tokens of long lists go to
the end of every order: a passage that many texts share then leaves the prefixes
of all texts that have enough of their own.

Texts with equal sets are one class from the start. Lists of the index that are
longer than LONG_LIST come from large groups of near copies or from passages that
many texts share; their texts are dealt into chunks of bounded size, and pairs of
chunks are compared whole, so no pairs are written out for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilmark.llm.class_lm import frequent_from, word_counts, words_of_batch
from veilmark.llm.common import (
    PACKED,
    importable,
    map_arrow,
    noted_paths,
    packed,
    removed,
    sliced,
    stored,
    unpacked,
)
from veilmark.llm.components import connected

WORDS, PERCENT = 4, 85
FREQUENT_WORDS = 100_000
LONG_LIST = 64
FREQUENT_TOKENS = 1 << 19
COUNTED_TOGETHER = 1 << 20
BITS_PER_ID, MOST_BITS = 16, 1 << 22
CHUNK_TOKENS, CHUNK_TEXTS = 1 << 17, 512
STRIP = 4096
# A token is a long: RARITY_BITS of how common it may be, then a hash.
RARITY_BITS = 5
MOST_COMMON = 2**RARITY_BITS - 1  # tokens known to have a long list
NONE_FREQUENT = np.empty(0, np.uint64)


def _mixed(z: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose values look random."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def tokens_of(
    texts: list[list[bytes]],
    n: int,
    rarity: dict[bytes, int],
    frequent: np.ndarray = NONE_FREQUENT,
) -> list[np.ndarray]:
    """Distinct tokens of each text, ascending.

    The leading bits are the measure of the rarest word, which no shingle can
    exceed, or MOST_COMMON for the tokens in ``frequent`` (ascending), so
    ascending order is from rare to common. With fewer than ``n`` words the
    whole sequence is one token; no words, no tokens.
    """
    flat = list(chain.from_iterable(texts))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, flat), np.uint64, len(flat))
    common = np.fromiter(map(rarity.get, flat, repeat(0)), np.uint64, len(flat))
    starts = np.cumsum([0, *map(len, texts)]).tolist()
    whole = _shingles(hashes, common, n) if len(flat) >= n else hashes[:0]
    whole = _put_last(whole, frequent)
    out = []
    for start, end in zip(starts, starts[1:], strict=False):
        if end - start >= n:
            token = np.sort(whole[start : end - n + 1])
            token = token[np.append(True, token[1:] != token[:-1])]
        else:
            token = _shingles(hashes[start:end], common[start:end], end - start)
            token = _put_last(token, frequent)
        out.append(token)
    return out


def _shingles(hashes: np.ndarray, common: np.ndarray, width: int) -> np.ndarray:
    """The token of every ``width`` words in a row."""
    if not width:
        return hashes[:0]
    m = len(hashes) - width + 1
    token = np.full(m, width, np.uint64)
    least = common[:m].copy()
    for k in range(width):
        token = _mixed(token * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + m])
        np.minimum(least, common[k : k + m], out=least)
    return (token >> np.uint64(RARITY_BITS)) | (least << np.uint64(64 - RARITY_BITS))


def _put_last(token: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The tokens, those in ``frequent`` with the measure MOST_COMMON."""
    if not len(frequent) or not len(token):
        return token
    place = np.minimum(np.searchsorted(frequent, token), len(frequent) - 1)
    last = np.uint64(MOST_COMMON << (64 - RARITY_BITS))
    return np.where(frequent[place] == token, token | last, token)


def prefix_length(size: int, percent: int) -> int:
    return size + 1 - -(-percent * size // 100)


def can_link(size: int, percent: int) -> bool:
    """Whether another set than this can be similar enough: at best one token more."""
    return 100 * size >= percent * (size + 1)


def prefixes(token: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """The prefix under each order, ascending.

    The first order is from rare to common, by the tokens' own value. The
    second is by fewer steps of rarity and another hash, the third only puts
    tokens of frequent words alone behind the others, and those of long lists last.
    """
    p = prefix_length(len(token), percent)
    measure = token >> np.uint64(64 - RARITY_BITS)
    orders = [token[:p]]
    last = measure == MOST_COMMON
    coarse = (measure >> np.uint64(2)) + last
    for salt, steps in ((0xD1B54A32D192ED03, coarse), (0x8CB92BA72F3D8DD7, (measure > 0) + 1 * last)):
        shuffled = _mixed(token ^ np.uint64(salt))
        first = np.lexsort((shuffled, steps))[:p]
        orders.append(np.sort(token[first]))
    return tuple(orders)


def _longs(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.uint64), *rows]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _key(token: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(token.tobytes())


def _counted_tokens(found: list[np.ndarray]) -> pa.RecordBatch:
    token, times = np.unique(np.concatenate(found), return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(token.view(np.int64)), pa.array(times)], ["word", "n"]
    )


def _count_prefixes(
    batches: Iterator[pa.RecordBatch], n: int, percent: int, rarity: dict[bytes, int]
) -> Iterator[pa.RecordBatch]:
    """Tokens of the prefixes and their number."""
    found, held = [], 0
    for batch in sliced(batches):
        for token in tokens_of(words_of_batch(batch), n, rarity):
            if can_link(len(token), percent):
                found.append(token[: prefix_length(len(token), percent)])
                held += len(found[-1])
        if held > COUNTED_TOGETHER:
            yield _counted_tokens(found)
            found, held = [], 0
    if found:
        yield _counted_tokens(found)


def _frequent_tokens(
    rows: DataFrame, n: int, percent: int, rarity: dict[bytes, int]
) -> np.ndarray:
    """Tokens of long lists, at most FREQUENT_TOKENS: those of the longest."""
    counter = partial(_count_prefixes, n=n, percent=percent, rarity=rarity)
    counts = map_arrow(rows.select("text"), counter, "word long, n long").groupBy("word")
    counts = counts.agg(F.sum("n").alias("n")).where(F.col("n") > LONG_LIST)
    counts = stored(counts, "ngram-lists")
    top = counts.where(F.col("n") >= frequent_from(counts, FREQUENT_TOKENS)).select("word")
    words = top.toArrow().column(0).to_numpy()
    return np.sort(np.ascontiguousarray(words, np.int64).view(np.uint64))


def _index(
    batches: Iterator[pa.RecordBatch],
    n: int,
    percent: int,
    rarity: dict[bytes, int],
    frequent: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Size, key, indexed prefix and the last token of that, of each set."""
    for batch in sliced(batches):
        sizes, keys, firsts, edges = [], [], [], []
        for token in tokens_of(words_of_batch(batch), n, rarity, frequent):
            sizes.append(len(token))
            keys.append(_key(token))
            linkable = can_link(len(token), percent)
            firsts.append(token[: prefix_length(len(token), percent) if linkable else 0])
            # With the first bit turned, signed longs are in the tokens' order.
            edges.append(int(firsts[-1][-1]) - (1 << 63) if linkable else None)
        same = [batch.column(batch.schema.get_field_index(c)) for c in ("row", "doc_id", "content")]
        yield pa.RecordBatch.from_arrays(
            [
                *same,
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                _longs(firsts),
                pa.array(edges, pa.int64()),
            ],
            ["row", "doc_id", "content", "size", "key", "prefix", "edge"],
        )


def _sets(
    batches: Iterator[pa.RecordBatch], n: int, rarity: dict[bytes, int], frequent: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The whole set of each text, where its key is the wanted one."""
    for batch in sliced(batches):
        take, tokens = [], []
        wanted = batch.column(batch.schema.get_field_index("key")).to_pylist()
        for i, token in enumerate(tokens_of(words_of_batch(batch), n, rarity, frequent)):
            if _key(token) == wanted[i]:
                take.append(i)
                tokens.append(token)
        rep = batch.column(batch.schema.get_field_index("rep")).take(pa.array(take, pa.int64()))
        copies = batch.column(batch.schema.get_field_index("copies")).take(
            pa.array(take, pa.int64())
        )
        yield pa.RecordBatch.from_arrays(
            [rep, copies, _longs(tokens)],
            ["rep", "copies", "tokens"],
        )


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], same: bool) -> np.ndarray:
    """Sizes of all intersections, as a product of 0/1 matrices strip by strip.

    For a chunk with itself, tokens of one set alone are left out; the sizes of
    a set with itself are not asked for.
    """
    one, times = np.unique(np.concatenate(left), return_counts=True)
    if same:
        shared = one[times > 1]
    else:
        shared = np.intersect1d(one, np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(shared), STRIP):
        strip = shared[at : at + STRIP]
        sides = []
        for rows in (left, right):
            m = np.zeros((len(rows), len(strip)), np.float32)
            for i, row in enumerate(rows):
                within = row[np.searchsorted(row, strip[0]) : np.searchsorted(row, strip[-1], "right")]
                place = np.searchsorted(strip, within)
                hit = strip[np.minimum(place, len(strip) - 1)] == within
                m[i, place[hit]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _linked(left: pa.Table, right: pa.Table, same: bool, percent: int) -> np.ndarray:
    """Which rows of two chunks are similar enough; filters first, then the sets."""

    def lists(table: pa.Table, column: str) -> list[np.ndarray]:
        # Unsigned, as they were sorted.
        values = table.column(column).combine_chunks()
        return [v.values.to_numpy().view(np.uint64) for v in values]

    sets = [lists(t, "tokens") for t in (left, right)]
    orders = [[prefixes(row, percent) for row in rows] for rows in sets]
    sizes = [np.array([len(row) for row in rows]) for rows in sets]
    small = np.minimum(sizes[0][:, None], sizes[1][None, :])
    large = np.maximum(sizes[0][:, None], sizes[1][None, :])
    candidate = 100 * small >= percent * large
    if same:
        candidate &= np.tri(len(sizes[0]), len(sizes[1]), -1, dtype=bool)
    for k in range(3):
        if candidate.any():
            candidate &= _overlaps(*[[row[k] for row in rows] for rows in orders], same) > 0
    rows, columns = np.flatnonzero(candidate.any(1)), np.flatnonzero(candidate.any(0))
    if not len(rows):
        return candidate
    both = _overlaps([sets[0][i] for i in rows], [sets[1][j] for j in columns], False)
    union = sizes[0][rows][:, None] + sizes[1][columns][None, :] - both
    similar = np.zeros_like(candidate)
    similar[np.ix_(rows, columns)] = 100 * both >= percent * union
    return candidate & similar


LINKS = "u long, v long, links_u long, links_v long"


def _links_table(u, v, links_u, links_v) -> pa.Table:
    return pa.table(
        {
            "u": pa.array(u, pa.int64()),
            "v": pa.array(v, pa.int64()),
            "links_u": pa.array(links_u, pa.int64()),
            "links_v": pa.array(links_v, pa.int64()),
        }
    )


def block_links(left: pa.Table, right: pa.Table, same: bool, percent: int) -> pa.Table:
    """Links between two chunks: a forest that joins all that are linked, and counts.

    A row (u, u) carries how many rows u is linked to in this pair of chunks.
    """
    linked = _linked(left, right, same, percent)
    ids = [t.column("rep").to_numpy() for t in (left, right)]
    copies = [t.column("copies").to_numpy() for t in (left, right)]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    u, v = [], []
    for i in np.flatnonzero(linked.any(1)).tolist():
        for j in np.flatnonzero(linked[i]).tolist():
            a, b = root(int(ids[0][i])), root(int(ids[1][j]))
            if a != b:
                parent[a] = b
                u.append(int(ids[0][i]))
                v.append(int(ids[1][j]))
    forest = len(u)
    number: dict[int, int] = {}
    for rows, others, hits in ((0, 1, linked), (1, 0, linked.T)):
        sums = hits.astype(np.int64) @ copies[others]
        for i in np.flatnonzero(sums).tolist():
            key = int(ids[rows][i])
            number[key] = number.get(key, 0) + int(sums[i])
    links = [0] * forest + list(number.values())
    return _links_table(
        u + list(number), v + list(number), links, [0] * (forest + len(number))
    )


def _rarity(rows: DataFrame) -> dict[bytes, int]:
    """Binary logarithm of the count of the most frequent words, at least 1."""
    counts = stored(word_counts(rows).where("word IS NOT NULL AND n > 1"), "ngram-words")
    top = counts.where(F.col("n") >= frequent_from(counts, FREQUENT_WORDS)).collect()
    return {bytes(r["word"]): min(MOST_COMMON - 1, int(r["n"]).bit_length()) for r in top}


def _chunks(shared: DataFrame) -> DataFrame:
    """Texts of long lists, dealt into chunks of bounded size by their longest list."""
    hot = (
        shared.where(F.col("n_list") > LONG_LIST)
        .groupBy("rep", "size")
        .agg(F.max(F.struct("n_list", "token"))["token"].alias("home"))
    )
    homes = hot.groupBy(F.col("home").alias("h")).agg(
        F.sum("size").alias("tokens"), F.count("*").alias("texts")
    )
    folds = F.greatest(
        F.ceil(F.col("tokens") / CHUNK_TOKENS), F.ceil(F.col("texts") / CHUNK_TEXTS), F.lit(1)
    )
    dealt = hot.join(homes.withColumn("folds", folds), F.col("home") == F.col("h"))
    chunk = F.xxhash64("home", F.pmod(F.xxhash64("rep"), F.col("folds")))
    return dealt.select(F.col("rep").alias("hot_rep"), "home", chunk.alias("chunk"))


def _blocks(shared: DataFrame, chunked: DataFrame) -> DataFrame:
    """Pairs of chunks with a long list in common, c <= d."""
    in_lists = (
        shared.where(F.col("n_list") > LONG_LIST)
        .join(chunked, F.col("rep") == F.col("hot_rep"))
        .select("token", "chunk")
        .distinct()
    )
    other = in_lists.select(F.col("token").alias("t"), F.col("chunk").alias("d"))
    return (
        in_lists.join(other, (F.col("token") == F.col("t")) & (F.col("chunk") <= F.col("d")))
        .select(F.col("chunk").alias("c"), "d")
        .distinct()
    )


def _cold_pairs(shared: DataFrame, chunked: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """Candidates of short lists that are in no pair of chunks.

    Such texts share no long list. Up to the end of the prefix that ends first,
    the tokens that two sets share are those that their prefixes share, and
    these lists hold them all; so with what is left of that set they bound the
    whole intersection.
    """
    marked = shared.where(F.col("n_list") <= LONG_LIST).join(
        chunked, F.col("rep") == F.col("hot_rep"), "left"
    )
    names = ("rep", "size", "edge", "home", "chunk")
    a = marked.select("token", *[F.col(c).alias("a_" + c) for c in names])
    b = marked.select(F.col("token").alias("b_token"), *[F.col(c).alias("b_" + c) for c in names])
    pairs = a.join(
        b,
        (F.col("token") == F.col("b_token"))
        & (F.struct("a_size", "a_rep") < F.struct("b_size", "b_rep"))
        & (F.col("a_size") * 100 >= F.col("b_size") * percent)
        & F.coalesce(F.col("a_home") != F.col("b_home"), F.lit(True)),
    )
    sides = [f"{s}_{c}" for s in "ab" for c in ("rep", "size", "edge", "chunk")]
    counted = pairs.groupBy(*sides).agg(F.count("*").alias("n_shared"))
    first = F.when(F.col("a_edge") <= F.col("b_edge"), F.col("a_size")).otherwise(F.col("b_size"))
    rest = F.floor((first * percent + 99) / 100) - 1
    possible = (F.col("n_shared") + rest) * (100 + percent)
    enough = possible >= (F.col("a_size") + F.col("b_size")) * percent
    in_block = (F.least("a_chunk", "b_chunk") == F.col("c")) & (
        F.greatest("a_chunk", "b_chunk") == F.col("d")
    )
    # NULL chunks are ignored by least and greatest, so ask for both.
    both_hot = F.col("a_chunk").isNotNull() & F.col("b_chunk").isNotNull()
    return (
        counted.where(enough)
        .join(blocks, in_block & both_hot, "left_anti")
        .select(F.col("a_rep").alias("u"), F.col("b_rep").alias("v"))
    )


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs that share tokens of the other orders' prefixes and are similar enough."""
    for batch in batches:
        lists = [
            batch.column(batch.schema.get_field_index(c)) for c in ("u_tokens", "v_tokens")
        ]
        take = []
        for i in range(batch.num_rows):
            pair = [v[i].values.to_numpy().view(np.uint64) for v in lists]
            one, two = (prefixes(token, percent)[1:] for token in pair)
            if all(len(np.intersect1d(*p, assume_unique=True)) for p in zip(one, two, strict=True)):
                both = len(np.intersect1d(*pair, assume_unique=True))
                if 100 * both >= percent * (len(pair[0]) + len(pair[1]) - both):
                    take.append(i)
        names = ("u", "v", "v_copies", "u_copies")
        kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
        rows = pa.array(take, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [c.take(rows) for c in kept], ["u", "v", "links_u", "links_v"]
        )


def _cold_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidates that pass the other orders' filters and are similar enough.

    Only the sets travel; the prefixes under the other orders follow from them.
    """
    names = ("rep", "copies", "tokens")
    one = sets.select(*[F.col(c).alias("u_" + c) for c in names])
    two = sets.select(*[F.col(c).alias("v_" + c) for c in names])
    joined = pairs.join(one, F.col("u") == F.col("u_rep")).join(two, F.col("v") == F.col("v_rep"))
    whole = joined.select("u", "v", "u_copies", "v_copies", "u_tokens", "v_tokens")
    # Rows that repeat give their set more than once.
    return map_arrow(whole, partial(_verified, percent=percent), LINKS).distinct()


def _hot_links(sets: DataFrame, chunked: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """Links between texts of long lists, chunk against chunk."""
    rows = sets.join(chunked, F.col("rep") == F.col("hot_rep")).select(
        "chunk", "rep", "copies", "tokens"
    )
    sides = [
        blocks.join(rows, F.col("c") == F.col("chunk")).withColumn("side", F.lit(0)),
        blocks.where("c <> d").join(rows, F.col("d") == F.col("chunk")).withColumn("side", F.lit(1)),
    ]

    def compare(block: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        block = block.sort_by("rep")
        # Rows that repeat give their set more than once.
        ids, sides = block.column("rep").to_numpy(), block.column("side").to_numpy()
        _, first = np.unique(ids * 2 + sides, return_index=True)
        block = block.take(pa.array(first))
        left = block.filter(pc.equal(block.column("side"), 0))
        right = block.filter(pc.equal(block.column("side"), 1))
        same = right.num_rows == 0 and block.column("c")[0] == block.column("d")[0]
        return block_links(left, left if same else right, same, percent)

    importable(sets.sparkSession)
    return sides[0].union(sides[1]).groupBy("c", "d").applyInArrow(compare, LINKS)


def may_be_in(ids: DataFrame, column: str, n_ids: int) -> Callable[[Column], Column]:
    """A test that is true for every id of a table and for few others.

    A bitmap of at most MOST_BITS hash bits, however many ids there are; a
    table that outgrows it is only filtered less.
    """
    bits = min(MOST_BITS, max(1 << 10, 1 << (BITS_PER_ID * n_ids).bit_length()))

    def slot(value: Column) -> Column:
        return F.xxhash64(value.cast("string")).bitwiseAND(F.lit(bits - 1).cast("long"))

    def in_word(value: Column) -> Column:
        return slot(value).bitwiseAND(F.lit(31).cast("long")).cast("int")

    words = (
        ids.groupBy(F.shiftright(slot(F.col(column)), 5).alias("w"))
        .agg(F.bit_or(F.call_function("shiftleft", F.expr("1L"), in_word(F.col(column)))).alias("b"))
        .collect()
    )
    bitmap = [0] * (bits // 32)
    for w, b in words:
        bitmap[w] = b
    known = F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")

    def test(value: Column) -> Column:
        word = F.get(known, F.shiftright(slot(value), 5).cast("int"))
        return F.call_function("shiftright", word, in_word(value)).bitwiseAND(
            F.lit(1).cast("long")
        ) == 1

    return test


def _firsts(index: DataFrame, classes: DataFrame) -> DataFrame:
    """The row of the index that stands for each class, with its prefix.

    Only rows that may be one of the other copies, by a bitmap of these, are
    looked up; the rest of the index does not move.
    """
    sets = index.where("size > 0")
    several = classes.where("copies > 1").select(F.col("key").alias("k"), "rep")
    others = sets.select("key", "row").join(several, F.col("key") == F.col("k"))
    others = stored(others.where("row <> rep").select("row"), "ngram-copies")
    asked = may_be_in(others, "row", others.count())(F.col("row"))
    cleared = sets.where(asked).join(others, "row", "left_anti").select(*sets.columns)
    return stored(sets.where(~asked).union(cleared), "ngram-firsts")


def joined(
    docs: DataFrame, n: int = WORDS, percent: int = PERCENT, row: str | None = None
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id``, ``n_links``, ``row``, ``group``.

    ``n_links`` counts the other rows with a similarity of at least ``percent``
    hundredths, ``component_id`` is the least doc_id reachable by links, and
    ``group`` is the least ``row`` number of a component's classes. ``row`` may
    name a column of unique longs; else rows are numbered. NULL, empty and blank texts have no
    shingles, no links and their own doc_id. Rows that repeat, also their
    doc_id, are linked as copies; NULL ids are left out of the least doc_id if
    the component has others. An empty table gives no rows.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    content = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    numbered = docs.select("doc_id", "text", number.alias("row"), content.alias("content"))
    rarity = _rarity(docs)
    frequent = _frequent_tokens(docs, n, percent, rarity)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # Stored: the row numbers must stay what they are.
    index = stored(
        map_arrow(
            numbered,
            partial(_index, n=n, percent=percent, rarity=rarity, frequent=frequent),
            f"row long, doc_id {id_type}, content long, size long, key binary,"
            " prefix array<bigint>, edge long",
        ),
        "ngram-index",
    )
    classes = stored(
        index.where("size > 0")
        .groupBy("key")
        .agg(
            F.min("row").alias("rep"),
            F.min("doc_id").alias("least_doc"),
            F.count("*").alias("copies"),
        ),
        "ngram-classes",
    )
    firsts = _firsts(index, classes)
    postings = firsts.select(
        F.explode("prefix").alias("token"), F.col("row").alias("rep"), "size", "edge"
    )
    lists = postings.groupBy(F.col("token").alias("t")).agg(F.count("*").alias("n_list"))
    shared = stored(
        postings.join(lists.where("n_list > 1"), F.col("token") == F.col("t")).drop("t"),
        "ngram-shared",
    )
    chunked = stored(_chunks(shared), "ngram-chunks")
    blocks = stored(_blocks(shared, chunked), "ngram-blocks")
    pairs = stored(_cold_pairs(shared, chunked, blocks, percent), "ngram-pairs")
    candidates = (
        chunked.select(F.col("hot_rep").alias("rep"))
        .union(pairs.select(F.col("u").alias("rep")))
        .union(pairs.select(F.col("v").alias("rep")))
        .distinct()
    )
    candidates = candidates.join(classes.select("rep", "copies"), "rep")
    wanted = firsts.join(candidates, F.col("row") == F.col("rep")).select(
        F.col("doc_id").alias("id"), F.col("content").alias("c"), "rep", "key", "copies"
    )
    wanted = stored(wanted, "ngram-wanted")
    n_wanted = wanted.count()
    # Ids may repeat, NULL above all, so a text is found by its id and its content.
    asked = may_be_in(wanted, "c", n_wanted)
    texts = numbered.select("doc_id", "text", "content").where(asked(F.col("content")))
    same_row = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("c"))
    texts = texts.join(wanted, same_row)
    sets = stored(
        map_arrow(
            texts.select("text", "rep", "key", "copies"),
            partial(_sets, n=n, rarity=rarity, frequent=frequent),
            "rep long, copies long, tokens array<bigint>",
        ),
        "ngram-sets",
    )
    if sets.count() > n_wanted:  # rows that repeat id and text
        sets = stored(sets.dropDuplicates(["rep"]), "ngram-sets")
    links = stored(
        _cold_links(pairs, sets, percent).union(_hot_links(sets, chunked, blocks, percent)),
        "ngram-links",
    )
    labels = connected(links.select("u", "v"))
    ends = links.select(F.col("u").alias("node"), F.col("links_u").alias("links")).union(
        links.select(F.col("v").alias("node"), F.col("links_v").alias("links"))
    )
    per_class = ends.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = classes.join(labels, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "least_doc", "copies", F.coalesce("label", "rep").alias("label")
    )
    least = grouped.groupBy(F.col("label").alias("l")).agg(F.min("least_doc").alias("component"))
    # Only classes with more than one text have something to tell their rows.
    told = (
        grouped.join(least, F.col("label") == F.col("l"))
        .join(per_class, F.col("rep") == F.col("node"), "left")
        .select(
            "key",
            F.col("label").alias("group"),
            "component",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
        .where("n_links > 0")
    )
    told = stored(told, "ngram-told").withColumnRenamed("key", "k")
    return index.join(told, F.col("key") == F.col("k"), "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "row",
        F.coalesce("group", "row").alias("group"),
    )


def one_of_each(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows without links, and of each component the one of the least doc_id.

    Ties go to the first row; NULL ids come last. All columns are kept, whatever
    their names. The join's own tables, larger than its result, are deleted once
    that is stored; only the rows and their links are read later.
    """
    numbered = packed(docs).withColumn("row", F.monotonically_increasing_id())
    numbered = stored(numbered, "numbered")
    own = [F.col(PACKED)[c].alias(c) for c in ("doc_id", "text")]
    texts = numbered.select(*own, "row")
    with noted_paths() as own_tables:
        linked = joined(texts, n, percent, "row").where("n_links > 0")
    linked = stored(linked.select("doc_id", "row", "group"), "linked")
    removed(docs.sparkSession, own_tables)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    keepers = linked.groupBy("group").agg(F.min(order)["row"].alias("keeper"))
    losers = linked.join(keepers, F.col("row") == F.col("keeper"), "left_anti")
    kept = numbered.join(losers.select("row"), "row", "left_anti")
    return kept.select(*unpacked(kept))


def document_components(docs: DataFrame) -> DataFrame:
    return joined(docs).select("doc_id", "n_shingles", "component_id", "n_links")
