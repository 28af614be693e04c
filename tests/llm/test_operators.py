"""Each operator against brute force, and on rows that are easily got wrong."""

import collections
import hashlib
import itertools
import math
import re
import struct
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import tiktoken  # noqa: F401
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from veilmark.llm import (
    byte_bpe,
    char_crf,
    class_lm,
    common,
    components,
    mixing,
    ngram_join,
    order_minhash,
    ordinal_toxicity,
    pii,
    quality,
    sharding,
    token_store,
)
from veilmark.llm.common import documents
from veilmark.llm.queries import registered

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, `Shard` string, ids int, pii int"
LONG = " ".join(f"w{i % 3000}" for i in range(30_000))
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \t\n", "en", "s", 3),
    (4, "one", "en", "s", 3),
    (5, "one", "en", None, 3),
    (5, "one", "en", None, 3),
    (6, LONG, "en", "s", len(LONG)),
    (7, LONG + " more", "en", "s", len(LONG) + 5),
    (8, "a b c a b c a b c", "en", "s", 17),
    (None, "mail x.y@z.org or 10.0.0.1 now", "en", "s", 30),
    (9, "Ünïcödé ’s \U0001f44d́ Å\n\nÅ", None, "s", 20),
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return documents(spark, sf_dir)


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    rows = {r["doc_id"]: r for r in df.collect()}
    assert len(rows) == df.count()
    return rows


def components_by_force(rows, n, percent):
    """Size, least id of the component and links of each (id, text)."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        shingles = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        sets.append(shingles or ({tuple(words)} if words else set()))
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    least = [min((d for d in groups[root(i)] if d is not None), default=None) for i in range(len(rows))]
    return sorted(
        zip([r[0] for r in rows], map(len, sets), least, links, strict=True), key=repr
    )


def test_ngram_join(docs, texts):
    got = sorted(map(tuple, ngram_join.document_components(docs).collect()), key=repr)
    assert got == components_by_force(list(texts.items()), 4, 85)


def near_copies(spark, n):
    """One large group of near copies, so that lists are long and chunks are many."""
    rng = np.random.default_rng(4)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for k in rng.permutation(120)[: rng.integers(0, 6)]:
            words[k] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(n + i, f"{' '.join(base[:60])} own{i} " + " ".join(f"y{i}_{k}" for k in range(70))) for i in range(90)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_ngram_join_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_LIST", 8)
    monkeypatch.setattr(ngram_join, "CHUNK_TEXTS", 40)
    df, rows = near_copies(spark, 220)
    got = sorted(map(tuple, ngram_join.document_components(df).collect()), key=repr)
    assert got == components_by_force(rows, 4, 85)


def test_ngram_join_looks_up_few_rows_for_their_class(spark, monkeypatch):
    rows = [(i, f"one{i} two{i} three{i} four{i} five{i}") for i in range(600)]
    rows += [(600 + i, rows[i % 7][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept, tests, make = {}, {}, ngram_join.may_be_in

    def keep(frame, label):
        kept[label] = real(frame, label)
        return kept[label]

    def told(ids, column, n_ids):
        tests[column] = make(ids, column, n_ids)
        return tests[column]

    real = ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", keep)
    monkeypatch.setattr(ngram_join, "may_be_in", told)
    got = sorted(map(tuple, ngram_join.document_components(df).collect()), key=repr)
    assert got == components_by_force(rows, 4, 85)
    moved = kept["ngram-index"].where(tests["row"](F.col("row"))).count()
    assert 20 <= moved < 100 and kept["ngram-firsts"].count() == 600
    # A bitmap that is full clears nothing, and the lookup decides.
    monkeypatch.setattr(ngram_join, "may_be_in", lambda *_: lambda value: value.isNotNull())
    got = sorted(map(tuple, ngram_join.document_components(df).collect()), key=repr)
    assert got == components_by_force(rows, 4, 85)


def test_ngram_join_of_odd_rows(odd, empty):
    got = sorted(map(tuple, ngram_join.document_components(odd).collect()), key=repr)
    assert got == components_by_force([r[:2] for r in ODD], 4, 85)
    assert ngram_join.document_components(empty).count() == 0


def test_prefix_orders_and_blocks_agree_with_sets():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**64, 200, dtype=np.uint64)
    rows = []
    for _ in range(40):
        row = base.copy()
        k = rng.integers(0, 25)
        row[rng.permutation(200)[:k]] = rng.integers(0, 2**64, k, dtype=np.uint64)
        rows.append(np.unique(row))
    import pyarrow as pa

    table = pa.table(
        {"rep": list(range(40)), "copies": [1] * 40, "tokens": ngram_join._longs(rows)}
    )
    got = ngram_join._linked(table, table, True, 85)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (100 * both >= 85 * (len(a) + len(b) - both))


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [tuple(map(int, p)) for p in rng.integers(0, 300, (180, 2))] + [(500, 501 + i) for i in range(50)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    want = {x: root(x) for p in pairs for x in p if p[0] != p[1]}
    got = components.connected(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {r["node"]: r["label"] for r in got} == want and len(got) == len(want)
    assert components.connected(spark.createDataFrame([], "u long, v long")).count() == 0


def token_rows(rows):
    tokenizer = Tokenizer.from_file(token_store.default_vocabulary())
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_store(docs, texts):
    got = sorted(map(tuple, token_store.stored_tokens(docs).collect()))
    assert got == list(token_rows(texts.items()))


def test_token_store_takes_no_text_back(docs, monkeypatch, tmp_path):
    shown = []
    store = token_store.stored
    monkeypatch.setattr(token_store, "stored", lambda df, name: shown.append(plan(df)) or store(df, name))
    token_store.write_tokens(docs, str(tmp_path / "t"))
    (given,) = re.findall(r"MapInArrow .*, \[([^\]]*)\]", shown[0])
    assert re.findall(r"(\w+)#", given) == ["doc_id", "n_tokens", "frame"]


def test_token_store_of_odd_rows(odd, empty):
    rows = [*map(tuple, token_store.stored_tokens(odd).collect())]
    assert sorted(rows, key=lambda r: r[1]) == list(token_rows([r[:2] for r in ODD]))
    assert token_store.stored_tokens(empty).count() == 0


def test_encoder_takes_odd_texts_as_the_library_does():
    texts = [
        "<|STARTOFTEXT|> a<|endoftext|>b. <|EndOfText|>,c",
        "H\u0331T\u0308 h\u0331 e\u0301. E\u0301!",
        "It's CAN'T 'S a.'s a,b.c 3.14 %%% x%%%, &&y&&\x01 \x01 \u4e2d\u6587. \u0130x \u00df.",
        "",
    ]
    words = token_store.WordEncoder(token_store.default_vocabulary())
    wanted = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        got = words.ids([t.encode() for t in texts], None)
        assert [np.frombuffer(g, words.dtype).tolist() for g in got] == wanted


def test_encoder_keeps_a_word_once_for_all_cases_and_marks():
    words = token_store.WordEncoder(token_store.default_vocabulary())
    words.ids([b"Word word, WORD. wOrd", b"word%"], None)
    assert set(words.known) == {b"", b"word", b",", b".", b"%"}


def test_positions_move_records_once(spark):
    records = spark.range(5000).select("id", F.lit(3).cast("long").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lined, _ = sharding.positions(
            records, "id", "n", "id", ("id",), split_hot=False, in_order=True
        )
        plan = lined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and plan.count("rangepartitioning(_range") == 1


def test_ordered_positions_bound_what_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 10)
    records = spark.range(4000).select("id", F.lit(3).cast("long").alias("n"))
    lined, _ = sharding.positions(records, "id", "n", "id", ("id",), split_hot=False, in_order=True)
    held = lined.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("rows"), F.min("_row").alias("low"), F.max("_row").alias("high")
    )
    held = held.orderBy("p").collect()
    assert 20 <= len(held) <= 25 and max(r["rows"] for r in held) <= 2 * 160
    assert all(a["high"] + 1 == b["low"] for a, b in itertools.pairwise(held))


def test_token_store_holds_few_texts_and_words_at_once(docs, monkeypatch, tmp_path):
    spark, sent = docs.sparkSession, []
    store, before = token_store.stored, spark.conf.get(common.ARROW_BYTES)

    def noted(df, name):
        sent.append(int(spark.conf.get(common.ARROW_BYTES)))
        return store(df, name)

    monkeypatch.setattr(token_store, "stored", noted)
    token_store.write_tokens(docs, str(tmp_path / "t"))
    assert sent == [token_store.ENCODED_BYTES]
    assert spark.conf.get(common.ARROW_BYTES) == before
    # A worker that goes on to write packs has no words left.
    token_store.encoder(token_store.default_vocabulary()).ids([b"word"], None)
    assert list(token_store._packs(iter([]), "", 2)) == []
    assert token_store.encoder.cache_info().currsize == 0


def test_token_store_reads_one_document(spark, docs, texts, tmp_path):
    token_store.write_tokens(docs, str(tmp_path / "t"))
    (row,) = token_store.read_tokens(spark, str(tmp_path / "t"), 77).collect()
    tokenizer = Tokenizer.from_file(token_store.default_vocabulary())
    ids = [*tokenizer.encode(texts[77], add_special_tokens=False).ids, 1]
    assert np.frombuffer(row["ids"], "<u4").tolist() == ids


def test_sharding(docs, texts, odd, empty):
    rows = by_id(sharding.sharded_documents(docs))
    for doc_id, row in rows.items():
        raw = texts[doc_id].encode()
        assert (row["size"], row["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert (row["law"], row["grown_shard"]) == ("bytes", None)
    shards = collections.defaultdict(list)
    for row in rows.values():
        shards[row["shard"]].append(row)
    assert set(shards) <= set(range(24))
    for members in shards.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    sizes = [sum(r["size"] for r in m) for m in shards.values()]
    most = max(r["size"] for r in rows.values())
    assert max(sizes) - min(sizes) <= 2 * most
    got = sharding.sharded_documents(odd).collect()
    assert len(got) == len(ODD) and {r["size"] for r in got if r["doc_id"] == 1} == {8}
    assert sharding.sharded_documents(empty).count() == 0


def test_sharding_subdivides_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 50)
    df = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text"),
    )
    rows = sharding.sharded_documents(df).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(rows) == 2000 and max(sizes.values()) - min(sizes.values()) <= 2 * 72


def quality_by_force(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_rules(spark, sf_dir, docs, texts):
    rows = by_id(quality.document_quality(docs))
    for doc_id, r in rows.items():
        want = quality_by_force(texts[doc_id])
        assert tuple(r[c] for c in quality.BASE) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    passed = [r for r in labels if r["doc_id"] in rows and not rows[r["doc_id"]]["base_failed"]]
    right = sum(rows[r["doc_id"]]["kept"] == (r["quality"] == 1) for r in passed)
    assert right >= 0.95 * len(passed)


def test_quality_of_odd_rows(odd, empty):
    rows = quality.document_quality(odd).collect()
    got = sorted((tuple(r[c] for c in quality.BASE) for r in rows))
    assert got == sorted(quality_by_force(r[1]) for r in ODD)
    assert quality.document_quality(empty).count() == 0


def test_sketch_quartiles_are_close(spark):
    df = spark.range(1000).select(F.lit("en").alias("lang"), F.lit("s").alias("source"), F.col("id"))
    counts = df.groupBy(
        F.lit("=en").alias("lang"), F.lit("=s").alias("source"), F.lit("word_length").alias("metric"),
        quality._bucket(F.col("id") * 10).alias("bucket"),
    ).agg(F.count("*").alias("n"))
    fences = quality.thresholds(counts).first()["_t"]["word_length"]
    spread = 3 * 5000
    assert abs(fences["low"] - (2490 - spread)) <= 4 * 7500 / 64
    assert abs(fences["high"] - (7490 + spread)) <= 4 * 7500 / 64


def test_class_lm(docs, texts):
    rows = by_id(class_lm.scored(docs))
    split = {d: [*t.encode().lower().split(), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    count = collections.Counter(w for d, words in split.items() if not held[d] for w in words)
    n, v = sum(count.values()), len(count)
    for d, r in rows.items():
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in split[d])
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["n_known"]) == (len(split[d]), sum(count[w] > 0 for w in split[d]))
        assert (r["train_tokens"], r["held_out"]) == (n, held[d])
    out = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_class_lm_of_odd_rows(odd, empty):
    rows = class_lm.scored(odd).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r["score"]) for r in rows)
    assert class_lm.scored(empty).count() == 0


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(1)
    hidden = np.arange(40) % 4
    follow = rng.random((4, 4)) ** 4
    bigrams = rng.poisson(200 * follow[hidden][:, hidden] / follow.sum()).astype(float)

    def likelihood(place):
        member = np.eye(place.max() + 1)[place]
        table = member.T @ bigrams @ member
        x = class_lm._xlogx
        return x(table).sum() - x(table.sum(0)).sum() - x(table.sum(1)).sum()

    start = np.arange(40) % 5
    place = class_lm.exchange_clusters(bigrams, 40, 5)
    assert likelihood(place) > likelihood(start)


def test_best_class_by_force():
    rng = np.random.default_rng(2)
    bigrams = rng.poisson(3, (30, 30)).astype(float)
    place = np.concatenate((np.arange(26) % 5, [5, 6, 5, 6]))

    def table(p):
        member = np.eye(7)[p]
        return member.T @ bigrams @ member

    member = np.eye(7)[place]
    best = class_lm.best_classes(
        place, bigrams @ member, bigrams.T @ member, np.diag(bigrams), table(place), 5
    )
    for w in range(30):
        tried = [np.where(np.arange(30) == w, c, place) for c in range(5)]
        assert best[w] == np.argmax([class_lm.likelihood(table(p)) for p in tried])


def test_class_lm_clusters_every_word_that_is_not_rare(spark):
    rng = np.random.default_rng(3)
    # Two kinds of 600 words take turns; which kind a word is does not show in it.
    names = rng.permutation(1200)
    texts = [
        " ".join(f"w{names[2 * j + (i % 2)]}" for i, j in enumerate(rng.integers(0, 600, 100)))
        for _ in range(300)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    training = df.where(~class_lm.held_out("doc_id"))
    model, _ = class_lm.fit(training, class_lm.stored(class_lm.word_counts(training), "counts"))
    kind = {b"w%d" % name: i % 2 for i, name in enumerate(names)}
    members = collections.defaultdict(collections.Counter)
    for word, i in model.number.items():
        if i < model.n_clustered:
            members[model.place[i]][kind[word]] += 1
    assert sum(max(c.values()) for c in members.values()) > 0.95 * 1200
    out = [r for r in class_lm.scored(df).collect() if r["held_out"]]
    assert np.mean([r["perplexity"] for r in out]) < 900


def test_class_lm_looks_up_a_word_once_per_batch(monkeypatch):
    asked = []
    tail = class_lm.tail_class
    monkeypatch.setattr(class_lm, "tail_class", lambda w: asked.append(w) or tail(w))
    texts = ["the Rare  " * 50, None, " ", "rare\x0bthe", "\u00c9 \u00a0rare"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    (line,) = class_lm._lines(iter([batch]), {b"the": 0})
    end = 1 + class_lm.TAILS
    wanted = [end]
    for text in texts:
        words = (text or "").encode().lower().split()
        wanted += [0 if w == b"the" else 1 + tail(w) for w in words] + [end]
    assert line.tolist() == wanted
    assert len(asked) <= 4
    counts = collections.Counter()
    for counted in class_lm._count_words(iter([batch] * 3)):
        counts.update({r["word"]: r["n"] for r in counted.to_pylist()})
    wanted = collections.Counter(w for t in texts if t for w in t.encode().lower().split())
    assert counts == {w: 3 * n for w, n in wanted.items()} | {None: 15}


def test_toxicity(spark, sf_dir, docs, odd, empty):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ordinal_toxicity.fit(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    rows = by_id(ordinal_toxicity.document_toxicity(docs, labels))
    known = [(r["toxic"], rows[r["doc_id"]]) for r in labels.collect() if r["doc_id"] in rows]
    mean = [np.mean([r["severity"] for t, r in known if t == k]) for k in (0, 1)]
    assert mean[1] > mean[0] + 0.5
    for _, r in known:
        assert r["p_grade_1"] >= r["p_grade_2"] >= r["p_grade_3"]
        assert r["severity"] == pytest.approx(sum(r[f"p_grade_{k}"] for k in (1, 2, 3)))
    assert ordinal_toxicity.document_toxicity(odd, labels).count() == len(ODD)
    none = labels.limit(0)
    assert not any(r["toxic"] for r in ordinal_toxicity.document_toxicity(odd, none).collect())
    assert ordinal_toxicity.document_toxicity(empty, labels).count() == 0


def test_order_minhash(docs, texts):
    rows = by_id(order_minhash.fingerprinted(docs))
    order = sorted(texts)
    prints = collections.defaultdict(set)
    for d, after in zip(order, [*order[1:], order[0]], strict=True):
        text, cut = texts[d], len(texts[d]) // 4
        edited = text[: len(text) - cut] + texts[after][:cut]
        r = rows[d]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints[text].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    near = np.mean([r["near_edited"] for r in rows.values()])
    assert near > 0.25 > 0.05 > np.mean([r["near_next"] for r in rows.values()])


def test_order_minhash_sees_order_and_repetition(spark):
    words = [f"v{i}" for i in range(400)]
    half = " ".join(words[200:] + words[:200])
    df = spark.createDataFrame(
        [(1, " ".join(words)), (2, half), (3, " ".join(words[:390])), (4, " ".join(words * 2))],
        "id long, text string",
    )
    sketch = {r["id"]: r["s"] for r in order_minhash.with_sketch(df, "text", "s").collect()}
    like = lambda a, b: len(set(sketch[a]) & set(sketch[b])) / 32
    assert like(1, 3) > 0.8 and like(1, 2) < 0.8 and like(1, 4) < 0.5


def test_order_minhash_of_unspaced_text(spark):
    rng = np.random.default_rng(4)
    text, other = ("".join(map(chr, rng.integers(0x4E00, 0x9000, 4000))) for _ in "ab")
    changed = [text, "x" + text, text[:2000] + "x" + text[2000:], text[:2000] + text[2001:], other]
    df = spark.createDataFrame(list(enumerate(changed)), "id long, text string")
    sketch = {r["id"]: r["s"] for r in order_minhash.with_sketch(df, "text", "s").collect()}
    like = [len(set(sketch[0]) & set(sketch[i])) / 32 for i in range(5)]
    assert min(like[1:4]) > 0.8 and like[4] < 0.1
    words = spark.createDataFrame([("ab " + "c" * 32 + "\t" + "".join(map(chr, range(65, 98))),)], "t string")
    pieces = words.select(order_minhash._pieces(F.col("t")).alias("p")).first()["p"]
    assert pieces[:5] == ["ab", *["c" * 8] * 4]
    assert pieces[5:] == ["".join(map(chr, range(i, i + 8))) for i in range(65, 91)]


def test_order_minhash_of_odd_rows(odd, empty):
    rows = order_minhash.fingerprinted(odd).collect()
    assert len(rows) == len(ODD)
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2, 3)} == {""}
    assert order_minhash.fingerprinted(empty).count() == 0


@pytest.mark.parametrize("rows", ["docs", "odd"])
def test_byte_bpe(rows, request, spark):
    df = request.getfixturevalue(rows)
    encoder = byte_bpe.encoding(*byte_bpe.default_ranks())
    want = []
    for r in df.collect():
        raw = (r["text"] or "").encode()
        ids = encoder.encode_ordinary(r["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((r["doc_id"], len(ids), digest, hashlib.sha256(raw).hexdigest()))
    got = map(tuple, byte_bpe.document_tokens(df).collect())
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_byte_bpe_takes_one_python_worker(spark):
    rows = [(1, "a b", 7), (2, None, 7), (3, "", None), (4, "Stra\u00dfe \u20ac 12,5", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    apart = byte_bpe.decode(byte_bpe.encode(df))
    together = byte_bpe.round_trip(df)
    assert together.schema == apart.schema
    assert sorted(together.collect()) == sorted(apart.collect())
    docs = df.selectExpr("*", "'en' AS lang", "'web' AS source")
    for rows in (byte_bpe.document_tokens(df), corpus_pipeline.token_ids(spark, docs, "")):
        assert rows._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_byte_bpe_of_long_texts(empty):
    encoder = byte_bpe.encoding(*byte_bpe.default_ranks())
    for text in (
        "word 12ab's " * 20_000,
        "x" * 200_000,
        "a" + " " * 100_000 + "b　　c" * 9_000 + "\n" * 5_000,
        "²1Ⅷ9" * 50_000,
        "!\x1c!" * 40_000,
    ):
        assert byte_bpe.encode_text(text, encoder) == encoder.encode_ordinary(text)
    millions = "a" + " " * 2_000_000 + "b"
    assert encoder.decode(byte_bpe.encode_text(millions, encoder)) == millions
    assert byte_bpe.document_tokens(empty).count() == 0


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def rules_by_force(text):
    found = []
    for place, (kind, pattern) in enumerate(RULES.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            valid = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if valid:
                found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [f[2] for f in sorted(found)]


def test_pii_rules_by_force():
    rng = np.random.default_rng(1)
    for _ in range(5000):
        text = "".join(rng.choice(list("a1.@-+ 29("), rng.integers(0, 40)))
        assert pii.digest(pii.base_spans(text)) == ",".join(rules_by_force(text))


def test_pii(docs, texts, odd, empty):
    rows = by_id(pii.document_pii(docs))
    for d, r in rows.items():
        base = rules_by_force(texts[d])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(",")) | {""}
        for kind in RULES:
            assert r[f"n_{kind}"] == sum(b.startswith(kind) for b in base)
    assert pii.document_pii(odd).count() == len(ODD)
    hidden = {r["text"] for r in pii.redacted(odd).where("doc_id is null").collect()}
    assert hidden == {"mail [EMAIL] or [IP] now"}
    assert pii.document_pii(empty).count() == 0


def test_network_gradients():
    model = char_crf.CharCrf.start(5, 1)
    model.weights = {k: v.astype(float) for k, v in model.weights.items()}
    rng = np.random.default_rng(0)
    codes, tags = rng.integers(0, 98, (3, 7)), rng.integers(0, 5, (3, 7))

    def loss():
        scores, pairs, total = model.scores(codes), model.weights["pairs"], 0.0
        for r in range(3):
            reach, own = scores[r, 0].astype(float), scores[r, 0, tags[r, 0]]
            for t in range(1, 7):
                reach = char_crf._logsumexp(reach[:, None] + pairs, 0) + scores[r, t]
                own += pairs[tags[r, t - 1], tags[r, t]] + scores[r, t, tags[r, t]]
            total += char_crf._logsumexp(reach, 0) - own
        return total / 3

    for name, gradient in model.gradients(codes, tags).items():
        place = (codes[0, 0], 2) if name == "embed" else tuple(0 for _ in gradient.shape)
        weight, kept = model.weights[name], model.weights[name][place]
        weight[place] = kept + 1e-3
        up = loss()
        weight[place] = kept - 1e-3
        slope = (up - loss()) / 2e-3
        weight[place] = kept
        assert slope == pytest.approx(gradient[place], rel=0.02, abs=2e-4)


def test_network_learns_what_the_rules_mark(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        digits = "".join(map(str, rng.integers(0, 10, 7)))
        phone = f"+1 ({rng.integers(200, 999)}) 555-{digits[:4]}"
        rows.append((f"some words here then {phone} and more words, version 2.{i} follows at last",))
    model = pii.fit(spark.createDataFrame(rows, "text string"))
    text = "some words here then  1 (424) 555-6469 and more words, version 2.7 follows at last"
    assert pii.base_spans(text) == []
    assert pii.Tagger(model).spans([text]) == [[(22, 38, "phone")]]


@pytest.mark.parametrize("weights", [None, {"a": 5.0, "b": 3.0, None: 1.0}])
def test_mixing_stays_within_a_block(spark, weights):
    sizes = {"a": 900, "b": 400, "c": 37, None: 260}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(df, weights=weights, block_docs=4, period=50).collect()
    assert len(got) == len(rows)
    places = {(r["mix_slot"], r["mix_pos"]) for r in got}
    assert len(places) == len(rows)
    served = dict(sorted({r["mix_slot"]: r["source"] for r in got}.items()))
    assert list(served) == list(range(sum(-(-n // 4) for n in sizes.values())))
    weight = {s: (math.sqrt(n) if weights is None else weights.get(s, 1.0)) for s, n in sizes.items()}
    total = sum(weight.values())
    share = {s: max(1, round(50 * w / total)) for s, w in weight.items()}
    left = {s: -(-n // 4) for s, n in sizes.items()}
    fluid, done = dict.fromkeys(sizes, 0.0), dict.fromkeys(sizes, 0)
    for source in served.values():
        time = 1.0
        while time > 1e-9:
            active = [s for s in sizes if left[s] - fluid[s] > 1e-9]
            speed = sum(share[s] for s in active)
            if not active:
                break
            step = min([time, *((left[s] - fluid[s]) * speed / share[s] for s in active)])
            for s in active:
                fluid[s] += step * share[s] / speed
            time -= step
        done[source] += 1
        assert all(abs(fluid[s] - done[s]) < 1 + 1e-6 for s in sizes)


@pytest.mark.parametrize(
    "blocks, weights",
    [
        ({"a": 3000, "b": 300}, {"a": 1.0, "b": 0.0001}),
        ({f"s{i}": 4500 if i == 0 else 62 + 8 * i for i in range(41)}, None),
    ],
)
def test_mixing_keeps_to_the_weights_as_given(spark, blocks, weights):
    rows = [(i, s) for s, n in blocks.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(df, weights=weights, block_docs=1).select("source", "mix_slot").collect()
    served = dict(sorted((r["mix_slot"], r["source"]) for r in got))
    assert list(served) == list(range(len(rows)))
    share = {s: math.sqrt(n) if weights is None else weights[s] for s, n in blocks.items()}
    fluid, done = dict.fromkeys(blocks, 0.0), dict.fromkeys(blocks, 0)
    for source in served.values():
        time = 1.0
        while time > 1e-9:
            active = [s for s in blocks if blocks[s] - fluid[s] > 1e-9]
            speed = sum(share[s] for s in active)
            if not active:
                break
            step = min([time, *((blocks[s] - fluid[s]) * speed / share[s] for s in active)])
            for s in active:
                fluid[s] += step * share[s] / speed
            time -= step
        done[source] += 1
        assert all(abs(fluid[s] - done[s]) < 1 + 1e-6 for s in blocks)


def test_mixing_weighs_more_sources_than_a_thousand(spark):
    sizes = {"a": 1000} | {f"s{i}": 2 for i in range(1200)}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(df, weights={"a": 1200.0}, block_docs=1).where("source = 'a'").collect()
    place = sorted(r["mix_slot"] for r in got)
    # Half the weight is every other slot while the others last.
    assert all(abs(s - 2 * k) <= 2 for k, s in enumerate(place))


def test_mixing_of_odd_rows(odd, empty):
    assert mixing.mix(odd).count() == len(ODD)
    assert set(odd.columns) < set(mixing.mix(odd).columns)
    assert mixing.mix(empty).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["op4_quality_rules", "op7_order_minhash", "op10_source_mixing"]
)
def test_native_operators_run_no_python(spark, sf_dir, name):
    shown = plan(registered()[name](spark, sf_dir))
    assert not re.search("Python|Pandas|Arrow|Cartesian", shown)


def test_pipeline(spark, sf_dir, docs):
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, before, sf_dir)
        if name == "quality_rules":
            kept = {r["doc_id"] for r in quality.document_quality(before).collect() if r["kept"]}
            assert {r["doc_id"] for r in rows.collect()} == kept
        elif name == "near_duplicates":
            force = components_by_force([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
            want = {d for d, _, least, links in force if not links or least == d}
            assert sorted(r["doc_id"] for r in rows.collect()) == sorted(want)
        elif name == "personal_data":
            assert not any(rules_by_force(r["text"]) for r in rows.collect())
            assert rows.count() == before.count()
        elif name == "source_mixing":
            assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, before.collect()))
        if name != "token_ids":
            assert rows.columns == docs.columns
        before = corpus_pipeline.stored(rows, name)
    assert before.where("NOT decodes").count() == 0


def test_pipeline_keeps_the_mix(spark, docs):
    few = corpus_pipeline.stored(docs.limit(300).repartition(7), "few")
    places = ["doc_id", "source", "mix_block", "mix_slot", "mix_pos"]
    want = sorted(map(tuple, mixing.mixed_documents(few).collect()))
    laid = corpus_pipeline.stored(corpus_pipeline.source_mixing(spark, few, ""), "laid")
    got = corpus_pipeline.token_ids(spark, laid, "").select(*places).collect()
    assert sorted(map(tuple, got)) == want


def test_pipeline_of_odd_rows(spark, odd):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, odd, "")
        assert rows.columns == odd.columns
    assert corpus_pipeline.near_duplicates(spark, odd, "").count() == 8


def test_near_duplicates_leave_only_what_is_read_later(spark, docs, monkeypatch, tmp_path):
    few, number = corpus_pipeline.stored(docs.limit(300), "few"), itertools.count()
    force = components_by_force([(r["doc_id"], r["text"]) for r in few.collect()], 5, 80)
    monkeypatch.setattr(
        "veilmark.llm.common.scratch_path", lambda _, label: f"{tmp_path}/{label}-{next(number)}"
    )
    rows = corpus_pipeline.near_duplicates(spark, few, "")
    left = sorted(p.name.rpartition("-")[0] for p in tmp_path.iterdir())
    assert left == ["linked", "numbered"] and next(number) > 10
    want = {d for d, _, least, links in force if not links or least == d}
    assert sorted(r["doc_id"] for r in rows.collect()) == sorted(want)


HELPERS = (
    "src s b t k l p row group loser keeper label node rep content wanted key size edge token "
    "_src _b _h _k _n0 _rank _row _source _id _lang _words _lines _q _t _chars _places _key _range "
    "packed_row base_failed kept total metric bucket n_docs linked component n_links"
).split()


def test_stages_keep_columns_of_any_name(spark, docs):
    """Names that the operators use inside are columns like any others."""
    few = docs.limit(120).select("*", *[F.col("doc_id").alias(h) for h in HELPERS])
    few = corpus_pipeline.stored(few, "few")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, few, "")
        assert rows.columns == few.columns, name
        found = rows.collect()
        assert found and all(r[h] == r["doc_id"] for r in found for h in HELPERS), name


def test_ngram_join_of_rows_without_ids(spark):
    """Rows meet by id and text, so that rows sharing an id do not multiply."""
    base = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(400)]
    texts = [t for b in base for t in (b, b + " more")] + ["same words here again now"] * 500
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    rows = ngram_join.joined(df.repartition(5)).groupBy("n_shingles", "n_links").count().collect()
    assert sorted(map(tuple, rows)) == [(2, 499, 500), (57, 1, 400), (58, 1, 400)]


def order_hash(doc_id, seed):
    """The hash that orders a source, by another implementation."""
    first = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
    return xxhash.xxh64_intdigest(struct.pack("<i", seed), first) >> (64 - mixing.HASH_BITS)


def mix_by_force(rows, weights, per_block):
    """Every row with its place: all blocks looked at in every slot, in fractions."""
    names = sorted({s for _, s in rows}, key=lambda s: "-" if s is None else "=" + s)
    docs = {
        s: sorted((d for d, t in rows if t == s), key=lambda d: (order_hash(d, mixing.ORDER_SEED), d))
        for s in names
    }
    blocks = {s: -(-len(docs[s]) // per_block) for s in names}
    share = {s: Fraction(weights.get(s, 1)) for s in names}

    def slots_until(level):
        return sum(min(share[s] * level, blocks[s]) for s in names)

    waiting = {
        (s, k): (slots_until(k / share[s]), (k + 1) / share[s]) for s in names for k in range(blocks[s])
    }
    out = []
    for slot in range(sum(blocks.values())):
        released = [b for b, (release, _) in waiting.items() if release < slot + 1]
        source, k = min(released, key=lambda b: (waiting[b][1], names.index(b[0])))
        del waiting[source, k]
        part = docs[source][k * per_block : (k + 1) * per_block]
        out += [(d, source, k, slot, i) for i, d in enumerate(part)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weights", [{"a": 5, "b": 2, None: 3}, {"a": 1, "b": 7}, {}])
def test_mixing_rows_by_force(spark, weights):
    sizes = {"a": 130, "b": 61, "c": 7, None: 44, "": 9}
    rows = [(i * 31, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(3)
    got = mixing.mix(df, weights=weights, block_docs=4)
    got = got.select("doc_id", "source", "mix_block", "mix_slot", "mix_pos").collect()
    assert sorted((tuple(r) for r in got), key=repr) == mix_by_force(rows, weights, 4)


def test_toxicity_learns_from_whole_texts(spark):
    """A marking word counts however many words come before it in the alphabet."""
    filler = " ".join(f"a{i}" for i in range(9000))
    rows = [(i, f"{filler} {'zzmark' if i % 3 == 0 else 'zzcalm'} b{i % 7}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    model = ordinal_toxicity.fit(docs, labels)
    assert {w for w in model.weights if w.startswith("zz")} >= {"zzmark", "zzcalm"}
    got = ordinal_toxicity.document_toxicity(docs, labels).collect()
    assert all(r["toxic"] == (r["doc_id"] % 3 == 0) for r in got)


def test_features_by_force(spark):
    rows = [
        (i % 2, sorted({f"w{j}" for j in range(40) if (i * 7 + j) % 9 < (3 + j % 5 if i % 2 else 2)}))
        for i in range(90)
    ]
    sample = spark.createDataFrame(rows, "toxic int, words array<string>")
    n = sum(t for t, _ in rows)
    want = {}
    for word in {w for _, ws in rows for w in ws}:
        m = sum(word in ws for _, ws in rows)
        k = sum(word in ws for t, ws in rows if t)
        cells = [(k, n * m), (n - k, n * (90 - m)), (m - k, (90 - n) * m), (90 - n - m + k, (90 - n) * (90 - m))]
        gain = 2 * sum(o * math.log(o * 90 / e) for o, e in cells if o > 0)
        if m >= 3 and gain >= ordinal_toxicity.MIN_INFORMATION:
            want[word] = math.log((k + 0.5) * (90 - n - m + k + 0.5) / ((n - k + 0.5) * (m - k + 0.5)))
    got = ordinal_toxicity.choose_features(sample)
    assert want and got == pytest.approx(want)


def test_sections_share_windows_and_lose_nothing(docs, monkeypatch):
    """Long stretches full of numbers give the same spans however they are cut."""
    model = pii.fit(docs)
    line = "call 555 010 4477 or 4111.1111.1111.1111, id 12 34, 10 . 0 . 0 . 1; "
    texts = [" " * k + line * 40 for k in range(0, 32, 5)]
    whole = pii.all_spans(texts, model)
    monkeypatch.setattr(pii, "SECTION", 24)
    runs = pii.Tagger(model).sections(texts[0])
    assert len(runs) > 3 and all(len(r) <= 24 + pii.SHARED for r in runs)
    assert all(b[: pii.SHARED] == a[-pii.SHARED :] for a, b in itertools.pairwise(runs))
    cut = pii.all_spans(texts, model)
    n, lost = sum(len(s) for _, s in whole), 0
    for (_, before), (_, after) in zip(whole, cut, strict=True):
        lost += len(set(before) ^ set(after))
    assert lost <= n // 100


def test_training_texts_are_different_ones(spark, docs, monkeypatch):
    few = docs.where("text RLIKE '[0-9@]'").select("text").distinct().limit(12)
    copies = few.limit(1).crossJoin(spark.range(300)).select("text")
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 12)
    seen = []
    real = pii.map_arrow
    monkeypatch.setattr(pii, "map_arrow", lambda df, *a: seen.append(df) or real(df, *a))
    pii.fit(few.union(copies))
    assert seen[0].count() == 12
