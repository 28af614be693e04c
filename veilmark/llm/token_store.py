"""Token ids in binary packs with one shared dictionary.

Every document is encoded once and compressed on its own with a zstandard
dictionary trained on a bounded sample, so a short document compresses well and
can be read alone. Packs are rows of a Parquet table in ascending id order: the
document ids, an offset index into the frames, the hash of the dictionary, and
the number of tokens before the pack. Spark writes them, so a task that runs
again replaces its own output and nothing else.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from veilmark.llm.common import (
    lowest,
    map_arrow,
    sliced,
    small_batches,
    stored,
    with_arrow_columns,
)
from veilmark.llm.sharding import ROW, START, positions
from veilmark.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 16384  # of one document's ids, for the dictionary alone
DICTIONARY_BYTES = 65536
LEVEL = 3
PACK_DOCS = 256
KNOWN_WORDS = 700_000
LONG_WORD = 100
ENCODED_BYTES = 4 << 20
TOGETHER = 500
BETWEEN = b"\x01"
# Marks behind an ASCII letter or digit, and the first bytes of combining accents.
CLOSING = re.compile(rb"[#$%&*|.,;:!?](?<=[a-z0-9].)")
ACCENTS = re.compile(rb"[\xcc\xcd]")

PACK = T.StructType(
    [
        T.StructField("first_row", T.LongType()),
        T.StructField("first_token", T.LongType()),
        T.StructField("first_doc", T.LongType()),
        T.StructField("last_doc", T.LongType()),
        T.StructField("id_bytes", T.IntegerType()),
        T.StructField("dictionary_hash", T.StringType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("frames", T.BinaryType()),
    ]
)
PACK_ARROW = pa.schema(
    [
        ("first_row", pa.int64()),
        ("first_token", pa.int64()),
        ("first_doc", pa.int64()),
        ("last_doc", pa.int64()),
        ("id_bytes", pa.int32()),
        ("dictionary_hash", pa.string()),
        ("doc_ids", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("frames", pa.binary()),
    ]
)


class WordEncoder:
    """Ids of whole texts, found word by word.

    The vocabulary's pre-tokenizer drops white space and never matches across
    it, so the ids of a text are those of its parts between white space, as
    little-endian bytes one after the other. Its normalizer lowers letters, and
    marks behind an ASCII letter or digit are a match of their own, so they are
    parts too. The ids of parts seen before are kept, up to a bound.
    """

    def __init__(self, path: str):
        # One text at a time has nothing for other threads, which wait busily.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # An added token cuts a text before it is normalized; words that hold
        # one are encoded alone.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added if t.content]
        alone = self.tokenizer.encode(BETWEEN.decode(), add_special_tokens=False).ids
        if len(alone) != 1:
            raise ValueError("the vocabulary has no single token for the mark between words")
        self.between = alone[0]
        # Tokens that end a match, where the vocabulary tells them from others.
        self.last = np.zeros(size, bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.last[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def together(self, words: list[bytes], mark: bytes) -> np.ndarray:
        """Ids of many words as one text, with ``mark`` between them."""
        text = mark.join(words).decode()
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, self.dtype)

    def cut(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray, gap: int) -> dict:
        """The words with their ids, which end before ``ends`` and lie ``gap`` apart."""
        width, raw = self.dtype.itemsize, ids.tobytes()
        starts = np.append(0, ends[:-1] + gap) * width
        places = map(slice, starts.tolist(), (ends * width).tolist())
        return dict(zip(words, map(raw.__getitem__, places), strict=True))

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new words, many at a time.

        Letters are one match, which its last token tells: if there are as many of
        these as words, each word has one. Between other words stands a known token.
        """
        found: dict[bytes, bytes] = {}
        rest = words
        if self.last.any():
            plain, rest = [], []
            for word in words:
                (plain if word.decode().isalpha() else rest).append(word)
            for at in range(0, len(plain), TOGETHER):
                some = plain[at : at + TOGETHER]
                ids = self.together(some, b" ")
                ends = np.flatnonzero(self.last[ids]) + 1
                if len(ends) == len(some):
                    found |= self.cut(some, ids, ends, 0)
                else:
                    rest += some
        for at in range(0, len(rest), TOGETHER):
            some, odd = rest[at : at + TOGETHER], []
            held, apart = b" ".join(some), [BETWEEN, *self.added]
            if any(m in held for m in apart):
                odd = [w for w in some if any(m in w for m in apart)]
                some = [w for w in some if not any(m in w for m in apart)]
            if some:
                ids = self.together(some, b" " + BETWEEN + b" ")
                ends = np.append(np.flatnonzero(ids == self.between), len(ids))
                found |= self.cut(some, ids, ends, 1)
            for word in odd:
                ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
                found[word] = np.array(ids, self.dtype).tobytes()
        return found

    def parted(self, text: bytes) -> bytes:
        """The text with white space between parts whose ids make up its own.

        Letters are lowered before the normalizer composes them with accents, which
        some are in one case alone; texts with such accents keep their case. So
        do texts that hold an added token in any case, whose marks are not parted.
        """
        low = text.lower()
        if ACCENTS.search(low) or any(m.lower() in low for m in self.added):
            return text
        return CLOSING.sub(rb" \g<0>", low)

    def ids(self, texts: list[bytes], end_id: int | None) -> list[bytes]:
        parts = pc.ascii_split_whitespace(pa.array(map(self.parted, texts), pa.string()))
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        found = self.learn([w for w in words if w and w not in self.known])
        self.known |= found
        self.known[b""] = b""
        pieces = list(map(self.known.__getitem__, words))
        for word in [w for w in found if len(w) > LONG_WORD]:
            del self.known[word]
        # All places of the words at once, as places of ids in their pieces.
        pool = np.frombuffer(b"".join(pieces), self.dtype)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.dtype.itemsize
        which = coded.indices.to_numpy()
        ends = np.cumsum(np.append(0, sizes[which]))
        shift = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        every = pool[np.repeat(shift, sizes[which]) + np.arange(ends[-1])]
        end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        cuts = ends[parts.offsets.to_numpy()].tolist()
        return [every[a:b].tobytes() + end for a, b in pairwise(cuts)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def forget() -> None:
    """A worker that has no more to encode gives the memory of its words back.

    Workers go on from one step to the next, and later steps need none of the words.
    """
    encoder.cache_clear()
    pa.default_memory_pool().release_unused()


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; raw content where there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionary_hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def _train(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    samples = []
    for batch in sliced(batches):
        samples += [ids[:SAMPLE_BYTES] for ids in encoder(path).ids(utf8_of(batch), None) if ids]
    yield pa.RecordBatch.from_arrays([pa.array([train_dictionary(samples)], pa.binary())], ["d"])


def shared_dictionary(docs: DataFrame, path: str) -> bytes:
    """Trained in one task on SAMPLE_DOCS documents, those of the lowest hashes."""
    sample = lowest(docs, F.xxhash64("doc_id"), SAMPLE_DOCS).select("text")
    rows = map_arrow(sample.coalesce(1), partial(_train, path=path), "d binary").collect()
    return max((bytes(r["d"]) for r in rows), default=b"")


def utf8_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    return [t or b"" for t in column.to_pylist()]


@lru_cache(maxsize=2)
def packer(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data)


def _compress(batch: pa.RecordBatch, path: str, dictionary: bytes, end_id: int) -> list[pa.Array]:
    words = encoder(path)
    rows = words.ids(utf8_of(batch), end_id)
    # Freed buffers of a batch are kept for as large ones, which the words leave no room for.
    pa.default_memory_pool().release_unused()
    compress = packer(dictionary).compress
    return [
        pa.array([len(r) // words.dtype.itemsize for r in rows], pa.int64()),
        pa.array(map(compress, rows), pa.binary()),
    ]


def _packs(
    batches: Iterator[pa.RecordBatch], digest: str, id_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Packs of the rows of a partition, which come in order."""
    forget()
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if len(rows) == PACK_DOCS or rows and row[ROW] != rows[-1][ROW] + 1:
                yield _pack(rows, digest, id_bytes)
                rows = []
            rows.append(row)
    if rows:
        yield _pack(rows, digest, id_bytes)


def _pack(rows: list[dict], digest: str, id_bytes: int) -> pa.RecordBatch:
    frames = [r["frame"] for r in rows]
    doc_ids = [r["doc_id"] for r in rows]
    known = [d for d in doc_ids if d is not None]
    pack = {
        "first_row": rows[0][ROW],
        "first_token": rows[0][START],
        "first_doc": min(known, default=None),
        "last_doc": max(known, default=None),
        "id_bytes": id_bytes,
        "dictionary_hash": digest,
        "doc_ids": doc_ids,
        "offsets": np.cumsum([0, *map(len, frames)]).tolist(),
        "frames": b"".join(frames),
    }
    return pa.RecordBatch.from_pylist([pack], PACK_ARROW)


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID
) -> None:
    """Write all documents' ids below ``path``: ``packs`` and ``dictionary``.

    Needs ``doc_id`` and ``text``. NULL and empty texts have the end id alone;
    NULL ids come first; repeated rows are all written, in any order among
    themselves. An empty table gives an empty table of packs. The file order is
    that of the ids; a pack holds at most PACK_DOCS documents.
    """
    vocabulary = vocabulary or default_vocabulary()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = shared_dictionary(docs, vocabulary)
    digest = dictionary_hash(dictionary)
    make = partial(_compress, path=vocabulary, dictionary=dictionary, end_id=end_id)
    fields = T.StructType().add("n_tokens", "long").add("frame", "binary")
    coded = with_arrow_columns(docs, fields, make, at_once=ENCODED_BYTES, without=("text",))
    with small_batches(docs.sparkSession, ENCODED_BYTES):
        records = stored(coded, "token-frames")
    records = records.withColumn(
        "key", F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    )
    lined, _ = positions(
        records, "key", "n_tokens", "key", ("key", "n_tokens"), split_hot=False, in_order=True
    )
    width = encoder(vocabulary).dtype.itemsize
    packs = map_arrow(
        lined.select(ROW, START, "doc_id", "frame"),
        partial(_packs, digest=digest, id_bytes=width),
        PACK,
    )
    # The frames are compressed already.
    with small_batches(docs.sparkSession):
        packs.write.option("compression", "uncompressed").parquet(f"{path}/packs")
    spark = docs.sparkSession
    spark.createDataFrame([(digest, dictionary)], "hash string, dictionary binary").write.parquet(
        f"{path}/dictionary"
    )


def _read(
    batches: Iterator[pa.RecordBatch], dictionary: bytes, wanted: int | None
) -> Iterator[pa.RecordBatch]:
    digest = dictionary_hash(dictionary)
    reader = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    )
    for batch in batches:
        for at in range(batch.num_rows):
            (pack,) = batch.slice(at, 1).to_pylist()
            if pack["dictionary_hash"] != digest:
                raise ValueError("the pack was written with another dictionary")
            out: dict[str, list] = {"doc_id": [], "start": [], "ids": []}
            start, kind = pack["first_token"], np.dtype(f"<u{pack['id_bytes']}")
            frames, offsets = memoryview(pack["frames"]), pack["offsets"]
            for i, doc_id in enumerate(pack["doc_ids"]):
                if wanted is not None and doc_id != wanted:
                    continue
                raw = reader.decompress(frames[offsets[i] : offsets[i + 1]])
                ids = np.frombuffer(raw, kind)
                out["doc_id"].append(doc_id)
                out["start"].append(start if wanted is None else None)
                out["ids"].append(ids.astype("<u4").tobytes())
                start += len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["doc_id"], pa.int64()),
                    pa.array(out["start"], pa.int64()),
                    pa.array(out["ids"], pa.binary()),
                ],
                ["doc_id", "start", "ids"],
            )


def read_tokens(spark: SparkSession, path: str, doc_id: int | None = None) -> DataFrame:
    """``doc_id``, ``start`` and ``ids`` (little-endian unsigned 32-bit integers).

    With ``doc_id`` only the packs that can hold it are read, and only its frame
    is decompressed; ``start`` is NULL then.
    """
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    packs = spark.read.schema(PACK).parquet(f"{path}/packs")
    if doc_id is not None:
        packs = packs.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    reader = partial(_read, dictionary=dictionary, wanted=doc_id)
    return map_arrow(packs, reader, "doc_id long, start long, ids binary")


def stored_tokens(docs: DataFrame) -> DataFrame:
    """Documents written to packs and read back: place, length and checksum."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    rows = read_tokens(docs.sparkSession, path)
    return rows.select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
