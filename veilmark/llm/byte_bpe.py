"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are split where no match of the pattern can reach across, so the ids
are those of the whole text while the library sees pieces of bounded length.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache, partial

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilmark.llm.common import list_array, texts_of, with_arrow_columns

RANKS = "byte_bpe_multi_50k.tiktoken"
LONG = 1 << 16
# White space as the encoder's own pattern engine knows it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A match with white space begins with it, so one that began before cannot reach
# over the place between anything else and white space; nor does one hold
# letters together with digits.
SAFE = re.compile(rf"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
# The engine overflows its stack on runs of a million; see `encode_text`.
LONG_WHITE = re.compile(rf"[{WHITE}]{{4096,}}")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """One encoder per worker process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def default_ranks() -> tuple[str, str]:
    """Place of the installed rank file and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def safe_pieces(text: str, most: int = LONG) -> list[str]:
    """The text in pieces of about ``most`` characters, cut at safe places only.

    A stretch without a safe place stays whole, however long.
    """
    pieces, start = [], 0
    while len(text) - start > most:
        place = SAFE.search(text, start + most)
        if place is None:
            break
        pieces.append(text[start : place.start()])
        start = place.start()
    return [*pieces, text[start:]]


def encode_text(text: str, encoder: tiktoken.Encoding) -> list[int]:
    if len(text) <= LONG:
        return encoder.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    # One match takes a long run of white space but for its last character,
    # which goes with what follows; at the end of the text it takes all.
    for run in LONG_WHITE.finditer(text):
        for piece in safe_pieces(text[start : run.start()]):
            ids += encoder.encode_ordinary(piece)
        start = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoder._encode_single_piece(text[run.start() : start])
    for piece in safe_pieces(text[start:]):
        ids += encoder.encode_ordinary(piece)
    return ids


def _encode(batch: pa.RecordBatch, text: str, path: str, pattern: str) -> list[pa.Array]:
    encoder = encoding(path, pattern)
    rows = [encode_text(t, encoder) for t in texts_of(batch, text)]
    return [list_array(rows, pa.int32(), "int32")]


def _decoded(lists: pa.Array, path: str, pattern: str) -> list[pa.Array]:
    encoder = encoding(path, pattern)
    rows = [encoder.decode_bytes(row.as_py() or []) for row in lists]
    return [pa.array(rows, pa.binary())]


def _decode(batch: pa.RecordBatch, ids: str, path: str, pattern: str) -> list[pa.Array]:
    return _decoded(batch.column(batch.schema.get_field_index(ids)), path, pattern)


def _round_trip(batch: pa.RecordBatch, text: str, path: str, pattern: str) -> list[pa.Array]:
    ids = _encode(batch, text, path, pattern)
    return [*ids, *_decoded(ids[0], path, pattern)]


def encode(df: DataFrame, text: str = "text", ranks: str | None = None, pattern: str | None = None):
    """All rows with ``ids``, the tokens of the whole text; none for NULL or empty.

    ``ranks`` is the path of a rank file on every executor. A column named
    ``ids`` is replaced; repeated rows are encoded one by one.
    """
    known = default_ranks() if ranks is None or pattern is None else ("", "")
    make = partial(_encode, text=text, path=ranks or known[0], pattern=pattern or known[1])
    return with_arrow_columns(df, T.StructType().add("ids", T.ArrayType(T.IntegerType())), make, text)


def decode(df: DataFrame, ids: str = "ids", ranks: str | None = None, pattern: str | None = None):
    """All rows with ``decoded``: the raw bytes, whether or not they are valid text."""
    known = default_ranks() if ranks is None or pattern is None else ("", "")
    make = partial(_decode, ids=ids, path=ranks or known[0], pattern=pattern or known[1])
    return with_arrow_columns(df, T.StructType().add("decoded", "binary"), make, None)


def round_trip(
    df: DataFrame, text: str = "text", ranks: str | None = None, pattern: str | None = None
):
    """All rows with ``ids`` and ``decoded``, as `decode` of `encode` gives.

    One Python worker per task does both, so an executor holds the encoder once per
    core and not twice, also while idle workers wait for the next stage.
    """
    known = default_ranks() if ranks is None or pattern is None else ("", "")
    make = partial(_round_trip, text=text, path=ranks or known[0], pattern=pattern or known[1])
    fields = T.StructType().add("ids", T.ArrayType(T.IntegerType())).add("decoded", "binary")
    return with_arrow_columns(df, fields, make, text)


def document_tokens(docs: DataFrame) -> DataFrame:
    """Digests of the ids and of the bytes that they decode to."""
    rows = round_trip(docs.select("doc_id", "text")).drop("text")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
