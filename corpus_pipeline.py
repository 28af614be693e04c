"""A training-data pipeline over ``documents``, stage by stage.

Quality rules, one document of each near-duplicate group, personal data replaced,
sources mixed to weights, and token ids. Every stage reads what the one before
wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilmark.llm import byte_bpe, mixing, ngram_join, pii, quality
from veilmark.llm.common import documents, stored

NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules keep."""
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return ngram_join.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows."""
    return pii.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order of the mix."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixing.in_mix_order(mixing.mix(docs), parts)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, whether they decode to it, and its place in the mix.

    Files may be read in any order, so the place is found anew: it depends on the
    rows alone, and these are all rows of the mix.
    """
    rows = byte_bpe.round_trip(mixing.mix(docs))
    whole = F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        whole.alias("decodes"),
        "mix_block",
        "mix_slot",
        "mix_pos",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("token_ids", token_ids),
]

# The stages hold hashes, a trained network and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
