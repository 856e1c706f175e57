"""A training-data pipeline over the table documents.

Quality classifier, exact dedup, MinHash near-dedup, mixing, SentencePiece.
Every stage takes what its predecessor kept, written as Parquet and read again.

Defined results of all stages: an empty table gives an empty one; extra columns
pass through all stages but the last, whatever their names and types; texts of
any length are read whole. A null text counts as an empty one in every decision
and stays null in the rows that are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodequill.llm import exact_dedup, minhash_neardup, mixing, quality_crf, sentencepiece_codec
from lodequill.llm.common import cut, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. A null, empty or blank text has
    the labels' prior as its score; rows are independent, so rows that repeat a
    doc_id or have none are judged by their texts."""
    return quality_crf.good_rows(docs, quality_crf.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; a null doc_id loses
    to any other. Among rows that tie the largest hash of all columns stays, so
    one row of each text is left, null and empty texts being one."""
    return exact_dedup.exact_keepers(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays. Wordless texts
    stay all; rows that repeat the doc_id that stays do so too; a row without
    doc_id goes if a row with one has the same words."""
    return minhash_neardup.near_keepers(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most twice; documents
    without words are taken no time. Sources are those of the rows that are left,
    null being one of them. Of rows that are equal in every column one stands for
    all their copies. Reruns take the same."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of each row; copies
    and null doc_ids are rows of their own, a null text has no ids."""
    return sentencepiece_codec.digests(sentencepiece_codec.encode_decode(docs))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("minhash near-dedup", near),
    ("mixing sources", mix),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
