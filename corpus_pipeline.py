"""A training corpus out of raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``docs``, whatever else they are
called. Nulls in any column, empty and very long texts, ties and repeated rows
are as the operators' docstrings say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nimbusframe.llm import line_dedup, mixing, order_minhash, piece_codec, quality
from nimbusframe.llm.common import checkpointed
from nimbusframe.llm.suite import PIECE_MODEL
from nimbusframe.session import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; references come from ``docs``."""
    return quality.keep_good(docs)


def line_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated line windows go from the texts, and
    documents that are left without a word by it."""
    return line_dedup.mended_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return order_minhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, their number, and whether they decode."""
    return piece_codec.encode_texts(docs, PIECE_MODEL)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_windows),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("piece ids", piece_ids),
]

#: Divergences, alignments and transducers are not SQL: tests/llm holds the
#: stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the
    checkpoint folder before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else checkpointed(docs), sf_dir)
    return docs
