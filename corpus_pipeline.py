"""The corpus pipeline: each stage reads the Parquet table that the stage before it wrote.

Documents whose language is recognised, one of each group of near copies, without passages that an earlier document
has, as often as the mix of sources takes them, as token ids.

Every stage but the last returns the columns of its input, whatever further ones there are, and an empty table for an
empty one. What it does with nulls, empty and very long texts, ties and repeated rows is said at each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evenhand.llm import bpe, jaccard, language, mixing, suffixes
from evenhand.llm.common import documents, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; the model is fitted on labelled documents of this stage's input.

    Null and empty texts and texts without a letter go, and so do all where no document has a label. Rows without an id or
    a label are judged and teach nothing. Very long texts are read whole; ties go to the language that is first by name.
    Repeated rows stay or go together.
    """
    return language.keep_known(docs, language.fit(docs))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at a similarity of 0.75 or more.

    The smallest doc_id of a group stays, once. Texts without words, null ones among them, link with nothing and stay;
    very long texts are cut into shingles whole.
    """
    return jaccard.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes and more that a document with a smaller doc_id has too.

    Null and empty texts and those below 50 bytes stay as they are, and so does a row without an id. Rows with equal
    doc_id take nothing from each other. Documents that lose all their bytes go; characters that a cut breaks are dropped.
    Very long texts are read in slices that overlap.
    """
    return suffixes.cleaned(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source. Null and empty texts have size 0: they come in the certain copies of their source, and
    take no part of its words. Rows with equal source and doc_id are taken equally often.
    """
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with the digests of ids and of the bytes decoded from them.

    A null text is an empty one, without ids. Repeated rows repeat; very long texts take time in proportion.
    """
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_near_copies),
    ("repeated_passages", without_repeated_passages),
    ("mix", mixed_sources),
    ("token_ids", token_ids),
]

#: SQL cannot say these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
