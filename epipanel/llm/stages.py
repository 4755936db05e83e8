"""Stages of the corpus pipeline: documents in, documents out, the last one packed pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.queries import TOKENIZER, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    from epipanel.llm import toxicity

    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one of smallest doc_id."""
    from epipanel.llm import jaccard_join

    return jaccard_join.keep_representatives(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand elsewhere too."""
    from epipanel.llm import repeats

    return repeats.without_repeats(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    from epipanel.llm import personal_data

    return personal_data.redact(docs, personal_data.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and place."""
    from epipanel.llm import packing

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))
