"""Named queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import quality_rules

    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op2_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import toxicity

    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import chunked_bpe

    coded = chunked_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op4_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import perspectives

    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def op5_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import personal_data

    docs = table(spark, sf_dir, "documents")
    found = personal_data.find(docs, personal_data.fit(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op6_parsing_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import phrases

    return phrases.with_next(table(spark, sf_dir, "documents"))


def op7_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import packing

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_bayes_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import jaccard_join

    return jaccard_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op9_bigru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import language

    return language.identify(table(spark, sf_dir, "documents"))


def op10_interval_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import repeats

    kept = repeats.deduplicated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_winnowed_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import winnowing

    judged = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import turn_repair

    turns = table(spark, sf_dir, "conversations")
    return turn_repair.with_all(turns, turn_repair.digests(turn_repair.repair(turn_repair.damaged(turns))))


def op13_quotient_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from epipanel.llm import collocations

    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_decision_list,
            op2_deobfuscated_toxicity,
            op3_chunk_reuse_bpe,
            op4_perspective_rotation,
            op5_boosted_pii,
            op6_parsing_fingerprint,
            op7_complement_packing,
            op8_bayes_jaccard,
            op9_bigru_language,
            op10_interval_tree_dedup,
            op11_winnowed_benchmark,
            op12_checkpointed_repair,
            op13_quotient_collocations,
        )
    }


def oracle_sql() -> dict[str, str]:
    from epipanel.llm import collocations, perspectives, winnowing

    return {
        "op4_perspective_rotation": perspectives.SQL,
        "op11_winnowed_benchmark": winnowing.SQL,
        "op13_quotient_collocations": collocations.SQL,
    }
