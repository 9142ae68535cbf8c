"""The registered queries of the training-data operators, with their production
parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waferline.llm import chat, collocations, decontaminate, language_id, language_model, licenses, line_dedup, mix, near_dedup, prefix_trie, shard, tokens, vector_search
from waferline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.digest(mix.mix(table(spark, sf_dir, "documents")))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.format_chats(chat.with_hostile(table(spark, sf_dir, "conversations"))))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.digest(tokens.write_tokens(table(spark, sf_dir, "documents"),
                                             public_tokenizers.path("byte_bpe_50k.json")))


def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.digest(shard.assign(table(spark, sf_dir, "documents")))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan_documents(table(spark, sf_dir, "documents")))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.top_k(vectors, vector_search.every_nth(vectors))


def op9_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(
        decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.digest(collocations.collocations(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_source_mix": op1_source_mix,
        "op2_chat_format": op2_chat_format,
        "op3_near_duplicates": op3_near_duplicates,
        "op4_token_files": op4_token_files,
        "op5_ring_shards": op5_ring_shards,
        "op6_language_id": op6_language_id,
        "op7_license_scan": op7_license_scan,
        "op8_exact_top_k": op8_exact_top_k,
        "op9_trie_scores": op9_trie_scores,
        "op10_decontamination": op10_decontamination,
        "op11_line_dedup": op11_line_dedup,
        "op12_collocations": op12_collocations,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_source_mix": mix.ORACLE,
        "op2_chat_format": chat.ORACLE,
        "op3_near_duplicates": near_dedup.ORACLE,
        "op8_exact_top_k": vector_search.ORACLE,
        "op10_decontamination": decontaminate.ORACLE,
        "op11_line_dedup": line_dedup.ORACLE,
        "op12_collocations": collocations.ORACLE,
        "op13_prefix_trie": prefix_trie.ORACLE,
    }
