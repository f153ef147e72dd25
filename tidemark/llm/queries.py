"""The corpus queries: op<N>_<name> applies operator N to its whole table; pipeline runs corpus_pipeline.py."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import branch_merge, byte_bpe, chat, decontaminate, html_extract, lexical, licenses, mixing, ngram_join, oracles, pii, quality_crf, quality_rules, suffix_dedup
from tidemark.llm.common import read


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.mix(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"), licenses.Params(windows=True))


def op6_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    c = read(spark, sf_dir, "conversations").selectExpr("cast(conv_id as bigint) conv_id", "cast(turn as bigint) turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(*chat.pack(c.unionByName(own)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules.judge(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read(spark, sf_dir, "documents"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(read(spark, sf_dir, "pages"))


def op10_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_branch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = branch_merge.merge(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_sha256"), *branch_merge.COUNTS)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = byte_bpe.Params(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    d = byte_bpe.encode(read(spark, sf_dir, "documents"), p).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return byte_bpe.decode(d, p).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
        "op3_mix_sources": op3_mix_sources,
        "op4_decontaminate": op4_decontaminate,
        "op5_license_scan": op5_license_scan,
        "op6_chat_tree": op6_chat_tree,
        "op7_quality_rules": op7_quality_rules,
        "op8_pii": op8_pii,
        "op9_html_extract": op9_html_extract,
        "op10_quality_crf": op10_quality_crf,
        "op11_branch_merge": op11_branch_merge,
        "op12_lexical_search": op12_lexical_search,
        "op13_byte_bpe": op13_byte_bpe,
    }


def oracle_sql() -> dict[str, str]:
    p = pii.Params()
    return {
        "op2_ngram_jaccard_join": oracles.NGRAM_JOIN,
        "op4_decontaminate": oracles.DECONTAMINATE,
        "op6_chat_tree": oracles.CHAT_TREE,
        "op11_branch_merge": oracles.BRANCH_MERGE,
        "op12_lexical_search": oracles.LEXICAL_SEARCH,
        "op8_pii": oracles.pii(p.min_letters, p.deviations, p.least_disclosure),
    }
