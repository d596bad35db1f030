"""The queries of this package, with their production parameters, and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lamina.llm import (
    op1_context_tree,
    op2_minhash,
    op3_toxicity,
    op4_bpe_automaton,
    op5_suffix_dedup,
    op6_substring_dedup,
    op7_quality_rules,
    op8_decontamination,
    op9_chat_formatting,
    op10_language_id,
    op11_secrets,
    op12_alignment,
    op13_collocations,
)
from lamina.llm.common import read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: A conversation of control strings that every run formats besides the table (fixed values).
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_context_tree.score(read(spark, sf_dir, "documents"))


def op2_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op3_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return op3_toxicity.digest(op3_toxicity.detect(docs, op3_toxicity.train(docs, labels)))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_bpe_automaton.digest(read(spark, sf_dir, "documents"), TOKENIZER)


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return op5_suffix_dedup.digest(op5_suffix_dedup.remove_repeats(docs))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return op6_substring_dedup.digest(op6_substring_dedup.remove_repeats(docs))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = op7_quality_rules.quality_rules(
        read(spark, sf_dir, "documents").select("doc_id", "lang", "text"),
        read(spark, sf_dir, "labels"),
        pooled=True,
    )
    return op7_quality_rules.digest(judged)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_decontamination.contaminated(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        "select * from values (-1L, 0L, 'user', :said), (-1L, 1L, 'assistant', :said)"
        " as t(conv_id, turn, role, text)",
        args={"said": CONTROL_TEXT},
    )
    turns = op9_chat_formatting.text_parts(given.unionByName(extra))
    return op9_chat_formatting.digest(op9_chat_formatting.format_chat(turns))


def op10_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return op10_language_id.identify(docs, op10_language_id.train(docs))


def op11_secrets_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_secrets.digest(op11_secrets.find(read(spark, sf_dir, "documents")))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_alignment.digest(read(spark, sf_dir, "documents"), TOKENIZER, PIECES)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_collocations.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ctw": op1_ctw,
    "op2_near": op2_near,
    "op3_toxic": op3_toxic,
    "op4_bpe": op4_bpe,
    "op5_suffix": op5_suffix,
    "op6_substring": op6_substring,
    "op7_quality": op7_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_chat": op9_chat,
    "op10_lang": op10_lang,
    "op11_secrets": op11_secrets_found,
    "op12_align": op12_align,
    "op13_phrases": op13_phrases,
}
