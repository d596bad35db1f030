"""Corpus pipeline: documents through quality rules, near and exact duplicates, benchmarks, tokens.

Every stage but the last returns the columns of its input. Each works on all rows that the stage
before kept, and what it decides takes effect: rejected documents, near-duplicates and contaminated
documents go, repeated passages are cut out of the text. The last returns one row per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import (
    op2_minhash,
    op4_bpe_automaton,
    op5_suffix_dedup,
    op7_quality_rules,
    op8_decontamination,
)
from lamina.llm.common import pin, read
from lamina.llm.queries import TOKENIZER
from lamina.operators.staging import noting_staged, release


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the cutoffs come from the labels.

    Documents without words go, as they break the base rule; without labels only that rule acts. Rows
    are judged one by one, so repeated rows and null ids are kept or not as their text is; an empty
    table stays empty.
    """
    return op7_quality_rules.accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    Of rows equal in id and text one stays; empty and null texts are near to nothing and all stay.
    """
    return op2_minhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 short words, 240 bytes, that also stand elsewhere.

    A document of which nothing is left goes, one that had no text stays; a letter that a cut splits
    goes as a whole; null ids are documents like any other.
    """
    return op5_suffix_dedup.cleaned(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items of five words or more.

    Null ids and null texts are never contaminated; an empty benchmark takes nothing.
    """
    return op8_decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, one row per row; a null text is empty."""
    return op4_bpe_automaton.digest(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("tokens", tokens),
]
#: Signatures, suffix ranks, tiles and tokens have no SQL form; brute force tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written once and read again.

    What a stage staged for itself, and the rows it read, are deleted once its own rows are written;
    only those that the last stage reads are left.
    """
    docs, read_from = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noting_staged() as paths:
            docs = pin(stage(spark, docs, sf_dir), name)
        release(spark, [*read_from, *paths[:-1]])
        read_from = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
