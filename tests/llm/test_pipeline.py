"""The registered queries against their SQL, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import importlib
from pathlib import Path

import brute
import corpus_pipeline
import pytest
from corpora import plain

from lamina.llm.op5_suffix_dedup import PASSAGE
from lamina.llm.oracle import ORACLE
from lamina.llm.queries import QUERIES
from lamina.operators.staging import staging_folder
from testbed.compare import connect, difference

contract = importlib.import_module("__spark_entry__")


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf_dir, oracle, key):
    assert difference(QUERIES[key](spark, sf_dir), oracle, ORACLE[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE) - {"op8_decontaminate", "op13_phrases"}))
def test_query_has_a_row_per_document(spark, sf_dir, key):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert QUERIES[key](spark, sf_dir).count() == docs.count()


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.dtypes
    stages = dict(corpus_pipeline.STAGES)

    def step(name):
        nonlocal docs
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        docs = corpus_pipeline.pin(stages[name](spark, docs, sf_dir), name)
        return rows, {r.doc_id: r for r in docs.collect()}

    rows, left = step("quality_rules")
    assert set(left) <= {i for i, *_, failed in brute.quality(rows) if not failed}
    assert len(left) > 0.85 * len(rows) and docs.dtypes == columns
    rows, left = step("near_duplicates")
    assert set(left) == {i for i, _, _, kept in brute.near_duplicates(rows) if kept}
    assert docs.dtypes == columns
    rows, left = step("repeated_passages")
    cut = {i: (n, gone) for i, n, gone, _, _ in brute.suffix_dedup(rows, PASSAGE)}
    assert set(left) == {i for i, (n, gone) in cut.items() if gone < n or not n}
    text = dict(rows)
    for i, r in left.items():
        n, gone = cut[i]
        assert r.n_chars == len(r.text)
        assert n - gone - 6 <= len(r.text.encode()) <= n - gone
        assert gone or r.text == text[i]
    assert docs.dtypes == columns
    rows, left = step("decontamination")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    grams = {tuple(w[k : k + 5]) for _, t in items for w in [brute.benchmark_words(t)] for k in range(len(w) - 4)}
    near = [(i, t) for i, t in rows if (w := brute.benchmark_words(t)) and any(tuple(w[k : k + 5]) in grams for k in range(len(w) - 4))]
    leaks = {i for i, *_ in brute.contaminated(near, items)}
    assert set(left) == {i for i, _ in rows} - leaks and docs.dtypes == columns
    rows, left = step("tokens")
    assert set(left) == {i for i, _ in rows}
    assert plain((i, left[i].decoded_sha256) for i, _ in rows) == plain((i, brute.sha(t)) for i, t in rows)


def test_run_gives_the_last_stage(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_only_what_the_last_stage_reads_stays_staged(spark, sf_dir):
    folder = Path(staging_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.is_dir() else set()
    result = corpus_pipeline.run(spark, sf_dir)
    left = [p.name for p in set(folder.iterdir()) - before]
    assert len(left) == 1 and left[0].startswith("decontamination")
    assert result.count() > 0


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.pin(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0
