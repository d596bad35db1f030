"""Context-tree weighting against a tree kept in plain dictionaries."""

from __future__ import annotations

import math

import brute
import pytest
from corpora import documents, prose, texts

from lamina.llm import exchange, op1_context_tree


@pytest.fixture(autouse=True)
def small_buckets(monkeypatch):
    monkeypatch.setattr(exchange, "BUCKET_BYTES", (6_000, 6_000))


def short_texts():
    """The hard cases with their long texts cut, as the brute-force tree visits every bit."""
    return [(i, None if t is None else t[:160]) for i, t in texts()][:30]


def test_scores_on_hard_cases(spark):
    rows = short_texts()
    got = op1_context_tree.score(documents(spark, rows)).collect()
    key = lambda r: (r[0] is not None, r[0], r[2], r[-1])
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for mine, want in zip(found, sorted(brute.base_scores(rows), key=key), strict=True):
        assert mine[:5] == want[:5]
        assert mine[5] == pytest.approx(want[5], rel=1e-9)
    mine = sorted((r.doc_id is not None, r.doc_id or 0, r.score) for r in got)
    tree = brute.tree_scores(rows, op1_context_tree.DEPTH)
    for a, b in zip(mine, sorted((i is not None, i or 0, s) for i, s in tree), strict=True):
        assert a[:2] == b[:2]
        assert a[2] == pytest.approx(b[2], rel=1e-6)


def test_code_length_is_that_of_the_score(spark):
    row = op1_context_tree.score(documents(spark, [(1, "abcabcabc")])).first()
    assert row.code_bits_per_byte == pytest.approx(-row.score / math.log10(2) / 10)


def test_known_text_costs_less_than_noise(spark):
    rows = [(k, prose(k, 120)) for k in range(20)] + [(900, "qzjx9#vw" * 40), (901, prose(999, 60))]
    got = {r.doc_id: r.code_bits_per_byte for r in op1_context_tree.score(documents(spark, rows)).collect()}
    assert got[901] < 4 < got[900] + 4


def test_only_held_out_documents(spark):
    held = [k for k in range(200) if brute.fold(k, 7, 2)][:3]
    got = op1_context_tree.score(documents(spark, [(k, "some text") for k in held])).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in got} == {(0, 0, 0.0)}
    assert all(r.score == pytest.approx(80 * math.log10(0.5)) for r in got)  # nothing is known


def test_empty_table(spark):
    assert op1_context_tree.score(documents(spark, [])).count() == 0


def test_slot_table_finds_all_keys_and_no_others():
    import numpy as np

    from lamina.llm.textops import Table

    keys = np.unique(np.random.default_rng(2).integers(0, 2**62, 30_000, dtype=np.uint64))
    table = Table(keys[::2], np.arange(len(keys[::2]), dtype=float) + 1)
    assert (table(keys[::2]) == np.arange(len(keys[::2])) + 1).all()
    assert (table(keys[1::2]) == 0).all()
    assert (Table(keys[:0], np.empty(0))(keys[:5]) == 0).all()


def test_base_score_in_numbers(spark):
    """Five training tokens of three kinds: a twice, b once, two ends."""
    assert [brute.fold(i, 7, 2) for i in (0, 1, 2)] == [False, True, False]
    rows = [(0, "a b"), (2, "A"), (1, "b new")]
    got = {r.doc_id: r for r in op1_context_tree.score(documents(spark, rows)).collect()}
    assert got[0].train_tokens == 5
    assert got[0].base_score == pytest.approx(math.log10(3 / 9 * 2 / 9 * 3 / 9))
    assert got[2].base_score == pytest.approx(math.log10(3 / 9 * 3 / 9))
    assert got[1].base_score == pytest.approx(math.log10(2 / 9 * 1 / 9 * 3 / 9))
