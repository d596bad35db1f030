"""Near-duplicates, repeated byte strings and repeated windows against brute force."""

from __future__ import annotations

from collections import Counter

import brute
import pytest
from corpora import documents, plain, texts
from pyspark.sql import functions as F

from lamina.llm import exchange, op2_minhash, op5_suffix_dedup, op6_substring_dedup
from lamina.llm.components import connected


@pytest.fixture
def small_buckets(monkeypatch):
    """Many buckets and shards on a small table."""
    monkeypatch.setattr(exchange, "BUCKET_BYTES", (12_000, 12_000))


def rows_of(df):
    return plain(tuple(r) for r in df.collect())


def given(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_near_duplicates_on_hard_cases(spark):
    found = op2_minhash.near_duplicates(documents(spark))
    assert rows_of(found) == plain(brute.near_duplicates(texts()))


def test_near_duplicates_on_the_given_table(spark, sf_dir):
    docs, rows = given(spark, sf_dir)
    assert rows_of(op2_minhash.near_duplicates(docs)) == plain(brute.near_duplicates(rows))


def test_a_chain_of_near_copies_is_one_component(spark):
    words = [f"w{k}" for k in range(200)]
    rows = []
    for n in range(40):  # each text differs from the next in a few words, the ends in most
        words[n * 5] = f"new{n}"
        rows.append((1000 - n, " ".join(words)))
    found = op2_minhash.near_duplicates(documents(spark, rows))
    assert rows_of(found) == plain(brute.near_duplicates(rows))
    assert {r.component_id for r in found.collect()} == {961}


def test_one_of_each_keeps_columns_and_rows_without_id(spark):
    docs = documents(spark)
    left = op2_minhash.one_of_each(docs)
    assert left.dtypes == docs.dtypes
    want = [i for i, _, _, kept in brute.near_duplicates(texts()) if kept or i is None]
    want.remove(70)  # the same row twice
    assert sorted(i or -1 for i in want) == sorted(r.doc_id or -1 for r in left.collect())


def test_one_of_each_tells_rows_of_one_id_apart(spark):
    words = [[f"{name}{k}" for k in range(120)] for name in "abc"]
    a, b, c = (" ".join(w) for w in words)
    near = " ".join([*words[2][:119], "changed"])
    rows = [(1, a), (7, a), (7, b), (9, c), (9, near), (9, ""), (9, None), (9, "")]
    left = op2_minhash.one_of_each(documents(spark, rows)).collect()
    found = sorted((r.doc_id, r.text or "") for r in left)
    assert found[:2] == [(1, a), (7, b)] and found[2:4] == [(9, ""), (9, "")]
    assert len(found) == 5 and found[4] in {(9, c), (9, near)}


def test_signature_estimate_counts_equal_groups(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "p q r s t u v w")]
    got = {r.doc_id: r for r in op2_minhash.signatures(documents(spark, rows)).collect()}
    same = [got[1][p] == got[2][p] for p in op2_minhash.PLANES]
    assert all(same)
    assert got[1].bands == got[2].bands
    assert not set(got[1].bands) & set(got[3].bands)


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = {r.node: r.label for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)}


def test_suffix_dedup_on_hard_cases(spark, small_buckets):
    removed = op5_suffix_dedup.remove_repeats(documents(spark))
    assert rows_of(op5_suffix_dedup.digest(removed)) == suffix_rows(texts(), 400)


def test_suffix_dedup_on_the_given_table(spark, sf_dir, small_buckets):
    docs, rows = given(spark, sf_dir)
    found = op5_suffix_dedup.digest(op5_suffix_dedup.remove_repeats(docs))
    assert rows_of(found) == suffix_rows(rows, 400)


@pytest.mark.parametrize("length", [40, 200, 777])
def test_suffix_dedup_of_other_lengths(spark, small_buckets, length):
    removed = op5_suffix_dedup.remove_repeats(documents(spark), length=length)
    assert rows_of(op5_suffix_dedup.digest(removed)) == suffix_rows(texts(), length)


def suffix_rows(rows, length):
    """The plain version's rows with the bytes that repeated cover samples cover."""
    cover = op5_suffix_dedup.Cover.of(length)
    size, counts, covered = cover.reach, Counter(), []
    at = [
        [k for k in range(len(t) - size + 1) if cover.sampled[k % cover.period]]
        for t in ((t or "").encode() for _, t in rows)
    ]
    for (_, t), places in zip(rows, at, strict=True):
        raw = (t or "").encode()
        counts.update(raw[k : k + size] for k in places)
    for (_, t), places in zip(rows, at, strict=True):
        raw = (t or "").encode()
        marks = bytearray(len(raw))
        for k in places:
            if counts[raw[k : k + size]] > 1:
                marks[k : k + size] = b"\1" * size
        covered.append(sum(marks))
    found = brute.suffix_dedup(rows, length)
    return plain((*row, n) for row, n in zip(found, covered, strict=True))


def test_no_passage_of_over_50_words_is_left_in_two_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    left = op5_suffix_dedup.cleaned(op2_minhash.one_of_each(docs)).collect()
    seen = {}
    for r in left:
        w = brute.words(r.text)
        for k in range(len(w) - 50):
            seen.setdefault(tuple(w[k : k + 51]), set()).add(r.doc_id)
    assert not [p for p, ids in seen.items() if len(ids) > 1]


def test_cleaned_returns_the_columns_and_whole_letters(spark):
    docs = documents(spark)
    left = op5_suffix_dedup.cleaned(docs)
    assert left.dtypes == docs.dtypes
    got = {r.doc_id: r for r in left.collect()}
    assert 10 not in got  # a copy stands elsewhere
    assert got[3].text in (None, "")
    assert "日本語 テキスト" in got[22].text
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text and r.n_chars is not None)


def test_difference_cover_spans_every_shift():
    for length in (30, 200, 400, 5000):
        cover = op5_suffix_dedup.Cover.of(length)
        places = [k for k in range(cover.period) if cover.sampled[k]]
        assert {(a - b) % cover.period for a in places for b in places} == set(range(cover.period))
        assert cover.reach >= length // 2 or length < 146


def test_substring_dedup_on_hard_cases(spark, small_buckets):
    removed = op6_substring_dedup.remove_repeats(documents(spark))
    assert rows_of(op6_substring_dedup.digest(removed)) == plain(brute.substring_dedup(texts()))


def test_substring_dedup_on_the_given_table(spark, sf_dir, small_buckets):
    docs, rows = given(spark, sf_dir)
    found = op6_substring_dedup.digest(op6_substring_dedup.remove_repeats(docs))
    assert rows_of(found) == plain(brute.substring_dedup(rows))


def test_a_narrow_sketch_loses_nothing(spark, monkeypatch, small_buckets):
    """Cells shared by many windows let more through to the exact groups, and change no result."""
    monkeypatch.setattr(op6_substring_dedup, "CELLS_PER_WINDOW_BITS", -30)
    found = op6_substring_dedup.digest(op6_substring_dedup.remove_repeats(documents(spark)))
    assert rows_of(found) == plain(brute.substring_dedup(texts()))


@pytest.mark.parametrize(
    "work",
    [
        op2_minhash.near_duplicates,
        op2_minhash.one_of_each,
        lambda d: op5_suffix_dedup.digest(op5_suffix_dedup.remove_repeats(d)),
        op5_suffix_dedup.cleaned,
        lambda d: op6_substring_dedup.digest(op6_substring_dedup.remove_repeats(d)),
    ],
)
def test_empty_table(spark, work):
    assert work(documents(spark, [])).count() == 0


def test_packed_keys_and_bits_come_back():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    assert (exchange.unpack_keys(exchange.pack_keys(keys)) == keys).all()
    assert len(exchange.unpack_keys(exchange.pack_keys(keys[:0]))) == 0
    flags = keys % np.uint64(3) == 0
    assert (exchange.unpack_bits(exchange.pack_bits(flags)) == flags).all()


def test_equal_rows_spread_over_buckets(spark, tmp_path, monkeypatch):
    """A third of all rows are copies of one row, id and text."""
    monkeypatch.setattr(exchange, "BUCKET_BYTES", (100_000, 100_000))
    rows = spark.range(9000).selectExpr(
        "if(id % 3 = 0, 7, id) as doc_id", "if(id % 3 = 0, repeat('same ', 40), repeat(sha2(cast(id as string), 256), 3)) as text"
    )
    rows.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    dealt = exchange.deal(docs)
    sizes = [r.n for r in dealt.rows.groupBy("bucket").agg(F.sum(F.octet_length("text")).alias("n")).collect()]
    assert len(sizes) == dealt.buckets > 10
    assert max(sizes) < 2 * sum(sizes) / len(sizes)
    removed = op5_suffix_dedup.digest(op5_suffix_dedup.remove_repeats(docs, length=150))
    assert removed.where("doc_id = 7 and n_removed = 200").count() == 3000
    assert removed.where("doc_id <> 7 and n_removed > 0").count() == 0
