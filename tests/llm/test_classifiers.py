"""Toxic passages and languages: exact parts against brute force, accuracy on held-out rows."""

from __future__ import annotations

import math
import time
import random

import brute
import numpy as np
import pytest
from corpora import documents, prose, texts

from lamina.llm import op3_toxicity, op10_language_id

INSULTS = ["idiot", "scum", "moron", "trash", "loser"]


def toxic_table(spark, n=260):
    """Clean prose, and prose with a few insults for every fourth document."""
    draw = random.Random(9)
    rows, labels = [], []
    for k in range(n):
        words = prose(k, draw.randint(20, 120)).split(" ")
        if k % 4 == 0:
            for _ in range(draw.randint(2, 5)):
                words.insert(draw.randrange(len(words)), draw.choice(INSULTS).upper() + "!")
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(k % 4 == 0)))
    labels += [(None, 1, 1), (3, 1, None), (9999, 0, 1), (5, 1, 0), (5, 1, 0)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_segments_take_linear_time():
    """Gains on a falling trend, on a rising one, and peaks that later ones join back to."""
    def seconds(n):
        at = np.arange(n)
        falling = np.full(n, 0.1), at * 2
        rising = np.full(n, 1.0), at * 2
        waves = np.where(at % 2 == 0, 1.0, -1.0 - 1e-6 * at), at
        start = time.perf_counter()
        for gains, places in (falling, rising, waves):
            op3_toxicity.segments(gains, places)
        return time.perf_counter() - start

    seconds(10_000)
    assert seconds(200_000) < 4 * min(seconds(100_000) for _ in range(2))


def test_segments_are_the_maximal_ones():
    draw = random.Random(4)
    for _ in range(400):
        scores = [draw.choice([-0.5, -0.5, -0.5, 0.37, 0.81, 1.13, 2.29]) for _ in range(draw.randint(0, 25))]
        at = np.array([i for i, s in enumerate(scores) if s > 0], dtype=int)
        found = op3_toxicity.segments(np.array([scores[i] for i in at]), at)
        assert [(a, b) for a, b, _ in found] == brute.segments(scores)
        assert all(s == pytest.approx(sum(scores[a : b + 1])) for a, b, s in found)


def test_decay_solves_the_moment_equation():
    scores, chances = np.array([2.0, -0.5]), np.array([0.05, 0.95])
    root = op3_toxicity.decay_of(scores, chances)
    assert float(np.dot(chances, np.exp(root * scores))) == pytest.approx(1.0, abs=1e-6)
    assert root > 0.01


def test_toxic_documents_and_their_passages_are_found(spark):
    docs, labels = toxic_table(spark)
    model = op3_toxicity.train(docs, labels)
    got = {r.doc_id: r for r in op3_toxicity.detect(docs, model).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    held = [k for k in got if brute.fold(k, 3, 1)]
    assert all(got[k].held_out == brute.fold(k, 3, 1) for k in got)
    right = [got[k].predicted == (k % 4 == 0) for k in held]
    assert np.mean(right) > 0.97
    assert all((got[k].score >= 0.7) == bool(got[k].predicted) for k in got)
    found = [
        any(i in text[k].encode()[p.start : p.end].decode().lower() for i in INSULTS)
        for k in got
        for p in (got[k].passages if k % 4 == 0 else [])
    ]
    assert len(found) >= 50 and np.mean(found) > 0.8


def test_labels_held_out_do_not_reach_the_model(spark):
    docs, labels = toxic_table(spark)
    kept = labels.where("doc_id is null or crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1")
    one, other = op3_toxicity.train(docs, labels), op3_toxicity.train(docs, kept)
    assert (one.cells == other.cells).all()
    assert (one.slope, one.offset, one.log_k) == (other.slope, other.offset, other.log_k)


def test_toxicity_of_hard_cases_and_without_labels(spark):
    docs, labels = toxic_table(spark)
    model = op3_toxicity.train(docs, labels)
    got = op3_toxicity.detect(documents(spark), model)
    assert got.count() == len(texts())
    assert all(0 <= r.score <= 1 for r in got.collect())
    none = op3_toxicity.train(docs, labels.limit(0))
    assert {r.score for r in op3_toxicity.detect(docs, none).collect()} == {0.0}
    assert op3_toxicity.detect(documents(spark, []), model).count() == 0
    assert op3_toxicity.train(documents(spark, []), labels).offset == -math.inf


def language_rows(n=60):
    """Invented languages: two of one family share letters, a third has its own."""
    letters = {"de": "abcdeß", "en": "abcdew", "es": "ñopqrs", "xx": "αβγδε"}
    draw = random.Random(12)
    rows = []
    for k in range(n * 4):
        lang = list(letters)[k % 4]
        words = ["".join(draw.choices(letters[lang], k=draw.randint(2, 7))) for _ in range(draw.randint(3, 40))]
        rows.append((k, " ".join(words), lang))
    return rows


def test_languages_of_held_out_documents(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op10_language_id.train(docs)
    assert model.families == (("xx",), ("de", "en"), ("es",)) and model.pairs == ((1, "de", "en"),)
    got = {r.doc_id: r for r in op10_language_id.identify(docs, model).collect()}
    right = [got[k].lang_pred == lang for k, _, lang in rows if brute.fold(k, 4, 2)]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.held_out == brute.fold(k, 4, 2) for k, r in got.items())


def test_language_of_hard_cases(spark):
    model = op10_language_id.train(spark.createDataFrame(language_rows(), "doc_id long, text string, lang string"))
    found = op10_language_id.identify(documents(spark), model).collect()
    text = {i: t for i, t in texts() if i is not None}
    for r in found:
        if r.doc_id is not None:
            letter = any(c.isalpha() for c in text[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not letter)
            assert letter or r.score == 0
    assert len(found) == len(texts())
    assert op10_language_id.identify(documents(spark, []), model).count() == 0


def test_language_without_training_rows(spark):
    docs = documents(spark).withColumn("lang", op10_language_id.F.lit(None).cast("string"))
    found = op10_language_id.identify(docs, op10_language_id.train(docs)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


def test_sample_is_bounded_per_language(spark, monkeypatch):
    monkeypatch.setattr(op10_language_id, "SAMPLE", 20)
    docs = spark.createDataFrame(language_rows(100), "doc_id long, text string, lang string")
    sizes = op10_language_id._sampled(docs).groupBy("lang").count().collect()
    assert len(sizes) == 4 and all(5 <= r["count"] <= 40 for r in sizes)


def test_toxicity_query_against_a_plain_version(spark):
    docs, labels = toxic_table(spark, 160)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(900, ""), (901, None), (902, "scum! " * 40), (903, "?!")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    known = {}
    for r in labels.where("toxic is not null and doc_id is not null").collect():
        known[r.doc_id] = max(r.toxic, known.get(r.doc_id, 0))
    known = {i: y for i, y in known.items() if i in dict(rows)}
    model = op3_toxicity.train(table, labels)
    got = {r.doc_id: r for r in op3_toxicity.digest(op3_toxicity.detect(table, model)).collect()}
    want = brute.toxicity(rows, known)
    assert len(want) == len(got)
    for i, held_out, score in want:
        assert got[i].held_out == held_out
        assert got[i].score == pytest.approx(score, abs=2e-3), i
        assert abs(score - 0.7) < 2e-3 or got[i].predicted == (score >= 0.7)
    assert {got[902].predicted, got[900].predicted, got[901].predicted} == {0, 1}


def test_words_of_clean_text_count_against_a_passage(spark):
    docs, labels = toxic_table(spark)
    model = op3_toxicity.train(docs, labels)
    assert (model.scores < -op3_toxicity.DRIFT).any() and (model.scores > 0).any()


def test_language_vectors_and_votes_against_a_plain_version(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op10_language_id.train(docs)
    given = [(k, t) for k, t, _ in rows[:40]] + [(1000 + k, t) for k, (_, t) in enumerate(texts()) if len(t or "") < 1000]
    table = spark.createDataFrame(given, "doc_id long, text string")
    got = {r.doc_id: r for r in op10_language_id.identify(table, model).collect()}
    for k, text in given:
        lang, score = brute.language(text, model.families, model.pairs, model.weights.tolist())
        assert got[k].score == pytest.approx(score, abs=1e-4)
        assert got[k].lang_pred == lang


def test_machines_reach_the_least_loss():
    """Against Newton's method on the loss itself: rows of length one in many cells, as texts are."""
    draw = np.random.default_rng(3)
    x = np.abs(draw.normal(size=(120, 400)))
    y = np.where(np.arange(120) % 3 == 0, 1.0, -1.0)
    x[y > 0, :40] *= 2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = np.hstack([x, np.ones((120, 1))])
    cost = op10_language_id.COST * 120 / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))

    def loss(w):
        return 0.5 * w @ w + np.sum(cost * np.maximum(0, 1 - y * (rows @ w)) ** 2)

    best = np.zeros(401)
    for _ in range(100):
        on = y * (rows @ best) < 1
        bent = np.eye(401) + 2 * (rows[on].T * cost[on]) @ rows[on]
        best = 0.5 * best + 0.5 * np.linalg.solve(bent, 2 * (rows[on].T * cost[on]) @ y[on])
    found = op10_language_id.train_machine(x, y)
    assert loss(best) - 1e-6 <= loss(found) < 1.05 * loss(best) < loss(np.zeros(401))


def test_of_many_codes_the_ones_with_most_labels_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(op10_language_id, "LANGUAGES", 3)
    rows = language_rows() + [(5000 + k, "αβ γδ", f"odd-{k}") for k in range(30)]
    model = op10_language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sum(map(len, model.families)) == 3
    assert not [c for own in model.families for c in own if c.startswith("odd")]
