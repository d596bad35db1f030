"""Toxic passages as maximum-scoring segments of token log-odds.

1. Tokens of labelled training documents are counted per class. A token's score is the end nearer to
   zero of the confidence interval of its log-odds between toxic and clean text, or zero inside it,
   under a Dirichlet prior in proportion to the background counts, less a drift, so that clean text
   scores below zero on average. Tokens without proof cost the drift, tokens of clean text more.
   Exact copies of a text count once.
2. A linear-time scan of each text finds every maximal segment: those that no shorter or longer
   segment around them beats. Scores of the best segments of clean text follow an extreme-value law
   in ``lambda`` (the root of the moment equation over clean tokens), ``K`` and the text's length,
   so each segment gets a normalised score and with it the number of such passages due to chance.
3. A document's evidence is the sum over its significant passages, or its best passage if none is.
   A logistic curve fitted to the training documents turns it into a probability.

Tokens are lower-cased words without punctuation at the ends, hashed to ``CELLS`` numbers; the model
holds at most that many scores, whatever the corpus, so it is sent to every task.

Defined results: a null or empty text, or one without tokens, has no passage and gets the lowest
probability; labels that are null or without a document are ignored, and a document labelled more
than once is toxic if any label says so; a null ``doc_id`` is not held out and has no label; an
empty table gives an empty result; without toxic and clean training documents every score is 0.
Other columns are ignored. Score inputs are texts alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import fold, if_small, pin
from lamina.llm.textops import PUNCTUATION, Block, batches

FOLD = (3, 1)
CELLS = 1 << 22
#: Weight of the prior as a share of all training tokens; deviations below the estimate that a
#: token's score is taken at; what every token costs.
PRIOR_SHARE, DEVIATIONS, DRIFT = 0.01, 1.0, 0.5
#: A passage counts when chance gives fewer than this many like it in a text of the same length.
CHANCE = 0.05
#: Evidence is held to this range and gathered in steps of 1 / ``STEPS`` to fit the curve.
LEAST, MOST, STEPS = -8.0, 60.0, 4
CUTOFF = 0.7
#: Most labels that are sent to every task instead of shuffling the documents.
LABELS_SENT = 1_000_000


@dataclass(frozen=True)
class Model:
    """Scores of the tokens with proof for a class, the extreme-value law and the curve."""

    cells: np.ndarray
    scores: np.ndarray
    decay: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    offset: float = -math.inf


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the tokens of lower-cased texts, their text, and their spans in the text's bytes."""
    block = Block(texts, lower=True)
    words = block.words().trim(PUNCTUATION)
    cells = (words.hashes() >> np.uint64(42)).astype(np.int64)
    begin = block.starts[words.doc]
    return cells, words.doc, words.start - begin, words.end - begin


def count_tokens(labelled: DataFrame) -> DataFrame:
    """``cell, toxic, clean``: tokens of both classes in rows ``text, toxic``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for part in parts:
            classes = part.column("toxic").to_pylist()
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            for label in (0, 1):
                for rows in batches((None, t) for t, c in zip(texts, classes, strict=True) if c == label):
                    cells, n = np.unique(tokens([t for _, t in rows])[0], return_counts=True)
                    old = held.get(label, (np.empty(0, np.int64), np.empty(0, np.int64)))
                    both, at = np.unique(np.concatenate([old[0], cells]), return_inverse=True)
                    sums = np.bincount(at, weights=np.concatenate([old[1], n]), minlength=len(both))
                    held[label] = both, sums.astype(np.int64)
        for label, (cells, n) in held.items():
            none = np.zeros(len(cells), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array(n if label else none), pa.array(none if label else n)],
                ["cell", "toxic", "clean"],
            )

    return (
        labelled.select("text", "toxic")
        .mapInArrow(run, "cell long, toxic long, clean long")
        .groupBy("cell")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def scored_cells(counts: DataFrame) -> tuple[DataFrame, int, int]:
    """``counts`` with the score of each token before the drift, and the tokens of both classes."""
    sums = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    n_toxic, n_clean = sums["t"] or 0, sums["c"] or 0
    prior = PRIOR_SHARE * (n_toxic + n_clean)
    own = prior * (F.col("toxic") + F.col("clean")) / max(n_toxic + n_clean, 1)
    log_odds = lambda y, n: F.log((y + own) / (n + prior - y - own))
    delta = log_odds(F.col("toxic"), F.lit(n_toxic)) - log_odds(F.col("clean"), F.lit(n_clean))
    spread = F.sqrt(1 / (F.col("toxic") + own) + 1 / (F.col("clean") + own))
    above = F.greatest(F.lit(0.0), delta - DEVIATIONS * spread)
    bound = above + F.least(F.lit(0.0), delta + DEVIATIONS * spread)
    return counts.withColumn("score", bound), n_toxic, n_clean


def decay_of(scores: np.ndarray, chances: np.ndarray) -> float:
    """The positive root of the moment equation: expected exp(root * score) over clean tokens is 1."""
    low, high = 1e-3, 1e-3
    moment = lambda r: float(np.dot(chances, np.exp(np.minimum(r * scores, 700.0))))
    while moment(high) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 1 else (low, mid)
    return low


def segments(gains: np.ndarray, at: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first token, last token, score)`` of one text.

    ``gains`` are the scores less the drift of the tokens the model knows, at positions ``at``; every
    other token costs the drift. One pass keeps the candidates so far with the total before and after
    each and a link to the last one before it that starts lower. A new candidate follows the links to
    one that starts lower than itself and joins back to it if that reaches less far up; if none starts
    lower, no later token can join the candidates so far, so they are done. Each step of a search
    skips or removes candidates, so the time grows with the number of tokens.
    """
    found: list[tuple[int, int, float]] = []
    held: list[tuple[int, int, float, float, int]] = []
    after = np.cumsum(gains) - DRIFT * (at - np.arange(len(at)))
    up = np.flatnonzero(gains > 0)
    for i, begin, total in zip(at[up].tolist(), (after - gains)[up].tolist(), after[up].tolist(), strict=True):
        first, k = i, len(held) - 1
        while True:
            while k >= 0 and held[k][2] >= begin:
                k = held[k][4]
            if k < 0:
                found += [(a, b, right - low) for a, b, low, right, _ in held]
                held = [(first, i, begin, total, -1)]
                break
            if held[k][3] >= total:
                held.append((first, i, begin, total, k))
                break
            first, _, begin, _, link = held[k]
            del held[k:]
            k = link
    return found + [(a, b, right - low) for a, b, low, right, _ in held]


def passages(texts: list[bytes], model: Model) -> tuple[np.ndarray, list[list[dict]]]:
    """Tokens of each text and its maximal segments with spans in bytes."""
    cells, doc, start, end = tokens(texts)
    n = np.bincount(doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    found: list[list[dict]] = [[] for _ in texts]
    if len(cells) and len(model.cells):
        at = np.minimum(np.searchsorted(model.cells, cells), len(model.cells) - 1)
        hit = np.flatnonzero(model.cells[at] == cells)
        gains, owner = model.scores[at[hit]], doc[hit]
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        for d in np.unique(owner).tolist():
            own = slice(cuts[d], cuts[d + 1])
            for a, b, s in segments(gains[own], hit[own] - first[d]):
                span = {"start": int(start[first[d] + a]), "end": int(end[first[d] + b]), "score": s}
                found[d].append(span)
    return n, found


_SEGMENT = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
_SEGMENT_SQL = "array<struct<start:long,end:long,score:double>>"


def scan(docs: DataFrame, model: Model, carried: list[str]) -> DataFrame:
    """``carried`` columns of every row with ``n_tokens`` and ``segments``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            counts, found = [], []
            for rows in batches((None, t) for t in texts):
                n, own = passages([t for _, t in rows], shared.value)
                counts += n.tolist()
                found += own
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carried), pa.array(counts, pa.int64()), pa.array(found, _SEGMENT)],
                [*carried, "n_tokens", "segments"],
            )

    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    return docs.select(*carried, "text").mapInArrow(
        run, f"{fields}, n_tokens long, segments {_SEGMENT_SQL}"
    )


def evidence(scanned: DataFrame, model: Model) -> DataFrame:
    """Adds ``passages``, the significant segments with their normalised scores, and ``evidence``."""
    length = F.log(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"))
    normal = F.transform(
        "segments",
        lambda s: F.struct(
            s["start"],
            s["end"],
            s["score"],
            (model.decay * s["score"] - model.log_k - length).alias("normal"),
        ),
    )
    held = F.filter("found", lambda s: s["normal"] >= -math.log(CHANCE))
    best = F.array_max(F.transform("found", lambda s: s["normal"]))
    total = F.aggregate("passages", F.lit(0.0), lambda a, s: a + s["normal"])
    value = F.when(F.size("passages") > 0, total).otherwise(F.coalesce(best, F.lit(LEAST)))
    return (
        scanned.withColumn("found", normal)
        .withColumn("passages", held)
        .withColumn("evidence", F.greatest(F.lit(LEAST), F.least(F.lit(MOST), value)))
        .drop("found", "segments")
    )


def fit_curve(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through binned counts, with smoothed targets."""
    n1, n0 = toxic.sum(), clean.sum()
    top, bottom = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    n, want = toxic + clean, toxic * top + clean * bottom
    slope, offset = 0.0, math.log((n1 + 1) / (n0 + 1))

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float(np.sum(n * np.logaddexp(0, z) - want * z)) + 1e-6 * a * a

    here = loss(slope, offset)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -500, 500)))
        g = np.array([np.dot(n * p - want, x) + 2e-6 * slope, np.sum(n * p - want)])
        v = n * p * (1 - p)
        h = np.array([[np.dot(v, x * x) + 2e-6, np.dot(v, x)], [np.dot(v, x), v.sum() + 1e-9]])
        move, size = np.linalg.solve(h, g), 1.0
        while size > 1e-8 and loss(slope - size * move[0], offset - size * move[1]) > here:
            size /= 2
        slope, offset = slope - size * move[0], offset - size * move[1]
        before, here = here, loss(slope, offset)
        if before - here < 1e-10 * max(1.0, here):
            break
    return slope, offset


def extreme_value_offset(seen: DataFrame, decay: float) -> float:
    """The law's log ``K``: clean texts have a significant passage with the chance ``CHANCE``."""
    best = F.array_max(F.transform("segments", lambda s: s["score"]))
    top = decay * best - F.log(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"))
    clean = seen.where("toxic = 0")
    n = clean.agg(F.count("*").alias("n"), F.count_if(F.size("segments") > 0).alias("k")).first()
    if not n["k"]:
        return 0.0
    level = max(0.0, 1 - CHANCE * n["n"] / n["k"])
    quantile = clean.where(F.size("segments") > 0).agg(F.percentile_approx(top, level, 10_000)).first()
    return quantile[0] + math.log(-math.log(1 - CHANCE))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled documents outside the held-out fold, all of them."""
    given = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(~fold(F.col("doc_id"), *FOLD) & F.col("toxic").isin(0, 1))
    )
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    firsts = pin(
        plain.join(if_small(given, LABELS_SENT), "doc_id")
        .groupBy(F.xxhash64("text").alias("h"), "toxic")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id", "toxic"),
        "labelled",
    )
    labelled = plain.join(if_small(firsts, LABELS_SENT), "doc_id")
    counts, n_toxic, n_clean = scored_cells(pin(count_tokens(labelled), "cells"))
    none = Model(np.empty(0, np.int64), np.empty(0))
    if not n_toxic or not n_clean:
        return none
    proven = counts.where(F.col("score") != 0).orderBy("cell").toArrow()  # CELLS rows at most
    scores = proven["score"].to_numpy() - DRIFT
    chances = proven["clean"].to_numpy() / n_clean
    spread = np.append(scores, -DRIFT), np.append(chances, 1 - chances.sum())
    model = Model(proven["cell"].to_numpy(), scores, decay_of(*spread))
    seen = pin(scan(labelled, model, ["toxic"]), "segments")
    log_k = extreme_value_offset(seen, model.decay)
    model = Model(model.cells, model.scores, model.decay, log_k)
    step = F.round(F.col("evidence") * STEPS)
    bins = (
        evidence(seen, model)
        .groupBy(step.alias("bin"))
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .collect()  # one row per step of the evidence's range at most
    )
    slope, offset = fit_curve(
        np.array([b["bin"] / STEPS for b in bins]),
        np.array([float(b["toxic"]) for b in bins]),
        np.array([float(b["clean"]) for b in bins]),
    )
    return Model(model.cells, model.scores, model.decay, log_k, slope, offset)


def detect(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, passages, evidence`` of every row."""
    marked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = evidence(scan(marked, model, ["doc_id"]), model)
    curve = 1 / (1 + F.exp(-(model.slope * F.col("evidence") + model.offset)))
    score = curve if math.isfinite(model.offset) else F.lit(0.0)
    return found.select(
        "doc_id",
        fold(F.col("doc_id"), *FOLD).alias("held_out"),
        score.alias("score"),
        (score >= CUTOFF).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
        "passages",
        "evidence",
    )


def digest(detected: DataFrame) -> DataFrame:
    """The columns of the query."""
    return detected.select("doc_id", "held_out", "score", "predicted", "n_passages")
