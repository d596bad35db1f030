"""Language identification by hierarchy: the family first, then one-versus-one linear machines.

A text becomes the shares of its hashed letter runs (one to four bytes of lower-cased letters, words
set apart by one space), square-rooted, so that every text has length one whatever its size. One
linear support vector machine per family tells it from the others; inside the chosen family every
pair of languages has its own machine and the language with most votes wins.

The machines are trained from at most about ``SAMPLE`` labelled documents per language, chosen by a
hash of their id and text, all their text counted; each machine trains in a task of its own on
``ROWS`` rows at most, with many languages the first of each by that hash. The ``LANGUAGES`` codes
with most labels are learnt, so that misspelt codes stay bounded. The model has one vector per family
and pair and is sent to every task.

Defined results: ``und`` with score 0 if the text is null or has no letter, or if nothing was
learnt; a language missing from the table of families is a family of its own; a null ``doc_id`` is
not held out; documents without a language teach nothing; an empty table gives an empty result.
Other columns are ignored. Inputs of a prediction are texts alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import fold, pin
from lamina.llm.textops import batches, mix

FOLD = (4, 2)
#: Length of a vector, runs counted in it, documents per language and rows per machine.
CELLS, RUNS = 1 << 12, (1, 2, 3, 4)
SAMPLE, ROWS, LANGUAGES = 600, 4_000, 200
PASSES, COST, SHARPNESS = 30, 10.0, 4.0
UNKNOWN = "und"
#: Families of language codes (fixed values).
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "yi", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "cy", "gd", "br"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk", "tt"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne", "si"),
    "semitic": ("ar", "he", "am", "mt"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "malayic": ("id", "ms", "jv", "tl"),
    "sinitic": ("zh", "yue"),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0], f"={lang}")


def letters(text: str | None) -> bytes:
    """The lower-cased letters of a text, other characters as one space; empty without a letter."""
    if not text:
        return b""
    kept = "".join([c if c.isalpha() else " " for c in text.lower()])
    words = kept.split()
    return (" " + " ".join(words) + " ").encode("utf-8", "replace") if words else b""


def vectors(texts: list[bytes]) -> np.ndarray:
    """One row per text: square roots of the shares of its letter runs."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    counts = np.zeros(len(texts) * CELLS, dtype=np.int64)
    run = np.zeros(len(data), dtype=np.uint64)
    for n in range(1, max(RUNS) + 1):
        run = ((run[: len(data) - n + 1] << np.uint64(8)) | data[n - 1 :]) if n > 1 else data
        if len(run) == 0 or n not in RUNS:
            continue
        inside = doc[: len(run)] == doc[n - 1 :]
        cell = mix(run + np.uint64(n << 40)) >> np.uint64(52)
        at = doc[: len(run)] * CELLS + cell.astype(np.int64)
        counts += np.bincount(at[inside], minlength=len(counts))
    table = counts.reshape(len(texts), CELLS).astype(np.float32)
    return np.sqrt(table / np.maximum(table.sum(axis=1, keepdims=True), 1))


@dataclass(frozen=True)
class Model:
    """Languages by family, a vector and offset per family, and per pair inside a family."""

    families: tuple[tuple[str, ...], ...]
    pairs: tuple[tuple[int, str, str], ...]
    weights: np.ndarray


def train_machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and offset of a linear support vector machine, by dual coordinate descent.

    Both classes weigh the same in total. Squared hinge loss; rows are visited in a fixed order.
    """
    n, width = x.shape
    share = np.where(y > 0, max((y > 0).sum(), 1), max((y < 0).sum(), 1))
    diagonal = 0.5 / (COST * n / (2.0 * share))
    alpha, w = np.zeros(n), np.zeros(width + 1)
    rows = np.hstack([x.astype(np.float64), np.ones((n, 1))])
    square = (rows**2).sum(axis=1) + diagonal
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        worst = 0.0
        for i in order.permutation(n):
            slope = y[i] * rows[i].dot(w) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - slope / square[i], 0.0)
            if new != alpha[i]:
                worst = max(worst, abs(new - alpha[i]))
                w += (new - alpha[i]) * y[i] * rows[i]
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def predict(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    plain = [letters(t) for t in texts]
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(plain) if t]
    if not known or not model.families:
        return langs, scores
    x = vectors([plain[i] for i in known])
    values = x @ model.weights[:, :-1].T.astype(np.float32) + model.weights[:, -1].astype(np.float32)
    n = len(model.families)
    best = values[:, :n].argmax(axis=1)
    raised = np.exp(SHARPNESS * (values[:, :n] - values[:, :n].max(axis=1, keepdims=True)))
    chance = raised[np.arange(len(known)), best] / raised.sum(axis=1)
    for row, i in enumerate(known):
        own = model.families[best[row]]
        votes = dict.fromkeys(own, 0.0)
        sure = dict.fromkeys(own, 1.0)
        for k, (f, a, b) in enumerate(model.pairs):
            if f == best[row]:
                p = 1 / (1 + np.exp(-SHARPNESS * float(values[row, n + k])))
                votes[a if p >= 0.5 else b] += 1
                sure[a] = min(sure[a], p)
                sure[b] = min(sure[b], 1 - p)
        lang = max(own, key=lambda c: (votes[c], sure[c]))
        langs[i], scores[i] = lang, float(min(1.0, chance[row] * sure[lang]))
    return langs, scores


def _sampled(docs: DataFrame) -> DataFrame:
    """About ``SAMPLE`` training documents per language, all where there are fewer, with their draw."""
    given = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(
        ~fold(F.col("doc_id"), *FOLD)
    )
    counts = given.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {r["lang"]: r["n"] for r in counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, SAMPLE / n))).otherwise(rate)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return given.select("lang", "text", draw.alias("draw")).where(F.col("draw") < rate)


def _featured(sample: DataFrame) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            plain = [letters(t) for t in part.column("text").to_pylist()]
            known = zip(part.column("lang").to_pylist(), part.column("draw").to_pylist(), strict=True)
            rows = [(k, t) for k, t in zip(known, plain, strict=True) if t]
            for group in batches(iter(rows)):
                x = vectors([t for _, t in group])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang for (lang, _), _ in group], pa.string()),
                        pa.array([draw for (_, draw), _ in group], pa.float64()),
                        pa.array([v.tobytes() for v in x], pa.binary()),
                    ],
                    ["lang", "draw", "x"],
                )

    return sample.mapInArrow(run, "lang string, draw double, x binary")


def train(docs: DataFrame) -> Model:
    """The machines of the languages of ``docs`` (``doc_id, text, lang``) outside the fold."""
    drawn = _featured(_sampled(docs))
    # About ``SAMPLE`` rows a language, numbered by their draw.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "x")).alias("place")
    rows = pin(drawn.select("lang", "x", place), "language-sample")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    names = sorted({family_of(c) for c in langs})
    families = tuple(tuple(c for c in langs if family_of(c) == f) for f in names)
    pairs = tuple(
        (f, a, b)
        for f, own in enumerate(families)
        for i, a in enumerate(own)
        for b in own[i + 1 :]
    )
    if not langs:
        return Model((), (), np.empty((0, CELLS + 1)))
    uses = {c: [] for c in langs}
    for f, own in enumerate(families):
        for c in langs:
            uses[c].append((f, 1 if c in own else -1))
    for k, (_, a, b) in enumerate(pairs):
        uses[a].append((len(families) + k, 1))
        uses[b].append((len(families) + k, -1))
    per_language = max(1, ROWS // len(langs))

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = (part.column(c).to_pylist() for c in ("lang", "x", "place"))
            # All languages meet in the machines of families: fewer rows of each.
            made = [
                (m, y, c, v)
                for c, v, k in zip(*columns, strict=True)
                for m, y in uses[c]
                if m >= len(families) or k <= per_language
            ]
            if made:
                columns = list(zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int32()),
                        pa.array(columns[1], pa.int32()),
                        pa.array(columns[2]),
                        pa.array(columns[3], pa.binary()),
                    ],
                    ["machine", "y", "lang", "x"],
                )

    def fit(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table[c].to_pylist() for c in ("lang", "x", "y")), strict=True))
        machine = table["machine"][0].as_py()
        x = np.array([np.frombuffer(v, dtype=np.float32) for _, v, _ in rows])
        y = np.array([float(v) for _, _, v in rows])
        return pa.table(
            {"machine": pa.array([machine], pa.int32()), "w": pa.array([train_machine(x, y).tobytes()], pa.binary())}
        )

    trained = (
        rows.mapInArrow(spread, "machine int, y int, lang string, x binary")
        .groupBy("machine")
        .applyInArrow(fit, "machine int, w binary")
        .collect()  # a vector per family and pair
    )
    weights = np.zeros((len(families) + len(pairs), CELLS + 1))
    for r in trained:
        weights[r["machine"]] = np.frombuffer(r["w"])
    return Model(families, pairs, weights)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    marked = docs.select(
        "doc_id", fold(F.col("doc_id"), *FOLD).alias("held_out"), F.col("text").cast("string").alias("text")
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            langs, scores = [], []
            texts = part.column("text").to_pylist()
            for group in batches((t, t or "") for t in texts):
                found = predict([t for t, _ in group], shared.value)
                langs += found[0]
                scores += found[1]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = marked.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
