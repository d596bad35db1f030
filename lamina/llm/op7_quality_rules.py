"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule compares one measure of a text with a cutoff. Cutoffs are not hand-set: for every stratum
(the document's language) and rule, candidate cutoffs are tested from the mildest on against the
labelled good documents. A cutoff is taken only while the exact binomial test rejects "more than
``MAX_FALSE_REJECTION`` of the good documents of this stratum fail it" at level ``ERROR`` divided by
the number of stratum-rule pairs (Bonferroni). The tests of one pair form a fixed sequence that ends
at the first failure, so with probability ``1 - ERROR`` all chosen cutoffs keep their promise. A pair
with too few labels gets no cutoff and rejects nothing.

With ``pooled``, strata too small for any test of their own share cutoffs tested on all their good
documents together; the rules of the pool count in the same Bonferroni total. Which strata are small
follows from the number of their good documents alone. The promise then holds for the pool: one
language in it may lose more than ``MAX_FALSE_REJECTION``. A stratum without a good document is in
no pool. ``accepted``, the pipeline's stage, pools; ``quality_rules`` does not unless told to, since
the query ``op7_quality`` must equal its SQL, which tests every stratum by itself.

Defined results: a null text has no words and fails the base rule; an empty table gives an empty
result; labels without a document, with a null quality or for a null id are ignored, and a document
labelled more than once counts as good only if every label says so. A null language is a stratum.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import if_small, pin

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Largest share of good documents that one rule may reject in a stratum, and the chance that any
#: of the chosen cutoffs breaks that promise.
MAX_FALSE_REJECTION, ERROR = 0.005, 0.05
#: Most labels that are sent to every task instead of shuffling the documents.
LABELS_SENT = 1_000_000
#: Candidate cutoffs of each rule, mildest first. A document fails when its measure is above.
CUTOFFS = {
    "symbol_share": (0.5, 0.3, 0.2, 0.1, 0.05, 0.02),
    "shout_share": (0.9, 0.7, 0.5, 0.3, 0.2),
    "dup_line_share": (0.8, 0.6, 0.4, 0.3, 0.2),
    "repeat_share": (0.18, 0.15, 0.12, 0.1),
    "mean_word_excess": (20.0, 15.0, 10.0, 8.0),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def _covered(hits: Column) -> Column:
    """Words covered by windows that start at the given ascending positions."""
    return F.aggregate(
        F.transform(
            F.sequence(F.lit(2), F.size(hits)),
            lambda i: F.least(F.lit(WINDOW), F.element_at(hits, i) - F.element_at(hits, i - 1)),
        ),
        F.lit(WINDOW),
        lambda total, step: total + step,
    )


def _covered_or_none(hits: Column) -> Column:
    return (
        F.when(F.size(hits) == 0, F.lit(0))
        .when(F.size(hits) == 1, F.lit(WINDOW))
        .otherwise(_covered(hits))
    )


def _repeated_positions(keys: Column) -> Column:
    """Ascending start positions of the windows whose key occurs twice or more."""

    def hits(pairs: Column) -> Column:
        marked = F.filter(
            pairs,
            lambda p, i: (F.get(pairs, i - 1)["key"] == p["key"]).eqNullSafe(True)
            | (F.get(pairs, i + 1)["key"] == p["key"]).eqNullSafe(True),
        )
        return F.sort_array(F.transform(marked, lambda p: p["at"]))

    pairs = F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at")))
    return let(F.sort_array(pairs), hits)


def repeat_words(words: Column) -> Column:
    """Words inside a five-word window that the text holds twice or more."""

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))),
        )

    def count(keys: Column) -> Column:
        several = F.size(F.array_distinct(keys)) < F.size(keys)
        return F.when(several, let(_repeated_positions(keys), _covered_or_none)).otherwise(F.lit(0))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    enough = F.size(words) >= WINDOW
    return F.when(enough, let(let(hashes, windows), count)).otherwise(F.lit(0)).cast("long")


def _line_counts(text: Column) -> Column:
    """Lines with a word, and those equal to an earlier one."""

    def count(lines: Column) -> Column:
        again = F.size(lines) - F.size(F.array_distinct(lines))
        return F.struct(F.size(lines).alias("n"), again.cast("long").alias("again"))

    with_word = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")
    return let(with_word, count)


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with ``m``, a struct of the base counts and of the measure of every rule."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: (F.upper(w) == w) & (F.lower(w) != w)))
            .cast("long")
            .alias("n_shouted"),
        )

    chars = F.char_length(F.translate(text, SPACES, "")).cast("long")
    symbols = (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long")
    counted = docs.select("*", let(words_of(text), of).alias("m_words"), _line_counts(text).alias("m_lines"))
    n = F.col("m_words.n_words")
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    m = F.struct(
        n.alias("n_words"),
        chars.alias("word_chars"),
        symbols.alias("n_symbols"),
        F.col("m_lines.again").alias("n_dup_lines"),
        F.col("m_words.n_repeat_words").alias("n_repeat_words"),
        share(symbols, chars).alias("symbol_share"),
        share(F.col("m_words.n_shouted"), n).alias("shout_share"),
        share(F.col("m_lines.again"), F.col("m_lines.n")).alias("dup_line_share"),
        share(F.col("m_words.n_repeat_words"), n).alias("repeat_share"),
        share(chars, n).alias("mean_word_excess"),
    )
    return counted.withColumn("m", m).drop("m_words", "m_lines")


def base_failed() -> Column:
    """The fixed rule: too few words, or too many of them in repeated windows."""
    m = F.col("m")
    return (m["n_words"] < MIN_WORDS) | (
        100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of n trials with chance p, exact, summed from the largest term down.

    Meant for ``k <= n * p``, where the terms fall towards zero successes; 1 above that.
    """
    log_gamma = lambda x: (  # noqa: E731  Stirling's series, shifted by 8
        (x + 7.5) * F.log(x + 8)
        - (x + 8)
        + 0.5 * F.log(F.lit(2 * 3.141592653589793))
        + 1 / (12 * (x + 8))
        - 1 / (360 * F.pow(x + 8, 3))
        + 1 / (1260 * F.pow(x + 8, 5))
        - reduce(lambda a, b: a + b, (F.log(x + i) for i in range(8)))
    )
    top = (
        log_gamma(n + 1.0)
        - log_gamma(k + 1.0)
        - log_gamma(n - k + 1.0)
        + k * F.log(F.lit(p))
        + (n - k) * F.log(F.lit(1 - p))
    )
    odds = (1 - p) / p
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * i * F.lit(odds) / (n - i + 1)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(k > 0, F.sequence(k, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    total = F.aggregate(steps, start, add, lambda acc: acc["total"])
    return F.when(k <= n * p, F.least(F.lit(1.0), F.exp(top) * total)).otherwise(F.lit(1.0))


def choose_cutoffs(measured: DataFrame, labels: DataFrame, pooled: bool = False) -> DataFrame:
    """``stratum, rule, cutoff, n_good, n_rejected, p_value`` of every cutoff that passed its test.

    ``measured`` holds ``doc_id, lang, m``. One row per stratum and rule at most; the counts and the
    p-value of a pooled stratum are those of the pool.
    """
    good = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .select("doc_id")
    )
    # No filter on the measures: it would be moved below the join and computed for every text.
    kept = measured.join(if_small(good, LABELS_SENT), "doc_id", "left_semi")
    tests = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.lit(step).alias("step"),
                    F.lit(cutoff).alias("cutoff"),
                    (F.col("m")[rule] > F.lit(cutoff)).alias("rejected"),
                )
                for rule, cutoffs in CUTOFFS.items()
                for step, cutoff in enumerate(cutoffs)
            )
        )
    )
    counts = (
        kept.select(F.col("lang").alias("stratum"), (~base_failed()).alias("passed"), tests.alias("t"))
        .groupBy("stratum", "t.rule", "t.step", "t.cutoff")
        .agg(
            F.count_if("passed").alias("n_good"),
            F.count_if(F.col("passed") & F.col("t.rejected")).alias("n_rejected"),
        )
    )
    every = F.collect_list(F.struct("stratum", "rule", "step", "cutoff", "n_good", "n_rejected"))
    pairs = F.array_distinct(F.transform("every", lambda t: F.struct(t["stratum"], t["rule"])))
    n_tests = F.size(pairs) + (len(CUTOFFS) if pooled else 0)
    # Without a single rejection the chance is (1 - MAX_FALSE_REJECTION) ** n_good.
    least = F.col("n_good") * math.log(1 - MAX_FALSE_REJECTION) + F.log("n_tests")
    small = (F.col("n_good") > 0) & (least > math.log(ERROR)) if pooled else F.lit(False)
    tested = (
        counts.agg(every.alias("every"))  # one small row: strata times rules times cutoffs
        .select(n_tests.alias("n_tests"), F.explode("every").alias("t"))
        .select("n_tests", "t.*")
        .withColumn("small", small)
        .groupBy("small", F.when(~F.col("small"), F.col("stratum")).alias("own"), "rule", "step", "cutoff")
        .agg(
            F.first("n_tests").alias("n_tests"),
            F.sum("n_good").alias("n_good"),
            F.sum("n_rejected").alias("n_rejected"),
            F.collect_list(F.struct("stratum")).alias("members"),
        )
        .withColumn(
            "p_value", binomial_tail(F.col("n_rejected"), F.col("n_good"), MAX_FALSE_REJECTION)
        )
    )
    passed = F.col("p_value") * F.col("n_tests") <= ERROR
    first_failure = F.min(F.when(~passed, F.col("step")))
    ends = tested.groupBy("small", "own", "rule").agg(
        F.coalesce(first_failure, F.lit(1_000_000)).alias("stop"),
        F.collect_list(F.struct("step", "cutoff", "n_good", "n_rejected", "p_value")).alias("seq"),
        F.first("members").alias("members"),
    )
    last = F.array_max(F.filter("seq", lambda s: s["step"] < F.col("stop")))
    chosen = ends.withColumn("s", last).where("s is not null")
    return chosen.select(F.explode("members").alias("member"), "rule", "s").select(
        "member.stratum", "rule", "s.*"
    )


def verdicts(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed``, the rules that a row breaks and ``kept``.

    The cutoffs are one map per stratum; a stratum without any rejects by the base rule only.
    """
    per_stratum = cutoffs.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits")
    )
    joined = measured.join(
        if_small(per_stratum), measured["lang"].eqNullSafe(per_stratum["stratum"]), "left"
    ).drop("stratum")
    broken = F.array_compact(
        F.array(
            *(
                F.when(F.col("m")[rule] > F.element_at("limits", rule), F.lit(rule))
                for rule in CUTOFFS
            )
        )
    )
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("broken", broken)
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
        .drop("limits")
    )


def calibrate(docs: DataFrame, labels: DataFrame, pooled: bool = False) -> DataFrame:
    """The cutoffs learnt from the labelled documents, a few rows per language, computed once."""
    held = docs.select("doc_id", "lang", "text").join(
        if_small(labels.where("quality = 1").select("doc_id").distinct(), LABELS_SENT),
        "doc_id",
        "left_semi",
    )
    measured = measures(held).select("doc_id", "lang", "m")
    return pin(choose_cutoffs(measured, labels, pooled), "cutoffs")


def quality_rules(docs: DataFrame, labels: DataFrame, pooled: bool = False) -> DataFrame:
    """``docs`` with ``m``, ``base_failed``, ``broken`` and ``kept`` of every row."""
    return verdicts(measures(docs), calibrate(docs, labels, pooled))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, small strata pooled, with its columns only."""
    verdict = F.struct("*").alias("doc")
    judged = quality_rules(docs.select("doc_id", "lang", "text", verdict), labels, pooled=True)
    return judged.where("kept").select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))


def digest(judged: DataFrame) -> DataFrame:
    """The columns of the query."""
    return judged.select(
        "doc_id",
        "m.n_words",
        "m.word_chars",
        "m.n_symbols",
        "m.n_dup_lines",
        "m.n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("broken", ",").alias("broken_rules"),
    )
