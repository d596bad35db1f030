"""Byte language model by context-tree weighting, trained and applied over the whole corpus.

A byte is eight binary decisions, each a node of a tree over the decisions before it. Every node has
one estimator per context depth, from none to the ``DEPTH`` bytes before: the Krichevsky-Trofimov
estimate of its training counts. Weighting mixes the depths: the weighted probability of a node is
half its own estimate plus half the product over its longer contexts, so a node's weight says how
well its depth coded the training text. A text's score is the sum of the log probabilities of its
bytes and of one end mark, each from the weighted mixture along its path.

1. Training documents are counted as ``DEPTH`` + 1 bytes: the context and the byte it led to.
   Documents kept from training add their strings with a count of zero; a node without counts
   estimates one half and changes no weight, and every path that scoring needs is then in the tree.
2. The tree is built level by level, from the longest context up (counts and weights), then down
   (mixtures): subtrees of a bounded size in shards, the levels above them as grouped and joined
   tables. All of it grows with the distinct strings of the corpus.
3. Each bucket of documents asks for the values of its distinct strings and adds them up.

The same exchange answers word counts for the unigram base score.

Defined results: a null text is empty and scores its end mark; a null ``doc_id`` is not held out;
repeated rows count as often as they stand; an empty table gives an empty result; without training
documents every estimate is one half; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm import exchange as x
from lamina.llm.common import fold, pin
from lamina.llm.textops import Block, Table, batches

#: Bytes of context at the deepest level; context and byte must fit 63 bits.
DEPTH = 5
#: Bytes of context down to which the tree's levels are tables; longer ones are subtrees of a shard.
SPLIT = 3
END = 0xFF
GRAM, WORD = 0, 1
FOLD = (7, 2)
#: Distinct strings that a counting task holds before it passes its counts on.
HELD = 1_500_000


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Context and byte of every position, the end mark included, and the first of each text.

    Contexts reach back into zero bytes before a text's start.
    """
    pad = bytes(DEPTH)
    data = np.frombuffer(pad + b"".join([t + bytes([END]) + pad for t in texts]), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + DEPTH)))[:-1] + DEPTH
    keys = np.zeros(len(data) - DEPTH, dtype=np.uint64)
    for back in range(DEPTH, -1, -1):
        keys <<= np.uint64(8)
        keys |= data[DEPTH - back : len(data) - back]
    coded = np.ones(len(keys) + DEPTH + 1, dtype=bool)
    ends = starts - DEPTH + sizes
    for k in range(DEPTH):
        coded[ends + k] = False
    return keys[coded[: len(keys)]], np.concatenate(([0], np.cumsum(sizes)))[:-1]


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words of lower-cased texts, the first word of each text and their counts."""
    words = Block(texts, lower=True).words()
    return words.hashes() >> np.uint64(2), words.first, words.counts


def _add(held: dict[int, list], kind: int, keys: np.ndarray, counted: bool) -> None:
    values, counts = np.unique(keys, return_counts=True)
    held[kind].append((values, counts if counted else np.zeros_like(counts)))


def _merged(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in pairs])
    counts = np.concatenate([c for _, c in pairs])
    values, at = np.unique(keys, return_inverse=True)
    return values, np.bincount(at, weights=counts, minlength=len(values)).astype(np.int64)


def count_strings(docs: DataFrame) -> DataFrame:
    """``kind, key, n``: partial counts of strings and words in training documents.

    Rows with ``held_out`` true add their strings with a count of zero.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {GRAM: [], WORD: []}

        def passed(kind: int) -> pa.RecordBatch:
            keys, counts = _merged(held[kind])
            held[kind] = []
            kinds = pa.array(np.full(len(keys), kind, dtype=np.int32))
            return pa.RecordBatch.from_arrays(
                [kinds, pa.array(keys.astype(np.int64)), pa.array(counts)], ["kind", "key", "n"]
            )

        for part in parts:
            out = part.column("held_out").to_pylist()
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            for apart in (False, True):
                own = ((None, t) for t, o in zip(texts, out, strict=True) if o is apart)
                for rows in batches(own):
                    block = [t for _, t in rows]
                    _add(held, GRAM, grams(block)[0], not apart)
                    if not apart:
                        _add(held, WORD, word_keys(block)[0], True)
            for kind in held:
                if sum(len(k) for k, _ in held[kind]) > HELD:
                    merged = _merged(held[kind])
                    held[kind] = [merged]
                    if len(merged[0]) > HELD // 2:
                        yield passed(kind)
        for kind in held:
            if held[kind]:
                yield passed(kind)

    return docs.select("held_out", "text").mapInArrow(run, "kind int, key long, n long")


class _Level:
    """One of the eight decisions of a byte, at all context depths from ``SPLIT`` to ``DEPTH``.

    A node is named by the context and the decisions so far, as one number; ``names[d]`` holds the
    ascending nodes of depth ``d`` and ``up[d]`` where each one's shorter context stands below it.
    """

    def __init__(self, step: int, keys: np.ndarray, n: np.ndarray):
        ahead = np.uint64(8 - step)
        bit = (keys >> (ahead - np.uint64(1))) & np.uint64(1)
        self.bit = bit.astype(bool)
        self.names, self.n0, self.n1, self.up = {}, {}, {}, {}
        name = keys >> ahead
        self.names[DEPTH], self.of = np.unique(name, return_inverse=True)
        size = len(self.names[DEPTH])
        self.n0[DEPTH] = np.bincount(self.of, weights=n * ~self.bit, minlength=size)
        self.n1[DEPTH] = np.bincount(self.of, weights=n * self.bit, minlength=size)
        for d in range(DEPTH - 1, SPLIT - 1, -1):
            short = self.names[d + 1] & np.uint64((1 << 8 * d + step) - 1)
            self.names[d], self.up[d + 1] = np.unique(short, return_inverse=True)
            size = len(self.names[d])
            self.n0[d] = np.bincount(self.up[d + 1], weights=self.n0[d + 1], minlength=size)
            self.n1[d] = np.bincount(self.up[d + 1], weights=self.n1[d + 1], minlength=size)
        self.weigh()

    def weigh(self) -> None:
        """Weighted log probabilities from the longest contexts up, and each node's own weight."""
        self.lw, self.w = {}, {}
        self.lw[DEPTH] = estimate(self.n0[DEPTH], self.n1[DEPTH])
        self.w[DEPTH] = np.ones(len(self.lw[DEPTH]))
        for d in range(DEPTH - 1, SPLIT - 1, -1):
            own = estimate(self.n0[d], self.n1[d])
            below = np.bincount(self.up[d + 1], weights=self.lw[d + 1], minlength=len(own))
            self.lw[d] = np.logaddexp(own, below) - math.log(2)
            self.w[d] = np.exp(own - self.lw[d] - math.log(2))

    def mix(self, p1: np.ndarray, rem: np.ndarray) -> np.ndarray:
        """Log10 probability of every string's decision, from the mixtures down to ``SPLIT``."""
        for d in range(SPLIT + 1, DEPTH + 1):
            p1, rem = p1[self.up[d]], rem[self.up[d]]
            one = (self.n1[d] + 0.5) / (self.n0[d] + self.n1[d] + 1.0)
            p1, rem = p1 + rem * self.w[d] * one, rem * (1 - self.w[d])
        chance = p1[self.of]
        return np.log10(np.where(self.bit, chance, 1 - chance))


def log_gamma(v: np.ndarray) -> np.ndarray:
    """Stirling's series, shifted by 8 so that it holds from one half on."""
    s = v + 8
    shift = np.log(v * (v + 1) * (v + 2) * (v + 3)) + np.log((v + 4) * (v + 5) * (v + 6) * (v + 7))
    series = 1 / (12 * s) - 1 / (360 * s**3) + 1 / (1260 * s**5)
    return (s - 0.5) * np.log(s) - s + 0.5 * math.log(2 * math.pi) + series - shift


def estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of ``n0`` zeros and ``n1`` ones."""
    log = log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)
    return np.where(n0 + n1 == 0, 0.0, log)


def _estimate() -> Column:
    """``estimate`` of the columns ``n0`` and ``n1``."""

    def log_gamma_of(v: Column) -> Column:
        s = v + 8
        shift = reduce(lambda a, b: a + b, [F.log(v + i) for i in range(8)])
        series = 1 / (12 * s) - 1 / (360 * F.pow(s, 3)) + 1 / (1260 * F.pow(s, 5))
        return (s - 0.5) * F.log(s) - s + 0.5 * math.log(2 * math.pi) + series - shift

    n0, n1 = F.col("n0"), F.col("n1")
    log = log_gamma_of(n0 + 0.5) + log_gamma_of(n1 + 0.5) - log_gamma_of(n0 + n1 + 1.0)
    return F.when(n0 + n1 == 0, F.lit(0.0)).otherwise(log - math.log(math.pi))


def _log_mean(a: Column, b: Column) -> Column:
    """Log of the mean of two probabilities given by their logs."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b))) - math.log(2)


NODES = "shard int, step int, name long, n0 double, n1 double, lw double"


def build_tree(strings: DataFrame, shards: int) -> DataFrame:
    """``key, value``: the weighted log10 probability of every string's last byte.

    ``strings`` holds ``key, n``, one row per distinct string of context and byte. Subtrees below
    contexts of ``SPLIT`` bytes are dealt to shards; one such subtree has at most
    256 ** (``DEPTH`` - ``SPLIT`` + 1) strings. Above them the levels are grouped and joined tables.
    """
    root = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * SPLIT) - 1))
    dealt = strings.select((root % x.SHARD_PRIME % shards).cast("int").alias("shard"), "key", "n")

    def steps(table: pa.Table) -> Iterator[tuple[int, _Level]]:
        keys = table["key"].to_numpy().astype(np.uint64)
        n = table["n"].to_numpy().astype(float)
        for step in range(8):
            yield step, _Level(step, keys, n)

    def climb(table: pa.Table) -> pa.Table:
        out = []
        for step, level in steps(table):
            names = level.names[SPLIT]
            out.append(
                pa.table(
                    {
                        "shard": np.full(len(names), table["shard"][0].as_py(), dtype=np.int32),
                        "step": np.full(len(names), step, dtype=np.int32),
                        "name": names.astype(np.int64),
                        "n0": level.n0[SPLIT],
                        "n1": level.n1[SPLIT],
                        "lw": level.lw[SPLIT],
                    }
                )
            )
        return pa.concat_tables(out)

    def descend(table: pa.Table, above: pa.Table) -> pa.Table:
        value = np.zeros(table.num_rows)
        step_of, name_of = above["step"].to_numpy(), above["name"].to_numpy().astype(np.uint64)
        p1, rem = above["p1"].to_numpy(), above["rem"].to_numpy()
        for step, level in steps(table):
            own = np.flatnonzero(step_of == step)
            own = own[np.argsort(name_of[own])]
            value += level.mix(p1[own], rem[own])
        return pa.table({"key": table["key"], "value": value})

    def up(nodes: DataFrame, depth: int) -> DataFrame:
        return (
            nodes.groupBy("step", _shorter(depth).alias("name"))
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("lw").alias("below"))
            .withColumn("pe", _estimate())
            .withColumn("lw", _log_mean(F.col("pe"), F.col("below")))
            .withColumn("w", F.exp(F.col("pe") - F.col("lw") - math.log(2)))
            .drop("below")
        )

    one = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    subtrees = pin(dealt.groupBy("shard").applyInArrow(climb, NODES), "subtrees")
    own = F.exp(_estimate() - F.col("lw") - math.log(2))
    levels = [subtrees.withColumn("w", F.least(F.lit(1.0), own))]
    for depth in range(SPLIT - 1, -1, -1):
        levels.insert(0, up(levels[0], depth))
    mixed = levels[0].select(
        "step", "name", (F.col("w") * one).alias("p1"), (1 - F.col("w")).alias("rem")
    )
    for depth in range(1, SPLIT + 1):
        above = mixed.select(
            "step",
            F.col("name").alias("up"),
            F.col("p1").alias("p1_up"),
            F.col("rem").alias("rem_up"),
        )
        mixed = (
            levels[depth]
            .withColumn("up", _shorter(depth - 1))
            .join(above, ["step", "up"])
            .withColumn("p1", F.col("p1_up") + F.col("rem_up") * F.col("w") * one)
            .withColumn("rem", F.col("rem_up") * (1 - F.col("w")))
            .select(*(["shard"] if depth == SPLIT else []), "step", "name", "p1", "rem")
        )
    return (
        dealt.groupBy("shard")
        .cogroup(mixed.groupBy("shard"))
        .applyInArrow(descend, "key long, value double")
    )


def _shorter(depth: int) -> Column:
    """The name of a node's counterpart with the last ``depth`` bytes of its context."""
    return F.expr(f"name & (shiftleft(1L, step + {8 * depth}) - 1)")


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out`` and the base and model scores of every row of ``docs``.

    ``code_bits_per_byte`` is the model's code length over the bytes of the text and its end mark.
    """
    marked = docs.select("doc_id", "text").withColumn("held_out", fold(F.col("doc_id"), *FOLD))
    dealt = x.deal(marked)
    shards = dealt.buckets
    counted = pin(
        count_strings(marked).groupBy("kind", "key").agg(F.sum("n").alias("n")), "strings"
    )
    words = counted.where(f"kind = {WORD}").select("key", "n")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    trained = marked.where("not held_out").count()
    total, distinct = sums["n"] + trained, sums["v"] + (trained > 0)
    values = build_tree(counted.where(f"kind = {GRAM}").select("key", "n"), shards)
    key = F.col("key")
    table = values.select(
        x.shard_of(key, shards).alias("shard"),
        F.lit(GRAM).alias("tag"),
        "key",
        F.col("value").cast("float").cast("double").alias("value"),  # half the bytes to send back
    ).unionByName(
        words.select(
            x.shard_of(key, shards).alias("shard"),
            F.lit(WORD).alias("tag"),
            "key",
            F.col("n").cast("double").alias("value"),
        )
    )

    def ask(bucket: pa.Table) -> Iterator[dict]:
        number = bucket["bucket"][0].as_py()
        found: dict[int, list] = {GRAM: [], WORD: []}
        for rows in batches((None, t) for t in x.bytes_of(bucket)):
            block = [t for _, t in rows]
            found[GRAM].append(x.distinct(grams(block)[0])[0])
            found[WORD].append(x.distinct(word_keys(block)[0])[0])
        for kind, keys in found.items():
            yield from x.lookup_rows(number, kind, x.distinct(np.concatenate(keys))[0], shards)

    def finish(bucket: pa.Table, answers: dict) -> pa.Table:
        blocks = [[t for _, t in rows] for rows in batches((None, t) for t in x.bytes_of(bucket))]
        read = [(grams(b), word_keys(b)) for b in blocks]
        known = []
        for kind in (GRAM, WORD):
            keys = x.distinct(np.concatenate([x.distinct(r[kind][0])[0] for r in read]))[0]
            known.append(Table(keys, x.answered(answers.get(kind), keys, shards)))
        floor = math.log10(total + distinct + 1)
        out: dict[str, list] = {n: [] for n in ("n_tokens", "n_known", "base_score", "score", "bits")}
        for block, ((strings, first), (words, _, counts)) in zip(blocks, read, strict=True):
            sums = np.add.reduceat(known[GRAM](strings), first)
            seen = known[WORD](words)
            doc = np.repeat(np.arange(len(block)), counts)
            n = len(block)
            hits = np.bincount(doc, weights=seen > 0, minlength=n).astype(np.int64)
            logs = np.bincount(doc, weights=np.log10(seen + 1.0), minlength=n)
            tokens = counts + 1
            out["n_tokens"].append(tokens)
            out["n_known"].append(hits + (trained > 0))
            out["base_score"].append(logs + math.log10(trained + 1.0) - tokens * floor)
            out["score"].append(sums)
            size = np.array([len(t) + 1 for t in block])
            out["bits"].append(-sums / math.log10(2) / size)
        columns = {n: pa.array(np.concatenate(v)) for n, v in out.items()}
        rest = bucket["rest"].combine_chunks()
        return pa.table(
            {
                "doc_id": rest.field("doc_id"),
                "held_out": rest.field("held_out"),
                "n_tokens": columns["n_tokens"],
                "n_known": columns["n_known"],
                "train_tokens": pa.array(np.full(bucket.num_rows, total, dtype=np.int64)),
                "base_score": columns["base_score"],
                "score": columns["score"],
                "code_bits_per_byte": columns["bits"],
            }
        )

    kind = marked.schema["doc_id"].dataType.simpleString()
    asked = x.per_bucket(dealt, ask, x.KEYS)
    return x.with_answers(
        dealt,
        x.answer(asked, table),
        finish,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double, code_bits_per_byte double",
    )
