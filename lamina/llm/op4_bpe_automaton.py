"""Byte-pair encoding by a deterministic automaton over tokens, and decoding by its arc labels.

The automaton starts with one state per byte, from each of which every byte may follow. The merges
are then applied in order, each as one gadget: merging ``u v`` into ``w`` adds a state ``w`` that
goes on as ``v`` does, lets ``w`` follow wherever ``u`` may, and takes away the arc from ``u`` to
``v``. A token sequence is the encoding of its text exactly if the final automaton accepts it, and
every text has one such sequence. Rows are copied on write: a state keeps the state it was copied
from, the time of the copy and the arcs taken from it since, so that the table grows with the
merges and not with their square.

Encoding reads a pre-split word from left to right. Each position has one state, the last token of
the encoding so far; the arcs out of it are followed through the letters, and the state at the
word's end gives the tokens. Words that repeat are looked up in a bounded memory.

Defined results: a null text is encoded as an empty one; an empty table gives an empty result;
repeated rows are all returned.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lamina.llm.textops import tidy

#: Pre-split of byte-level tokenizers (fixed value, the public pattern).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose encoding a task remembers since it last forgot some.
REMEMBERED = 300_000
START = -1


def byte_letters() -> dict[str, int]:
    """The printable letter by which byte-level vocabularies write each byte, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Token states, their arcs and labels, compiled from a vocabulary and its merges."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], added: dict[str, int]):
        letters = byte_letters()
        self.added = dict(added)
        self.width = 1 + max([*vocab.values(), *added.values()], default=0)
        self.label: list[bytes] = [b""] * self.width
        for token, i in vocab.items():
            self.label[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.label[i] = token.encode()
        # The time a token was made and what it was made of; the last place is the start state's.
        self.rank = [-1] * (self.width + 1)
        self.left, self.right = [START] * self.width, [START] * self.width
        self.taken: dict[int, int] = {}
        live = {vocab[c] for c in letters if c in vocab}
        for time, (left, right) in enumerate(merges):
            self._gadget(live, vocab[left], vocab[right], vocab[left + right], time)
        self.trie = self._trie(live)

    def _gadget(self, live: set[int], u: int, v: int, w: int, time: int) -> None:
        """Adds the state ``w`` for ``u v`` and takes the arc from ``u`` to ``v`` away."""
        if u not in live or v not in live or w in live or u * self.width + v in self.taken:
            return
        if self.arc(u, v, time - 1):
            live.add(w)
            self.left[w], self.right[w], self.rank[w] = u, v, time
        self.taken[u * self.width + v] = time

    def arc(self, state: int, token: int, time: int) -> bool:
        """Whether ``token`` may follow ``state`` once the merges up to ``time`` are applied."""
        while True:
            if self.taken.get(state * self.width + token, time + 1) <= time:
                return False
            made, came = self.rank[token], self.rank[state]
            if made < 0 and came < 0:
                return True
            if made >= came:
                token, time = self.left[token], made
            else:
                state, time = self.right[state], came - 1

    def _trie(self, live: set[int]) -> tuple[dict[int, int], list[int]]:
        """Labels of live tokens letter by letter: the node after ``node * 256 + byte``, and the
        token that ends at each node, -1 for none."""
        steps: dict[int, int] = {}
        ends = [-1]
        for token in live:
            node = 0
            for byte in self.label[token]:
                at = node * 256 + byte
                if at not in steps:
                    steps[at] = len(ends)
                    ends.append(-1)
                node = steps[at]
            ends[node] = token
        return steps, ends


class _Words(dict):
    """Remembered words. Once there are too many, those not asked for since the last time go."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.before: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(word) or self.encode(word.encode("utf-8"))
        self[word] = ids
        return ids


class Coder:
    """Encoder and decoder of one task: an automaton, its followed arcs and remembered words."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.last = len(automaton.taken) + automaton.width
        self.width = automaton.width
        self.arcs: dict[int, bool] = {}
        self.words = _Words(self.word)
        self.split = regex.compile(SPLIT)
        self.special = (
            regex.compile("|".join(map(regex.escape, sorted(automaton.added, key=len, reverse=True))))
            if automaton.added
            else None
        )

    def _follow(self, state: int, token: int) -> bool:
        """The arc's entry, filled in the first time it is followed."""
        if len(self.arcs) > 2 * REMEMBERED:
            self.arcs.clear()
        found = self.arcs[state * self.width + token] = self.automaton.arc(state, token, self.last)
        return found

    def word(self, letters: bytes) -> tuple[int, ...]:
        """Tokens of one pre-split word."""
        n, width, known = len(letters), self.width, self.arcs.get
        state: list[int] = [START] * (n + 1)
        came = [0] * (n + 1)
        steps, ends = self.automaton.trie
        step = steps.get
        for i in range(n):
            now, node, j = state[i], 0, i
            row = now * width
            while j < n:
                node = step(node * 256 + letters[j])
                if node is None:
                    break
                j += 1
                token = ends[node]
                if token >= 0:
                    follows = known(row + token)
                    if follows is None:
                        follows = self._follow(now, token)
                    if follows:
                        state[j], came[j] = token, i
        out = []
        while n:
            out.append(state[n])
            n = came[n]
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        find, known = self.split.findall, self.words.__getitem__
        if self.special is None or not (marks := list(self.special.finditer(text))):
            return list(chain.from_iterable(map(known, find(text))))
        out: list[int] = []
        at = 0
        for match in marks:
            out.extend(chain.from_iterable(map(known, find(text[at : match.start()]))))
            out.append(self.automaton.added[match.group()])
            at = match.end()
        out.extend(chain.from_iterable(map(known, find(text[at:]))))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.automaton.label.__getitem__, ids)).decode("utf-8", "replace")


def compile_file(path: str) -> Automaton:
    """The automaton of a byte-level tokenizer file, read on the driver."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    vocab = {token: i for token, i in model["vocab"].items() if token not in added}
    return Automaton(vocab, merges, added)


_CODERS: dict[int, Coder] = {}


def _coder(shared) -> Coder:
    """One coder per worker and automaton, so that its words last over tasks."""
    if shared.id not in _CODERS:
        _CODERS.clear()
        gc.collect()  # what earlier stages left in this worker
    tidy()
    if shared.id not in _CODERS:
        _CODERS[shared.id] = Coder(shared.value)
    return _CODERS[shared.id]


class _Shared:
    """A broadcast automaton: its size is that of the vocabulary, whatever the table's."""

    def __init__(self, spark, automaton: Automaton):
        self.broadcast = spark.sparkContext.broadcast(automaton)
        self.id = self.broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self) -> Automaton:
        return self.broadcast.value


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``."""
    shared = _Shared(docs.sparkSession, compile_file(path))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for part in parts:
            ids = [coder.encode(t or "") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    plain = docs.selectExpr("doc_id", "cast(text as string) text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from rows ``doc_id, ids``; null ids give a null text."""
    shared = _Shared(encoded.sparkSession, compile_file(path))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for part in parts:
            texts = [None if i is None else coder.decode(i) for i in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: both directions in one pass per row."""
    shared = _Shared(docs.sparkSession, compile_file(path))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        decimal = [str(i) for i in range(coder.width)].__getitem__
        for part in parts:
            counts, encoded, decoded = [], [], []
            for text in part.column("text").to_pylist():
                ids = coder.encode(text or "")
                counts.append(len(ids))
                encoded.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)],
                names,
            )

    plain = docs.selectExpr("doc_id", "cast(text as string) text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
