"""Alignment of two tokenizers over the same texts by coalescing their tokens' byte intervals.

Every token covers an interval of a text's bytes. The tokens of both sides are sorted by start, the
running maximum of their ends is taken, and a group ends where a start reaches that maximum; inside a
group every pair of overlapping tokens is a link. As the tokens of a text leave no byte out, the texts
of a batch lie end to end and are coalesced in one go.

Links are counted corpus-wide in documents that hold them. Texts are tokenized once: each row keeps its
distinct links packed in a staged table, tasks add their counts up before the shuffle, and a last
pass gives each row the counts of its links. The counts are sent to the tasks if there are at most
``PAIRS_SENT`` of them and joined otherwise, with the same result.

Defined results: a null or empty text, or one whose tokens' bytes differ from the text with a space
before it, has no tokens; repeated rows are documents of their own; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lamina.llm.common import pin
from lamina.llm.exchange import pack_keys, squeeze, stretch, unpack_keys
from lamina.llm.textops import tidy

#: Distinct links whose counts are sent to every task: 17 bytes each.
PAIRS_SENT = 2_000_000
#: Link counts a task holds before it adds them up.
PAIRS_HELD = 4_000_000
#: Text that is aligned in one go.
TEXT_BYTES = 2_000_000


class ByteBpe:
    """A byte-level BPE vocabulary file: token ids of a text and the bytes of each id.

    Where merges come in the order of the ids, as the file format has it when it was written by
    training, the ids of a text are those of the same ranks in the faster library.
    """

    def __init__(self, raw: bytes):
        self.plain = Tokenizer.from_str(raw.decode())
        self.plain.encode_special_tokens = True
        self.plain.no_padding()
        self.plain.no_truncation()
        model = json.loads(raw)["model"]
        letters = _byte_letters()
        named = {bytes(letters[c] for c in token): k for token, k in model["vocab"].items()}
        self.width = max([*named.values(), *(t["id"] for t in json.loads(raw)["added_tokens"])]) + 1
        self.bytes = [b""] * self.width
        for token, k in named.items():
            self.bytes[k] = token
        made = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [model["vocab"][left + right] for left, right in made]
        self.fast = None
        if ids == sorted(set(ids)) and _gpt2_split(json.loads(raw)):
            self.fast = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=named, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as error:  # its pattern matcher gives up on some very long runs
                if isinstance(error, KeyboardInterrupt | SystemExit):
                    raise
        return self.plain.encode(text, add_special_tokens=False).ids


#: How byte-level vocabularies split a text into words (a fixed public pattern).
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _gpt2_split(spec: dict) -> bool:
    split = spec["pre_tokenizer"] or {}
    known = split.get("type") == "ByteLevel" and split.get("use_regex", True)
    return known and not split.get("add_prefix_space") and spec["normalizer"] is None


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level files: printable Latin-1 as it is, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pieces:
    """A piece vocabulary with byte fallback: ids of texts and the bytes of each id."""

    def __init__(self, raw: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.width = self.model.get_piece_size()
        self.bytes = []
        for k in range(self.width):
            piece = self.model.id_to_piece(k)
            if self.model.is_byte(k):
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode())

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Tokenizers:
    """Both vocabulary files as the driver read them, for tasks that may not see its folders."""

    a: Broadcast
    b: Broadcast

    @staticmethod
    def read(spark: SparkSession, path_a: str, path_b: str) -> Tokenizers:
        send = spark.sparkContext.broadcast
        return Tokenizers(send(Path(path_a).read_bytes()), send(Path(path_b).read_bytes()))

    def open(self) -> tuple[ByteBpe, Pieces]:
        """Built once per worker process."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = tuple(hashlib.sha256(raw).digest() for raw in (self.a.value, self.b.value))
        if key not in _OPEN:
            _OPEN[key] = ByteBpe(self.a.value), Pieces(self.b.value)
        return _OPEN[key]


_OPEN: dict[tuple, tuple[ByteBpe, Pieces]] = {}


class Aligned:
    """The tokens of some texts on both sides, their groups and links.

    ``a`` and ``b`` hold the ids of all texts in a row, ``n_a`` and ``n_b`` their numbers per text;
    ``order`` sorts the tokens of both sides by start, A first, and ``group`` numbers their groups.
    """

    def __init__(self, texts: list[str | None], bpe: ByteBpe, pieces: Pieces):
        full = [k for k, t in enumerate(texts) if t]
        given_b = iter(pieces.ids([texts[k] for k in full]))
        a, b = [[] for _ in texts], [[] for _ in texts]
        for k in full:
            spaced = " " + texts[k]
            raw, ids_a, ids_b = spaced.encode(), bpe.ids(spaced), next(given_b)
            if all(b"".join(map(side.bytes.__getitem__, ids)) == raw for side, ids in ((bpe, ids_a), (pieces, ids_b))):
                a[k], b[k] = ids_a, ids_b
        self.n_a, self.n_b = (np.array([len(ids) for ids in side], dtype=np.int64) for side in (a, b))
        self.a, self.b = (
            np.fromiter((i for ids in side for i in ids), dtype=np.int64, count=int(n.sum()))
            for side, n in ((a, self.n_a), (b, self.n_b))
        )
        self._coalesce(_sizes(bpe)[self.a], _sizes(pieces)[self.b])

    def _coalesce(self, size_a: np.ndarray, size_b: np.ndarray) -> None:
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        start_a, start_b = end_a - size_a, end_b - size_b
        start, end = np.concatenate((start_a, start_b)), np.concatenate((end_a, end_b))
        self.is_b = np.arange(len(start)) >= len(start_a)
        self.order = np.lexsort((self.is_b, start))
        reach = np.maximum.accumulate(end[self.order])
        breaks = np.ones(len(start), dtype=bool)
        breaks[1:] = start[self.order][1:] >= reach[:-1]
        self.group = np.cumsum(breaks) - 1
        # The B tokens that overlap an A token are neighbours.
        first = np.searchsorted(end_b, start_a, side="right")
        count = np.searchsorted(start_b, end_a, side="left") - first
        before = np.cumsum(count) - count
        self.link_a = np.repeat(np.arange(len(start_a)), count)
        self.link_b = np.arange(int(count.sum())) - np.repeat(before - first, count)
        doc = np.concatenate([np.repeat(np.arange(len(n)), n) for n in (self.n_a, self.n_b)])
        self.doc = doc[self.order]
        self.n_groups = np.bincount(self.doc[breaks], minlength=len(self.n_a))
        self.n_links = np.bincount(doc[: len(start_a)][self.link_a], minlength=len(self.n_a))
        self._doc_a = doc[: len(start_a)]

    def by_group(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in the order of text, group, side and place; whether each is of B; their group."""
        at = np.lexsort((np.arange(len(self.order)), self.is_b[self.order], self.group))
        ids = np.concatenate((self.a, self.b))[self.order]
        return ids[at], self.is_b[self.order][at], self.group[at]

    def written(self) -> list[str]:
        """The groups of each text: ``a1,a2|b1;a3|b2,b3``, nothing for a text without tokens."""
        ids, is_b, group = self.by_group()
        mark = np.zeros(len(ids), dtype=np.int64)
        mark[:-1] = np.where(group[1:] != group[:-1], 2, np.where(is_b[1:] != is_b[:-1], 1, 0))
        sizes = (self.n_a + self.n_b).tolist()
        last = np.cumsum(sizes)[np.array(sizes, dtype=np.int64) > 0] - 1
        mark[last] = 3
        most = int(ids.max()) + 1 if len(ids) else 1
        said = _decimals(most)
        words = list(map(said.__getitem__, (ids * 4 + mark).tolist()))
        out, here = [], 0
        for n in sizes:
            out.append("".join(words[here : here + n]))
            here += n
        return out

    def pairs(self, width_b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text, ascending distinct links ``a * width_b + b`` and how often each occurs."""
        keys = self.a[self.link_a] * width_b + self.b[self.link_b]
        doc = self._doc_a[self.link_a]
        order = np.lexsort((keys, doc))
        keys, doc = keys[order], doc[order]
        first = np.ones(len(keys), dtype=bool)
        first[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(first)
        times = np.diff(np.append(at, len(keys)))
        cuts = np.searchsorted(doc[at], np.arange(len(self.n_a) + 1))
        for k in range(len(self.n_a)):
            own = slice(int(cuts[k]), int(cuts[k + 1]))
            yield keys[at[own]], times[own]


def _sizes(side) -> np.ndarray:
    if not hasattr(side, "sizes"):
        side.sizes = np.array([len(b) for b in side.bytes], dtype=np.int64)
    return side.sizes


_SAID: list[str] = []


def _decimals(n: int) -> list[str]:
    """At ``4 * id + mark`` the id with the mark after it."""
    for k in range(len(_SAID) // 4, n):
        _SAID.extend(f"{k}{mark}" for mark in (",", "|", ";", ""))
    return _SAID


def _batched(parts: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Rows in slices of about ``TEXT_BYTES``, one at least."""
    for part in parts:
        sizes = [len(t or "") for t in part.column(column).to_pylist()]
        start, held = 0, 0
        for k, size in enumerate(sizes):
            held += size
            if held >= TEXT_BYTES or k + 1 == len(sizes):
                yield part.slice(start, k + 1 - start)
                start, held = k + 1, 0
        tidy()


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, a, b, groups`` of every row: both sides' ids and, per group, its ids on each side."""
    shared = Tokenizers.read(docs.sparkSession, path_a, path_b)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = shared.open()
        for part in _batched(parts):
            found = Aligned(part.column("text").to_pylist(), bpe, pieces)
            ids, is_b, group = found.by_group()
            edge = np.flatnonzero(np.diff(group, prepend=-1))
            middle = np.flatnonzero(np.diff(is_b.astype(np.int8), prepend=0) > 0)
            stop = np.append(edge[1:], len(ids))
            lists = [
                {"a": ids[i:j].tolist(), "b": ids[j:k].tolist()}
                for i, j, k in zip(edge.tolist(), middle.tolist(), stop.tolist(), strict=True)
            ]
            groups = _split(lists, found.n_groups)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(_split(found.a.tolist(), found.n_a), pa.list_(pa.int32())),
                    pa.array(_split(found.b.tolist(), found.n_b), pa.list_(pa.int32())),
                    pa.array(groups, pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))),
                ],
                ["doc_id", "a", "b", "groups"],
            )

    plain = docs.selectExpr("doc_id", "cast(text as string) text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(
        run, f"doc_id {kind}, a array<int>, b array<int>, groups array<struct<a:array<int>,b:array<int>>>"
    )


def _split(values: list, sizes: np.ndarray) -> list[list]:
    out, here = [], 0
    for n in sizes.tolist():
        out.append(values[here : here + n])
        here += n
    return out


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One staged row per row of ``docs``: its numbers, the digest of its groups, its packed links."""
    shared = Tokenizers.read(docs.sparkSession, path_a, path_b)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = shared.open()
        for part in _batched(parts):
            found = Aligned(part.column("text").to_pylist(), bpe, pieces)
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.written()]
            keys, times = [], []
            for own, often in found.pairs(pieces.width):
                keys.append(pack_keys(own) if len(own) else None)
                times.append(squeeze(often.astype("<u4").tobytes()) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *(pa.array(getattr(found, c), pa.int64()) for c in numbers),
                    pa.array(digests, pa.string()),
                    pa.array(keys, pa.binary()),
                    pa.array(times, pa.binary()),
                ],
                ["doc_id", *numbers, "groups_sha256", "links", "times"],
            )

    plain = docs.selectExpr("doc_id", "cast(text as string) text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return pin(
        plain.mapInArrow(
            run,
            f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
            " links binary, times binary",
        ),
        "links",
    )


def _unpacked(links: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    return unpack_keys(links), np.frombuffer(stretch(times), dtype="<u4").astype(np.int64)


def link_counts(rows: DataFrame, width_b: int) -> DataFrame:
    """``a, b, link, n, best``: in how many rows a link stands, and whether no link of ``a`` has more."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.astype(np.int64)), pa.array(counts, pa.int64())], ["link", "n"]
            )

        for part in parts:
            for links in part.column("links").to_pylist():
                held.append(unpack_keys(links))
                size += len(held[-1])
                if size >= PAIRS_HELD:
                    yield summed()
                    held, size = [], 0
        if held:
            yield summed()

    counts = (
        rows.where("links is not null")
        .select("links")
        .mapInArrow(run, "link long, n long")
        .groupBy("link")
        .agg(F.sum("n").alias("n"))
        .selectExpr(f"link div {width_b} as a", f"link % {width_b} as b", "link", "n")
    )
    counts = pin(counts, "link-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return pin(counts.join(most, "a").selectExpr("a", "b", "link", "n", "n = most as best"), "link-counts")


def width_of(path_b: str) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def digest(docs: DataFrame, path_a: str, path_b: str, sent: int = PAIRS_SENT) -> DataFrame:
    """The numbers of every row, with ``n_best`` and ``count_sum`` over its links."""
    rows = linked(docs, path_a, path_b)
    counts = link_counts(rows, width_of(path_b))
    found = _from_broadcast(rows, counts) if counts.count() <= sent else _from_join(rows, counts)
    return found.select(*_COLUMNS)


def _from_broadcast(rows: DataFrame, counts: DataFrame) -> DataFrame:
    table = counts.select("link", "n", "best").toArrow()
    links = table["link"].to_numpy().astype(np.uint64)
    order = np.argsort(links)
    n = table["n"].to_numpy()[order]
    best = table["best"].combine_chunks().to_numpy(zero_copy_only=False)[order]
    shared = rows.sparkSession.sparkContext.broadcast((links[order], n, best))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for part in parts:
            n_best, total = [], []
            for own, times in zip(part.column("links").to_pylist(), part.column("times").to_pylist(), strict=True):
                if own is None:
                    n_best.append(0)
                    total.append(0)
                    continue
                keys, often = _unpacked(own, times)
                at = np.searchsorted(known, keys)
                n_best.append(int(often[best[at]].sum()))
                total.append(int((often * n[at]).sum()))
            kept = [part.column(c) for c in _COLUMNS if c not in ("n_best", "count_sum")]
            names = [c for c in _COLUMNS if c not in ("n_best", "count_sum")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], [*names, "n_best", "count_sum"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
        " n_best long, count_sum long",
    )


def _from_join(rows: DataFrame, counts: DataFrame) -> DataFrame:
    numbered = pin(rows.withColumn("row", F.monotonically_increasing_id()), "links")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = (part.column(c).to_pylist() for c in ("row", "links", "times"))
            for row, links, times in zip(*columns, strict=True):
                keys, often = _unpacked(links, times)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(keys), row), pa.int64()),
                        pa.array(keys.astype(np.int64)),
                        pa.array(often, pa.int64()),
                    ],
                    ["row", "link", "times"],
                )

    each = (
        numbered.where("links is not null")
        .select("row", "links", "times")
        .mapInArrow(run, "row long, link long, times long")
        .join(counts.select("link", "n", "best"), "link")
        .groupBy("row")
        .agg(F.expr("sum(if(best, times, 0)) as n_best"), F.expr("sum(times * n) as count_sum"))
    )
    return numbered.join(each, "row", "left").fillna(0, ["n_best", "count_sum"])
