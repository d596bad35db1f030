"""Repeated byte strings by fingerprint grouping, with a difference cover as a prefilter.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in the corpus,
in the same document too. That needs ties only, so no suffix order is built; two groupings find them:

1. Cover sample. Positions whose place in their document is, modulo the period, in a difference
   cover are sampled, and the samples are grouped by the string of ``length - period + 1`` bytes from
   them. For any two positions some shift below the period takes both to a sample, so two suffixes
   that agree on ``length`` bytes have equal samples at that shift. The sample answers only whether
   its string stands twice; suffixes without such a sample ahead are left out. The bytes that such
   strings cover are reported: they show repeats too short to be removed.
2. Windows. The fingerprints of the ``length`` bytes from the suffixes left are grouped in ranges;
   those that occur twice are the repeats.

The cover is the largest whose period is at most half the length. ``LENGTH`` is that of the query;
a corpus loses passages of about 50 words, ``PASSAGE`` bytes.

Both group strings by a fingerprint of at most 64 bits, cut to the bits that keep the expected number
of false ties below one up to about 10^9 suffixes. No rank or byte comparison confirms a tie.

Defined results: a null text is empty; texts shorter than ``length`` stay whole; repeated rows are
copies of each other, so all their long texts go; an empty table gives an empty result; other
columns come back in ``rest`` and cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import exchange as x
from lamina.llm.textops import Block, ByteSums, batches, covered

LENGTH = 400
#: Bytes of a passage of 50 short words.
PASSAGE = 240
RANKS, SUFFIXES, AHEAD, TWICE = 0, 1, 2, 3


def difference_cover(r: int) -> tuple[np.ndarray, int]:
    """The cover of Colbourn and Ling: positions and the period whose differences they span."""
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return np.concatenate(([0], np.cumsum(steps))), 24 * r * r + 36 * r + 13


@dataclass(frozen=True)
class Cover:
    """The sampled places for strings of ``length`` bytes, and the bytes that a sample stands for."""

    length: int
    period: int
    sampled: np.ndarray

    @staticmethod
    def of(length: int) -> Cover:
        order = max((r for r in range(1, 32) if 2 * difference_cover(r)[1] <= length), default=0)
        places, period = difference_cover(order)
        if length < period:
            raise ValueError(f"strings of {length} bytes are shorter than the least period, {period}")
        return Cover(length, period, np.isin(np.arange(period), places))

    @property
    def reach(self) -> int:
        return self.length - self.period + 1


def key_bits(total: int) -> tuple[int, int]:
    """Bits of a sample's and of a suffix's fingerprint for a corpus of ``total`` bytes."""
    n = math.log2(max(total, 2))
    return max(40, min(64, round(n + 10))), max(48, min(64, math.ceil(2 * n - 2)))


class _Part:
    """Some documents of a bucket as one block, with the room that each position has ahead."""

    def __init__(self, texts: list[bytes], cover: Cover):
        self.cover = cover
        self.block = Block(texts)
        self.sums = ByteSums(self.block.data)
        size = np.repeat(self.block.sizes, self.block.sizes + 1)
        self.place = np.arange(len(size)) - np.repeat(self.block.starts, self.block.sizes + 1)
        self.room = size - self.place

    def samples(self) -> np.ndarray:
        fits = self.room >= self.cover.reach
        return np.flatnonzero(self.cover.sampled[self.place % self.cover.period] & fits)

    def ranks(self, at: np.ndarray, bits: int) -> np.ndarray:
        return self.sums.hashes(at, self.cover.reach) >> np.uint64(64 - bits)

    def suffixes(self, at: np.ndarray, bits: int) -> np.ndarray:
        return self.sums.hashes(at, self.cover.length, salt=1) >> np.uint64(64 - bits)

    def covered_by(self, at: np.ndarray, size: int) -> np.ndarray:
        """Marks the positions that strings of ``size`` bytes from ``at`` cover."""
        return covered(at, size, len(self.room) + size)[: len(self.room)]

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Marked positions of each text."""
        return np.add.reduceat(marks.astype(np.int64), self.block.starts) if len(self.block) else marks[:0]


def _parts(table: pa.Table, cover: Cover) -> Iterator[_Part]:
    for rows in batches((None, t) for t in x.bytes_of(table)):
        yield _Part([t for _, t in rows], cover)


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, dtype=np.uint64)


def repeated_spans(dealt: x.Deal, whole_letters: bool = False, length: int = LENGTH) -> DataFrame:
    """``rest, doc_id, n_bytes, spans, kept, n_twice`` of every row: removed byte ranges and what is left.

    ``n_twice`` counts the bytes that cover samples standing twice cover, removed or not. With ``whole_letters``, bytes of a letter that a cut has split are left out of ``kept`` as well.
    """
    cover = Cover.of(length)
    rank_bits, suffix_bits = key_bits(dealt.total)
    shards = dealt.buckets

    def send_ranks(table: pa.Table) -> Iterator[dict]:
        ranks = _joined([p.ranks(p.samples(), rank_bits) for p in _parts(table, cover)])
        keys, twice = x.distinct(ranks)
        bucket = table["bucket"][0].as_py()
        return x.range_rows(bucket, RANKS, keys, rank_bits, shards, lambda s: x.pack_bits(twice[s]))

    def send_suffixes(table: pa.Table, flags: dict) -> Iterator[dict]:
        ranks = _joined([p.ranks(p.samples(), rank_bits) for p in _parts(table, cover)])
        keys, _ = x.distinct(ranks)
        repeated = keys[x.joined_bits(flags.get(RANKS))]
        found, ahead, twice = [], [], []
        for part in _parts(table, cover):
            at = part.samples()
            at = at[_among(part.ranks(at, rank_bits), repeated)]
            twice.append(part.per_text(part.covered_by(at, cover.reach)))
            near = part.covered_by(np.maximum(at - cover.period + 1, 0), cover.period)
            near &= part.room >= length
            ahead.append(near)
            found.append(part.suffixes(np.flatnonzero(near), suffix_bits))
        keys, again = x.distinct(_joined(found))
        bucket = table["bucket"][0].as_py()
        yield from x.range_rows(
            bucket, SUFFIXES, keys, suffix_bits, shards, lambda s: x.pack_bits(again[s])
        )
        yield x.passed_on(bucket, AHEAD, shards, _joined(ahead).astype(bool))
        counts = np.concatenate(twice).astype("<u8").view(np.uint8)
        yield x.passed_on(bucket, TWICE, shards, np.unpackbits(counts))

    def finish(table: pa.Table, flags: dict) -> pa.Table:
        ahead = x.joined_bits(flags.get(AHEAD))
        near, found, at = [], [], 0
        for part in _parts(table, cover):
            near.append(np.flatnonzero(ahead[at : at + len(part.room)]))
            found.append(part.suffixes(near[-1], suffix_bits))
            at += len(part.room)
        keys, _ = x.distinct(_joined(found))
        repeated = keys[x.joined_bits(flags.get(SUFFIXES))]
        spans, kept, sizes = [], [], []
        for part, positions, own in zip(_groups(table), near, found, strict=True):
            block = Block(part)
            gone = covered(positions[_among(own, repeated)], length, len(block.data) + length)
            edges = np.flatnonzero(np.diff(gone[: len(block.data)].astype(np.int8), prepend=0, append=0))
            begin, end = edges[0::2], edges[1::2]
            first = np.searchsorted(begin, block.starts)
            last = np.append(first[1:], len(begin))
            for text, start, i, j in zip(part, block.starts.tolist(), first, last, strict=True):
                cuts = [(int(b) - start, int(e) - start) for b, e in zip(begin[i:j], end[i:j], strict=True)]
                spans.append([{"start": b, "end": e} for b, e in cuts])
                keep, here = [], 0
                for b, e in cuts:
                    keep.append(text[here:b])
                    here = e
                left = b"".join([*keep, text[here:]])
                kept.append(left.decode("utf-8", "ignore").encode() if whole_letters and cuts else left)
                sizes.append(len(text))
        pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.table(
            {
                "rest": table["rest"],
                "doc_id": table["doc_id"],
                "n_bytes": pa.array(sizes, pa.int64()),
                "spans": pa.array(spans, pa.list_(pair)),
                "kept": pa.array(kept, pa.binary()),
                "n_twice": pa.array(np.packbits(x.joined_bits(flags.get(TWICE))).view("<u8"), pa.int64()),
            }
        )

    ranked = x.flag_repeats(x.per_bucket(dealt, send_ranks, x.KEYS))
    tied = x.flag_repeats(x.with_answers(dealt, ranked, send_suffixes, x.KEYS))
    return x.with_answers(
        dealt,
        tied,
        finish,
        f"rest {dealt.rest_type}, doc_id long, n_bytes long,"
        " spans array<struct<start:long,end:long>>, kept binary, n_twice long",
    )


def _groups(table: pa.Table) -> list[list[bytes]]:
    """The texts of a bucket, grouped as ``_parts`` groups them."""
    return [[t for _, t in rows] for rows in batches((None, t) for t in x.bytes_of(table))]


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which keys stand among the ascending ``wanted``."""
    if not len(wanted):
        return np.zeros(len(keys), dtype=bool)
    at = np.searchsorted(wanted, keys)
    return wanted[np.minimum(at, len(wanted) - 1)] == keys


def remove_repeats(docs: DataFrame, whole_letters: bool = False, length: int = LENGTH) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text`` and any others) with its repeats taken out."""
    return repeated_spans(x.deal(docs), whole_letters, length)


def cleaned(docs: DataFrame, length: int = PASSAGE) -> DataFrame:
    """``docs`` with the text that is left and, if there is one, ``n_chars`` counted anew.

    Strings of ``length`` bytes or more that stand twice go. Documents of which nothing is left are dropped; those that had no text stay.
    """
    left = remove_repeats(docs, whole_letters=True, length=length).where(
        (F.octet_length("kept") > 0) | (F.col("n_bytes") == 0)
    )
    text = F.col("kept").cast("string")
    changed = F.size("spans") > 0
    columns = []
    for field in docs.schema:
        old = F.col("rest").getField(field.name) if field.name != "text" else text
        if field.name == "n_chars":
            old = F.when(changed, F.char_length(text).cast(field.dataType)).otherwise(old)
        columns.append(old.alias(field.name))
    return left.select(*columns)


def digest(removed: DataFrame) -> DataFrame:
    """The columns of the query."""
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        "n_twice",
    )
