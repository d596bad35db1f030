"""Benchmark passages in documents by greedy string tiling.

1. Texts become lower-cased words without punctuation at the ends. A seed is ``LEAST_TILE``
   consecutive words, or all words of an item that has fewer. Seeds of all benchmark items set bits of a fixed-size filter that is sent to
   every task; each document keeps only the words under seeds that pass it.
2. Documents and items are joined on the seeds they share. A pair goes on if its shared seeds could
   cover the threshold even as shortest tiles.
3. Each pair is tiled: the longest common run of words that are not yet marked, found by running
   Karp-Rabin hashes over both, becomes a tile and is marked on both sides, again and again, down
   to ``LEAST_TILE`` words. Tiles may stand in any order, so passages with moved sentences count.
   A pair is reported if tiles cover ``COVERAGE`` of the item. An item with fewer words than a tile
   is one tile and must stand whole.

Defined results: documents without text or with a null ``doc_id`` and items without a word or with
a null id are never reported; an item or document that stands twice is reported once,
at its best; an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import if_small, pin
from lamina.llm.textops import PUNCTUATION, Block, batches, mix, windows

LEAST_TILE, COVERAGE = 5, 0.5
#: Bits of the seed filter as a power of two: two megabytes, whatever the benchmark's size.
FILTER_BITS = 24
#: Most ids that are sent to every task instead of shuffling the documents.
IDS_SENT = 1_000_000
#: Most seeds of items that are sent to every task instead of being shuffled.
SEEDS_SENT = 500_000
_BASE = 0x9E3779B97F4A7C55
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def _seeds(hashes: np.ndarray, size: int) -> np.ndarray:
    """Seeds of ``size`` words; those of shorter items differ from all others."""
    return windows(hashes, size, salt=size if size < LEAST_TILE else 0)


def item_words(benchmark: DataFrame) -> DataFrame:
    """``item_id, item, n, words, seeds`` of every distinct item; ``item`` tells texts apart."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column("item_id").to_pylist()
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            words = Block(texts, lower=True).words().trim(PUNCTUATION)
            hashes = words.hashes()
            rows = []
            for i, first, n in zip(ids, words.first.tolist(), words.counts.tolist(), strict=True):
                own = hashes[first : first + n]
                if n and i is not None:
                    seeds = _seeds(own, min(n, LEAST_TILE))
                    rows.append((i, n, own.astype(np.int64).tolist(), seeds.astype(np.int64).tolist()))
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int32()),
                        pa.array(columns[2], pa.list_(pa.int64())),
                        pa.array(columns[3], pa.list_(pa.int64())),
                    ],
                    ["item_id", "n", "words", "seeds"],
                )

    plain = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    found = plain.mapInArrow(run, "item_id long, n int, words array<long>, seeds array<long>")
    return found.withColumn("item", F.xxhash64("item_id", "words")).dropDuplicates(["item"])


def seed_filter(items: DataFrame) -> np.ndarray:
    """The filter's bits, packed: bit ``seed >> (64 - FILTER_BITS)`` of every seed."""
    seeds = items.select(F.explode("seeds").alias("seed"))
    bit = F.shiftrightunsigned("seed", 64 - FILTER_BITS).alias("bit")
    set_bits = seeds.select(bit).distinct().toArrow()["bit"].to_numpy()  # at most 2 ** FILTER_BITS
    flags = np.zeros(1 << FILTER_BITS, dtype=bool)
    flags[set_bits] = True
    return np.packbits(flags)


def seed_sizes(items: DataFrame) -> list[int]:
    """The numbers of words in the seeds of the items, ``LEAST_TILE`` of them at most."""
    size = F.least("n", F.lit(LEAST_TILE)).alias("size")
    return sorted(r["size"] for r in items.select(size).distinct().collect())


def seeded_words(docs: DataFrame, packed: np.ndarray, sizes: list[int]) -> DataFrame:
    """``doc_id, text_key, at, words, seeds`` of the documents with seeds that pass the filter.

    ``words`` are the hashes of the words under those seeds and ``at`` their places.
    """
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(shared.value).astype(bool)
        for part in parts:
            ids = part.column("doc_id").to_pylist()
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            rows = []
            for group in batches(zip(ids, texts, strict=True)):
                words = Block([t for _, t in group], lower=True).words().trim(PUNCTUATION)
                hashes = words.hashes()
                hits = []
                for size in sizes:
                    seeds = _seeds(hashes, size)
                    inside = words.doc[: len(seeds)] == words.doc[size - 1 :]
                    hit = np.flatnonzero(inside & flags[seeds >> np.uint64(64 - FILTER_BITS)])
                    cuts = np.searchsorted(words.doc[hit], np.arange(len(group) + 1))
                    hits.append((size, seeds, hit, cuts))
                owners = [words.doc[hit] for _, _, hit, _ in hits]
                for d in np.unique(np.concatenate(owners)).tolist() if owners else []:
                    own = [(size, seeds, hit[cuts[d] : cuts[d + 1]]) for size, seeds, hit, cuts in hits]
                    under = np.unique(
                        np.concatenate([(at[:, None] + np.arange(size)).ravel() for size, _, at in own])
                    )
                    kept = hashes[under]
                    key = int(np.add.reduce(mix(kept ^ under.astype(np.uint64))) >> np.uint64(1))
                    at = (under - words.first[d]).tolist()
                    found = np.unique(np.concatenate([seeds[at] for _, seeds, at in own]))
                    found = found.astype(np.int64).tolist()
                    rows.append((group[d][0], key, at, kept.astype(np.int64).tolist(), found))
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "text_key", "at", "words", "seeds"],
                )

    plain = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    lists = "at array<long>, words array<long>, seeds array<long>"
    return plain.mapInArrow(run, f"doc_id long, text_key long, {lists}")


class _Side:
    """Words of one side with prefix hashes and marks; gaps in ``at`` cannot be crossed."""

    def __init__(self, words: np.ndarray, at: np.ndarray):
        self.words = words
        self.marked = np.zeros(len(words), dtype=bool)
        self.cut = np.zeros(len(words), dtype=bool)
        self.cut[1:] = np.diff(at) != 1
        power = np.ones(len(words), dtype=np.uint64)
        power[1:] = np.cumprod(np.full(len(words) - 1, _BASE, dtype=np.uint64))
        self.back = np.ones(len(words), dtype=np.uint64)
        self.back[1:] = np.cumprod(np.full(len(words) - 1, _BASE_INVERSE, dtype=np.uint64))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(words) * power)))

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and Karp-Rabin hashes of the unmarked runs of ``size`` words."""
        n = len(self.words) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        marks = np.concatenate(([0], np.cumsum(self.marked)))
        cuts = np.concatenate(([0], np.cumsum(self.cut)))
        free = (marks[size:] == marks[:n]) & (cuts[size:] == cuts[1 : n + 1])
        at = np.flatnonzero(free)
        return at, (self.sums[at + size] - self.sums[at]) * self.back[at]

    def longest(self) -> int:
        edges = np.flatnonzero(np.append(self.cut, True))
        return int(np.diff(np.concatenate(([0], edges[edges > 0]))).max(initial=0))


def tile(item: np.ndarray, words: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """Tiles ``(place in the item, index in the text, words)``, longest first, then leftmost.

    A common run holds common runs of every smaller size, so the size of the next tile is found by
    halves, and the passes over both sides grow with the number of tiles and not with the item.
    """
    left, right = _Side(item, np.arange(len(item))), _Side(words, at)
    tiles = []
    least, size = min(LEAST_TILE, len(item)), min(len(item), right.longest())

    def common(size: int) -> bool:
        return bool(np.isin(left.runs(size)[1], right.runs(size)[1]).any())

    while size >= least and common(least):
        low = least
        while low < size:
            middle = (low + size + 1) // 2
            low, size = (middle, size) if common(middle) else (low, middle - 1)
        places, hashes = left.runs(size)
        spots, found = right.runs(size)
        order = np.argsort(hashes, kind="stable")
        lows = np.searchsorted(hashes[order], found, "left")
        highs = np.searchsorted(hashes[order], found, "right")
        for k in np.flatnonzero(lows < highs).tolist():
            spot = int(spots[k])
            if right.marked[spot : spot + size].any():
                continue
            for j in order[lows[k] : highs[k]].tolist():
                place = int(places[j])
                if left.marked[place : place + size].any():
                    continue
                if np.array_equal(item[place : place + size], words[spot : spot + size]):
                    left.marked[place : place + size] = True
                    right.marked[spot : spot + size] = True
                    tiles.append((place, spot, size))
                    break
        size -= 1
    return tiles


def _tiled(pairs: DataFrame) -> DataFrame:
    names = ["doc_id", "item_id", "item_words", "covered_words", "n_tiles"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            covered, tiles = [], []
            columns = [part.column(c).to_pylist() for c in ("item_words_list", "words", "at")]
            for item, words, at in zip(*columns, strict=True):
                found = tile(
                    np.array(item, dtype=np.int64).astype(np.uint64),
                    np.array(words, dtype=np.int64).astype(np.uint64),
                    np.array(at, dtype=np.int64),
                )
                covered.append(sum(size for _, _, size in found))
                tiles.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in names[:3]),
                    pa.array(covered, pa.int64()),
                    pa.array(tiles, pa.int64()),
                ],
                names,
            )

    return pairs.mapInArrow(
        run, "doc_id long, item_id long, item_words int, covered_words long, n_tiles long"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, coverage, item_words, covered_words, n_tiles`` of every pair found."""
    items = pin(item_words(benchmark), "items")
    kept = pin(seeded_words(docs, seed_filter(items), seed_sizes(items)), "seeded")
    places = items.select("item", "n", F.posexplode("seeds").alias("place", "seed"))
    shared = (
        kept.select("doc_id", "text_key", F.explode("seeds").alias("seed"))
        .join(if_small(places, SEEDS_SENT), "seed")
        .groupBy("doc_id", "text_key", "item")
        .agg(F.count_distinct("place").alias("shared"), F.first("n").alias("n"))
        .where(F.col("shared") * LEAST_TILE >= F.col("n") * COVERAGE)
        .select("doc_id", "text_key", "item")
    )
    whole = items.select(
        "item", "item_id", F.col("n").alias("item_words"), F.col("words").alias("item_words_list")
    )
    pairs = (
        shared.join(kept.dropDuplicates(["doc_id", "text_key"]).drop("seeds"), ["doc_id", "text_key"])
        .join(if_small(whole), "item")
        .select("doc_id", "item_id", "item_words", "item_words_list", "words", "at")
    )
    share = F.col("covered_words") / F.col("item_words")
    best = F.max_by(F.struct("item_words", "covered_words", "n_tiles", share.alias("coverage")), share)
    return (
        _tiled(pairs)
        .where(share >= COVERAGE)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("b"))
        .select("doc_id", "item_id", "b.coverage", "b.item_words", "b.covered_words", "b.n_tiles")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_TILE) -> DataFrame:
    """``docs`` without those that hold a benchmark item of ``least_words`` words or more.

    Shorter items are reported by ``contaminated``, but a word or two prove nothing and would take
    every document that holds them.
    """
    found = contaminated(docs, benchmark).where(F.col("item_words") >= least_words)
    found = pin(found.select("doc_id").distinct(), "contaminated")
    return docs.join(if_small(found, IDS_SENT), "doc_id", "left_anti").select(docs.columns)
