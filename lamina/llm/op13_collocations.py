"""Phrase collocations from count streams in prefix and in suffix order.

Phrases of up to ``LONGEST`` words are counted per language, order by order; a longer phrase is
counted only where both phrases one word shorter that it holds reach ``LEAST``, which loses none,
as a phrase never occurs more often than a part of it. What reached it is sent to the tasks as a
bitmap of hashed phrases of fixed size, which lets too many through, never too few; the counts
themselves are exact and grouped by the phrase's own bytes.

The frequent phrases are then laid out twice, sorted by their words from the first on (prefix order)
and from the last on (suffix order), in ranges of about ``PART_ROWS``. One walk over a range of
either stream keeps the phrases open that the current one extends. In prefix order they are the
left parts of every cut, in suffix order the right parts, and each tells the phrase before it how
often its extension occurs; nothing is looked up by hash. Where a range begins inside an open phrase,
that phrase is copied to it, so no first word, however many phrases start with it, needs one task.

Defined results: a null text is empty, a null language ``und``; repeated rows count again; a text
without words adds nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import parts_for, pin
from lamina.llm.textops import encode, tidy

LONGEST = 5
LEAST = 100
TOP = 2000
#: Cells of the bitmap of frequent phrases that tasks get: 8 MB whatever the corpus.
FILTER_CELLS = 1 << 26
#: Frequent phrases that one task walks over.
PART_ROWS = 200_000
#: Text whose phrases a task combines before they are sent.
COMBINE_BYTES = 12_000_000

#: Ends of pieces become newlines, tabs become spaces; a byte that UTF-8 never uses marks an end.
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\x09", b"\n" * 9 + b" ")
_END = b"\xff"
#: Phrases are counted under one key, the phrase and after a newline the language.
_COUNTED = "key binary, n long"
_WALKED = "lang string, phrase binary, own boolean, parts array<long>, longer long"


class _Words:
    """Words of some texts of one language as numbers of their own, ends of pieces among them."""

    def __init__(self, texts: list[bytes]):
        flat = b"\n".join(texts).lower().translate(_PIECES).replace(b"\n", b" \xff ")
        found = flat.split()
        self.names = list(dict.fromkeys(found))
        number = {name: k for k, name in enumerate(self.names)}
        self.ids = np.fromiter(map(number.__getitem__, found), dtype=np.int64, count=len(found))
        self.end = number.get(_END, -1)

    def single(self) -> tuple[list[bytes], np.ndarray]:
        counts = np.bincount(self.ids, minlength=len(self.names))
        if self.end >= 0:
            counts[self.end] = 0
        kept = np.flatnonzero(counts)
        return [self.names[k] for k in kept.tolist()], counts[kept]

    def longer(self, allowed) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        """Phrases of 2, 3, ... words with their counts, while ``allowed(size, names)`` marks some.

        ``allowed`` is asked once per distinct phrase; only occurrences of phrases it marks are extended.
        """
        names, local = self.names, self.ids
        good = allowed(1, names)
        if self.end >= 0:
            good[self.end] = False
        at = good[self.ids]  # the phrase that starts here is allowed
        size, width = 1, len(self.names)
        while True:
            size += 1
            both = np.flatnonzero(at[:-1] & at[1:])
            if not len(both):
                return
            keys = local[both] * width + self.ids[both + size - 1]
            distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
            head, last = np.divmod(distinct, width)
            names = [
                names[h] + b" " + self.names[w] for h, w in zip(head.tolist(), last.tolist(), strict=True)
            ]
            yield size, names, counts
            good = allowed(size, names)
            if good is None:
                return
            at = np.zeros(max(len(at) - 1, 0), dtype=bool)
            at[both] = good[inverse]
            local = np.zeros(len(at), dtype=np.int64)
            local[both] = inverse


def _grouped(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of a task by language, about ``COMBINE_BYTES`` at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for part in parts:
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
            raw = encode(text)
            held.setdefault(lang, []).append(raw)
            size += len(raw)
            if size >= COMBINE_BYTES:
                yield from held.items()
                held, size = {}, 0
                tidy()
    yield from held.items()


def _batch(lang: str, names: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
    tail = b"\n" + lang.encode()
    keys = pa.array([name + tail for name in names], pa.binary())
    return pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64())], ["key", "n"])


def _cell() -> Column:
    """The cell of a phrase, from 1 on."""
    return F.xxhash64("lang", "phrase").bitwiseAND(F.lit(FILTER_CELLS - 1)) + 1


def _bitmap(counts: DataFrame) -> np.ndarray:
    """One bit per cell, set where some phrase of ``counts`` has it: at most 2048 short rows."""
    rows = (
        counts.select(_cell().alias("cell"))
        .groupBy(F.bitmap_bucket_number("cell").alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_CELLS // 8, dtype=np.uint8)
    for row in rows:
        block = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        at = (row["block"] - 1) * len(block)
        bits[at : at + len(block)] |= block
    return bits


def _marked(lang: str, names: list[bytes], bits: np.ndarray) -> np.ndarray:
    """Which phrases have their cell set; the hash is the one of ``_cell``."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    digest = xxhash.xxh64_intdigest
    cells = np.fromiter((digest(name, seed) for name in names), dtype=np.uint64, count=len(names))
    cells &= np.uint64(FILTER_CELLS - 1)
    return (bits[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _summed(rows: DataFrame, least: int = 1) -> DataFrame:
    """``lang, words, phrase, n`` of the phrases that occur ``least`` times."""
    text = F.col("key").cast("string")
    phrase = F.substring_index(text, "\n", 1)
    return (
        rows.groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .select(
            F.substr(text, F.char_length(phrase) + 2).alias("lang"),
            (F.char_length(phrase) - F.char_length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1).alias("words"),
            phrase.cast("binary").alias("phrase"),
            "n",
        )
    )


def phrase_counts(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, n`` of phrases that occur ``least`` times, and ``lang, total`` words.

    Bigrams take one pass over the texts, all longer phrases another.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    ).where("text is not null")

    def single(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, raw in _grouped(parts):
            names, counts = _Words(raw).single()
            yield _batch(lang, names, counts)

    words = pin(_summed(texts.mapInArrow(single, _COUNTED)), "words")
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.where(F.col("n") >= least)

    def counted(first: int, last: int, held) -> DataFrame:
        """Phrases of ``first`` to ``last`` words whose parts of ``first - 1`` words ``held`` has."""

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = held.value

            def allowed(lang: str, size: int, names: list[bytes]) -> np.ndarray | None:
                if size >= last:
                    return None
                if size == first - 1 or size == 1:
                    return _marked(lang, names, bits)
                return np.ones(len(names), dtype=bool)

            for lang, raw in _grouped(parts):
                found = _Words(raw).longer(lambda size, names, lang=lang: allowed(lang, size, names))
                for size, names, counts in found:
                    if size >= first:
                        yield _batch(lang, names, counts)

        return _summed(texts.mapInArrow(run, _COUNTED), least)

    bits = _bitmap(frequent)
    streams = [frequent]
    if longest >= 2 and bits.any():
        streams.append(pin(counted(2, 2, spark.sparkContext.broadcast(bits)), "bigrams"))
        both = bits | _bitmap(streams[-1])
        if longest >= 3:
            streams.append(counted(3, longest, spark.sparkContext.broadcast(both)))
    every = streams[0]
    for stream in streams[1:]:
        every = every.unionByName(stream)
    return pin(every, "phrases"), total


def _key(phrase: bytes, lang: str, backwards: bool) -> tuple:
    words = phrase.split(b" ")
    return (lang, *(reversed(words) if backwards else words))


def _bounds(counts: DataFrame, backwards: bool, rows: int) -> list[tuple]:
    """Where the ranges of a stream begin, from about 20 phrases a range drawn by their hash."""
    parts = parts_for(counts.count(), rows)
    if parts == 1:
        return []
    every = max(1, rows // 20)
    drawn = counts.where(F.pmod(F.xxhash64("phrase", "lang"), F.lit(every)) == 0)
    keys = sorted(_key(bytes(r.phrase), r.lang, backwards) for r in drawn.select("lang", "phrase").collect())
    return sorted({keys[k * len(keys) // parts] for k in range(1, parts)}) if keys else []


def walk(counts: DataFrame, backwards: bool, rows: int = PART_ROWS) -> DataFrame:
    """What one sorted stream tells of every phrase, ``lang, phrase, own, parts, longer``.

    ``parts`` holds the counts of its first 1, 2, ... words (``backwards``: of its last ones) and
    ``longer`` the largest count of the phrase with one word more at the other end, 0 if there is
    none. Rows that are not ``own`` add a ``longer`` seen in another range and have no ``parts``.
    """
    bounds = _bounds(counts, backwards, rows)
    # A phrase that begins like the first phrase of a range, but sorts before it, is open there.
    open_at: dict[tuple, list[int]] = {}
    for k, bound in enumerate(bounds):
        for size in range(2, len(bound)):
            open_at.setdefault(bound[:size], []).append(k + 1)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, own, at = [], [], []
            names = batch.column("phrase").to_pylist()
            for k, (lang, phrase) in enumerate(zip(batch.column("lang").to_pylist(), names, strict=True)):
                key = _key(phrase, lang, backwards)
                home = bisect.bisect_right(bounds, key)
                homes = [home, *(p for p in open_at.get(key, ()) if p != home)]
                part += homes
                own += [p == home for p in homes]
                at += [k] * len(homes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    pa.array(own, pa.bool_()),
                    *(batch.column(c).take(pa.array(at, pa.int64())) for c in ("lang", "phrase", "n")),
                ],
                ["part", "own", "lang", "phrase", "n"],
            )

    def go(table: pa.Table) -> pa.Table:
        lines = sorted(
            (_key(p, lang, backwards), n, own, p)
            for lang, p, n, own in zip(*(table[c].to_pylist() for c in ("lang", "phrase", "n", "own")), strict=True)
        )
        out, held = [], []

        def close(depth: int) -> None:
            while len(held) > depth:
                key, n, own, phrase, longer = held.pop()
                if own or longer:
                    parts = [h[1] for h in held] if own else None
                    out.append({"lang": key[0], "phrase": phrase, "own": own, "parts": parts, "longer": longer})

        for key, n, own, phrase in lines:
            depth = len(held)
            while depth and key[: len(held[depth - 1][0])] != held[depth - 1][0]:
                depth -= 1
            close(depth)
            if held:
                held[-1][4] = max(held[-1][4], n)
            held.append([key, n, own, phrase, 0])
        close(0)
        return pa.Table.from_pylist(
            out,
            schema=pa.schema(
                [
                    ("lang", pa.string()),
                    ("phrase", pa.binary()),
                    ("own", pa.bool_()),
                    ("parts", pa.list_(pa.int64())),
                    ("longer", pa.int64()),
                ]
            ),
        )

    laid = counts.select("lang", "phrase", "n").mapInArrow(
        lay, "part int, own boolean, lang string, phrase binary, n long"
    )
    return laid.groupBy("part").applyInArrow(go, _WALKED)


def scored(counts: DataFrame, totals: DataFrame, rows: int = PART_ROWS) -> DataFrame:
    """``lang, phrase, a, l, r, n, score, longer`` of every phrase of two words or more.

    ``l``, ``r`` and ``score`` are those of the lowest-scoring cut, the shortest first part on ties;
    ``longer`` is the largest count of a phrase one word longer that holds it. Products stay whole:
    they are decimals of 38 digits, room for corpora of 10^15 words.
    """
    left = walk(counts, False, rows).withColumn("parts", F.struct(F.col("parts").alias("l")))
    right = walk(counts, True, rows).withColumn("parts", F.struct(F.col("parts").alias("r")))
    sides = left.selectExpr("lang", "phrase", "parts.l as l", "null as r", "longer").unionByName(
        right.selectExpr("lang", "phrase", "null as l", "parts.r as r", "longer")
    )
    joined = sides.groupBy("lang", "phrase").agg(
        F.max("l").alias("ls"), F.max("r").alias("rs"), F.max("longer").alias("longer")
    )
    cuts = """array_min(transform(sequence(1, words - 1), k -> struct(
        1000BD * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))
          div (cast(ls[k - 1] as decimal(17, 0)) * cast(rs[words - k - 1] as decimal(17, 0))) as score,
        k, ls[k - 1] as l, rs[words - k - 1] as r)))"""
    return (
        counts.where("words > 1")
        .withColumnRenamed("n", "a")
        .join(F.broadcast(totals.withColumnRenamed("total", "n")) if _few(totals) else totals.withColumnRenamed("total", "n"), "lang")
        .join(joined, ["lang", "phrase"])
        .selectExpr("lang", "phrase", "a", "n", "longer", f"{cuts} as cut")
        .selectExpr("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "longer")
    )


def _few(totals: DataFrame, rows: int = 10_000) -> bool:
    return totals.limit(rows + 1).count() <= rows


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, rows: int = PART_ROWS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases.

    A phrase goes if one that holds it occurs as often. One word longer is enough to look at: of any
    longer phrase with that count, the part one word longer has it too and is counted.
    """
    counts, totals = phrase_counts(docs, least, longest)
    kept = scored(counts, totals, rows).where("longer < a").withColumn("phrase", F.col("phrase").cast("string"))
    order = "partition by lang order by score desc, a desc, phrase"
    return (
        kept.selectExpr("*", f"row_number() over ({order}) as rank")
        .where(F.col("rank") <= top)
        .selectExpr("lang", "cast(rank as long) as rank", "phrase", "a", "l", "r", "n", "score")
    )
