"""Near-duplicate documents by b-bit MinHash, with every link confirmed on full shingle sets.

1. Each text becomes its set of five-word shingles and ``HASHES`` minima. ``BANDS`` bands of minima
   give candidate keys; of each minimum only ``BITS`` low bits are kept, packed by bit plane.
2. Texts with the same set are one node. Nodes that share a key are candidates. In each round every
   node is paired with one hub per key, drawn anew, unless both are connected already; pairs are
   kept if the similarity estimated from the count of equal bit groups, corrected for groups that
   agree by chance, may reach the threshold; the kept ones are confirmed on their whole sets.
   Hubs connect a large group of copies in a few comparisons per node.
3. What hubs leave apart is settled exactly: all candidate pairs whose nodes are still in different
   components, estimated and confirmed likewise, but for those that share too few shingles by a
   bound that no link fails. No link between components is lost to a hub.

A pair at the threshold shares no band with a chance of (1 - 0.75 ** ROWS) ** BANDS, 5e-6, and is
estimated too low with one of about 1e-7.

Defined results: a text without words, a null text or a row with a null ``doc_id`` links with
nothing (its component is its own id, so ``kept`` is true); a text of one to four words is one
shingle; repeated rows fall in one component and share its result; sets are told apart by a 64-bit
hash; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lamina.llm.common import if_small, pin
from lamina.llm.components import connected
from lamina.llm.textops import Block, batches, combine, mix, windows

SHINGLE, PERCENT = 5, 75
BANDS, ROWS, BITS = 32, 4, 2
HASHES = BANDS * ROWS
#: Most differing bit groups of two signatures that are still confirmed: an estimate of one half.
MOST_DIFFERENT = 48
HUB_ROUNDS = 2
#: Classes in which shared shingles are counted before pairs that hubs leave apart are formed.
CLASSES = 64
#: Most ids that are sent to every task instead of shuffling the documents.
IDS_SENT = 1_000_000
_RNG = np.random.default_rng(5)
_A = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64)
PLANES = [f"plane{bit}_{half}" for bit in range(BITS) for half in range(HASHES // 64)]


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and the text of each."""
    words = Block(texts, lower=True).words()
    hashes = words.hashes()
    keys, docs = [], []
    for size in range(1, SHINGLE + 1):
        found = windows(hashes, size, salt=size)
        if size < SHINGLE:  # only a text of exactly so few words is one shingle
            at = words.first[words.counts == size]
            owner = np.flatnonzero(words.counts == size)
        else:
            at = np.flatnonzero(words.doc[: len(found)] == words.doc[size - 1 :])
            owner = words.doc[at]
        keys.append(found[at])
        docs.append(owner)
    keys, docs = np.concatenate(keys), np.concatenate(docs)
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    return keys[first], docs[first]


def set_hashes(keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One hash per set; ``starts`` and ``sizes`` of the sets that are not empty."""
    return mix(np.add.reduceat(mix(keys ^ np.uint64(0x5DEECE66D)), starts) + sizes.astype(np.uint64))


def _split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, set sizes of all texts, the texts with a set, and where those sets start."""
    keys, docs = shingle_sets(texts)
    sizes = np.bincount(docs, minlength=len(texts))
    own = np.flatnonzero(sizes)
    starts = np.concatenate(([0], np.cumsum(sizes[own])))[:-1].astype(np.int64)
    return keys, sizes, own, starts


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, node, n_shingles, bands`` and packed planes; ``node`` is null without shingles."""
    names = ["doc_id", "node", "n_shingles", "bands", *PLANES]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column("doc_id").to_pylist()
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            for rows in batches(zip(ids, texts, strict=True)):
                block = [t for _, t in rows]
                keys, sizes, own, starts = _split(block)
                n = len(own)
                least = np.empty((HASHES, n), dtype=np.uint64)
                for k in range(HASHES if n else 0):
                    least[k] = np.minimum.reduceat(keys * _A[k] + _B[k], starts)
                bands = np.zeros((n, BANDS), dtype=np.uint64)
                for band in range(BANDS):
                    key = np.full(n, band, dtype=np.uint64)
                    for row in range(ROWS):
                        key = combine(key, least[band * ROWS + row])
                    bands[:, band] = key
                low = mix(least)
                node = np.zeros(n, dtype=np.uint64) if not n else set_hashes(keys, starts, sizes[own])
                columns = {"node": [None] * len(block), "bands": [None] * len(block)}
                columns |= {p: [None] * len(block) for p in PLANES}
                packed = {}
                for bit in range(BITS):
                    flags = ((low >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8).T
                    packed_rows = np.ascontiguousarray(np.packbits(flags, axis=1))
                    words = packed_rows.view(">u8").astype(np.int64)
                    for half in range(HASHES // 64):
                        packed[f"plane{bit}_{half}"] = words[:, half].tolist()
                node, bands = node.astype(np.int64).tolist(), bands.astype(np.int64).tolist()
                for i, at in enumerate(own.tolist()):
                    columns["node"][at], columns["bands"][at] = node[i], bands[i]
                    for p in PLANES:
                        columns[p][at] = packed[p][i]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in rows], pa.int64()),
                        pa.array(columns["node"], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(columns["bands"], pa.list_(pa.int64())),
                        *(pa.array(columns[p], pa.int64()) for p in PLANES),
                    ],
                    names,
                )

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    planes = ", ".join(f"{p} long" for p in PLANES)
    return plain.mapInArrow(
        run, f"doc_id long, node long, n_shingles long, bands array<long>, {planes}"
    )


def full_sets(docs: DataFrame) -> DataFrame:
    """``node, shingles`` of every row with shingles, its whole set."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            for rows in batches((None, t) for t in texts):
                keys, sizes, own, starts = _split([t for _, t in rows])
                if not len(own):
                    continue
                offsets = pa.array(np.append(starts, len(keys)), pa.int32())
                sets = pa.ListArray.from_arrays(offsets, pa.array(keys.astype(np.int64)))
                nodes = pa.array(set_hashes(keys, starts, sizes[own]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([nodes, sets], ["node", "shingles"])

    plain = docs.select(F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "node long, shingles array<long>")


def _may_link(a: str, b: str) -> Column:
    """Whether two signatures differ in few enough bit groups, and the sizes allow the threshold."""
    different = F.lit(0)
    for half in range(HASHES // 64):
        mark = F.lit(0).cast("long")
        for bit in range(BITS):
            p = f"plane{bit}_{half}"
            mark = mark.bitwiseOR(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}")))
        different = different + F.bit_count(mark)
    small = F.least(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"))
    large = F.greatest(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"))
    return (different <= MOST_DIFFERENT) & (100 * small >= PERCENT * large)


def _sets_of(needed: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, shingles`` of the needed nodes, read from one document of each."""
    ids = nodes.join(needed, "node", "left_semi").select("doc_id")
    texts = docs.select("doc_id", "text").join(if_small(ids, IDS_SENT), "doc_id", "left_semi")
    return pin(
        full_sets(texts).dropDuplicates(["node"]).join(needed, "node", "left_semi"), "sets"
    )


def _shared_counts(sets: DataFrame) -> DataFrame:
    """``node, counts``: shingles that another of the sets holds too, counted in ``CLASSES`` classes.

    Two sets cannot have more in common than the smaller count of each class, added up. Nodes
    without such a shingle link with nothing and are left out.
    """
    each = sets.select("node", F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    counted = (
        each.join(common, "shingle", "left_semi")
        .groupBy("node", F.pmod("shingle", F.lit(CLASSES)).cast("int").alias("class"))
        .agg(F.count("*").cast("int").alias("n"))
        .groupBy("node")
        .agg(F.map_from_entries(F.collect_list(F.struct("class", "n"))).alias("found"))
    )
    every = F.sequence(F.lit(0), F.lit(CLASSES - 1))
    counts = F.transform(every, lambda c: F.coalesce(F.element_at("found", c), F.lit(0)))
    return counted.select("node", counts.alias("counts"))


def _sets_allow(a: str, b: str) -> Column:
    """Whether the counts of shared shingles leave room for the threshold; no link fails this."""
    least = F.zip_with(f"{a}.counts", f"{b}.counts", lambda m, n: F.least(m, n))
    most = F.aggregate(least, F.lit(0), lambda total, n: total + n)
    sizes = F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")
    return 100 * most >= PERCENT * (sizes - most)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes whose whole sets reach the threshold."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"set_{name}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.where(
        100 * both >= PERCENT * (F.size("set_a") + F.size("set_b") - both)
    ).select("a", "b")


def _merge(component: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` with the components that ``links`` connect made one."""
    of = lambda side: component.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    label = connected(edges).withColumnRenamed("node", "component")
    return pin(
        component.join(label, "component", "left").select(
            "node", F.coalesce("label", "component").alias("component")
        ),
        "components",
    )


def components(signed: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, component`` of every set: the smallest node that links reach."""
    nodes = pin(
        signed.where("node is not null and doc_id is not null").dropDuplicates(["node"]), "nodes"
    )
    keyed = nodes.select(F.explode("bands").alias("key"), "node")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    candidates = pin(keyed.join(shared, "key", "left_semi"), "candidates")
    component = pin(nodes.select("node", F.col("node").alias("component")), "components")
    drawn = nodes.select("node", "doc_id", "n_shingles", *PLANES)
    for turn in range(HUB_ROUNDS + 1):
        placed = candidates.join(component, "node")
        apart = (
            placed.groupBy("key")
            .agg(
                F.min("component").alias("least"),
                F.max("component").alias("most"),
                F.min_by(
                    F.struct("node", "component"), F.xxhash64("node", "key", F.lit(turn))
                ).alias("hub"),
            )
            .where("least <> most")
            .select("key", "hub")
        )
        open_keys = placed.join(apart, "key")
        if turn < HUB_ROUNDS:
            pairs = (
                open_keys.where(F.col("component") != F.col("hub.component"))
                .select(F.col("node").alias("a"), F.col("hub.node").alias("b"))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct()
                .join(drawn.alias("x"), F.col("a") == F.col("x.node"))
                .join(drawn.alias("y"), F.col("b") == F.col("y.node"))
                .where(_may_link("x", "y"))
                .select("a", "b")
            )
        else:
            open_nodes = pin(open_keys.select("node").distinct(), "open")
            sets = _sets_of(open_nodes, drawn, docs)
            rest = (
                open_keys.select("key", "node", "component")
                .join(nodes.select("node", "n_shingles", "bands", *PLANES), "node")
                .join(_shared_counts(sets), "node")
            )
            same = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") < F.col("y.component"))
            once = F.element_at(F.array_intersect("x.bands", "y.bands"), 1) == F.col("x.key")
            pairs = (  # under the first key that both have
                rest.alias("x")
                .join(rest.alias("y"), same & _may_link("x", "y") & _sets_allow("x", "y") & once)
                .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
            )
        pairs = pin(pairs, "pairs")
        if pairs.isEmpty():
            continue
        if turn < HUB_ROUNDS:
            named = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
            sets = _sets_of(named, drawn, docs)
        links = pin(_confirmed(pairs, sets), "links")
        component = _merge(component, links)
    return component


def _with_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, node, component`` of every row; no component where nothing links."""
    signed = pin(signatures(docs), "signatures")
    rows = signed.select("doc_id", "node", "n_shingles")
    linked = F.col("component").isNotNull() & F.col("doc_id").isNotNull()
    placed = rows.join(components(signed, docs), "node", "left")
    return placed.withColumn("component", F.when(linked, F.col("component")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    placed = _with_components(docs)
    linked = F.col("component").isNotNull()
    first = placed.where(linked).groupBy("component").agg(F.min("doc_id").alias("first"))
    result = placed.join(first, "component", "left")
    component = F.when(linked, F.col("first")).otherwise(F.col("doc_id"))
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def _with_nodes(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, text, node``: every row as a struct, and the hash of its set."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            nodes = []
            for block in batches((t, t) for t in (v or b"" for v in part.column("text").cast(pa.binary()).to_pylist())):
                keys, sizes, own, starts = _split([t for _, t in block])
                found = [None] * len(block)
                if len(own):
                    hashes = set_hashes(keys, starts, sizes[own]).astype(np.int64).tolist()
                    for at, node in zip(own.tolist(), hashes, strict=True):
                        found[at] = node
                nodes += found
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(nodes, pa.int64())], [*part.schema.names, "node"]
            )

    rows = docs.select(
        F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("node", LongType())]))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the near-duplicates: the smallest ``doc_id`` of each component stays, once.

    Rows are told apart by ``doc_id`` and the hash of their set, so an id that stands over several
    texts loses those with a near copy only. Near copies under one id are copies too: the smallest
    hash stays. Rows without a ``doc_id`` stay; of rows with equal id and set, or with equal id and
    text where there is no word, one stays.
    """
    found = pin(_with_components(docs).select("doc_id", "node", "component"), "near-duplicates")
    own = F.struct("doc_id", "node")
    linked = found.where("component is not null")
    first = linked.groupBy("component").agg(F.min(own).alias("first"))
    gone = linked.join(first, "component").where(own != F.col("first")).select("doc_id", "node")
    gone = pin(gone.distinct(), "copies")
    again = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = if_small(pin(again, "repeated-ids"), IDS_SENT)
    single = docs.join(repeated, "doc_id", "left_anti").join(
        if_small(gone.select("doc_id").distinct(), IDS_SENT), "doc_id", "left_anti"
    )
    several = _with_nodes(docs.join(repeated, "doc_id", "left_semi").select(docs.columns))
    once = (
        several.join(if_small(gone, IDS_SENT), ["doc_id", "node"], "left_anti")
        .groupBy("doc_id", "node", F.when(F.col("node").isNull(), F.col("text")).alias("blank"))
        .agg(F.min_by("doc", F.coalesce("text", F.lit(""))).alias("doc"))
        .select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
    )
    return single.select(docs.columns).unionByName(once)
