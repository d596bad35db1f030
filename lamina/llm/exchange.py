"""Exchanges of packed keys between buckets of documents and shards of keys.

Operators that ask, for each position of each text, what the rest of the corpus holds would shuffle
one row per position. Here documents are dealt into buckets of some megabytes; each bucket sends its
distinct keys sorted, delta-coded and compressed, one binary row per shard; shards answer with one
packed row per bucket. A key that stands in a third of all documents reaches its shard once per
bucket. All passes over the documents read the same exchange of the dealt rows, so texts cross the
network once.

Bucket functions put their rows in the order of ``doc_id`` and text, so that every pass sees the
same positions, also when a lost executor's work runs again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import parts_for, text_bytes

#: A bucket holds the text that one task works on. It grows with the root of the input, so that
#: buckets times shards do not grow with its square, from the first bound to the second.
BUCKET_BYTES = (8_000_000, 32_000_000)
SHARD_PRIME = 1_000_003
KEYS = "shard int, bucket int, tag int, keys binary, marks binary"
FLAGS = "bucket int, shard int, tag int, flags binary"
_KEYS = pa.schema(
    [("shard", pa.int32()), ("bucket", pa.int32()), ("tag", pa.int32()), ("keys", pa.binary()), ("marks", pa.binary())]
)
_FLAGS = pa.schema(
    [("bucket", pa.int32()), ("shard", pa.int32()), ("tag", pa.int32()), ("flags", pa.binary())]
)


@dataclass(frozen=True)
class Deal:
    """Documents dealt into buckets: columns ``bucket, doc_id, text, rest``."""

    rows: DataFrame
    total: int
    buckets: int
    rest_type: str


def deal(docs: DataFrame) -> Deal:
    """Deals rows by id, text and place; ``rest`` holds every column but the text.

    ``docs`` is read from stored files, whose splits every attempt of a task reads in the same order,
    so a row keeps its place, and rows that are equal in id and text still spread over the buckets.
    """
    total = text_bytes(docs)
    least, most = BUCKET_BYTES
    buckets = parts_for(total, int(min(most, max(least, 300 * math.sqrt(total)))))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(buckets))
        .cast("int")
        .alias("bucket"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(*others).alias("rest"),
    )
    return Deal(rows, total, buckets, rows.schema["rest"].dataType.simpleString())


def per_bucket(dealt: Deal, work: Callable[[pa.Table], Iterator[dict] | list[dict]], schema: str) -> DataFrame:
    """One pass over the documents; ``work`` gets a bucket's rows in their fixed order."""
    send = _sender(schema)
    return dealt.rows.groupBy("bucket").applyInArrow(lambda t: send(work(_ordered(t))), schema)


def with_answers(
    dealt: Deal, answers: DataFrame, work: Callable[[pa.Table, dict], Iterator[dict]], schema: str
) -> DataFrame:
    """Another pass, with the bucket's answers: ``{tag: flags of its keys in shard order}``."""
    send = _sender(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            return send([])
        return send(work(_ordered(left), _by_tag(right)))

    return (
        dealt.rows.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(run, schema)
    )


def _sender(schema: str) -> Callable[[Iterator[dict] | list[dict] | pa.Table], pa.Table]:
    arrow = {KEYS: _KEYS, FLAGS: _FLAGS}.get(schema)

    def send(made) -> pa.Table:
        return made if isinstance(made, pa.Table) else pa.Table.from_pylist(list(made), schema=arrow)

    return send


def _ordered(table: pa.Table) -> pa.Table:
    order = pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")])
    return table.take(order)


def _by_tag(table: pa.Table) -> dict[int, list[bytes]]:
    rows = sorted(
        zip(table["tag"].to_pylist(), table["shard"].to_pylist(), table["flags"].to_pylist(), strict=True)
    )
    found: dict[int, list[bytes]] = {}
    for tag, _, flags in rows:
        found.setdefault(tag, []).append(flags)
    return found


def bytes_of(table: pa.Table) -> list[bytes]:
    """UTF-8 bytes of the texts, none for null."""
    return [t or b"" for t in table["text"].cast(pa.binary()).to_pylist()]


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def stretch(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], size, "zstd", asbytes=True) if size else b""


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte plane by byte plane, compressed."""
    steps = np.diff(keys.astype(np.uint64), prepend=np.uint64(0))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return squeeze(np.ascontiguousarray(planes).tobytes())


def unpack_keys(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(stretch(packed), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64))


def pack_bits(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(8, "little") + squeeze(np.packbits(flags).tobytes())


def unpack_bits(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    bits = np.frombuffer(stretch(packed[8:]), dtype=np.uint8)
    return np.unpackbits(bits, count=size).astype(bool)


def joined_bits(packed: list[bytes] | None) -> np.ndarray:
    """Flags of all keys of a bucket, in the order in which its shards hold them."""
    parts = [unpack_bits(p) for p in packed or []]
    return np.concatenate(parts) if parts else np.empty(0, dtype=bool)


def range_rows(bucket: int, tag: int, keys: np.ndarray, bits: int, shards: int, marks=None) -> Iterator[dict]:
    """Rows that send ascending keys of ``bits`` bits; shard s holds the s-th range of keys.

    ``marks(slice)`` packs what goes along with the keys. Different tags use different shards.
    """
    edges = [-(-s * 2**32 // shards) << (bits - 32) for s in range(shards)]
    cuts = np.append(np.searchsorted(keys, np.array(edges, dtype=np.uint64)), len(keys))
    for s in range(shards):
        own = slice(int(cuts[s]), int(cuts[s + 1]))
        if own.start < own.stop:
            yield {
                "shard": tag * shards + s,
                "bucket": bucket,
                "tag": tag,
                "keys": pack_keys(keys[own]),
                "marks": marks(own) if marks else None,
            }


def passed_on(bucket: int, tag: int, shards: int, mask: np.ndarray) -> dict:
    """A mask that a bucket leaves for its own later pass; shards hand it back unread."""
    return {"shard": bucket % shards, "bucket": bucket, "tag": -tag, "keys": None, "marks": pack_bits(mask)}


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and whether each stands twice or more."""
    ordered = np.sort(keys)
    if not len(ordered):
        return ordered, np.empty(0, dtype=bool)
    first = np.append(True, ordered[1:] != ordered[:-1])
    again = np.append(~first[1:], False)
    return ordered[first], again[first]


def flag_repeats(sent: DataFrame) -> DataFrame:
    """For every key that was sent: whether it stands twice or more in all buckets together."""

    def run(table: pa.Table) -> pa.Table:
        out, held, counted = [], [], []
        for row in table.to_pylist():
            if row["keys"] is None:
                out.append({k: row[k] for k in ("bucket", "shard")} | {"tag": -row["tag"], "flags": row["marks"]})
                continue
            keys = unpack_keys(row["keys"])
            held.append((row, keys))
            counted += [keys, keys[unpack_bits(row["marks"])]]
        if held:
            values, twice = distinct(np.concatenate(counted))
            repeated = values[twice]
            for row, keys in held:
                at = np.searchsorted(repeated, keys)
                found = np.zeros(len(keys), dtype=bool)
                inside = at < len(repeated)
                found[inside] = repeated[at[inside]] == keys[inside]
                out.append({k: row[k] for k in ("bucket", "shard", "tag")} | {"flags": pack_bits(found)})
        return pa.Table.from_pylist(out, schema=_FLAGS)

    return sent.groupBy("shard").applyInArrow(run, FLAGS)


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a non-negative key of a table that buckets look up."""
    return (key % SHARD_PRIME % shards).cast("int")


def lookup_order(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ascending keys by shard, and where each shard begins in that order."""
    shard = (keys % np.uint64(SHARD_PRIME) % np.uint64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def lookup_rows(bucket: int, tag: int, keys: np.ndarray, shards: int) -> Iterator[dict]:
    """Rows that ask the shards for the values of ascending distinct keys."""
    order, cuts = lookup_order(keys, shards)
    for s in range(shards):
        if cuts[s] < cuts[s + 1]:
            asked = keys[order[cuts[s] : cuts[s + 1]]]
            yield {"shard": s, "bucket": bucket, "tag": tag, "keys": pack_keys(asked), "marks": None}


def answer(asked: DataFrame, table: DataFrame) -> DataFrame:
    """Values of the keys that buckets ask for, 0 where ``table`` has none.

    ``table`` holds ``shard, tag, key, value`` with one row per tag and key.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {}
        tags = right["tag"].to_numpy()
        for tag in np.unique(tags):
            own = tags == tag
            keys = right["key"].to_numpy()[own].astype(np.uint64)
            order = np.argsort(keys)
            known[tag] = keys[order], right["value"].to_numpy()[own][order]
        out = []
        for row in left.to_pylist():
            keys = unpack_keys(row["keys"])
            have, values = known.get(row["tag"], (np.empty(0, np.uint64), np.empty(0)))
            found = np.zeros(len(keys))
            at = np.searchsorted(have, keys)
            inside = at < len(have)
            hit = np.zeros(len(keys), dtype=bool)
            hit[inside] = have[at[inside]] == keys[inside]
            found[hit] = values[at[hit]]
            planes = found.astype("<f8").view(np.uint8).reshape(-1, 8).T
            out.append({k: row[k] for k in ("bucket", "shard", "tag")} | {"flags": squeeze(np.ascontiguousarray(planes).tobytes())})
        return pa.Table.from_pylist(out, schema=_FLAGS)

    return asked.groupBy("shard").cogroup(table.groupBy("shard")).applyInArrow(run, FLAGS)


def answered(packed: list[bytes] | None, keys: np.ndarray, shards: int) -> np.ndarray:
    """The values that came back for ascending distinct keys, in the order of the keys."""
    values = np.zeros(len(keys))
    if len(keys):
        order, _ = lookup_order(keys, shards)
        came = []
        for p in packed:
            planes = np.frombuffer(stretch(p), dtype=np.uint8).reshape(8, -1)
            came.append(np.ascontiguousarray(planes.T).view("<f8").ravel())
        values[order] = np.concatenate(came)
    return values
