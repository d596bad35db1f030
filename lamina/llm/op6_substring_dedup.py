"""Repeated word windows: a count-min prefilter, then exact groups of what it lets through.

A word goes if a window of ``WINDOW`` words that covers it also starts in a document with a smaller
``doc_id``.

1. Every bucket of documents sketches its windows: in each of ``ROWS`` rows a window counts in the
   cell that the row's hash names. Sketches are sent as sorted occupied cells and merged cell by
   cell, a shard at a time, so that the sketch can be far wider than a machine's memory and keeps
   its width per window whatever the corpus. Counts saturate at two, all the filter asks. A merged
   count never falls below the true one: a window with a cell below two in any row stands once.
2. Windows estimated to repeat are grouped by their whole 64-bit hash with the smallest ``doc_id``
   that holds them; every other bucket learns whether a smaller one than its own exists.

Defined results: a null text has no words; texts shorter than a window stay whole; a row without a
``doc_id`` keeps all its words and removes none from others; rows that repeat under one id keep
what they share; an empty table gives an empty result; other columns come back in ``rest``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import exchange as x
from lamina.llm.textops import Block, Words, batches, combine, covered, windows, within_document

WINDOW = 13
#: Rows of the sketch and its cells per window and row, as a power of two.
ROWS, CELLS_PER_WINDOW_BITS = 2, 2
#: Bytes of text that a word takes at the least, to size the sketch before words are counted.
BYTES_PER_WORD = 4
EXACT, AHEAD = ROWS, ROWS + 1
EXACT_BITS = 64


def cell_bits(total: int) -> int:
    """Bits of a cell number for a corpus of ``total`` bytes; at least one shard number's 32."""
    return max(32, math.ceil(math.log2(max(total, 2) / BYTES_PER_WORD)) + CELLS_PER_WINDOW_BITS)


class _Part:
    """Some documents of a bucket: words, their windows, and the documents' ids."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, texts: list[bytes]):
        self.texts = texts
        self.words: Words = Block(texts).words()
        hashes = self.words.hashes()
        self.windows = windows(hashes, WINDOW)
        inside = within_document(self.words, WINDOW)
        first = self.words.doc[: len(self.windows)]
        self.at = np.flatnonzero(inside & known[first]) if len(first) else np.empty(0, np.int64)
        self.owner = ids[self.words.doc[self.at]]

    def cells(self, row: int, bits: int) -> np.ndarray:
        own = self.windows[self.at]
        return combine(own, own, salt=2 * row + 1) >> np.uint64(64 - bits)


def _parts(table: pa.Table) -> Iterator[_Part]:
    ids = table["doc_id"].combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for rows in batches(enumerate(x.bytes_of(table))):
        own = np.array([i for i, _ in rows])
        yield _Part(ids[own], known[own], [t for _, t in rows])


def _joined(arrays: list[np.ndarray], kind=np.uint64) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, dtype=kind)


def _earliest(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and the smallest owner of each."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.empty(0, bool)
    return keys[first], owners[first]


def _pack_owners(owners: np.ndarray) -> bytes:
    planes = owners.astype("<i8").view(np.uint8).reshape(-1, 8).T
    return x.squeeze(np.ascontiguousarray(planes).tobytes())


def _unpack_owners(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(x.stretch(packed), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def flag_earlier(sent: DataFrame) -> DataFrame:
    """For every key that was sent with its owner: whether another bucket has a smaller owner."""

    def run(table: pa.Table) -> pa.Table:
        out, held = [], []
        for row in table.to_pylist():
            back = {k: row[k] for k in ("bucket", "shard")}
            if row["keys"] is None:
                out.append(back | {"tag": -row["tag"], "flags": row["marks"]})
            else:
                held.append((back, x.unpack_keys(row["keys"]), _unpack_owners(row["marks"])))
        if held:
            keys, owners = _earliest(
                np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            )
            for back, own, owner in held:
                found = owners[np.searchsorted(keys, own)] < owner
                out.append(back | {"tag": EXACT, "flags": x.pack_bits(found)})
        return pa.Table.from_pylist(out, schema=x._FLAGS)

    return sent.groupBy("shard").applyInArrow(run, x.FLAGS)


def repeated_words(dealt: x.Deal) -> DataFrame:
    """``rest, doc_id, n_words, n_removed, kept``: what is left of every row, words and one space."""
    bits, shards = cell_bits(dealt.total), dealt.buckets

    def sketch(table: pa.Table) -> Iterator[dict]:
        parts = [[p.cells(r, bits) for r in range(ROWS)] for p in _parts(table)]
        bucket = table["bucket"][0].as_py()
        for r in range(ROWS):
            cells, twice = x.distinct(_joined([p[r] for p in parts]))
            yield from x.range_rows(bucket, r, cells, bits, shards, lambda s, t=twice: x.pack_bits(t[s]))

    def send_windows(table: pa.Table, flags: dict) -> Iterator[dict]:
        parts = list(_parts(table))
        ahead = [np.ones(len(p.at), dtype=bool) for p in parts]
        for r in range(ROWS):
            own = [p.cells(r, bits) for p in parts]
            cells, _ = x.distinct(_joined(own))
            repeated = x.joined_bits(flags.get(r))
            for mask, mine in zip(ahead, own, strict=True):
                mask &= repeated[np.searchsorted(cells, mine)] if len(cells) else False
        keys, owners = _earliest(
            _joined([p.windows[p.at[m]] for p, m in zip(parts, ahead, strict=True)]),
            _joined([p.owner[m] for p, m in zip(parts, ahead, strict=True)], np.int64),
        )
        bucket = table["bucket"][0].as_py()
        yield from x.range_rows(
            bucket, EXACT, keys, EXACT_BITS, shards, lambda s: _pack_owners(owners[s])
        )
        yield x.passed_on(bucket, AHEAD, shards, _joined(ahead, bool))

    def finish(table: pa.Table, flags: dict) -> pa.Table:
        parts = list(_parts(table))
        mask = x.joined_bits(flags.get(AHEAD))
        near, at = [], 0
        for p in parts:
            near.append(p.at[mask[at : at + len(p.at)]])
            at += len(p.at)
        own = [p.windows[n] for p, n in zip(parts, near, strict=True)]
        owner = [p.owner[np.searchsorted(p.at, n)] for p, n in zip(parts, near, strict=True)]
        keys, least = _earliest(_joined(own), _joined(owner, np.int64))
        earlier = x.joined_bits(flags.get(EXACT))
        total, removed, kept = [], [], []
        for p, n, k, o in zip(parts, near, own, owner, strict=True):
            i = np.searchsorted(keys, k)
            gone = covered(n[earlier[i] | (o > least[i])] if len(keys) else n, WINDOW, len(p.words) + WINDOW)
            gone = gone[: len(p.words)]
            total += p.words.counts.tolist()
            last = p.words.first + p.words.counts
            raw, starts, ends = p.words.block.data.tobytes(), p.words.start, p.words.end
            for f, z in zip(p.words.first.tolist(), last.tolist(), strict=True):
                left = f + np.flatnonzero(~gone[f:z])
                removed.append(z - f - len(left))
                kept.append(
                    b" ".join([raw[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist(), strict=True)])
                )
        return pa.table(
            {
                "rest": table["rest"],
                "doc_id": table["doc_id"],
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    estimated = x.flag_repeats(x.per_bucket(dealt, sketch, x.KEYS))
    exact = flag_earlier(x.with_answers(dealt, estimated, send_windows, x.KEYS))
    return x.with_answers(
        dealt,
        exact,
        finish,
        f"rest {dealt.rest_type}, doc_id long, n_words long, n_removed long, kept string",
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text`` and any others) without words seen earlier."""
    return repeated_words(x.deal(docs))


def digest(removed: DataFrame) -> DataFrame:
    """The columns of the query."""
    return removed.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
