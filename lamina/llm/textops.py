"""Array helpers for texts inside Spark tasks: byte blocks, word spans and 64-bit hashes.

Every function works on one block, the UTF-8 bytes of a handful of documents laid end to end, so
its memory follows the block and not the table. Words are runs of bytes outside
``\\x20 \\x09-\\x0D``; UTF-8 never uses those bytes inside a longer character, so spans found on
bytes are spans of characters.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Multipliers of the public 64-bit finaliser of MurmurHash3 and of the golden ratio (fixed values).
MIX_A, MIX_B, GOLDEN = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53), U64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_WORD_BASE = 0xD1342543DE82EF95
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Punctuation and signs of ASCII, marked per byte.
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def encode(text: str | None) -> bytes:
    """UTF-8 bytes of a text, none for null."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> U64(33))
    x *= MIX_A
    x ^= x >> U64(33)
    x *= MIX_B
    x ^= x >> U64(33)
    return x


def combine(left: np.ndarray, right: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    x = left * GOLDEN
    x ^= x >> U64(29)
    x += right + U64(salt)
    x *= MIX_A
    x ^= x >> U64(32)
    return x


class Block:
    """Documents laid end to end, each followed by one newline that belongs to none."""

    def __init__(self, texts: Sequence[bytes], lower: bool = False):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes + 1)))[:-1].astype(np.int64)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", dtype=np.uint8)
        if lower:
            self.data = _LOWER[self.data]

    def __len__(self) -> int:
        return len(self.sizes)

    def words(self) -> Words:
        return Words(self)


class Words:
    """Spans of the words of a block, in order: ``start``, ``end`` and ``doc`` of each."""

    def __init__(self, block: Block):
        self.block = block
        inside = np.empty(len(block.data) + 1, dtype=bool)
        inside[0] = False
        np.logical_not(_IS_SPACE[block.data], out=inside[1:])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        self.counts = np.zeros(len(block), dtype=np.int64)
        self.first = np.searchsorted(self.start, block.starts)
        if len(block):
            self.counts = np.diff(np.append(self.first, len(self.start)))
        self.doc = np.repeat(np.arange(len(block)), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def trim(self, edge: np.ndarray) -> Words:
        """Takes the bytes marked in ``edge`` off both ends of every word; empty words go."""
        last = len(self.block.data) - 1
        while len(self):
            head = (self.start < self.end) & edge[self.block.data[np.minimum(self.start, last)]]
            self.start = self.start + head
            tail = (self.start < self.end) & edge[self.block.data[self.end - 1]]
            self.end = self.end - tail
            if not (head.any() or tail.any()):
                break
        keep = self.start < self.end
        self.start, self.end, self.doc = self.start[keep], self.end[keep], self.doc[keep]
        self.counts = np.bincount(self.doc, minlength=len(self.block))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))[:-1]
        return self

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        if not len(self):
            return np.empty(0, dtype=np.uint64)
        length = self.end - self.start
        total = int(length.sum())
        powers = _powers(int(length.max()))
        before = np.concatenate(([0], np.cumsum(length)[:-1]))
        at = np.arange(total) - np.repeat(before, length)
        letters = self.block.data[at + np.repeat(self.start, length)]
        sums = np.add.reduceat(_BYTE_VALUES[letters] * powers[at], before)
        return mix(sums + length.astype(np.uint64) * GOLDEN)

    def texts(self) -> list[bytes]:
        raw = self.block.data.tobytes()
        return [raw[s:e] for s, e in zip(self.start.tolist(), self.end.tolist(), strict=True)]


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers 0..n-1 of the word base modulo 2**64, kept between calls."""
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.concatenate(
            ([U64(1)], np.cumprod(np.full(max(n, 64) * 5 // 4, U64(_WORD_BASE), dtype=np.uint64)))
        )
    return _POWERS


_INVERSE = np.ones(1, dtype=np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    """Powers 0..n-1 of the word base's inverse modulo 2**64, kept between calls."""
    global _INVERSE
    if len(_INVERSE) < n:
        base = U64(pow(_WORD_BASE, -1, 2**64))
        _INVERSE = np.concatenate(
            ([U64(1)], np.cumprod(np.full(max(n, 64) * 5 // 4, base, dtype=np.uint64)))
        )
    return _INVERSE


def windows(hashes: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` words; entry i covers words i..i+size-1 of the block."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    step, factor = 0x2545F4914F6CDD1D + 2 * salt, 1
    for k in range(size):
        factor = factor * step & (2**64 - 1)
        total += hashes[k : k + n] * U64(factor)
    return mix(total + U64(salt))


class Table:
    """Distinct 64-bit keys spread over slots, so that most look-ups touch one of them.

    Keys that share a slot move on to a further, smaller set of slots until every key has its own.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels = []
        salt = 1
        while len(keys):
            shift = U64(max(64 - 30, 63 - int(len(keys) - 1).bit_length()) if len(keys) > 1 else 62)
            slots = np.zeros(1 << int(64 - int(shift)), dtype=np.int64)
            at = ((keys ^ U64(salt)) * GOLDEN) >> shift
            slots[at] = np.arange(1, len(keys) + 1)
            self.levels.append((U64(salt), shift, slots, keys, values))
            left = slots[at] != np.arange(1, len(keys) + 1)
            keys, values, salt = keys[left], values[left], salt + 2

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, 0 where the table has none."""
        found = np.zeros(len(keys))
        rest = None
        for salt, shift, slots, own, values in self.levels:
            asked = keys if rest is None else keys[rest]
            at = slots[((asked ^ salt) * GOLDEN) >> shift] - 1
            hit = own[at] == asked
            if rest is None:
                found = np.where(hit, values[at], 0.0)
                rest = np.flatnonzero(~hit)
            else:
                found[rest[hit]] = values[at[hit]]
                rest = rest[~hit]
        return found


def within_document(words: Words, size: int) -> np.ndarray:
    """Marks the windows of ``size`` words that stay inside one document."""
    n = len(words) - size + 1
    return words.doc[:n] == words.doc[size - 1 :] if n > 0 else np.empty(0, dtype=bool)


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Marks the items of ``total`` that lie in a window of ``size`` items from one of ``starts``."""
    steps = np.zeros(total + 1, dtype=np.int32)
    steps[starts] = 1
    ends = np.zeros(total + 1, dtype=np.int32)
    ends[starts + size] = 1
    return np.cumsum(steps - ends)[:total] > 0


class ByteSums:
    """Prefix sums over a block from which the hash of any byte string of 8 bytes or more follows.

    Every run of 8 bytes is mixed to 64 bits first; a string is the sum of its mixed runs times
    powers of an odd base, so equal strings have equal hashes wherever they stand.
    """

    def __init__(self, data: np.ndarray):
        n = max(len(data) - 7, 0)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        if n:
            raw = np.ascontiguousarray(data)
            runs = np.ndarray((n,), dtype="<u8", buffer=raw.data, strides=(1,))
            np.cumsum(mix(runs) * _powers(n)[:n], out=self.sums[1:])

    def hashes(self, at: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
        """Hash of the ``size`` bytes from each position; every string must lie in the block."""
        total = self.sums[at + (size - 7)] - self.sums[at]
        if len(at):
            total *= _inverse_powers(int(at.max()) + 1)[at]
        return mix(total + U64(salt))


def tidy() -> None:
    """Gives memory that is no longer used back to the system, as workers live through many tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def batches(rows: Iterator, most: int = 500_000) -> Iterator[list]:
    """Groups ``(key, bytes)`` rows into lists of about ``most`` bytes, one row at least."""
    tidy()
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + 1
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
