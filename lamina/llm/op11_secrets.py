"""Secrets in texts: fixed patterns, and values in credential contexts that would be hard to guess.

Three patterns give the base findings: assignments to names such as ``password``, access key ids and
long hexadecimal runs. Values that stand where a credential would (after a wider set of names and
signs, or before the ``@`` of an address) are judged by what a guesser would have to spend: the
cheapest way to cut the value into words, dates, repeats, keyboard or alphabet walks and stretches of
brute force, found by dynamic programming in time linear in the value. Values of ``MIN_BITS`` or more
that no assignment covers are findings of kind ``guess``.

Words are ranked by how often they occur in all documents; the ``WORDS`` most frequent are known to
the guesser, and rank r costs log2(r) bits. A segment's kind costs log2(5) bits more.

Defined results: a null text is empty and has no findings; positions are code points; repeated rows
are judged alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import pin
from lamina.llm.textops import tidy

#: Words the guesser knows, and the bits from which a value counts as a secret.
WORDS = 50_000
MIN_BITS = 36.0
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "guess")
#: Text whose words a task combines before they are sent.
COMBINE_CHARS = 12_000_000

# The base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
# Where else a credential may stand: after a name and a sign or verb, or in an address.
_NAMED = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|credentials?)"""
    r"""(?:["']?[\x20\t]{0,3}(?::=|=>|->|[:=])|[\x20\t]{1,3}(?:is|was))[\x20\t]{0,3}["'`]?"""
    r"""([^\x20\x09-\x0D"'`<>]+)""",
    re.IGNORECASE | re.ASCII,
)
_NAMED_STEMS = ("pass", "pwd", "secret", "token", "api", "access", "credential")
_ADDRESS = re.compile(r"://[^\x20\x09-\x0D:/@]+:([^\x20\x09-\x0D/@]+)@")
_TAIL = ".,;:!?)]}"

KIND_BITS = math.log2(5)
# Keys of the keyboard by row, each row half a key to the right of the one above.
_ROWS = ("`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./")
_SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))
_PLACE = {key: (x, y) for y, row in enumerate(_ROWS) for x, key in enumerate(row) if key != " "}
_NEXT_TO = {(-1, 0): 0, (1, 0): 1, (0, -1): 2, (1, -1): 3, (-1, 1): 4, (0, 1): 5}
# Signs that stand for a letter.
_LEET = str.maketrans("@43105$7!", "aaeiosst" + "i")
_ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LONGEST_WORD = 24
LONGEST_UNIT = 8
_DATES = (
    re.compile(r"(?P<d>[0-9]{1,2})(?P<sep>[-/._])(?P<m>[0-9]{1,2})(?P=sep)(?P<y>[0-9]{4}|[0-9]{2})"),
    re.compile(r"(?P<y>[0-9]{4})(?P<sep>[-/._])(?P<m>[0-9]{1,2})(?P=sep)(?P<d>[0-9]{1,2})"),
    re.compile(r"(?P<d>[0-9]{2})(?P<m>[0-9]{2})(?P<y>[0-9]{4})"),
    re.compile(r"(?P<y>[0-9]{4})(?P<m>[0-9]{2})(?P<d>[0-9]{2})"),
    re.compile(r"(?P<d>[0-9]{2})(?P<m>[0-9]{2})(?P<y>[0-9]{2})"),
    re.compile(r"(?P<y>[0-9]{4})"),
)
YEARS = range(1900, 2100)
DATE_BITS = math.log2(365.25 * len(YEARS))
SEPARATOR_BITS = 2.0
YEAR_BITS = math.log2(len(YEARS))


def sign_bits(sign: str) -> float:
    """What one sign costs by brute force: its class among those of ASCII, 12 bits beyond."""
    if "0" <= sign <= "9":
        return math.log2(10)
    if "a" <= sign <= "z" or "A" <= sign <= "Z":
        return math.log2(26)
    return math.log2(33) if " " <= sign <= "~" else 12.0


def case_bits(word: str) -> float:
    """What guessing the capitals of a word costs."""
    upper = sum("A" <= c <= "Z" for c in word)
    lower = len(word) - upper
    if not upper:
        return 0.0
    if not lower or (upper == 1 and "A" <= word[0] <= "Z"):
        return 1.0
    return math.log2(sum(math.comb(upper + lower, k) for k in range(1, min(upper, lower) + 1)))


def keyboard(left: str, right: str) -> int | None:
    """The direction from one key to the next, if they touch."""
    a, b = _PLACE.get(left), _PLACE.get(right)
    return None if a is None or b is None else _NEXT_TO.get((b[0] - a[0], b[1] - a[1]))


def alphabet(left: str, right: str) -> int | None:
    """Forwards or backwards from one letter or digit to its neighbour."""
    if not (left.isascii() and left.isalnum() and right.isascii() and right.isalnum()):
        return None
    step = ord(right) - ord(left)
    return {1: 0, -1: 1}.get(step) if left.isdigit() == right.isdigit() else None


#: Direction, bits of the first sign and bits of a turn; going straight on costs half a bit.
WALKS = ((keyboard, math.log2(47), math.log2(6)), (alphabet, math.log2(36), 1.0))
STRAIGHT_BITS = 0.5


def dates(value: str, at: int) -> Iterator[tuple[int, float]]:
    """Ends and bits of the dates and years that start at a place."""
    for form in _DATES:
        found = form.match(value, at)
        if found is None:
            continue
        part = found.groupdict()
        if len(part["y"]) == 4 and int(part["y"]) not in YEARS:
            continue
        if "d" not in part:
            yield found.end(), YEAR_BITS
            continue
        day, month = sorted((int(part["d"]), int(part["m"])), reverse=True)
        if 1 <= month <= 12 and 1 <= day <= 31:
            yield found.end(), DATE_BITS + (SEPARATOR_BITS if "sep" in part else 0.0)


class Guesser:
    """Bits that guessing a value takes, with words by rank."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self._units: dict[str, float] = {}

    def word_bits(self, value: str, low: str, plain: str, i: int, j: int) -> float | None:
        rank = self.ranks.get(low[i:j])
        if rank is not None:
            return math.log2(rank) + case_bits(value[i:j])
        rank = self.ranks.get(plain[i:j])
        if rank is None:
            return None
        signs = sum(a != b for a, b in zip(low[i:j], plain[i:j], strict=True))
        return math.log2(rank) + case_bits(value[i:j]) + signs

    def unit_bits(self, unit: str) -> float:
        if unit not in self._units:
            if len(self._units) > 100_000:
                self._units.clear()
            self._units[unit] = self.bits(unit, repeats=False)
        return self._units[unit]

    def bits(self, value: str, repeats: bool = True) -> float:
        """The cheapest cut of the whole value.

        Brute force and walks go on sign by sign in states of their own; words and dates have a
        greatest length; a repeat takes as many copies of its unit as there are. So every place
        has a bounded number of ways on.
        """
        n = len(value)
        low = value.translate(_ASCII_LOWER)
        plain = low.translate(_LEET)
        keys = "".join(_SHIFTED.get(c, c) for c in low)
        shifted = [a != b for a, b in zip(value, keys, strict=True)]
        best = [math.inf] * (n + 1)
        best[0] = 0.0
        brute = math.inf
        # Per kind of walk: its bits with one sign and, by direction of the last step, with two and with more.
        walks = [(math.inf, math.inf, math.inf, None) for _ in WALKS]
        runs = [[0] * (n + LONGEST_UNIT + 1) for _ in range(LONGEST_UNIT + 1)]
        if repeats:
            for p in range(1, min(LONGEST_UNIT, n) + 1):
                run = runs[p]
                for i in range(n - p - 1, -1, -1):
                    run[i] = run[i + 1] + 1 if value[i] == value[i + p] else 0
        for i in range(n):
            here = best[i]
            # One sign on by brute force.
            brute = min(brute, here + KIND_BITS) + sign_bits(value[i])
            if brute < best[i + 1]:
                best[i + 1] = brute
            # One sign on in a walk, or its first sign.
            for k, (direction, first, turn) in enumerate(WALKS):
                one, two, more, last = walks[k]
                way = direction(keys[i - 1], keys[i]) if i else None
                shift = float(shifted[i] != shifted[i - 1]) if i else float(shifted[i])
                if way is None:
                    two = more = math.inf
                else:
                    on = STRAIGHT_BITS + (0.0 if way == last else turn) + shift
                    two, more = one + turn + STRAIGHT_BITS + shift, min(two, more) + on
                one = here + KIND_BITS + first + float(shifted[i])
                walks[k] = one, two, more, way
                if more < best[i + 1]:
                    best[i + 1] = more
            for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
                bits = self.word_bits(value, low, plain, i, j)
                if bits is not None and here + KIND_BITS + bits < best[j]:
                    best[j] = here + KIND_BITS + bits
            if value[i].isascii() and value[i].isdigit():
                for j, bits in dates(value, i):
                    best[j] = min(best[j], here + KIND_BITS + bits)
            if repeats:
                for p in range(1, min(LONGEST_UNIT, n - i) + 1):
                    copies = 1 + runs[p][i] // p
                    if copies >= (3 if p == 1 else 2):
                        j = i + copies * p
                        bits = self.unit_bits(value[i : i + p]) + math.log2(copies)
                        best[j] = min(best[j], here + KIND_BITS + bits)
        return best[n]


@dataclass(frozen=True)
class Finding:
    kind: str
    start: int
    end: int
    value_start: int
    value_end: int
    bits: float | None


def base_findings(text: str, lower: str) -> list[Finding]:
    """What the fixed patterns find; ``lower`` is the text in lower case."""
    found = []
    if any(name in lower for name in _ASSIGN_NAMES):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                found.append(("assign", m.start(), m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m.start(), m.end()) for m in _HEX.finditer(text)]
    return [Finding(*f, None) for f in found]


def contexts(text: str, lower: str) -> Iterator[tuple[int, int]]:
    """Where values stand in credential contexts."""
    if any(stem in lower for stem in _NAMED_STEMS):
        for m in _NAMED.finditer(text):
            yield m.start(1), m.start(1) + len(m[1].rstrip(_TAIL))
    if "://" in lower:
        for m in _ADDRESS.finditer(text):
            yield m.span(1)


def findings(text: str, guesser: Guesser) -> list[Finding]:
    """All findings by start and kind; assigned values come with their bits."""
    lower = text.lower()
    base = base_findings(text, lower)
    out, taken = [], []
    for f in base:
        if f.kind == "assign":
            bits = guesser.bits(text[f.value_start : f.value_end])
            f = Finding(f.kind, f.start, f.end, f.value_start, f.value_end, bits)
        out.append(f)
        taken.append((f.start, f.end))
    taken.sort()
    at, reach = 0, -1
    for start, end in sorted(set(contexts(text, lower))):
        while at < len(taken) and taken[at][0] <= start:
            reach = max(reach, taken[at][1])
            at += 1
        covered = start < reach or (at < len(taken) and taken[at][0] < end)
        if covered or end - start < LEAST_VALUE:
            continue
        bits = guesser.bits(text[start:end])
        if bits >= MIN_BITS:
            out.append(Finding("guess", start, end, start, end, bits))
            reach = max(reach, end)
    return sorted(out, key=lambda f: (f.start, KINDS.index(f.kind), f.end))


def _named_words(counts: Counter) -> Counter:
    """Tokens without signs at their ends, if letters are left and nothing else."""
    out: Counter = Counter()
    for token, n in counts.items():
        word = token if token.isalpha() else token.strip(".,;:!?\"'`()[]{}<>*#$%&|-")
        if 3 <= len(word) <= LONGEST_WORD and word.isalpha():
            out[word] += n
    return out


def word_ranks(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``word, n`` of the most frequent words of letters in all documents, ``words`` of them."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = Counter(), 0

        def sent() -> pa.RecordBatch:
            found = _named_words(held)
            columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for part in parts:
            for text in part.column("text").to_pylist():
                held.update(text.lower().split())
                size += len(text)
                if size >= COMBINE_CHARS:
                    yield sent()
                    held, size = Counter(), 0
                    tidy()
        if held:
            yield sent()

    texts = docs.selectExpr("cast(text as string) text").where("text is not null")
    counts = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return pin(counts.orderBy(F.desc("n"), "word").limit(words), "word-ranks")


def _send(ranked: DataFrame):
    rows = ranked.orderBy(F.desc("n"), "word").collect()
    ranks = {row["word"]: k + 1 for k, row in enumerate(rows)}
    return ranked.sparkSession.sparkContext.broadcast(ranks)


def find(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, findings`` of every row; a finding has its kind, span, value span and bits."""
    shared = _send(word_ranks(docs, words))
    names = ["kind", "start", "end", "value_start", "value_end", "bits"]
    kinds = [pa.string(), *[pa.int64()] * 4, pa.float64()]
    lists = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesser = Guesser(shared.value)
        for part in parts:
            found = [
                [{c: getattr(f, c) for c in names} for f in findings(t, guesser)] if t else []
                for t in part.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, lists)], ["doc_id", "findings"]
            )

    plain = docs.selectExpr("doc_id", "cast(text as string) text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(
        run,
        f"doc_id {kind}, findings array<struct<kind:string,start:long,end:long,value_start:long,"
        "value_end:long,bits:double>>",
    )


def redacted(docs: DataFrame, words: int = WORDS, mark: str = "<secret>") -> DataFrame:
    """``doc_id, text`` with the value of every finding replaced."""
    shared = _send(word_ranks(docs, words))

    def clean(text: str, guesser: Guesser) -> str:
        out, here = [], 0
        for start, end in sorted((f.value_start, f.value_end) for f in findings(text, guesser)):
            if start >= here:
                out += [text[here:start], mark]
            here = max(here, end)
        return "".join([*out, text[here:]])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesser = Guesser(shared.value)
        for part in parts:
            texts = [clean(t, guesser) if t else t for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    plain = docs.selectExpr("doc_id", "cast(text as string) text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, text string")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query, and how many findings have ``MIN_BITS`` or more."""
    said = "concat(f.kind, ':', f.start, ':', f.end)"
    joined = "array_join(transform({0}, f -> " + said + "), ',')"
    base = "filter(findings, f -> f.kind <> 'guess')"
    count = "cast(size(filter(findings, f -> f.kind = '{0}')) as long)"
    return found.selectExpr(
        "doc_id",
        *(f"{count.format(k)} as n_{k}" for k in KINDS[:3]),
        f"sha2({joined.format(base)}, 256) as base_sha256",
        f"{joined.format('findings')} as spans",
        f"cast(size(filter(findings, f -> f.bits >= {MIN_BITS})) as long) as n_hard",
    )
