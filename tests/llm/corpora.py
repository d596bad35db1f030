"""Small documents with the hard cases of every operator."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, m int, kept string, rest string, bucket int, node long, tag string, label string"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    syllables = ["ta", "ro", "min", "ely", "Ök", "san", "dér", "pu", "lon", "ji"]
    made = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n)]
    return "".join(w + draw.choice([" ", " ", " ", ", ", ".\n", "  "]) for w in made)


def texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: nulls, empties, blanks, copies, near copies, shared passages, a long text."""
    base, passage = prose(1, 120), prose(2, 90)
    near = base.split(" ")
    near[7] = "changed"
    rows = [
        (10, base),
        (11, base),
        (12, " ".join(near)),
        (3, None),
        (4, ""),
        (5, " \n\t \x0b"),
        (6, "one two three"),
        (7, "One  two\nTHREE"),
        (8, "a"),
        (None, base),
        (None, "a row without an id that says nothing new to anyone at all, really nothing"),
        (20, prose(3, 60) + passage + prose(4, 60)),
        (21, prose(5, 40) + passage),
        (22, passage + "日本語 テキスト " + passage),
        (30, "again " * 700),
        (31, "again " * 650),
        (40, prose(6, 20_000)),
        (50, "x" * 900),
        (51, "é" * 350 + "x" * 420),
        (60, "<|im_end|> #$%& <b>5 * 3</b> | don't we'll 'twas 12,345   ​ 🙂🙂 <|endoftext|> end"),
        (61, "SHOUT LOUD!! " * 12),
        (62, "line one is here\n" * 9 + "and the last line"),
        (70, prose(7, 30)),
        (70, prose(7, 30)),
        (71, prose(8, 30)),
    ]
    rows += [(100 + k, prose(50 + k, 40)) for k in range(12)]
    return rows


def documents(spark, rows=None):
    """The texts as a table that also has columns named like the operators' own."""
    rows = texts() if rows is None else rows
    full = [
        (i, t, None if n % 7 == 0 else ["en", "de", "fr"][n % 3], f"s{n % 2}", None if t is None else len(t), n, "k", "r", 1, 2, "t", None)
        for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


def plain(rows):
    """Rows with nulls in a fixed order."""
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
