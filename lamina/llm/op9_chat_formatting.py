"""Chat formatting with typed content parts, in DataFrame functions only.

A turn is a list of parts: ``text``, ``image``, ``audio`` or ``document``. A visitor over the kinds
flattens the parts of a turn into one string: text parts are escaped, every other part becomes an
ordered placeholder whose reference and expanded token count are recorded. Turns are then laid
between control strings. ``read_back`` recovers roles, texts and the text under the loss mask from
the output alone.

Defined results: a null text or reference is empty, a null role is an empty role, a null list has
no parts, a null or unknown kind counts as text. A null ``turn`` sorts first; turns with the same
number are ordered by role and content and all are kept; a null ``conv_id`` is one conversation.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART_TYPE = "array<struct<kind:string,text:string,ref:string,units:double>>"
#: Tokens that one unit of an attachment stands for: an image tile, a second, a page.
TOKENS_PER_UNIT = {"image": 256.0, "audio": 25.0, "document": 768.0}
#: Turns of a conversation that are joined before the conversation is.
TURNS_PER_BLOCK = 256


def escape(text: Column) -> Column:
    """Text in which no control string can stand; ``unescape`` inverts it.

    Tildes are doubled, so that only an escape holds a single tilde: ``<~|`` is ``<|``, ``<~n`` a
    newline of a role and ``<~e`` a ``<`` that ends a part.
    """
    return F.replace(F.replace(text, F.lit("~"), F.lit("~~")), F.lit("<|"), F.lit("<~|"))


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("<~|"), F.lit("<|")), F.lit("<~e"), F.lit("<"))
    return F.replace(plain, F.lit("~~"), F.lit("~"))


def escape_part(text: Column, followed: Column) -> Column:
    """Text of one part; where another part follows, a ``<`` at its end cannot begin a control string there."""
    escaped = escape(text)
    return F.when(followed & F.endswith(escaped, F.lit("<")), F.concat(escaped, F.lit("~e"))).otherwise(escaped)


def escape_role(role: Column) -> Column:
    """A role in one line: a newline becomes ``<~n``, which no escaped text contains."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<~n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<~n"), F.lit("\n")))


def text_parts(conversations: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, parts`` from rows with one plain ``text``."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("double").alias("units"),
    )
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def _visit(part: Column, followed: Column) -> Column:
    """One part as ``piece, is_text, kind, ref, tokens``; ``followed`` if it is not the turn's last."""
    attached = F.coalesce(part["kind"].isin(*TOKENS_PER_UNIT), F.lit(False))
    rate = F.lit(0.0)
    for kind, tokens in TOKENS_PER_UNIT.items():
        rate = F.when(part["kind"] == kind, F.lit(tokens)).otherwise(rate)
    holder = F.concat(F.lit("<|"), part["kind"], F.lit("|>"))
    return F.struct(
        F.when(attached, holder)
        .otherwise(escape_part(F.coalesce(part["text"], F.lit("")), followed))
        .alias("piece"),
        (~attached).alias("is_text"),
        part["kind"].alias("kind"),
        F.coalesce(part["ref"], F.lit("")).alias("ref"),
        F.ceil(F.coalesce(part["units"], F.lit(1.0)) * rate).cast("long").alias("tokens"),
    )


def _turn_rows(turns: DataFrame) -> DataFrame:
    """Each turn as its formatted string, loss spans inside it, and its attachments."""
    role = F.coalesce("role", F.lit(""))
    head = F.concat(escape_role(role), F.lit("\n"))
    parts = F.coalesce("parts", F.array().cast(PART_TYPE))
    visited = turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        head.alias("head"),
        F.transform(parts, lambda p, i: _visit(p, i + 1 < F.size(parts))).alias("seen"),
    )
    begins = F.transform(
        "seen",
        lambda _, i: F.aggregate(
            F.slice("seen", 1, i), F.char_length("head"), lambda n, p: n + F.char_length(p["piece"])
        ),
    )
    spans = F.transform(
        "seen",
        lambda p, i: F.struct(
            F.element_at(F.col("begins"), i + 1).alias("start"),
            F.char_length(p["piece"]).alias("chars"),
            p["is_text"].alias("is_text"),
        ),
    )
    learned = F.filter("spans", lambda s: s["is_text"] & (F.col("role") == "assistant"))
    held = F.transform(
        "seen", lambda p, i: F.struct(i.alias("part"), p["kind"], p["ref"], p["tokens"], p["is_text"])
    )
    return (
        visited.withColumn("begins", begins)
        .withColumn("spans", spans)
        .select(
            "conv_id",
            "turn",
            F.concat(
                F.lit(START),
                "head",
                F.array_join(F.transform("seen", lambda p: p["piece"]), ""),
                F.lit(END + "\n"),
            ).alias("formatted"),
            F.transform(learned, lambda s: F.struct(s["start"], s["chars"])).alias("loss"),
            F.transform(
                F.filter(held, lambda p: ~p["is_text"]),
                lambda p: F.struct(p["part"], p["kind"], p["ref"], p["tokens"]),
            ).alias("attached"),
        )
    )


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per conversation from rows ``conv_id, turn, role, parts``.

    Returns ``conv_id, n_turns, formatted``, ``loss`` (for each turn, the spans of ``start`` and
    ``chars`` in code points after its start mark that a model learns from), ``attachments`` (for
    each turn, ``part, kind, ref, tokens``) and ``expanded_tokens``. A conversation is assembled
    from blocks of turns, so that a very long one crosses the shuffle as a few joined strings.
    """
    block = F.floor(F.col("turn") / TURNS_PER_BLOCK).alias("block")
    item = F.struct("turn", "formatted", "loss", "attached")
    blocks = (
        _turn_rows(turns)
        .groupBy("conv_id", block)
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select(
            "conv_id",
            "block",
            F.size("items").cast("long").alias("n"),
            F.array_join("items.formatted", "").alias("formatted"),
            F.col("items.loss").alias("loss"),
            F.col("items.attached").alias("attached"),
        )
    )
    whole = blocks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "n", "formatted", "loss", "attached"))).alias("b")
    )
    tokens = F.aggregate(
        F.flatten("attachments"), F.lit(0).cast("long"), lambda n, a: n + a["tokens"]
    )
    return whole.select(
        "conv_id",
        F.aggregate("b.n", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_turns"),
        F.array_join("b.formatted", "").alias("formatted"),
        F.flatten("b.loss").alias("loss"),
        F.flatten("b.attached").alias("attachments"),
    ).withColumn("expanded_tokens", tokens)


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role and text, unescaped) and ``loss_text`` parsed from the output."""
    blocks = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, F.size("loss"))
    body = formatted.withColumn("blocks", blocks)
    turns = F.transform(
        "blocks",
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(
                F.substring_index(
                    F.substr(b, F.char_length(F.substring_index(b, "\n", 1)) + 2), END, 1
                )
            ).alias("text"),
        ),
    )
    learned = F.transform(
        F.arrays_zip("blocks", "loss"),
        lambda z: F.array_join(
            F.transform(
                z["loss"], lambda s: unescape(F.substr(z["blocks"], s["start"] + 1, s["chars"]))
            ),
            "",
        ),
    )
    return body.withColumn("turns", turns).withColumn("loss_text", F.array_join(learned, ""))


def digest(formatted: DataFrame) -> DataFrame:
    """The columns of the query, all read back from ``formatted`` and ``loss``."""
    back = read_back(formatted)
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "expanded_tokens",
    )
