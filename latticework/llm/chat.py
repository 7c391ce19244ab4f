"""Chat formatting: typed parts flattened to placeholders, one escaped text a conversation, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticework.operators.joins import fresh

# Template: TURN role TEXT content END, turn after turn. No escaped text holds a control string.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Starts of control strings, of this template and of others that models know.
_CONTROL = r"(<)(\||/?s>)|(\[)(/?(?:INST|SYS)\])|(<)(</?SYS>>)"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}

PART = T.StructType(
    [
        T.StructField("type", T.StringType()),  # text, image, audio or document
        T.StructField("text", T.StringType()),  # of a text part
        T.StructField("ref", T.StringType()),  # of an attachment
        T.StructField("size", T.LongType()),  # pixels, milliseconds or bytes
    ]
)
# Units that make one token: pixels of an image patch, milliseconds of an audio frame, bytes of a page chunk.
UNITS = {"image": 28 * 28, "audio": 40, "document": 4}


def escaped(text: Column) -> Column:
    """``text`` without control strings: a backslash goes before each backslash and into each start of one."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$1$3$5\\$2$4$6")


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``: a backslash stands for what follows it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A text as an array of one part."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.cast("string").alias("text"),
            null.cast("string").alias("ref"),
            null.cast("long").alias("size"),
        )
    )


def _tokens(part: Column) -> Column:
    """Tokens that an attachment takes once it is expanded: one at least, one a unit of its size."""
    per = F.lit(1)
    for kind, unit in UNITS.items():
        per = F.when(part["type"] == kind, F.lit(unit)).otherwise(per)
    return F.greatest(F.ceil(F.coalesce(part["size"], F.lit(0)) / per), F.lit(1)).cast("long")


def flatten(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """``turns`` with content, attachments and expanded_tokens in place of the array ``parts`` of PART.

    Parts are visited in order. A text part adds its escaped text (null: none), an attachment the placeholder of
    its kind; attachments lists (type, ref, tokens, place), place being the number of the placeholder in its
    turn, and expanded_tokens sums their tokens. A null array has no parts; null parts, and parts of a type
    that is none of the four, add nothing. Columns of these three names are replaced, others stay whatever their names.
    """
    name = fresh("known", [*turns.columns, "content", "attachments", "expanded_tokens"])
    known = F.filter(
        F.coalesce(F.col(parts), F.array().cast(T.ArrayType(PART))),
        lambda p: F.coalesce(p["type"].isin("text", *PLACEHOLDERS), F.lit(False)),
    )

    def visited(part: Column) -> Column:
        written = escaped(F.coalesce(part["text"], F.lit("")))
        for kind, placeholder in PLACEHOLDERS.items():
            written = F.when(part["type"] == kind, F.lit(placeholder)).otherwise(written)
        return written

    attached = F.filter(name, lambda p: p["type"] != "text")
    return (
        turns.withColumn(name, known)
        .withColumn("content", F.array_join(F.transform(name, visited), ""))
        .withColumn(
            "attachments",
            F.transform(
                attached,
                lambda p, i: F.struct(
                    p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens"), i.alias("place")
                ),
            ),
        )
        .withColumn(
            "expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
        )
        .drop(name, parts)
    )


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts"
) -> DataFrame:
    """(conv, n_turns, formatted, attachments, expanded_tokens) of each conversation in ``turns``.

    ``parts`` is a text column or an array of PART; other columns are not read. Turns are ordered by
    ``turn``, then role and content, so ties and repeated rows have one order and all stay; null turns come
    first. A null role or text is empty, and a null conversation is one conversation. Each attachment of a
    conversation also has the number of its turn from 0. No rows: no rows. A formatted conversation is one
    cell, as is its whole text anywhere.
    """
    typed = text_part(F.col(parts)) if turns.schema[parts].dataType == T.StringType() else F.col(parts)
    kept = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        typed.alias("parts"),
    )
    visited = flatten(kept)
    written = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT), F.col("content"), F.lit(END))
    entry = F.struct("turn", "role", written.alias("written"), "attachments", "expanded_tokens")
    gathered = visited.groupBy("conv").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    return gathered.select(
        F.col("conv").alias(conv),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["written"]), "").alias("formatted"),
        F.flatten(
            F.transform(
                "turns",
                lambda t, i: F.transform(t["attachments"], lambda a: a.withField("turn", i)),
            )
        ).alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["expanded_tokens"]).alias("expanded_tokens"),
    )


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped; placeholders stay in the text."""
    turns = F.filter(F.split(formatted, r"<\|turn\|>"), lambda t: t != "")
    return F.transform(
        turns,
        lambda t: F.struct(
            unescaped(F.substring_index(t, TEXT, 1)).alias("role"),
            unescaped(F.regexp_replace(F.substring_index(t, TEXT, -1), r"<\|end\|>$", "")).alias("text"),
        ),
    )


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """(start, length) in code points of the content of each turn of ``role`` in a formatted conversation."""
    head = TURN + role + TEXT
    pieces = F.split(formatted, r"(?<=<\|end\|>)")
    state = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )

    def step(state: Column, piece: Column) -> Column:
        span = F.struct(
            (state["at"] + len(head)).alias("start"), (F.length(piece) - len(head) - len(END)).alias("length")
        )
        spans = F.when(piece.startswith(head), F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(piece)).alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, state, step, lambda s: s["spans"])


def loss_text(formatted: Column, role: str = "assistant") -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    inside = F.transform(
        loss_spans(formatted, role), lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))
    )
    return F.array_join(inside, "")
