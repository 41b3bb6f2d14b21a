"""Conversations as one training text, with typed content parts.

A turn is ``<|im_start|>role``, a line break, its content, ``<|im_end|>`` and a
line break.  Inside roles and texts every ``<|`` gets a backslash between its
two characters (and one more where backslashes stand there already), so that
only the template can write a control string, and texts can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simquarry.llm.text import let, running

START, END = "<|im_start|>", "<|im_end|>"

# Tokens that a part takes in the model's input; a document takes one for each page.
PART_TOKENS = {"image": 256, "audio": 128, "document": 64}

PIECE = 4096  # characters

PARTS = "array<struct<type:string,text:string,ref:string,units:bigint>>"


def escape(text: Column) -> Column:
    """One backslash more in every ``<``, backslashes, ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role fits on one line: backslashes and line breaks are written with a backslash."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    pieces = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(pieces, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def placeholder(kind: Column, ref: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit("|>"))


def text_parts(text: Column) -> Column:
    """A plain text as the only part of a turn."""
    null = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null.alias("ref"), F.lit(None).cast("long").alias("units")))


def visit(parts: Column) -> Column:
    """Flatten parts in their order: ``content``, ``attachments`` and ``n_attached`` tokens.

    Texts are escaped; image, audio and document parts become placeholders, and
    are listed with their number in the turn, their reference, and the tokens
    they take: ``PART_TOKENS`` of the kind for each unit (pages, seconds,
    tiles; one if null).  Null parts and null texts are empty; an unknown kind
    is kept as text, so nothing is lost.
    """
    kind = lambda p: F.lower(F.coalesce(p["type"], F.lit("text")))
    media = lambda p: kind(p).isin(*PART_TOKENS)
    tokens = lambda p: F.create_map(*(F.lit(x) for kv in PART_TOKENS.items() for x in kv))[kind(p)] * F.coalesce(p["units"], F.lit(1))

    def walk(ps: Column) -> Column:
        attached = F.filter(ps, media)
        return F.struct(
            F.array_join(F.transform(ps, lambda p: F.when(media(p), placeholder(kind(p), p["ref"])).otherwise(escape(F.coalesce(p["text"], F.lit(""))))), "").alias("content"),
            F.transform(attached, lambda p, i: F.struct(i.alias("number"), kind(p).alias("type"), p["ref"].alias("ref"), tokens(p).cast("long").alias("tokens"))).alias("attachments"),
            F.aggregate(attached, F.lit(0).cast("long"), lambda a, p: a + tokens(p)).alias("n_attached"),
        )

    empty = F.array().cast(PARTS)
    return let(F.filter(F.coalesce(parts, empty), lambda p: p.isNotNull()), walk)


def format_turns(turns: DataFrame, parts: str = "parts") -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss, attachments, n_attached.

    ``turns`` has conv_id, turn, role and parts.  Turns go by turn, null first,
    then by role and content, so ties have one order; repeated rows are turns of
    their own.  ``loss`` lists (start, length) in code points of what the model
    is trained to say: the contents of assistant turns.  A null role is empty,
    and null conv_ids are one conversation.

    Each turn is formatted before the shuffle; a conversation is one row of the
    result, so its turns meet in one task by need, and nothing else does.
    """
    seen = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit(F.col(parts)).alias("v"))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    one = seen.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.col("role"),
            head.alias("head"),
            F.col("v.content").alias("content"),
            F.col("v.attachments").alias("attachments"),
            F.col("v.n_attached").alias("n_attached"),
        ).alias("t"),
    )
    tail = f"{END}\n"

    def joined(ts: Column) -> Column:
        sizes = F.transform(ts, lambda t: F.struct(F.char_length(t["head"]).alias("head"), F.char_length(t["content"]).alias("content"), (t["role"] == "assistant").alias("loss")))
        length = lambda z: F.transform(z, lambda s: (s["head"] + s["content"] + len(tail)).cast("long"))

        def spans(z: Column, stop: Column) -> Column:
            each = F.transform(z, lambda s, i: F.struct(s["loss"].alias("loss"), (stop[i] - len(tail) - s["content"]).alias("start"), s["content"].cast("long").alias("length")))
            return F.transform(F.filter(each, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))

        return F.struct(
            F.array_join(F.transform(ts, lambda t: F.concat(t["head"], t["content"], F.lit(tail))), "").alias("formatted"),
            let(sizes, lambda z: let(let(length(z), lambda x: running(x)), lambda stop: spans(z, stop))).alias("loss"),
            F.flatten(F.transform(ts, lambda t, i: F.transform(t["attachments"], lambda x: F.struct(i.alias("turn_number"), x.alias("part"))))).alias("attachments"),
            F.aggregate(ts, F.lit(0).cast("long"), lambda a, t: a + t["n_attached"]).alias("n_attached"),
        )

    return one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts")).select("conv_id", let(F.col("ts"), joined).alias("f")).select("conv_id", "f.*")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, content); contents still escaped."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda b: b != "")
    body = lambda b: F.substring(b, F.instr(b, "\n") + 1, F.char_length(b))
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            let(body(b), lambda x: F.left(x, F.char_length(x) - len(END) - 1)).alias("content"),
        ),
    )


def masked_texts(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, in order and unescaped.

    The text is cut into pieces of ``PIECE`` characters first: a substring of the
    whole would walk it from its beginning for each span.
    """
    piece = lambda at: F.floor(at / PIECE).cast("int")

    def said(ps: Column, s: Column) -> Column:
        near = F.array_join(F.slice(ps, piece(s["start"]) + 1, piece(s["start"] + s["length"]) - piece(s["start"]) + 1), "")
        return unescape(F.substring(near, (s["start"] % PIECE).cast("int") + 1, s["length"].cast("int")))

    return let(F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda ps: F.transform(loss, lambda s: said(ps, s)))
