"""Chat formatting of typed content parts, with DataFrame functions only.

A message is an array of parts. A visitor turns each part into a piece of text: text parts are escaped, images, audio and
documents become ordered placeholders, with their reference and the number of tokens they expand to in ``attachments``.
Messages of a conversation are joined in order of turn (then role, then text). The loss mask has one entry per turn:
characters to skip from the turn's start, characters that count.

Control strings start with ``<|``. In texts, backslashes are doubled, then ``<|`` becomes ``<\\|``; reading undoes both, so
no text can forge a turn. A line break in a role becomes ``<|nl|>``.

Defined results: null texts, roles and parts count as empty; rows without conversation id form one conversation; repeated
rows are repeated turns; an empty table gives an empty table; other columns are ignored. One conversation is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
TAIL = END + "\n"
TRAINED = "assistant"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25.0, 256
ATTACHMENT = "struct<turn:int,place:int,kind:string,ref:string,tokens:long>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _replaced(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    return _replaced(_replaced(F.coalesce(text, F.lit("")), "\\", "\\\\"), "<|", "<\\|")


def unescape(text: Column) -> Column:
    return _replaced(_replaced(text, "<\\|", "<|"), "\\\\", "\\")


def escape_role(role: Column) -> Column:
    return _replaced(escape(role), "\n", NEWLINE)


def unescape_role(role: Column) -> Column:
    return unescape(_replaced(role, NEWLINE, "\n"))


def text_part(text: Column | str) -> Column:
    """Array with one text part."""
    text = F.col(text) if isinstance(text, str) else text
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), null.cast("string").alias("ref"), null.cast("int").alias("width"),
                            null.cast("int").alias("height"), null.cast("double").alias("seconds"), null.cast("int").alias("pages")))


def _tokens(part: Column) -> Column:
    size = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / PATCH)
    return (F.when(part["kind"] == "image", size(part["width"]) * size(part["height"]))
            .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE))
            .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS).cast("long"))


def _is_attached(part: Column) -> Column:
    return F.coalesce(part["kind"].isin("image", "audio", "document"), F.lit(False))


def visit(part: Column) -> Column:
    """The piece of text of one part; a part of an unknown kind counts as text."""
    return F.when(_is_attached(part), F.concat(F.lit("<|"), part["kind"], F.lit("|>"))).otherwise(escape(part["text"]))


def format_chat(messages: DataFrame, parts: Column | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_mask`` (skip, take by turn) and ``attachments``."""
    parts = text_part(text) if parts is None else F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    plain = F.coalesce(F.col(role), F.lit(""))
    turns = messages.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), plain.alias("role"), parts.alias("parts")).alias("m")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("m")).alias("m"))  # by turn, null first, then by role and parts as they are
    turns = turns.select("conv_id", F.transform("m", lambda m: F.struct(
        escape_role(m["role"]).alias("role"), F.array_join(F.transform(m["parts"], visit), "").alias("body"), (m["role"] == TRAINED).alias("trained"),
        F.transform(F.filter(m["parts"], _is_attached), lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens"))).alias("attached"))).alias("m"))
    head = lambda m: F.concat(F.lit(START), m["role"], F.lit("\n"))
    mask = F.transform("m", lambda m: F.struct(F.length(head(m)).alias("skip"),
                                               F.when(m["trained"], F.length(m["body"])).otherwise(0).alias("take")))
    attachments = F.flatten(F.transform("m", lambda m, i: F.transform(m["attached"], lambda a, k: F.struct(
        i.alias("turn"), k.alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return turns.select("conv_id", F.array_join(F.transform("m", lambda m: F.concat(head(m), m["body"], F.lit(TAIL))), "").alias("formatted"),
                        mask.alias("loss_mask"), attachments.alias("attachments"))


def turn_pieces(formatted: Column) -> Column:
    """The pieces of a formatted conversation, one per turn, without their start mark."""
    return let(F.split(formatted, START.replace("|", r"\|"), -1), lambda p: F.slice(p, F.lit(2), F.size(p)))


def read_turns(pieces: Column) -> Column:
    """(role, text) of each piece."""
    def parsed(p):
        return let(F.substring_index(p, "\n", 1), lambda r: F.struct(
            unescape_role(r).alias("role"),
            unescape(F.substring(p, F.length(r) + 2, F.length(p) - F.length(r) - 1 - len(TAIL))).alias("text")))

    return F.transform(pieces, parsed)


def read_loss(pieces: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.zip_with(pieces, mask, lambda p, m: unescape(F.substring(p, m["skip"] - len(START) + 1, m["take"]))), "")
