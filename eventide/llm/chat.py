"""Chat formatting with typed content parts, in DataFrame functions only.

A turn holds a list of parts: ``type`` (text, image, audio, document), ``text``
(of text parts), ``ref`` (where an attachment lies) and ``units`` (image
tiles, seconds, pages).  The visitor goes over a turn's parts in order: text
is escaped, an attachment leaves a placeholder, and its reference, place and
expanded token count are recorded.

A turn is written as ``<turn role="...">`` body ``</turn>`` and a new line.
In texts and roles ``&``, ``<`` and ``"`` become ``&amp;``, ``&lt;`` and
``&quot;``, so no text can pass for a control string, and unescaping gives
back every text.  ``loss_spans`` are the places (code points, end exclusive)
of the assistant turns' texts in ``formatted``.

Defined cases: a null role or text is empty; a null or empty list of parts is
an empty body; a part of another type, or null, leaves nothing; null units
count as 1; turns go by number (null first), equal numbers by role and text;
turns without a conv_id form one conversation without one; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,units:bigint>"
#: tokens that one unit of an attachment expands to: image tile, second of audio, page
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;"))
HEAD, MIDDLE, TAIL = '<turn role="', '">', "</turn>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ESCAPES, F.coalesce(text, F.lit("")))


def unescape(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), ESCAPES[::-1], text)


def placeholder(kind: str) -> str:
    return f"<{kind}/>"


def text_part(text: Column) -> Column:
    """A list of one text part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null.cast("string").alias("ref"), null.cast("bigint").alias("units")))


def _visit(part: Column) -> Column:
    """What a part leaves in the body."""
    out = F.when(part["type"] == "text", escape(part["text"]))
    for kind in UNIT_TOKENS:
        out = out.when(part["type"] == kind, F.lit(placeholder(kind)))
    return out.otherwise(F.lit(""))


def _tokens(part: Column) -> Column:
    out = F.lit(0)
    for kind, each in UNIT_TOKENS.items():
        out = F.when(part["type"] == kind, F.coalesce(part["units"], F.lit(1)) * each).otherwise(out)
    return out.cast("bigint")


def format_chat(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, parts) to one row per conversation.

    Returns conv_id, formatted, loss_spans (start, end), attachments (turn,
    part, type, ref, n_tokens) in order, attachment_tokens.
    """
    parts = F.coalesce("parts", F.array().cast(f"array<{PART}>"))
    kept = F.filter(
        F.transform(parts, lambda p, k: F.struct(k.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("n_tokens"))),
        lambda p: p["type"].isin(*UNIT_TOKENS),
    )
    flat = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(parts, _visit), "").alias("body"), kept.alias("kept"),
    )
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(MIDDLE))
    flat = flat.select("conv_id", "turn", "role", "body", "kept", F.length(head).cast("bigint").alias("before"), F.concat(head, "body", F.lit(TAIL)).alias("piece"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    size = F.sum(F.length("piece").cast("bigint"))
    placed = flat.select(
        "conv_id", "turn", "role", "piece", "kept", F.row_number().over(order).alias("n"),
        (F.coalesce(size.over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("before")).alias("start"), F.length("body").alias("size"),
    )
    span = F.when(F.col("role") == LOSS_ROLE, F.struct("start", (F.col("start") + F.col("size")).alias("end")))
    one = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "piece", span.alias("span"), "turn", "kept"))).alias("all")
    )
    attachments = F.flatten(
        F.transform("all", lambda t: F.transform(t["kept"], lambda p: F.struct(t["turn"].alias("turn"), p["part"].alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), p["n_tokens"].alias("n_tokens"))))
    )
    return one.select(
        "conv_id", F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("all", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"), attachments.alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda s, a: s + a["n_tokens"]))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as a list of (role, body); bodies are still escaped."""
    pieces = F.split(formatted, "</turn>\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    cut = lambda p: F.locate(MIDDLE, F.substring(p, len(HEAD) + 1, 1 << 30))  # noqa: E731  the role's length + 1
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substr(p, F.lit(len(HEAD) + 1), cut(p) - 1)).alias("role"),
        F.substr(p, cut(p) + len(HEAD) + len(MIDDLE), F.length(p)).alias("body"),
    ))


def chat_report(chats: DataFrame) -> DataFrame:
    """What the formatted conversations (of text parts) read back as.

    Returns conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, attachment_tokens.
    """
    turns = F.col("turns")
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), unescape(t["body"]), F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    read = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), loss.alias("loss"), "attachment_tokens")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "attachment_tokens",
    )
