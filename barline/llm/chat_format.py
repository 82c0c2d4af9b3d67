"""Chat formatting of typed content parts, in DataFrame expressions.

A turn's content is an array of parts (kind, text, ref, units).  Text parts are kept;
image, audio and document parts become placeholders numbered in order through the
conversation.  ``attachments`` lists their kind, reference, expanded token count (the
units times the kind's tokens) and their own text, a caption say, which isn't formatted.  A part without
kind is text; a part of any other kind, whatever its name, is an attachment of kind ``other`` with no tokens.  Control strings inside texts are escaped: every
``<`` and ``[`` gets a ``\\`` behind it, so no marker of this template or of other common
ones (``<|..|>``, ``</s>``, ``[INST]``) can occur inside a text; taking that character away
again is exact.  In roles a line break, which ends the role, is escaped too.

The loss covers the text parts of assistant turns and no placeholder.  Turns are ordered by
turn, role, text and parts.  Null roles and texts count as empty; rows without conversation id are
one conversation.  Repeated rows are repeated turns.  Other columns are not read; an empty
table gives an empty result.

Parts are rows until the end: a conversation's parts are numbered and placed by running sums
in one sort, so work is in proportion to its parts.  A conversation is one row in the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, END = "<|turn|>", "<|end|>"
#: Tokens that one unit (image tile, second of audio, document page) expands to.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}

PART = "struct<kind:string,text:string,ref:string,units:int>"


OTHER = "other"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<")), F.lit("[\\"), F.lit("["))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<n"), F.lit("\n")))


def part(kind: str, text: Column | None = None, ref: Column | None = None, units: Column | None = None) -> Column:
    """A content part."""
    own = lambda c, t: (F.lit(None) if c is None else c).cast(t)
    return F.struct(F.lit(kind).alias("kind"), own(text, "string").alias("text"), own(ref, "string").alias("ref"), own(units, "int").alias("units")).cast(PART)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation from rows of (conv_id, turn, role, parts).

    Returns conv_id, formatted, loss_spans (start and length of each text part of an
    assistant in ``formatted``, in code points) and attachments (number, kind, ref, tokens, text).
    """
    parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    plain = F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], F.lit(""))), "")
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", plain, "parts")
    numbered = rows.withColumn("_turn", F.row_number().over(by_turn))
    # A turn is its head, its parts and its end, each a row.
    # Template text has a column of its own, so that no part of any kind can pass as such.
    piece = lambda own, p: F.struct(own.cast("string").alias("own"), p.cast(PART).alias("part"))
    head, end = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n")), F.lit(END)
    pieces = F.concat(F.array(piece(head, F.lit(None))), F.transform("parts", lambda p: piece(F.lit(None), p)), F.array(piece(end, F.lit(None))))
    rows = numbered.select("conv_id", "_turn", (F.col("role") == "assistant").alias("_loss"), F.posexplode(pieces).alias("_at", "piece"))
    rows = rows.select("conv_id", "_turn", "_at", "_loss", F.col("piece.own").alias("_own"), F.col("piece.part").alias("p"))
    known = F.create_map(*(F.lit(x) for kv in UNIT_TOKENS.items() for x in kv))
    kind = F.when(F.col("p.kind").isNull(), "text").when(F.col("p.kind").isin("text", *UNIT_TOKENS), F.col("p.kind")).otherwise(OTHER)
    rows = rows.withColumn("kind", F.when(F.col("_own").isNull(), kind))
    attached = F.coalesce(F.col("kind") != "text", F.lit(False))
    in_order = Window.partitionBy("conv_id").orderBy("_turn", "_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("number", F.sum(attached.cast("int")).over(in_order))
    said = F.coalesce("p.text", F.lit(""))
    placeholder = F.concat(F.lit("<|"), "kind", F.lit(":"), F.col("number").cast("string"), F.lit("|>"))
    rows = rows.withColumn("_shown", F.when(attached, placeholder).otherwise(F.coalesce("_own", escape(said))))
    rows = rows.withColumn("_end", F.sum(F.length("_shown")).over(in_order))
    tokens = F.when(F.col("kind") == OTHER, 0).otherwise(F.coalesce("p.units", F.lit(1)) * known[F.col("kind")])
    attachment = F.struct("number", "kind", F.col("p.ref").alias("ref"), tokens.alias("tokens"), F.col("p.text").alias("text"))
    span = F.struct((F.col("_end") - F.length("_shown")).cast("int").alias("start"), F.length("_shown").alias("length"))
    grouped = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("_turn", "_at", "_shown"))).alias("_pieces"),
        F.sort_array(F.collect_list(F.when(F.col("_loss") & (F.col("kind") == "text"), span))).alias("loss_spans"),
        F.sort_array(F.collect_list(F.when(attached, attachment))).alias("attachments"),
    )
    return grouped.select("conv_id", F.array_join(F.col("_pieces._shown"), "").alias("formatted"), "loss_spans", "attachments")


def read_back(chats: DataFrame) -> DataFrame:
    """Adds turns (role, text) and loss_text, read from ``formatted`` and ``loss_spans`` alone; placeholders are no text."""
    raw = F.filter(F.split("formatted", r"<\|turn\|>"), lambda s: s != "")

    def turn(s: Column) -> Column:
        head = F.substring_index(s, "\n", 1)
        body = F.substr(s, F.length(head) + 2, F.length(s) - F.length(head) - 1 - len(END))
        return F.struct(unescape_role(head).alias("role"), unescape(F.regexp_replace(body, r"<\|[a-z]+:[0-9]+\|>", "")).alias("text"))

    loss = F.array_join(F.transform("loss_spans", lambda x: unescape(F.substr(F.col("formatted"), x["start"] + 1, x["length"]))), "")
    return chats.withColumn("turns", F.transform(raw, turn)).withColumn("loss_text", loss)
