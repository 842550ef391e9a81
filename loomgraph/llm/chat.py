"""Chat formatting with typed content parts, in DataFrame functions only.

A visitor flattens each turn's parts in order: text is escaped, image, audio
and document parts become placeholders, and their references and expanded token
counts are recorded.  Escaping replaces every ``&``, ``<`` and ``[`` of a text
by an entity, so in the output those characters are only ever markup and the
output can be read back exactly.

Defined cases: null text, role or part counts as empty; turns go by their
number (nulls first), ties by role, then text; repeated rows are all kept; a
null key is a conversation of its own; an empty table gives an empty result;
other columns are not read.  A conversation is one output row by definition, so
the turns of one conversation meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, ROLE_END, END = "<s>[TURN]", "[/TURN]", "</s>"
#: Placeholder of each kind of part; any other kind is a file.
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
OTHER = "<file>"
#: Tokens a placeholder stands for: images by tiles, audio by second, documents by page.
TILE, TILE_TOKENS, IMAGE_TOKENS, AUDIO_RATE, PAGE_TOKENS = 512, 170, 85, 25, 560
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&lb;"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&lb;"), F.lit("["))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def text_parts(text: Column) -> Column:
    """One text part, for tables whose turns are plain text."""
    nothing = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in nothing.items()))
    return F.array(part).cast(PARTS)


def _placeholder(kind: Column) -> Column:
    out = F.lit(OTHER)
    for name, mark in PLACEHOLDERS.items():
        out = F.when(kind == name, mark).otherwise(out)
    return out


def _tokens(part: Column) -> Column:
    tiles = F.ceil(part["width"] / TILE) * F.ceil(part["height"] / TILE)
    return F.coalesce(
        F.when(part["type"] == "image", IMAGE_TOKENS + TILE_TOKENS * tiles)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_RATE))
        .when(part["type"] == "document", part["pages"] * F.lit(PAGE_TOKENS)),
        F.lit(0),
    ).cast("long")


def format_chat(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", parts: Column | None = None) -> DataFrame:
    """One row a conversation: ``formatted``, ``loss`` (spans of assistant text) and ``attachments``.

    ``parts`` is an array of typed parts (see ``PARTS``); by default the column
    ``text`` as one part.  ``loss`` holds for each assistant turn its number, the
    place where the turn starts, and start and end of its text in ``formatted``
    (code points).  ``attachments`` holds turn, part, kind, reference, tokens.
    """
    parts = text_parts(F.col("text")) if parts is None else parts
    parts = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p.isNotNull())
    own = turns.select(F.col(key).alias("_key"), F.col(turn).alias("_turn"), F.coalesce(F.col(role), F.lit("")).alias("_role"), parts.alias("_parts"))
    is_text = lambda p: F.coalesce(p["type"], F.lit("text")) == "text"
    flat = F.array_join(F.transform("_parts", lambda p: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(_placeholder(p["type"]))), "")
    files = F.filter(
        F.transform("_parts", lambda p, i: F.struct((i + 1).alias("part"), p["type"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens"))),
        lambda x: F.coalesce(x["kind"], F.lit("text")) != "text",
    )
    raw = F.array_join(F.transform("_parts", lambda p: F.coalesce(p["text"], p["ref"], F.lit(""))), "")
    own = own.select("_key", "_turn", "_role", flat.alias("_body"), raw.alias("_raw"), files.alias("_files"))
    own = own.withColumn("_head", F.concat(F.lit(BEGIN), escape(F.col("_role")), F.lit(ROLE_END)))
    own = own.withColumn("_piece", F.concat("_head", "_body", F.lit(END)))
    by = Window.partitionBy("_key").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_raw", "_piece")
    own = own.withColumn("_n", F.row_number().over(by))
    before = F.coalesce(F.sum(F.length("_piece")).over(Window.partitionBy("_key").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = own.withColumn("_at", before)
    start = F.col("_at") + F.length("_head")
    held = F.struct(
        F.col("_n").alias("turn"), "_piece", (F.col("_role") == "assistant").alias("learn"), F.col("_at").alias("turn_start"),
        start.alias("start"), (start + F.length("_body")).alias("end"), F.col("_files").alias("files"),
    )
    whole = own.groupBy("_key").agg(F.sort_array(F.collect_list(held)).alias("_t"))
    return whole.select(
        F.col("_key").alias(key),
        F.array_join(F.transform("_t", lambda t: t["_piece"]), "").alias("formatted"),
        F.transform(F.filter("_t", lambda t: t["learn"]), lambda t: F.struct(t["turn"], t["turn_start"], t["start"], t["end"])).alias("loss"),
        F.flatten(F.transform("_t", lambda t: F.transform(t["files"], lambda f: F.struct(t["turn"], f["part"], f["kind"], f["ref"], f["tokens"])))).alias("attachments"),
    )


def read_chat(formatted: DataFrame) -> DataFrame:
    """The output read back: ``turns`` (role and text, unescaped) and ``loss_text``, added to its columns."""
    pieces = F.split("formatted", END)
    out = formatted.withColumn("_pieces", F.slice(pieces, 1, F.size(pieces) - 1))
    role = lambda p: F.substring_index(p, ROLE_END, 1)
    turns = F.transform(
        "_pieces",
        lambda p: F.struct(
            unescape(F.substring(role(p), F.lit(len(BEGIN) + 1), F.length(p))).alias("role"),
            unescape(F.substring(p, F.length(role(p)) + len(ROLE_END) + 1, F.length(p))).alias("text"),
        ),
    )
    learnt = F.transform(
        "loss", lambda s: unescape(F.substring(F.element_at("_pieces", s["turn"]), (s["start"] - s["turn_start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return out.withColumn("turns", turns).withColumn("loss_text", F.array_join(learnt, "")).drop("_pieces")
