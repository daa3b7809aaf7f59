"""Chat formatting with typed content parts, in DataFrame expressions only.

A turn reads ``### role: content</turn>`` and a line break. Control strings inside texts and roles
get a backslash after their first character, and backslashes are doubled, so no text can end a
turn or stand for a part, and every text reads back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, ROLE_END, TURN_END = "### ", ": ", "</turn>"
#: The placeholder of each kind of part that is not text.
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
OTHER = "<file>"
_CONTROLS = (HEAD, TURN_END, *PLACEHOLDERS.values(), OTHER)
PART = "kind string, text string, ref string, width int, height int, seconds double, pages int"
_END = f"{TURN_END}\n"
_VISITED = "array<struct<shown:string,kind:string,ref:string,tokens:bigint>>"


def text_parts(text: Column) -> Column:
    """A text column as the typed parts of a turn: one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text")))


def escape(text: Column, controls=_CONTROLS) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in controls:
        text = F.replace(text, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _visit(part: Column, fields: set[str], patch: int, rate: float, per_page: int) -> Column:
    """A part to its placeholder or escaped text, with its attachment and expanded tokens."""
    field = lambda n, t: (part[n] if n in fields else F.lit(None)).cast(t)
    kind = F.lower(F.coalesce(field("kind", "string"), F.lit("text")))
    patches = lambda side: F.ceil(F.coalesce(side, F.lit(0)) / patch)
    tokens = (
        F.when(kind == "image", patches(field("width", "int")) * patches(field("height", "int")))
        .when(kind == "audio", F.ceil(F.coalesce(field("seconds", "double"), F.lit(0.0)) * rate))
        .when(kind == "document", F.coalesce(field("pages", "int"), F.lit(0)) * per_page)
        .otherwise(0))
    shown = F.when(kind == "text", escape(F.coalesce(field("text", "string"), F.lit(""))))
    for name, mark in PLACEHOLDERS.items():
        shown = shown.when(kind == name, F.lit(mark))
    return F.struct(
        shown.otherwise(F.lit(OTHER)).alias("shown"), kind.alias("kind"),
        field("ref", "string").alias("ref"),
        F.when(kind == "text", 0).otherwise(F.greatest(tokens, F.lit(1))).cast("long")
        .alias("tokens"))


def format_conversations(
    turns: DataFrame, parts: str, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", trained_role: str = "assistant", patch: int = 14,
    audio_rate: float = 25.0, page_tokens: int = 1000,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``turns``, ``attachments``.

    ``parts`` names a column of arrays of structs with the fields of :data:`PART` (any may be
    missing). Text parts are escaped; an image, audio or document part becomes its placeholder,
    any other kind ``<file>``. ``turns`` lists ``role``, ``start`` and ``length`` of the content in
    ``formatted`` (code points) and ``loss``, true for the trained role. ``attachments`` lists
    ``turn``, ``part``, ``kind``, ``ref`` and ``tokens`` in the order of the placeholders: an image
    has ceil(width / patch) * ceil(height / patch) tokens, audio its seconds times a rate,
    a document its pages times a constant, each at least one.

    Turns are ordered by number (nulls first), then role and content, so repeated and tied turns
    all stay, in an order that does not depend on the input's. Null roles, contents and texts
    count as empty. Null conversation ids form one conversation. Other columns are ignored.
    A conversation's result is one row, so its turns meet in one task, escaped before they move.
    """
    fields = {f.name for f in turns.schema[parts].dataType.elementType.fields}
    visited = F.transform(
        F.filter(F.col(parts), lambda p: p.isNotNull()),
        lambda p: _visit(p, fields, patch, audio_rate, page_tokens))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("number"), role.alias("role"),
        F.coalesce(visited, F.array().cast(_VISITED)).alias("visited"))
    head = F.concat(F.lit(HEAD), escape(F.col("role"), (*_CONTROLS, ROLE_END)), F.lit(ROLE_END))
    rows = rows.select(
        "conv_id", "number", "role", head.alias("head"),
        F.array_join(F.transform("visited", lambda v: v["shown"]), "").alias("content"),
        F.filter(F.transform("visited", lambda v, k: F.struct(
            k.alias("part"), v["kind"].alias("kind"), v["ref"].alias("ref"),
            v["tokens"].alias("tokens"))), lambda v: v["kind"] != "text").alias("attached"))
    order = Window.partitionBy("conv_id").orderBy(
        F.col("number").asc_nulls_first(), "role", "content", "attached")
    size = F.length("head") + F.length("content") + len(_END)
    to_here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (rows.withColumn("stop", F.sum(size).over(to_here))
              .withColumn("turn", F.row_number().over(order) - 1))
    collected = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "stop", "turn", "role", "head", "content", "attached"))).alias("all"))
    length = lambda t: F.length(t["content"])
    return collected.select(
        "conv_id",
        F.array_join(F.transform("all", lambda t: F.concat(
            t["head"], t["content"], F.lit(_END))), "").alias("formatted"),
        F.transform("all", lambda t: F.struct(
            t["role"].alias("role"), (t["stop"] - len(_END) - length(t)).alias("start"),
            length(t).cast("long").alias("length"),
            (t["role"] == trained_role).alias("loss"))).alias("turns"),
        F.flatten(F.transform("all", lambda t: F.transform(t["attached"], lambda a: F.struct(
            t["turn"].alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"),
            a["ref"].alias("ref"), a["tokens"].alias("tokens"))))).alias("attachments"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Formatted conversations back to ``conv_id`` and ``turns`` of ``role``, ``text``, ``trained``.

    Role and text come from the formatted string alone, ``trained`` is what the loss spans cover
    (null outside them), all unescaped; placeholders stay as they are. One pass over the string.
    """
    pieces = F.split("formatted", _END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column, i: Column) -> Column:
        rest = F.substring(piece, F.lit(len(HEAD) + 1), F.length(piece))
        at = F.locate(ROLE_END, rest)
        span, before = F.get(F.col("turns"), i), F.get(F.col("turns"), i - 1)
        begin = F.coalesce(before["start"] + before["length"] + len(_END), F.lit(0))
        return F.struct(
            unescape(F.substring(rest, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(rest, at + len(ROLE_END), F.length(rest))).alias("text"),
            F.when(span["loss"], unescape(F.substring(
                piece, (span["start"] - begin + 1).cast("int"), span["length"].cast("int"))))
            .alias("trained"))

    return formatted.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"))
