"""Chat formatting with typed content parts, in DataFrame operations only.

A conversation becomes one string of turns::

    <turn:user>
    text with <image:0.1> where a part stood</turn>

Text parts are escaped reversibly: any control string of the template inside a
text gets a backslash after its ``<`` (one more, if it has some already), so that
no text can open or close a turn or pose as an attachment. Image, audio and
document parts become placeholders named by turn and part, in their order; the
attachment list holds each one's reference and expanded token count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What attachments expand to, in tokens for each unit (an image
#: tile, a second of audio, a page).
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 768}
PARTS = "array<struct<type: string, text: string, ref: string, units: double>>"
TURN_END = "</turn>\n"
CONTROL = r"(\\*(?:turn|/turn|" + "|".join(TOKENS_PER_UNIT) + r"))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, "<" + CONTROL, r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\" + CONTROL, "<$1")


def text_parts(text: Column) -> Column:
    """The parts of a message that has only text; null is the empty text."""
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("double").alias("units"),
        )
    )


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*TOKENS_PER_UNIT), F.lit(False))


def visit(parts: Column, turn: Column) -> Column:
    """The message as one string; a part of unknown type counts by its text."""

    def one(part: Column, place: Column) -> Column:
        name = F.concat(part["type"], F.lit(":"), turn.cast("string"), F.lit("."), place.cast("string"))
        text = escape(F.coalesce(part["text"], F.lit("")))
        return F.when(_is_attachment(part), F.concat(F.lit("<"), name, F.lit(">"))).otherwise(text)

    return F.array_join(F.transform(F.coalesce(parts, F.array().cast(PARTS)), one), "")


def attachments(parts: Column, turn: Column) -> Column:
    """Turn, part, type, reference and expanded token count of each attachment."""
    per_unit = F.create_map(*[F.lit(x) for kv in TOKENS_PER_UNIT.items() for x in kv])

    def one(part: Column, place: Column) -> Column:
        tokens = F.ceil(per_unit[part["type"]] * F.coalesce(part["units"], F.lit(1.0)))
        return F.when(
            _is_attachment(part),
            F.struct(
                turn.cast("long").alias("turn"),
                place.cast("long").alias("part"),
                part["type"].alias("type"),
                part["ref"].alias("ref"),
                tokens.alias("tokens"),
            ),
        )

    return F.filter(F.transform(F.coalesce(parts, F.array().cast(PARTS)), one), lambda x: x.isNotNull())


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``, ``attachments``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``parts`` (see ``PARTS``); other
    columns are not looked at. ``loss_spans`` are start and end (code points of
    ``formatted``) of the messages of ``trained_role``. Turns are ordered by ``turn``,
    nulls first; equal ones by role and content, and repeated rows all stay. A null
    role is the empty role; rows without a conversation form one of their own.

    Positions are running sums within a conversation, which sort and spill. The
    result has a conversation in one string, which therefore has to fit one row.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    numbered = turns.select(
        "conv_id", "role", "parts", (F.row_number().over(order) - 1).cast("long").alias("place")
    )
    visited = numbered.select(
        "conv_id",
        "place",
        F.concat(F.lit("<turn:"), F.url_encode(F.coalesce("role", F.lit(""))), F.lit(">\n")).alias("head"),
        visit(F.col("parts"), F.col("place")).alias("body"),
        F.col("role").eqNullSafe(F.lit(trained_role)).alias("trained"),
        attachments(F.col("parts"), F.col("place")).alias("attached"),
    )
    size = F.length("head") + F.length("body") + len(TURN_END)
    placed = visited.withColumn(
        "start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")
    )
    span = F.struct("start", (F.col("start") + F.length("body")).alias("end"))
    piece = F.struct("place", F.concat("head", "body", F.lit(TURN_END)).alias("piece"))
    return (
        placed.groupBy("conv_id")
        .agg(
            F.sort_array(F.collect_list(piece)).alias("pieces"),
            F.sort_array(F.collect_list(F.when(F.col("trained"), span))).alias("loss_spans"),
            F.sort_array(F.flatten(F.collect_list("attached"))).alias("attachments"),
        )
        .select(
            "conv_id",
            F.array_join(F.col("pieces.piece"), "").alias("formatted"),
            "loss_spans",
            "attachments",
        )
    )


def read_chats(formatted: Column) -> Column:
    """The turns of a formatted conversation: role and unescaped text of each."""
    pieces = F.split(formatted, TURN_END)
    # what follows the last end mark is empty
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda piece: F.struct(
            F.url_decode(
                F.substring_index(piece, ">\n", 1).substr(F.lit(len("<turn:") + 1), F.length(piece))
            ).alias("role"),
            unescape(piece.substr(F.instr(piece, ">\n") + 2, F.length(piece))).alias("text"),
        ),
    )


def read_spans(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under ``spans``, joined with nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
        ),
        "",
    )
