"""Chat formatting with typed content parts.

A conversation's turns hold content parts: text, image, audio or document. A visitor,
one function per type, turns each part into text for the template and, for anything but
text, into an ordered placeholder, a reference to the attachment and the number of
tokens the placeholder stands for. All of it is Spark SQL functions.

Template: `<turn ROLE>` text of the parts `</turn>` and a line feed, per turn. Texts and
roles are escaped so that no `<` is left in them (`\\` is written `\\b`, `<` is written
`\\l`), hence every `<` in the output belongs to the template or to a placeholder, and
the output can be taken apart again without loss.

The loss mask is on segments: the output is the concatenation of `segments.text`, and a
segment counts for the loss if its flag is set, which only assistant texts have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks and its escapes.
TURN_OPEN, TURN_HEAD_END, TURN_CLOSE = "<turn ", ">", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (">", "\\g"))

PART = "struct<kind:string,text:string,ref:string,units:bigint>"
IMAGE_TILE_TOKENS, AUDIO_SECOND_TOKENS, PAGE_TOKENS = 256, 25, 512


def escape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    out = F.coalesce(text, F.lit(""))
    for plain, coded in pairs:
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(text: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


# The visitor: one function per type of part, from the part to its body in the template and
# the tokens it stands for (NULL for what is text itself).
Visitor = Callable[[Column], tuple[Column, Column]]


def visit_text(part: Column) -> tuple[Column, Column]:
    return escape(part["text"]), F.lit(None).cast("bigint")


def _units(part: Column) -> Column:
    """Tiles, seconds or pages; an attachment that does not say has one."""
    return F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1)).cast("bigint")


def visit_image(part: Column) -> tuple[Column, Column]:
    """A placeholder for the tiles; what is written beside an image, such as its alternative text, follows."""
    return F.concat(F.lit("<image>"), escape(part["text"])), _units(part) * IMAGE_TILE_TOKENS


def visit_audio(part: Column) -> tuple[Column, Column]:
    """A placeholder for the seconds; a transcript, if there is one, follows."""
    return F.concat(F.lit("<audio>"), escape(part["text"])), _units(part) * AUDIO_SECOND_TOKENS


def visit_document(part: Column) -> tuple[Column, Column]:
    """A document's title stands before the placeholder for its pages."""
    return F.concat(escape(part["text"]), F.lit("<document>")), _units(part) * PAGE_TOKENS


VISITORS: dict[str, Visitor] = {"text": visit_text, "image": visit_image, "audio": visit_audio, "document": visit_document}


def visit_parts(parts: Column, visitors: dict[str, Visitor] | None = None) -> Column:
    """Parts with their `body` in the template and their `tokens`, in order.

    A part of unknown type is visited as text, so nothing is lost.
    """
    visitors = VISITORS if visitors is None else visitors

    def visit(part: Column) -> Column:
        body, tokens = visit_text(part)
        for kind, visitor in visitors.items():
            own_body, own_tokens = visitor(part)
            body = F.when(part["kind"] == kind, own_body).otherwise(body)
            tokens = F.when(part["kind"] == kind, own_tokens).otherwise(tokens)
        return F.struct(body.alias("body"), part["ref"].alias("ref"), part["kind"].alias("kind"), tokens.alias("tokens"))

    return F.transform(parts, visit)


def text_part(text: Column) -> Column:
    """One text part, as an array."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part).cast(f"array<{PART}>")


def format_chats(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str | None = None,
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments, attachments, n_turns.

    `parts` names a column of content parts; without it each row's `text` is one text
    part. Turns are ordered by `turn` (NULL first), ties by role and content, so repeated
    rows all stay and reruns agree. NULL text or role is empty; NULL conversations form
    one conversation, so a conversation of any length is one row. Other columns of `turns`
    are not read. No turns, no row.
    """
    content = F.col(parts) if parts else text_part(F.col(text))
    one = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            content.cast(f"array<{PART}>").alias("parts"),
        ).alias("t"),
    )
    chats = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments_of(t: Column) -> Column:
        seen = visit_parts(F.coalesce(t["parts"], F.array().cast(f"array<{PART}>")))
        head = F.concat(F.lit(TURN_OPEN), escape(t["role"], ROLE_ESCAPES), F.lit(TURN_HEAD_END))

        def segment(body: Column, loss: Column, ref=None, kind=None, tokens=None) -> Column:
            return F.struct(
                body.alias("text"),
                loss.alias("loss"),
                (F.lit(None).cast("string") if ref is None else ref).alias("ref"),
                (F.lit(None).cast("string") if kind is None else kind).alias("kind"),
                (F.lit(None).cast("bigint") if tokens is None else tokens).alias("tokens"),
            )

        middle = F.transform(
            seen,
            lambda p: segment(
                p["body"], (t["role"] == loss_role) & p["tokens"].isNull(), p["ref"],
                F.when(p["tokens"].isNotNull(), p["kind"]), p["tokens"],
            ),
        )
        no = F.lit(False)
        return F.concat(F.array(segment(head, no)), middle, F.array(segment(F.lit(TURN_CLOSE), no)))

    segmented = chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("turns", segments_of)).alias("all"),
    )
    attachments = F.filter("all", lambda s: s["tokens"].isNotNull())
    return segmented.select(
        "conv_id",
        "n_turns",
        F.array_join(F.transform("all", lambda s: s["text"]), "").alias("formatted"),
        F.transform("all", lambda s: F.struct(s["text"].alias("text"), s["loss"].alias("loss"))).alias("segments"),
        F.transform(
            attachments,
            lambda s, i: F.struct(
                (i + 1).alias("place"), s["kind"].alias("kind"), s["ref"].alias("ref"), s["tokens"].alias("tokens")
            ),
        ).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns in a formatted text: array of role, text (placeholders as they stand)."""
    pieces = F.split(formatted, "</turn>\n", -1)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def parse(piece: Column) -> Column:
        head = F.substring_index(piece, TURN_HEAD_END, 1)
        role = F.substr(head, F.lit(len(TURN_OPEN) + 1))
        body = F.substr(piece, F.length(head) + 2)
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, parse)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"])), "")


def chat_digest(chats: DataFrame) -> DataFrame:
    """What `format_chats` wrote, read back from its output and digested."""
    back: Callable[[Column], Column] = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return chats.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("segments")).alias("loss"),
        F.size("attachments").cast("long").alias("n_attachments"),
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", back), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_attachments",
    )
