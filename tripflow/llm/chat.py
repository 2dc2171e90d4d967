"""Chat formatting of turns made of typed content parts.

A visitor with one method per kind of part flattens a turn into text: words as they are, attachments
as numbered placeholders in order, each recorded with its reference and the tokens it expands to.
The template marks turns with control strings that all begin with ``<|``. Inside roles and texts the
escape ``%3C`` stands for the ``<`` of such a string and ``%25`` for ``%``, so no text can close or
open a turn and every text can be read back.

Built-in functions only. Turns of a conversation meet in one sorted shuffle; the place of every
piece in the output comes from running sums over it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts of a turn. Sizes matter to the kind that has them.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
_NO_PARTS = f"array<{PART}>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def escape_role(role: Column) -> Column:
    """A role stands before ``|>``, so its bars are escaped too."""
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("|"), F.lit("%7C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%7C"), F.lit("|")), F.lit("%25"), F.lit("%"))


@dataclass(frozen=True)
class Template:
    """Control strings; each must begin with ``<|`` and appear in no other way in the output."""

    open_role: str = "<|turn:"
    close_role: str = "|>\n"
    end: str = "<|end|>\n"


@dataclass(frozen=True)
class Visitor:
    """What each kind of part becomes, and how many tokens an attachment expands to."""

    pixels_per_token: int = 28
    audio_tokens_per_second: float = 25.0
    tokens_per_page: int = 1024

    def text(self, part: Column) -> Column:
        return escape(F.coalesce(part["text"], F.lit("")))

    def image(self, part: Column) -> Column:
        def side(n: Column) -> Column:
            return F.ceil(F.coalesce(n, F.lit(0)) / self.pixels_per_token)

        return side(part["width"]) * side(part["height"])

    def audio(self, part: Column) -> Column:
        return F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.audio_tokens_per_second)

    def document(self, part: Column) -> Column:
        return F.coalesce(part["pages"], F.lit(0)).cast("long") * self.tokens_per_page

    def is_attachment(self, part: Column) -> Column:
        return F.coalesce(part["kind"], F.lit("text")).isin("image", "audio", "document")

    def tokens(self, part: Column) -> Column:
        kind = part["kind"]
        return F.when(kind == "image", self.image(part)).when(kind == "audio", self.audio(part)).otherwise(self.document(part)).cast("long")


def text_parts(text: Column) -> Column:
    """Parts of a turn that is plain text; null is empty."""
    none = {n: F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))}
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), *none.values()))


def format_chats(
    turns: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    parts_column: str = "parts",
    loss_roles: tuple[str, ...] = ("assistant",),
    template: Template = Template(),
    visitor: Visitor = Visitor(),
) -> DataFrame:
    """One row per conversation: (conv_id, formatted, n_turns, loss, attachments).

    Turns go by turn number, nulls first; equal numbers by role, then content; repeated rows are
    turns of their own. ``formatted`` holds them in the template. ``loss`` lists (start, length) of
    the contents of turns of ``loss_roles``, counted in characters from 0. ``attachments`` lists
    (number, kind, ref, tokens) in the order of their placeholders ``<|kind:number|>``. A null role,
    null parts and null text are empty; a part of unknown kind is taken as text. Null conversation
    ids are one conversation. An empty table gives no rows. Other columns are not read.
    """
    for mark in (template.open_role, template.end):
        if not mark.startswith("<|"):
            raise ValueError(f"a control string must begin with '<|': {mark!r}")
    if not template.close_role.startswith("|"):
        raise ValueError("the role must be closed by a string that begins with '|'")
    rows = turns.select(
        F.col(conv_column).alias("conv"), F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(parts_column).cast(_NO_PARTS), F.array().cast(_NO_PARTS)).alias("parts"),
    )
    rows = rows.withColumn("own", F.filter("parts", lambda p: visitor.is_attachment(p)))
    # Equal rows are interchangeable, so any order among them gives the same output.
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", F.to_json("parts"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "conv", "role", "parts", "own", F.row_number().over(order).alias("place"),
        F.coalesce(F.sum(F.size("own")).over(before), F.lit(0)).alias("seen"),
    )

    def visited(p: Column, i: Column) -> Column:
        number = F.col("seen") + F.size(F.filter(F.slice("parts", F.lit(1), i), lambda x: visitor.is_attachment(x)))
        placeholder = F.concat(F.lit("<|"), p["kind"], F.lit(":"), number.cast("string"), F.lit("|>"))
        return F.when(visitor.is_attachment(p), placeholder).otherwise(visitor.text(p))

    content = F.array_join(F.transform("parts", visited), "")
    head = F.concat(F.lit(template.open_role), escape_role(F.col("role")), F.lit(template.close_role))
    attached = F.transform(
        "own",
        lambda p, i: F.struct((F.col("seen") + i).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), visitor.tokens(p).alias("tokens")),
    )
    rows = rows.select("conv", "role", "place", head.alias("head"), content.alias("content"), attached.alias("attached"))
    long = F.length("head") + F.length("content") + len(template.end)
    placed = Window.partitionBy("conv").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(long).over(placed), F.lit(0)) + F.length("head"))
    masked = F.when(F.col("role").isin(*loss_roles), F.struct(F.col("start").cast("long").alias("start"), F.length("content").cast("long").alias("length")))
    piece = F.struct("place", F.concat("head", "content", F.lit(template.end)).alias("text"), masked.alias("loss"), "attached")
    # collect_list leaves the order open, so the pieces are sorted by their place.
    made = rows.groupBy("conv").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return made.select(
        F.col("conv").alias(conv_column),
        F.array_join(F.col("pieces.text"), "").alias("formatted"),
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_compact(F.col("pieces.loss")).alias("loss"),
        F.flatten(F.col("pieces.attached")).alias("attachments"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """Array of (role, content) read back from a formatted conversation; texts are unescaped,
    placeholders stay as they are."""
    whole = F.split(formatted, f"\\Q{template.end}\\E")
    turns = F.slice(whole, F.lit(1), F.size(whole) - 1)

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(template.open_role) + 1))
        at = F.locate(template.close_role, body)
        return F.struct(
            unescape_role(F.substr(body, F.lit(1), at - 1)).alias("role"),
            unescape(F.substr(body, at + len(template.close_role))).alias("content"),
        )

    return F.transform(turns, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under a loss mask, unescaped, without anything between."""
    return F.array_join(F.transform(loss, lambda x: unescape(F.substr(formatted, (x["start"] + 1).cast("int"), x["length"].cast("int")))), "")
