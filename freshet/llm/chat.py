"""Chat formatting with a verified grammar, DataFrame functions only.

    conversation := turn*
    turn         := "<s>[INST]" role "[/INST]" text "</s>"

The parser is deterministic: it cuts at every closing mark, takes what stands
between the marks, and takes one backslash out of each broken control string.
A turn is rendered as it is and parsed again; if that doesn't give the role
and text back, control strings in it are broken by a backslash after their
first character, and if it still doesn't, strings that look broken already get
one more. Breaking is one-to-one, so the last form always comes back.

No control string holds a first character of one further in, so none can form
across the border of two parts: the parse of a conversation is that of its turns.

Defined results: a null role or text is empty; turns are in the order of
``turn``, nulls first, and rows that agree in it in the order of their
rendering; rows without a conversation id form one conversation; very long texts
are rendered whole, and a conversation's text is one value; an empty table gives
an empty table; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
LOSS_ROLE = "assistant"

# Where a backslash goes: after the first character of a control string, of a
# whole one, or also of one that backslashes have broken.
_WHOLE = r"(?<=<)(?=/?s>)|(?<=\[)(?=/?INST\])"
_ANY = r"(?<=<)(?=\\*/?s>)|(?<=\[)(?=\\*/?INST\])"
_BROKEN = r"(?<=<)\\(?=\\*/?s>)|(?<=\[)\\(?=\\*/?INST\])"

_ESCAPES: list[Callable[[Column], Column]] = [
    lambda part: part,
    lambda part: F.regexp_replace(part, _WHOLE, r"\\"),
    lambda part: F.regexp_replace(part, _ANY, r"\\"),
]


def render(role: Column, text: Column, escape: Callable[[Column], Column] = _ESCAPES[-1]) -> Column:
    """One turn by the grammar."""
    return F.concat(F.lit(OPEN), escape(role), F.lit(MIDDLE), escape(text), F.lit(CLOSE))


def plain(part: Column) -> Column:
    """A part of a turn as it was before control strings in it were broken."""
    return F.regexp_replace(part, _BROKEN, "")


def masked(formatted: Column, loss: Column) -> Column:
    """The texts that the stretches of a loss mask cut out of a formatted conversation."""

    def cut(stretch: Column) -> Column:
        return plain(F.substring(formatted, stretch["start"].cast("int") + 1, (stretch["end"] - stretch["start"]).cast("int")))

    return F.transform(loss, cut)


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; one that breaks the grammar has null parts."""

    def turn(piece: Column) -> Column:
        inner = F.when(F.startswith(piece, F.lit(OPEN)), F.substring(piece, F.lit(len(OPEN) + 1), F.length(piece)))
        parts = F.split(inner, r"\[/INST\]|<s>|\[INST\]", -1)
        good = F.size(parts) == 2
        return F.struct(
            F.when(good, plain(F.get(parts, F.lit(0)))).alias("role"),
            F.when(good, plain(F.get(parts, F.lit(1)))).alias("text"),
        )

    pieces = F.split(formatted, CLOSE, -1)
    # Nothing may follow the last closing mark.
    return F.when(F.endswith(formatted, F.lit(CLOSE)), F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn))


def verified(role: Column, text: Column) -> Column:
    """The first rendering of a turn from which exactly it is read back."""
    out = F.raise_error(F.lit("no rendering of the turn can be read back")).cast("string")
    for escape in reversed(_ESCAPES):
        way = render(role, text, escape)
        same = parse(way) == F.array(F.struct(role.alias("role"), text.alias("text")))
        out = F.when(same, way).otherwise(out)
    return out


def rendered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``rendered`` and ``masked`` (whether its text counts for the loss) of every row."""
    plain = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return plain.select(
        "conv_id", "turn", verified(F.col("role"), F.col("text")).alias("rendered"), (F.col("role") == LOSS_ROLE).alias("masked")
    )


def formatted(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its text and the stretches of it that count for the loss.

    ``loss``: start and end, in code points, of the text between the marks of
    each assistant turn, escapes included.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "rendered")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rendered(turns, conv, turn, role, text).withColumn(
        "at", F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0))
    )
    lead = F.locate(MIDDLE, F.col("rendered")) + len(MIDDLE) - 1
    stretch = F.when(
        F.col("masked"),
        F.struct(
            (F.col("at") + lead).cast("long").alias("start"),
            (F.col("at") + F.length("rendered") - len(CLOSE)).cast("long").alias("end"),
        ),
    )
    gathered = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "rendered"))).alias("turns"),
        F.sort_array(F.collect_list(stretch)).alias("loss"),
    )
    return gathered.select("conv_id", F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"), "loss")
