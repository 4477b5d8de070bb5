"""Training examples from conversations: every reply with all that was said before it.

Each assistant turn becomes an example of its own. Its text holds all earlier
turns as context, and only the reply itself is trainable. What a conversation
says after its last reply (or all of it, where nobody replies) makes one more
example with nothing to train on, so that the examples lose nothing.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings
inside roles and texts are broken up by a word joiner behind their first
character; one that is broken up already gets one more. So every text has exactly
one escaped form, texts without control strings stay as they are, and marks of
the template never come from a text.

Turns are taken in the order of ``turn``, then role, then text, nulls first; equal
rows are separate turns. A null role or text is empty, and rows without
``conv_id`` are one conversation. Only the role ``assistant``, as it is written
here, replies. Further columns are left out; an empty table gives no rows. A
conversation is one value of Spark (as its digest has to be); its examples,
which grow with the square of its turns, are rows made one after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template and what counts as a control string.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
REPLIES = "assistant"
_JOINER = "⁠"
_REST = r"(\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"
CONTROL = rf"([<\[])({_JOINER}*){_REST}"
_BROKEN = rf"([<\[]){_JOINER}({_JOINER}*){_REST}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, f"$1{_JOINER}$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _BROKEN, "$1$2$3")


def _turn(row: Column) -> Column:
    return F.concat(F.lit(START), escape(row["role"]), F.lit(MIDDLE), escape(row["text"]), F.lit(END))


def examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, example`` (from 0)``, text, loss_start, loss_length`` (code points; the escaped reply).

    The last row of a conversation that does not end with a reply has the loss length null.
    """
    rows = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("said"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    count = F.size("said")
    # Places, from 1, of the replies and of the last turn.
    places = F.filter(F.sequence(F.lit(1), count), lambda i: (F.element_at("said", i)["role"] == REPLIES) | (i == count))
    parts = whole.select("conv_id", F.transform("said", _turn).alias("parts"), places.alias("places"))
    # Only the place differs between examples; each text is put together row by row.
    each = parts.select("conv_id", "parts", F.posexplode("places").alias("example", "upto")).select(
        "conv_id",
        "example",
        F.array_join(F.slice("parts", F.lit(1), F.col("upto")), "").alias("text"),
        F.element_at("parts", F.col("upto")).alias("target"),
    )
    before = START + REPLIES + MIDDLE
    is_reply = F.col("target").startswith(before)
    return each.select(
        "conv_id",
        "example",
        "text",
        (F.length("text") - F.when(is_reply, F.length("target") - len(before)).otherwise(len(END))).alias("loss_start"),
        F.when(is_reply, F.length("target") - len(before) - len(END)).alias("loss_length"),
    )


def turns_of(text: Column) -> Column:
    """The turns of a formatted text: an array of role and text as they were before formatting."""
    parts = F.filter(F.split(text, r"<\|im_start\|>"), lambda p: p != "")

    def turn(part: Column) -> Column:
        said = F.substring_index(part, MIDDLE, -1)
        return F.struct(
            unescape(F.substring_index(part, MIDDLE, 1)).alias("role"),
            unescape(F.substring(said, F.lit(1), F.length(said) - len(END))).alias("text"),
        )

    return F.transform(parts, turn)


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its examples alone.

    The last example holds all turns; each example gives the text under its loss
    mask. ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    trained = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_length")))
    # The examples of a conversation lie together, so nothing is moved; of the texts only the longest is kept.
    back = formatted.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"),
        F.sort_array(F.collect_list(F.when(F.col("loss_length").isNotNull(), F.struct("example", trained.alias("reply"))))).alias("replies"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("replies", lambda r: r["reply"]), "")
    read = back.select("conv_id", turns_of(F.col("longest")).alias("turns"), loss.alias("loss"), "formatted_chars")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
