"""Chat formatting: turns of a conversation as one training string with a loss mask.

Template of a block of adjacent turns of one role::

    ### role</role>\n text <next/> text </turn>\n

(without the spaces).  Inside roles and texts every backslash, ``#`` and ``<`` is followed by a
backslash, so no control string can occur there, and deleting that backslash restores the text.

The turns of a conversation are collected as structs and sorted, blocks of adjacent turns of one role are cut from the sorted array and joined, and the
places of the texts are running sums over the array.  Everything is built from Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from malgeul.llm.common import require

HEAD, ROLE_END, NEXT, TURN_END = "### ", "</role>\n", "<next/>", "</turn>\n"
_CHUNK = 64


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#<])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#<])\\", "$1")


def _running(sizes: Column) -> Column:
    """The sums of the elements before each place.  Appending to an array copies it, so places are added up in chunks."""
    grow = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    chunk = lambda i: F.aggregate(F.slice(sizes, i * _CHUNK + 1, F.lit(_CHUNK)), F.array(F.lit(0)), grow)
    let = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)

    def placed(chunks: Column) -> Column:
        bases = F.aggregate(chunks, F.array(F.lit(0)), lambda sums, c: grow(sums, F.element_at(c, -1)))
        moved = lambda b: F.transform(chunks, lambda c, i: F.transform(F.slice(c, F.lit(1), F.size(c) - 1), lambda x: x + F.get(b, i)))
        return F.flatten(let(bases, moved))

    return let(F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _CHUNK).cast("int")), chunk), placed)


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per ``conv_id``: ``formatted`` and ``loss_spans``, the half-open code-point ranges of
    the texts of ``loss_role``.

    Turns are ordered by ``turn`` (nulls first), then role, then text; repeated rows all stay.
    Null roles and texts count as empty strings, a null ``conv_id`` is a conversation of its own,
    other columns are ignored, and an empty table gives no rows.  A conversation is one row, whatever its length.
    """
    require(turns, "conv_id", "turn", "role", "text")
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    starts = lambda i: (i == 0) | (F.get("turns", i - 1)["role"] != F.get("turns", i)["role"])
    part = lambda t, i: F.struct(starts(i).alias("first"), escape(t["role"]).alias("role"), escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss"))
    parts = chats.select("conv_id", F.transform("turns", part).alias("parts"))
    # blocks of adjacent turns of one role, each from where it starts up to the next one
    firsts = F.filter(F.sequence(F.lit(0), F.size("parts") - 1), lambda i: F.get("parts", i)["first"])
    # characters before each text: what ends the block before it and begins its own, or what parts it from the text before it
    begun = lambda p, i: F.length(p["role"]) + len(HEAD + ROLE_END) + F.when(i > 0, len(TURN_END)).otherwise(0)
    lead = lambda p, i: F.when(p["first"], begun(p, i)).otherwise(len(NEXT))
    before = _running(F.transform("parts", lambda p, i: lead(p, i) + F.length(p["body"])))
    rows = parts.select("conv_id", "parts", firsts.alias("firsts"), before.alias("before"))
    length = lambda i, j: F.coalesce(F.get("firsts", j + 1), F.size("parts")) - i
    merged = lambda i, j: F.array_join(F.transform(F.slice("parts", i + 1, length(i, j)), lambda p: p["body"]), NEXT)
    block = lambda i, j: F.concat(F.lit(HEAD), F.get("parts", i)["role"], F.lit(ROLE_END), merged(i, j), F.lit(TURN_END))
    start = lambda p, i: F.get("before", i) + lead(p, i)
    spans = F.transform("parts", lambda p, i: F.struct(p["loss"].alias("loss"), start(p, i).alias("start"), (start(p, i) + F.length(p["body"])).alias("stop")))
    return rows.select(
        "conv_id",
        F.array_join(F.transform("firsts", block), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["stop"])).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string as ``array<struct<role, text>>``."""

    def block(part: Column) -> Column:
        role = unescape(F.substring_index(F.substring(part, len(HEAD) + 1, 2**31 - 1), ROLE_END, 1))
        body = F.substring_index(part, ROLE_END, -1)
        return F.transform(F.split(body, NEXT), lambda text: F.struct(role.alias("role"), unescape(text).alias("text")))

    parts = F.split(formatted, TURN_END)
    return F.flatten(F.transform(F.filter(parts, lambda p: p != ""), block))


def masked_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under a loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))), "")


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests read back from ``formatted`` and ``loss_spans``."""
    read = chats.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
