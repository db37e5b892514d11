"""Text expressions: let-binding, Unicode whitespace, regex replacement by a computed value, and match offsets.

``U`` makes ``\\d \\s \\w \\b`` follow Unicode and lets only a line feed end a line for ``$``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

U = "(?Ud)"
_MATCH, _GROUP, _END = "\x01", "\x02", "\x03"
#: Stands where a computed value was null.
LOST = "\x04"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def either(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, rf"{U}^\s+", ""), r"(?U)\s+\z", "")


def collapse(text: Column) -> Column:
    """Runs of whitespace become one space, none at the ends."""
    return F.regexp_replace(strip(either(text)), rf"{U}\s+", " ")


def words(text: Column) -> Column:
    return F.filter(F.split(text, rf"{U}\s+"), lambda w: w != "")


def sanitize(text: Column) -> Column:
    """Without the control characters that mark matches and lost values."""
    return F.translate(text, _MATCH + _GROUP + _END + LOST, "")


def replace_with(text: Column, pattern: str, groups: int, value: Callable[[list[Column]], Column]) -> Column:
    """Replace each match by ``value`` of its groups; a group that took no part is ''.  A null value leaves ``LOST`` behind.

    ``text`` must not hold the control characters that ``sanitize`` removes."""
    marked = F.regexp_replace(text, pattern, _MATCH + _GROUP.join(f"${i + 1}" for i in range(groups)) + _END)

    def part(piece: Column, i: Column) -> Column:
        found = lambda g: F.when(i == 0, piece).otherwise(F.concat(F.coalesce(value([F.get(g, F.lit(k)) for k in range(groups)]), F.lit(LOST)), F.get(F.split(piece, _END), F.lit(1))))
        return let(F.split(F.substring_index(piece, _END, 1), _GROUP), found)

    return F.array_join(F.transform(F.split(marked, _MATCH), part), "")


_CHUNK = 64


def match_offsets(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, text>>`` of all matches, half-open, in code points.

    The control characters that mark matches count as another one while matches are looked for, so that places are those of the text.
    Appending to an array copies it, so pieces are folded in chunks and the chunks then placed one after the other."""
    marks = _MATCH + _GROUP + _END + LOST
    pieces = F.split(F.regexp_replace(F.translate(text, marks, "\x05" * len(marks)), pattern, _MATCH + "$0" + _GROUP), _MATCH)
    one = "struct<start: int, end: int, text: string>"
    empty = lambda kind: F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{kind}>)").alias("found"))

    def step(state: Column, piece: Column) -> Column:
        def told(x: Column) -> Column:
            own, rest = F.get(x, F.lit(0)), F.get(x, F.lit(1))
            plain = F.size(x) == 1
            stop = state["at"] + F.length(own)
            hit = F.struct(state["at"].alias("start"), stop.alias("end"), own.alias("text"))
            return F.struct(
                F.when(plain, stop).otherwise(stop + F.length(F.coalesce(rest, F.lit("")))).alias("at"),
                F.when(plain, state["found"]).otherwise(F.concat(state["found"], F.array(hit))).alias("found"),
            )

        return let(F.split(piece, _GROUP), told)

    def place(state: Column, chunk: Column) -> Column:
        own = F.struct(state["at"].alias("base"), chunk["found"].alias("found"))
        return F.struct((state["at"] + chunk["at"]).alias("at"), F.concat(state["found"], F.array(own)).alias("found"))

    def moved(part: Column) -> Column:
        return F.transform(part["found"], lambda m: F.struct((m["start"] + part["base"]).alias("start"), (m["end"] + part["base"]).alias("end"), m["text"].alias("text")))

    def folded(all_: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _CHUNK).cast("int"))
        chunks = F.transform(firsts, lambda c: F.aggregate(F.slice(all_, c * _CHUNK + 1, _CHUNK), empty(one), step))
        return F.aggregate(chunks, empty(f"struct<base: int, found: array<{one}>>"), place, lambda s: F.flatten(F.transform(s["found"], moved)))

    def own(m: Column) -> Column:
        return F.struct(m["start"], m["end"], F.substr(text, m["start"] + 1, m["end"] - m["start"]).alias("text"))

    return let(let(pieces, folded), lambda found: F.when(text.rlike(f"[{marks}]"), F.transform(found, own)).otherwise(found))


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: ~((end <= s["start"]) | (start >= s["end"])))
