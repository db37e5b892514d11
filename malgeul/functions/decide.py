"""Decisions on rewrite candidates behind conservative guards, prompts, and fix application."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from malgeul.functions.textexpr import U, let, overlaps


@dataclass(frozen=True)
class Guards:
    """Limits of the automatic fixes."""

    max_change: float = 0.35
    number_buckets: tuple[str, ...] = ("GREEN", "YELLOW")
    number_margin: float = 0.25
    number_change: float = 0.20
    latin_buckets: tuple[str, ...] = ("GREEN",)
    latin_margin: float = 0.35
    latin_change: float = 0.15
    sentence_buckets: tuple[str, ...] = ("GREEN",)
    sentence_change: float = 0.18


TASKS = ("STW_CANON", "STW_SPAN", "STW_URL")


def edit_ratio(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, 0.0).otherwise(F.levenshtein(a, b) / longest)  # equal texts can be long: the distance takes the square of that


def margin(candidates: Column) -> Column:
    """By how much the best score leads; 1 without a second candidate."""
    score = lambda i: F.get(candidates, F.lit(i))["score"]
    return F.when(F.size(candidates) < 2, 1.0).otherwise(score(0) - score(1))


def mixed_script(text: Column) -> Column:
    return text.rlike("[가-힣]") & text.rlike("[A-Za-z]")


def only_symbols(text: Column) -> Column:
    return text.rlike(rf"{U}^[\s.,!?;:\-_'\"()\[\]{{}}]*\z")


def span_action(tag: Column, bucket: Column, raw: Column, recommended: Column, lead: Column, guards: Guards = Guards()) -> Column:
    """AUTO_FIX, NEEDS_REVIEW or PASS for one span."""

    def rules(ratio: Column) -> Column:
        near, said = ratio <= guards.max_change, ~only_symbols(recommended)
        number = bucket.isin(list(guards.number_buckets)) & (lead >= guards.number_margin) & (ratio <= guards.number_change) & near & said
        script = (raw == recommended) | ~mixed_script(recommended) | mixed_script(raw)
        latin = bucket.isin(list(guards.latin_buckets)) & (lead >= guards.latin_margin) & (ratio <= guards.latin_change) & near & said & script
        return (  # the cheap tests first: patterns cost most
            F.when(tag.isin("U1", "OOV"), "NEEDS_REVIEW")
            .when(tag == "N3", F.when(number, "AUTO_FIX").otherwise("NEEDS_REVIEW"))
            .when(tag == "E2", F.when(latin, "AUTO_FIX").otherwise("NEEDS_REVIEW"))
            .when(~near | ~said, "NEEDS_REVIEW")
            .otherwise("PASS")
        )

    return let(edit_ratio(raw, recommended), rules)


def sentence_action(bucket: Column, raw: Column, canonical: Column, has_address: Column, guards: Guards = Guards()) -> Column:
    fits = bucket.isin(list(guards.sentence_buckets)) & ~has_address & (edit_ratio(raw, canonical) <= guards.sentence_change)
    return F.when(F.coalesce(fits, F.lit(False)), "AUTO_FIX").otherwise("NEEDS_REVIEW")


def prompt(task: str, left: Column, span: Column, right: Column) -> Column:
    if task not in TASKS:
        raise ValueError(f"unknown task: {task}")
    if task == "STW_CANON":
        return F.concat(F.lit(f"<{task}>\n"), span, F.lit(f"\n</{task}>"))
    return F.concat(F.lit(f"<{task}>\nLEFT: "), left, F.lit("\nSPAN: ⟦"), span, F.lit("⟧\nRIGHT: "), right, F.lit(f"\n</{task}>"))


def rank_scores(texts: Column) -> Column:
    """Candidates of an ordered list without scores: 1 - i / n."""
    return let(texts, lambda t: F.transform(t, lambda x, i: F.struct(x.alias("text"), (1.0 - i / F.greatest(F.size(t), F.lit(1))).alias("score"))))


def ranked(candidates: Column) -> Column:
    """One candidate for each text, with its best score, best first; among equals the earlier one leads."""
    placed = F.transform(candidates, lambda c, i: F.struct((-c["score"]).alias("minus"), i.alias("place"), c["text"].alias("text"), c["score"].alias("score")))
    best = lambda all_: F.filter(all_, lambda c, i: ~F.exists(F.slice(all_, F.lit(1), i), lambda d: d["text"] == c["text"]))
    return F.transform(let(F.array_sort(placed), best), lambda c: F.struct(c["text"], c["score"]))


def mark(left: Column, span: Column, right: Column) -> Column:
    return F.concat(left, F.lit("⟦"), span, F.lit("⟧"), right)


def mark_safe(marked: Column) -> Column:
    return F.replace(F.replace(marked, F.lit("⟦"), F.lit("[[")), F.lit("⟧"), F.lit("]]"))


def _splice(text: Column, start: Column, end: Column, new: Column) -> Column:
    return F.concat(F.left(text, start), new, F.substr(text, end + 1, F.lit(2**31 - 1)))


def _from_the_end(a: Column, b: Column) -> Column:
    return F.when(a["start"] != b["start"], b["start"] - a["start"]).otherwise(a["end"] - b["end"])


def apply_fixes(text: Column, fixes: Column) -> Column:
    """Apply ``array<struct<start, end, new>>``, those that start later first and of these the shorter; one that overlaps an
    applied one is left out."""
    none = F.expr("cast(array() as array<struct<start: int, end: int>>)")

    def step(state: Column, f: Column) -> Column:
        clash = overlaps(state["done"], f["start"], f["end"])
        return F.struct(
            F.when(clash, state["text"]).otherwise(_splice(state["text"], f["start"], f["end"], f["new"])).alias("text"),
            F.when(clash, state["done"]).otherwise(F.concat(state["done"], F.array(F.struct(f["start"].cast("int").alias("start"), f["end"].cast("int").alias("end"))))).alias("done"),
        )

    return F.aggregate(F.array_sort(fixes, _from_the_end), F.struct(text.alias("text"), none.alias("done")), step, lambda s: s["text"])


def apply_all(text: Column, fixes: Column) -> Column:
    """Apply ``array<struct<start, end, new, place>>`` from the end without regard to overlaps; ``place`` orders equal starts."""
    order = lambda a, b: F.when(a["start"] != b["start"], b["start"] - a["start"]).otherwise(a["place"] - b["place"])
    return F.aggregate(F.array_sort(fixes, order), text, lambda t, f: _splice(t, f["start"], f["end"], f["new"]))


def review_cell(candidates: Column, most: int = 5) -> Column:
    """The first candidates as ``text (score)`` between bars."""
    return F.array_join(F.transform(F.slice(candidates, 1, most), lambda c: F.concat(c["text"], F.lit(" ("), F.format_string("%.3f", c["score"]), F.lit(")"))), " | ")
