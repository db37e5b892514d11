"""Accuracy of normalised text at several levels of strictness, and character error rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from malgeul.functions.normalize import canonical_levels, text_flags
from malgeul.functions.textexpr import either

LEVELS = ("strict", "punct", "punct_space", "no_space")


def matches(pred: Column, gold: Column) -> dict[str, Column]:
    return {f"match_{n}": p == g for n, p, g in zip(LEVELS, canonical_levels(pred), canonical_levels(gold), strict=True)}


def _chosen(rows: DataFrame, by: str, most: int | None) -> DataFrame:
    return rows.orderBy(by).limit(most) if most is not None else rows


def accuracy(rows: DataFrame, by: str = "i", most: int | None = 200) -> DataFrame:
    """One row over the first ``most`` of ``rows(i, raw, pred, gold)``: counts of rows, flags and matches, and match ratios."""
    own = _chosen(rows, by, most).select(*(c.alias(n) for n, c in {**text_flags(either(F.col("raw"))), **matches(F.col("pred"), F.col("gold"))}.items()))
    counts = [F.count_if(c).alias(c) for c in own.columns]
    ratios = [F.try_divide(F.count_if(f"match_{n}"), F.count("*")).alias(f"ratio_{n}") for n in LEVELS]
    return own.agg(F.count("*").alias("rows"), *counts, *ratios)


def mismatches(rows: DataFrame, by: str = "i", most: int | None = 200, show: int = 25) -> DataFrame:
    """The first rows whose texts differ."""
    return _chosen(rows, by, most).filter(either(F.col("pred")) != either(F.col("gold"))).orderBy(by).limit(show)


def character_error_rate(rows: DataFrame) -> DataFrame:
    """Edit distance over length of gold, both summed over all rows; null without gold."""
    return rows.agg(F.try_divide(F.sum(F.levenshtein(either(F.col("pred")), either(F.col("gold")))), F.sum(F.length(either(F.col("gold"))))).alias("cer"))
