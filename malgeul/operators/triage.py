"""Triage by absolute thresholds (A, B, C) and by percentiles of the batch (RED to GREEN)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from malgeul.functions.spans import text_risk
from malgeul.functions.textexpr import U, let, strip, words
from malgeul.operators.quantiles import exact_percentiles


@dataclass(frozen=True)
class Thresholds:
    compression_max: float = 4.0
    least_length: int = 2
    repeats: int = 3
    high: float = -0.3
    medium: float = -0.7


@dataclass(frozen=True)
class Percentiles:
    red: float = 0.03
    orange: float = 0.15
    yellow: float = 0.40


def has_repetition(text: Column, repeats: int = 3, size: int = 2) -> Column:
    """A block of ``size`` characters ``repeats`` times in a row, or as many equal words, in a text of at least size * repeats characters."""

    def equal_run(w: Column) -> Column:
        starts = F.when(F.size(w) >= repeats, F.sequence(F.lit(0), F.size(w) - repeats)).otherwise(F.array().cast("array<int>"))
        same = lambda i: reduce(Column.__and__, (F.get(w, i) == F.get(w, i + k) for k in range(1, repeats)))
        return F.exists(starts, same)

    block = r"(?s)(" + "." * size + ")" + r"\1" * (repeats - 1)
    return (F.length(text) >= size * repeats) & (text.rlike(block) | let(words(text), equal_run))


def triage(text: Column, logprob: Column, compression: Column, t: Thresholds = Thresholds()) -> Column:
    """``struct<bucket, reason, avg_logprob, compression_ratio, text_length, has_repetition>``.  NaN passes no threshold; a null
    input gives bucket C with reason processing_error."""
    above = lambda x, limit: ~F.isnan(x) & (x > limit)

    def scored(x: Column) -> Column:
        repeated = x["repeated"]
        reason = (
            F.when(x["text"].isNull() | logprob.isNull() | compression.isNull(), "processing_error")
            .when(above(compression, t.compression_max), "compression_ratio_high")
            .when(repeated if t.repeats == 3 else has_repetition(x["text"], t.repeats), "repeated_ngram")
            .when(F.length(x["text"]) < t.least_length, "too_short")
            .when(above(logprob, t.high), "high_confidence")
            .when(above(logprob, t.medium), "medium_confidence")
            .otherwise("low_confidence")
        )
        return let(reason, lambda r: F.struct(
            F.when(r == "high_confidence", "A").when(r == "medium_confidence", "B").otherwise("C").alias("bucket"), r.alias("reason"),
            logprob.alias("avg_logprob"), compression.alias("compression_ratio"), F.length(x["text"]).alias("text_length"),
            ((r == "repeated_ngram") | repeated).alias("has_repetition"),
        ))

    return let(strip(text), lambda own: let(F.struct(own.alias("text"), has_repetition(own).alias("repeated")), scored))


def triage_features(text: Column) -> dict[str, Column]:
    """Digits, Latin letters and things like units in a raw transcript."""
    unit = r"(?Uiu)\d+\s*(?:cm|mm|m|km|kg|g|mg|ml|L|cc|%|도|원|개|명|번|회|시|분|초|년|월|일)"
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return {
        "has_digit": text.rlike(rf"{U}\d"),
        "latin_count": count("[a-zA-Z]"),
        "unit_like_count": count(unit) + count(r"(?U)(?:제|약|총|각)\s*\d+"),
    }


def bucket_statistics(rows: DataFrame, buckets: tuple[str, ...] = ("A", "B", "C"), strict: bool = False) -> DataFrame:
    """One row: ``total`` and, for each bucket, its count and ratio; ratios over no rows are null.  ``strict``: another bucket is an error."""
    if strict:
        rows = rows.withColumn("bucket", F.when(F.col("bucket").isin(*buckets), F.col("bucket")).otherwise(F.raise_error(F.concat(F.lit("unknown bucket: "), F.coalesce("bucket", F.lit("null"))))))
    total = F.count("*")
    columns = [total.alias("total")]
    for b in buckets:
        n = F.count_if(F.col("bucket") == b)
        columns += [n.alias(f"{b.lower()}_count"), F.try_divide(n, total).alias(f"{b.lower()}_ratio")]
    return rows.agg(*columns)


def summary_lines(statistics: DataFrame, buckets: tuple[str, ...] = ("A", "B", "C")) -> DataFrame:
    """``bucket, line`` with a percentage to one decimal."""
    own = [F.struct(F.lit(b).alias("bucket"), F.format_string(f"{b}: %d (%.1f%%)", F.col(f"{b.lower()}_count"), F.coalesce(F.col(f"{b.lower()}_ratio"), F.lit(0.0)) * 100).alias("line")) for b in buckets]
    return statistics.select(F.inline(F.array(*own)))


def risk_logprob(text: Column) -> Column:
    """What stands for a missing log probability: the more risky spans, the lower."""
    return -1.0 - text_risk(text) * 0.1


def with_logprob(rows: DataFrame, text: str = "text_raw", column: str = "avg_logprob") -> DataFrame:
    missing = F.when(F.col(column).isNull(), F.col(text))  # a Python function gets all rows: other texts need not go there
    return rows.withColumn("logprob", F.coalesce(F.col(column), risk_logprob(missing)))


def percentile_thresholds(rows: DataFrame, p: Percentiles = Percentiles(), column: str = "logprob") -> DataFrame:
    """One row ``p_red, p_orange, p_yellow``, interpolated linearly; NaN if any value is, null without values."""
    cuts = exact_percentiles(rows, column, (p.red, p.orange, p.yellow))
    return rows.sparkSession.range(1).select(*(F.lit(v).cast("double").alias(f"p_{n}") for v, n in zip(cuts, ("red", "orange", "yellow"), strict=True)))


def percentile_buckets(rows: DataFrame, p: Percentiles = Percentiles(), column: str = "logprob") -> DataFrame:
    """``rows`` with ``bucket``: the lowest shares of the batch are RED, ORANGE and YELLOW, ties included, the rest GREEN."""
    cuts = percentile_thresholds(rows, p, column)
    below = lambda c: ~F.isnan(c) & (F.col(column) <= F.col(c))
    bucket = F.when(below("p_red"), "RED").when(below("p_orange"), "ORANGE").when(below("p_yellow"), "YELLOW").otherwise("GREEN")
    return rows.crossJoin(F.broadcast(cuts)).withColumn("bucket", bucket).drop("p_red", "p_orange", "p_yellow")  # one row
