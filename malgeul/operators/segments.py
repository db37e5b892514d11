"""From recognised segments to utterances, and resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from malgeul.functions.textexpr import strip
from malgeul.operators.quantiles import exact_percentiles


def utterance_id(speaker: Column, sentence: Column) -> Column:
    return F.concat(F.coalesce(speaker.cast("string"), F.lit("")), F.lit("_"), F.coalesce(sentence.cast("string"), F.lit("")))


def default_speaker(index: Column) -> Column:
    return F.format_string("S%04d", index)


def default_sentence(index: Column) -> Column:
    return F.format_string("%06d", index)


def _joined_text() -> Column:
    ordered = F.array_sort(F.collect_list(F.struct("seg_no", "text")))
    return strip(F.array_join(F.transform(ordered, lambda s: s["text"]), ""))


def _outer(utterances: DataFrame | None, made: DataFrame, defaults: dict) -> DataFrame:
    """``made`` with a row of defaults for each utterance without segments."""
    if utterances is None:
        return made
    rows = utterances.select("utt_id").distinct().join(made, "utt_id", "left")
    return rows.select("utt_id", *(F.coalesce(c, F.lit(v)).alias(c) for c, v in defaults.items()))


def weighted_utterances(segments: DataFrame, utterances: DataFrame | None = None) -> DataFrame:
    """Means weighted by duration, or plain ones where the durations do not sum to more than 0; whether any
    temperature is above 0; texts joined in order of ``seg_no``."""
    length = F.col("end") - F.col("start")

    def mean(c: str) -> Column:
        return F.when(F.sum(length) > 0, F.sum(F.col(c) * length) / F.sum(length)).otherwise(F.avg(c))

    made = segments.groupBy("utt_id").agg(
        _joined_text().alias("text_raw"), mean("avg_logprob").alias("avg_logprob"), mean("no_speech_prob").alias("avg_no_speech_prob"),
        mean("compression_ratio").alias("compression_ratio"), F.bool_or(F.coalesce(F.col("temperature") > 0, F.lit(False))).alias("temperature_fallback"),
    )
    return _outer(utterances, made, {"text_raw": "", "avg_logprob": -1.0, "avg_no_speech_prob": 1.0, "compression_ratio": 0.0, "temperature_fallback": False})


def mean_utterances(segments: DataFrame, utterances: DataFrame | None = None) -> DataFrame:
    """Plain means over segments."""
    made = segments.groupBy("utt_id").agg(_joined_text().alias("text"), F.avg("avg_logprob").alias("avg_logprob"), F.avg("compression_ratio").alias("compression_ratio"))
    return _outer(utterances, made, {"text": "", "avg_logprob": -1.0, "compression_ratio": 0.0})


def not_done(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose ``utt_id`` is not in ``done``; rows without one stay."""
    return rows.join(done.select("utt_id").distinct(), "utt_id", "left_anti")


def hours(rows: DataFrame, by: str = "split") -> DataFrame:
    return rows.groupBy(by).agg((F.sum("duration") / 3600).alias("hours"))


def real_time_factor(rows: DataFrame) -> DataFrame:
    """Seconds of work over seconds of audio of ``rows(wall_seconds, duration)``; null without audio."""
    return rows.agg(F.try_divide(F.sum("wall_seconds"), F.sum("duration")).alias("rtf"))


def shard_of(index: Column, size: int = 200) -> Column:
    return F.floor(index / size)


def describe(rows: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, deviation, minimum, exact quartiles and maximum: a row for each column."""
    quartiles = {c: exact_percentiles(rows, c, (0.25, 0.5, 0.75)) for c in columns}
    told = rows.agg(*(x for c in columns for x in (F.count(c).alias(f"{c}_count"), F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))))

    def one(c: str) -> Column:
        of = {n: F.col(f"{c}_{n}") for n in ("count", "mean", "std", "min", "max")} | {f"p{p}": F.lit(v) for p, v in zip((25, 50, 75), quartiles[c], strict=True)}
        return F.struct(F.lit(c).alias("metric"), *(of[n].cast("double").alias(n) for n in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")))

    return told.select(F.inline(F.array(*map(one, columns))))
