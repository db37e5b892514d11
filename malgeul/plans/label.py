"""From recognised segments to labelled utterances: aggregate, triage, verify, normalise, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from malgeul.functions.normalize import Spacer, normalize
from malgeul.operators.segments import mean_utterances
from malgeul.operators.triage import Thresholds, triage

ERROR = "[ERROR]"


def results(utterances: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """``utterances(utt_id, text, avg_logprob, compression_ratio[, duration, language, error])`` as pipeline results; a row with
    an error, or without text or scores, is bucket C with reason processing_error."""
    def column(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in utterances.columns else F.lit(None).cast(kind)

    failed = column("error", "string")
    t = triage(F.when(failed.isNull(), F.col("text")), F.col("avg_logprob"), F.col("compression_ratio"), thresholds)
    rows = utterances.select("utt_id", "text", column("duration", "double").alias("duration"), column("language", "string").alias("language"), failed.alias("error"), t.alias("t"))
    bad = F.col("t.reason") == "processing_error"
    metrics = F.struct("t.avg_logprob", "t.compression_ratio", "duration", "language", "t.text_length", "t.has_repetition", F.when(bad, F.coalesce("error", F.lit("missing input"))).alias("error"))
    return rows.select(
        F.col("utt_id").alias("sample_id"), F.when(bad, ERROR).otherwise(F.col("text")).alias("text_raw"), "t.bucket", "t.reason", metrics.alias("metrics"),
        F.lit(None).cast("string").alias("text_verified"), F.lit(None).cast("string").alias("text_normalized"),
    )


def transcription_errors(rows: DataFrame) -> DataFrame:
    """``rows(text, avg_logprob, compression_ratio, duration, error)`` of a batch: a row with an error reads ``ERROR`` with log probability -1."""
    failed = F.col("error").isNotNull()
    of = {"text": F.lit(ERROR), "avg_logprob": F.lit(-1.0), "compression_ratio": F.lit(0.0), "duration": F.lit(0.0)}
    return rows.select(*(F.when(failed, of[c]).otherwise(F.col(c)).alias(c) if c in of else F.col(c) for c in rows.columns))


def without_errors(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows without an error, and how many there are with one."""
    return rows.filter("error is null"), rows.filter("error is not null").count()


def normalization_source(verified: Column, raw: Column) -> Column:
    """The verified text, or the raw one where that is null or empty; null for empty and failed rows."""
    text = F.coalesce(F.nullif(verified, F.lit("")), raw)
    return F.when(~text.isin("", ERROR), text)


def normalize_results(rows: DataFrame, spacer: Spacer | None = None) -> DataFrame:
    source = normalization_source(F.col("text_verified"), F.col("text_raw"))
    return rows.withColumn("text_normalized", F.when(source.isNotNull(), normalize(source, spacer)))


def label(segments: DataFrame, utterances: DataFrame | None = None, thresholds: Thresholds = Thresholds()) -> DataFrame:
    return normalize_results(results(mean_utterances(segments, utterances), thresholds))
