"""Corrections and triage on streams.

Triage, spans and normalisation work row by row and run on a stream as they are.  Percentile buckets need
a batch: here each micro-batch is one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from malgeul import schemas
from malgeul.operators.correct import available, correct, issues_of
from malgeul.operators.triage import triage
from malgeul.plans.providers import Provider, unchanged


def read_transcripts(spark, path: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schemas.ASR).option("maxFilesPerTrigger", files_per_batch).json(path)


def triaged(rows: DataFrame) -> DataFrame:
    return rows.withColumn("triage", triage(F.coalesce("text", "text_raw"), F.col("avg_logprob"), F.col("compression_ratio"))).select("*", "triage.bucket", "triage.reason").drop("triage")


def correct_stream(rows: DataFrame, out: str, checkpoint: str, provider: Provider = unchanged) -> StreamingQuery:
    """Issues and available texts of each micro-batch in folders named by its number, so that a repeated batch replaces its own."""

    def batch(frame: DataFrame, number: int) -> None:
        made = correct(frame, provider).persist()
        try:
            issues_of(made).write.mode("overwrite").json(f"{out}/issues/batch={number}")
            available(made).write.mode("overwrite").json(f"{out}/available/batch={number}")
        finally:
            made.unpersist()

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
