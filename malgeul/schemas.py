"""Schemas at the boundaries of the stages, as DDL; every field is nullable."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _ddl(text: str) -> str:
    return " ".join(text.split())


CANDIDATE = "STRUCT<text: STRING, score: DOUBLE>"
SPAN = "STRUCT<`start`: INT, `end`: INT, text: STRING, tag: STRING, `left`: STRING, `right`: STRING>"
META = "STRUCT<avg_logprob: DOUBLE, compression_ratio: DOUBLE, duration: DOUBLE, language: STRING>"
METRICS = "STRUCT<avg_logprob: DOUBLE, compression_ratio: DOUBLE, duration: DOUBLE, language: STRING, text_length: INT, has_repetition: BOOLEAN, error: STRING>"

ASR = _ddl("""utt_id STRING, speaker_id STRING, sentence_id STRING, audio_source STRUCT<dataset: STRING, split: STRING, field: STRING>,
  text STRING, text_raw STRING, avg_logprob DOUBLE, avg_no_speech_prob DOUBLE, compression_ratio DOUBLE, temperature_fallback BOOLEAN,
  language STRING, duration DOUBLE, triage_feat STRUCT<has_digit: BOOLEAN, latin_count: INT, unit_like_count: INT>""")
SEGMENTS = _ddl("utt_id STRING, seg_no INT, text STRING, `start` DOUBLE, `end` DOUBLE, avg_logprob DOUBLE, no_speech_prob DOUBLE, compression_ratio DOUBLE, temperature DOUBLE")
ISSUE_COLUMNS = {
    **dict.fromkeys(("utt_id", "speaker_id", "sentence_id", "bucket", "tag"), "STRING"), "span_start": "INT", "span_end": "INT",
    **dict.fromkeys(("raw_span", "context_full", "context_marked", "context_marked_safe"), "STRING"), "candidates": f"ARRAY<{CANDIDATE}>", "recommended": "STRING", "user_fix": "STRING", "meta": META,
}
ISSUE_FIELDS = ", ".join(f"{name}: {kind}" for name, kind in ISSUE_COLUMNS.items())
ISSUE = ", ".join(f"{name} {kind}" for name, kind in ISSUE_COLUMNS.items())
TEXT_AVAIL = _ddl("utt_id STRING, speaker_id STRING, sentence_id STRING, text_raw STRING, text_avail STRING, bucket STRING, decision STRING")
OUTPUT = _ddl(f"""utt_id STRING, speaker_id STRING, sentence_id STRING, text_raw STRING, bucket STRING, decision STRING, text_avail STRING,
  issues ARRAY<STRUCT<{ISSUE_FIELDS}>>, audit STRUCT<pipeline_version: STRING, mode: STRING, k_candidates: INT, context_len: INT, spans_detected: INT, auto_fixed: INT>""")
REVIEW_COLUMNS = ["utt_id", "speaker_id", "sentence_id", "bucket", "tag", "span_start", "span_end", "raw_span", "context_marked", "candidates", "recommended", "user_fix", "avg_logprob", "compression_ratio"]
RESOLUTION = _ddl("utt_id STRING, speaker_id STRING, sentence_id STRING, span_start INT, span_end INT, raw_span STRING, final_text STRING, was_modified BOOLEAN, resolved_at TIMESTAMP")
FINAL = _ddl("utt_id STRING, speaker_id STRING, sentence_id STRING, text_raw STRING, text_avail STRING, resolved_from STRING, resolution_count INT")
PIPELINE_FIELDS = f"sample_id: STRING, text_raw: STRING, bucket: STRING, reason: STRING, metrics: {METRICS}, text_verified: STRING, text_normalized: STRING"
PIPELINE_ROW = _ddl(f"sample_id STRING, text_raw STRING, bucket STRING, reason STRING, metrics {METRICS}, text_verified STRING, text_normalized STRING")
RESULTS_DOCUMENT = _ddl(f"metadata STRUCT<created_at: STRING, total_count: INT, model_size: STRING>, results ARRAY<STRUCT<{PIPELINE_FIELDS}>>")
BUCKET_REVIEW = _ddl("speaker_id STRING, sentence_id STRING, text_raw STRING, bucket STRING, reason STRING, duration DOUBLE, avg_logprob DOUBLE")
SHARD = _ddl("idx INT, gender STRING, speaker_id STRING, sentence_id STRING, duration DOUBLE, raw_asr_text_acoustic STRING, beam_size INT, vad_filter BOOLEAN")

TAGS = ("N3", "E2", "U1", "OOV", "CANON")
BUCKETS = ("RED", "ORANGE", "YELLOW", "GREEN")
ACTIONS = ("AUTO_FIX", "NEEDS_REVIEW", "PASS")

#: Kinds that rows are stored as: ``as_json`` and ``from_json`` turn a struct of such fields into JSON and back.
KINDS = {"span": SPAN, "candidate": CANDIDATE, "issue": f"STRUCT<{ISSUE_FIELDS}>", "output": f"STRUCT<{OUTPUT}>", "resolution": f"STRUCT<{RESOLUTION}>"}


def as_json(value: Column) -> Column:
    """A struct as JSON, null fields included."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def from_json(text: Column, kind: str) -> Column:
    """A struct of a kind back from JSON; a damaged text gives null fields, a null one null."""
    return F.from_json(text, KINDS[kind])
