"""Correcting a batch of utterances: spans, candidates, guarded decisions, fixes and issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from malgeul.functions.decide import Guards, apply_fixes, margin, mark, mark_safe, sentence_action, span_action
from malgeul.functions.spans import CONTEXT, with_spans
from malgeul.operators.segments import utterance_id
from malgeul.operators.triage import Percentiles, percentile_buckets, with_logprob
from malgeul.plans.providers import KEYS, Provider, unchanged
from malgeul.schemas import CANDIDATE

# Fixed value: what audits name as the version.
VERSION = "correct_model_v1"
#: Columns of available texts.
AVAILABLE = ("utt_id", "speaker_id", "sentence_id", "text_raw", "text_avail", "bucket", "decision")


def _column(rows: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)


def records(rows: DataFrame) -> DataFrame:
    """The fixed columns of recogniser output: text from ``text``, else ``text_raw``, else ''; ids by default from
    speaker and sentence; ``meta``."""
    speaker, sentence = (F.coalesce(_column(rows, c, "string"), F.lit("")) for c in ("speaker_id", "sentence_id"))
    meta = [("avg_logprob", "double"), ("compression_ratio", "double"), ("duration", "double"), ("language", "string")]
    return rows.select(
        F.coalesce(_column(rows, "utt_id", "string"), utterance_id(speaker, sentence)).alias("utt_id"),
        speaker.alias("speaker_id"),
        sentence.alias("sentence_id"),
        F.coalesce(_column(rows, "text", "string"), _column(rows, "text_raw", "string"), F.lit("")).alias("text_raw"),
        F.struct(*(_column(rows, c, k).alias(c) for c, k in meta)).alias("meta"),
    )


def bucketed(rows: DataFrame, percentiles: Percentiles = Percentiles()) -> DataFrame:
    own = with_logprob(rows.withColumn("avg_logprob", F.col("meta.avg_logprob")))
    return percentile_buckets(own, percentiles).drop("logprob", "avg_logprob")


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``row_key``, a digest of all columns: rows that share an id but not a text are told apart, and spans need not carry the text."""
    return rows.withColumn("row_key", F.md5(F.to_json(F.struct(*rows.columns))))


def _asked(rows: DataFrame, context: int | None) -> Column:
    """The spans of a row ``with_spans``, or the whole sentence (tag CANON) where there is none."""
    whole = {"start": F.lit(0), "end": F.length("text_raw"), "text": F.col("text_raw"), "tag": F.lit("CANON")}
    whole |= {"left": F.lit(""), "right": F.lit("")} if context is not None else {}
    whole["before"] = F.lit("")
    if "candidates" in rows.schema["spans"].dataType.elementType.names:
        whole["candidates"] = F.col("whole_candidates")
    return F.when(F.size("spans") > 0, F.col("spans")).otherwise(F.array(F.struct(*(c.alias(n) for n, c in whole.items()))))


def requests(rows: DataFrame, context: int = CONTEXT) -> DataFrame:
    """A row for each span, or one for the whole sentence (tag CANON) where there is none, without the text."""
    kept = [c for c in ("utt_id", "row_key", "bucket") if c in rows.columns]
    spans = with_spans(rows.select(*kept, "text_raw"), "text_raw", context)
    one = spans.select(*kept, F.size("spans").alias("n_spans"), F.explode(_asked(spans, context)).alias("span"))
    return one.select(
        *kept, "n_spans", F.col("span.start").alias("span_start"), F.col("span.end").alias("span_end"), F.col("span.text").alias("span"),
        F.col("span.tag").alias("tag"), F.col("span.left").alias("left"), F.col("span.right").alias("right"), task_of(F.col("span.tag")).alias("task"),
    )


def task_of(tag: Column) -> Column:
    return F.when(tag == "CANON", "STW_CANON").when(tag == "U1", "STW_URL").otherwise("STW_SPAN")


def decided(asked: DataFrame, provider: Provider = unchanged, guards: Guards = Guards()) -> DataFrame:
    """``asked`` with ``candidates, recommended, action``."""
    told = provider(asked)
    keys = [k for k in ("row_key", *KEYS) if k in asked.columns and k in told.columns]
    rows = told if set(asked.columns) <= set(told.columns) else asked.join(told, keys, "left")  # else spans would be looked for twice
    rows = rows.withColumn("recommended", recommendation(F.col("candidates"), F.col("span")))
    return rows.withColumn("action", action(F.col("tag"), F.col("bucket"), F.col("span"), F.col("recommended"), F.col("candidates"), guards))


def recommendation(candidates: Column, span: Column) -> Column:
    return F.coalesce(F.get(candidates, F.lit(0))["text"], span)


def action(tag: Column, bucket: Column, span: Column, recommended: Column, candidates: Column, guards: Guards) -> Column:
    # spans of a sentence without spans: no address is among them
    sentence = sentence_action(bucket, span, recommended, F.lit(False), guards)
    return F.when(tag == "CANON", sentence).otherwise(span_action(tag, bucket, span, recommended, F.coalesce(margin(candidates), F.lit(1.0)), guards))


def _by_row(rows: DataFrame, provider: Provider, context: int | None) -> DataFrame | None:
    """``rows`` with their spans and candidates in one array, if the provider can tell them for whole rows; so no span is shuffled by itself."""
    if hasattr(provider, "each"):
        return with_spans(rows, "text_raw", context)
    return provider.whole(rows, context) if getattr(provider, "whole", None) else None


def _own_candidates(spans: DataFrame, provider: Provider, span: Column) -> Column:
    return provider.each(span["text"]) if hasattr(provider, "each") else F.coalesce(span["candidates"], F.expr(f"cast(array() as array<{CANDIDATE}>)"))


def _decided_rows(spans: DataFrame, provider: Provider, guards: Guards, context: int | None) -> DataFrame:
    """Rows with ``own``, their decided spans by start, and ``found``, those that need review."""
    names = ["start", "end", "text", "tag", "before"] + (["left", "right"] if context is not None else [])

    def told(s: Column) -> Column:
        cands = _own_candidates(spans, provider, s)
        return F.struct(*(s[n].alias(n) for n in names), cands.alias("candidates"), recommendation(cands, s["text"]).alias("recommended"))

    def acted(s: Column) -> Column:
        way = action(s["tag"], F.col("bucket"), s["text"], s["recommended"], s["candidates"], guards)
        return F.struct(*(s[n].alias(n) for n in (*names, "candidates", "recommended")), way.alias("action"))

    made = spans.withColumn("own", F.transform(F.transform(_asked(spans, context), told), acted))
    return made.withColumn("found", F.filter("own", lambda s: s["action"] != "AUTO_FIX"))


def _audit(whole: Column, n_spans: Column, fixed: Column, k_candidates: int, context: int) -> Column:
    return F.struct(
        F.lit(VERSION).alias("pipeline_version"), F.when(whole, "STW_CANON").alias("mode"), F.when(~whole, F.lit(k_candidates)).alias("k_candidates"),
        F.when(~whole, F.lit(context)).alias("context_len"), F.when(~whole, n_spans).alias("spans_detected"), F.when(~whole, fixed).alias("auto_fixed"),
    )


def _marked(tag: Column, left: Column, span: Column, right: Column) -> Column:
    return F.when(tag == "CANON", F.concat(F.lit("⟦"), span, F.lit("⟧"))).otherwise(mark(left, span, right))


def _issue(x: dict[str, Column], texts: bool = True) -> list[Column]:
    own = ["utt_id", "speaker_id", "sentence_id", "bucket"]
    made = {
        "tag": x["tag"], "span_start": x["span_start"], "span_end": x["span_end"], "raw_span": x["span"], "context_full": F.col("text_raw") if texts else F.lit(None).cast("string"), "context_marked": x["marked"],
        "context_marked_safe": mark_safe(x["marked"]), "candidates": x["candidates"], "recommended": x["recommended"], "user_fix": x["recommended"], "meta": F.col("meta"),
    }
    return [*map(F.col, own), *(c.alias(n) for n, c in made.items())]


def _fixed_text() -> Column:
    """The text with all ``own`` spans rewritten; spans do not overlap, so it is put together from left to right."""
    same = ~F.exists("own", lambda s: s["recommended"] != s["text"])
    return F.when(same, F.col("text_raw")).otherwise(F.concat(F.array_join(F.transform("own", lambda s: F.concat(s["before"], s["recommended"])), ""), F.when(F.size("spans") > 0, F.col("tail")).otherwise("")))


def _row_columns(k_candidates: int, context: int) -> tuple[list[Column], Column]:
    clear = F.size("found") == 0
    return [
        *map(F.col, ("utt_id", "speaker_id", "sentence_id", "text_raw", "bucket")), F.when(clear, "AUTO_FIX").otherwise("NEEDS_REVIEW").alias("decision"),
        F.when(clear, _fixed_text()).alias("text_avail"),
    ], _audit(F.size("spans") == 0, F.size("spans"), F.size("own") - F.size("found"), k_candidates, context).alias("audit")


def outputs(rows: DataFrame, base: DataFrame, k_candidates: int = 5, context: int = CONTEXT, texts: bool = True) -> DataFrame:
    """A row for each of ``base``: decision, text_avail (null if anything needs review), issues and audit, from its decided ``rows``."""
    marked = _marked(F.col("tag"), F.col("left"), F.col("span"), F.col("right"))
    fixed = F.col("action") == "AUTO_FIX"
    own = F.struct("span_start", "span_end", "tag", "span", marked.alias("marked"), "candidates", "recommended")
    gathered = rows.groupBy("row_key").agg(
        F.collect_list(F.when(~fixed, own)).alias("found"),
        F.collect_list(F.when(fixed, F.struct(F.col("span_start").alias("start"), F.col("span_end").alias("end"), F.col("recommended").alias("new")))).alias("fixes"),
        F.max("n_spans").alias("n_spans"),
    )
    met = base.join(gathered, "row_key")
    whole, clear = F.col("n_spans") == 0, F.size("found") == 0
    audit = _audit(whole, F.col("n_spans"), F.size("fixes"), k_candidates, context)
    by_place = lambda a, b: F.when(a["span_start"] != b["span_start"], a["span_start"] - b["span_start"]).otherwise(b["span_end"] - a["span_end"])
    issue = lambda x: F.struct(*_issue({n: x[n] for n in ("tag", "span_start", "span_end", "span", "marked", "candidates", "recommended")}, texts))
    return met.select(
        "utt_id", "speaker_id", "sentence_id", "text_raw", "bucket", F.when(clear, "AUTO_FIX").otherwise("NEEDS_REVIEW").alias("decision"),
        F.when(clear, apply_fixes(F.col("text_raw"), F.col("fixes"))).alias("text_avail"),
        F.transform(F.array_sort("found", by_place), issue).alias("issues"), audit.alias("audit"),
    )


def correct(rows: DataFrame, provider: Provider = unchanged, guards: Guards = Guards(), percentiles: Percentiles = Percentiles(), k_candidates: int = 5, context: int = CONTEXT, texts: bool = True) -> DataFrame:
    """Recogniser rows to outputs, one for each row.  With a provider that must see each request by itself, equal rows are decided once.
    Without ``texts`` the issues have a null ``context_full``: a row with many issues would else hold its text once for each."""
    base = bucketed(records(rows), percentiles)
    spans = _by_row(base, provider, context)
    if spans is None:
        base = keyed(base)
        return outputs(decided(requests(base.dropDuplicates(["row_key"]), context), provider, guards), base, k_candidates, context, texts)

    def issue(s: Column) -> Column:
        return F.struct(*_issue({"tag": s["tag"], "span_start": s["start"], "span_end": s["end"], "span": s["text"], "marked": _marked(s["tag"], s["left"], s["text"], s["right"]), "candidates": s["candidates"], "recommended": s["recommended"]}, texts))

    own, audit = _row_columns(k_candidates, context)
    return _decided_rows(spans, provider, guards, context).select(*own, F.transform("found", issue).alias("issues"), audit)


def decisions(rows: DataFrame, provider: Provider = unchanged, guards: Guards = Guards(), percentiles: Percentiles = Percentiles(), k_candidates: int = 5, context: int = CONTEXT) -> DataFrame:
    """As ``correct``, with the number of issues, ``n_issues``, in place of the issues: their contexts are not made."""
    spans = _by_row(bucketed(records(rows), percentiles), provider, None)
    if spans is None:
        made = correct(rows, provider, guards, percentiles, k_candidates, context)
        return made.select(*(F.size("issues").alias("n_issues") if c == "issues" else c for c in made.columns))
    own, audit = _row_columns(k_candidates, context)
    return _decided_rows(spans, provider, guards, None).select(*own, F.size("found").alias("n_issues"), audit)


def issues(rows: DataFrame, provider: Provider = unchanged, guards: Guards = Guards(), percentiles: Percentiles = Percentiles(), context: int = CONTEXT) -> DataFrame:
    """The issues alone, as ``issues_of(correct(...))``: spans are decided one by one and never gathered again."""
    spans = _by_row(bucketed(records(rows), percentiles), provider, context)
    if spans is None:
        return issues_of(correct(rows, provider, guards, percentiles, context=context))
    kept = ["utt_id", "speaker_id", "sentence_id", "bucket", "text_raw", "meta"]
    one = spans.select(*kept, F.explode(_asked(spans, context)).alias("s"))
    one = one.select(*kept, "s", _own_candidates(spans, provider, F.col("s")).alias("candidates"))
    s = lambda n: F.col(f"s.{n}")
    one = one.withColumn("recommended", recommendation(F.col("candidates"), s("text")))
    one = one.filter(action(s("tag"), F.col("bucket"), s("text"), F.col("recommended"), F.col("candidates"), guards) != "AUTO_FIX")
    one = one.select(*kept, *(s(n).alias(o) for n, o in (("tag", "tag"), ("start", "span_start"), ("end", "span_end"), ("text", "span"))), _marked(s("tag"), s("left"), s("text"), s("right")).alias("marked"), "candidates", "recommended")
    return one.select(*_issue({n: F.col(n) for n in ("tag", "span_start", "span_end", "span", "marked", "candidates", "recommended")}))


def issues_of(made: DataFrame) -> DataFrame:
    return made.select(F.inline("issues"))


def available(made: DataFrame) -> DataFrame:
    return made.filter("text_avail is not null").select(*AVAILABLE)


def distributions(made: DataFrame) -> DataFrame:
    """``kind, name, n`` of buckets and decisions, and the numbers of issues, available texts and reviews, of outputs or ``decisions``."""
    n_issues = F.col("n_issues") if "n_issues" in made.columns else F.size("issues")
    counts = made.groupBy("bucket", "decision").agg(F.count("*").alias("n"), F.sum(n_issues).alias("issues"), F.count("text_avail").alias("available"))
    row = lambda kind, name, n: F.struct(F.lit(kind).alias("kind"), name.alias("name"), n.cast("long").alias("n"))
    total = lambda name, n: row("total", F.lit(name), n)
    review = F.when(F.col("decision") == "NEEDS_REVIEW", F.col("n")).otherwise(0)
    each = F.array(row("bucket", F.col("bucket"), F.col("n")), row("decision", F.col("decision"), F.col("n")), total("issues", F.col("issues")), total("available", F.col("available")), total("review", review))
    none = made.sparkSession.range(1).select(F.inline(F.array(*(total(name, F.lit(0)) for name in ("issues", "available", "review")))))
    return counts.select(F.inline(each)).unionByName(none).groupBy("kind", "name").agg(F.sum("n").alias("n"))
