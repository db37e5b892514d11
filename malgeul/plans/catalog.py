"""Registered queries, one or more for each operator, over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from malgeul.functions import decide, normalize as norm, numbers, spans as sp
from malgeul.functions.textexpr import collapse, match_offsets, overlaps
from malgeul.operators import correct as fix, evaluate, review, segments as seg, triage as tri
from malgeul.plans import label as labels_plan
from malgeul.plans.providers import table_provider
from malgeul.plans.views import edited, fix_candidates, korean_numbers, segments, table, utterances
from malgeul.schemas import CANDIDATE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def scratch(spark: SparkSession, name: str) -> str:
    """A folder that driver and executors share, for queries that write and read files."""
    import re
    import tempfile

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp()
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return f"{path}/data"


# ---- flagship and whole plans ----


@query
def e1_correct(spark, sf):
    """Decisions over a batch of utterances with candidates from a table."""
    docs = utterances(spark, sf)
    asked = fix.requests(fix.records(docs), 0)
    cands = asked.select("utt_id", "span_start", "span_end", F.array(F.struct(F.concat("span", F.when(F.col("span_start") % 2 == 0, "").otherwise("x")).alias("text"), F.lit(0.9).alias("score"))).alias("candidates"))
    made = fix.decisions(docs, table_provider(cands))
    return made.select("utt_id", "bucket", "decision", "text_avail", "n_issues", "audit.spans_detected", "audit.auto_fixed")


@query
def e1_decision_counts(spark, sf):
    return fix.distributions(fix.decisions(utterances(spark, sf)))


@query
def e2_label_pipeline(spark, sf):
    rows = labels_plan.results(seg.mean_utterances(segments(spark, sf)))
    return rows.select("sample_id", "bucket", "reason", "metrics.text_length", "metrics.has_repetition", F.round("metrics.avg_logprob", 9).alias("avg_logprob"))


@query
def e2_normalized(spark, sf):
    return labels_plan.label(segments(spark, sf)).select("sample_id", "bucket", "text_normalized")


# ---- sources and sinks ----


@query
def s3_get_split(spark, sf):
    from malgeul.sources.io import get_split

    return get_split(table(spark, sf, "documents").withColumnRenamed("lang", "split"), "fr").select("doc_id", "split", "source")


@query
def s2_dataset_round_trip(spark, sf):
    from malgeul.sources.io import load_dataset, save_dataset

    path = scratch(spark, "dataset")
    save_dataset(table(spark, sf, "documents").withColumnRenamed("lang", "split"), path)
    return load_dataset(spark, path).groupBy("split").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query
def s6_jsonl_scan(spark, sf):
    from malgeul import schemas
    from malgeul.sources.io import read_jsonl

    path = scratch(spark, "asr")
    utterances(spark, sf).drop("doc_id").write.json(path)
    return read_jsonl(spark, path, schemas.ASR).select("utt_id", "speaker_id", "sentence_id", F.length("text_raw").alias("chars"), "avg_logprob", "duration")


@query
def s7_done_ids(spark, sf):
    from malgeul.sources.io import read_done

    path = scratch(spark, "done")
    lines = table(spark, sf, "labels").select(F.when(F.col("doc_id") % 5 == 0, "{broken").when(F.col("doc_id") % 5 == 1, "{}").otherwise(F.format_string('{"utt_id": "%d"}', F.col("doc_id"))).alias("value"))
    lines.write.text(path)
    return read_done(spark, path)


@query
def s8_issue_round_trip(spark, sf):
    from malgeul.sources.io import read_issues, write_outputs

    made, path = fix.correct(utterances(spark, sf), texts=False), scratch(spark, "outputs")
    write_outputs(made, f"{path}/issues", f"{path}/available")
    return read_issues(spark, f"{path}/issues").groupBy("tag", "bucket").agg(F.count("*").alias("n"), F.sum("span_start").alias("starts"))


@query
def s9_results_round_trip(spark, sf):
    from malgeul.sources.io import read_results, write_results

    path = scratch(spark, "results")
    write_results(labels_plan.results(seg.mean_utterances(segments(spark, sf))), path)
    return read_results(spark, path).groupBy("bucket", "reason").agg(F.count("*").alias("n"), F.sum("metrics.text_length").alias("chars"))


@query
def s14_bucket_files(spark, sf):
    from malgeul.sources.io import read_written_buckets, write_buckets

    path = scratch(spark, "buckets")
    rows = _triaged(spark, sf).select(F.col("language").alias("split"), "speaker_id", "sentence_id", "text_raw", "bucket", "reason", "duration", "avg_logprob")
    write_buckets(rows, path)
    return review.bucket_counts(review.merge_buckets([read_written_buckets(spark, path)]))


@query
def k4_review_cells(spark, sf):
    rows = fix_candidates(spark, sf)
    return rows.select("id", decide.review_cell(F.col("candidates"), 5).alias("cell"))


@query
def k5_final_texts(spark, sf):
    rows = edited(spark, sf)
    originals = review.original_texts(utterances(spark, sf).withColumn("line_no", F.lit(1)))
    return review.final_texts(review.resolutions(rows), originals).select("utt_id", "text_avail", "resolved_from", F.col("resolution_count").cast("long").alias("resolution_count"))


@query
def k7_shards(spark, sf):
    return table(spark, sf, "orders").groupBy(seg.shard_of(F.col("o_orderkey")).alias("shard")).agg(F.count("*").alias("n"))


@query
def k8_shard_merge(spark, sf):
    from malgeul.sources.io import merge_shards, write_shards

    path = scratch(spark, "shards")
    rows = table(spark, sf, "part").select(F.col("p_partkey").cast("int").alias("idx"), F.col("p_brand").alias("speaker_id"), F.col("p_retailprice").alias("duration"))
    write_shards(rows, path)
    write_shards(rows, path)  # adds nothing
    return merge_shards(spark, path).select("idx", "speaker_id", "duration")


# ---- projections and predicates ----


@query
def f1_utterance_ids(spark, sf):
    d = F.col("doc_id")
    return table(spark, sf, "documents").select("doc_id", seg.utterance_id(F.col("source"), d).alias("utt_id"), seg.default_speaker(d).alias("speaker_id"), seg.default_sentence(d).alias("sentence_id"))


@query
def f2_records(spark, sf):
    rows = utterances(spark, sf).withColumn("utt_id", F.when(F.col("doc_id") % 2 == 0, F.col("utt_id"))).withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.lit("given")))
    return fix.records(rows).select("utt_id", "speaker_id", "sentence_id", F.length("text_raw").alias("chars"), "meta.duration", "meta.language")


@query
def f3_with_audio(spark, sf):
    from malgeul.sources.io import with_audio

    rows = table(spark, sf, "embeddings").withColumn("audio", F.when(F.col("vec_id") % 4 != 0, F.col("embedding")))
    return with_audio(rows, "audio").select("vec_id", "label")


@query
def f4_error_rows(spark, sf):
    rows = seg.mean_utterances(segments(spark, sf)).withColumn("error", F.when(F.col("utt_id").cast("int") % 7 == 0, "no audio"))
    return labels_plan.results(rows).select("sample_id", F.when(F.col("text_raw") == "[ERROR]", "[ERROR]").otherwise("ok").alias("state"), "metrics.error", (F.col("reason") == "processing_error").alias("failed"))


@query
def f5_triage_features(spark, sf):
    rows = table(spark, sf, "documents")
    return rows.select("doc_id", *(c.cast("boolean" if n == "has_digit" else "long").alias(n) for n, c in tri.triage_features(F.col("text")).items()))


@query
def f6_text_flags(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *(c.alias(n) for n, c in norm.text_flags(F.col("text")).items()))


@query
def f7_normalization_source(spark, sf):
    d = F.col("doc_id")
    verified = F.when(d % 4 == 0, F.col("lang")).when(d % 4 == 1, "").when(d % 4 == 2, "[ERROR]")
    return table(spark, sf, "documents").select("doc_id", labels_plan.normalization_source(verified, F.when(d % 3 == 0, "").otherwise(F.col("source"))).alias("src"))


@query
def f8_verified_rename(spark, sf):
    return review.merge_buckets([_triaged(spark, sf).select("speaker_id", "sentence_id", "text_raw", "bucket")]).select("speaker_id", "sentence_id", F.length("text_verified").alias("chars"))


@query
def f10_resolutions(spark, sf):
    return review.resolutions(edited(spark, sf)).select("row_no", "utt_id", "span_start", "span_end", "raw_span", "final_text", "was_modified")


@query
def f11_marker_escape(spark, sf):
    return table(spark, sf, "part").select("p_partkey", decide.mark_safe(decide.mark(F.col("p_brand"), F.col("p_name"), F.lit("⟦x⟧"))).alias("marked"))


@query
def f12_context(spark, sf):
    start = (F.col("doc_id") % 50).cast("int")
    rows = table(spark, sf, "documents")
    return rows.select("doc_id", sp.left_context(F.col("text"), start, 40).alias("left"), sp.right_context(F.col("text"), start + 5, 40).alias("right"))


# ---- joins and aggregates ----


@query
def j1_resume(spark, sf):
    done = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id").select(seg.utterance_id(F.col("source"), F.col("doc_id")).alias("utt_id"))
    return seg.not_done(utterances(spark, sf), done).select("utt_id", "duration")


@query
def j2_original_texts(spark, sf):
    rows = segments(spark, sf).select(F.col("utt_id"), F.col("seg_no").alias("line_no"), F.col("text").alias("text_raw"))
    return review.original_texts(rows)


@query
def j5_overlaps(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("no"), F.col("l_quantity").cast("int").alias("start"), (F.col("l_quantity") + F.col("l_linenumber") * 3).cast("int").alias("end"))
    taken = rows.groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("no") > 1, F.struct("start", "end"))).alias("taken"), F.min(F.struct("no", "start", "end")).alias("one"))
    return taken.select("l_orderkey", overlaps(F.col("taken"), F.col("one.start"), F.col("one.end")).alias("hit"))


@query
def j6_match_levels(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", *(c.alias(n) for n, c in evaluate.matches(F.regexp_replace("text", "[.,]", " "), F.col("text")).items()))
    return rows


def _triaged(spark, sf):
    rows = utterances(spark, sf)
    return rows.select("*", tri.triage(F.col("text_raw"), F.col("avg_logprob"), F.col("compression_ratio")).alias("t")).select("*", "t.bucket", "t.reason", "t.text_length", "t.has_repetition").drop("t")


@query
def t1_triage(spark, sf):
    return _triaged(spark, sf).select("utt_id", "bucket", "reason", "text_length", "has_repetition")


@query
def a1_bucket_statistics(spark, sf):
    return tri.bucket_statistics(_triaged(spark, sf))


@query
def a2_summary(spark, sf):
    return tri.summary_lines(tri.bucket_statistics(_triaged(spark, sf)))


@query
def a3_percentile_thresholds(spark, sf):
    return tri.percentile_thresholds(utterances(spark, sf).withColumnRenamed("avg_logprob", "logprob"))


@query
def w1_percentile_buckets(spark, sf):
    return tri.percentile_buckets(utterances(spark, sf).withColumnRenamed("avg_logprob", "logprob")).select("utt_id", "bucket")


@query
def w1_risk_buckets(spark, sf):
    """Utterances without scores: their risky spans stand in."""
    rows = utterances(spark, sf).withColumn("avg_logprob", F.when(F.col("doc_id") % 2 == 0, F.col("avg_logprob")))
    return tri.percentile_buckets(tri.with_logprob(rows)).select("utt_id", "bucket", "logprob")


@query
def a5_weighted_means(spark, sf):
    rows = seg.weighted_utterances(segments(spark, sf), table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("utt_id")))
    return rows.select("utt_id", F.length("text_raw").alias("chars"), *(F.round(c, 9).alias(c) for c in ("avg_logprob", "avg_no_speech_prob", "compression_ratio")), "temperature_fallback")


@query
def a6_plain_means(spark, sf):
    return seg.mean_utterances(segments(spark, sf)).select("utt_id", "text", *(F.round(c, 9).alias(c) for c in ("avg_logprob", "compression_ratio")))


def _predicted(spark, sf):
    d = F.col("doc_id")
    pred = F.when(d % 4 == 0, F.col("text")).when(d % 4 == 1, F.replace("text", F.lit("."), F.lit(""))).when(d % 4 == 2, F.replace("text", F.lit(" "), F.lit("")))
    return table(spark, sf, "documents").select(d.alias("i"), F.col("text").alias("raw"), pred.alias("pred"), F.col("text").alias("gold"))


@query
def a7_accuracy(spark, sf):
    return evaluate.accuracy(_predicted(spark, sf))


@query
def l8_mismatches(spark, sf):
    return evaluate.mismatches(_predicted(spark, sf)).select("i", F.length("pred").alias("pred_chars"), F.length("gold").alias("gold_chars"))


@query
def a8_resolution_groups(spark, sf):
    rows = review.resolutions(edited(spark, sf))
    own = F.array_sort(F.collect_list(F.struct("row_no", "final_text")))
    return rows.groupBy("utt_id").agg(F.array_join(F.transform(own, lambda r: r["final_text"]), "|").alias("texts"), F.count("*").alias("n"))


@query
def a9_hours(spark, sf):
    return seg.hours(utterances(spark, sf), "language").withColumn("hours", F.round("hours", 9))


@query
def a9_real_time_factor(spark, sf):
    rows = utterances(spark, sf).withColumn("wall_seconds", F.col("compression_ratio"))
    return seg.real_time_factor(rows).select(F.round("rtf", 9).alias("rtf"))


@query
def a10_describe(spark, sf):
    made = seg.describe(utterances(spark, sf), ["avg_logprob", "compression_ratio", "duration"])
    return made.select("metric", *(F.round(c, 6).alias(c) for c in made.columns[1:]))


@query
def a10_value_counts(spark, sf):
    rows = utterances(spark, sf)
    return rows.groupBy("language").agg(F.count("*").alias("n"), F.count_if(F.col("avg_logprob") < -0.7).alias("low"), F.count_if(F.col("compression_ratio") > 4.0).alias("high"))


@query
def a11_bucket_counts(spark, sf):
    rows = _triaged(spark, sf).withColumn("bucket", F.when(F.col("doc_id") % 10 != 0, F.col("bucket")))
    return review.bucket_counts(rows)


@query
def a12_shard_counts(spark, sf):
    return utterances(spark, sf).groupBy("language").agg(F.count("*").alias("n"), (F.count("*") == 100).alias("expected"))


@query
def a13_risk_scores(spark, sf):
    """Pages' addresses: one span of the whole address."""
    return table(spark, sf, "pages").select("page_id", sp.risk_score(sp.find_spans(F.col("url"), 0)).alias("risk"))


@query
def w2_equal_words(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", tri.has_repetition(F.col("text")).alias("repeated"))
    return rows


# ---- numbers and normalisation ----


def _keys(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") * F.lit(7919) * F.lit(104729) % F.lit(10**15)).cast("long").alias("n"))


@query
def n1_digit_words(spark, sf):
    return table(spark, sf, "part").select("p_partkey", numbers.read_each_digit(F.col("p_partkey").cast("string")).alias("said"))


@query
def n2_sino_under_100(spark, sf):
    return table(spark, sf, "part").select("p_partkey", numbers.sino_under_100((F.col("p_partkey") % 100).cast("int")).alias("said"))


@query
def n3_sino_under_10000(spark, sf):
    return table(spark, sf, "part").select("p_partkey", numbers.sino_under_10000((F.col("p_partkey") * 37 % 10000).cast("int")).alias("said"))


@query
def n4_sino(spark, sf):
    return _keys(spark, sf).select("id", numbers.read_sino(F.col("n")).alias("said"))


@query
def n5_native(spark, sf):
    return table(spark, sf, "part").select("p_partkey", numbers.read_native(F.col("p_partkey") % 120).alias("said"))


@query
def n7_hours(spark, sf):
    return table(spark, sf, "part").select("p_partkey", numbers.read_hour(F.col("p_partkey") % 25).alias("said"))


@query
def z1_symbols(spark, sf):
    return table(spark, sf, "part").select("p_partkey", norm.symbols(F.concat("p_size", F.lit("℃ "), "p_size", F.lit("% 5° ㎞"))).alias("said"))


@query
def z2_letters(spark, sf):
    return table(spark, sf, "part").select("p_partkey", norm.letters(F.concat(F.lit("5km "), "p_type")).alias("said"))


@query
def z3_ssi(spark, sf):
    return table(spark, sf, "part").select("p_partkey", norm.ssi(F.concat(F.lit("김철수씨가 "), "p_size", F.lit("씨앗 박씨"))).alias("said"))


@query
def z4_covid(spark, sf):
    return table(spark, sf, "part").select("p_partkey", norm.covid(F.concat(F.lit("코로나 19 covid–19 코로나19가 "), "p_size")).alias("said"))


@query
def z_number_units(spark, sf):
    """Decimals, units, hours, machines, ten-thousands and bare numbers in whole texts."""
    return korean_numbers(spark, sf).select("id", "kind", norm.normalize(F.col("text")).alias("said"))


@query
def z6_approximate(spark, sf):
    return table(spark, sf, "part").select("p_partkey", norm.approximations(F.concat("p_size", F.lit("만여 명이"))).alias("said"))


@query
def z9_special_counters(spark, sf):
    return table(spark, sf, "part").select("p_partkey", norm.special_counters(F.concat(F.lit("형사 "), "p_size", F.lit("부의 제"), "p_size", F.lit("회"))).alias("said"))


@query
def z12_punctuation(spark, sf):
    return table(spark, sf, "documents").select("doc_id", norm.punctuation(F.col("text")).alias("bare"))


@query
def z13_compounds(spark, sf):
    stem = F.get(F.array(*map(F.lit, ["국민체육공원에서", "자작나무숲은", "대통령배", "두배", "빈차", "마을버스운송사업조합이", "잣나무숲", "사과나무"])), (F.col("p_partkey") % 8).cast("int"))
    return table(spark, sf, "part").select("p_partkey", norm.compounds(F.concat("p_brand", F.lit(" "), stem)).alias("spaced"))


@query
def z14_particles(spark, sf):
    return table(spark, sf, "part").select("p_partkey", norm.join_particles(F.concat("p_name", F.lit(" 을 보고 "), "p_size", F.lit(" 에서 는"))).alias("joined"))


@query
def z15_glue(spark, sf):
    return table(spark, sf, "part").select("p_partkey", norm.restore_spaces(norm.glue(F.concat("p_name", F.lit("  이 번 저 번␣"), "p_size"))).alias("glued"))


@query
def y3_normalized_text(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("idx"), F.when(F.col("doc_id") % 5 != 0, F.col("text")).alias("text"))
    return rows.select("idx", collapse(F.col("text")).alias("normalized_text"))


# ---- spans ----


@query
def p1_find_spans(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.inline(sp.find_spans(F.col("text"), 0)))
    return rows.select("doc_id", "start", "end", "text", "tag")


@query
def p2_addresses(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.inline(sp.addresses(F.col("url"))))
    return rows.select("page_id", "start", "end", "text")


@query
def p3_latin_runs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.size(match_offsets(F.col("text"), sp.LATIN)).cast("long").alias("runs"), F.size(match_offsets(F.col("text"), sp.ALPHANUMERIC)).cast("long").alias("mixed"))


@query
def p4_digit_runs(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", match_offsets(F.col("text"), sp.DIGIT_RUN).alias("m"))
    return rows.select("doc_id", F.size("m").cast("long").alias("runs"), F.array_join(F.transform("m", lambda m: m["text"]), " ").alias("texts"))


@query
def p5_number_context(spark, sf):
    texts = F.get(F.array(*map(F.lit, ["이십명", "삼십 명", "비밀번호는 일이삼", "번호 없이 일이", "백만 원", "사오육"])), (F.col("p_partkey") % 6).cast("int"))
    return table(spark, sf, "part").select("p_partkey", F.transform(sp.hangul_numbers(texts), lambda s: s["text"]).alias("found"))


# ---- decisions ----


@query
def d1_edit_ratio(spark, sf):
    return table(spark, sf, "part").select("p_partkey", decide.edit_ratio(F.col("p_name"), F.col("p_type")).alias("ratio"))


@query
def d2_margin(spark, sf):
    return fix_candidates(spark, sf).select("id", F.round(decide.margin(F.col("candidates")), 9).alias("margin"))


@query
def d3_mixed_script(spark, sf):
    text = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, "가").otherwise(""))
    return table(spark, sf, "part").select("p_partkey", decide.mixed_script(text).alias("mixed"))


@query
def d4_only_symbols(spark, sf):
    text = F.get(F.array(F.lit(" .,! "), F.lit(""), F.lit("a."), F.lit("[x]"), F.lit("-_-")), (F.col("p_partkey") % 5).cast("int"))
    return table(spark, sf, "part").select("p_partkey", decide.only_symbols(text).alias("symbols"))


@query
def d5_span_actions(spark, sf):
    rows = fix_candidates(spark, sf)
    return rows.select("id", decide.span_action(F.col("tag"), F.col("bucket"), F.col("raw"), F.col("recommended"), decide.margin(F.col("candidates"))).alias("action"))


@query
def d6_sentence_actions(spark, sf):
    rows = fix_candidates(spark, sf)
    return rows.select("id", decide.sentence_action(F.col("bucket"), F.col("raw"), F.col("recommended"), F.col("tag") == "U1").alias("action"))


@query
def m1_prompts(spark, sf):
    rows = table(spark, sf, "part")
    own = [rows.select("p_partkey", F.lit(t).alias("task"), decide.prompt(t, F.col("p_brand"), F.col("p_name"), F.col("p_type")).alias("prompt")) for t in decide.TASKS]
    return own[0].unionByName(own[1]).unionByName(own[2])


@query
def m3_ranked(spark, sf):
    rows = fix_candidates(spark, sf).select("id", decide.ranked(F.concat("candidates", "candidates", decide.rank_scores(F.array("raw", "tag")))).alias("r"))
    return rows.select("id", F.array_join(F.transform("r", lambda c: c["text"]), "|").alias("texts"))


@query
def x3_apply_fixes(spark, sf):
    """Two fixes of each text, of which the first may overlap the second."""
    at = (F.col("p_partkey") % 5).cast("int")
    one = lambda start, end, new: F.struct(start.alias("start"), end.alias("end"), F.lit(new).alias("new"))
    fixes = F.array(one(at, at + 3, "<A>"), one(F.lit(3), F.lit(5), "<B>"))
    return table(spark, sf, "part").select("p_partkey", decide.apply_fixes(F.col("p_type"), fixes).alias("fixed"))


@query
def x4_apply_resolutions(spark, sf):
    fixes = edited(spark, sf).select("utt_id", F.col("span_start").alias("start"), F.col("span_end").alias("end"), F.lit("<R>").alias("new"))
    return review.apply_resolutions(utterances(spark, sf).select("utt_id", "text_raw"), fixes).select("utt_id", "text_fixed")


@query
def x5_issues(spark, sf):
    made = fix.issues(utterances(spark, sf))
    return made.select("utt_id", "tag", "span_start", "span_end", "raw_span", "context_marked_safe", "recommended", "user_fix")


@query
def y1_json_round_trip(spark, sf):
    rows = fix_candidates(spark, sf)
    kind = f"struct<id:long,candidates:array<{CANDIDATE}>>"
    back = rows.select("id", F.from_json(F.to_json(F.struct("id", "candidates")), kind).alias("back"))
    return back.select("id", (F.col("back.id") == F.col("id")).alias("same"), F.size("back.candidates").cast("long").alias("n"))


# ---- sorts, limits, sets ----


@query
def l1_span_order(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("start"), (F.col("l_quantity") + F.col("l_linenumber")).cast("int").alias("end"))
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("start", F.desc("end"), "l_linenumber"))
    return rows.withColumn("place", place).select("l_orderkey", "l_linenumber", "place")


@query
def l2_recommended(spark, sf):
    rows = fix_candidates(spark, sf)
    return rows.select("id", F.coalesce(F.get(decide.ranked(F.col("candidates")), F.lit(0))["text"], F.col("raw")).alias("recommended"))


@query
def l5_merged_order(spark, sf):
    merged = review.merge_buckets([_triaged(spark, sf).filter(F.col("bucket") == b).select("speaker_id", "sentence_id", "text_raw", "bucket") for b in "ABC"])
    return merged.select("speaker_id", "sentence_id", "bucket")


@query
def l6_first_rows(spark, sf):
    return review.first_rows(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 200)


@query
def l7_longest_span(spark, sf):
    rows = edited(spark, sf).withColumn("span_end", F.col("span_end") + (F.col("row_no") % 2).cast("int"))
    return review.final_texts(review.resolutions(rows)).select("utt_id", "text_raw", "text_avail")


@query
def l9_sample(spark, sf):
    return review.sample_rows(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 10)


@query
def u1_union(spark, sf):
    parts = [_triaged(spark, sf).filter(F.col("bucket") == b).select("speaker_id", "sentence_id", "text_raw", "bucket") for b in "ABC"]
    return review.merge_buckets(parts).groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.length("text_verified")).alias("chars"))


@query
def u3_dedupe(spark, sf):
    return fix_candidates(spark, sf).select("id", F.inline(decide.ranked(F.col("candidates"))))


@query
def u4_difference(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id")


@query
def cer(spark, sf):
    """On ASCII names, where both engines count alike."""
    rows = table(spark, sf, "part").select(F.col("p_name").alias("pred"), F.col("p_type").alias("gold"))
    return evaluate.character_error_rate(rows).select(F.round("cer", 9).alias("cer"))
