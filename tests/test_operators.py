"""Operators over tables, file round trips, providers, the review loop and streams."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from malgeul import schemas
from malgeul.__main__ import main
from malgeul.operators import correct as fix, evaluate, review, segments as seg, triage
from malgeul.plans import label as labels_plan
from malgeul.plans.providers import model_provider, recognizer, table_provider, unchanged
from malgeul.sources import io, xlsx
from malgeul.streaming.incremental import correct_stream, read_transcripts, triaged

ASR = "utt_id string, speaker_id string, sentence_id string, text_raw string, avg_logprob double, compression_ratio double, duration double, language string"


def asr(spark, rows):
    return spark.createDataFrame([(u, "s", u, t, lp, 1.5, 2.0, "ko") for u, t, lp in rows], ASR)


TEXTS = [("a", "COVID19 확진자 1234명", -0.1), ("b", "안녕하세요", -0.1), ("c", "www.naver.com 접속", -0.2), ("d", "금액은 98765 입니다", -0.01), ("e", "", -0.3), ("f", "다른 말", -5.0)]


def test_correct_batch(spark):
    rows = asr(spark, [*TEXTS, *((f"x{i}", "그냥 말", -1.0 - i) for i in range(20))])
    cands = spark.createDataFrame([("a", 0, 7, [("코로나19", 0.9), ("x", 0.1)]), ("d", 4, 9, [("98766", 0.9), ("x", 0.1)]), ("b", 0, 5, [("안녕하세요", 0.9)])], f"utt_id string, span_start int, span_end int, candidates array<{schemas.CANDIDATE}>")
    made = {r["utt_id"]: r for r in fix.correct(rows, table_provider(cands)).collect()}
    assert len(made) == 26
    assert all((r["text_avail"] is None) == (r["decision"] == "NEEDS_REVIEW") and bool(r["issues"]) == (r["decision"] == "NEEDS_REVIEW") for r in made.values())
    assert made["d"]["text_avail"] == "금액은 98766 입니다" and made["d"]["audit"]["auto_fixed"] == 1 and made["d"]["audit"]["mode"] is None
    assert [i["tag"] for i in made["a"]["issues"]] == ["E2"]  # the number is unchanged and fixed by itself
    assert made["c"]["issues"][0]["context_marked_safe"] == "[[www.naver.com]] 접속" and made["c"]["issues"][0]["user_fix"] == "www.naver.com"
    assert made["b"]["decision"] == "AUTO_FIX" and made["b"]["audit"]["mode"] == "STW_CANON" and made["e"]["text_avail"] == ""
    counts = {(r["kind"], r["name"]): r["n"] for r in fix.distributions(fix.correct(rows)).collect()}
    assert counts["total", "available"] + counts["total", "review"] == 26 == sum(n for (k, _), n in counts.items() if k == "bucket")
    assert fix.correct(rows.limit(0)).count() == 0


def test_rows_that_share_an_id(spark):
    """Each row has its own candidates and output, also where ids or whole rows are repeated; the default provider changes nothing."""
    rows = [("a", "abc one 12 now", -0.1), ("a", "xyz two 12 now", -0.1), ("b", "same 12345", -0.2), ("b", "same 12345", -0.2), ("c", "금\x01\x02 98765 원", -0.1)]
    frame = asr(spark, [*rows, *((f"x{i}", "그냥 말", -1.0 - i) for i in range(20))])
    made = [r for r in fix.correct(frame).collect() if r["utt_id"] in "abc"]
    assert sorted((r["utt_id"], r["text_raw"], r["decision"], len(r["issues"])) for r in made) == sorted((u, t, "AUTO_FIX", 0) for u, t, _ in rows)
    assert all(r["text_avail"] == r["text_raw"] for r in made)
    start = rows[-1][1].index("98765")
    cands = spark.createDataFrame([("c", start, start + 5, "98765", [("98766", 0.9), ("x", 0.1)]), ("a", 8, 10, "nothing", [("13", 0.9)])], f"utt_id string, span_start int, span_end int, span string, candidates array<{schemas.CANDIDATE}>")
    told = {r["utt_id"]: r["text_avail"] for r in fix.correct(frame, table_provider(cands)).collect()}
    assert told["c"] == rows[-1][1].replace("98765", "98766") and told["b"] == "same 12345"


def test_recognizer(spark):
    def load():
        return lambda samples, rate: [{"text": f"{len(samples)}@{rate}", "start": 0.0, "end": 1.0, "avg_logprob": 1 / len(samples), "no_speech_prob": 0.0, "compression_ratio": 1.0, "temperature": 0.0}]

    rows = spark.createDataFrame([("a", [0.1, 0.2], 16000), ("b", None, 16000), ("c", [], 8000)], "utt_id string, samples array<float>, sampling_rate int")
    got = {r["utt_id"]: r for r in recognizer(load)(rows).collect()}
    assert got["a"]["text"] == "2@16000" and got["a"]["error"] is None and got["b"]["error"] == "no audio" and got["c"]["error"]
    whole = spark.createDataFrame([("a", "x", -0.1, 1.0, 2.0, None), ("b", "y", -0.1, 1.0, 2.0, "no")], "utt_id string, text string, avg_logprob double, compression_ratio double, duration double, error string")
    assert [tuple(r)[1:5] for r in labels_plan.transcription_errors(whole).orderBy("utt_id").collect()] == [("x", -0.1, 1.0, 2.0), ("[ERROR]", -1.0, 0.0, 0.0)]
    kept, failed = labels_plan.without_errors(whole)
    assert kept.count() == 1 and failed == 1


def test_unknown_buckets_and_numbers(spark):
    rows = spark.createDataFrame([("A",), ("X",)], "bucket string")
    assert triage.bucket_statistics(rows).first()["total"] == 2
    with pytest.raises(Exception, match="unknown bucket: X"):
        triage.bucket_statistics(rows, strict=True).collect()
    values = [i * 7919 % 1000 for i in range(1000)]
    made = review.numbered(spark.createDataFrame([(v,) for v in values], "v int").repartition(5), ["v"]).collect()
    assert sorted((r["v"], r["row_no"]) for r in made) == [(v, v + 1) for v in range(1000)] and review.numbered(rows.limit(0), ["bucket"]).count() == 0
    fixes = spark.createDataFrame([("a", 0, 1, "z", 1), ("a", 0, 1, "b", 2)], "utt_id string, start int, end int, new string, place int")
    assert review.apply_resolutions(spark.createDataFrame([("a", "xy")], "utt_id string, text_raw string"), fixes).first()["text_fixed"] == "by"


def test_stored_kinds(spark):
    """Spans, issues, outputs and resolutions as JSON and back."""
    made = fix.correct(asr(spark, TEXTS)).select(F.struct("*").alias("v"))
    back = made.select("v", schemas.from_json(schemas.as_json(F.col("v")), "output").alias("b"))
    assert back.count() == 6 and back.filter(schemas.as_json(F.col("v")) != schemas.as_json(F.col("b"))).count() == 0
    issue = made.select(F.explode("v.issues").alias("v")).select("v", schemas.from_json(schemas.as_json(F.col("v")), "issue").alias("b"))
    assert issue.count() and issue.filter(schemas.as_json(F.col("v")) != schemas.as_json(F.col("b"))).count() == 0


def test_command_line(spark, tmp_path, capsys):
    path = lambda name: str(tmp_path / name)
    asr(spark, TEXTS).write.json(path("in"))
    main(["correct", path("in"), path("issues"), path("available")], spark)
    main(["export-review", path("issues"), path("book.xlsx")], spark)
    main(["import-review", path("book.xlsx"), path("done"), path("finals"), "--transcripts", path("in")], spark)
    main(["results", path("in"), "--output", path("out")], spark)
    told = capsys.readouterr().out.split("\n")
    assert told[0].endswith("texts") and told[1] == f"{spark.read.json(path('issues')).count()} rows" and io.read_results(spark, path("out")).count() == 6
    assert spark.read.json(path("out") + "/metadata").first()["total_count"] == 6


def test_records_defaults(spark):
    rows = spark.createDataFrame([("s", "1", None, "raw"), (None, None, "given", None)], "speaker_id string, sentence_id string, text string, text_raw string")
    got = [tuple(r)[:4] for r in fix.records(rows).collect()]
    assert got == [("s_1", "s", "1", "raw"), ("_", "", "", "given")]


def test_model_provider(spark):
    def load():
        return lambda frame: [[(t.upper(), 0.5), (t, 0.9), (t, 0.1)] for t in frame["span"]]

    asked = fix.requests(fix.bucketed(fix.records(asr(spark, TEXTS))))
    told = model_provider(load)(asked.select("utt_id", "span_start", "span_end", "task", "left", "span", "right")).collect()
    assert all(r["candidates"][0]["score"] == 0.9 for r in told) and len(told) == asked.count()


def test_segments(spark):
    rows = [("a", 1, " b ", 0.0, 3.0, -0.3, 0.1, 1.0, 0.0), ("a", 0, " a", 0.0, 1.0, -0.1, 0.5, 2.0, 0.2), ("z", 0, "x", 1.0, 1.0, -0.4, 0.2, 3.0, None)]
    segments = spark.createDataFrame(rows, "utt_id string, seg_no int, text string, start double, end double, avg_logprob double, no_speech_prob double, compression_ratio double, temperature double")
    got = {r["utt_id"]: r for r in seg.weighted_utterances(segments, spark.createDataFrame([("a",), ("n",), ("z",)], "utt_id string")).collect()}
    assert (got["a"]["text_raw"], got["a"]["avg_logprob"], got["a"]["temperature_fallback"]) == ("a b", pytest.approx(-0.25), True)
    assert tuple(got["n"])[1:] == ("", -1.0, 1.0, 0.0, False) and got["z"]["avg_logprob"] == -0.4
    plain = {r["utt_id"]: r for r in seg.mean_utterances(segments).collect()}
    assert plain["a"]["avg_logprob"] == pytest.approx(-0.2) and set(plain) == {"a", "z"}


def test_label_pipeline(spark):
    rows = spark.createDataFrame([("1", "3명", -0.1, 1.0, None), ("2", "x", -0.1, 1.0, "broken"), ("3", "", -0.1, 1.0, None)], "utt_id string, text string, avg_logprob double, compression_ratio double, error string")
    got = {r["sample_id"]: r for r in labels_plan.normalize_results(labels_plan.results(rows)).collect()}
    assert (got["1"]["bucket"], got["1"]["text_normalized"]) == ("A", "세 명")
    assert (got["2"]["text_raw"], got["2"]["bucket"], got["2"]["reason"], got["2"]["metrics"]["error"], got["2"]["text_normalized"]) == ("[ERROR]", "C", "processing_error", "broken", None)
    assert got["3"]["reason"] == "too_short" and got["3"]["text_normalized"] is None


def test_evaluation(spark):
    rows = spark.createDataFrame([(0, "a1", "가, 나", "가, 나"), (1, "b", "가 나", "가, 나"), (2, "!", "가나", "가 나"), (3, None, None, "x")], "i int, raw string, pred string, gold string")
    r = evaluate.accuracy(rows).first()
    assert (r["rows"], r["has_digit"], r["has_english"], r["has_symbol"]) == (4, 1, 2, 1)
    assert (r["match_strict"], r["match_punct"], r["match_punct_space"], r["match_no_space"]) == (1, 2, 2, 3) and r["ratio_strict"] == 0.25
    assert [x["i"] for x in evaluate.mismatches(rows, show=2).collect()] == [1, 2]
    assert evaluate.accuracy(rows.limit(0)).first()["ratio_strict"] is None and evaluate.character_error_rate(rows.limit(0)).first()[0] is None


def test_review_loop(spark, tmp_path):
    issues = fix.issues_of(fix.correct(asr(spark, TEXTS)))
    path = str(tmp_path / "review.xlsx")
    n = io.export_review(issues, path)
    assert n == issues.count() and io.export_review(issues.limit(0), str(tmp_path / "none.xlsx")) == 0 and not os.path.exists(tmp_path / "none.xlsx")
    edited = io.import_review(spark, path)
    assert edited.count() == n and set(schemas.REVIEW_COLUMNS) < set(edited.columns)
    done = review.resolutions(edited)
    finals = review.final_texts(done, review.original_texts(asr(spark, TEXTS).withColumn("line_no", F.lit(1))))
    assert not done.filter("was_modified").count()
    assert {r["utt_id"]: r["text_avail"] for r in finals.collect()} == {u: t for u, t, _ in TEXTS if u in {r["utt_id"] for r in issues.select("utt_id").collect()}}
    assert io.write_resolutions(done, finals, str(tmp_path / "r"), str(tmp_path / "f")) == (n, finals.count())
    assert xlsx.write(path, ["a", "b"], [("<x>&", 1.5), ("", 2), ("z", None)]) == 3
    assert list(xlsx.read(path)) == [{"a": "<x>&", "b": "1.5"}, {"a": "z", "b": None}]


def test_resolutions(spark):
    columns = "row_no int, utt_id string, speaker_id string, sentence_id string, span_start string, span_end string, raw_span string, recommended string, user_fix string"
    rows = [(2, "a", "s", "1", "0", "2", "ab", "R", "  "), (3, "b", "s", "2", "0", "2", None, "R", "R"), (4, "c", "s", "3", "3", "5", "de", "R", " X "), (5, "", "s", "4", "0", "1", "a", "R", "Q"), (6, None, "s", "4", "0", "1", "a", "R", "Q"), (7, "d", "s", "5", "0", "4", "abcd", None, None), (8, "d", "s", "5", "1", "3", "bc", "Y", "")]
    done = review.resolutions(spark.createDataFrame(rows, columns))
    got = {r["row_no"]: (r["final_text"], r["was_modified"], r["raw_span"]) for r in done.collect()}
    assert got == {2: ("R", False, "ab"), 3: ("R", False, "None"), 4: (" X ", True, "de"), 7: ("", False, "abcd"), 8: ("Y", False, "bc")}
    finals = {r["utt_id"]: (r["text_raw"], r["text_avail"], r["resolution_count"]) for r in review.final_texts(done).collect()}
    assert finals == {"a": ("ab", "R", 1), "b": ("None", "Rne", 1), "d": ("abcd", "", 2)}  # c cannot be restored; overlaps are not checked
    originals = review.original_texts(spark.createDataFrame([(1, "c", "old"), (2, "c", "abcdef")], "line_no int, utt_id string, text_raw string"))
    assert {r["utt_id"]: r["text_avail"] for r in review.final_texts(done, originals).collect()}["c"] == "abc X f"


def test_files(spark, tmp_path):
    rows = asr(spark, TEXTS)
    path = str(tmp_path / "asr")
    assert io.append_transcripts(rows.limit(4), path) == 4 and io.append_transcripts(rows, path) == 2 and io.append_transcripts(rows, path) == 0
    assert io.read_jsonl(spark, path, schemas.ASR).count() == 6 and io.append_transcripts(rows, path, resume=False) == 6
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"utt_id": "a"}\n\n{oops\n{"other": 1}\n{"utt_id": "a"}\n')
    assert [r[0] for r in io.read_done(spark, str(bad)).collect()] == ["a"] and io.read_done(spark, str(tmp_path / "missing")).count() == 0
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        io.read_jsonl(spark, str(bad), schemas.ASR).collect()
    made = fix.correct(rows)
    io.write_outputs(made, str(tmp_path / "issues"), str(tmp_path / "available"))
    assert io.read_issues(spark, str(tmp_path / "issues")).count() == fix.issues_of(made).count()
    assert spark.read.json(str(tmp_path / "available")).filter("text_avail is null").count() == 0
    results = labels_plan.results(rows.withColumn("text", F.col("text_raw")))
    io.write_results(results, str(tmp_path / "results"))
    io.write_results_document(results, str(tmp_path / "document"))
    for name in ("results", "document"):
        assert sorted(map(str, io.read_results(spark, str(tmp_path / name)).collect())) == sorted(map(str, results.collect()))
    assert io.read_bucket(spark, str(tmp_path / "missing.json")).count() == 0
    (tmp_path / "b.json").write_text(json.dumps([{"speaker_id": "s", "sentence_id": "2", "text_raw": "x", "bucket": "A"}, {"speaker_id": "s", "sentence_id": "1", "text_raw": "y"}]))
    files = io.read_buckets(spark, [str(tmp_path / "b.json"), str(tmp_path / "no.json")])
    edits = spark.createDataFrame([("s", "1", "changed")], "speaker_id string, sentence_id string, text string")
    assert [r["text_verified"] for r in review.merge_buckets(files, edits).collect()] == ["changed", "x"]
    assert {r["bucket"]: r["n"] for r in review.bucket_counts(files[0]).collect()} == {"A": 1, "unknown": 1}


def test_issue_files(spark, tmp_path):
    """A text is written once, not with each of its issues, and comes back whole; it is not joined where it is not used."""
    rows, path = asr(spark, [*TEXTS, ("again", TEXTS[0][1], TEXTS[0][2]), ("many", "ab 12 cd " * 30, TEXTS[0][2])]), str(tmp_path / "issues")
    made = fix.correct(rows)
    want = fix.issues_of(made)
    io.write_outputs(made, path, str(tmp_path / "available"))
    back = io.read_issues(spark, path)
    assert back.columns == want.columns and sorted(map(str, back.collect())) == sorted(map(str, want.collect()))
    assert "context_full" not in spark.read.json(path).columns
    counted = back.groupBy("tag", "bucket").agg(F.sum("span_start"))
    assert "Join" not in counted._jdf.queryExecution().optimizedPlan().toString()
    want.write.json(str(tmp_path / "whole"))
    assert sorted(map(str, io.read_issues(spark, str(tmp_path / "whole")).collect())) == sorted(map(str, want.collect()))


def test_issue_files_without_texts(spark, tmp_path, monkeypatch):
    """Rows on their way to files don't hold their text once for each issue, nothing is cached, and all comes back; a kind without rows is an empty file."""
    rows, path = asr(spark, [*TEXTS, ("long", "ab 12 cd " * 500, TEXTS[0][2])]), str(tmp_path / "issues")
    want = sorted(map(str, fix.issues_of(fix.correct(rows)).collect()))
    made = fix.correct(rows, texts=False)
    assert made.filter(F.exists("issues", lambda i: i["context_full"].isNotNull())).count() == 0
    monkeypatch.setattr(type(rows), "persist", None)
    for _ in range(2):  # the second time over the first
        io.write_outputs(made, path, str(tmp_path / "available"))
        assert sorted(map(str, io.read_issues(spark, path).collect())) == want
    assert sorted(map(str, spark.read.schema(schemas.TEXT_AVAIL).json(str(tmp_path / "available")).collect())) == sorted(map(str, fix.available(made).collect()))
    assert "context_marked_safe" not in spark.read.json(path).columns
    assert sorted(p.name for p in tmp_path.iterdir()) == ["available", "issues", "issues_texts"]
    io.write_outputs(made.filter("false"), path, str(tmp_path / "available"))
    assert io.read_issues(spark, path).count() == spark.read.json(path).count() == spark.read.json(str(tmp_path / "available")).count() == 0


def test_datasets(spark, tmp_path):
    path = str(tmp_path / "d")
    with pytest.raises(FileNotFoundError):
        io.load_dataset(spark, path)
    assert io.save_dataset(spark.createDataFrame([("train", 1), ("test", 2), ("train", 3)], "split string, x int"), path) == {"train": 2, "test": 1} and io.is_dataset_there(spark, path)
    rows = io.load_dataset(spark, path)
    assert io.get_split(rows, "test").count() == 1
    with pytest.raises(ValueError, match="test, train"):
        io.get_split(rows, "dev")


def test_audio_columns(spark):
    kind = "struct<array:array<float>,sampling_rate:int>"
    find = lambda ddl: io.acoustic_column(spark.createDataFrame([], ddl).schema)
    assert find(f"x int, audio {kind}, acoustic {kind}") == "acoustic" and find(f"x int, my_Acoustic_mic {kind}, other {kind}") == "my_Acoustic_mic" and find(f"x int, sound {kind}") == "sound"
    with pytest.raises(ValueError):
        find("x int")
    rows = spark.createDataFrame([(([1.0], 8000), (([2.0], None),), [3.0])], f"a {kind}, b struct<acoustic_microphone:{kind}>, c array<float>")
    assert [(io.audio_payload(rows, c).first()["samples"], io.audio_payload(rows, c).first()["sampling_rate"]) for c in "abc"] == [([1.0], 8000), ([2.0], 16000), ([3.0], 16000)]


def test_streams(spark, tmp_path):
    rows = asr(spark, TEXTS)
    for part in (rows.limit(3), rows.exceptAll(rows.limit(3))):
        part.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    correct_stream(read_transcripts(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    available, issues = (spark.read.json(str(tmp_path / "out" / k)).select("utt_id").distinct().count() for k in ("available", "issues"))
    assert available + issues == len(TEXTS)
    q = triaged(read_transcripts(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("triaged").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("triaged").groupBy("bucket").count().count() >= 2 and isinstance(spark.table("triaged").toPandas(), pd.DataFrame)


def test_rows_decided_whole(spark, monkeypatch):
    """Spans decided within their row, by a column or by packed entries, are as those decided one by one; they are not shuffled."""
    rows = [*TEXTS, ("g", "ab cd 12345 ef", -0.02), ("h", "ab cd 12345 ef", -0.02), ("g", "xy ab", -0.02), ("i", "tel 12345678 or me@b.net", -0.02), ("j", " ".join(f"word{chr(97 + i)}" for i in range(20)), -0.01)]
    frame = asr(spark, [*rows, *((f"x{i}", "그냥 말", -1.0 - i) for i in range(20))])
    entries = [("g", 0, 2, [("ac", 0.9)]), ("g", 6, 11, [("12346", 0.9), ("x", 0.1)]), ("g", 6, 11, [("12340", 0.9), ("x", 0.1)]), ("g", 6, 11, None), ("h", 12, 14, []), ("b", 0, 5, [("안녕하세오", 0.9)]), ("b", 0, 5, [(None, None)])]
    entries += [("i", 4, 12, [("12345679", float("nan")), ("1", 0.1)]), (None, 0, 1, [("q", 0.1)]), ("j", None, 5, [("q", 0.1)]), ("zz", 0, 1, [("q", 0.1)])]
    entries += [("j", 6 * i, 6 * i + 5, [(f"word{chr(97 + i)}", 0.9)]) for i in range(20)] * 2
    cands = spark.createDataFrame(entries, f"utt_id string, span_start int, span_end int, candidates array<{schemas.CANDIDATE}>")
    key = lambda made: sorted(str(r) for r in made.collect())
    for provider in (unchanged, table_provider(cands)):
        plain = lambda asked, p=provider: p(asked)  # noqa: E731  without what tells whole rows
        told = key(fix.correct(frame, plain))
        assert key(fix.correct(frame, provider)) == told and len(told) == 31
        assert key(fix.issues(frame, provider)) == key(fix.issues_of(fix.correct(frame, plain))) == key(fix.issues(frame, plain))
        few = [c for c in fix.decisions(frame, provider).columns if c != "n_issues"]
        made = fix.correct(frame, plain).select(*few, F.size("issues").alias("n_issues"))
        assert key(fix.decisions(frame, provider).select(*few, "n_issues")) == key(made) == key(fix.decisions(frame, plain).select(*few, "n_issues"))
        assert key(fix.distributions(fix.decisions(frame, provider))) == key(fix.distributions(fix.correct(frame, plain)))
    assert "Exchange hash" not in fix.issues(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in fix.decisions(frame)._jdf.queryExecution().executedPlan().toString()
