"""The review loop: issues to a table that people edit, edited rows to resolutions and final texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from malgeul.functions.decide import apply_all, apply_fixes, review_cell
from malgeul.functions.textexpr import strip
from malgeul.schemas import REVIEW_COLUMNS


def review_table(issues: DataFrame, most_candidates: int = 5) -> DataFrame:
    """The columns that reviewers see."""
    return issues.select(
        *REVIEW_COLUMNS[:9], review_cell(F.col("candidates"), most_candidates).alias("candidates"), "recommended", "user_fix",
        F.col("meta.avg_logprob").alias("avg_logprob"), F.col("meta.compression_ratio").alias("compression_ratio"),
    )


def _blank(c: Column) -> Column:
    return c.isNull() | (strip(c.cast("string")) == "")


def resolutions(edited: DataFrame) -> DataFrame:
    """``edited(row_no, review columns)`` to resolutions: the reviewer's text if it isn't blank, else the recommended one.
    Rows without a first cell are left out; a missing raw span reads "None"; ``resolved_at`` is the time of the query."""
    fix, told = F.col("user_fix").cast("string"), F.col("recommended").cast("string")
    number = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0))
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    return edited.filter(F.coalesce(F.col("utt_id"), F.lit("")) != "").select(
        "row_no", F.col("utt_id").cast("string").alias("utt_id"), word("speaker_id").alias("speaker_id"), word("sentence_id").alias("sentence_id"),
        number("span_start").alias("span_start"), number("span_end").alias("span_end"), word("raw_span").alias("raw_span"),
        F.when(_blank(fix), F.coalesce(told, F.lit(""))).otherwise(fix).alias("final_text"),
        (~_blank(fix) & (fix != F.coalesce(told, F.lit("None")))).alias("was_modified"), F.current_timestamp().alias("resolved_at"),
    )


def original_texts(rows: DataFrame) -> DataFrame:
    """``utt_id, original`` of ``rows(line_no, utt_id, text_raw)``; of repeated ids the last line counts."""
    return rows.groupBy("utt_id").agg(F.max_by(F.coalesce("text_raw", F.lit("")), "line_no").alias("original"))


def final_texts(resolved: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """All resolutions of an utterance applied to its original text; without one, to the longest raw span if that starts at 0,
    else the utterance has no row."""
    own = F.array_sort(F.collect_list(F.struct("row_no", "speaker_id", "sentence_id", "span_start", "span_end", "raw_span", "final_text")))
    rows = resolved.groupBy("utt_id").agg(own.alias("own"))
    if originals is not None:
        rows = rows.join(originals, "utt_id", "left")
    else:
        rows = rows.withColumn("original", F.lit(None).cast("string"))
    longest = F.get(F.array_sort("own", lambda a, b: F.when(b["span_end"] - b["span_start"] != a["span_end"] - a["span_start"], (b["span_end"] - b["span_start"]) - (a["span_end"] - a["span_start"])).otherwise((a["row_no"] - b["row_no"]).cast("int"))), F.lit(0))
    fixes = F.transform("own", lambda r, i: F.struct(r["span_start"].alias("start"), r["span_end"].alias("end"), r["final_text"].alias("new"), i.alias("place")))
    based = rows.withColumn("longest", longest).withColumn("text_raw", F.coalesce("original", F.when(F.col("longest.span_start") == 0, F.col("longest.raw_span"))))
    first = F.get("own", F.lit(0))
    return based.filter("text_raw is not null").select(
        "utt_id", first["speaker_id"].alias("speaker_id"), first["sentence_id"].alias("sentence_id"), "text_raw",
        apply_all(F.col("text_raw"), fixes).alias("text_avail"), F.lit("human_review").alias("resolved_from"), F.size("own").alias("resolution_count"),
    )


def apply_resolutions(rows: DataFrame, fixes: DataFrame) -> DataFrame:
    """``rows(utt_id, text_raw)`` with ``text_fixed``: ``fixes(utt_id, start, end, new[, place])`` that don't overlap; of fixes of one range the
    last by ``place`` holds, or without such a column the one that sorts last."""
    last = F.max_by("new", F.struct("place", "new")) if "place" in fixes.columns else F.max("new")
    own = fixes.groupBy("utt_id", "start", "end").agg(last.alias("new")).groupBy("utt_id").agg(F.collect_list(F.struct("start", "end", "new")).alias("fixes"))
    made = rows.join(own, "utt_id", "left")
    return made.withColumn("text_fixed", F.when(F.col("fixes").isNull(), F.col("text_raw")).otherwise(apply_fixes(F.col("text_raw"), F.col("fixes")))).drop("fixes")


# ---- bucket review ----


def bucket_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("bucket", F.lit("unknown")).alias("bucket")).agg(F.count("*").alias("n"))


def merge_buckets(files: list[DataFrame], edits: DataFrame | None = None) -> DataFrame:
    """Reviewed bucket files as one table, its text named ``text_verified``, in order of speaker and sentence; ``edits(speaker_id,
    sentence_id, text)`` are what people changed."""
    rows = files[0]
    for other in files[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    rows = rows.withColumnRenamed("text_raw", "text_verified")
    if edits is not None:
        own = edits.groupBy("speaker_id", "sentence_id").agg(F.max("text").alias("edited"))
        rows = rows.join(own, ["speaker_id", "sentence_id"], "left").withColumn("text_verified", F.coalesce("edited", "text_verified")).drop("edited")
    return rows.orderBy("speaker_id", "sentence_id")


def sample_rows(rows: DataFrame, key: str, n: int = 10, seed: int = 0) -> DataFrame:
    """n rows by a seeded hash of ``key``."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def first_rows(rows: DataFrame, by: str, n: int | None) -> DataFrame:
    """The first n rows by ``by``; all for 0 or None."""
    return rows.orderBy(by).limit(n) if n else rows


def numbered(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with ``row_no``, their place in order of ``by``: ranges are sorted by themselves, and a range's numbers begin after the counts of
    those before it."""
    ranges = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("row_no", F.monotonically_increasing_id())
    part = F.shiftright("row_no", 33)
    before, offsets = 0, []
    for r in ranges.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row for each range
        offsets += [F.lit(r["part"]), F.lit(before)]
        before += r["count"]
    if not offsets:
        return rows.withColumn("row_no", F.lit(0).cast("long")).limit(0)
    within = F.col("row_no").bitwiseAND(F.lit((1 << 33) - 1))
    return ranges.withColumn("row_no", F.create_map(*offsets)[part] + within + 1)
