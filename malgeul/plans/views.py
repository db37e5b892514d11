"""Views of the test tables in the shapes that the operators take.

The tables hold no speech data: scores are made from keys by integer rules, and Korean numbers from numeric columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _number(c: Column) -> Column:
    return c.cast("double")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("source", F.lit("_"), d).alias("utt_id"), F.col("source").alias("speaker_id"), d.cast("string").alias("sentence_id"), F.col("text").alias("text_raw"),
        (-_number(d * 37 % 101) / 100.0).alias("avg_logprob"), (_number(d * 13 % 50) / 10.0).alias("compression_ratio"), (_number(F.col("n_chars")) / 15.0).alias("duration"),
        F.col("lang").alias("language"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn, conv = F.col("turn"), F.col("conv_id")
    return table(spark, sf_dir, "conversations").select(
        conv.cast("string").alias("utt_id"), turn.cast("int").alias("seg_no"), "text", F.lit(0.0).alias("start"), _number(F.length("text") % 7).alias("end"),
        (-_number((conv * 7 + turn * 3) % 100) / 100.0).alias("avg_logprob"), (_number(turn % 10) / 10.0).alias("no_speech_prob"),
        (_number((conv + turn) % 40) / 10.0).alias("compression_ratio"), _number(F.when(turn % 5 == 4, 1).otherwise(0)).alias("temperature"),
    )


def korean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, kind, n, text``: counted things, prices, hours, years, distances and long prices."""
    def kinds(rows: DataFrame, key: Column, number: Column, texts: dict[str, Callable[[Column], Column]]) -> DataFrame:
        own = rows.select(key.cast("long").alias("id"), number.cast("long").alias("n"))
        return own.select("id", "n", F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), text(F.col("n")).alias("text")) for k, text in texts.items()))))

    after = lambda suffix: lambda n: F.concat(n, F.lit(suffix))
    counted = {"count": "개를 샀다", "hour": "시에 왔다", "machine": " 대가", "distance": ".5km", "big": "억원", "man": "만1300명"}
    part = kinds(table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size"), {k: after(v) for k, v in counted.items()})
    large = {"price": after("원"), "bare": lambda n: n.cast("string")}
    return part.unionByName(kinds(table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_orderkey") * 7919 % 1_000_000_007, large))


def fix_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, tag, bucket, raw, recommended, candidates``: small and large rewrites of part names."""
    key = F.col("p_partkey")
    pick = lambda words, by: F.get(F.array(*map(F.lit, words)), (key % by).cast("int"))
    rec = F.when(key % 4 == 0, F.col("p_name")).when(key % 4 == 1, F.concat("p_name", F.lit("s"))).when(key % 4 == 2, F.col("p_type")).otherwise(F.lit("..."))
    rows = table(spark, sf_dir, "part").select(key.alias("id"), pick(["U1", "N3", "E2", "OOV", "N3"], 5).alias("tag"), pick(["RED", "GREEN", "YELLOW", "GREEN", "ORANGE", "GREEN"], 6).alias("bucket"), F.col("p_name").alias("raw"), rec.alias("recommended"))
    one = lambda text, n, by: F.struct(text.alias("text"), (_number(F.col("id") * n % by) / 10.0).alias("score"))
    first, second = F.struct(F.col("recommended").alias("text"), F.lit(0.9).alias("score")), one(F.col("raw"), 3, 9)
    return rows.withColumn("candidates", F.when(F.col("id") % 3 == 0, F.array(first)).otherwise(F.array(first, second)))


def edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reviewed table: two spans of each document, some fixes blank."""
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").filter(F.length("text") >= 20)
    span = lambda k: F.struct((2 * d + k).alias("row_no"), F.lit(8 * k).alias("span_start"), F.lit(8 * k + 4).alias("span_end"))
    rows = docs.select("doc_id", "source", "text", F.inline(F.array(span(0), span(1))))
    return rows.select(
        "row_no", F.concat("source", F.lit("_"), d).alias("utt_id"), F.col("source").alias("speaker_id"), d.cast("string").alias("sentence_id"), "span_start", "span_end",
        F.substr("text", F.col("span_start") + 1, F.lit(4)).alias("raw_span"), F.lit("REC").alias("recommended"),
        F.when(F.col("row_no") % 3 == 0, F.lit("  ")).when(F.col("row_no") % 3 == 1, F.lit("REC")).otherwise(F.concat(F.lit("fix"), d)).alias("user_fix"),
    )
