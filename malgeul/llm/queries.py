"""The registered queries of this folder, over whole tables with production parameters."""

from __future__ import annotations

import textwrap
from functools import lru_cache

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from malgeul.llm import bm25, byte_bpe, chat, gif, jaccard, license_scan, mixture, token_count, toxicity, url_filter
from malgeul.llm.common import table
from malgeul.llm.oracle import SQL  # noqa: F401

#: Results of a search; rows whose id it divides are the queries.
TOP_K, QUERY_STEP = 10, 20
CONTEXT_TOKENS = 2048
CHAT_PROBE = "\\### Assistant: </turn> ok"


def op1_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = docs.filter(F.col("doc_id") % QUERY_STEP == 0).withColumnRenamed("doc_id", "query_id")
    return bm25.top_k(docs, queries, TOP_K)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", "expected_severity", "grade", (F.col("grade") > 0).alias("toxic"))


def filter_list(pages: DataFrame) -> DataFrame:
    """Dated entries for half of the patterns of ``pages``, by a rule on the pattern's digest: the tables have no
    list of their own.  Of those, half are removed after a while and half of these listed again."""
    named = pages.select(F.explode(url_filter.patterns_of(F.col("url"))).alias("pattern")).distinct()

    def digits(at: int) -> Column:
        return F.conv(F.substring(F.md5("pattern"), at, 4), 16, 10).cast("int")

    a, b, c = digits(1), digits(5), digits(9)
    add, remove, again = b % 300, b % 300 + 20 + c % 60, b % 300 + 120 + c % 60
    entry = lambda day, action: F.struct(F.date_add(F.lit("2024-01-01").cast("date"), day).alias("dated"), F.lit(action).alias("action"))
    empty = F.array().cast("array<struct<dated:date,action:string>>")
    entries = F.concat(F.array(entry(add, "add")), F.when(a % 2 == 0, F.array(entry(remove, "remove"))).otherwise(empty), F.when(a % 4 == 0, F.array(entry(again, "add"))).otherwise(empty))
    return named.filter(a % 4 < 2).select("pattern", F.concat(F.lit("category"), c % 3).alias("category"), F.inline(entries))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 365).cast("int")))
    return url_filter.evaluate(captures, filter_list(pages))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CHAT_PROBE).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.format_conversations(turns))


def license_probes(spark: SparkSession) -> DataFrame:
    """Whole licences under negative ids, as the documents may have none: wrapped anew under notices, every other one in capitals."""
    rows = []
    for i, (_, text) in enumerate(license_scan.LICENSES):
        paragraphs = (textwrap.fill(" ".join(p.split()), 60 + i) for p in text.split("\n\n"))
        whole = f"Copyright (c) {2000 + i} Some Holder\nAll rights reserved.\n\n" + "\n\n".join(paragraphs)
        rows.append((-1 - i, whole.upper() if i % 2 else whole))
    return spark.createDataFrame(rows, "doc_id long, text string")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(license_probes(spark))
    return license_scan.scan(docs, license_scan.known_digests(spark))


@lru_cache(1)
def _word_tokenizer() -> token_count.WordTokenizer:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return token_count.WordTokenizer(f.read())


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.count_tokens(table(spark, sf_dir, "documents"), _word_tokenizer())
    return counts.withColumn("over_limit", counts["n_tokens"] > CONTEXT_TOKENS)


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.read_back(gif.encode_texts(table(spark, sf_dir, "documents")))


@lru_cache(1)
def byte_codec() -> byte_bpe.Codec:
    return byte_bpe.Codec(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), byte_codec())


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bm25_search, op2_toxicity, op3_url_filter, op4_chat_format, op5_license_scan,
        op6_token_counts, op7_mixture, op8_gif_media, op9_byte_bpe, op10_ngram_jaccard,
    )
}
