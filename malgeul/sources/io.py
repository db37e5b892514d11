"""Reading and writing datasets, transcripts, issues, results, shards and review files."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StructType

from malgeul import schemas
from malgeul.sources import xlsx

#: How many files a task writes side by side before it sorts its rows by file.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


# ---- datasets ----


def save_dataset(rows: DataFrame, path: str, split: str = "split") -> dict[str, int]:
    """Write a dataset by split and return the rows of each."""
    rows.write.mode("overwrite").partitionBy(split).parquet(path)
    return {r[split]: r["count"] for r in rows.groupBy(split).count().collect()}


def is_dataset_there(spark: SparkSession, path: str) -> bool:
    return _exists(spark, path)


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def splits(rows: DataFrame, column: str = "split") -> list[str]:
    return sorted(r[0] for r in rows.select(column).distinct().collect() if r[0] is not None)


def get_split(rows: DataFrame, split: str, column: str = "split") -> DataFrame:
    if split not in (there := splits(rows, column)):
        raise ValueError(f"no split {split!r}; there are {', '.join(there)}")
    return rows.filter(F.col(column) == split)


# Names of the audio column, best first.
ACOUSTIC = ("Acoustic_Microphone", "acoustic_microphone", "Acoustic", "acoustic", "audio")


def acoustic_column(schema: StructType, ranked: tuple[str, ...] = ACOUSTIC) -> str:
    """The audio column: the first of the ranked names, else the first that says acoustic, else the first that looks like audio."""
    for name in ranked:
        if name in schema.names:
            return name
    for name in schema.names:
        if "acoustic" in name.lower():
            return name
    for field in schema.fields:
        inner = field.dataType.names if isinstance(field.dataType, StructType) else []
        if isinstance(field.dataType, BinaryType) or "array" in inner:
            return field.name
    raise ValueError(f"no acoustic column among {', '.join(schema.names)}")


def audio_payload(rows: DataFrame, column: str, rate: int = 16_000) -> DataFrame:
    """``samples`` and ``sampling_rate`` of an audio column: a struct of array and rate, one that holds such a struct, or a bare array."""
    kind = rows.schema[column].dataType
    samples, told = F.col(column), F.lit(None).cast("int")
    if isinstance(kind, StructType):
        inner = column if "array" in kind.names else f"{column}.{acoustic_column(kind)}"
        samples, told = F.col(f"{inner}.array"), F.col(f"{inner}.sampling_rate").cast("int")
    return rows.withColumn("samples", samples).withColumn("sampling_rate", F.coalesce(told, F.lit(rate)))


def with_audio(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNotNull())


# ---- transcripts and outputs ----


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped, a damaged one is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """The ids in a JSON-lines file that may have damaged lines; a missing file has none."""
    schema = "utt_id string, _corrupt_record string"
    if not _exists(spark, path):
        return spark.createDataFrame([], "utt_id string")
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return rows.filter("utt_id is not null").select("utt_id").distinct()


def _texts_beside(path: str) -> str:
    return f"{path.rstrip('/')}_texts"


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """Issues of JSON lines that have their whole text, or whose texts are beside them, as ``write_outputs`` writes them: these are joined
    by their digest, and only if ``context_full`` is used.  A missing ``context_marked_safe`` is made from ``context_marked``."""
    from malgeul.functions.decide import mark_safe

    rows = read_jsonl(spark, path, f"text_key string, {schemas.ISSUE}")
    if _exists(spark, _texts_beside(path)):
        texts = read_jsonl(spark, _texts_beside(path), "text_key string, text string").groupBy("text_key").agg(F.min("text").alias("text"))
        rows = rows.join(texts, "text_key", "left").withColumn("context_full", F.coalesce("context_full", "text"))
    rows = rows.withColumn("context_marked_safe", F.coalesce("context_marked_safe", mark_safe(F.col("context_marked")))).select(*schemas.ISSUE_COLUMNS)
    empty = F.expr(f"cast(array() as array<{schemas.CANDIDATE}>)")
    return rows.withColumn("candidates", F.coalesce("candidates", empty)).withColumn("user_fix", F.coalesce("user_fix", F.lit("")))


def append_transcripts(rows: DataFrame, path: str, resume: bool = True) -> int:
    """Write the rows that ``path`` lacks, or all anew without ``resume``; returns their number."""
    spark = rows.sparkSession
    if resume and _exists(spark, path):
        from malgeul.operators.segments import not_done

        rows = not_done(rows, read_done(spark, path))
    n = rows.count()
    rows.write.mode("append" if resume else "overwrite").json(path)
    return n


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``; without one, a folder with an empty file."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf, old, new = spark._jsc.hadoopConfiguration(), hadoop.Path(source), hadoop.Path(target)
    here, there = old.getFileSystem(conf), new.getFileSystem(conf)
    if not here.exists(old):
        spark.createDataFrame([], "value string").write.mode("overwrite").text(target)
        return
    there.delete(new, True)
    if new.getParent() is not None:
        there.mkdirs(new.getParent())
    same = here.getUri().equals(there.getUri())
    if not (here.rename(old, new) if same else hadoop.FileUtil.copy(here, old, there, new, True, conf)):
        raise OSError(f"could not move {source} to {target}")


def write_outputs(made: DataFrame, issues_path: str, available_path: str) -> None:
    """Issues and available texts as JSON lines in gzip files, from one evaluation of ``made``.  The whole text of a row with issues is written once
    beside them, not with each; the lines have its digest, ``text_key``, and no ``context_marked_safe``, which follows from ``context_marked``.

    Each row becomes its lines at once, and a task writes them to a file for each kind as they come: nothing is cached, sorted or read again.
    ``made`` is best without the issues' texts, which aren't written (``correct(..., texts=False)``)."""
    from malgeul.functions.textexpr import let
    from malgeul.operators.correct import AVAILABLE

    spark = made.sparkSession
    kept = [c for c in schemas.ISSUE_COLUMNS if c not in ("context_full", "context_marked_safe")]
    line = lambda kind, *fields: F.struct(F.lit(kind).alias("kind"), F.to_json(F.struct(*fields)).alias("line"))
    issues = let(F.md5("text_raw"), lambda key: F.transform("issues", lambda i: line("issues", key.alias("text_key"), *(i[c].alias(c) for c in kept))))
    text = F.when(F.col("decision") == "NEEDS_REVIEW", F.array(line("texts", F.md5("text_raw").alias("text_key"), F.col("text_raw").alias("text"))))
    available = let(F.col("text_avail"), lambda t: F.when(t.isNotNull(), F.array(line("available", *(t.alias(c) if c == "text_avail" else F.col(c) for c in AVAILABLE)))))
    empty = F.expr("cast(array() as array<struct<kind: string, line: string>>)")
    lines = made.select(F.concat(*(F.coalesce(x, empty) for x in (issues, text, available))).alias("lines")).select(F.inline("lines"))
    staged = f"{issues_path.rstrip('/')}_parts-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(staged)
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, "8")
    try:
        lines.write.partitionBy("kind").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(staged)
        for kind, path in (("texts", _texts_beside(issues_path)), ("available", available_path), ("issues", issues_path)):
            _move(spark, f"{staged}/kind={kind}", path)
    finally:
        spark.conf.set(WRITERS, before)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_results(rows: DataFrame, path: str | None = None, model_size: str = "large-v3", folder: str = ".") -> str:
    """Pipeline results as JSON lines in ``results`` with one row of ``metadata`` beside them; returns the path, by default named by the time."""
    path = path or f"{folder}/results_{datetime.now():%Y%m%d_%H%M%S}"
    rows.write.mode("overwrite").json(f"{path}/results")
    told = rows.sparkSession.read.schema(schemas.PIPELINE_ROW).json(f"{path}/results").agg(F.count("*").cast("int").alias("total_count"))
    told.select(F.current_timestamp().cast("string").alias("created_at"), "total_count", F.lit(model_size).alias("model_size")).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    return path


def write_results_document(rows: DataFrame, path: str, model_size: str = "large-v3") -> None:
    """The same as one document with ``metadata`` and ``results``, for result sets that fit in one row."""
    own = rows.agg(F.collect_list(F.struct(*rows.columns)).alias("results"), F.count("*").cast("int").alias("n"))
    metadata = F.struct(F.current_timestamp().cast("string").alias("created_at"), F.col("n").alias("total_count"), F.lit(model_size).alias("model_size"))
    own.select(metadata.alias("metadata"), "results").coalesce(1).write.mode("overwrite").json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """What either of these wrote, or one such document in a file."""
    if _exists(spark, f"{path}/results"):
        return spark.read.schema(schemas.PIPELINE_ROW).json(f"{path}/results")
    return spark.read.schema(schemas.RESULTS_DOCUMENT).option("multiLine", True).json(path).select(F.inline("results"))


def write_resolutions(resolved: DataFrame, finals: DataFrame, resolved_path: str, finals_path: str) -> tuple[int, int]:
    resolved.drop("row_no").write.mode("overwrite").json(resolved_path)
    finals.write.mode("overwrite").json(finals_path)
    return resolved.count(), finals.count()


# ---- buckets and shards ----


def write_buckets(rows: DataFrame, path: str) -> None:
    rows.withColumn("bucket", F.coalesce("bucket", F.lit("unknown"))).write.mode("overwrite").partitionBy("split", "bucket").json(path)


def read_bucket(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A JSON array of reviewed rows, or what ``write_buckets`` wrote (``lines``); a missing file has none."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schemas.BUCKET_REVIEW)
    return spark.read.schema(schemas.BUCKET_REVIEW).option("multiLine", not lines).json(path)


def read_buckets(spark: SparkSession, paths: list[str], lines: bool = False) -> list[DataFrame]:
    """Those of the files that exist."""
    return [read_bucket(spark, p, lines) for p in paths if _exists(spark, p)]


def read_written_buckets(spark: SparkSession, path: str) -> DataFrame:
    """All that ``write_buckets`` wrote; ``split`` and ``bucket`` are those of each file's path."""
    return spark.read.schema(f"split STRING, {schemas.BUCKET_REVIEW}").json(path)


def write_shards(rows: DataFrame, path: str, size: int = 200) -> None:
    """JSON lines by ranges of ``idx``; a rerun adds the rows that are not there."""
    from malgeul.operators.segments import shard_of

    spark = rows.sparkSession
    own = rows.withColumn("shard", shard_of(F.col("idx"), size))
    if _exists(spark, path):
        own = own.join(spark.read.json(path).select("idx").distinct(), "idx", "left_anti")
    own.write.mode("append").partitionBy("shard").json(path)


def merge_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SHARD).json(path).orderBy("idx")


# ---- review workbooks ----


def export_review(issues: DataFrame, path: str, most_candidates: int = 5) -> int:
    """Write the workbook and return its rows; without issues there is none."""
    from malgeul.operators.review import review_table

    table = review_table(issues, most_candidates).orderBy("utt_id", "span_start")
    widths = {"context_marked": 60, "candidates": 40, "recommended": 25, "user_fix": 25, "raw_span": 20}
    return xlsx.write(path, schemas.REVIEW_COLUMNS, (tuple(r) for r in table.toLocalIterator()), widths=widths)


def import_review(spark: SparkSession, path: str) -> DataFrame:
    rows = [(i, *(r.get(c) for c in schemas.REVIEW_COLUMNS)) for i, r in enumerate(xlsx.read(path), 2)]
    return spark.createDataFrame(rows, "row_no int, " + ", ".join(f"{c} string" for c in schemas.REVIEW_COLUMNS))
