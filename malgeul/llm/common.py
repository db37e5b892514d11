"""Shared storage and table access for the operators in this folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Deletes the shuffle files of a query when it has ended.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a plan, as Catalyst estimates them, for which a table gets one more file.
FILE_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.  Where it is unset, a temporary folder if
    all of Spark runs in one process, else an error: other executors would not see a local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="malgeul-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def _files(df: DataFrame, parts: int | None) -> int:
    """Files for a table: as many as its size asks for, and one for each core at least."""
    if parts is None:
        parts = -(-int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) // FILE_BYTES)
    return max(df.sparkSession.sparkContext.defaultParallelism, min(parts, 1 << 30))


def materialize(df: DataFrame, label: str, batch: int | None = None, parts: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, so that later stages neither
    repeat its work nor depend on an executor that may be lost.

    ``batch``: rows that a Python worker gets at once, for rows that are large.  ``parts``: files that the table needs;
    small tables would else get one for each shuffle partition.  Partitions are put together without a shuffle, and
    shuffle files go with the query that wrote them.  The table is deleted by ``discard``, or when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/malgeul-{label}-{uuid.uuid4().hex}"
    own = {CLEAN_SHUFFLES: "true", **({ARROW_ROWS: str(batch)} if batch else {})}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        df.coalesce(_files(df, parts)).write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(t.scratch)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def give_back() -> None:
    """Give the system back what earlier tasks of this Python worker have freed: workers are reused, and allocators keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, such that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
