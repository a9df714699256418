"""Intermediate tables in the folder that all nodes share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it back; a
lost executor then costs a re-read, never a recomputation from the source. Paths go
through Spark only, so any Hadoop file system works.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in local mode, where it may be unset, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chainlake-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def text_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Fewer rows in an Arrow batch than Spark's default of 10,000: texts are large, and each task holds a few batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return it as read from the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def delete(*tables: DataFrame) -> None:
    """Delete tables that :func:`store` wrote, once nothing reads them any more."""
    for df in tables:
        files = df.inputFiles()
        for item in [x for x in _made if any(x[1].split("/")[-1] in f for f in files)]:
            _delete(*item)
            _made.remove(item)


def drop(*tables: DataFrame) -> None:
    """:func:`delete`, and shuffles that nothing refers to."""
    delete(*tables)
    release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Have the driver's JVM notice plans that are gone: executors keep a shuffle's files until it does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone by now; the folder is a scratch folder
            return
