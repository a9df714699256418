"""The folder for checkpoints that all nodes share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where it is unset in local mode."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="chainlake-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return context.getCheckpointDir()


#: For large rows: a scan holds a row group at once, and the writer looks at its size after so many rows.
LARGE = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 4}


def written(df: DataFrame, name: str, options: dict = {}) -> DataFrame:  # noqa: B006
    """``df`` computed once, as Parquet in the shared folder: cuts the lineage, and outlives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete what :func:`written` wrote."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
