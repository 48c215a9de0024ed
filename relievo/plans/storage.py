"""Tables that cut lineage, in the folder that driver and executors share.

The folder is the session's ``spark.checkpoint.dir``. Only a local master may
do without it (tests); a temporary folder then stands in for it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT = "spark.checkpoint.dir"


def work_uri(spark: SparkSession) -> str:
    """URI of the shared working folder, without a trailing slash."""
    shared = spark.conf.get(_CHECKPOINT, None) or spark.sparkContext.getConf().get(_CHECKPOINT)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{_CHECKPOINT} must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="relievo-")
        spark.conf.set(_CHECKPOINT, shared)
    return shared.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A URI below the shared folder that no one has used yet."""
    return f"{work_uri(spark)}/relievo/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, under: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, or to a folder in it, and read it back.

    Later stages then start from files that outlive any executor.
    """
    spark = df.sparkSession
    path = f"{under}/{label}-{uuid.uuid4().hex}" if under else new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, uri: str) -> None:
    """Delete a folder through the file system that Spark reads it by."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, uri: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder, in place of what has the new name; nothing happens without the old one."""
    if exists(spark, old):
        delete(spark, new)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        path(old).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(path(old), path(new))


def folders(spark: SparkSession, uri: str) -> list[str]:
    """The names of what lies in a folder; none without it."""
    if not exists(spark, uri):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return [s.getPath().getName() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs that are done.

    Spark's cleaner follows the driver's garbage collector, which has no reason to
    run while the executors' disks fill; a job of many large exchanges asks for it.
    """
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function like :func:`materialize` whose tables go at the end of the block.

    What is to outlive the block has to be written elsewhere within it.
    """
    folder = new_folder(spark, label)
    try:
        yield lambda df, name: materialize(df, name, folder)
    finally:
        delete(spark, folder)
