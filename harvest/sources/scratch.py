"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Spark's setting that deletes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. A local session without one gets a temporary folder."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="harvest-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def folder_of(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, where = folder_of(spark, path)
    fs.delete(where, True)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A copy like that of `written`, deleted when the block has ended well; after an error it stays."""
    path = new_path(df.sparkSession, label)
    yield _copy(df, path)
    drop_folder(df.sparkSession, path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end in the block give back the disk of their shuffles at once; later steps read the table they wrote."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _copy(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """The same rows, read back from a table in the shared folder: a lost executor re-reads files, not the lineage."""
    return _copy(df, new_path(df.sparkSession, label))
