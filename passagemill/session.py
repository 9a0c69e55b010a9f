"""Session-level helpers: the shared work folder, staged tables and Arrow batch size."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Where it is unset, a cluster session uses a folder below the warehouse, which all executors reach,
    and a local one a temporary folder per application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged-{app}"
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="passagemill-")
    return _local_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def held_setting(spark: SparkSession, key: str, value: int):
    """Set a number of the session for the jobs run inside the block, then restore it."""
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def arrow_batch_rows(spark: SparkSession, rows: int):
    """Set the Arrow batch row cap for the jobs run inside the block, then restore it."""
    return held_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def stage(df: DataFrame, label: str, arrow_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used between stages whose work must not run twice (model calls, parsed text) and between
    Python stages that want different Arrow batch sizes. Survives the loss of executors.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if arrow_rows is None:
        df.write.parquet(path)
    else:
        with arrow_batch_rows(spark, arrow_rows):
            df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_meanwhile(df: DataFrame, label: str):
    """``stage`` for rows that nothing reads after the block: its end deletes them."""
    spark = df.sparkSession
    path = new_path(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
