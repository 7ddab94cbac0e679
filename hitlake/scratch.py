"""Durable scratch tables.

Some operators have to fix an intermediate result before they read it twice. They
write it as Parquet to the folder the cluster names in ``spark.checkpoint.dir``, so a
lost executor costs a task retry and never a different answer.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_owned: ContextVar[list[str] | None] = ContextVar("owned scratch paths", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder; without one, a folder in the warehouse, which executors share too."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return root.rstrip("/") if root else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that nothing has used yet."""
    path = f"{scratch_root(spark)}/hitlake-{label}-{uuid.uuid4().hex}"
    if (owned := _owned.get()) is not None:
        owned.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the copy.

    One file per task: the order inside a partition then equals the row order of its file.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside are deleted at the end; use their results before."""
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in paths:
            delete_path(spark, path)


def remove_scratch(df: DataFrame) -> None:
    """Delete the scratch tables a DataFrame reads, when it is no longer needed."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        if folder.rpartition("/")[2].startswith("hitlake-"):
            delete_path(df.sparkSession, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
