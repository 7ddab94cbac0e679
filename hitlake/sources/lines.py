"""Line-delimited JSON as raw lines, each judged on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.paths import is_json
from ..scratch import materialize


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw lines (column ``value``). No schema is needed and no bad line stops a job."""
    return spark.read.text(list(paths))


def bad_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines that are not JSON: file, 1-based line number, text.

    A line's number is the lines in all blocks of its file before its own, plus its place in
    the block. Where a scan splits files can change between jobs, so one scan is written down
    first: per line the file and block (repeated values, next to nothing in Parquet) and the
    text of bad lines only.
    """
    checked = read_lines(spark, *paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.when(~is_json(F.col("value")), F.col("value")).alias("value"),
    )
    stored = materialize(checked, "lines").select("*", F.col("_metadata.row_index").alias("index"))
    blocks = stored.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.min("index").alias("first")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "file", "block", (F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first")).alias("shift")
    )
    bad = stored.where(F.col("value").isNotNull())
    return bad.join(starts, ["file", "block"]).select(
        "file", (F.col("shift") + F.col("index") + 1).alias("line_no"), "value"
    )
