"""Row numbers over whole tables without sending the table through one task.

Parquet knows each row's index inside its file. A number is therefore the rows in all
files before it (a table with one entry per file) plus that index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..scratch import materialize

# A broadcast entry is a file name and two numbers; a table of this many stays around 20 MB.
BROADCAST_FILES = 100_000
ROWS_PER_BLOCK = 1_000_000


def parquet_files(table: DataFrame) -> DataFrame:
    """Rows per file of a Parquet table, from the footers."""
    file = F.col("_metadata.file_path").alias("_file")
    counts = table.groupBy(file).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.withColumn("_order", F.col("_file"))


def file_offsets(files: DataFrame) -> DataFrame:
    """``_offset``: rows in the files before, by ``_order``. One row per file goes in and out."""
    before = Window.orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    rows_before = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    return files.select("_file", "_rows", rows_before.alias("_offset"))


def with_offsets(rows: DataFrame, offsets: DataFrame, broadcast: bool) -> DataFrame:
    """Add ``_offset`` to ``rows`` (``_file``, ``_index``) from ``offsets`` (``_file``, ``_rows``, ``_offset``)."""
    if broadcast:
        return rows.join(F.broadcast(offsets.drop("_rows")), "_file")
    # More files: a shuffle join, on blocks of rows so that one large file fills many tasks.
    last_block = F.floor((F.col("_rows") - 1) / ROWS_PER_BLOCK)
    blocks = offsets.select(
        "_file", "_offset", F.explode(F.sequence(F.lit(0), last_block)).alias("_block")
    )
    blocked = rows.withColumn("_block", F.floor(F.col("_index") / ROWS_PER_BLOCK))
    return blocked.join(blocks.hint("shuffle_hash"), ["_file", "_block"]).drop("_block")


def _with_offsets(rows: DataFrame, files: DataFrame, n_files: int) -> DataFrame:
    """The same from the ``files`` that :func:`parquet_files` counted."""
    return with_offsets(rows, file_offsets(files), n_files <= BROADCAST_FILES)


def number_parquet(spark: SparkSession, *paths: str, name: str = "row_id") -> DataFrame:
    """A Parquet table with each row's position, from 0, in file-path order.

    Only file footers are read to count; the position does not depend on how Spark splits
    the scan, so it names the same row in every query over the same files.
    """
    table = spark.read.parquet(*paths)
    columns = table.columns
    rows = table.select(
        F.struct(*map(_quoted, columns)).alias("_row"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    numbered = _with_offsets(rows, parquet_files(table), len(table.inputFiles()))
    return numbered.select((F.col("_offset") + F.col("_index")).alias(name), "_row.*")


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_no") -> DataFrame:
    """Rows of ``df`` numbered from 1 in ``order``, which must tell all rows apart.

    The sorted rows are written once; the range partitions follow all sort columns, so
    rows that share the first ones still spread over tasks.
    """
    return number_ordered(df.orderBy(*order), name)


def number_ordered(df: DataFrame, name: str = "row_no") -> DataFrame:
    """Rows of ``df`` numbered from 1 in the order that it has, such as that of a sort.

    A row is one struct until it is numbered, so its columns may have any names.
    """
    ranked = df.select(F.struct(*map(_quoted, df.columns)).alias("_row"), F.spark_partition_id().alias("_part"))
    stored = materialize(ranked, "sorted")
    rows = stored.select("_row", F.col("_part").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    files = stored.groupBy(F.col("_part").alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    files = files.withColumn("_order", F.col("_file"))
    numbered = _with_offsets(rows, files, len(stored.inputFiles()))
    return numbered.select((F.col("_offset") + F.col("_index") + 1).alias(name), "_row.*")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
