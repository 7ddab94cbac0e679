"""The given tables, and documents made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitlake.operators import number_rows
from hitlake.scratch import scratch_path
from hitlake.sources import as_hits, json_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def sparse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose type is missing where it was ``error``."""
    return events(spark, sf_dir).withColumn(
        "event_type", F.when(F.col("event_type") != "error", F.col("event_type"))
    )


# The same in SQL, to be put before a SELECT.
SPARSE_EVENTS = "WITH sparse AS (SELECT * REPLACE (nullif(event_type, 'error') AS event_type) FROM events) "


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log documents: id, ``@timestamp``, message, host and the parsed number."""
    return events(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("@timestamp"),
        F.concat_ws(" ", "event_type", F.concat(F.lit("user="), "user_id")).alias("message"),
        F.struct(F.concat(F.lit("node"), F.col("user_id") % 7).alias("name")).alias("host"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def event_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_hits(event_documents(spark, sf_dir), "event_id", ["@timestamp", "event_id"])


def hit_lines(spark: SparkSession, sf_dir: str, damaged: bool = False) -> str:
    """Folder of line-delimited JSON made from the events.

    Every line starts with its own place in its file. When ``damaged``, lines of purchases
    are cut short and lines of errors have text behind the object.
    """
    hits = event_hits(spark, sf_dir).drop("sort")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1
    rows = hits.select(place.alias("place"), "_id", "_source")
    text = json_text(rows)
    if damaged:
        message = F.col("_source.message")
        text = (
            F.when(message.startswith("purchase"), F.substr(text, F.lit(1), F.length(text) - 1))
            .when(message.startswith("error"), F.concat(text, F.lit(" trailing")))
            .otherwise(text)
        )
    path = scratch_path(spark, "hit-lines")
    rows.select(text.alias("value")).write.text(path)
    return path


def lines_in_order(lines: DataFrame) -> DataFrame:
    """``line`` and ``value``: the lines of a folder of part files, numbered from 0 in the order of the files' names."""
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")]
    numbered = number_rows(lines.select("value", *place), [F.col("file"), F.col("block"), F.col("at")], "line")
    return numbered.select((F.col("line") - 1).alias("line"), "value")
