"""Values rendered for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hitlake.functions import cell_text, fmt_bytes, fmt_count, fmt_epoch_ms, json_safe
from hitlake.functions.text import iso_seconds

from .tables import event_hits, table


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .when(F.col("o_orderstatus") == "F", "")
        .otherwise((F.col("o_totalprice") * 100).cast("bigint").cast("string"))
    )
    return orders.select("o_orderkey", fmt_count(text).alias("shown"))


def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    day = F.date_diff(F.col("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint")
    millis = day * 86_400_000 + F.col("o_custkey") * 61_007
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(millis.cast("string"))
    return orders.select(
        "o_orderkey", fmt_epoch_ms(text).alias("listed"), fmt_epoch_ms(text, iso_seconds).alias("described")
    )


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    scale = (
        F.when(F.col("o_orderkey") % 4 == 0, 1)
        .when(F.col("o_orderkey") % 4 == 1, 2048)
        .when(F.col("o_orderkey") % 4 == 2, 999_983)
        .otherwise(0)
    )
    size = F.col("o_custkey") * scale + F.col("o_orderkey") % 2000
    return orders.select("o_orderkey", fmt_bytes(size).alias("shown"))


def safe_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    number = (F.col("o_orderkey") % 400 - 200) * 90_071_992_547_409
    return orders.select("o_orderkey", F.to_json(F.struct(json_safe(number).alias("n"))).alias("json"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = event_hits(spark, sf_dir)
    host = hits.schema["_source"].dataType["host"].dataType
    number = F.when(F.col("_source.k") > 50, F.col("_source.k"))
    return hits.select(
        "_id",
        cell_text(F.col("_source.host"), host).alias("host"),
        cell_text(number, T.LongType()).alias("number"),
    )


QUERIES = {
    "fmt_count": (
        counts,
        """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN o_orderpriority WHEN 'F' THEN '-'
            ELSE format('{:,}', CAST(trunc(o_totalprice * 100) AS BIGINT)) END AS shown FROM orders""",
    ),
    "fmt_epoch_ms": (
        epochs,
        """SELECT o_orderkey,
            CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(t, '%Y-%m-%d %H:%M') END AS listed,
            CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE strftime(t, '%Y-%m-%dT%H:%M:%SZ') END AS described
        FROM (SELECT o_orderkey, o_orderstatus,
            o_orderdate + to_milliseconds(o_custkey * 61007) AS t FROM orders)""",
    ),
    "fmt_bytes": (
        sizes,
        """SELECT o_orderkey, CASE WHEN n < 1024 THEN CAST(n AS VARCHAR) || ' B'
            WHEN n < 1048576 THEN CAST(CAST(round(n * 10 / 1024.0) / 10 AS DECIMAL(18, 1)) AS VARCHAR) || ' KB'
            WHEN n < 1073741824 THEN CAST(CAST(round(n * 10 / 1048576.0) / 10 AS DECIMAL(18, 1)) AS VARCHAR) || ' MB'
            ELSE CAST(CAST(round(n * 100 / 1073741824.0) / 100 AS DECIMAL(18, 2)) AS VARCHAR) || ' GB' END AS shown
        FROM (SELECT o_orderkey, o_custkey * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2048
            WHEN 2 THEN 999983 ELSE 0 END + o_orderkey % 2000 AS n FROM orders)""",
    ),
    "json_safe": (
        safe_integers,
        """SELECT o_orderkey, CASE WHEN abs(n) > 9007199254740991 THEN '{"n":"' || CAST(n AS VARCHAR) || '"}'
            ELSE '{"n":' || CAST(n AS VARCHAR) || '}' END AS json
        FROM (SELECT o_orderkey, (o_orderkey % 400 - 200) * 90071992547409 AS n FROM orders)""",
    ),
    "cell_text": (
        cells,
        """SELECT CAST(event_id AS VARCHAR) AS _id, '{"name":"node' || CAST(user_id % 7 AS VARCHAR) || '"}' AS host,
            CASE WHEN k > 50 THEN CAST(k AS VARCHAR) ELSE '-' END AS number
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    ),
}
