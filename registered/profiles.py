"""Counts, value statistics, field profiles and time ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitlake.functions import describe_schema, detect_time_field, leaf_fields, span_text, time_field_options
from hitlake.operators import (
    Filter,
    date_range,
    date_ranges,
    field_counts,
    filtered_count,
    numeric_stats,
    profile,
    row_count,
    top_values,
    value_histogram,
)

from .tables import SPARSE_EVENTS, event_hits, events, sparse_events, table


def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(table(spark, sf_dir, "lineitem"))


def count_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered_count(sparse_events(spark, sf_dir), [Filter("event_type", "neq", "view")], search="12")


def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_counts(sparse_events(spark, sf_dir), "event_type")


def user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_counts(events(spark, sf_dir), "user_id")


def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(events(spark, sf_dir), "user_id")


def type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = value_histogram(top_values(sparse_events(spark, sf_dir), "event_type"))
    return top.withColumn("height", F.round("height", 6))


def value_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numeric_stats(events(spark, sf_dir), "value").withColumn("avg", F.round("avg", 6))


def text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text column where only some values are numbers."""
    texts = events(spark, sf_dir).select(
        F.when(F.col("event_type") == "click", F.col("user_id").cast("string")).otherwise("n/a").alias("mixed")
    )
    return numeric_stats(texts, "mixed").withColumn("avg", F.round("avg", 6))


def profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(sparse_events(spark, sf_dir))


def profile_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaves of nested documents."""
    return profile(event_hits(spark, sf_dir).drop("sort"))


def profile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "orders"))


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns as described, with what their values say."""
    orders = table(spark, sf_dir, "orders")
    filled = profile(orders, k=1).select("field", "unique_count", "null_count")
    described = describe_schema(orders).join(filled, F.col("name") == F.col("field")).drop("field")
    labels = leaf_fields(orders).select("name", "display_path", "short_type")
    return described.join(labels, "name")


def event_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_range(events(spark, sf_dir), "ts")


def detected_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = event_hits(spark, sf_dir)
    return date_range(hits, detect_time_field(hits.schema))


def empty_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_range(events(spark, sf_dir).where(F.col("user_id") < 0), "ts")


def offered_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range of each time field a user can choose."""
    hits = event_hits(spark, sf_dir).withColumn("received", F.col("_source.`@timestamp`") + F.expr("interval 1 hour"))
    return date_ranges(hits, time_field_options(hits.schema))


def daily_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Span between each event and the end of the data."""
    end = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return events(spark, sf_dir).select("event_id", span_text(F.col("ts"), end).alias("span"))


def _profile_sql(source: str, fields: list[tuple[str, str, str]]) -> str:
    parts = []
    for name, label, expression in fields:
        parts.append(f"""
        SELECT '{name}' AS field, '{label}' AS type, u AS unique_count, n AS null_count, rank, value, count
        FROM (SELECT count(DISTINCT {expression}) AS u, count(*) - count({expression}) AS n FROM {source})
        LEFT JOIN (
            SELECT *, CAST(row_number() OVER (ORDER BY count DESC, value) AS INTEGER) AS rank FROM (
                SELECT CAST({expression} AS VARCHAR) AS value, count(*) AS count FROM {source}
                WHERE {expression} IS NOT NULL GROUP BY 1)
            QUALIFY rank <= 10) ON TRUE""")
    return " UNION ALL ".join(parts)


_MESSAGE = "event_type || ' user=' || CAST(user_id AS VARCHAR)"
_HOST = "'node' || CAST(user_id % 7 AS VARCHAR)"
_SPAN = """CASE WHEN s IS NULL THEN '-'
    WHEN s // 86400 > 1 THEN CAST(s // 86400 AS VARCHAR) || ' days' WHEN s // 86400 = 1 THEN '1 day'
    WHEN s // 3600 > 1 THEN CAST(s // 3600 AS VARCHAR) || ' hours' WHEN s // 3600 = 1 THEN '1 hour'
    WHEN s // 60 = 1 THEN '1 minute' ELSE CAST(s // 60 AS VARCHAR) || ' minutes' END AS span"""


def range_sql(where: str = "", shift: str = "INTERVAL 0 HOUR", extra: str = "") -> str:
    return f"""SELECT strftime(a, '%Y-%m-%dT%H:%M:%S.%gZ') AS oldest, strftime(b, '%Y-%m-%dT%H:%M:%S.%gZ') AS newest,
        {_SPAN} {extra} FROM (SELECT a, b, date_diff('microsecond', a, b) // 1000000 AS s
        FROM (SELECT min(ts) + {shift} AS a, max(ts) + {shift} AS b FROM events {where}))"""


QUERIES = {
    "row_count": (count_rows, "SELECT count(*) AS total FROM lineitem"),
    "filtered_count": (
        count_filtered,
        SPARSE_EVENTS
        + """SELECT count(*) AS total FROM sparse WHERE event_type != 'view'
        AND (CAST(event_id AS VARCHAR) ILIKE '%12%' OR CAST(ts AS VARCHAR) ILIKE '%12%'
          OR CAST(user_id AS VARCHAR) ILIKE '%12%' OR event_type ILIKE '%12%'
          OR CAST(value AS VARCHAR) ILIKE '%12%' OR props ILIKE '%12%')""",
    ),
    "field_counts": (
        type_counts,
        SPARSE_EVENTS + "SELECT count(DISTINCT event_type) AS unique_count,"
        " count(*) - count(event_type) AS null_count FROM sparse",
    ),
    "field_counts_user": (
        user_counts,
        "SELECT count(DISTINCT user_id) AS unique_count, count(*) - count(user_id) AS null_count FROM events",
    ),
    "top_values": (
        top_users,
        "SELECT CAST(user_id AS VARCHAR) AS value, count(*) AS count FROM events GROUP BY user_id"
        " ORDER BY count DESC, value LIMIT 10",
    ),
    "value_histogram": (
        type_histogram,
        SPARSE_EVENTS + "SELECT value, count, round(count / greatest(max(count) OVER (), 1) * 100, 6) AS height"
        " FROM (SELECT event_type AS value, count(*) AS count FROM sparse WHERE event_type IS NOT NULL"
        " GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)",
    ),
    "numeric_stats": (
        value_stats,
        "SELECT min(value) AS min, max(value) AS max, round(avg(try_cast(value AS DOUBLE)), 6) AS avg FROM events",
    ),
    "numeric_stats_text": (
        text_stats,
        "SELECT min(m) AS min, max(m) AS max, round(avg(try_cast(m AS DOUBLE)), 6) AS avg FROM (SELECT"
        " CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) ELSE 'n/a' END AS m FROM events)",
    ),
    "profile": (
        profile_events,
        SPARSE_EVENTS
        + _profile_sql(
            "sparse",
            [
                ("event_id", "i64", "event_id"),
                ("ts", "time", "ts"),
                ("value", "f64", "value"),
                ("user_id", "i64", "user_id"),
                ("event_type", "str", "event_type"),
                ("props", "str", "props"),
            ],
        ),
    ),
    "profile_nested": (
        profile_hits,
        _profile_sql(
            "events",
            [
                ("_id", "str", "CAST(event_id AS VARCHAR)"),
                ("_source.event_id", "i64", "event_id"),
                ("_source.@timestamp", "time", "ts"),
                ("_source.message", "str", f"({_MESSAGE})"),
                ("_source.host.name", "str", f"({_HOST})"),
                ("_source.k", "i64", "CAST(json_extract_string(props, '$.k') AS BIGINT)"),
            ],
        ),
    ),
    "profile_orders": (
        profile_orders,
        _profile_sql(
            "orders",
            [
                ("o_orderkey", "i64", "o_orderkey"),
                ("o_custkey", "i64", "o_custkey"),
                ("o_orderstatus", "str", "o_orderstatus"),
                ("o_totalprice", "f64", "o_totalprice"),
                ("o_orderdate", "time", "o_orderdate"),
                ("o_orderpriority", "str", "o_orderpriority"),
            ],
        ),
    ),
    "schema_report": (
        schema_report,
        """SELECT column_name AS name, column_type AS type, "null" = 'YES' AS nullable, name AS display_path,
            CASE column_type WHEN 'BIGINT' THEN 'i64' WHEN 'TIMESTAMP' THEN 'time' WHEN 'DOUBLE' THEN 'f64' ELSE 'str' END AS short_type,
            unique_count, null_count
        FROM (DESCRIBE orders) JOIN (
            SELECT 'o_orderkey' AS name, count(DISTINCT o_orderkey) AS unique_count,
                count(*) - count(o_orderkey) AS null_count FROM orders
            UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey), count(*) - count(o_custkey) FROM orders
            UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), count(*) - count(o_orderstatus) FROM orders
            UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice), count(*) - count(o_totalprice) FROM orders
            UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate), count(*) - count(o_orderdate) FROM orders
            UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority),
                count(*) - count(o_orderpriority) FROM orders) ON column_name = name""",
    ),
    "date_range": (event_range, range_sql()),
    "date_range_detected": (detected_range, range_sql()),
    "date_range_empty": (empty_range, range_sql("WHERE user_id < 0")),
    "date_ranges_offered": (
        offered_ranges,
        range_sql(extra=", '_source.@timestamp' AS field")
        + " UNION ALL "
        + range_sql(shift="INTERVAL 1 HOUR", extra=", 'received' AS field"),
    ),
    "date_span": (
        daily_spans,
        f"""SELECT event_id, {_SPAN} FROM (SELECT event_id,
        date_diff('microsecond', ts, TIMESTAMP '2024-01-31') // 1000000 AS s FROM events)""",
    ),
}
