"""Filters, time ranges, free-text search and query bodies."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitlake.operators import (
    Filter,
    SortKey,
    TimeRange,
    between_closed,
    between_half_open,
    bool_,
    last,
    match_all,
    number_parquet,
    range_,
    search_all,
    term,
    where_all,
)
from hitlake.plans import View, search

from .tables import SPARSE_EVENTS, event_documents, event_hits, events, sparse_events, table

COLUMNS = ("event_id", "event_type", "user_id")
WEEK = ("2024-01-10T00:00:00Z", "2024-01-17T12:30:00Z")


def _filtered(f: Filter):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return where_all(sparse_events(spark, sf_dir), [f]).select(*COLUMNS)

    return query


def _filter_query(f: Filter, condition: str):
    sql = f"{SPARSE_EVENTS} SELECT event_id, event_type, user_id FROM sparse WHERE {condition}"
    return _filtered(f), sql


def filter_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = [
        Filter("event_type", "neq", "view"),
        Filter("user_id", "gte", "10"),
        Filter("value", "lt", 50.5),
        Filter("event_type", "exists"),
    ]
    return where_all(sparse_events(spark, sf_dir), filters, TimeRange("ts", *WEEK), "7").select(*COLUMNS)


def time_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir)
    return df.where(between_closed(df.schema, TimeRange("ts", *WEEK))).select(*COLUMNS)


def time_half_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir)
    bounds = TimeRange("ts", "2024-01-10", "2024-01-17")
    return df.where(between_half_open(df.schema, bounds)).select(*COLUMNS)


def last_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir)
    recent = last("ts", "7d", datetime(2024, 1, 30))
    return df.where(between_closed(df.schema, recent)).select(*COLUMNS)


def _recent(span: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = events(spark, sf_dir)
        return df.where(between_closed(df.schema, last("ts", span, datetime(2024, 1, 20)))).select(*COLUMNS)

    return query


def term_in_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A term is sought in an array's members."""
    df = events(spark, sf_dir)
    df = df.withColumn("tags", F.array("event_type", F.concat(F.lit("u"), F.col("user_id") % 5)))
    return df.where(term(df.schema, "tags", "u3")).select(*COLUMNS)


def search_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer")
    return df.where(search_all(df.schema, "r#%12_4"))


def search_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = event_hits(spark, sf_dir)
    return hits.where(search_all(hits.schema, "SIGNUP user=1")).select("_id", "_source.message")


def query_match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(match_all()).select(*COLUMNS)


def query_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir)
    condition = bool_(
        must=[term(df.schema, "event_type", "click")],
        filter=[range_(df.schema, "ts", gte="2024-01-05", lt="2024-01-20")],
    )
    return df.where(condition).select(*COLUMNS)


BODY = {
    "size": 500,
    "sort": [{"@timestamp": "desc"}, {"_shard_doc": "desc"}],
    "track_total_hits": False,
    "_source": ["@timestamp", "message", "host.name"],
    "query": {
        "bool": {
            "must": [{"match_all": {}}],
            "filter": [
                {"term": {"host.name": "node3"}},
                {"range": {"@timestamp": {"gte": "2024-01-05", "lt": "2024-01-25"}}},
            ],
        }
    },
}


def query_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = search(event_documents(spark, sf_dir), BODY, "event_id").hits
    return hits.select("_id", "_source.`@timestamp`", "_source.message", "_source.host.name", "sort.event_id")


def view_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir).rows()


def view_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir).info()


def _view(spark: SparkSession, sf_dir: str) -> View:
    return View(
        event_hits(spark, sf_dir),
        unique="_id",
        filters=[Filter("_source.host.name", "neq", "node2")],
        time=TimeRange('_source."@timestamp"', *WEEK),
        search="click",
        sort=SortKey('_source."@timestamp"', descending=True),
        offset=200,
        limit=250,
    )


def view_default_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return View(
        number_parquet(spark, f"{sf_dir}/lineitem.parquet"),
        unique="row_id",
        filters=[Filter("l_returnflag", "eq", "R")],
        sort=SortKey("l_extendedprice"),
        limit=25,
    ).rows()


_VIEW_WHERE = """
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-17 12:30:00'
  AND user_id % 7 <> 2 AND event_type = 'click'
"""

QUERIES = {
    "filter_eq": _filter_query(Filter("user_id", "eq", "8"), "user_id = 8"),
    "filter_neq": _filter_query(Filter("event_type", "neq", "click"), "event_type != 'click'"),
    "filter_contains": _filter_query(Filter("event_type", "contains", "I%N_P"), "event_type ILIKE '%I%N_P%'"),
    "filter_contains_number": _filter_query(Filter("user_id", "contains", "4"), "CAST(user_id AS VARCHAR) ILIKE '%4%'"),
    "filter_gt": _filter_query(Filter("ts", "gt", "2024-01-20T00:00:00Z"), "ts > TIMESTAMP '2024-01-20'"),
    "filter_lt": _filter_query(Filter("value", "lt", 12.5), "value < 12.5"),
    "filter_gte": _filter_query(Filter("value", "gte", "12.5"), "value >= 12.5"),
    "filter_lte": _filter_query(Filter("user_id", "lte", 20), "user_id <= 20"),
    "filter_exists": _filter_query(Filter("event_type", "exists"), "event_type IS NOT NULL"),
    "filter_not_exists": _filter_query(Filter("event_type", "not_exists"), "event_type IS NULL"),
    "where_all": (
        filter_all,
        SPARSE_EVENTS
        + """SELECT event_id, event_type, user_id FROM sparse
        WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-17 12:30:00'
          AND event_type != 'view' AND user_id >= 10 AND value < 50.5 AND event_type IS NOT NULL
          AND (COALESCE(CAST(event_id AS VARCHAR), '') ILIKE '%7%' OR COALESCE(CAST(ts AS VARCHAR), '') ILIKE '%7%'
            OR COALESCE(CAST(user_id AS VARCHAR), '') ILIKE '%7%' OR COALESCE(event_type, '') ILIKE '%7%'
            OR COALESCE(CAST(value AS VARCHAR), '') ILIKE '%7%' OR COALESCE(props, '') ILIKE '%7%')""",
    ),
    "time_closed": (
        time_closed,
        "SELECT event_id, event_type, user_id FROM events"
        " WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-17 12:30:00'",
    ),
    "time_half_open": (
        time_half_open,
        "SELECT event_id, event_type, user_id FROM events"
        " WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'",
    ),
    "last_7d": (
        last_7d,
        "SELECT event_id, event_type, user_id FROM events"
        " WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-30'",
    ),
    **{
        f"last_{span}": (
            _recent(span),
            "SELECT event_id, event_type, user_id FROM events"
            f" WHERE ts >= TIMESTAMP '2024-01-20' - INTERVAL {interval} AND ts <= TIMESTAMP '2024-01-20'",
        )
        for span, interval in (("15m", "15 MINUTE"), ("1h", "1 HOUR"), ("24h", "24 HOUR"), ("30d", "30 DAY"))
    },
    "query_term_array": (
        term_in_array,
        "SELECT event_id, event_type, user_id FROM events WHERE user_id % 5 = 3",
    ),
    "search_all": (
        search_customers,
        """SELECT * FROM customer WHERE COALESCE(CAST(c_custkey AS VARCHAR), '') ILIKE '%r#%12_4%'
        OR COALESCE(c_name, '') ILIKE '%r#%12_4%' OR COALESCE(CAST(c_nationkey AS VARCHAR), '') ILIKE '%r#%12_4%'
        OR COALESCE(CAST(c_acctbal AS VARCHAR), '') ILIKE '%r#%12_4%' OR COALESCE(c_mktsegment, '') ILIKE '%r#%12_4%'""",
    ),
    "search_nested": (
        search_nested,
        "SELECT CAST(event_id AS VARCHAR) AS _id, event_type || ' user=' || CAST(user_id AS VARCHAR) AS message"
        " FROM events WHERE event_type || ' user=' || CAST(user_id AS VARCHAR) ILIKE '%SIGNUP user=1%'",
    ),
    "query_match_all": (query_match_all, "SELECT event_id, event_type, user_id FROM events"),
    "query_bool": (
        query_bool,
        "SELECT event_id, event_type, user_id FROM events WHERE event_type = 'click'"
        " AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'",
    ),
    "query_body": (
        query_body,
        """SELECT CAST(event_id AS VARCHAR) AS _id, ts AS "@timestamp",
               event_type || ' user=' || CAST(user_id AS VARCHAR) AS message,
               'node' || CAST(user_id % 7 AS VARCHAR) AS name, event_id
        FROM events WHERE user_id % 7 = 3 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'
        ORDER BY ts DESC, event_id DESC LIMIT 500""",
    ),
    "view_rows": (
        view_rows,
        f"""SELECT ts AS "_source_@timestamp", event_type || ' user=' || CAST(user_id AS VARCHAR) AS _source_message
        FROM events {_VIEW_WHERE} ORDER BY ts DESC, CAST(event_id AS VARCHAR) LIMIT 250 OFFSET 200""",
    ),
    "view_info": (
        view_info,
        f"""SELECT n AS total, CAST(1 AS BIGINT) AS page, CAST(ceil(n / 250.0) AS BIGINT) AS pages,
            CASE WHEN n > 0 THEN CAST(201 AS BIGINT) END AS showing_from,
            CASE WHEN n > 0 THEN least(450, n) END AS showing_to, TRUE AS has_previous, 450 < n AS has_next,
            CAST(0 AS BIGINT) AS previous_offset,
            greatest(0, least(450, greatest(0, (CAST(ceil(n / 250.0) AS BIGINT) - 1) * 250))) AS next_offset,
            greatest(0, (CAST(ceil(n / 250.0) AS BIGINT) - 1) * 250) AS last_offset
        FROM (SELECT count(*) AS n FROM events {_VIEW_WHERE})""",
    ),
    "view_default_columns": (
        view_default_columns,
        """SELECT row_id, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity
        FROM (SELECT row_number() OVER () - 1 AS row_id, * FROM lineitem)
        WHERE l_returnflag = 'R' ORDER BY l_extendedprice, row_id LIMIT 25""",
    ),
}
