"""Order, pages, seeking, numbering and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitlake.operators import (
    SortKey,
    keyset_after,
    keyset_page,
    number_ordered,
    number_pages,
    number_parquet,
    page,
    page_info,
    page_select,
    row_by_id,
    row_count,
    row_detail,
    size,
    sort_by,
    total_hits,
)
from hitlake.plans import export, search
from hitlake.scratch import scratch_path
from hitlake.sources import infer_schema, read_hits, write_json_array

from .tables import SPARSE_EVENTS, event_documents, events, lines_in_order, sparse_events, table

BY_TYPE = [SortKey("event_type", descending=True), SortKey("event_id")]
BY_TIME = [SortKey("ts"), SortKey("event_id")]
COLUMNS = ("event_id", "ts", "event_type")
EXPORT_BODY = {"query": {"term": {"host.name": "node5"}}, "size": 7}


def sort_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sort_by(sparse_events(spark, sf_dir), "event_type", "desc", unique="event_id").select(*COLUMNS)


def page_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page(sparse_events(spark, sf_dir), BY_TYPE, offset=200, limit=100, unique="event_id").select(*COLUMNS)


def page_of_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that starts with the last row before the NULLs."""
    df = sparse_events(spark, sf_dir)
    keys = [SortKey("event_type"), SortKey("event_id")]
    return keyset_page(df, keys, ("view", None), 100).select(*COLUMNS)


def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page so far in that a top-k would hold most of the table."""
    keys = [SortKey("o_orderstatus", descending=True), SortKey("o_orderkey")]
    return page(table(spark, sf_dir, "orders"), keys, offset=10_000, limit=500)


def selected_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last page but some thousand rows, found without a sort of the table."""
    items = table(spark, sf_dir, "lineitem").withColumn("item", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    keys = [SortKey("l_shipdate", descending=True), SortKey("l_quantity")]
    offset = items.count() * 5 // 6
    return page_select(items, keys, offset, 400, unique="item", sorted_rows=5_000).select("l_shipdate", "l_quantity", "item")


def deep_page_of_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page far into one value of a key that is not total; the other columns settle the order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return page(orders, [SortKey("o_orderstatus")], offset=10_000, limit=500)


def sort_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in a sort."""
    df = sparse_events(spark, sf_dir).select(*COLUMNS)
    return number_ordered(sort_by(df, "event_type", "desc", unique="event_id"))


def export_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every hit in an export."""
    job = export(event_documents(spark, sf_dir), EXPORT_BODY, "event_id")
    return number_ordered(job.hits().select("_id"))


def count_capped_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_hits(table(spark, sf_dir, "lineitem"), cap=150_000)


def count_untracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_hits(events(spark, sf_dir), track=False)


def search_no_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search that names no size gives all its hits."""
    body = {"query": {"term": {"host.name": "node5"}}, "sort": [{"@timestamp": "desc"}]}
    return search(event_documents(spark, sf_dir), body, "event_id").hits.select("_id", "_source.message")


def whole_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event in one JSON array whose part files are partly empty: its lines in order, each checked where it lies.

    Lines are a bracket, objects with one comma between two of them, a bracket. ``ok`` tells that
    what stands before a line, with the line before it, is what its place asks for.
    """
    path = scratch_path(spark, "array-whole")
    rows = events(spark, sf_dir).select("event_id", "user_id")
    few = F.col("event_id") % 3  # a range per value, of more ranges: the others stay empty
    write_json_array(rows.repartitionByRange(9, few).sortWithinPartitions(few, "event_id"), path)
    lines = lines_in_order(spark.read.text(path)).select("line", "value")
    before = lines.select((F.col("line") + 1).alias("line"), F.col("value").alias("before"))
    row = F.from_json(F.regexp_replace("value", "^,", ""), "event_id bigint, user_id bigint", {"mode": "FAILFAST"})
    paired = lines.join(before, "line", "left").where("value <> ','")
    comma = F.col("value").startswith(",").cast("int") + (F.col("before") == ",").cast("int")
    shape = (
        F.when(F.col("before").isNull(), F.col("value") == "[")
        .when(F.col("value") == "]", F.col("before").endswith("}"))
        .otherwise(comma == F.when(F.col("before") == "[", 0).otherwise(1))
    )
    inside = ~F.col("value").isin("[", "]")
    return paired.select(shape.alias("ok"), F.when(inside, row).alias("r")).select("ok", "r.*")


def page_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_info(row_count(events(spark, sf_dir)), 300, 100)


def first_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return size(events(spark, sf_dir), BY_TIME, 40).select(*COLUMNS)


def keyset_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyset_page(events(spark, sf_dir), BY_TIME, ("2024-01-10T00:00:00", 3000), 1000).select(*COLUMNS)


def keyset_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows after one inside a value of a descending key, NULLs behind the last value included."""
    df = sparse_events(spark, sf_dir)
    return df.where(keyset_after(df, BY_TYPE, ("click", 100))).select(*COLUMNS)


def count_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_hits(events(spark, sf_dir))


def count_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_hits(events(spark, sf_dir), cap=5000)


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [SortKey("o_orderdate", descending=True), SortKey("o_orderkey")]
    return number_pages(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), keys)


def status_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers along a key with three values, each a third of the table."""
    keys = [SortKey("o_orderstatus"), SortKey("o_orderkey", descending=True)]
    return number_pages(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), keys, 250)


def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_parquet(spark, f"{sf_dir}/orders.parquet").select("row_id", "o_orderkey", "o_totalprice")


def one_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_by_id(spark, f"{sf_dir}/orders.parquet", 1234)


def one_row_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = row_detail(row_by_id(spark, f"{sf_dir}/documents.parquet", 123))
    whole = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return detail.select(F.from_json("detail", whole).alias("d")).select("d.*")


def export_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = export(event_documents(spark, sf_dir), EXPORT_BODY, "event_id", "2024-01-03", "2024-01-20")
    return job.hits().select("_id", "_source.`@timestamp`", "_source.message", "sort.event_id")


def export_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export written as JSON lines and read back."""
    path = scratch_path(spark, "export")
    export(event_documents(spark, sf_dir), EXPORT_BODY, "event_id", "2024-01-03", "2024-01-20").write(path)
    hits = read_hits(spark, path, schema=infer_schema(spark, path))
    stamp = F.col("_source.`@timestamp`")
    return hits.select(
        "_id", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time"), "_source.message", "sort.event_id"
    )


def export_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export written as one JSON array; its lines read back without the array's own marks."""
    path = scratch_path(spark, "export-array")
    job = export(event_documents(spark, sf_dir), EXPORT_BODY, "event_id", "2024-01-03", "2024-01-20")
    job.write(path, "json")
    lines = spark.read.text(path).where(~F.col("value").isin("[", "]", ","))
    hit = F.from_json(F.regexp_replace("value", "^,", ""), "_id string, _source struct<message: string, k: bigint>")
    return lines.select(hit.alias("hit")).select("hit._id", "hit._source.*")


def export_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = {"query": {"match_all": {}}}
    job = export(event_documents(spark, sf_dir), body, "event_id", page_size=300)
    return job.pages().select("row_no", "page", "event_id")


_EXPORTED = "FROM events WHERE user_id % 7 = 5 AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20'"
_MESSAGE = "event_type || ' user=' || CAST(user_id AS VARCHAR) AS message"

QUERIES = {
    "sort_nulls_last": (
        sort_nulls_last,
        SPARSE_EVENTS
        + "SELECT event_id, ts, event_type FROM sparse ORDER BY event_type DESC NULLS LAST, event_id",
    ),
    "page_3": (
        page_3,
        SPARSE_EVENTS + "SELECT event_id, ts, event_type FROM sparse"
        " ORDER BY event_type DESC NULLS LAST, event_id LIMIT 100 OFFSET 200",
    ),
    "page_of_nulls": (
        page_of_nulls,
        SPARSE_EVENTS + "SELECT event_id, ts, event_type FROM sparse WHERE event_type > 'view' OR event_type IS NULL"
        " ORDER BY event_type NULLS LAST, event_id LIMIT 100",
    ),
    "page_deep": (
        deep_page,
        "SELECT * FROM orders ORDER BY o_orderstatus DESC, o_orderkey LIMIT 500 OFFSET 10000",
    ),
    "page_select": (
        selected_page,
        "SELECT l_shipdate, l_quantity, l_orderkey * 10 + l_linenumber AS item FROM lineitem ORDER BY l_shipdate DESC NULLS LAST,"
        " l_quantity NULLS LAST, item LIMIT 400 OFFSET (SELECT count(*) * 5 // 6 FROM lineitem)",
    ),
    "page_deep_ties": (
        deep_page_of_ties,
        "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderstatus, o_orderkey LIMIT 500 OFFSET 10000",
    ),
    "sort_order": (
        sort_order,
        SPARSE_EVENTS + "SELECT row_number() OVER (ORDER BY event_type DESC NULLS LAST, event_id) AS row_no,"
        " event_id, ts, event_type FROM sparse",
    ),
    "export_order": (
        export_ordered,
        "SELECT row_number() OVER (ORDER BY ts, event_id) AS row_no, CAST(event_id AS VARCHAR) AS _id"
        " FROM events WHERE user_id % 7 = 5",
    ),
    "total_hits_capped_high": (
        count_capped_high,
        "SELECT CAST(least(count(*), 150000) AS BIGINT) AS value,"
        " CASE WHEN count(*) > 150000 THEN 'gte' ELSE 'eq' END AS relation FROM lineitem",
    ),
    "total_hits_untracked": (
        count_untracked,
        "SELECT count(*) AS value, 'eq' AS relation FROM events WHERE FALSE",
    ),
    "search_no_size": (
        search_no_size,
        f"SELECT CAST(event_id AS VARCHAR) AS _id, {_MESSAGE} FROM events WHERE user_id % 7 = 5",
    ),
    "json_array_filtered": (
        whole_array,
        "SELECT TRUE AS ok, event_id, user_id FROM events UNION ALL SELECT TRUE, NULL, unnest([NULL, NULL]::BIGINT[])",
    ),
    "page_info": (
        page_position,
        """SELECT n AS total, CAST(4 AS BIGINT) AS page, p AS pages, CAST(301 AS BIGINT) AS showing_from,
            least(400, n) AS showing_to, TRUE AS has_previous, 400 < n AS has_next,
            CAST(200 AS BIGINT) AS previous_offset, greatest(0, least(400, greatest(0, (p - 1) * 100))) AS next_offset,
            greatest(0, (p - 1) * 100) AS last_offset
        FROM (SELECT count(*) AS n, CAST(ceil(count(*) / 100.0) AS BIGINT) AS p FROM events)""",
    ),
    "first_hits": (first_hits, "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 40"),
    "keyset_page": (
        keyset_time,
        "SELECT event_id, ts, event_type FROM events WHERE (ts, event_id) > (TIMESTAMP '2024-01-10', 3000)"
        " ORDER BY ts, event_id LIMIT 1000",
    ),
    "keyset_nulls_last": (
        keyset_type,
        SPARSE_EVENTS + "SELECT event_id, ts, event_type FROM sparse"
        " WHERE event_type < 'click' OR (event_type = 'click' AND event_id > 100) OR event_type IS NULL",
    ),
    "total_hits": (count_exact, "SELECT count(*) AS value, 'eq' AS relation FROM events"),
    "total_hits_capped": (
        count_capped,
        "SELECT CAST(least(count(*), 5000) AS BIGINT) AS value,"
        " CASE WHEN count(*) > 5000 THEN 'gte' ELSE 'eq' END AS relation FROM events",
    ),
    "number_pages": (
        order_pages,
        "SELECT row_no, (row_no - 1) // 1000 + 1 AS page, o_orderkey, o_orderdate FROM (SELECT *,"
        " row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS row_no FROM orders)",
    ),
    "number_pages_hot_key": (
        status_pages,
        "SELECT row_no, (row_no - 1) // 250 + 1 AS page, o_orderkey, o_orderstatus FROM (SELECT *,"
        " row_number() OVER (ORDER BY o_orderstatus, o_orderkey DESC) AS row_no FROM orders)",
    ),
    "row_ids": (row_ids, "SELECT row_number() OVER () - 1 AS row_id, o_orderkey, o_totalprice FROM orders"),
    "row_by_id": (one_row, "SELECT * FROM orders LIMIT 1 OFFSET 1234"),
    "row_detail": (one_row_detail, "SELECT doc_id, text, lang, source, CAST(n_chars AS BIGINT) AS n_chars FROM documents LIMIT 1 OFFSET 123"),
    "export_hits": (
        export_hits,
        f'SELECT CAST(event_id AS VARCHAR) AS _id, ts AS "@timestamp", {_MESSAGE}, event_id {_EXPORTED}',
    ),
    "export_file": (
        export_file,
        "SELECT CAST(event_id AS VARCHAR) AS _id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time,"
        f" {_MESSAGE}, event_id {_EXPORTED}",
    ),
    "export_json_array": (
        export_array,
        f"SELECT CAST(event_id AS VARCHAR) AS _id, {_MESSAGE},"
        f" CAST(json_extract_string(props, '$.k') AS BIGINT) AS k {_EXPORTED}",
    ),
    "export_pages": (
        export_pages,
        "SELECT row_no, (row_no - 1) // 300 + 1 AS page, event_id FROM (SELECT event_id,"
        " row_number() OVER (ORDER BY ts, event_id) AS row_no FROM events)",
    ),
}
