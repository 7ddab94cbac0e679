"""Line-delimited JSON: raw lines, typed documents, projections and round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hitlake.functions import get_path, is_json, select_fields, source_includes, typed_text
from hitlake.operators import SortKey, extract, top_values
from hitlake.scratch import scratch_path
from hitlake.sources import (
    as_json_array,
    bad_lines,
    infer_schema,
    read_hits,
    read_lines,
    store_hits,
    write_jsonl,
    write_report,
)

from .tables import event_hits, events, hit_lines, table

FLAT = ("_id", "_source.message", "_source.host.name", "_source.k", "_source.event_id")


def flat(hits: DataFrame) -> DataFrame:
    """Every field of a hit but its place, its time to the microsecond."""
    time = F.date_format(F.col("_source.`@timestamp`"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return hits.select(*FLAT, time.alias("time"))


def path_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return events(spark, sf_dir).where(is_json(props)).select(
        "event_id",
        get_path(props, "k").alias("k"),
        get_path(props, "k.below").alias("below"),
        get_path(props, "missing").alias("missing"),
    )


def path_lookup_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = event_hits(spark, sf_dir)
    return hits.select(
        "_id",
        typed_text(hits, "_source.host.name").alias("host"),
        typed_text(hits, "_source.host").alias("object"),
        typed_text(hits, "_source.host.missing").alias("missing"),
    )


def visible_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_fields(event_hits(spark, sf_dir), ["_id", '_source."message"', "_source.host.name"])


def included_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = source_includes(event_hits(spark, sf_dir), ["host.name", "k", "missing"])
    return kept.select("_id", F.to_json("_source").alias("source"))


def typed_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(read_hits(spark, hit_lines(spark, sf_dir)))


def damaged_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line is a row, a damaged one has only NULLs."""
    hits = read_hits(spark, hit_lines(spark, sf_dir, damaged=True))
    return hits.groupBy((F.col("_id").isNull() & F.col("_source").isNull()).alias("damaged")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("_corrupt_record").alias("kept_texts"),
        F.sum("_source.k").alias("k"),
    )


def misfit_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read with a type that only some values fit: the others keep their line."""
    schema = T.StructType.fromDDL("_id string, _source struct<k: tinyint, message: string>")
    hits = read_hits(spark, hit_lines(spark, sf_dir), schema=schema)
    return hits.select("_id", "_source.k", F.col("_corrupt_record").isNotNull().alias("kept"))


def date_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days are inferred as dates and compare as such."""
    path = scratch_path(spark, "date-hits")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    write_jsonl(rows, path)
    hits = read_hits(spark, path)
    return hits.where(F.col("day") >= F.lit("1995-01-01").cast(hits.schema["day"].dataType)).select("o_orderkey", "day")


def case_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that differ only in case, stored and read back."""
    path = scratch_path(spark, "case-keys")
    line = F.format_string('{"id":%d,"User":%d,"user":"%s"}', "event_id", "user_id", "event_type")
    events(spark, sf_dir).select(line.alias("value")).write.text(path)
    schema = T.StructType.fromDDL("id bigint, User bigint").add("user", "string")
    hits = read_hits(spark, path, schema=schema).drop("_corrupt_record")
    return store_hits(hits, scratch_path(spark, "case-keys-stored")).toDF("id", "number", "name")


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad lines; each line says which one of its file it is."""
    bad = bad_lines(spark, hit_lines(spark, sf_dir, damaged=True))
    place = F.regexp_extract("value", r'"place":(\d+)', 1).cast("bigint")
    event = F.regexp_extract("value", r'"_id":"(\d+)"', 1).cast("bigint")
    return bad.select(event.alias("event_id"), (place == F.col("line_no")).alias("numbered_right"))


def stored_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = read_hits(spark, hit_lines(spark, sf_dir)).drop("_corrupt_record")
    return flat(store_hits(hits, scratch_path(spark, "stored")))


def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    documents = table(spark, sf_dir, "documents")
    write_jsonl(documents, path)
    return read_hits(spark, path, schema=documents.schema).drop("_corrupt_record")


def raw_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines pass through unchanged."""
    first = hit_lines(spark, sf_dir)
    second = scratch_path(spark, "raw")
    write_jsonl(read_lines(spark, first), second, raw=True)
    return flat(read_hits(spark, second, schema=infer_schema(spark, first)))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report whose cells hold quotes and commas, written as CSV and read back."""
    path = scratch_path(spark, "csv")
    report = extract(table(spark, sf_dir, "pages"), r"<meta [^>]+>", "html", ("url", "page_id"))
    write_report(report, path)
    return spark.read.schema(report.schema).options(header=True, escape='"', emptyValue="").csv(path)


def csv_crlf_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-crlf")
    report = extract(table(spark, sf_dir, "pages"), r"<meta [^>]+>", "html", ("url", "page_id"))
    write_report(report, path, crlf=True)
    lines = spark.read.schema(report.schema).options(escape='"', emptyValue="", lineSep="\r\n").csv(path)
    return lines.where(F.col("match") != "match")


def small_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short report as a single JSON array, taken apart again."""
    top = top_values(events(spark, sf_dir), "user_id")
    array = as_json_array(top, [SortKey("count", descending=True), SortKey("value")])
    items = F.from_json("value", "array<struct<value: string, count: bigint>>")
    return array.select(F.posexplode(items).alias("place", "item")).select("place", "item.*")


_ROWS = """SELECT CAST(event_id AS VARCHAR) AS _id, event_type || ' user=' || CAST(user_id AS VARCHAR) AS message,
    'node' || CAST(user_id % 7 AS VARCHAR) AS name, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""
_FLAT = _ROWS.replace(" FROM events", ", event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time FROM events")
_META = """SELECT DISTINCT unnest(regexp_extract_all(html, '<meta [^>]+>')) AS match, url,
    CAST(page_id AS VARCHAR) AS page_id FROM pages"""

QUERIES = {
    "read_hits_misfit": (
        misfit_hits,
        f"SELECT _id, CASE WHEN k BETWEEN -128 AND 127 THEN CAST(k AS TINYINT) END AS k, k NOT BETWEEN -128 AND 127 AS kept FROM ({_ROWS})",
    ),
    "read_hits_dates": (
        date_hits,
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1995-01-01'",
    ),
    "read_hits_case_keys": (case_hits, "SELECT event_id AS id, user_id AS number, event_type AS name FROM events"),
    "path_lookup": (
        path_lookup,
        "SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS below,"
        " json_extract_string(props, '$.missing') AS missing FROM events",
    ),
    "path_lookup_typed": (
        path_lookup_typed,
        "SELECT CAST(event_id AS VARCHAR) AS _id, 'node' || CAST(user_id % 7 AS VARCHAR) AS host,"
        """ '{"name":"node' || CAST(user_id % 7 AS VARCHAR) || '"}' AS object, CAST(NULL AS VARCHAR) AS missing"""
        " FROM events",
    ),
    "select_fields": (
        visible_fields,
        "SELECT CAST(event_id AS VARCHAR) AS _id, event_type || ' user=' || CAST(user_id AS VARCHAR)"
        " AS _source_message, 'node' || CAST(user_id % 7 AS VARCHAR) AS _source_host_name FROM events",
    ),
    "source_includes": (
        included_fields,
        """SELECT CAST(event_id AS VARCHAR) AS _id, '{"host":{"name":"node' || CAST(user_id % 7 AS VARCHAR)
        || '"},"k":' || json_extract_string(props, '$.k') || '}' AS source FROM events""",
    ),
    "read_hits": (typed_hits, _FLAT),
    "read_hits_damaged": (
        damaged_hits,
        """SELECT damaged, count(*) AS lines, count(*) FILTER (damaged) AS kept_texts,
            CAST(sum(k) FILTER (NOT damaged) AS BIGINT) AS k
        FROM (SELECT event_type IN ('error', 'purchase') AS damaged,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1""",
    ),
    "bad_lines": (
        damaged_lines,
        "SELECT event_id, TRUE AS numbered_right FROM events WHERE event_type IN ('error', 'purchase')",
    ),
    "store_hits": (stored_hits, _FLAT),
    "write_jsonl": (jsonl_round_trip, "SELECT * FROM documents"),
    "write_raw_lines": (raw_round_trip, _FLAT),
    "write_csv": (csv_round_trip, _META),
    "write_csv_crlf": (csv_crlf_round_trip, _META),
    "as_json_array": (
        small_array,
        "SELECT CAST(row_number() OVER (ORDER BY count DESC, value) - 1 AS INTEGER) AS place, value, count"
        " FROM (SELECT CAST(user_id AS VARCHAR) AS value, count(*) AS count FROM events GROUP BY 1)"
        " ORDER BY 1 LIMIT 10",
    ),
}
