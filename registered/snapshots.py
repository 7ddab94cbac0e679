"""Named snapshots: repeated exports, clustered storage, footers, early counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitlake.functions import describe_schema
from hitlake.operators import Filter, TimeRange, filter_column, merge_sketches, profile, sketch_fields, value_counts
from hitlake.operators.sketches import ERROR
from hitlake.plans import export
from hitlake.scratch import scratch_path
from hitlake.sources import (
    Snapshot,
    files_with,
    footer_bounds,
    index_substrings,
    open_snapshot,
    read_documents,
    search_indexed,
    store_documents,
    store_hits,
    take_snapshot,
    variant_fields,
    variant_schema,
)

from .profiles import range_sql
from .tables import event_documents, events, hit_lines, lines_in_order, table

BODY = {"query": {"term": {"host.name": "node5"}}}


def many_files(spark: SparkSession, df: DataFrame, files: int = 24) -> str:
    """A folder with the rows in so many files."""
    path = scratch_path(spark, "many-files")
    df.repartition(files).write.parquet(path)
    return path


def snapshot_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export of a snapshot, and a second one by its name after the table has got all its rows once more.

    One row per line of either; ``times`` is 2 for lines that both have at the same place.
    """
    documents = event_documents(spark, sf_dir)
    path, root = many_files(spark, documents), scratch_path(spark, "snapshots")
    outputs = [scratch_path(spark, "snapshot-export") for _ in range(2)]
    export(take_snapshot(spark, path, root, "january").rows(), BODY, "event_id").write(outputs[0])
    documents.write.mode("append").parquet(path)
    export(open_snapshot(spark, root, "january").rows(), BODY, "event_id").write(outputs[1])
    first, second = (lines_in_order(spark.read.text(output)) for output in outputs)
    both = first.unionByName(second).groupBy("line", "value").agg(F.count(F.lit(1)).alias("times"))
    return both.select("line", F.get_json_object("value", "$._id").alias("_id"), F.get_json_object("value", "$._source.message").alias("message"), "times")


def event_snapshot(spark: SparkSession, sf_dir: str) -> Snapshot:
    """A snapshot of the events, clustered by time."""
    path = scratch_path(spark, "clustered")
    store_hits(events(spark, sf_dir), path, cluster_by="ts")
    return take_snapshot(spark, path, scratch_path(spark, "snapshots"), "events", ["ts", "event_id"])


def clustered_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of clustered events, and the share of the files that had to be opened."""
    snapshot = event_snapshot(spark, sf_dir)
    time = TimeRange("ts", "2024-01-12T00:00:00", "2024-01-13T12:00:00")
    few = len(snapshot.files_between(time)) * 8 <= len(snapshot.files)
    return snapshot.between(time).select("event_id", "ts", F.lit(few).alias("few_files"))


def date_range_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time span and rows of the events from a manifest."""
    snapshot = event_snapshot(spark, sf_dir)
    return snapshot.date_range("ts").crossJoin(snapshot.count())  # a row each


def order_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footer_bounds(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_custkey"])


def early_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits counted until they are more than a thousand, and whether that left files unread."""
    snapshot = take_snapshot(spark, many_files(spark, table(spark, sf_dir, "lineitem"), 64), scratch_path(spark, "snapshots"), "items")
    condition = lambda schema: filter_column(schema, Filter("l_returnflag", "eq", "R"))
    _, files = snapshot.count_until(condition, 100)
    return snapshot.total_hits(condition, 100).withColumn("files_left", F.lit(files < len(snapshot.files)))


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's number in a snapshot, from the manifest, and the row that is found by that number again."""
    path = scratch_path(spark, "numbered")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    orders.repartitionByRange(8, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    snapshot = take_snapshot(spark, path, scratch_path(spark, "snapshots"), "orders")
    found = snapshot.row_by_id(777).select(F.lit(777).alias("row_id"), F.col("o_orderkey").alias("found"))
    return snapshot.number().join(found, "row_id", "left")


def search_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a rare word, by the substring index, and whether it spared files."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rare = F.when(F.col("doc_id") % 100 == 7, F.concat("text", F.lit(" Quxzyplonk"))).otherwise(F.col("text"))
    path = scratch_path(spark, "by-id")
    documents.withColumn("text", rare).repartitionByRange(16, F.col("doc_id") % 100).write.parquet(path)
    snapshot = take_snapshot(spark, path, scratch_path(spark, "snapshots"), "documents")
    index_substrings(snapshot)
    spared = len(files_with(snapshot, "quxzyPLON%")) < len(snapshot.files)
    return search_indexed(snapshot, "quxzyPLON%").select("doc_id", "lang", F.lit(spared).alias("spared"))


def variant_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths into hits stored as VARIANT; damaged lines are kept as they are."""
    stored = store_documents(read_documents(spark, hit_lines(spark, sf_dir, damaged=True)), scratch_path(spark, "variants"))
    paths = {"id": "_id", "host": "_source.host.name", "object": "_source.host", "k": "_source.k", "missing": "_source.k.x"}
    texts = [text.alias(name) for name, text in zip(paths, variant_fields(F.col("document"), list(paths.values())))]
    return stored.select(*texts, F.col("_corrupt_record").isNotNull().alias("corrupt"))


def schema_of_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema of hits in one pass over their variants."""
    schema = variant_schema(read_documents(spark, hit_lines(spark, sf_dir)))
    return describe_schema(spark.createDataFrame([], schema))


def profile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile merged from sketches of each day, held against the exact one.

    ``near``: distinct values within the stated error; ``recall``: the rows of the ten values found are at
    least nine tenths of those of the ten most frequent.
    """
    df = events(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    sketch_fields(df, [F.to_date("ts").alias("day")]).write.parquet(path)
    merged = merge_sketches(spark.read.parquet(path), rows=df)
    counts = value_counts(df)
    exact = profile(df)
    found = merged.select("field", F.explode("top.value").alias("value")).join(counts, ["field", "value"])
    held = found.groupBy("field").agg(F.sum("count").alias("held"))
    best = exact.groupBy("field", F.col("unique_count").alias("exact_count")).agg(F.sum("count").alias("best"))
    joined = merged.join(held, "field").join(best, "field")
    near = F.abs(F.col("unique_count") - F.col("exact_count")) <= ERROR * F.col("exact_count") + 1
    return joined.select("field", "type", "rows", "null_count", near.alias("near"), (F.col("held") >= 0.9 * F.col("best")).alias("recall"))


QUERIES = {
    "snapshot_export": (
        snapshot_export,
        """SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS line, CAST(event_id AS VARCHAR) AS _id, event_type || ' user=' || CAST(user_id AS VARCHAR) AS message,
            CAST(2 AS BIGINT) AS times FROM events WHERE user_id % 7 = 5""",
    ),
    "clustered_range": (
        clustered_range,
        "SELECT event_id, ts, TRUE AS few_files FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-12' AND TIMESTAMP '2024-01-13 12:00:00'",
    ),
    "date_range_footers": (
        date_range_footers,
        f"SELECT oldest, newest, span, (SELECT count(*) FROM events) AS total FROM ({range_sql()})",
    ),
    "footer_bounds": (
        order_footers,
        """SELECT 'o_orderkey' AS field, count(*) AS total, CAST(min(o_orderkey) AS VARCHAR) AS min, CAST(max(o_orderkey) AS VARCHAR) AS max FROM orders
        UNION ALL SELECT 'o_custkey', count(*), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders""",
    ),
    "total_hits_early": (
        early_total,
        """SELECT least(count(*), 100) AS value, CASE WHEN count(*) > 100 THEN 'gte' ELSE 'eq' END AS relation, TRUE AS files_left
        FROM lineitem WHERE l_returnflag = 'R'""",
    ),
    "search_indexed": (
        search_by_index,
        "SELECT doc_id, lang, TRUE AS spared FROM documents WHERE doc_id % 100 = 7",
    ),
    "variant_lookup": (
        variant_lookup,
        """SELECT CASE WHEN good THEN CAST(event_id AS VARCHAR) END AS id, CASE WHEN good THEN 'node' || user_id % 7 END AS host,
            CASE WHEN good THEN '{"name":"node' || user_id % 7 || '"}' END AS object,
            CASE WHEN good THEN json_extract_string(props, '$.k') END AS k, CAST(NULL AS VARCHAR) AS missing, NOT good AS corrupt
        FROM (SELECT *, event_type NOT IN ('error', 'purchase') AS good FROM events)""",
    ),
    "variant_schema": (
        schema_of_variants,
        """SELECT * FROM (VALUES ('_id', 'VARCHAR', TRUE), ('place', 'BIGINT', TRUE), ('_source',
            'STRUCT("@timestamp" VARCHAR, event_id BIGINT, host STRUCT(name VARCHAR), k BIGINT, message VARCHAR)', TRUE)) AS v(name, type, nullable)""",
    ),
    "profile_sketch": (
        profile_sketch,
        """SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS field,
            unnest(['i64', 'time', 'i64', 'str', 'f64', 'str']) AS type, n AS rows, CAST(0 AS BIGINT) AS null_count, TRUE AS near, TRUE AS recall
        FROM (SELECT count(*) AS n FROM events)""",
    ),
    "snapshot_rows": (
        snapshot_rows,
        """SELECT row_id, o_orderkey, o_totalprice, CASE WHEN row_id = 777 THEN o_orderkey END AS found
        FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, o_orderkey, o_totalprice FROM orders)""",
    ),
}
