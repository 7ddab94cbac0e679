"""Datasets, aliases and reports about them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hitlake.operators import SortKey, number_pages
from hitlake.plans import export
from hitlake.scratch import scratch_path
from hitlake.sources import (
    Catalog,
    Dataset,
    Member,
    aliases,
    dataset_schema,
    describe_alias,
    describe_dataset,
    inventory,
    read_alias,
    read_hits,
)

from .tables import hit_lines

# The given tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def catalog(sf_dir: str) -> Catalog:
    datasets = {name: Dataset(f"{sf_dir}/{name}.parquet") for name in TABLES}
    return Catalog(
        datasets,
        {
            "parties": [
                Member("customer", {"term": {"c_mktsegment": "BUILDING"}}),
                Member("supplier"),
            ],
            "activity": [
                Member("events"),
                Member("clicks", {"bool": {"filter": [{"term": {"event_type": "click"}}]}}),
            ],
            "texts": [Member("documents"), Member("pages"), Member("conversations")],
        },
    )


def activity(sf_dir: str) -> Catalog:
    """The events under two names, so that one can carry a filter."""
    given = catalog(sf_dir)
    return Catalog({**given.datasets, "clicks": given.datasets["events"]}, given.aliases)


def alias_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_alias(spark, catalog(sf_dir), "parties")
    return rows.select("_index", "c_custkey", "c_name", "s_suppkey", "s_name")


def alias_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alias of sixty datasets in folders of their own, some narrowed by one of three filters, and one that names another's folder."""
    path = scratch_path(spark, "many")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.withColumn("shard", F.col("event_id") % 60).write.partitionBy("shard").parquet(path)
    shards = {f"shard-{n:02}": Dataset(f"{path}/shard={n}") for n in range(60)}
    filters = [None, {"term": {"event_type": "click"}}, {"range": {"event_id": {"gte": 500, "lt": 5000}}}, {"term": {"event_type": "view"}}]
    many = [Member(name, filters[n % 4]) for n, name in enumerate(shards)]
    given = Catalog({**shards, "again": shards["shard-07"]}, {"many": [*many, Member("again")]})
    return read_alias(spark, given, "many").select("_index", "event_id", "ts", "event_type")


def pattern_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_alias(spark, catalog(sf_dir), "*ion")
    return rows.select("_index", "n_nationkey", "n_regionkey", "r_name")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of aliases with their document counts."""
    given = activity(sf_dir)
    listed = aliases(spark, given, "*t*")
    counted = inventory(spark, given).select("index", "docs")
    return listed.join(counted, "index", "left")


def alias_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = describe_alias(spark, activity(sf_dir), "activity", "ts")
    return report.withColumn("has_facts", (F.col("bytes") > 0) & F.col("created").isNotNull()).drop("bytes", "created")


def alias_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages over an alias, whose rows name their dataset in ``_index``."""
    rows = read_alias(spark, activity(sf_dir), "activity").select("_index", "event_id", "ts")
    return number_pages(rows, [SortKey("ts"), SortKey("event_id"), SortKey("_index")], 300)


def export_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alias exported as JSON lines and read back."""
    path = scratch_path(spark, "export-alias")
    rows = read_alias(spark, activity(sf_dir), "activity")
    rows = rows.withColumn("id", F.concat_ws("/", "_index", "event_id")).select("id", "_index", "event_type", "ts")
    export(rows, {"query": {"match_all": {}}}, "id", time_field="ts").write(path)
    schema = T.StructType.fromDDL("_id string, _source struct<_index: string, event_type: string>")
    return read_hits(spark, path, schema=schema).select("_id", "_source.*")


def dataset_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_dataset(spark, catalog(sf_dir), "events", "ts").drop("bytes", "created")


def columns_of_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_schema(spark, catalog(sf_dir), "customer")


def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(spark, catalog(sf_dir)).select("index", "docs", "files")


def matching_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = inventory(spark, catalog(sf_dir), "*o*s", sort="docs", descending=True)
    return listed.select("index", "docs", (F.col("bytes") > 0).alias("has_bytes"), F.col("created").isNotNull().alias("has_time"))


def json_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = Catalog({"hits": Dataset(hit_lines(spark, sf_dir), "json")})
    return inventory(spark, given).select("index", "docs")


_COUNTS = " UNION ALL ".join(f"SELECT '{name}' AS index, count(*) AS docs FROM {name}" for name in TABLES)
_ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"

_ACTIVITY = """(SELECT 'events' AS _index, * FROM events
    UNION ALL SELECT 'clicks', * FROM events WHERE event_type = 'click')"""

QUERIES = {
    "alias_union": (
        alias_union,
        "SELECT 'customer' AS _index, c_custkey, c_name, NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name"
        " FROM customer WHERE c_mktsegment = 'BUILDING'"
        " UNION ALL SELECT 'supplier', NULL, NULL, s_suppkey, s_name FROM supplier",
    ),
    "alias_many": (
        alias_many,
        """SELECT printf('shard-%02d', event_id % 60) AS _index, event_id, ts, event_type FROM events
        WHERE CASE event_id % 60 % 4 WHEN 0 THEN TRUE WHEN 1 THEN event_type = 'click' WHEN 2 THEN event_id >= 500 AND event_id < 5000
            ELSE event_type = 'view' END
        UNION ALL SELECT 'again', event_id, ts, event_type FROM events WHERE event_id % 60 = 7""",
    ),
    "pattern_union": (
        pattern_union,
        "SELECT 'nation' AS _index, n_nationkey, n_regionkey, NULL::VARCHAR AS r_name FROM nation"
        " UNION ALL SELECT 'region', NULL, NULL, r_name FROM region",
    ),
    "alias_members": (
        members,
        f"""WITH counts AS ({_COUNTS}), listed AS (SELECT * FROM (VALUES
            ('parties', 'customer', '*'), ('parties', 'supplier', '-'), ('activity', 'events', '-'),
            ('activity', 'clicks', '*'), ('texts', 'documents', '-'), ('texts', 'pages', '-'),
            ('texts', 'conversations', '-')) AS v(alias, index, filter))
        SELECT index, alias, filter, docs FROM listed
        JOIN (FROM counts UNION ALL SELECT 'clicks', count(*) FROM events) USING (index) WHERE alias LIKE '%t%'""",
    ),
    "describe_alias": (
        alias_report,
        f"""WITH members AS (SELECT 'events' AS index, ts FROM events
            UNION ALL SELECT 'clicks', ts FROM events WHERE event_type = 'click')
        SELECT index, count(*) AS docs, strftime(min(ts), {_ISO}) AS member_oldest,
            strftime(max(ts), {_ISO}) AS member_newest,
            CAST(date_diff('microsecond', min(ts), max(ts)) // 86400000000 AS VARCHAR) || ' days' AS member_span,
            CAST(1 AS BIGINT) AS files, TRUE AS has_facts,
            CAST(2 AS BIGINT) AS members,
            (SELECT strftime(min(ts), {_ISO}) FROM members) AS oldest,
            (SELECT strftime(max(ts), {_ISO}) FROM members) AS newest,
            (SELECT CAST(date_diff('microsecond', min(ts), max(ts)) // 86400000000 AS VARCHAR) || ' days'
             FROM members) AS span
        FROM members GROUP BY index""",
    ),
    "describe_dataset": (
        dataset_report,
        f"""SELECT 'events' AS index, count(*) AS docs, strftime(min(ts), {_ISO}) AS oldest,
            strftime(max(ts), {_ISO}) AS newest,
            CAST(date_diff('microsecond', min(ts), max(ts)) // 86400000000 AS VARCHAR) || ' days' AS span,
            CAST(1 AS BIGINT) AS files
        FROM events""",
    ),
    "alias_pages": (
        alias_pages,
        f"""SELECT row_no, (row_no - 1) // 300 + 1 AS page, _index, event_id, ts FROM (
            SELECT *, row_number() OVER (ORDER BY ts, event_id, _index) AS row_no FROM {_ACTIVITY})""",
    ),
    "export_alias": (
        export_alias,
        f"SELECT _index || '/' || event_id AS _id, _index, event_type FROM {_ACTIVITY}",
    ),
    "dataset_schema": (
        columns_of_dataset,
        "SELECT column_name AS name, column_type AS type, \"null\" = 'YES' AS nullable FROM (DESCRIBE customer)",
    ),
    "inventory": (table_inventory, f"SELECT index, docs, CAST(1 AS BIGINT) AS files FROM ({_COUNTS})"),
    "inventory_like": (
        matching_inventory,
        f"SELECT index, docs, TRUE AS has_bytes, TRUE AS has_time FROM ({_COUNTS}) WHERE index LIKE '%o%s'",
    ),
    "inventory_json": (json_inventory, "SELECT 'hits' AS index, count(*) AS docs FROM events"),
}
