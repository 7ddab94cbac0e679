"""Snapshots, clustered storage, selection of deep pages, footers."""

import datetime as dt
import random

import pytest
from plans import plan
from pyspark.sql import functions as F, types as T

from hitlake.operators import Filter, SortKey, TimeRange, filter_column, number_pages, page, page_select, total_hits
from hitlake.sources import footer_bounds, open_snapshot, store_hits, take_snapshot


@pytest.fixture
def days(spark, tmp_path):
    """Thirty days of hits, two a minute, clustered by time; a third of them share one second, some have no time."""
    rows = spark.range(30 * 1440 * 2).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-03-15T12:00:00Z").cast("timestamp"))
        .when(F.col("id") % 1000 != 1, F.timestamp_seconds(F.lit(1709251200) + F.col("id") * 30))
        .alias("at"),
        F.lit("own").alias("day"),
    )
    path = str(tmp_path / "hits")
    stored = store_hits(rows, path, cluster_by="at")
    return path, stored, rows


def jobs(spark, group, call):
    """How many jobs ``call`` runs."""
    spark.sparkContext.setJobGroup(group, group)
    result = call()
    spark.sparkContext.setJobGroup("others", "others")
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_clustered_rows_are_all_there(days):
    path, stored, rows = days
    assert stored.columns == rows.columns and stored.exceptAll(rows).count() == 0 and stored.count() == rows.count()


def test_a_day_opens_few_files(spark, days, tmp_path):
    path, _, rows = days
    snapshot = take_snapshot(spark, path, str(tmp_path), "days", ["at"])
    time = TimeRange("at", "2024-03-05T00:00:00", "2024-03-05T23:59:59")
    opened = snapshot.files_between(time)
    assert 0 < len(opened) and len(opened) * 20 <= len(snapshot.files)
    found = snapshot.between(time)
    assert sorted(r.id for r in found.collect()) == sorted(
        r.id for r in rows.where("at >= '2024-03-05T00:00:00Z' AND at <= '2024-03-05T23:59:59Z'").collect()
    )
    assert len(found.inputFiles()) == len(opened)
    assert snapshot.between(TimeRange("at", None, None)).count() == rows.count()
    assert snapshot.between(TimeRange("at", "2030-01-01T00:00:00", None)).count() == 0
    half = snapshot.between(TimeRange("at", "2024-03-15T12:00:00", "2024-03-15T12:00:01"), half_open=True)
    assert half.count() == rows.where("at = '2024-03-15T12:00:00Z'").count()
    with pytest.raises(ValueError):
        snapshot.between(TimeRange("id", 1, 2))


def test_snapshot_keeps_its_files(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(100).repartition(4).write.parquet(path)
    snapshot = take_snapshot(spark, path, str(tmp_path), "first")
    spark.range(100, 150).write.mode("append").parquet(path)
    again = open_snapshot(spark.newSession(), str(tmp_path), "first")
    assert sorted(r.id for r in again.rows().collect()) == list(range(100)) and again.schema == snapshot.schema
    assert spark.read.parquet(path).count() == 150 and again.count().first().total == 100
    with pytest.raises(Exception):
        take_snapshot(spark, path, str(tmp_path), "first")


def test_numbers_come_from_the_manifest(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(1000).repartition(5).write.parquet(path)
    snapshot = take_snapshot(spark, path, str(tmp_path), "numbered")
    numbered, n_jobs = jobs(spark, "number", snapshot.number)
    assert n_jobs <= 1  # the list of files, from the manifest
    by_number = {r.row_id: r.id for r in numbered.collect()}
    assert sorted(by_number) == list(range(1000)) and sorted(by_number.values()) == list(range(1000))
    for n in (0, 1, 500, 999):
        row, n_jobs = jobs(spark, f"row {n}", lambda: snapshot.row_by_id(n))
        assert n_jobs <= 1 and [r.id for r in row.collect()] == [by_number[n]] and len(row.inputFiles()) == 1
    assert snapshot.row_by_id(1000).count() == 0
    _, n_jobs = jobs(spark, "count", snapshot.count)
    assert n_jobs == 0


def test_counting_stops_beyond_the_cap(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(6400).repartition(64).write.parquet(path)
    snapshot = take_snapshot(spark, path, str(tmp_path), "capped")
    even = lambda schema: F.col("id") % 2 == 0
    for cap in (0, 10, 3199, 3200, 5000):
        found, files = snapshot.count_until(even, cap)
        assert files < 64 if cap == 10 else True
        expected = total_hits(snapshot.rows().where("id % 2 = 0"), cap).first()
        assert tuple(snapshot.total_hits(even, cap).first()) == tuple(expected)
    assert tuple(snapshot.total_hits(None, 100).first()) == (100, "gte")
    none = lambda schema: filter_column(schema, Filter("id", "lt", 0))
    assert snapshot.count_until(none, 10) == (0, 64)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(0).write.parquet(path)
    snapshot = take_snapshot(spark, path, str(tmp_path), "empty", ["id"])
    assert snapshot.rows().count() == 0 and snapshot.count().first().total == 0 and snapshot.row_by_id(0).count() == 0
    assert snapshot.count_until(lambda schema: F.lit(True), 5)[0] == 0


def test_date_range_reads_no_data(spark, days, tmp_path):
    path, stored, _ = days
    snapshot = take_snapshot(spark, path, str(tmp_path), "range", ["at"])
    spans = snapshot.date_range("at")
    assert all("/range/files/" in file for file in spans.inputFiles())
    assert spans.first().oldest.startswith("2024-03-01T00:0")


def test_footer_bounds(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(500).select("id", (F.col("id") / 2).alias("half"), F.lit(None).cast("int").alias("none"), F.col("id").cast("string").alias("text")).repartition(3).write.parquet(path)
    rows = {r.field: tuple(r)[1:] for r in footer_bounds(spark, path, ["id", "half", "none"]).collect()}
    assert rows == {"id": (500, "0", "499"), "half": (500, "0.0", "249.5"), "none": (500, None, None)}
    with pytest.raises(ValueError):
        footer_bounds(spark, path, ["text"])


ROWS = [(i, (i * 7919) % 50 if i % 11 else None, f"t{i % 4}", None if i % 13 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i % 97, microseconds=i)) for i in range(3000)]


@pytest.mark.parametrize("keys", [["n"], ["-n", "text"], ["-at"], ["text", "-at"], ["id"], ["-id"], []])
def test_selected_pages_equal_sorted_ones(spark, tmp_path, keys):
    df = spark.createDataFrame(ROWS, "id bigint, n int, text string, at timestamp")
    df.repartition(5).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    order = [SortKey(key.lstrip("-"), key.startswith("-")) for key in keys]
    draw = random.Random(len(keys))
    for offset in [0, 2995, 3000, 5000, *draw.sample(range(3000), 4)]:
        got = page_select(df, order, offset, 40, unique="id", sorted_rows=200).collect()
        assert got == page(df, order, offset, 40, unique="id").collect()


def test_selection_sorts_few_rows(spark, tmp_path):
    spark.range(200_000).select(F.col("id"), (F.hash("id") % 1000).alias("n")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = page_select(df, [SortKey("n")], 150_000, 10, unique="id", sorted_rows=20_000)
    text = plan(found)
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(n," in text
    assert found.count() == 10


def test_page_of_a_unique_key_reads_its_columns_only(spark, tmp_path):
    spark.range(10).select("id", F.lit(1).alias("wide")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert "wide" not in plan(page(df, [SortKey("id")], 2, 3, unique="id").select("id")).split("ReadSchema")[1]


def test_number_pages_leaves_user_columns(spark):
    df = spark.createDataFrame([(2, "a", "b"), (1, "c", "d")], "id int, row_no string, page string")
    got = number_pages(df, [SortKey("id")], 1)
    assert got.columns == ["_row_no", "id", "row_no", "page", "_page"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, 1, "c", "d", 1), (2, 2, "a", "b", 2)]
    with pytest.raises(ValueError):
        number_pages(df, [SortKey("id")], 1, page="PAGE")
    assert number_pages(df, [SortKey("id")], 1, number="n", page="p").columns == ["n", "id", "row_no", "page", "p"]


def test_snapshot_of_a_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(100).withColumn("part", F.col("id") % 3).write.partitionBy("part").parquet(path)
    snapshot = take_snapshot(spark, path, str(tmp_path), "parts", ["id"])
    assert snapshot.schema == T.StructType([T.StructField("id", T.LongType())]) and snapshot.rows().count() == 100
