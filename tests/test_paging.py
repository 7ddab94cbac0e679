import os
import random
from pathlib import Path
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from plans import plan
from pyspark.sql import functions as F

from hitlake.operators import (
    SortKey,
    export_order,
    flip_sort,
    keyset_after,
    keyset_page,
    number_pages,
    number_parquet,
    number_rows,
    page,
    page_info,
    page_offset,
    row_by_id,
    row_detail,
    sort_by,
)
from hitlake.operators import numbering
from hitlake.operators.paging import order_columns
from hitlake.scratch import materialize, owned_scratch, remove_scratch


def test_nulls_are_last_both_ways(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 3), (4, 1)], "id int, n int")
    assert [r.id for r in sort_by(df, "n", "asc", unique="id").collect()] == [1, 4, 3, 2]
    assert [r.id for r in sort_by(df, "n", "desc", unique="id").collect()] == [3, 1, 4, 2]
    with pytest.raises(ValueError):
        sort_by(df, "n", "down", unique="id")


def test_choosing_a_sort_again_flips_it():
    first = flip_sort(None, "a")
    assert first == SortKey("a", True)
    assert flip_sort(first, "a") == SortKey("a", False)
    assert flip_sort(first, "b") == SortKey("b", True)


def test_export_order_adds_the_unique_field_once():
    assert export_order("id") == [SortKey("@timestamp"), SortKey("id")]
    assert export_order("id", [SortKey("id", True)]) == [SortKey("id", True)]


def test_pages_are_a_top_k(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert "TakeOrderedAndProject" in plan(page(events, [SortKey("ts"), SortKey("event_id")], 200, 100))


@pytest.mark.parametrize("offset", [0, 10, 4321, 4990, 7000])
def test_pages_of_keys_that_are_not_total(spark, offset):
    """Rows with equal keys are neither lost nor repeated, however deep the page."""
    df = spark.range(5000).select((F.col("id") * 7919 % 3).alias("k"), F.lit(None).cast("string").alias("n"), "id").repartition(6)
    rows = [tuple(r) for start in range(offset, offset + 40, 20) for r in page(df, [SortKey("k")], start, 20).collect()]
    assert rows == sorted((i * 7919 % 3, None, i) for i in range(5000))[offset : offset + 40]


def test_numbering_leaves_names_alone(spark):
    df = spark.range(20).select("id", *[F.lit(i).alias(n) for i, n in enumerate(("_index", "_file", "_part", "_row", "_offset", "_block"))])
    rows = number_pages(df, [SortKey("id", True)], 6).collect()
    assert sorted((r.row_no, r.page, r.id, r._index, r._block) for r in rows) == [(i + 1, i // 6 + 1, 19 - i, 0, 5) for i in range(20)]


def test_scratch_tables_have_an_owner(spark):
    with owned_scratch(spark):
        numbered = number_pages(spark.range(9).toDF("id"), [SortKey("id")], 2)
        folder = numbered.inputFiles()[0].rpartition("/")[0].removeprefix("file:")
        assert numbered.count() == 9 and os.path.isdir(folder)
    assert not os.path.exists(folder)


@pytest.mark.parametrize(
    "total, offset, limit, expected",
    [
        (250, 0, 100, (250, 1, 3, 1, 100, False, True, 0, 100, 200)),
        (250, 200, 100, (250, 3, 3, 201, 250, True, False, 100, 200, 200)),
        (0, 0, 100, (0, 1, 0, None, None, False, False, 0, 0, 0)),
        (100, 0, 100, (100, 1, 1, 1, 100, False, False, 0, 0, 0)),
    ],
)
def test_page_info(spark, total, offset, limit, expected):
    df = spark.createDataFrame([(total,)], "total bigint")
    assert tuple(page_info(df, offset, limit).first()) == expected


def test_page_offset():
    assert page_offset(1, 250) == 0
    assert page_offset(3, 250) == 200
    assert page_offset(9, 250) == 200
    assert page_offset(0, 250) == 0
    assert page_offset(5, 0) == 0


ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.sampled_from("ab"))), min_size=1, max_size=9
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, down=st.tuples(st.booleans(), st.booleans(), st.booleans()))
def test_keyset_pages_are_the_sorted_table(spark, rows, down):
    data = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, a int, b string").coalesce(1)
    keys = [SortKey("a", down[0]), SortKey("b", down[1]), SortKey("id", down[2])]
    expected = [tuple(r) for r in df.orderBy(*order_columns(keys)).collect()]
    seen, after = [], None
    while True:
        hits = keyset_page(df, keys, after, size=4).collect()
        if not hits:
            break
        seen += [tuple(r) for r in hits]
        after = (hits[-1].a, hits[-1].b, hits[-1].id)
    assert seen == expected


def test_keyset_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    keys = [SortKey("ts"), SortKey("event_id")]
    text = plan(events.where(keyset_after(events, keys, ("2024-01-10", 30))))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(ts" in pushed
    with pytest.raises(ValueError):
        keyset_after(events, keys, ("2024-01-10",))


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_numbers_do_not_depend_on_partitions(spark, partitions):
    ids = list(range(3000))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i, i % 3) for i in ids], "id int, hot int").repartition(partitions)
    numbered = number_rows(df, [F.asc("hot"), F.desc("id")]).collect()
    expected = sorted(ids, key=lambda i: (i % 3, -i))
    assert [r.id for r in sorted(numbered, key=lambda r: r.row_no)] == expected
    assert sorted(r.row_no for r in numbered) == list(range(1, 3001))


def test_hot_key_is_sorted_by_several_tasks(spark):
    df = spark.range(100_000).select("id", F.lit("same").alias("hot")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = materialize(df.orderBy("hot", "id").withColumn("part", F.spark_partition_id()), "hot")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in stored.groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 30_000


def test_numbering_does_not_gather_the_table(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(number_rows(orders, [F.asc("o_orderkey")]))
    single = text.split("Exchange SinglePartition")
    assert "BroadcastHashJoin" in text
    # the only thing brought together is the table of files
    assert text.count("SinglePartition") <= 2, single


def test_page_numbers(spark):
    pages = number_pages(spark.range(25), [SortKey("id")], size=10)
    assert [r["count"] for r in pages.groupBy("page").count().orderBy("page").collect()] == [10, 10, 5]
    assert pages.where("row_no = 11").first() == (11, 10, 2)


@pytest.mark.parametrize("limit", [0, 100_000])
def test_parquet_row_ids(spark, tmp_path, monkeypatch, limit):
    """Positions follow file and row; joining the file table by shuffle gives the same."""
    monkeypatch.setattr(numbering, "BROADCAST_FILES", limit)
    monkeypatch.setattr(numbering, "ROWS_PER_BLOCK", 70)
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(path)
    rows = number_parquet(spark, path).collect()
    assert sorted(r.row_id for r in rows) == list(range(1000))
    assert all(r.row_id == r.id for r in rows)


def test_one_row(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(path)
    for n in (0, 555, 999):
        assert [r.id for r in row_by_id(spark, path, n).collect()] == [n]
    assert row_by_id(spark, path, 1000).count() == 0


def test_row_detail(spark):
    df = spark.createDataFrame([(1, (None, "x"))], "n int, s struct<a: int, b: string>")
    assert row_detail(df).first().detail == (
        '{\n  "n" : 1,\n  "s" : {\n    "a" : null,\n    "b" : "x"\n  }\n}'
    )


def test_scratch_tables_can_be_removed(spark):
    numbered = number_rows(spark.range(10), [F.asc("id")])
    folder = Path(urlparse(numbered.inputFiles()[0]).path).parent
    assert folder.exists()
    remove_scratch(numbered)
    assert not folder.exists()
    source = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    remove_scratch(source)
    assert source.count() == 5
