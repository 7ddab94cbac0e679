from pathlib import Path

import pytest
from plans import plan
from pyspark.sql import functions as F, types as T

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
)


@pytest.fixture
def catalog(spark, tmp_path):
    datasets = {}
    for n, day in enumerate(("2024-01-10", "2024-01-11")):
        path = str(tmp_path / f"logs-{n}")
        df = spark.sql(f"select 'message {n}' as message, timestamp'{day} 12:00:00Z' as `@timestamp`")
        (df if n == 0 else df.withColumn("extra", F.lit(n))).write.parquet(path)
        datasets[f"logs-{n}"] = Dataset(path)
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "`@timestamp` timestamp").write.parquet(empty)
    datasets["empty"] = Dataset(empty)
    (tmp_path / "raw.jsonl").write_text('{"a":1}\n\nbroken\n')
    datasets["raw"] = Dataset(str(tmp_path / "raw.jsonl"), "json")
    return Catalog(
        datasets,
        {
            "logs": [Member("logs-0"), Member("logs-1")],
            "some": [Member("logs-0", {"term": {"message": "message 9"}}), Member("logs-1"), Member("empty")],
        },
    )


def test_inventory(spark, catalog):
    rows = inventory(spark, catalog, sort="docs").collect()
    assert [(r["index"], r.docs) for r in rows] == [("empty", 0), ("logs-0", 1), ("logs-1", 1), ("raw", 2)]
    for r in rows:
        place = Path(catalog.datasets[r["index"]].path)
        files = [place] if place.is_file() else [f for f in place.iterdir() if f.name[0] not in "._"]
        assert (r.bytes, r.files) == (sum(f.stat().st_size for f in files), len(files))
        assert abs(r.created.timestamp() - min(f.stat().st_mtime for f in files)) < 0.01
    assert [r["index"] for r in inventory(spark, catalog, "logs-*").collect()] == ["logs-0", "logs-1"]
    assert inventory(spark, catalog, "*.*").count() == 0
    down = inventory(spark, catalog, sort="index", descending=True).collect()
    assert [r["index"] for r in down] == ["raw", "logs-1", "logs-0", "empty"]


def test_aliases(spark, catalog):
    rows = [tuple(r) for r in aliases(spark, catalog, "s*").collect()]
    assert rows == [("some", "empty", "-"), ("some", "logs-0", "*"), ("some", "logs-1", "-")]


def test_names_stand_for_members(spark, catalog):
    both = read_alias(spark, catalog, "logs").orderBy("_index").collect()
    assert [(r._index, r.message, r.extra) for r in both] == [("logs-0", "message 0", None), ("logs-1", "message 1", 1)]
    assert read_alias(spark, catalog, "logs-*").count() == 2
    assert [r.message for r in read_alias(spark, catalog, "some").collect()] == ["message 1"]
    for name in ("nothing", "nothing-*"):
        with pytest.raises(KeyError, match="Index not found"):
            read_alias(spark, catalog, name)


def test_describe_dataset(spark, catalog):
    row = describe_dataset(spark, catalog, "logs-0").first()
    assert (row["index"], row.docs, row.oldest, row.span) == ("logs-0", 1, "2024-01-10T12:00:00.000Z", "0 minutes")
    assert row.files == 1 and row.bytes > 0
    assert [r.name for r in dataset_schema(spark, catalog, "logs-1").collect()] == ["message", "@timestamp", "extra"]
    with pytest.raises(KeyError, match="Index not found"):
        describe_dataset(spark, catalog, "nothing")


def test_describe_alias(spark, catalog):
    rows = describe_alias(spark, catalog, "logs").orderBy("index").collect()
    assert [(r["index"], r.docs, r.member_oldest) for r in rows] == [
        ("logs-0", 1, "2024-01-10T12:00:00.000Z"),
        ("logs-1", 1, "2024-01-11T12:00:00.000Z"),
    ]
    assert {(r.oldest, r.newest, r.span, r.members) for r in rows} == {
        ("2024-01-10T12:00:00.000Z", "2024-01-11T12:00:00.000Z", "1 day", 2)
    }
    assert all(r.bytes > 0 and r.files > 0 and r.created is not None for r in rows)
    partly = {r["index"]: (r.docs, r.member_span) for r in describe_alias(spark, catalog, "some").collect()}
    assert partly == {"logs-0": (0, "-"), "logs-1": (1, "0 minutes"), "empty": (0, "-")}


def test_one_scan_for_any_number_of_members(spark, tmp_path):
    """The plan of an alias does not grow with its members, and its rows are those of the union."""
    from hitlake.sources.datasets import _union

    lines = []
    for size in (4, 40):
        root = tmp_path / f"of {size}"
        spark.range(400).select("id", (F.col("id") % size).alias("n"), F.lit("x").alias("text")).write.partitionBy("n").parquet(str(root))
        datasets = {f"d{n}": Dataset(f"{root}/n={n}") for n in range(size)}
        (root / "more").mkdir()
        for n in range(3):
            (root / "more" / f"{n}.jsonl").write_text("".join(f'{{"id": {n * 1000 + i}, "own": {n}}}\n' for i in range(5)))
            datasets[f"j{n}"] = Dataset(f"{root}/more/{n}.jsonl", "json", T.StructType.fromDDL("id bigint, own int"))
        members = [Member(name, {"term": {"id": 7}} if n % 2 else None) for n, name in enumerate(datasets)]
        catalog = Catalog(datasets, {"all": members})
        rows = read_alias(spark, catalog, "all")
        expected = _union(spark, catalog, members)
        assert sorted(map(tuple, rows.select("_index", "id", "text", "own").collect()), key=str) == sorted(map(tuple, expected.select("_index", "id", "text", "own").collect()), key=str)
        lines.append(len(plan(rows).split("\n")))
    assert lines[0] == lines[1]


def test_members_that_overlap_or_differ(spark, tmp_path):
    """A folder inside another one, one folder under two names, one name with two filters, types that can't be merged."""
    base = str(tmp_path / "base")
    spark.range(10).write.parquet(base)
    spark.range(10, 15).write.parquet(f"{base}/inner")
    spark.createDataFrame([("text",)], "id string").write.parquet(str(tmp_path / "other"))
    datasets = {"base": Dataset(base), "inner": Dataset(f"{base}/inner"), "same": Dataset(base + "/"), "other": Dataset(str(tmp_path / "other"))}
    groups = {"nested": [Member("inner"), Member("same")], "twice": [Member("inner", {"term": {"id": 11}}), Member("inner", {"term": {"id": 12}})]}
    catalog = Catalog(datasets, groups)
    twice = read_alias(spark, catalog, "twice").collect()
    assert sorted(r.id for r in twice) == [11, 12]
    nested = read_alias(spark, catalog, "nested").groupBy("_index").count().collect()
    assert dict(map(tuple, nested))["inner"] == 5
