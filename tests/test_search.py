import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hitlake.operators import Filter, SortKey
from hitlake.plans import View, export, search
from hitlake.sources import as_hits


@pytest.fixture
def documents(spark):
    rows = [(i, f"note no. {i}", ("a" if i % 2 else "b",)) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, message string, host struct<name: string>")
    moment = F.timestamp_seconds(F.col("id") + 1750003200)  # 2025-06-15T16:00:00Z
    return df.withColumn("@timestamp", moment).repartition(3)


def test_search(documents):
    body = {
        "size": 2,
        "sort": [{"@timestamp": "desc"}, {"_shard_doc": {"order": "desc"}}],
        "_source": ["message"],
        "query": {"bool": {"filter": [{"term": {"host.name": "b"}}]}},
    }
    result = search(documents, body, "id")
    hits = result.hits.collect()
    assert [h._id for h in hits] == ["4", "2"]
    assert hits[0]._source.asDict() == {"message": "note no. 4"}
    assert hits[0].sort["id"] == 4
    assert tuple(result.total.first()) == (3, "eq")
    untracked = search(documents, {**body, "track_total_hits": False}, "id").total
    assert untracked.first().value == 0
    assert tuple(search(documents, {"track_total_hits": 2}, "id").total.first()) == (2, "gte")


def test_search_defaults(documents):
    hits = search(documents, {}, "id").hits
    assert [h._id for h in hits.collect()] == ["0", "1", "2", "3", "4"]
    assert search(documents, {"_source": False}, "id").hits.columns == ["_id", "sort"]
    assert search(documents, {"size": 0}, "id").hits.count() == 0


@pytest.mark.parametrize("body", [{"aggs": {}}, {"query": {"match": {"message": "x"}}}, {"sort": [{"id": "up"}]}])
def test_unsupported_bodies(documents, body):
    with pytest.raises(ValueError, match="unsupported"):
        search(documents, body, "id").hits.collect()


def lines(path):
    return [json.loads(x) for p in sorted(Path(path).glob("part-*")) for x in p.read_text().splitlines()]


def test_export_writes_every_hit_in_order(documents, tmp_path):
    export(documents, {"query": {"match_all": {}}, "size": 2}, "id").write(str(tmp_path / "out"))
    hits = lines(tmp_path / "out")
    assert [h["_source"]["message"] for h in hits] == [f"note no. {i}" for i in range(5)]
    assert hits[0]["sort"] == {"@timestamp": "2025-06-15T16:00:00.000000Z", "id": 0}


def test_export_of_a_time_range(documents):
    job = export(documents, {}, "id", "2025-06-15T16:00:01Z", "2025-06-15T16:00:03Z")
    assert [h._id for h in job.hits().collect()] == ["1", "2"]
    assert [json.loads(r.value)["_id"] for r in job.lines().collect()] == ["1", "2"]


def test_export_pages(documents):
    job = export(documents, {"sort": [{"id": "desc"}]}, "id", page_size=2)
    rows = sorted((r.row_no, r.page, r.id) for r in job.pages().collect())
    assert rows == [(1, 1, 4), (2, 1, 3), (3, 2, 2), (4, 2, 1), (5, 3, 0)]


def test_export_as_one_array(documents, tmp_path):
    job = export(documents, {"sort": [{"host.name": "desc"}], "_source": "message"}, "id")
    job.write(str(tmp_path / "out"), "json")
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [h["_id"] for h in json.loads(text)] == ["0", "2", "4", "1", "3"]
    with pytest.raises(ValueError, match="format"):
        job.write(str(tmp_path / "other"), "xml")


def test_view(documents):
    hits = as_hits(documents, "id")
    view = View(hits, "_id", filters=[Filter("_source.host.name", "eq", "b")], sort=SortKey("_id", True), limit=2)
    assert view.rows().columns == ["_source_@timestamp", "_source_message"]
    assert [r._source_message for r in view.rows().collect()] == ["note no. 4", "note no. 2"]
    assert view.count().first().total == 3
    assert view.info().first().pages == 2
    assert View(hits, "_id", columns=["_id"]).rows().count() == 5
