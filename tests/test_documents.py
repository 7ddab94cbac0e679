"""VARIANT documents, substring indexes, sketches, whole nested values, clashing names."""

import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from hitlake.functions import get_paths
from hitlake.operators import extract, field_counts, merge_sketches, profile, search_all, sketch_fields
from hitlake.sources import (
    files_with,
    index_substrings,
    read_documents,
    read_hits,
    read_lines,
    search_indexed,
    store_documents,
    take_snapshot,
    variant_fields,
    variant_schema,
    write_json_array,
)

LINES = [
    '{"a":1,"b":{"c":"x y","a.b":[1,{"z":true}]},"n":null,"s":"text","t":"2024-01-01T00:00:00Z"}',
    '{"a":"1","b":{"c":null},"s":""}',
    '{"a":1.25,"b":7,"s":"a \\"quoted\\" \\u00e9"}',
    '{"a":true,"b":[]}',
    "{}",
]
BAD = ['{"a":1} t', '{"a":1},{"a":2}', "5", "[1]", "nope", '{"a":1,"a":2}', '{"a":1}]', '{"a":1},0', '"{}"', "null"]


def test_variant_text_follows_the_rules_of_raw_lines(spark, write, tmp_path):
    path = write(*LINES, *BAD, "", "  ")
    read = read_documents(spark, path)
    assert sorted(r[0] for r in read.select("_corrupt_record").collect() if r[0]) == sorted(BAD)
    stored = store_documents(read.where("document IS NOT NULL"), str(tmp_path / "stored"))
    paths = ["a", "b", "b.c", "b.c.d", "n", "s", "t", "none.x"]
    got = stored.select(*variant_fields(F.col("document"), paths)).collect()
    raw = read_lines(spark, path).where(F.col("value").isin(LINES))
    plain = raw.select(*get_paths(F.col("value"), paths)).collect()
    compact = lambda row: tuple(v if v is None or v[:1] not in ("{", "[") else json.dumps(json.loads(v), sort_keys=True) for v in row)
    assert sorted(map(compact, got), key=str) == sorted(map(compact, plain), key=str)
    with pytest.raises(ValueError):
        variant_fields(F.col("document"), ["a]"])


def test_variant_schema_is_that_of_all_documents(spark, write):
    schema = variant_schema(read_documents(spark, write('{"a":1,"b":{"c":"x"}}', '{"b":{"d":[1,2]},"e":null}', '{"a":2.5,"f":1}', '{"f":"x"}', "broken")))
    assert schema["b"].dataType.fieldNames() == ["c", "d"] and isinstance(schema["a"].dataType, T.DecimalType)
    assert isinstance(schema["f"].dataType, T.VariantType) and schema.fieldNames() == ["a", "b", "e", "f"]
    assert variant_schema(read_documents(spark, write("broken", name="none.jsonl"))) == T.StructType([])


def test_indexed_search_equals_a_search_of_all_files(spark, tmp_path):
    draw = random.Random(4)
    words = ["Error", "time-out", "café", "ÄÖ", "100%", "a_b", "x\\y", "日本語", "ok", "İstanbul", "straße"]
    rows = [(i, " ".join(draw.choices(words[: 3 + i % 9], k=draw.randint(0, 4))) or None, float(i), [draw.choice(words[:5])]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, text string, number double, list array<string>")
    df.repartitionByRange(12, F.col("id") % 9).write.parquet(str(tmp_path / "t"))
    snapshot = take_snapshot(spark, str(tmp_path / "t"), str(tmp_path), "s")
    index_substrings(snapshot)
    patterns = ["error", "TIME", "cafÉ", "äö", "00%", "a_b", "x\\y", "本語", "語", "o", "%", "", "err%out", "r t_me", "399", "İSTAN", "istan", "STRASSE", "straße", "nowhere", "[\"ok"]
    for text in patterns:
        expected = snapshot.rows().where(search_all(snapshot.schema, text))
        assert sorted(r.id for r in search_indexed(snapshot, text).collect()) == sorted(r.id for r in expected.collect()), text
    assert files_with(snapshot, "nowhere") == [] and len(files_with(snapshot, "日本語")) < len(snapshot.files)


def test_sketches_merge_to_a_profile(spark, tmp_path):
    df = spark.range(30_000).select(
        (F.col("id") % 5).alias("field"), F.col("id").alias("unique"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 40)).alias("value"),
        F.lit(None).cast("int").alias("none"), F.struct((F.col("id") % 1000).alias("deep")).alias("s"),
    )
    sketch_fields(df, [F.col("field").alias("part")]).write.parquet(str(tmp_path / "k"))
    stored = spark.read.parquet(str(tmp_path / "k"))
    got = {r.field: r for r in merge_sketches(stored).collect()}
    exact = {}
    for r in profile(df).collect():
        exact.setdefault(r.field, (r.unique_count, r.null_count, {}))[2].update({r.value: r["count"]} if r.value is not None else {})
    assert set(got) == set(exact)
    for field, (unique, nulls, top) in exact.items():
        assert got[field].null_count == nulls and got[field].rows == 30_000
        assert abs(got[field].unique_count - unique) <= 0.025 * unique
        if unique <= 1000:
            assert sorted(t["count"] for t in got[field].top) == sorted(top.values())
    some = merge_sketches(stored.where("part = 1"), 2).where("field = 'field'").first()
    assert [tuple(t) for t in some.top] == [("1", 6000)]


def test_fields_beyond_their_sketch_are_counted(spark):
    n = F.col("id")
    df = spark.range(60_000).select(
        n, F.when(n % 5 == 0, n % 7).otherwise(n % 20_011).alias("short"), F.when(n % 4 > 0, n % 13).otherwise(n + 100).alias("tall"), (n % 50).alias("few")
    )
    sketches = sketch_fields(df, [(n % 3).alias("part")])
    alone = {r.field: r for r in merge_sketches(sketches).collect()}
    assert {f for f, r in alone.items() if not r.reliable} == {"id", "short"}
    got = {r.field: r for r in merge_sketches(sketches, rows=df).collect()}
    exact = {}
    for r in profile(df).orderBy("rank").collect():
        exact.setdefault(r.field, []).append((r.value, r["count"]))
    assert all(r.reliable for r in got.values())
    assert {f: [tuple(t) for t in got[f].top] for f in ("id", "short")} == {f: exact[f] for f in ("id", "short")}
    assert len(got["tall"].top) == 10 and {t["value"] for t in got["tall"].top} <= {str(value) for value in range(13)}
    assert sorted(t["count"] for t in got["few"].top) == sorted(count for _, count in exact["few"])


def test_nested_times_are_whole(spark):
    rows = spark.sql(
        """SELECT array(timestamp'2024-01-01T00:00:00.000001Z') AS list, struct(timestamp_ntz'2024-01-01 00:00:00.000001' AS t) AS s,
            map('k', timestamp'2024-01-01T00:00:00.5Z') AS m, array(0.0D) AS z
        UNION ALL SELECT array(timestamp'2024-01-01T00:00:00.000002Z'), struct(timestamp_ntz'2024-01-01 00:00:00.000002'),
            map('k', timestamp'2024-01-01T00:00:00.500001Z'), array(-0.0D)"""
    )
    found = {r.field: r.unique_count for r in profile(rows).where("rank = 1").collect()}
    for field in ("list", "s.t", "z"):
        assert found[field] == field_counts(rows, field).first().unique_count == (1 if field == "z" else 2)
    assert found["m"] == 2
    zones = []
    for zone in ("UTC", "America/New_York"):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            zones.append(sorted(r.value for r in profile(rows, ["list", "m"]).collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
    assert zones[0] == zones[1] and '["2024-01-01T00:00:00.000001Z"]' in zones[0]


def test_report_fields_may_be_called_anything(spark, write):
    docs = [{"_source": {"message": "id=1 id=1", "_position": "p", "match": "m"}, "_position": "top"}, {"_source": {"message": "id=2"}}]
    path = write(*map(json.dumps, docs))
    fields = ["_source._position:_position", "_position:__position", "_source.match:value"]
    got = [tuple(r) for r in extract(read_lines(spark, path), r"id=(\d)", fields=fields, raw=True).collect()]
    assert sorted(got) == [("1", "p", "top", "m"), ("2", "", "", "")]
    typed = read_hits(spark, path).drop("_corrupt_record")
    assert sorted(tuple(r) for r in extract(typed, r"id=(\d)", fields=fields, unique=False).collect()) == [("1", "p", "top", "m")] * 2 + [("2", "", "", "")]


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_json_array_in_one_write(spark, tmp_path, ranges):
    rows = spark.range(50).where("id < 20 OR id > 40").repartitionByRange(ranges, "id").sortWithinPartitions("id")
    for name, part in (("some", rows), ("none", rows.where("id < 0")), ("one", rows.where("id = 45"))):
        write_json_array(part, str(tmp_path / name))
        text = "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*")))
        assert [r["id"] for r in json.loads(text)] == [r.id for r in part.collect()]


def test_values_that_do_not_fit_are_found_at_any_depth(spark, write):
    schema = T.StructType.fromDDL("a int, l array<struct<x:int>>, m map<string,int>, s struct<y:int>")
    good = ['{"a":1,"l":[{"x":1}],"m":{"k":1},"s":{"y":1}}', '{"a":1}', '{"l":[{"x":null}],"m":{"k":null}}', "{}"]
    bad = ['{"a":"x"}', '{"l":[{"x":"no"}],"a":1}', '{"a":1,"m":{"k":"no"}}', '{"s":{"y":[]},"a":2}', '{"a":1} x']
    rows = read_hits(spark, write(*good, *bad), schema=schema, file_column="from").collect()
    assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == sorted(bad)
    assert len(rows) == 9 and all(r["from"].endswith("input.jsonl") for r in rows)
