import json

import pytest
from pyspark.sql import functions as F

from hitlake.functions import (
    get_path,
    get_paths,
    is_json,
    object_lines,
    parse_field_spec,
    result_name,
    select_fields,
    source_includes,
    split_path,
    typed_text,
)
from hitlake.functions import paths
from hitlake.sources import infer_schema, read_hits

LOOKUPS = [
    ({"city": "Oslo", "zip": "0150"}, "zip", "0150"),
    ({"trip": {"from": {"city": "Oslo"}}}, "trip.from.city", "Oslo"),
    ({"trip": {"from": {"city": "Oslo"}}}, "trip.to", None),
    ({"trip": {"from": {}}}, "trip.from.city", None),
    ({"city": "Oslo"}, "city.name", None),
    ({"city": None}, "city", None),
    ({"seats": -7}, "seats", "-7"),
    ({"n": 1.0}, "n", "1.0"),
    ({"n": 1e5}, "n", "100000.0"),
    ({"n": 12345678901234567890123}, "n", "12345678901234567890123"),
    ({"t": True}, "t", "true"),
    ({"o": {"x": 1}}, "o", '{"x":1}'),
    ({"a": [{"b": 1}]}, "a.b", None),
    ({"@timestamp": "now"}, "@timestamp", "now"),
    ({"it's": {"a b": 3}}, "it's.a b", "3"),
    ({"*": "star", "b": "other"}, "*", "star"),
    ({"empty": ""}, "empty", ""),
]


@pytest.mark.parametrize("doc, path, expected", LOOKUPS)
def test_raw_lookup(spark, doc, path, expected):
    df = spark.createDataFrame([(json.dumps(doc),)], "value string")
    value = F.col("value")
    assert df.select(get_path(value, path)).first()[0] == expected
    assert tuple(object_lines(df, ["none", path]).first()) == (None, expected)


@pytest.mark.parametrize("doc, path, expected", LOOKUPS[:7])
def test_typed_lookup_agrees(spark, write, doc, path, expected):
    file = write(json.dumps(doc), json.dumps({"anchor": 1}))
    hits = read_hits(spark, file, schema=infer_schema(spark, file)).where("anchor is null")
    assert hits.select(typed_text(hits, path)).first()[0] == expected


@pytest.mark.parametrize(
    "spec, expected",
    [
        ("_source.message", ("_source.message", "message")),
        ("_source.@timestamp:timestamp", ("_source.@timestamp", "timestamp")),
        ("message", ("message", "message")),
        ("path:with:colons:name", ("path:with:colons", "name")),
    ],
)
def test_field_spec(spec, expected):
    assert parse_field_spec(spec) == expected


@pytest.mark.parametrize(
    "line, good",
    [
        ('{"a":1}', True),
        ("  {}  ", True),
        ("5", True),
        ("NaN", True),
        ('{"a":-Infinity}', True),
        ('"text"', True),
        ("null", True),
        ("[1, 2]", True),
        ('{"a":\t1}', True),
        ('{"a":1e5, "b":[true,false,null]}', True),
        ('{"a":"end of the line"}', True),
        ('1,"end of the line"] trailing', False),
        ('{"a":1},{"end of the line":1}] trailing', False),
        ('{"a":1},{"end of the line":1}', False),
        ("not json", False),
        ("", False),
        ("   ", False),
        ('{"a":1', False),
        ('{"a":1} trailing', False),
        ('{"a":1}] trailing', False),
        ('{"a":1}} trailing', False),
        ('{"a":1}{"b":2}', False),
        ('{"a":1},{"b":2}', False),
        ('{"a":1}, "b":2', False),
        ('1, "k": 2', False),
        ('1} , {"v": 2', False),
        ("1] , [2", False),
        ("{'a':1}", False),
        ('{"a":01}', False),
        ('{"a":"tab\there"}', False),
        ('{a:1}', False),
        ('{"a":1,}', False),
    ],
)
def test_is_json(spark, monkeypatch, line, good):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(is_json(F.col("value"))).first()[0] is good
    if "a" in line and "{" in line:
        assert object_lines(df, ["a"]).count() == good
    monkeypatch.setattr(paths, "END_MARK", "")  # every line holds it
    assert df.select(is_json(F.col("value"))).first()[0] is good
    if good:
        json.loads(line)
    else:
        with pytest.raises(ValueError):
            json.loads(line)


def test_last_of_equal_keys_counts(spark):
    df = spark.createDataFrame([('{"a":1,"b":NaN,"a":2}',)], "value string")
    assert tuple(df.select(is_json(F.col("value")), get_path(F.col("value"), "a")).first()) == (True, "2")


def test_paths_of_one_line(spark):
    line = '{"a":{"b":{"c":1},"d":"x"},"A":{"b":2},"e":[1, {"f":null}]}'
    wanted = ["a.b.c", "a.b", "a", "A.b", "e", "a.d", "a.b.c", "e.f", "a.b.c.z"]
    df = spark.createDataFrame([(line,)], "value string")
    assert list(object_lines(df, wanted).first()) == list(df.select(*get_paths(F.col("value"), wanted)).first()) == [
        "1",
        '{"c":1}',
        '{"b":{"c":1},"d":"x"}',
        "2",
        '[1,{"f":null}]',
        "x",
        "1",
        None,
        None,
    ]


def test_object_where_text_was_expected(spark):
    """A step into something else leaves the rest of the line readable."""
    df = spark.createDataFrame([('{"a":"text","b":[1],"c":{"d":{"e":1},"f":"x"}}',)], "value string")
    value = F.col("value")
    for path, expected in [("a.x", None), ("b.x", None), ("c.d", '{"e":1}'), ("c.f", "x"), ("c.f.g", None)]:
        assert object_lines(df, [path]).first()[0] == expected
    assert list(df.select(*get_paths(value, ["a.x", "b.x", "c.f"])).first()) == [None, None, "x"]


def test_path_names():
    assert split_path('_source."a.b".c') == ["_source", "a.b", "c"]
    assert result_name('_source."@timestamp"') == "_source_@timestamp"
    with pytest.raises(ValueError):
        split_path("a..b")


def test_select_fields(spark):
    df = spark.createDataFrame([((1, "x"), 2)], "_source struct<`@timestamp`: int, m: string>, n int")
    assert select_fields(df, []).columns == df.columns
    picked = select_fields(df, ['_source."@timestamp"', "n"])
    assert picked.columns == ["_source_@timestamp", "n"]
    assert tuple(picked.first()) == (1, 2)


def test_select_fields_rejects_equal_names(spark):
    df = spark.createDataFrame([((1,), (2,))], "a struct<b_c: int>, a_b struct<c: int>")
    with pytest.raises(ValueError, match="a_b_c"):
        select_fields(df, ["a.b_c", "a_b.c"])


def test_source_includes(spark):
    schema = "_source struct<m: string, host: struct<name: string, ip: string>, tags: array<struct<k: int, v: int>>>"
    df = spark.createDataFrame([(("m", ("n", "i"), [(1, 2)]),), (None,), (("m", None, None),)], schema)
    kept = source_includes(df, ["host.name", "tags.v", "nothing"])
    rows = [r[0] for r in kept.select(F.to_json("_source", {"ignoreNullFields": "false"})).collect()]
    assert rows == ['{"host":{"name":"n"},"tags":[{"v":2}]}', None, '{"host":null,"tags":null}']
    assert source_includes(df, ["host"]).schema["_source"].dataType.simpleString() == (
        "struct<host:struct<name:string,ip:string>>"
    )
    none = source_includes(df, ["nothing"])
    assert [r[0] for r in none.select(F.to_json("_source")).collect()] == ["{}", None, "{}"]
