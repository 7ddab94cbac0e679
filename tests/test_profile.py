import pytest
from plans import final_plan, plan
from pyspark.sql import functions as F

from hitlake.functions import (
    base_type,
    cell_text,
    default_columns,
    describe_schema,
    detect_time_field,
    leaf_fields,
    short_type,
    time_field_options,
    type_name,
    walk_fields,
)
from hitlake.operators import (
    date_ranges,
    date_range,
    field_counts,
    numeric_stats,
    profile,
    top_values,
    total_hits,
    value_histogram,
)
from pyspark.sql import types as T


def schema(ddl):
    return T.StructType.fromDDL(ddl)


NESTED = "_id string, _source struct<`@timestamp`: timestamp, host: struct<name: string>, tags: array<struct<k: bigint>>, message: string>"


def test_walk_fields():
    paths = [f.display_path for f in walk_fields(schema(NESTED))]
    assert paths == ["_id", "_source.@timestamp", "_source.host.name", "_source.tags", "_source.message"]
    with_structs = [f.path for f in walk_fields(schema(NESTED), include_structs=True)]
    assert with_structs[1] == '"_source"' and with_structs[3] == '"_source"."host"'
    assert walk_fields(schema("e struct<>"))[0].display_path == "e"


def test_leaf_fields(spark):
    rows = leaf_fields(spark.createDataFrame([], NESTED)).collect()
    assert (rows[3].path, rows[3].type, rows[3].short_type) == ('"_source"."tags"', "STRUCT(k BIGINT)[]", "arr")


def test_describe_schema(spark):
    df = spark.createDataFrame([], "a bigint not null, b map<string, double>, c timestamp_ntz, d decimal(5,2)")
    assert [tuple(r) for r in describe_schema(df).collect()] == [
        ("a", "BIGINT", False),
        ("b", "MAP(VARCHAR, DOUBLE)", True),
        ("c", "TIMESTAMP", True),
        ("d", "DECIMAL(5,2)", True),
    ]


@pytest.mark.parametrize(
    "ddl, base, short",
    [
        ("struct<a: int>", "STRUCT", "obj"),
        ("array<string>", "LIST", "arr"),
        ("map<string, int>", "MAP", "map"),
        ("string", "VARCHAR", "str"),
        ("bigint", "BIGINT", "i64"),
        ("int", "INTEGER", "int"),
        ("double", "DOUBLE", "f64"),
        ("float", "FLOAT", "f32"),
        ("timestamp", "TIMESTAMP WITH TIME ZONE", "time"),
        ("boolean", "BOOLEAN", "bool"),
        ("date", "DATE", "date"),
        ("decimal(3,1)", "DECIMAL(3,1)", "deci"),
    ],
)
def test_type_labels(ddl, base, short):
    data_type = schema(f"c {ddl}")["c"].dataType
    assert (base_type(data_type), short_type(data_type)) == (base, short)


def test_nested_type_names():
    assert type_name(schema("s struct<`a-b`: int, c: array<int>>")["s"].dataType) == 'STRUCT("a-b" INTEGER, c INTEGER[])'


@pytest.mark.parametrize(
    "ddl, field, options",
    [
        ("a timestamp, my_Timestamp timestamp_ntz", '"my_Timestamp"', ['"a"', '"my_Timestamp"']),
        ("timestamp string, b timestamp", '"b"', ['"b"']),
        (NESTED, '_source."@timestamp"', ['_source."@timestamp"']),
        ("a int", "@timestamp", []),
    ],
)
def test_time_fields(ddl, field, options):
    assert detect_time_field(schema(ddl)) == field
    assert time_field_options(schema(ddl)) == options


def test_default_columns():
    assert default_columns(schema(NESTED)) == ['"_source"."@timestamp"', '"_source"."message"']
    flat = "a int, s struct<x: int>, b int, c int, d int, e int, f int, g int"
    assert default_columns(schema(flat)) == ['"a"', '"b"', '"c"', '"d"', '"e"', '"f"']


def test_total_hits(spark):
    df = spark.range(30)
    assert tuple(total_hits(df).first()) == (30, "eq")
    assert tuple(total_hits(df, cap=30).first()) == (30, "eq")
    assert tuple(total_hits(df, cap=29).first()) == (29, "gte")
    assert tuple(total_hits(df, track=False).first()) == (0, "eq")


def test_field_counts_without_expand(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "n int")
    counted = field_counts(df, "n")
    assert tuple(counted.first()) == (2, 1)
    assert "Expand" not in plan(counted)


def test_top_values_and_histogram(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,), ("a",)], "v string")
    top = top_values(df, "v", 2)
    assert [tuple(r) for r in top.collect()] == [("a", 2), ("b", 2)]
    heights = value_histogram(top_values(df, "v")).orderBy("value").collect()
    assert [r.height for r in heights] == [100.0, 100.0, 50.0]


def test_numeric_stats(spark):
    df = spark.createDataFrame([("1",), ("x",), ("4",), (None,)], "v string")
    assert tuple(numeric_stats(df, "v").first()) == ("1", "x", 2.5)
    assert tuple(numeric_stats(df.limit(0), "v").first()) == (None, None, None)


def test_date_range(spark):
    df = spark.sql("select timestamp'2024-01-10 12:00:00Z' as t union all select timestamp'2024-01-11 12:00:00.5Z'")
    assert tuple(date_range(df, "t").first()) == ("2024-01-10T12:00:00.000Z", "2024-01-11T12:00:00.500Z", "1 day")
    assert tuple(date_range(df.limit(0), "t").first()) == (None, None, "-")


def test_profile(spark):
    rows = [(1, ("x", [1])), (2, ("x", None)), (None, ("y", [1]))]
    df = spark.createDataFrame(rows, "n int, s struct<a: string, l: array<int>>").withColumn("none", F.lit(None).cast("int"))
    found = {(r.field, r["rank"]): tuple(r)[1:] for r in profile(df).collect()}
    assert found == {
        ("n", 1): ("int", 2, 1, 1, "1", 1),
        ("n", 2): ("int", 2, 1, 2, "2", 1),
        ("s.a", 1): ("str", 2, 0, 1, "x", 2),
        ("s.a", 2): ("str", 2, 0, 2, "y", 1),
        ("s.l", 1): ("arr", 1, 1, 1, "[1]", 2),
        ("none", None): ("int", 0, 3, None, None, None),
    }


def test_profile_plan(spark, sf_dir):
    """One scan and one count; top values are limited before they are shuffled by field."""
    text = final_plan(profile(spark.read.parquet(f"{sf_dir}/events.parquet")))
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert "WindowGroupLimit" in final
    assert "SinglePartition" not in final


def test_cell_text(spark):
    df = spark.createDataFrame([(None, (1,)), (5, None)], "n int, s struct<a: int>")
    cells = [cell_text(F.col(f.name), f.dataType) for f in df.schema.fields]
    assert [tuple(r) for r in df.select(*cells).collect()] == [("-", '{"a":1}'), ("5", "-")]


def test_values_are_counted_not_texts(spark):
    """Two instants with one wall-clock time are two values, zero and minus zero are one."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1730610000, 0.0), (1730613600, -0.0), (None, 1.5)], "s bigint, z double")
        df = df.select(F.timestamp_seconds("s").alias("at"), "z")
        rows = profile(df).collect()
        counts = {(r.field, r.unique_count, r.null_count) for r in rows}
        assert counts == {("at", 2, 1), ("z", 2, 0)}
        assert {(r.field, r.value, r["count"]) for r in rows} == {
            ("at", "2024-11-03 05:00:00", 1), ("at", "2024-11-03 06:00:00", 1), ("z", "0.0", 2), ("z", "1.5", 1)
        }
        assert sorted(r.value for r in top_values(df, "at").collect()) == ["2024-11-03 05:00:00", "2024-11-03 06:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_member_facts_and_ranges_in_one_scan(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as a, timestamp'2024-01-03 00:00:00Z' as b")
    ranges = date_ranges(df, ["a", "b"])
    assert [tuple(r) for r in ranges.collect()] == [
        ("2024-01-01T00:00:00.000Z", "2024-01-01T00:00:00.000Z", "0 minutes", "a"),
        ("2024-01-03T00:00:00.000Z", "2024-01-03T00:00:00.000Z", "0 minutes", "b"),
    ]
