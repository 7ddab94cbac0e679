from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from plans import plan

from hitlake.operators.predicates import can_hold
from hitlake.operators import (
    Filter,
    TimeRange,
    between_closed,
    between_half_open,
    bool_,
    filter_column,
    last,
    query_column,
    range_,
    search_all,
    term,
    where_all,
)


def values(df, condition):
    return sorted(r[0] for r in df.where(condition).collect())


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([("a_b",), ("axb",), ("a\\b",), ("A%B",), (None,)], "t string")


@pytest.mark.parametrize(
    "value, found",
    [
        ("a_b", ["A%B", "a\\b", "a_b", "axb"]),
        ("a\\b", ["a\\b"]),
        ("\\", ["a\\b"]),
        ("X", ["axb"]),
        ("a%b", ["A%B", "a\\b", "a_b", "axb"]),
        ("", ["A%B", "a\\b", "a_b", "axb"]),
    ],
)
def test_contains(texts, value, found):
    assert values(texts, filter_column(texts.schema, Filter("t", "contains", value))) == found


def test_neq_drops_nulls(texts):
    assert len(values(texts, filter_column(texts.schema, Filter("t", "neq", "axb")))) == 3


def test_search_treats_null_as_empty(texts):
    assert texts.where(search_all(texts.schema, "%")).count() == 5
    assert texts.where(search_all(texts.schema, "a")).count() == 4


TYPED = [
    ("bigint", "values (-9223372036854775808), (0)"),
    ("double", "values (1.5e300), (double('NaN')), (double('-Infinity')), (-0.1), (1e-7)"),
    ("float", "values (float(1.5e30)), (float('Infinity')), (float(1e-7))"),
    ("decimal", "values (cast(1e-20 as decimal(38, 30))), (-12.50)"),
    ("boolean", "values (true), (false)"),
    ("timestamp", "values (timestamp'2024-01-01 00:00:00.000001'), (timestamp'+12345-01-01 00:00:00')"),
    ("timestamp_ntz", "values (timestamp_ntz'-0001-01-01 00:00:00'), (timestamp_ntz'2024-01-01 01:02:03.5')"),
    ("date", "values (date'2024-01-31'), (date'+12345-01-01')"),
]


@pytest.mark.parametrize("name, rows", TYPED)
def test_search_skips_no_column_that_could_match(spark, name, rows):
    """Every piece of a value's own text is something its type can hold."""
    df = spark.sql(rows).toDF("c")
    for (text,) in df.select(F.col("c").cast("string")).collect():
        for piece in {text, text.upper(), text[1:], text[-3:], "%" + text[0] + "_"}:
            assert can_hold(df.schema["c"].dataType, piece), piece


def test_search_reads_only_columns_that_can_match(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(where_all(events, search="click").select("event_type"))
    assert "ReadSchema: struct<event_type:string,props:string>" in text
    assert where_all(spark.range(5), search="word").count() == 0
    assert where_all(spark.range(15), search="1%4").count() == 1


def test_text_value_on_a_number(spark):
    df = spark.range(10)
    assert values(df, filter_column(df.schema, Filter("id", "gte", "8"))) == [8, 9]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.where(filter_column(df.schema, Filter("id", "eq", "abc"))).collect()


def test_booleans(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert values(df, filter_column(df.schema, Filter("b", "eq", True))) == [True]
    assert values(df, filter_column(df.schema, Filter("b", "eq", "false"))) == [False]


def test_unknown_operator_and_field(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="unknown filter operator"):
        filter_column(df.schema, Filter("id", "like", 1))
    with pytest.raises(ValueError, match="no such field"):
        filter_column(df.schema, Filter("missing", "eq", 1))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_bounds_are_utc(spark, kind, zone):
    moments = ["2024-01-10T00:00:00Z", "2024-01-10T12:00:00Z", "2024-01-11T00:00:00Z"]
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = F.col("t") if kind == "timestamp" else F.replace("t", F.lit("Z"), F.lit(""))
        df = spark.createDataFrame(list(enumerate(moments)), "i int, t string").select("i", text.cast(kind).alias("ts"))
        closed = TimeRange("ts", "2024-01-10T12:00:00Z", "2024-01-11")
        assert values(df, between_closed(df.schema, closed)) == [1, 2]
        assert values(df, between_half_open(df.schema, closed)) == [1]
        aware = datetime(2024, 1, 10, 7, tzinfo=timezone(timedelta(hours=-5)))
        assert values(df, between_closed(df.schema, TimeRange("ts", end=aware))) == [0, 1]
        assert values(df, between_closed(df.schema, TimeRange("ts"))) == [0, 1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_presets():
    now = datetime(2024, 1, 31, 12)
    assert last("ts", "15m", now) == TimeRange("ts", datetime(2024, 1, 31, 11, 45), now)
    assert last("ts", "30d", now).start == datetime(2024, 1, 1, 12)


def test_where_all_combines(spark):
    df = spark.createDataFrame([(i, f"user {i % 3}", (i % 2,)) for i in range(12)], "n int, m string, s struct<k: int>")
    found = where_all(df, [Filter("s.k", "eq", 1), Filter("n", "lt", 9)], search="USER 1")
    assert sorted(r.n for r in found.collect()) == [1, 7]
    assert where_all(df).count() == 12
    assert where_all(df, search='"k":1').count() == 6


def test_query_bodies(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b"], ("x",)), (2, ["b"], ("y",)), (3, None, (None,))], "n int, tags array<string>, host struct<name: string>"
    )
    assert values(df, query_column(df.schema, {"match_all": {}})) == [1, 2, 3]
    assert values(df, query_column(df.schema, {"term": {"tags": "b"}})) == [1, 2]
    assert values(df, query_column(df.schema, {"term": {"host.name": {"value": "y"}}})) == [2]
    both = {"bool": {"must": {"term": {"tags": "b"}}, "filter": [{"range": {"n": {"gte": 2, "lt": 3}}}]}}
    assert values(df, query_column(df.schema, both)) == [2]
    assert values(df, query_column(df.schema, {"bool": {}})) == [1, 2, 3]
    assert values(df, bool_([term(df.schema, "n", 1)], [range_(df.schema, "n", lt=2)])) == [1]
    for body in ({"match": {"n": 1}}, {"bool": {"should": []}}, {"range": {"n": {"gt": 1}}}, {}):
        with pytest.raises(ValueError):
            query_column(df.schema, body)


def test_scan_sees_the_filters(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    filters = [Filter("user_id", "eq", "8"), Filter("event_type", "exists")]
    text = plan(where_all(events, filters, TimeRange("ts", "2024-01-10", "2024-01-12")).select("event_id"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    for part in ("GreaterThanOrEqual(ts", "LessThanOrEqual(ts", "EqualTo(user_id,8)", "IsNotNull(event_type)"):
        assert part in pushed
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "value" not in read and "props" not in read


@pytest.mark.parametrize(
    "operator, value, found",
    [("gt", "5.5", [6, 7]), ("gte", "6.0", [6, 7]), ("lt", "6.25", [5, 6]), ("eq", "5.5", []), ("eq", " 6e0 ", [6]), ("neq", "5.5", [5, 6, 7]), ("lt", "9" * 25, [5, 6, 7]),
     ("eq", "6.0000000000000000000000000001", []), ("gt", "5.9999999999999999999999999999", [6, 7]), ("lt", "1e400", [5, 6, 7]), ("gt", "-1e400", [5, 6, 7]),
     ("gte", "-0.3", [5, 6, 7]), ("lt", "-5.5", []), ("lte", "7." + "0" * 60, [5, 6, 7]), ("eq", "1" * 60, [])],
)
def test_numbers_in_any_spelling(spark, operator, value, found):
    df = spark.createDataFrame([(5,), (6,), (7,)], "n int")
    assert values(df, filter_column(df.schema, Filter("n", operator, value))) == found
