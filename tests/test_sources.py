import csv
import io
import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from hitlake.functions import fmt_bytes, fmt_count, fmt_epoch_ms, json_safe, span_text
from hitlake.functions.text import iso_seconds
from hitlake.operators import SortKey, date_range, extract
from hitlake.sources import (
    as_hits,
    as_json_array,
    bad_lines,
    infer_schema,
    read_hits,
    read_lines,
    store_hits,
    write_csv,
    write_json_array,
    write_jsonl,
    write_report,
)


def parts(path):
    """Content of a folder of part files, in order."""
    return b"".join(p.read_bytes() for p in sorted(Path(path).glob("part-*")))


def test_bad_lines_become_null_rows(spark, write):
    path = write('{"a":1,"b":{"c":"x"}}', "not json", '{"a":2}', "", "5", '{"a":3} tail', '{"a":4')
    rows = read_hits(spark, path).select("a", "b.c", "_corrupt_record").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [
            (1, "x", None),
            (None, None, "not json"),
            (2, None, None),
            (None, None, "5"),
            (None, None, '{"a":3} tail'),
            (None, None, '{"a":4'),
        ],
        key=str,
    )


def test_object_size_limit(spark, write):
    path = write('{"a":"short"}', '{"a":"' + "é" * 50 + '"}')
    limited = read_hits(spark, path, max_object_bytes=60).collect()
    assert sorted((r.a, r._corrupt_record is None) for r in limited if r.a) == [("short", True)]
    assert read_hits(spark, path).where("a is null").count() == 0
    assert read_hits(spark, path, max_object_bytes=None).where("a is null").count() == 0


def test_iso_times_are_timestamps(spark, write):
    path = write('{"@timestamp":"2026-01-14T07:34:50.697Z","n":1.5,"big":9007199254740993}')
    df = read_hits(spark, path)
    assert dict(df.dtypes) == {
        "@timestamp": "timestamp",
        "n": "double",
        "big": "bigint",
        "_corrupt_record": "string",
    }
    assert df.first().big == 9007199254740993


@pytest.mark.parametrize(
    "text, kind",
    [
        ("2026-01-14T07:34:50Z", "timestamp"),
        ("2026-01-14T07:34:50.6Z", "timestamp"),
        ("2026-01-14T07:34:50.697123+02:00", "timestamp"),
        ("2026-01-14 07:34:50", "timestamp"),
        ("2026-01-14T07:34:50.123456789", "timestamp"),
        ("10001", "string"),
        ("2026", "string"),
        ("12:30", "string"),
        ("2026-01", "string"),
        ("text", "string"),
    ],
)
def test_text_taken_for_a_time(spark, write, text, kind):
    """Ids made of digits stay text; what is taken for a time is also read as one."""
    df = read_hits(spark, write(json.dumps({"t": text})))
    assert df.schema["t"].dataType.simpleString() == kind
    assert df.where("t is not null").count() == 1


def test_keys_that_differ_in_case(spark, write):
    path = write('{"a":1,"A":2}')
    before = spark.conf.get("spark.sql.caseSensitive")
    df = read_hits(spark, path)
    assert spark.conf.get("spark.sql.caseSensitive") == before
    assert {c: v for c, v in zip(df.columns, df.first())} == {"a": 1, "A": 2, "_corrupt_record": None}


def test_schema_skips_inference(spark, write):
    path = write('{"a":1,"b":2}')
    assert read_hits(spark, path, schema=infer_schema(spark, path).add("z", "string")).first().z is None


@pytest.mark.parametrize("limit", [None, 1000])
def test_values_that_do_not_fit_the_schema(spark, write, limit):
    path = write('{"a":"x","b":2,"c":{"d":1}}', '{"a":1,"b":2,"c":"text"}', '{"b":3,"end of the line":1}')
    schema = "a int, b int, c struct<d: int>"
    rows = read_hits(spark, path, schema=T.StructType.fromDDL(schema), max_object_bytes=limit).select("a", "b", "c.d")
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, 2, None), (None, 2, 1), (None, 3, None)]


def test_lines_that_are_no_object(spark, write):
    path = write('{"a":1}', "null", "[1]", '[{"a":2}]', '"a"', '{"a":1},{"a":2}', '{"a":3},{"end of the line":1}] x')
    rows = read_hits(spark, path, schema=T.StructType.fromDDL("a int, `end of the line` int"))
    assert sorted(rows.select("a", "_corrupt_record").collect(), key=str)[0] == (1, None)
    assert rows.where("_corrupt_record is not null and a is null").count() == 6


@pytest.mark.parametrize("split", [64, 1000, 10**8])
def test_bad_line_numbers(spark, tmp_path, split):
    """Line numbers count through all blocks of a file, however it is split."""
    expected = set()
    for name, n in (("a", 700), ("b", 33), ("c", 1)):
        lines = []
        for i in range(1, n + 1):
            bad = i % 7 == 0 or i == n
            lines.append(f"broken {name} {i}" if bad else json.dumps({"i": i, "pad": "x" * (i % 40)}))
            if bad:
                expected.add((name, i, lines[-1]))
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = bad_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert {(r.file[-1], r.line_no, r.value) for r in rows} == expected
    assert len(rows) == len(expected)


def test_blank_lines_are_bad_lines(spark, write):
    path = write('{"a":1}', "", "x", '{"a":2}')
    assert [(r.line_no, r.value) for r in bad_lines(spark, path).orderBy("line_no").collect()] == [(2, ""), (3, "x")]


def test_write_jsonl_keeps_nulls_and_order(spark, tmp_path):
    df = spark.createDataFrame([(3, None), (1, "é\n"), (2, "")], "n int, s string")
    write_jsonl(df.orderBy("n"), str(tmp_path / "out"))
    lines = parts(tmp_path / "out").decode().splitlines()
    assert [json.loads(line) for line in lines] == [
        {"n": 1, "s": "é\n"},
        {"n": 2, "s": ""},
        {"n": 3, "s": None},
    ]


def test_write_jsonl_keeps_microseconds(spark, tmp_path):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00.123456' as a, timestamp'2024-01-01 00:00:00.000001Z' as b")
    write_jsonl(df, str(tmp_path / "out"))
    assert json.loads(parts(tmp_path / "out")) == {
        "a": "2024-01-01T00:00:00.123456",
        "b": "2024-01-01T00:00:00.000001Z",
    }


def test_raw_lines_pass_unchanged(spark, write, tmp_path):
    lines = ['{ "b" : 1e5 }', "not json", '{"é": "\\u00e9"}']
    write_jsonl(read_lines(spark, write(*lines)), str(tmp_path / "out"), raw=True)
    assert sorted(parts(tmp_path / "out").decode().splitlines()) == sorted(lines)


def test_safe_integers(spark, tmp_path):
    df = spark.createDataFrame(
        [(2**53 - 1, (2**53, [-(2**53)]), None), (1, None, -(2**63))],
        "n bigint, s struct<m: bigint, l: array<bigint>>, x bigint",
    )
    write_jsonl(df, str(tmp_path / "out"), safe_integers=True)
    lines = [json.loads(line) for line in parts(tmp_path / "out").decode().splitlines()]
    assert sorted(lines, key=str) == sorted(
        [
            {"n": 2**53 - 1, "s": {"m": str(2**53), "l": [str(-(2**53))]}, "x": None},
            {"n": 1, "s": None, "x": str(-(2**63))},
        ],
        key=str,
    )
    assert df.select(F.to_json(F.struct(json_safe(F.col("n")).alias("n")))).count() == 2


def test_json_array(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("n"), F.lit(None).cast("string").alias("s")).repartition(7)
    keys = [SortKey("n", descending=True)]
    expected = [{"n": n, "s": None} for n in range(999, -1, -1)]
    assert json.loads(as_json_array(df, keys).first()[0]) == expected
    write_json_array(df.orderBy(F.desc("n")), str(tmp_path / "out"))
    assert json.loads(parts(tmp_path / "out")) == expected
    assert len(list((tmp_path / "out").glob("part-*"))) > 1
    with pytest.raises(Exception, match="write_json_array"):
        as_json_array(df, keys, max_rows=999).collect()


def test_json_array_of_nothing(spark, tmp_path):
    df = spark.range(0)
    assert as_json_array(df, [SortKey("id")]).first()[0].replace(" ", "") == "[]"
    write_json_array(df.orderBy("id"), str(tmp_path / "out"))
    assert json.loads(parts(tmp_path / "out")) == []


CELLS = [
    ("plain", "x"),
    (" blanks ", 'say "hi"'),
    ("a,b", "line\nbreak"),
    ("crlf\r\nhere", ""),
    ("é", "\\back"),
    ("", ""),
]


def test_csv_bytes_equal_pythons(spark, tmp_path):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CELLS)], "i int, a string, b string")
    write_csv(df.orderBy("i").select("a", "b"), str(tmp_path / "out"), crlf=True)
    expected = io.StringIO(newline="")
    csv.writer(expected).writerows([("a", "b"), *CELLS])
    assert parts(tmp_path / "out") == expected.getvalue().encode()
    single = io.StringIO(newline="")
    csv.writer(single).writerows([("a",), *((a,) for a, _ in CELLS)])
    write_csv(df.orderBy("i").select("a"), str(tmp_path / "single"), crlf=True)
    assert parts(tmp_path / "single") == single.getvalue().encode()


def test_csv_reads_back(spark, tmp_path):
    df = spark.createDataFrame(CELLS, "a string, b string").coalesce(1)
    write_csv(df, str(tmp_path / "out"))
    text = parts(tmp_path / "out").decode()
    assert list(csv.reader(io.StringIO(text, newline=""))) == [["a", "b"], *map(list, CELLS)]


def test_empty_report_leaves_no_file(spark, write, tmp_path):
    report = extract(read_lines(spark, write('{"m":"x"}')), r"NOMATCH\d+", "m", raw=True)
    assert write_report(report, str(tmp_path / "out")) is False
    assert not (tmp_path / "out").exists()


def test_as_hits(spark):
    df = spark.createDataFrame([(7, ("n",))], "id bigint, host struct<name: string>")
    hit = as_hits(df, "id", ["host.name", "id"]).first()
    assert (hit._id, hit._source.host.name, list(hit.sort)) == ("7", "n", ["n", 7])
    assert as_hits(df, "id", ["host.name"]).schema["sort"].dataType.names == ["host.name"]


@pytest.mark.parametrize(
    "text, shown", [("1234567", "1,234,567"), ("12", "12"), ("-1234", "-1,234"), ("n/a", "n/a"), ("", "-"), (None, "-"), ("5.5", "5.5")]
)
def test_fmt_count(spark, text, shown):
    assert spark.createDataFrame([(text,)], "t string").select(fmt_count(F.col("t"))).first()[0] == shown


@pytest.mark.parametrize(
    "text, listed, described",
    [
        ("1700000000123", "2023-11-14 22:13", "2023-11-14T22:13:20Z"),
        ("0", "1970-01-01 00:00", "1970-01-01T00:00:00Z"),
        ("soon", "soon", "soon"),
        (None, "-", "-"),
    ],
)
def test_fmt_epoch_ms(spark, text, listed, described):
    df = spark.createDataFrame([(text,)], "t string")
    columns = fmt_epoch_ms(F.col("t")), fmt_epoch_ms(F.col("t"), iso_seconds)
    assert tuple(df.select(*columns).first()) == (listed, described)


def test_times_do_not_depend_on_the_session_zone(spark):
    """02:30 on this day does not exist in New York."""
    gap = str(int(datetime(2024, 3, 10, 2, 30, tzinfo=timezone.utc).timestamp() * 1000))
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(gap,)], "t string")
        moment = F.timestamp_millis(F.col("t").cast("bigint")).alias("m")
        assert df.select(fmt_epoch_ms(F.col("t"))).first()[0] == "2024-03-10 02:30"
        assert date_range(df.select(moment), "m").first().oldest == "2024-03-10T02:30:00.000Z"
        assert date_range(df.select(F.lit("2024-03-10 02:30").cast("timestamp_ntz").alias("m")), "m").first().oldest == (
            "2024-03-10T02:30:00.000Z"
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


@pytest.mark.parametrize(
    "size, shown",
    [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1280, "1.3 KB"), (1048576, "1.0 MB"), (5_500_000_000, "5.12 GB")],
)
def test_fmt_bytes(spark, size, shown):
    assert spark.createDataFrame([(size,)], "n bigint").select(fmt_bytes(F.col("n"))).first()[0] == shown


@pytest.mark.parametrize(
    "start, end, span",
    [
        ("2024-01-10 12:00:00", "2024-01-11 12:00:00", "1 day"),
        ("2024-01-10 12:00:00", "2024-01-11 11:59:59.999999", "23 hours"),
        ("2024-01-10 12:00:00", "2024-01-15 12:00:00", "5 days"),
        ("2024-01-10 12:00:00", "2024-01-10 13:00:00", "1 hour"),
        ("2024-01-10 12:00:00", "2024-01-10 12:01:30", "1 minute"),
        ("2024-01-10 12:00:00", "2024-01-10 12:00:00", "0 minutes"),
        ("2024-01-11 12:00:00", "2024-01-10 12:00:00", "0 minutes"),
        ("2024-01-11 12:00:00", "2024-01-11 11:00:00", "23 hours"),
        (None, "2024-01-10 12:00:00", "-"),
    ],
)
def test_span(spark, start, end, span):
    df = spark.createDataFrame([(start, end)], "a string, b string")
    a, b = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    assert df.select(span_text(a, b)).first()[0] == span


def test_a_value_that_does_not_fit_keeps_its_text(spark, write):
    lines = ['{"k":"x","a":1}', '{"k":2,"a":3}', '{"k":4,"a":5} tail', '{"k":{"deep":1},"a":6}', "[1]"]
    for limit in (None, 1000):
        found = read_hits(spark, write(*lines), schema=T.StructType.fromDDL("k bigint, a bigint"), max_object_bytes=limit)
        rows = sorted(map(tuple, found.collect()), key=str)
        assert rows == sorted([(None, 1, lines[0]), (2, 3, None), (None, None, lines[2]), (None, 6, lines[3]), (None, None, lines[4])], key=str)


def test_keys_that_differ_in_case(spark, write, tmp_path):
    before = spark.conf.get("spark.sql.caseSensitive")
    hits = read_hits(spark, write('{"a":1,"A":2,"o":{"Key":3,"key":4}}')).drop("_corrupt_record")
    assert sorted(hits.columns) in (["A", "a_2", "o"], ["A_2", "a", "o"]) and spark.conf.get("spark.sql.caseSensitive") == before
    row = store_hits(hits, str(tmp_path / "stored")).first().asDict(True)
    assert sorted([row.get("a", row.get("a_2")), row.get("A", row.get("A_2"))]) == [1, 2] and sorted(row["o"].values()) == [3, 4]


def test_only_asked_columns_are_parsed(spark, write):
    path = write('{"a":1,"b":{"c":2,"d":"x"},"e":5}')
    hits = read_hits(spark, path, schema=T.StructType.fromDDL("a int, b struct<c: int, d: string>, e int"), columns=["b.c", "e"])
    assert hits.columns == ["b", "e", "_corrupt_record"] and hits.first()[:2] == ((2,), 5)
    assert hits.schema["b"].dataType.names == ["c"]


def test_json_array_with_empty_first_partitions(spark, tmp_path):
    df = spark.range(0, 10, 1, 4).where("id > 5")
    write_json_array(df, str(tmp_path / "out"))
    assert [r["id"] for r in json.loads(parts(tmp_path / "out"))] == [6, 7, 8, 9]
    write_jsonl(spark.createDataFrame([("plain text",)], "value string"), str(tmp_path / "lines"))
    assert json.loads(parts(tmp_path / "lines")) == {"value": "plain text"}


def test_report_runs_once(spark, write, tmp_path):
    counter = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    report = spark.range(100, numPartitions=3).mapInArrow(seen, "id long")
    assert write_report(report, str(tmp_path / "out")) and counter.value == 100


def test_sizes_and_counts(spark):
    assert spark.range(1).select(fmt_bytes(F.lit(None).cast("bigint"))).first()[0] is None
    assert spark.range(1).select(fmt_count(F.lit("12345678901234567890123"))).first()[0] == "12,345,678,901,234,567,890,123"
