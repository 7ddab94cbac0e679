import pytest

from hitlake.operators import extract, extract_matches
from hitlake.sources import infer_schema, read_hits, read_lines, write_report

LOG = [
    '{"_source":{"message":"gave up on job/a17-xk after 3 tries","@timestamp":"2025-06-03T21:05:00.125Z","host":{"name":"east"}}}',
    '{"_source":{"message":"job/b02-qz finished","@timestamp":"2025-06-04T00:10:09.000Z","host":{"name":"west"}}}',
    '{"_source":{"message":"nothing to do","@timestamp":"2025-06-05T03:00:00.000Z","host":{"name":"north"}}}',
    '{"_source":{"message":"gave up on job/a17-xk after 3 tries","@timestamp":"2025-06-03T21:05:00.125Z","host":{"name":"east"}}}',
]
PATTERN = r"job/[a-z]\d{2}-[a-z]{2}"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_deduplicated_report(spark, write):
    report = extract(read_lines(spark, write(*LOG)), PATTERN, fields=["_source.@timestamp:timestamp"], raw=True)
    assert report.columns == ["match", "timestamp"]
    assert rows(report) == [
        ("job/b02-qz", "2025-06-04T00:10:09.000Z"),
        ("job/a17-xk", "2025-06-03T21:05:00.125Z"),
    ]


def test_all_matches(spark, write):
    assert extract(read_lines(spark, write(*LOG)), PATTERN, unique=False, raw=True).count() == 3


def test_several_fields(spark, write):
    fields = ["_source.@timestamp:timestamp", "_source.host.name:host", "_source.none"]
    report = extract(read_lines(spark, write(*LOG)), PATTERN, fields=fields, raw=True)
    assert report.columns == ["match", "timestamp", "host", "none"]
    assert rows(report)[1] == ("job/a17-xk", "2025-06-03T21:05:00.125Z", "east", "")


def test_no_match(spark, write):
    assert rows(extract(read_lines(spark, write(*LOG)), r"NOMATCH\d+", raw=True)) == []


def test_other_source(spark, write):
    lines = read_lines(spark, write('{"kind":"retry","step":"s42 s7"}'))
    assert rows(extract(lines, r"s\d+", "step", raw=True)) == [("s7",), ("s42",)]


def test_invalid_pattern(spark, write):
    with pytest.raises(ValueError, match="Invalid regex pattern"):
        extract(read_lines(spark, write(*LOG)), "[invalid", raw=True)


def test_equal_column_names(spark, write):
    with pytest.raises(ValueError, match="differ"):
        extract(read_lines(spark, write(*LOG)), "x", fields=["a.match"], raw=True)


def test_bad_lines_are_passed_over(spark, write):
    lines = read_lines(spark, write('{"m":"a1"} tail', '{"m":"a2"', "", '{"m":"a3"}', '{"m":null}', '{"n":"a4"}', "7"))
    assert rows(extract(lines, r"a\d", "m", raw=True)) == [("a3",)]


def test_groups_and_empty_matches(spark, write):
    lines = read_lines(spark, write('{"m":"abc","n":5}'))
    assert rows(extract(lines, "x*", "m", unique=False, raw=True)) == [("",)] * 4
    assert rows(extract(lines, "(a)|(b)", "m", unique=False, raw=True)) == [("a",), ("",)]
    assert rows(extract(lines, r"\d", "n", raw=True)) == [("5",)]


def test_typed_documents_give_the_same_report(spark, write):
    path = write(*LOG)
    hits = read_hits(spark, path, schema=infer_schema(spark, path))
    raw = extract(read_lines(spark, path), PATTERN, fields=["_source.host.name:host"], raw=True)
    assert rows(extract(hits, PATTERN, fields=["_source.host.name:host"])) == rows(raw)


def test_order_of_equal_keys_is_as_seen(spark, write):
    lines = [f'{{"m":"hit","k":"same","i":{i}}}' for i in range(50)]
    report = extract(read_lines(spark, write(*lines)).coalesce(1), "hit", "m", ["k", "i"], raw=True)
    assert [r.i for r in report.collect()] == [str(i) for i in range(50)]


def test_order_is_by_code_point(spark, write):
    lines = read_lines(spark, write('{"m":"\\ud83d\\ude00 z Z é \\uffee"}'))
    found = [r[0] for r in rows(extract(lines, r"\S+", "m", raw=True))]
    assert found == sorted(found, reverse=True) and len(found) == 5


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_any_partitioning(spark, sf_dir, partitions):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(partitions)
    report = extract(documents, r"\w+@\w+", "text", ["lang", "source"])
    found = rows(report)
    assert len(found) == len(set(found)) > 0
    assert [(r[1], r[0]) for r in found] == sorted(((r[1], r[0]) for r in found), reverse=True)


def test_extract_matches_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "-")], "i int, t string")
    assert rows(extract_matches(df, r"\w", df.t).select("i", "match")) == [(1, "a"), (1, "b")]
    assert rows(extract_matches(df, r"\w*?", df.t).where("match <> ''").select("i", "match")) == [(1, "a"), (1, "b")]


def test_written_report(spark, write, tmp_path):
    report = extract(read_lines(spark, write(*LOG)), PATTERN, fields=["_source.host.name:host"], raw=True)
    assert write_report(report, str(tmp_path / "out"), crlf=True)
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text == b"match,host\r\njob/b02-qz,west\r\njob/a17-xk,east\r\n"
