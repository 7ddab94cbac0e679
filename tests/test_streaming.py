import json
import os

from hitlake.operators import report_order
from hitlake.streaming import extract_stream, run_extract, start_extract, stream_lines


def put(folder, name, *docs):
    (folder / name).write_text("".join((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs))


def run(spark, tmp_path, **options):
    lines = stream_lines(spark, str(tmp_path / "in"))
    extraction = extract_stream(lines, r"id=(\d+)", "m", ["h"], **options)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    start_extract(extraction.rows, out, state).awaitTermination()
    if extraction.undated is not None:
        start_extract(extraction.undated, str(tmp_path / "undated"), str(tmp_path / "undated-state")).awaitTermination()
    return [tuple(r) for r in report_order(spark.read.parquet(out)).collect()]


def test_rows_are_remembered_between_runs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "a", {"m": "id=1 id=1 id=2", "h": "x"}, "broken", {"m": "id=1", "h": "x"}, {"m": "id=1"})
    assert run(spark, tmp_path) == [("2", "x"), ("1", "x"), ("1", "")]
    put(tmp_path / "in", "b", {"m": "id=2", "h": "x"}, {"m": "id=3", "h": "y"})
    assert run(spark, tmp_path) == [("3", "y"), ("2", "x"), ("1", "x"), ("1", "")]


def test_event_time(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(
        tmp_path / "in",
        "a",
        {"m": "id=1", "h": "x", "t": "2024-01-01T00:00:00Z"},
        {"m": "id=1", "h": "x", "t": "2024-01-01T01:00:00Z"},
        {"m": "id=5", "h": "x", "t": "unknown"},
        {"m": "id=6", "h": "x"},
    )
    assert run(spark, tmp_path, event_time="t") == [("1", "x")]
    undated = sorted(r[0] for r in spark.read.parquet(str(tmp_path / "undated")).collect())
    assert undated == ["5", "6"]


def test_late_rows_come_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    at = lambda n, day, time="00:00:00": {"m": f"id={n}", "h": "x", "t": f"2024-01-{day:02}T{time}Z"}
    batches = [
        [at(1, 20), at(2, 1), {"m": "id=3", "h": "x"}],
        [at(1, 20), at(4, 18)],
        [at(5, 19), at(6, 19, "00:00:01"), at(7, 2), at(7, 2), at(1, 20), at(8, 25)],
        [at(9, 18), at(10, 23), {"m": "id=11", "h": "x", "t": "?"}],
        [at(12, 23), at(13, 24), at(14, 24, "12:00:00")],
        [],
        [at(15, 23)],
    ]
    out = str(tmp_path / "out")
    for number, docs in enumerate(batches):
        put(tmp_path / "in", f"f{number}", *docs)
        extraction = extract_stream(stream_lines(spark, str(tmp_path / "in")), r"id=(\d+)", "m", ["h"], event_time="t")
        run_extract(extraction, out, str(tmp_path / "state"))
    found = sorted((int(r.match), r.part) for r in spark.read.parquet(out).collect())
    late = {5, 7, 9, 12, 13, 15}
    parts = {n: "late" if n in late else "undated" if n in (3, 11) else "row" for n in range(1, 16)}
    assert found == sorted([*parts.items(), (7, "late")])


def test_an_unfinished_batch_is_finished_first(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out, state = str(tmp_path / "out"), tmp_path / "state"
    for number, day in enumerate((20, 20, 21, 1, 2)):
        put(tmp_path / "in", f"f{number}", {"m": f"id={number}", "h": "x", "t": f"2024-01-{day:02}T00:00:00Z"})
        extraction = extract_stream(stream_lines(spark, str(tmp_path / "in")), r"id=(\d+)", "m", ["h"], event_time="t")
        if number == 4:
            for name in ("3", ".3.crc"):
                (state / "stream" / "commits" / name).unlink()
        run_extract(extraction, out, str(state))
    found = sorted((int(r.match), r.part) for r in spark.read.parquet(out).collect())
    assert found == [(0, "row"), (1, "row"), (2, "row"), (3, "late"), (4, "late")]


def test_query_has_late_and_undated_rows(spark, sf_dir):
    from registered.extraction import stream_parts

    assert {r.part for r in stream_parts(spark, sf_dir).select("part").distinct().collect()} == {"row", "late", "undated"}


def test_several_batches_a_run_and_clashing_names(spark, tmp_path):
    """A file a batch, oldest first; fields may be called what the stream uses inside."""
    (tmp_path / "in").mkdir()
    days = [20, 1, 25, 19, 24]
    for number, day in enumerate(days):
        doc = {"m": f"id={number} id={number}", "part": "p", "batch": "b", "seen_at": "s", "salt": "x", "t": f"2024-01-{day:02}T00:00:00Z"}
        put(tmp_path / "in", f"f{number}", doc, {"m": "id=9", "part": "p", "t": None}, {"m": "id=0", "t": "2024-01-25T00:00:00Z"})
        os.utime(tmp_path / "in" / f"f{number}", (1_700_000_000 + number, 1_700_000_000 + number))
    lines = stream_lines(spark, str(tmp_path / "in"), files_per_batch=1)
    extraction = extract_stream(lines, r"id=(\d+)", "m", ["part", "batch", "seen_at", "salt", "t:a.b"], event_time="t")
    run_extract(extraction, str(tmp_path / "out"), str(tmp_path / "state"))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert set(found.columns) == {"match", "part", "batch", "seen_at", "salt", "a.b", "_batch", "_part"}
    got = sorted((r.match, r.part, r._part, r._batch) for r in found.collect())
    expected = [("9", "p", "undated", n) for n in range(5)] + [("0", "", "row", 0)]
    for number, day in enumerate(days):  # the first batch reaches the 25th by its last line
        late = number > 1 and day <= 24  # the watermark counts from the batch after the next
        expected += [(str(number), "p", "late" if late else "row", number)] * (2 if late else 1)
    assert got == sorted(expected)


def test_arrival_time_has_no_late_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for number in range(3):
        put(tmp_path / "in", f"f{number}", {"m": "id=1", "h": "x"}, {"m": f"id={number}", "h": "x"})
        run_extract(extract_stream(stream_lines(spark, str(tmp_path / "in")), r"id=(\d+)", "m", ["h"]), str(tmp_path / "out"), str(tmp_path / "state"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.match, r.part) for r in rows) == [("0", "row"), ("1", "row"), ("2", "row")]
    assert sorted(p.name for p in (tmp_path / "state" / "state").iterdir()) == ["1", "2"]
