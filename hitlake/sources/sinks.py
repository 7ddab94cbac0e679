"""Writing results: JSON lines, one JSON array, CSV.

Each writer leaves a folder of part files whose names follow the row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import json_safe
from ..operators.paging import JSON_OPTIONS, SortKey, order_columns
from ..scratch import delete_path


def json_text(df: DataFrame, safe_integers: bool = False) -> Column:
    """A row as one JSON object, NULL fields kept.

    ``safe_integers`` writes integers beyond a double's exact range as text.
    """
    columns = [F.col(f"`{f.name}`") for f in df.schema.fields]
    if safe_integers:
        columns = [_safe(c, f.dataType).alias(f.name) for c, f in zip(columns, df.schema.fields)]
    return F.to_json(F.struct(*columns), JSON_OPTIONS)


def _safe(column: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.LongType):
        return json_safe(column)
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda item: _safe(item, data_type.elementType))
    if isinstance(data_type, T.StructType):
        fields = [_safe(column.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def write_jsonl(df: DataFrame, path: str, safe_integers: bool = False, raw: bool = False) -> None:
    """One JSON object per line; ``raw`` lines (their text column ``value``) pass unchanged."""
    (df if raw else df.select(json_text(df, safe_integers).alias("value"))).write.text(path)


def as_json_array(df: DataFrame, keys: Sequence[SortKey], max_rows: int | None = None) -> DataFrame:
    """A result as a single indented JSON array (column ``value``).

    The array is one value of one row, made in one task. More than ``max_rows`` rows, if given,
    are an error; :func:`write_json_array` writes any number from many tasks.
    """
    first = df.orderBy(*order_columns(keys))
    if max_rows is not None:
        first = first.limit(max_rows + 1)
    rank = F.monotonically_increasing_id()
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    by_rank = lambda a, b: F.signum(a["rank"] - b["rank"]).cast("int")
    rows = F.array_sort(F.collect_list(F.struct("rank", "row")), by_rank)
    text = F.to_json(F.transform(rows, lambda r: r["row"]), {**JSON_OPTIONS, "pretty": "true"})
    array = first.select(rank.alias("rank"), row.alias("row")).agg(text.alias("value"), F.count(F.lit(1)).alias("n"))
    if max_rows is None:
        return array.select("value")
    too_many = F.raise_error(F.lit(f"more than {max_rows} rows: use write_json_array"))
    return array.select(F.when(F.col("n") > max_rows, too_many).otherwise(F.col("value")).alias("value"))


def write_json_array(df: DataFrame, path: str) -> None:
    """A sorted result of any size as part files that together, in the order of their names, are one JSON array.

    Rows are computed and written once, each partition's first one without a comma before it. Which
    partitions have rows shows afterwards: brackets, and a comma between two parts, are lines of
    files of their own, whose names sort where they belong.
    """
    spark = df.sparkSession
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    df.select(F.concat(F.when(first, "").otherwise(","), json_text(df)).alias("value")).write.text(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def put(name: str, text: str) -> None:
        out = files.create(spark._jvm.org.apache.hadoop.fs.Path(folder, name))
        out.write(bytearray(text.encode()))
        out.close()

    listed = [(status.getPath().getName(), status.getLen()) for status in files.listStatus(folder)]
    filled = sorted(name for name, size in listed if name.startswith("part-") and size)
    put("part-!", "[\n")
    for name in filled[:-1]:
        put(f"{name}~", ",\n")
    put("part-~", "]\n")


def write_csv(df: DataFrame, path: str, crlf: bool = False) -> None:
    """Header and rows as CSV, minimal quotes, quotes doubled.

    Lines end in LF and every part file has a header. With ``crlf`` lines end in CRLF and the
    header is a part file of its own, so the parts together are one file.
    """
    if not crlf:
        df.write.options(
            header=True,
            quote='"',
            escape='"',
            emptyValue="",
            nullValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
        return
    names = [F.lit(name) for name in df.columns]
    header = df.sparkSession.range(0, 1, 1, 1).select(_csv_line(names).alias("value"))
    rows = df.select(_csv_line([F.col(f"`{c}`") for c in df.columns]).alias("value"))
    header.union(rows).write.option("lineSep", "\r\n").text(path)


def _csv_line(columns: Sequence[Column]) -> Column:
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    special = '[",\r\n]'
    cells = [
        F.when(t.rlike(special), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"')))
        .when(F.lit(len(texts) == 1) & (t == ""), '""')
        .otherwise(t)
        for t in texts
    ]
    return F.concat_ws(",", *cells)


def write_report(report: DataFrame, path: str, crlf: bool = False) -> bool:
    """Write an extraction report as CSV; an empty one leaves no file. Returns whether it wrote.

    The report runs once: whether it had rows is read off what was written.
    """
    spark = report.sparkSession
    write_csv(report, path, crlf)
    if spark.read.text(path).limit(2).count() > 1:  # more than the header
        return True
    delete_path(spark, path)
    return False
