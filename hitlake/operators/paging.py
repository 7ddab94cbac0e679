"""Sort, page, seek and number results in a total order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.paths import column_at
from .numbering import file_offsets, number_rows, parquet_files
from .predicates import all_of, field_type, typed_literal

DEFAULT_TIME = "@timestamp"
DEFAULT_LIMIT = 100
DEFAULT_PAGE_SIZE = 1000


@dataclass(frozen=True)
class SortKey:
    field: str
    descending: bool = False

    def column(self) -> Column:
        """NULLs last either way."""
        c = column_at(self.field)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_last()


def flip_sort(current: SortKey | None, field: str) -> SortKey:
    """The sort after choosing a field: descending first, flipped when chosen again."""
    if current is not None and current.field == field:
        return SortKey(field, not current.descending)
    return SortKey(field, True)


def order_columns(keys: Sequence[SortKey]) -> list[Column]:
    return [key.column() for key in keys]


def with_tiebreak(keys: Sequence[SortKey], unique: str) -> list[SortKey]:
    """``keys`` made total by a unique field, unless they hold it already."""
    keys = list(keys)
    if all(key.field != unique for key in keys):
        keys.append(SortKey(unique))
    return keys


def export_order(unique: str, sort: Sequence[SortKey] | None = None) -> list[SortKey]:
    """Order of an export: by time unless asked otherwise, then by the unique field."""
    return with_tiebreak([SortKey(DEFAULT_TIME)] if sort is None else sort, unique)


def sort_by(df: DataFrame, field: str, direction: str = "desc", *, unique: str) -> DataFrame:
    """All rows ordered by one field, ties by the unique one."""
    if direction not in ("asc", "desc"):
        raise ValueError(f"direction must be asc or desc, not {direction!r}")
    return df.orderBy(*order_columns(with_tiebreak([SortKey(field, direction == "desc")], unique)))


def page(
    df: DataFrame, keys: Sequence[SortKey], offset: int = 0, limit: int = DEFAULT_LIMIT, unique: str | None = None
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the order of ``keys``.

    Ties are settled by the field ``unique``. Without one, rows that the keys leave equal are
    ordered by all columns that have an order, so pages neither repeat nor lose rows; all of them
    are then read. Every task keeps ``offset + limit`` rows at most: to walk far into a large
    result take :func:`keyset_page`, to jump there :func:`page_select`.
    """
    settling = _settling(df, keys) if unique is None else []
    keys = keys if unique is None else with_tiebreak(keys, unique)
    return df.orderBy(*order_columns(keys), *settling).offset(offset).limit(limit)


#: Ranges that a round of :func:`page_select` counts, rows sampled for the bounds of each, and rows it is content to sort.
RANGES, SAMPLED_PER_RANGE, SORTED_ROWS = 32, 32, 100_000


def page_select(
    df: DataFrame, keys: Sequence[SortKey], offset: int = 0, limit: int = DEFAULT_LIMIT, *, unique: str, sorted_rows: int = SORTED_ROWS
) -> DataFrame:
    """The rows of :func:`page` for an offset of any depth, found by selection instead of a sort.

    Rounds of jobs narrow the part of the order that holds the page: a sample of its rows (some
    ``RANGES * SAMPLED_PER_RANGE``, their keys alone) gives bounds, the rows between them are counted
    with partial sums, and the ranges that hold the page are kept, until they hold ``sorted_rows``
    or no bound splits them any more. Only those are sorted; no row before them leaves its task.
    A round reads the key columns, and of files ordered by the first key only those in the part.
    """
    keys = with_tiebreak(keys, unique)
    low: list[Any] | None = None
    high: list[Any] | None = None
    skipped, inside = 0, df.count()
    while inside > sorted_rows and limit > 0 and offset < skipped + inside:
        part = _between_keys(df, keys, low, high).select(*(_key_column(df, key).alias(f"k{at}") for at, key in enumerate(keys)))
        own_keys = [SortKey(f"k{at}", key.descending) for at, key in enumerate(keys)]
        wanted = RANGES * SAMPLED_PER_RANGE
        sample = part.sample(min(1.0, 1.2 * wanted / inside), seed=inside % 1_000_003).orderBy(*order_columns(own_keys)).limit(2 * wanted).collect()
        bounds = sample[SAMPLED_PER_RANGE // 2 :: SAMPLED_PER_RANGE]
        if not bounds:
            break
        behind = part.agg(*(F.count_if(keyset_after(part, own_keys, list(bound))) for bound in bounds)).first()
        upto = [skipped + inside - n for n in behind]  # rows of the table up to each bound, itself included
        before = max((at for at, n in enumerate(upto) if n <= offset), default=None)
        after = min((at for at, n in enumerate(upto) if n >= offset + limit), default=None)
        if before is None and after is None:
            break
        end = skipped + inside if after is None else upto[after]
        if before is not None:
            low, skipped = _key_values(df, keys, bounds[before]), upto[before]
        high = high if after is None else _key_values(df, keys, bounds[after])
        inside = end - skipped
    found = _between_keys(df, keys, low, high)
    return found.orderBy(*order_columns(keys)).offset(offset - skipped).limit(limit)


def _key_column(df: DataFrame, key: SortKey) -> Column:
    """A key to be collected: times as numbers, which no time zone changes."""
    c = column_at(key.field)
    return F.unix_micros(c) if isinstance(field_type(df.schema, key.field), T.TimestampType) else c


def _key_values(df: DataFrame, keys: Sequence[SortKey], row: Sequence[Any]) -> list[Any]:
    """Collected keys as values of their columns."""
    times = [isinstance(field_type(df.schema, key.field), T.TimestampType) for key in keys]
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return [start + timedelta(microseconds=v) if is_time and v is not None else v for v, is_time in zip(row, times)]


def _between_keys(df: DataFrame, keys: Sequence[SortKey], low: Sequence[Any] | None, high: Sequence[Any] | None) -> DataFrame:
    """Rows after ``low`` and not after ``high``, each the key values of a row or None."""
    part = df if low is None else df.where(keyset_after(df, keys, low))
    return part if high is None else part.where(~F.coalesce(keyset_after(df, keys, high), F.lit(False)) & _upto_first(df, keys, high))


def _upto_first(df: DataFrame, keys: Sequence[SortKey], high: Sequence[Any]) -> Column:
    """What follows for the first key from not being after ``high``, spelled out for the scan."""
    first, value = column_at(keys[0].field), high[0]
    if value is None:
        return F.lit(True)
    literal = typed_literal(value, field_type(df.schema, keys[0].field))
    return first >= literal if keys[0].descending else first <= literal


def _settling(df: DataFrame, keys: Sequence[SortKey]) -> list[Column]:
    """The columns that no key names, as far as values of their types can be compared."""
    named = {key.field for key in keys}
    return [
        F.col("`" + f.name.replace("`", "``") + "`").asc_nulls_last()
        for f in df.schema.fields
        if f.name not in named and _has_order(f.dataType)
    ]


def _has_order(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _has_order(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_has_order(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType, T.CalendarIntervalType))


def page_info(total: DataFrame, offset: int, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Page position from a one-row count (column ``total``)."""
    n, last_offset = F.col("total"), F.greatest(F.lit(0), (F.col("pages") - 1) * limit)
    return total.select(
        n, F.ceil(n / F.lit(limit)).alias("pages"), F.lit(offset // limit + 1).cast("bigint").alias("page")
    ).select(
        "total",
        "page",
        "pages",
        F.when(n > 0, F.lit(offset + 1).cast("bigint")).alias("showing_from"),
        F.when(n > 0, F.least(F.lit(offset + limit).cast("bigint"), n)).alias("showing_to"),
        (F.lit(offset) > 0).alias("has_previous"),
        (F.lit(offset + limit) < n).alias("has_next"),
        F.lit(max(0, offset - limit)).cast("bigint").alias("previous_offset"),
        F.greatest(F.lit(0), F.least(last_offset, F.lit(offset + limit))).cast("bigint").alias("next_offset"),
        last_offset.cast("bigint").alias("last_offset"),
    )


def page_offset(page_number: int, total: int, limit: int = DEFAULT_LIMIT) -> int:
    """Offset of a page, clamped to the pages there are."""
    pages = -(-total // limit)
    return max(0, min((page_number - 1) * limit, (pages - 1) * limit))


def keyset_after(df: DataFrame, keys: Sequence[SortKey], after: Sequence[Any]) -> Column:
    """Rows strictly after a row with the given sort values.

    Spelled out key by key, because scans cannot use a comparison of structs. The leading
    bound repeats what the rest implies, so that a scan can skip on the first key.
    """
    if len(keys) != len(after):
        raise ValueError("one value per sort key is needed")
    columns = [column_at(key.field) for key in keys]
    literals = [
        None if value is None else typed_literal(value, field_type(df.schema, key.field))
        for key, value in zip(keys, after)
    ]

    def beyond(i: int) -> Column:
        if literals[i] is None:  # NULLs are last, nothing follows them
            return F.lit(False)
        c = columns[i]
        return (c < literals[i] if keys[i].descending else c > literals[i]) | c.isNull()

    def same(i: int) -> Column:
        return columns[i].isNull() if literals[i] is None else columns[i] == literals[i]

    steps = [all_of([*(same(j) for j in range(i)), beyond(i)]) for i in range(len(keys))]
    condition = reduce(lambda a, b: a | b, steps)
    if literals[0] is None:
        return columns[0].isNull() & condition
    c = columns[0]
    bound = c <= literals[0] if keys[0].descending else c >= literals[0]
    return (bound | c.isNull()) & condition


def keyset_page(
    df: DataFrame,
    keys: Sequence[SortKey],
    after: Sequence[Any] | None = None,
    size: int = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """The ``size`` rows that follow the given sort values; the first ones without values."""
    rest = df if after is None else df.where(keyset_after(df, keys, after))
    return rest.orderBy(*order_columns(keys)).limit(size)


def number_pages(
    df: DataFrame, keys: Sequence[SortKey], size: int = DEFAULT_PAGE_SIZE, number: str | None = None, page: str | None = None
) -> DataFrame:
    """Every row with its number and page, both from 1, in the order of ``keys``.

    The columns are called ``row_no`` and ``page``, with underscores before where ``df`` has such columns,
    or as given; a given name that ``df`` has is an error.
    """
    taken = {name.lower() for name in df.columns}
    names = []
    for given, usual in ((number, "row_no"), (page, "page")):
        name = given or usual
        while given is None and name in taken:
            name = f"_{name}"
        if name.lower() in taken:
            raise ValueError(f"column exists: {name}")
        taken.add(name.lower())
        names.append(name)
    numbered = number_rows(df, order_columns(keys), names[0])
    return numbered.withColumn(names[1], (F.floor((F.col(names[0]) - 1) / size) + 1).cast("bigint"))


def size(df: DataFrame, keys: Sequence[SortKey], n: int) -> DataFrame:
    """The first ``n`` hits of a search."""
    return page(df, keys, 0, n)


def row_by_id(spark: SparkSession, path: str, row_id: int, files: DataFrame | None = None) -> DataFrame:
    """One row of a Parquet table by its position (see :func:`number_parquet`).

    The rows per file tell which file holds the row; only that one is read. They are counted
    anew each time unless given as ``files``, which for many lookups in one snapshot is
    :func:`parquet_files` of the table, written down once.
    """
    table = spark.read.parquet(path)
    holder = file_offsets(parquet_files(table) if files is None else files).where(
        (F.col("_offset") <= row_id) & (F.col("_offset") + F.col("_rows") > row_id)
    )
    found = holder.first()
    if found is None:
        return table.limit(0)
    return table.where(
        (F.col("_metadata.file_path") == found["_file"])
        & (F.col("_metadata.row_index") == row_id - found["_offset"])
    )


def row_detail(df: DataFrame) -> DataFrame:
    """Each row as indented JSON, NULL fields kept; meant for single rows."""
    return df.select(F.to_json(F.struct("*"), JSON_DETAIL).alias("detail"))


# Times keep their microseconds; the JSON writer's own default cuts them to milliseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
JSON_DETAIL = {**JSON_OPTIONS, "pretty": "true"}
