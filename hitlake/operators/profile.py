"""Counts, value statistics and time spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.paths import column_at, split_path, text_of
from ..functions.schema import short_type, walk_fields
from ..functions.text import iso_millis, span_text, utc
from .predicates import Filter, TimeRange, field_type, where_all

TOP_VALUES = 10


def row_count(df: DataFrame) -> DataFrame:
    """All rows, as one row ``total``."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def filtered_count(
    df: DataFrame, filters: Sequence[Filter] = (), time: TimeRange | None = None, search: str = ""
) -> DataFrame:
    """Rows that pass a view's filters, as one row ``total``."""
    return row_count(where_all(df, filters, time, search))


def total_hits(df: DataFrame, cap: int | None = None, track: bool = True) -> DataFrame:
    """Hit count with its relation: ``eq`` is exact, ``gte`` means more than ``cap``.

    Without tracking the value is 0. Whatever the cap, the plan is one lazy count of all rows with partial
    sums: no hit leaves its task. A count that stops reading at the cap is
    :meth:`hitlake.sources.Snapshot.total_hits`.
    """
    counted = (df if track else df.limit(0)).agg(F.count(F.lit(1)).alias("n"))
    if not track or cap is None:
        return counted.select(F.col("n").alias("value"), F.lit("eq").alias("relation"))
    return counted.select(
        F.least(F.col("n"), F.lit(cap).cast("bigint")).alias("value"),
        F.when(F.col("n") > cap, "gte").otherwise("eq").alias("relation"),
    )


def field_counts(df: DataFrame, field: str) -> DataFrame:
    """Distinct non-null values and NULLs of one field."""
    c = column_at(field)
    return df.agg(
        F.count_distinct(c).alias("unique_count"),
        (F.count(F.lit(1)) - F.count(c)).alias("null_count"),
    )


def top_values(df: DataFrame, field: str, k: int = TOP_VALUES) -> DataFrame:
    """The ``k`` most frequent non-null values as text, ties by value."""
    data_type = field_type(df.schema, field)
    counted = df.select(column_at(field).alias("value")).where(F.col("value").isNotNull())
    return (
        counted.groupBy("value")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(text_of(F.col("value"), data_type).alias("value"), "count")
        .orderBy(F.desc("count"), F.asc("value"))
        .limit(k)
    )


def value_histogram(top: DataFrame) -> DataFrame:
    """Bar heights in percent of the highest; ``top`` is a short list from :func:`top_values`."""
    highest = F.greatest(F.max("count").over(Window.partitionBy()), F.lit(1))
    return top.withColumn("height", F.col("count") / highest * 100)


def numeric_stats(df: DataFrame, field: str) -> DataFrame:
    """Minimum, maximum and mean; NULL without values, and values that are no number are left out of the mean."""
    c = column_at(field)
    return df.agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c.try_cast("double")).alias("avg"))


def date_bounds(df: DataFrame, field: str) -> tuple:
    """Aggregates ``oldest`` and ``newest`` of a time field."""
    return F.min(column_at(field)).alias("oldest"), F.max(column_at(field)).alias("newest")


def date_texts(data_type: T.DataType) -> list:
    """``oldest`` and ``newest`` as ISO text in UTC, and the ``span`` between them."""
    start, end = utc(F.col("oldest"), data_type), utc(F.col("newest"), data_type)
    return [
        iso_millis(start).alias("oldest"),
        iso_millis(end).alias("newest"),
        span_text(start, end).alias("span"),
    ]


def date_range(df: DataFrame, field: str = "@timestamp") -> DataFrame:
    """Oldest and newest time of a field and their span; NULLs and ``-`` without documents."""
    data_type = field_type(df.schema, field)
    return df.agg(*date_bounds(df, field)).select(*date_texts(data_type))


def date_ranges(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``date_range`` of several time fields, one row each, from one scan."""
    bounds = [F.struct(*date_bounds(df, f)).alias(f"b{i}") for i, f in enumerate(fields)]
    types = [field_type(df.schema, f) for f in fields]
    rows = [
        F.struct(
            F.lit(".".join(split_path(f))).alias("field"),
            utc(F.col(f"b{i}.oldest"), t).alias("oldest"),
            utc(F.col(f"b{i}.newest"), t).alias("newest"),
        )
        for i, (f, t) in enumerate(zip(fields, types))
    ]
    each = df.agg(*bounds).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return each.select(*date_texts(T.TimestampNTZType()), "field")


def _leaves(df: DataFrame, fields: Sequence[str] | None) -> list:
    return [f for f in walk_fields(df.schema) if fields is None or f.display_path in fields]


def _value_counts(df: DataFrame, leaves: Sequence) -> DataFrame:
    """(field, value, count) of the leaves, fields by path: the scan is unpivoted and counted once, combined before the shuffle."""
    texts = df.select(*(text_of(column_at(f.path), f.data_type).alias(f.path) for f in leaves))
    values = texts.unpivot([], [F.col(f"`{f.path}`") for f in leaves], "field", "value")
    return values.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """How often every leaf field has every value: field, value (text, or NULL) and count."""
    leaves = _leaves(df, fields)
    names = F.create_map(*(F.lit(x) for f in leaves for x in (f.path, f.display_path)))
    return _value_counts(df, leaves).withColumn("field", names[F.col("field")])


def profile(df: DataFrame, fields: Sequence[str] | None = None, k: int = TOP_VALUES) -> DataFrame:
    """Statistics of every leaf field in one pass: distinct values, NULLs and the top values.

    One row per field and top value, one with NULL ``rank`` for a field without values.
    The scan is unpivoted and counted once per (field, value); map-side counts keep frequent
    values out of the shuffle. The totals and the top values both read those counts.
    """
    leaves = _leaves(df, fields)
    counts = _value_counts(df, leaves)
    totals = counts.groupBy("field").agg(
        F.count("value").alias("unique_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("null_count"),
    )
    # NULL comes last and is dropped after ranking: dropped before, the filter would reach the
    # scan, and the two halves would no longer share it.
    by_frequency = Window.partitionBy("field").orderBy(
        F.col("value").isNull(), F.desc("count"), F.asc("value")
    )
    top = (
        counts.withColumn("rank", F.row_number().over(by_frequency))
        .where((F.col("rank") <= k) & F.col("value").isNotNull())
    )
    names = F.create_map(*(F.lit(x) for f in leaves for x in (f.path, f.display_path)))
    types = F.create_map(*(F.lit(x) for f in leaves for x in (f.path, short_type(f.data_type))))
    return totals.join(top, "field", "left").select(
        names[F.col("field")].alias("field"),
        types[F.col("field")].alias("type"),
        "unique_count",
        "null_count",
        "rank",
        "value",
        "count",
    )
