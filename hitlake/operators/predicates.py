"""Filters as Columns. Literals take the type of their column, so scans can use them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from decimal import ROUND_FLOOR, Decimal, InvalidOperation
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.paths import column_at, text_of, type_at
from ..functions.schema import TIMESTAMPS

# The time-range presets.
PRESETS = {
    "15m": timedelta(minutes=15),
    "1h": timedelta(hours=1),
    "24h": timedelta(hours=24),
    "7d": timedelta(days=7),
    "30d": timedelta(days=30),
}

# The characters that text of a type is made of, in lower case.
DIGITS = "-0123456789"
ALPHABETS = [
    (T.IntegralType, DIGITS),
    (T.FractionalType, DIGITS + ".+einfitya"),
    (T.BooleanType, "truefals"),
    (T.DatetimeType, DIGITS + ":. +"),
]

Value = str | int | float | bool | datetime


@dataclass(frozen=True)
class Filter:
    field: str
    operator: str
    value: Value | None = None


@dataclass(frozen=True)
class TimeRange:
    field: str
    start: str | datetime | None = None
    end: str | datetime | None = None


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


#: Beyond every number a column of whole numbers holds.
FAR = 10**36


def field_type(schema: T.StructType, field: str) -> T.DataType:
    data_type = type_at(schema, field)
    if data_type is None:
        raise ValueError(f"no such field: {field}")
    return data_type


def typed_literal(value: Value, data_type: T.DataType) -> Column:
    """``value`` as a literal of the column's type; times are read as UTC unless they say otherwise."""
    if isinstance(data_type, TIMESTAMPS) and isinstance(value, (str, datetime)):
        moment = value if isinstance(value, datetime) else datetime.fromisoformat(value)
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        text = moment.isoformat(sep=" ", timespec="microseconds")
        if isinstance(data_type, T.TimestampType):
            return F.lit(text + "Z").cast("timestamp")
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(value, str) and isinstance(data_type, T.IntegralType):
        return _number(value, data_type)
    if isinstance(value, str):
        return F.lit(value).cast(data_type)
    return F.lit(value)


def _number(text: str, data_type: T.DataType) -> Column:
    """A number in any spelling, to be compared exactly with a column of whole numbers.

    A whole number has the column's type where it fits. Any other lies between two whole numbers, and
    compares like the middle between them; beyond 37 digits like the last number that has so many.
    """
    try:
        number = Decimal(text.strip())
    except InvalidOperation:
        number = Decimal("NaN")
    if not number.is_finite():
        return F.lit(text).cast(data_type)  # an error that names the text
    if number.copy_abs() >= FAR:
        return F.lit(str(FAR if number > 0 else -FAR)).cast(T.DecimalType(38, 0))
    whole = int(number.to_integral_value(ROUND_FLOOR))
    if number != whole:
        # Spelled out: a division would round long numbers.
        half = f"{whole}.5" if whole >= 0 else f"-{-whole - 1}.5"
        return F.lit(half).cast(T.DecimalType(38, 1))
    bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32}.get(type(data_type), 64)
    kind = data_type if -(1 << bits - 1) <= whole < 1 << bits - 1 else T.DecimalType(38, 0)
    return F.lit(str(whole)).cast(kind)


def contains_pattern(text: str) -> str:
    """Substring pattern: ``%`` and ``_`` are wildcards, a backslash is itself."""
    return "%" + text.replace("\\", "\\\\") + "%"


def filter_column(schema: T.StructType, f: Filter) -> Column:
    """One field filter."""
    data_type = field_type(schema, f.field)
    column = column_at(f.field)
    match f.operator:
        case "exists":
            return column.isNotNull()
        case "not_exists":
            return column.isNull()
        case "contains":
            return text_of(column, data_type).ilike(contains_pattern(str(f.value)))
    literal = typed_literal(f.value, data_type)
    match f.operator:
        case "eq":
            return column == literal
        case "neq":
            return column != literal
        case "gt":
            return column > literal
        case "gte":
            return column >= literal
        case "lt":
            return column < literal
        case "lte":
            return column <= literal
    raise ValueError(f"unknown filter operator: {f.operator}")


def between_closed(schema: T.StructType, time: TimeRange) -> Column:
    """Times from ``start`` to ``end``, both included, each optional."""
    data_type = field_type(schema, time.field)
    column, bounds = column_at(time.field), []
    if time.start is not None:
        bounds.append(column >= typed_literal(time.start, data_type))
    if time.end is not None:
        bounds.append(column <= typed_literal(time.end, data_type))
    return all_of(bounds)


def between_half_open(schema: T.StructType, time: TimeRange) -> Column:
    """Times from ``start`` on and before ``end``, each optional."""
    data_type = field_type(schema, time.field)
    column, bounds = column_at(time.field), []
    if time.start is not None:
        bounds.append(column >= typed_literal(time.start, data_type))
    if time.end is not None:
        bounds.append(column < typed_literal(time.end, data_type))
    return all_of(bounds)


def last(field: str, preset: str, now: datetime) -> TimeRange:
    """A preset range that ends now, for :func:`between_closed`."""
    return TimeRange(field, now - PRESETS[preset], now)


def can_hold(data_type: T.DataType, text: str) -> bool:
    """Whether text of this type could contain ``text``: a number never contains a word."""
    literal = set(text.lower()) - set("%_")
    return all(literal <= set(chars) for kind, chars in ALPHABETS if isinstance(data_type, kind))


def search_all(schema: T.StructType, text: str) -> Column:
    """Whether any top-level column contains ``text``; nested columns are searched as JSON.

    Columns whose type cannot hold the text are not even read.
    """
    pattern = contains_pattern(text)
    texts = [
        text_of(column_at(f'"{f.name}"'), f.dataType) for f in schema.fields if can_hold(f.dataType, text)
    ]
    return any_of([F.coalesce(value, F.lit("")).ilike(pattern) for value in texts])


def where_all(
    df: DataFrame,
    filters: Sequence[Filter] = (),
    time: TimeRange | None = None,
    search: str = "",
) -> DataFrame:
    """Rows that pass the time range, every filter and the free-text search."""
    conditions = []
    if time is not None:
        conditions.append(between_closed(df.schema, time))
    conditions += [filter_column(df.schema, f) for f in filters]
    if search:
        conditions.append(search_all(df.schema, search))
    return df.where(all_of(conditions)) if conditions else df


# --- query bodies ----------------------------------------------------------------------


def match_all() -> Column:
    """Every document."""
    return F.lit(True)


def term(schema: T.StructType, field: str, value: Value) -> Column:
    """Exact equality; on an array field, membership."""
    data_type = field_type(schema, field)
    column = column_at(field)
    if isinstance(data_type, T.ArrayType):
        return F.array_contains(column, typed_literal(value, data_type.elementType))
    return column == typed_literal(value, data_type)


def range_(schema: T.StructType, field: str, **bounds: Value) -> Column:
    """``gte`` and ``lt`` bounds on any field."""
    data_type = field_type(schema, field)
    column, conditions = column_at(field), []
    for name, value in bounds.items():
        if name not in ("gte", "lt"):
            raise ValueError(f"unsupported range bound: {name}")
        literal = typed_literal(value, data_type)
        conditions.append(column >= literal if name == "gte" else column < literal)
    return all_of(conditions)


def bool_(must: Sequence[Column] = (), filter: Sequence[Column] = ()) -> Column:
    """All of the given conditions; documents are not scored, so both lists mean the same."""
    return all_of([*must, *filter])


def query_column(schema: T.StructType, query: Mapping[str, Any]) -> Column:
    """A query body made of ``match_all``, ``term``, ``range`` and ``bool``."""
    if len(query) != 1:
        raise ValueError(f"expected one query clause, got {sorted(query)}")
    [(kind, body)] = query.items()
    if kind == "match_all":
        return match_all()
    if kind == "term":
        [(field, value)] = body.items()
        return term(schema, field, value["value"] if isinstance(value, Mapping) else value)
    if kind == "range":
        [(field, bounds)] = body.items()
        return range_(schema, field, **bounds)
    if kind == "bool":
        unknown = set(body) - {"must", "filter"}
        if unknown:
            raise ValueError(f"unsupported bool clause: {sorted(unknown)}")

        def clauses(name: str) -> list[Column]:
            given = body.get(name, [])
            given = [given] if isinstance(given, Mapping) else given
            return [query_column(schema, clause) for clause in given]

        return bool_(clauses("must"), clauses("filter"))
    raise ValueError(f"unsupported query clause: {kind}")
