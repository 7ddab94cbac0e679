"""Column functions that render values for reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

from .paths import text_of

# Fixed value: the integers a double holds exactly.
MAX_SAFE_INTEGER = 9007199254740991


def utc(column: Column, data_type: T.DataType) -> Column:
    """A timestamp as UTC wall-clock time, whatever the session time zone."""
    if isinstance(data_type, T.TimestampType):
        micros = F.unix_micros(column)
        return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))
    return column.cast("timestamp_ntz")


def list_time(moment: Column) -> Column:
    """``2024-01-31 23:59`` of a UTC wall-clock time.

    Cut from the time's own text: formatting would go through the session time zone, which
    lacks some wall-clock times.
    """
    return F.substr(moment.cast("string"), F.lit(1), F.lit(16))


def iso_seconds(moment: Column) -> Column:
    """``2024-01-31T23:59:59Z`` of a UTC wall-clock time."""
    text = moment.cast("string")
    date, time = F.substr(text, F.lit(1), F.lit(10)), F.substr(text, F.lit(12), F.lit(8))
    return F.concat(date, F.lit("T"), time, F.lit("Z"))


def iso_millis(moment: Column) -> Column:
    """``2024-01-31T23:59:59.000Z`` of a UTC wall-clock time."""
    text = moment.cast("string")
    date, time = F.substr(text, F.lit(1), F.lit(10)), F.substr(text, F.lit(12), F.lit(8))
    millis = F.rpad(F.substr(text, F.lit(21), F.lit(3)), 3, "0")
    return F.concat(date, F.lit("T"), time, F.lit("."), millis, F.lit("Z"))


def _blank_as_dash(text: Column, shown: Column) -> Column:
    """``-`` for no text, the text itself where it could not be read as a number."""
    return F.when(F.coalesce(text, F.lit("")) == "", "-").otherwise(F.coalesce(shown, text))


def fmt_epoch_ms(text: Column, style: Callable[[Column], Column] = list_time) -> Column:
    """Epoch milliseconds as UTC time, in one of the styles above."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    moment = F.timestamp_add("MILLISECOND", text.cast("string").try_cast("bigint"), start)
    return _blank_as_dash(text.cast("string"), style(moment))


def fmt_count(text: Column) -> Column:
    """An integer with thousands separators."""
    number = F.coalesce(text.cast("string").try_cast("bigint").cast("decimal(38,0)"), _integer(text.cast("string")))
    return _blank_as_dash(text.cast("string"), F.format_number(number, 0))


def _integer(text: Column) -> Column:
    """An integer of up to 38 digits."""
    return F.when(F.trim(text).rlike(r"^[+-]?\d{1,38}$"), F.trim(text).try_cast("decimal(38,0)"))


def fmt_bytes(size: Column) -> Column:
    """A size in B, KB, MB or GB, base 1024."""
    return (
        F.when(size.isNull(), F.lit(None))
        .when(size < 1024, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < 1024**2, F.format_string("%.1f KB", size / F.lit(1024.0)))
        .when(size < 1024**3, F.format_string("%.1f MB", size / F.lit(1024.0**2)))
        .otherwise(F.format_string("%.2f GB", size / F.lit(1024.0**3)))
    )


def json_safe(number: Column) -> Column:
    """A 64-bit integer that JSON writes as a number where a double holds it, else as text."""
    exact = number.between(-MAX_SAFE_INTEGER, MAX_SAFE_INTEGER)
    return F.when(exact, number.cast("bigint").cast("variant")).otherwise(
        number.cast("string").cast("variant")
    )


def cell_text(column: Column, data_type: T.DataType) -> Column:
    """A table cell: JSON for nested values, ``-`` for NULL."""
    return F.coalesce(text_of(column, data_type), F.lit("-"))


def span_text(start: Column, end: Column) -> Column:
    """Whole days between two UTC times, else hours, else minutes; ``-`` without both."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    of_day = F.pmod(micros, F.lit(86_400_000_000))
    days = ((micros - of_day) / F.lit(86_400_000_000)).cast("bigint")
    hours = F.floor(of_day / F.lit(3_600_000_000))
    minutes = F.floor(of_day / F.lit(60_000_000))

    def counted(n: Column, unit: str) -> Column:
        return F.concat(n.cast("string"), F.when(n == 1, f" {unit}").otherwise(f" {unit}s"))

    text = (
        F.when(days > 0, counted(days, "day"))
        .when(hours > 0, counted(hours, "hour"))
        .otherwise(counted(minutes, "minute"))
    )
    return F.when(micros.isNull(), "-").otherwise(text)
