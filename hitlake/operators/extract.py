"""Regular-expression matches as a deduplicated, sorted report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.paths import object_lines, parse_field_spec, typed_text
from ..functions.patterns import Finder, finder

DEFAULT_SOURCE = "_source.message"
#: The place of a row, as long as no field has that name.
POSITION = "_position"


def extract_matches(df: DataFrame, pattern: str, source: Column, name: str = "match") -> DataFrame:
    """One row per match of ``pattern`` in ``source``.

    A match reports its first group, or itself if the pattern has none; a group that took no
    part reports an empty string. Rows without a source or a match drop out.
    """
    find = finder(pattern)
    found = df.where(find.may_be_in(source)).withColumn(name, find.all_in(source))
    return _one_row_each(found, name)


def _one_row_each(found: DataFrame, name: str) -> DataFrame:
    """Explode the array ``name``.

    A plain explode makes the optimizer test the array before building it, which would search
    every text once more.
    """
    columns = [F.explode_outer(f"`{name}`").alias(name) if c == name else F.col(f"`{c}`") for c in found.columns]
    return found.select(*columns).where(F.col(f"`{name}`").isNotNull())


def _rows(
    found: DataFrame,
    find: Finder,
    source: Column,
    fields: Sequence[tuple[str, Column]],
    keep: Sequence[str],
) -> DataFrame:
    columns = [F.coalesce(column, F.lit("")).alias(name) for name, column in fields]
    return _one_row_each(found.select(find.all_in(source).alias("match"), *columns, *keep), "match")


def raw_matches(
    lines: DataFrame,
    pattern: str,
    source: str = DEFAULT_SOURCE,
    fields: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Match rows of raw JSON lines (column ``value``); lines that are not JSON are passed over.

    ``keep`` names columns to carry along as they are.
    """
    specs = _unique([parse_field_spec(spec) for spec in fields])
    find = finder(pattern)
    unparsed = find.may_be_in_line(F.col("value"))
    if unparsed is not None:
        lines = lines.where(unparsed)
    parsed = object_lines(lines, [source, *(path for path, _ in specs)], keep)
    columns = [(name, F.col(f"`{i}`")) for i, (_, name) in enumerate(specs, 1)]
    text = F.col("`0`")
    return _rows(parsed.where(find.may_be_in(text)), find, text, columns, keep)


def typed_matches(
    df: DataFrame,
    pattern: str,
    source: str = DEFAULT_SOURCE,
    fields: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Match rows of a typed DataFrame."""
    specs = _unique([parse_field_spec(spec) for spec in fields])
    columns = [(name, typed_text(df, path)) for path, name in specs]
    find, text = finder(pattern), typed_text(df, source)
    return _rows(df.where(find.may_be_in(text)), find, text, columns, keep)


def _unique(specs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    names = ["match", *(name for _, name in specs)]
    if len(set(names)) < len(names):
        raise ValueError(f"report columns must differ in name: {names}")
    return specs


def _positioned(df: DataFrame, name: str) -> DataFrame:
    """``df`` with each row's place ``name``: file, block and place inside for a scan, else the place alone."""
    local = F.monotonically_increasing_id().alias("row")
    file, block = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    try:
        return df.withColumn(name, F.struct(file, block, local))
    except AnalysisException:  # no scan, so no files
        return df.withColumn(name, F.struct(local))


def dedupe(rows: DataFrame, position: str | None = None) -> DataFrame:
    """Each row once, at the first of its places if the column ``position`` has them."""
    if position is None:
        return rows.dropDuplicates()
    keys = [c for c in rows.columns if c != position]
    return rows.groupBy(*(F.col(f"`{c}`") for c in keys)).agg(F.min(position).alias(position))


def report_order(rows: DataFrame, position: str | None = None) -> DataFrame:
    """Descending by first field and match (by match alone without fields), ties as first seen.

    The column ``position`` makes the order total, so equal rows spread over the sort's partitions,
    and is dropped. Rows without one (a stream's output) are ordered by their other fields instead.
    """
    columns = [c for c in rows.columns if c != position]
    keys = [F.col(f"`{c}`").desc() for c in [*columns[1:2], columns[0]]]
    ties = [F.col(position).asc()] if position else [F.col(f"`{c}`").asc() for c in columns[2:]]
    return rows.orderBy(*keys, *ties).select(*(F.col(f"`{c}`") for c in columns))


def extract(
    df: DataFrame,
    pattern: str,
    source: str = DEFAULT_SOURCE,
    fields: Sequence[str] = (),
    unique: bool = True,
    raw: bool = False,
) -> DataFrame:
    """The report: ``match`` and one text column per ``path`` or ``path:name`` field.

    ``df`` is a scan: typed documents, or with ``raw`` the lines from :func:`hitlake.sources.read_lines`.
    """
    position = POSITION
    taken = {name.lower() for name in [*df.columns, *(parse_field_spec(spec)[1] for spec in fields)]}
    while position in taken:
        position = f"_{position}"
    matches = raw_matches if raw else typed_matches
    rows = matches(_positioned(df, position), pattern, source, fields, keep=[position])
    # Either way the matches are shuffled before they are sorted: a sort samples its input, and
    # must not search the documents a second time for that.
    return report_order(dedupe(rows, position) if unique else rows.repartition(position), position)
