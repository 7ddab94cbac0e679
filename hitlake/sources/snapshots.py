"""Snapshots: the files of a table written down with what they hold, under a name.

A snapshot is a manifest: per file its size, rows, the rows before it, and the least and
greatest value of chosen fields. Files that are added to the table later do not belong to it,
so an export repeats exactly, in this session or another; counts, time spans and row numbers
are read off the manifest; and a range of a field opens only the files that can hold it.
Tables that :func:`hitlake.sources.store_hits` clustered by that field have files with narrow
bounds, of which a range opens few.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.paths import column_at
from ..functions.rows import literal_rows
from ..operators.numbering import BROADCAST_FILES, file_offsets, with_offsets
from ..operators.predicates import TimeRange, all_of, between_closed, between_half_open, field_type, typed_literal
from ..operators.profile import date_texts

FILES, TABLE = "files", "table"


@dataclass(frozen=True)
class Snapshot:
    """A named manifest, as :func:`take_snapshot` wrote it or :func:`open_snapshot` found it.

    ``fields`` are those with bounds, in the order of the manifest's columns ``min_0``, ``max_0``, …
    """

    spark: SparkSession
    place: str
    schema: T.StructType
    fields: tuple[str, ...]

    def manifest(self) -> DataFrame:
        """file, bytes, rows, offset, and ``min_i``, ``max_i`` of each field: one row per file, in file order."""
        ends = [T.StructField(f"{label}_{at}", field_type(self.schema, f)) for at, f in enumerate(self.fields) for label in ("min", "max")]
        known = [T.StructField("file", T.StringType()), *(T.StructField(name, T.LongType()) for name in ("bytes", "rows")), *ends]
        return self.spark.read.schema(T.StructType([*known, T.StructField("offset", T.LongType())])).parquet(f"{self.place}/{FILES}")

    @cached_property
    def files(self) -> list[str]:
        """All files, in order: as many as a scan lists on the driver."""
        return _names(self.manifest())

    def read(self, files: Sequence[str]) -> DataFrame:
        """Rows of some of the files."""
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def rows(self) -> DataFrame:
        """All rows of the snapshot, whatever the table's folder holds by now."""
        return self.read(self.files)

    def count(self) -> DataFrame:
        """The number of rows, as one row ``total``; no file of the table is read."""
        return self.manifest().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"))

    def bounds(self, field: str) -> tuple[str, str]:
        if field not in self.fields:
            raise ValueError(f"the snapshot has no bounds of {field!r}")
        at = self.fields.index(field)
        return f"min_{at}", f"max_{at}"

    def date_range(self, field: str) -> DataFrame:
        """Oldest and newest time of a field and their span, as :func:`hitlake.operators.date_range`, from the manifest."""
        low, high = self.bounds(field)
        return self.manifest().agg(F.min(low).alias("oldest"), F.max(high).alias("newest")).select(*date_texts(field_type(self.schema, field)))

    def files_between(self, time: TimeRange) -> list[str]:
        """The files that can hold a time from ``start`` to ``end``."""
        low, high = self.bounds(time.field)
        data_type = field_type(self.schema, time.field)
        conditions = [F.col(low).isNotNull()]  # a file without any value holds none in a range
        if time.start is not None:
            conditions.append(F.col(high) >= typed_literal(time.start, data_type))
        if time.end is not None:
            conditions.append(F.col(low) <= typed_literal(time.end, data_type))
        return _names(self.manifest().where(all_of(conditions)))

    def between(self, time: TimeRange, half_open: bool = False) -> DataFrame:
        """Rows in a range of a field with bounds, from the files that can hold them; without start and end all rows."""
        if time.start is None and time.end is None:
            return self.rows()
        inside = between_half_open if half_open else between_closed
        return self.read(self.files_between(time)).where(inside(self.schema, time))

    def number(self, name: str = "row_id") -> DataFrame:
        """All rows with their position, from 0, as :func:`hitlake.operators.number_parquet`; the rows per file are not counted again."""
        rows = self.rows()
        placed = rows.select(
            F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in rows.columns]).alias("_row"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.row_index").alias("_index"),
        )
        files = self.manifest().select(F.col("file").alias("_file"), F.col("rows").alias("_rows"), F.col("offset").alias("_offset"))
        numbered = with_offsets(placed, files, broadcast=len(self.files) <= BROADCAST_FILES)
        return numbered.select((F.col("_offset") + F.col("_index")).alias(name), "_row.*")

    def row_by_id(self, row_id: int) -> DataFrame:
        """One row by its position; only the file that holds it is opened."""
        holder = self.manifest().where((F.col("offset") <= row_id) & (F.col("offset") + F.col("rows") > row_id)).first()
        if holder is None:
            return self.read([])
        return self.read([holder.file]).where(F.col("_metadata.row_index") == row_id - holder.offset)

    def count_until(self, condition: Callable[[T.StructType], Column] | None, cap: int) -> tuple[int, int]:
        """Rows that pass ``condition``, counted until they are more than ``cap``, and how many files that took.

        Files are counted in waves, each four times the last: every wave is a Spark job with partial
        counts, and no row leaves its task. A manifest that counts for itself, without a condition, reads none.
        """
        if condition is None:
            return self.count().first().total, 0
        found, done, wave = 0, 0, 1
        while found <= cap and done < len(self.files):
            part = self.files[done : done + wave]
            found += self.read(part).where(condition(self.schema)).count()
            done += len(part)
            wave *= 4
        return found, done

    def total_hits(self, condition: Callable[[T.StructType], Column] | None = None, cap: int = 10_000) -> DataFrame:
        """Hit count with its relation, as :func:`hitlake.operators.total_hits`, that stops reading once it is beyond ``cap``."""
        found, _ = self.count_until(condition, cap)
        return literal_rows(self.spark, [(min(found, cap), "gte" if found > cap else "eq")], "value bigint, relation string")


def _names(manifest: DataFrame) -> list[str]:
    return [file for _, file in sorted(tuple(row) for row in manifest.select("offset", "file").collect())]


def take_snapshot(spark: SparkSession, path: str, root: str, name: str, fields: Sequence[str] = ()) -> Snapshot:
    """Write down the files that a Parquet table has now as ``name`` under ``root``; an existing name is an error.

    One scan, of ``fields`` alone: without any, only footers are read.
    """
    table = spark.read.parquet(path)
    for field in fields:
        field_type(table.schema, field)
    file = F.col("_metadata.file_path").alias("file")
    ends = [end(column_at(f)).alias(f"{label}_{at}") for at, f in enumerate(fields) for end, label in ((F.min, "min"), (F.max, "max"))]
    facts = table.groupBy(file, F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"), *ends)
    place = f"{root}/{name}"
    facts.write.mode("error").parquet(f"{place}/counted")
    counted = spark.read.parquet(f"{place}/counted")
    ordered = file_offsets(counted.select(F.col("file").alias("_file"), F.col("rows").alias("_rows"), F.col("file").alias("_order")))
    offsets = ordered.select(F.col("_file").alias("file"), F.col("_offset").alias("offset"))
    counted.join(offsets, "file").coalesce(max(1, len(table.inputFiles()) // 100_000)).write.mode("error").parquet(f"{place}/{FILES}")
    about = [(_data_schema(spark, path, table).json(), list(fields))]
    spark.createDataFrame(about, "schema string, fields array<string>").write.mode("error").json(f"{place}/{TABLE}")
    return open_snapshot(spark, root, name)


def _data_schema(spark: SparkSession, path: str, table: DataFrame) -> T.StructType:
    """The columns that files hold themselves, without those in folder names."""
    files = table.inputFiles()
    if not files:
        return table.schema
    own = set(spark.read.parquet(files[0]).columns)
    return T.StructType([f for f in table.schema.fields if f.name in own])


def open_snapshot(spark: SparkSession, root: str, name: str) -> Snapshot:
    """The snapshot of that name, in whatever session it was taken."""
    place = f"{root}/{name}"
    about = spark.read.schema("schema string, fields array<string>").json(f"{place}/{TABLE}").first()
    return Snapshot(spark, place, T.StructType.fromJson(json.loads(about.schema)), tuple(about.fields or ()))


# Types whose footer statistics Spark's scan can stand in for values.
FOOTER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)


def footer_bounds(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """``total`` rows and ``min``, ``max`` of top-level number and date fields, from the footers: no value is read.

    One row per field. One job, when called: footers are aggregated by Spark's own pushdown, which
    a session of its own switches on. Where a file has no statistics of a field, as one without any
    value in it, the fields' values are read after all.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    table = own.read.parquet(path)
    for field in fields:
        if not isinstance(field_type(table.schema, field), FOOTER_TYPES):
            raise ValueError(f"footers have no usable bounds of {field!r}")
    ends = [end(column_at(f)) for f in fields for end in (F.min, F.max)]
    try:
        own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        total, *values = table.agg(F.count(F.lit(1)), *ends).first()
    except Exception as failed:
        if "No min/max found" not in str(failed):
            raise
        own.conf.set("spark.sql.parquet.aggregatePushdown", "false")
        total, *values = table.agg(F.count(F.lit(1)), *ends).first()
    text = lambda value: None if value is None else str(value)
    rows = [(f, total, text(values[2 * at]), text(values[2 * at + 1])) for at, f in enumerate(fields)]
    return literal_rows(spark, rows, "field string, total bigint, min string, max string")
