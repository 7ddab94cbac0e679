"""Line-delimited JSON as typed documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.paths import CORRUPT, column_at, parse_objects, split_path, type_at
from ..functions.schema import walk_fields
from ..functions.text import utc
from ..scratch import materialize, owned_scratch
from .lines import read_lines

# Fixed value: text taken for a time. Spark's own reading would take any number for a year.
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIME = "yyyy-MM-dd['T'][' ']HH:mm:ss[.SSSSSSSSS][XXX]"


#: Rows that show which text fields can be days at all.
FIRST_ROWS = 1_000


def infer_schema(spark: SparkSession, *paths: str, sample: float = 1.0) -> T.StructType:
    """Schema of NDJSON files, ISO times as timestamps, texts that are all ISO days as dates.

    Keys that differ only in case are different fields. One pass over the data, or over a ``sample`` of the
    lines; a second one, of those fields alone, only if some text fields hold nothing but days in
    the first rows. Infer once, keep the schema.
    """
    own = spark.newSession()  # its settings are nobody else's
    own.conf.set("spark.sql.caseSensitive", "true")
    reader = own.read.options(
        inferTimestamp=True, timestampFormat=ISO_TIME, mode="DROPMALFORMED", samplingRatio=sample
    )
    found = reader.json(list(paths)).schema
    texts = [f.path for f in walk_fields(found) if isinstance(f.data_type, T.StringType)]
    if not texts:
        return found
    rows = own.read.schema(found).option("mode", "DROPMALFORMED").json(list(paths))
    texts = _all_days(rows.limit(FIRST_ROWS), texts, unknown=True)
    if texts:
        texts = _all_days(rows if sample == 1 else rows.sample(sample, seed=0), texts, unknown=False)
    return _as_dates(found, [split_path(path) for path in texts])


def _all_days(rows: DataFrame, paths: Sequence[str], unknown: bool) -> list[str]:
    """The fields whose values are all ISO days; those without values if they are to count."""
    values = [column_at(path) for path in paths]
    all_days = [F.bool_and(v.rlike(ISO_DAY) & v.try_cast("date").isNotNull()) for v in values]
    days = rows.agg(*(d.alias(f"d{i}") for i, d in enumerate(all_days))).first()
    return [path for path, day in zip(paths, days) if day or (day is None and unknown)]


def _as_dates(schema: T.StructType, steps: Sequence[Sequence[str]]) -> T.StructType:
    fields = []
    for f in schema.fields:
        below = [rest for first, *rest in steps if first == f.name]
        if [] in below:
            f = T.StructField(f.name, T.DateType(), f.nullable)
        elif below:
            f = T.StructField(f.name, _as_dates(f.dataType, below), f.nullable)
        fields.append(f)
    return T.StructType(fields)


def distinct_names(data_type: T.DataType) -> T.DataType:
    """The type with fields that differ only in case told apart: the second ``a`` is ``a_2``."""
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(distinct_names(data_type.elementType), data_type.containsNull)
    if not isinstance(data_type, T.StructType):
        return data_type
    taken, fields = {name.lower() for name in data_type.names}, []
    seen: set[str] = set()
    for f in data_type.fields:
        name, n = f.name, 1
        while name.lower() in seen or (n > 1 and name.lower() in taken):
            n += 1
            name = f"{f.name}_{n}"
        seen.add(name.lower())
        fields.append(T.StructField(name, distinct_names(f.dataType), f.nullable))
    return T.StructType(fields)


def pruned(schema: T.StructType, paths: Sequence[str]) -> T.StructType:
    """The part of a schema that holds the given paths."""
    return _pruned(schema, [split_path(path) for path in paths])


def _pruned(schema: T.StructType, steps: Sequence[Sequence[str]]) -> T.StructType:
    fields = []
    for f in schema.fields:
        below = [rest for first, *rest in steps if first == f.name]
        if below:
            nested = isinstance(f.dataType, T.StructType) and all(below)
            fields.append(T.StructField(f.name, _pruned(f.dataType, below) if nested else f.dataType, f.nullable))
    return T.StructType(fields)


def _has_null(column: Column, data_type: T.DataType) -> Column:
    """Whether a value, or anything inside it, is NULL."""
    inner = F.lit(False)
    if isinstance(data_type, T.StructType):
        inner = reduce(lambda a, b: a | b, [_has_null(column.getField(f.name), f.dataType) for f in data_type.fields], inner)
    elif isinstance(data_type, T.ArrayType):
        inner = F.exists(column, lambda item: _has_null(item, data_type.elementType))
    elif isinstance(data_type, T.MapType):
        inner = F.exists(F.map_values(column), lambda item: _has_null(item, data_type.valueType))
    return column.isNull() | inner


def read_hits(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    max_object_bytes: int | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Typed documents of NDJSON files, one row per non-blank line.

    A line that is no JSON object, or a larger one than allowed, is a row of NULLs whose text is
    kept in ``_corrupt_record``; so is the text of an object with a value that its column's type
    can't hold, beside the values that fit. ``columns`` names the paths to parse, all by default;
    ``file_column`` one to add with the path of a row's file. Fields that differ only in case get
    names of their own (see :func:`distinct_names`). A line is parsed once; one in which a
    field is missing or null a second time, to see whether its value did not fit.
    """
    schema = schema or infer_schema(spark, *paths)
    schema = schema if columns is None else pruned(schema, columns)
    value = F.col("value")
    lines = read_lines(spark, *paths).where(F.trim(value) != "")
    fits = value if max_object_bytes is None else F.when(F.octet_length(value) <= max_object_bytes, value)
    corrupt = CORRUPT
    while corrupt in schema.names:
        corrupt += "_"
    file = [] if file_column is None else [F.col("_metadata.file_path").alias("file")]
    parsed = parse_objects(lines, schema, [*file, "value"], fits)
    told_apart = distinct_names(parsed.schema["object"].dataType)
    rows = parsed.select(*(["file"] if file else []), "value", "good", F.col("object").cast(told_apart).alias("object"))
    item = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    checked = F.from_json(fits, item, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).getField(corrupt)
    kept = told_apart.fields[: len(schema.fields)]
    fields = [F.when(F.col("good"), F.col("object").getField(f.name)).alias(f.name) for f in kept]
    some_null = reduce(lambda a, b: a | b, [_has_null(F.col("object").getField(f.name), f.dataType) for f in kept], F.lit(False))
    text = F.when(~F.col("good"), value).when(some_null, checked)
    return rows.select(*fields, text.alias(CORRUPT), *([F.col("file").alias(file_column)] if file_column else []))


def store_hits(hits: DataFrame, path: str, cluster_by: str | None = None) -> DataFrame:
    """Convert to Parquet once, so that later queries prune columns and skip row groups.

    With ``cluster_by``, a time field, rows are ordered by it: a folder for each day (in UTC) and in
    it files with ranges of their own, so that a range of time opens few of them (see
    :mod:`hitlake.sources.snapshots`). Rows are parsed once, to the scratch folder, because
    ranges are found by a sample; equal times are split by a hash of the row, so a time that very
    many rows share fills many files.
    """
    spark = hits.sparkSession
    if cluster_by is None:
        hits.write.parquet(path)
        return spark.read.parquet(path)
    day = "day"
    while day.lower() in (name.lower() for name in hits.columns):
        day = f"_{day}"
    with owned_scratch(spark):
        parsed = materialize(hits, "hits-to-cluster")
        time = column_at(cluster_by)
        spread = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        keyed = parsed.select("*", utc(time, type_at(parsed.schema, cluster_by)).cast("date").alias(day), spread.alias(f"{day} spread"))
        placed = keyed.repartitionByRange(day, time, f"{day} spread").sortWithinPartitions(day, time).drop(f"{day} spread")
        placed.write.partitionBy(day).parquet(path)
    return spark.read.parquet(path).drop(day)


def as_hits(df: DataFrame, id_field: str, sort_fields: Sequence[str] = ()) -> DataFrame:
    """Wrap documents as hits: ``_id``, ``_source`` and the ``sort`` values they page by."""
    columns = [
        column_at(id_field).cast("string").alias("_id"),
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_source"),
    ]
    if sort_fields:
        values = [column_at(f).alias(".".join(split_path(f))) for f in sort_fields]
        columns.append(F.struct(*values).alias("sort"))
    return df.select(*columns)
