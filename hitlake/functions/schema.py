"""Questions about a schema. They read metadata only and feed the data operators."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, types as T

from .paths import type_at
from .rows import literal_rows

TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)

# Type names and the short labels shown beside a field.
SQL_NAMES = {
    T.StringType: "VARCHAR",
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.ShortType: "SMALLINT",
    T.ByteType: "TINYINT",
    T.DoubleType: "DOUBLE",
    T.FloatType: "FLOAT",
    T.BooleanType: "BOOLEAN",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    T.DateType: "DATE",
    T.BinaryType: "BLOB",
}
SHORT_LABELS = [
    ("STRUCT", "obj"),
    ("LIST", "arr"),
    ("MAP", "map"),
    ("VARCHAR", "str"),
    ("BIGINT", "i64"),
    ("INT", "int"),
    ("DOUBLE", "f64"),
    ("FLOAT", "f32"),
    ("TIMESTAMP", "time"),
    ("BOOLEAN", "bool"),
]


class Field(NamedTuple):
    path: str  # quoted, usable wherever an operator takes a path
    display_path: str
    name: str
    data_type: T.DataType
    nullable: bool


def type_name(data_type: T.DataType) -> str:
    """SQL spelling of a type: ``BIGINT``, ``VARCHAR[]``, ``STRUCT(a BIGINT)``."""
    if isinstance(data_type, T.StructType):
        inner = ", ".join(f"{_quoted(f.name)} {type_name(f.dataType)}" for f in data_type.fields)
        return f"STRUCT({inner})"
    if isinstance(data_type, T.ArrayType):
        return type_name(data_type.elementType) + "[]"
    if isinstance(data_type, T.MapType):
        return f"MAP({type_name(data_type.keyType)}, {type_name(data_type.valueType)})"
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    return SQL_NAMES.get(type(data_type), data_type.simpleString().upper())


def _quoted(name: str) -> str:
    return name if name.isidentifier() else f'"{name}"'


def base_type(data_type: T.DataType) -> str:
    """``STRUCT``, ``LIST`` or ``MAP``; for other types the type itself."""
    if isinstance(data_type, T.StructType):
        return "STRUCT"
    if isinstance(data_type, T.ArrayType):
        return "LIST"
    if isinstance(data_type, T.MapType):
        return "MAP"
    return type_name(data_type)


def short_type(data_type: T.DataType) -> str:
    """Short label of a type, else the first four letters of its name."""
    name = base_type(data_type)
    for part, label in SHORT_LABELS:
        if part in name:
            return label
    return name[:4].lower()


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per top-level column: name, type, nullable."""
    rows = [(f.name, type_name(f.dataType), f.nullable) for f in df.schema.fields]
    return literal_rows(df.sparkSession, rows, "name string, type string, nullable boolean")


def walk_fields(schema: T.StructType, include_structs: bool = False) -> list[Field]:
    """Fields in depth-first order: leaves, and on request the structs before their children.

    An array of structs is a leaf, since its members are not columns.
    """
    found: list[Field] = []

    def visit(struct: T.StructType, parents: tuple[str, ...]) -> None:
        for f in struct.fields:
            steps = (*parents, f.name)
            nested = isinstance(f.dataType, T.StructType) and len(f.dataType.fields) > 0
            if include_structs or not nested:
                found.append(
                    Field(
                        ".".join(f'"{step}"' for step in steps),
                        ".".join(steps),
                        f.name,
                        f.dataType,
                        f.nullable if not parents else True,
                    )
                )
            if nested:
                visit(f.dataType, steps)

    visit(schema, ())
    return found


def leaf_fields(df: DataFrame, include_structs: bool = False) -> DataFrame:
    """:func:`walk_fields` as rows: path, display_path, name, type, short_type, nullable."""
    rows = [
        (f.path, f.display_path, f.name, type_name(f.data_type), short_type(f.data_type), f.nullable)
        for f in walk_fields(df.schema, include_structs)
    ]
    return literal_rows(
        df.sparkSession,
        rows,
        "path string, display_path string, name string, type string, short_type string, nullable boolean",
    )


def detect_time_field(schema: T.StructType) -> str:
    """The time field to filter by when the user names none."""
    times = [f.name for f in schema.fields if isinstance(f.dataType, TIMESTAMPS)]
    named = [name for name in times if "timestamp" in name.lower()]
    if named or times:
        return f'"{(named or times)[0]}"'
    if type_at(schema, '_source."@timestamp"') is not None:
        return '_source."@timestamp"'
    return "@timestamp"


def time_field_options(schema: T.StructType) -> list[str]:
    """Paths a time range can be asked for, in schema order."""
    options = []
    for f in schema.fields:
        if isinstance(f.dataType, TIMESTAMPS):
            options.append(f'"{f.name}"')
        elif f.name == "_source" and type_at(schema, '_source."@timestamp"') is not None:
            options.append('_source."@timestamp"')
    return options


def default_columns(schema: T.StructType) -> list[str]:
    """Columns shown first: time and message of a hit, else the first six non-struct columns."""
    by_name = {f.display_path: f.path for f in walk_fields(schema)}
    preferred = [by_name[p] for p in ("_source.@timestamp", "_source.message") if p in by_name]
    if preferred:
        return preferred
    flat = [f'"{f.name}"' for f in schema.fields if not isinstance(f.dataType, T.StructType)]
    return flat[:6]
