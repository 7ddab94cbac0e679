"""Dotted paths into documents: raw JSON text and typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def split_path(path: str) -> list[str]:
    """Steps of a dotted path; a step in double quotes may hold dots (``_source."a.b"``)."""
    steps, step, quoted = [], "", False
    for char in path:
        if char == '"':
            quoted = not quoted
        elif char == "." and not quoted:
            steps.append(step)
            step = ""
        else:
            step += char
    steps.append(step)
    if quoted or not all(steps):
        raise ValueError(f"malformed field path: {path!r}")
    return steps


def result_name(path: str) -> str:
    """Column name of a projected path: quotes dropped, dots to underscores."""
    return "_".join(split_path(path)).replace(".", "_")


def parse_field_spec(spec: str) -> tuple[str, str]:
    """``path:name`` split at the last colon; without one, the last step names the column."""
    path, colon, name = spec.rpartition(":")
    if colon:
        return path, name
    return spec, spec.rpartition(".")[2]


# --- typed columns ---------------------------------------------------------------------


def column_at(path: str) -> Column:
    """The typed column or nested field at ``path``."""
    return F.col(".".join("`" + step.replace("`", "``") + "`" for step in split_path(path)))


def type_at(schema: T.StructType, path: str) -> T.DataType | None:
    """Type at ``path``, or None where the schema has no such field."""
    current: T.DataType = schema
    for step in split_path(path):
        if not isinstance(current, T.StructType) or step not in current.fieldNames():
            return None
        current = current[step].dataType
    return current


def text_of(column: Column, data_type: T.DataType) -> Column:
    """A value as text: JSON for nested values, the cast for the rest; equal values have equal texts.

    Times are shown in UTC with their microseconds, so two of them never share a text, inside
    nested values too; zero has no sign.
    """
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(_unsigned_zeros(column, data_type), NESTED_JSON)
    if isinstance(data_type, T.TimestampType):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", F.unix_micros(column), epoch).cast("string")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return (column + F.lit(0.0).cast(data_type)).cast("string")
    return column.cast("string")


#: Times inside nested values: whole and independent of the session; the writer's own default cuts them to milliseconds.
NESTED_JSON = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _holds_floats(data_type: T.DataType) -> bool:
    below = {
        T.StructType: lambda t: [f.dataType for f in t.fields],
        T.ArrayType: lambda t: [t.elementType],
        T.MapType: lambda t: [t.keyType, t.valueType],
    }.get(type(data_type), lambda t: [])(data_type)
    return isinstance(data_type, (T.DoubleType, T.FloatType)) or any(map(_holds_floats, below))


def _unsigned_zeros(column: Column, data_type: T.DataType) -> Column:
    """A value whose floats, at any depth, have no negative zero."""
    if not _holds_floats(data_type):
        return column
    if isinstance(data_type, T.StructType):
        fields = [_unsigned_zeros(column.getField(f.name), f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda item: _unsigned_zeros(item, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(column, lambda _, value: _unsigned_zeros(value, data_type.valueType))
    return column + F.lit(0.0).cast(data_type)


def typed_text(df: DataFrame, path: str) -> Column:
    """Text at ``path`` of a typed DataFrame; NULL for a path the schema lacks."""
    data_type = type_at(df.schema, path)
    if data_type is None:
        return F.lit(None).cast("string")
    return text_of(column_at(path), data_type)


# --- raw JSON lines --------------------------------------------------------------------

CORRUPT = "_corrupt_record"
STRICT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": CORRUPT}


def get_paths(raw: Column, paths: Sequence[str]) -> list[Column]:
    """Text at dotted paths of a raw JSON line, from one parse of the line.

    Descends objects only: a missing step, a step into something else, and JSON null give
    NULL. Values keep JSON spelling (``true``, ``{"x":1}``); of equal keys the last counts.
    The line must be JSON, see :func:`is_json`.
    """
    trees, places = _trees(paths)
    parsed = [F.from_json(raw, _struct(tree), STRICT) for tree in trees]
    return [_field(parsed[number], path) for number, path in places]


def get_path(raw: Column, path: str) -> Column:
    """:func:`get_paths` for a single path."""
    return get_paths(raw, [path])[0]


def parse_objects(
    lines: DataFrame, schema: T.StructType, keep: Sequence[str | Column] = (), raw: Column | None = None
) -> DataFrame:
    """Raw lines (column ``value``) parsed as ``object``, and whether they are one JSON object (``good``).

    Both come from the same parse: a line is read as the first of two array items, and the
    second shows that nothing stood between. Lines that hold the mark of the second item
    themselves are checked by :func:`is_json`. The items are generated as a row, because as a
    mere column they would be parsed again wherever they are used.
    """
    raw, mark = F.col("value") if raw is None else raw, END_MARK
    while mark in schema.names:
        mark += "."
    item = T.StructType([*schema.fields, T.StructField(mark, T.StringType())])
    marked = F.concat(F.lit("["), raw, F.lit(f',{{"{mark}":1}}]'))
    parsed = lines.select(
        *keep,
        (~raw.contains(mark) | is_json(raw)).alias("exact"),
        F.explode_outer(F.array(F.from_json(marked, T.ArrayType(item), STRICT))).alias("items"),
    )
    first, second = F.col("items").getItem(0), F.col("items").getItem(1)
    whole = (F.size("items") == 2) & (second.getField(mark) == "1") & first.isNotNull()
    good = F.coalesce(whole & F.col("exact"), F.lit(False))
    return parsed.select("*", first.alias("object"), good.alias("good")).drop("items", "exact")


def object_lines(lines: DataFrame, paths: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Raw lines (column ``value``) that are one JSON object, as text columns ``0``, ``1``, … at the paths."""
    trees, places = _trees(paths)
    others = [
        F.from_json(F.col("value"), _struct(tree), STRICT).alias(f"tree {n}") for n, tree in enumerate(trees[1:], 1)
    ]
    parsed = parse_objects(lines, _struct(trees[0]), [*keep, *others])
    roots = [F.col("object"), *(F.col(f"`tree {n}`") for n in range(1, len(trees)))]
    texts = [_field(roots[number], path).alias(str(i)) for i, (number, path) in enumerate(places)]
    return parsed.where("good").select(*keep, *texts)


def _field(parsed: Column, path: str) -> Column:
    return reduce(lambda c, step: c.getField(step), path.split("."), parsed)


def _trees(paths: Sequence[str]) -> tuple[list[dict], list[tuple[int, str]]]:
    """Schemas that hold the paths, and where each path is.

    One is enough unless paths exclude each other, such as ``a.b`` and ``a``.
    """
    trees: list[dict] = []
    places = []
    for path in paths:
        for number, tree in enumerate(trees):
            if _insert(tree, path.split(".")):
                break
        else:
            number = len(trees)
            trees.append({})
            _insert(trees[-1], path.split("."))
        places.append((number, path))
    return trees, places


def _insert(tree: dict, steps: Sequence[str]) -> bool:
    """Add a path to a tree of steps; False if a leaf and an object would share a name."""
    step, below = steps[0], steps[1:]
    if any(other != step and other.lower() == step.lower() for other in tree):
        return False
    if step not in tree:
        tree[step] = {}
        return not below or _insert(tree[step], below)
    if not below or not tree[step]:
        return not below and not tree[step]
    return _insert(tree[step], below)


def _struct(tree: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(step, _struct(below) if below else T.StringType()) for step, below in tree.items()]
    )


END_MARK = "end of the line"


def is_json(raw: Column) -> Column:
    """Whether a whole line is one JSON value.

    A parser stops after the first value, so text behind it would go unseen. As an array with
    a mark behind it, a line that is one value gives two items. A line that holds the mark
    itself is wrapped both as an array and as an object: only one value alone fits both.
    """

    def wrapped(start: str, end: str, schema: str) -> Column:
        return F.from_json(F.concat(F.lit(start), raw, F.lit(end)), schema, STRICT)

    marked = F.size(wrapped("[", f',"{END_MARK}"]', "array<string>")) == 2
    item = F.size(wrapped("[", "]", "array<string>")) == 1
    member = wrapped('{"v":', "}", f"_ boolean, {CORRUPT} string").getField(CORRUPT).isNull()
    return F.coalesce(F.when(raw.contains(END_MARK), item & member).otherwise(marked), F.lit(False))


# --- projections -----------------------------------------------------------------------


def select_fields(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Keep the given paths; nested ones are named by :func:`result_name`. None given → all."""
    if not paths:
        return df
    names = [result_name(path) for path in paths]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"several paths give the same column name: {clashes}")
    return df.select(*(column_at(path).alias(name) for path, name in zip(paths, names)))


def _prune(column: Column, data_type: T.DataType, wanted: Sequence[list[str]]) -> Column:
    """``column`` reduced to the wanted sub-paths, looking through arrays of objects."""
    if any(not steps for steps in wanted):
        return column
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda item: _prune(item, data_type.elementType, wanted))
    kept = []
    for field in data_type.fields:
        below = [steps[1:] for steps in wanted if steps[0] == field.name]
        if below and _reachable(field.dataType, below):
            kept.append(_prune(column.getField(field.name), field.dataType, below).alias(field.name))
    return F.when(column.isNotNull(), F.struct(*kept))


def _reachable(data_type: T.DataType, wanted: Sequence[list[str]]) -> bool:
    """Whether any wanted sub-path exists below ``data_type``."""
    while isinstance(data_type, T.ArrayType):
        data_type = data_type.elementType
    return any(
        not steps
        or (
            isinstance(data_type, T.StructType)
            and steps[0] in data_type.fieldNames()
            and _reachable(data_type[steps[0]].dataType, [steps[1:]])
        )
        for steps in wanted
    )


def source_includes(df: DataFrame, names: Sequence[str], source: str = "_source") -> DataFrame:
    """Keep only the listed fields of the document struct; unknown names are ignored."""
    wanted = [name.split(".") for name in names]
    data_type = df.schema[source].dataType
    if not _reachable(data_type, wanted):
        empty = F.from_json(F.lit("{}"), T.StructType([]))
        return df.withColumn(source, F.when(F.col(source).isNotNull(), empty))
    return df.withColumn(source, _prune(F.col(source), data_type, wanted))
