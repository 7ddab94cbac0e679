from .paths import (
    column_at,
    get_path,
    get_paths,
    is_json,
    object_lines,
    parse_field_spec,
    parse_objects,
    result_name,
    select_fields,
    source_includes,
    split_path,
    type_at,
    typed_text,
)
from .patterns import finder
from .schema import (
    base_type,
    default_columns,
    describe_schema,
    detect_time_field,
    leaf_fields,
    short_type,
    time_field_options,
    type_name,
    walk_fields,
)
from .text import cell_text, fmt_bytes, fmt_count, fmt_epoch_ms, json_safe, span_text

__all__ = [
    "base_type",
    "cell_text",
    "column_at",
    "default_columns",
    "describe_schema",
    "detect_time_field",
    "finder",
    "fmt_bytes",
    "fmt_count",
    "fmt_epoch_ms",
    "get_path",
    "get_paths",
    "is_json",
    "json_safe",
    "leaf_fields",
    "object_lines",
    "parse_field_spec",
    "parse_objects",
    "result_name",
    "select_fields",
    "short_type",
    "source_includes",
    "span_text",
    "split_path",
    "time_field_options",
    "type_at",
    "type_name",
    "typed_text",
    "walk_fields",
]
