from .extract import dedupe, extract, extract_matches, report_order
from .numbering import number_ordered, number_parquet, number_rows
from .paging import (
    SortKey,
    export_order,
    flip_sort,
    keyset_after,
    keyset_page,
    number_pages,
    page,
    page_info,
    page_offset,
    page_select,
    row_by_id,
    row_detail,
    size,
    sort_by,
)
from .predicates import (
    Filter,
    TimeRange,
    between_closed,
    between_half_open,
    bool_,
    filter_column,
    last,
    match_all,
    query_column,
    range_,
    search_all,
    term,
    where_all,
)
from .profile import (
    date_range,
    date_ranges,
    field_counts,
    filtered_count,
    numeric_stats,
    profile,
    row_count,
    top_values,
    total_hits,
    value_counts,
    value_histogram,
)
from .sketches import merge_sketches, sketch_fields

__all__ = [
    "Filter",
    "SortKey",
    "TimeRange",
    "between_closed",
    "between_half_open",
    "bool_",
    "date_range",
    "date_ranges",
    "dedupe",
    "export_order",
    "extract",
    "extract_matches",
    "field_counts",
    "filter_column",
    "filtered_count",
    "flip_sort",
    "keyset_after",
    "keyset_page",
    "last",
    "match_all",
    "merge_sketches",
    "number_pages",
    "number_parquet",
    "number_ordered",
    "number_rows",
    "numeric_stats",
    "page",
    "page_info",
    "page_offset",
    "page_select",
    "profile",
    "query_column",
    "range_",
    "report_order",
    "row_by_id",
    "row_count",
    "row_detail",
    "search_all",
    "size",
    "sketch_fields",
    "sort_by",
    "term",
    "top_values",
    "total_hits",
    "value_counts",
    "value_histogram",
    "where_all",
]
