from .datasets import (
    Catalog,
    Dataset,
    Member,
    aliases,
    dataset_schema,
    describe_alias,
    describe_dataset,
    inventory,
    like,
    read_alias,
    read_dataset,
)
from .documents import read_documents, store_documents, variant_fields, variant_schema, variant_text
from .hits import as_hits, infer_schema, read_hits, store_hits
from .lines import bad_lines, read_lines
from .snapshots import Snapshot, footer_bounds, open_snapshot, take_snapshot
from .sinks import as_json_array, json_text, write_csv, write_json_array, write_jsonl, write_report
from .substrings import files_with, index_substrings, search_indexed

__all__ = [
    "Catalog",
    "Dataset",
    "Member",
    "Snapshot",
    "aliases",
    "as_hits",
    "as_json_array",
    "bad_lines",
    "dataset_schema",
    "describe_alias",
    "describe_dataset",
    "files_with",
    "footer_bounds",
    "index_substrings",
    "infer_schema",
    "inventory",
    "json_text",
    "like",
    "open_snapshot",
    "read_alias",
    "read_dataset",
    "read_documents",
    "read_hits",
    "read_lines",
    "search_indexed",
    "store_documents",
    "store_hits",
    "take_snapshot",
    "variant_fields",
    "variant_schema",
    "variant_text",
    "write_csv",
    "write_json_array",
    "write_jsonl",
    "write_report",
]
