"""Searches and full exports described by a query body."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from ..functions.paths import source_includes
from ..operators.paging import DEFAULT_PAGE_SIZE, SortKey, export_order, number_pages, order_columns
from ..operators.paging import page as top_page
from ..operators.predicates import TimeRange, between_half_open, query_column
from ..operators.profile import total_hits
from ..sources.hits import as_hits
from ..sources.sinks import json_text, write_json_array, write_jsonl

BODY_KEYS = {"query", "sort", "size", "_source", "track_total_hits"}
SHARD_ORDER = "_shard_doc"  # how a body names the storage order, here the unique field


@dataclass(frozen=True)
class SearchResult:
    """Hits and their count, both lazy."""

    hits: DataFrame
    total: DataFrame


def _check(body: Mapping[str, Any]) -> None:
    unknown = set(body) - BODY_KEYS
    if unknown:
        raise ValueError(f"unsupported query body keys: {sorted(unknown)}")


def _matching(df: DataFrame, body: Mapping[str, Any]) -> DataFrame:
    return df.where(query_column(df.schema, body["query"])) if "query" in body else df


def sort_keys(body: Mapping[str, Any], unique: str) -> list[SortKey] | None:
    """The ``sort`` of a body as keys; None if it has none."""
    if "sort" not in body:
        return None
    keys = []
    for clause in body["sort"]:
        if isinstance(clause, str):
            clause = {clause: "asc"}
        [(field, order)] = clause.items()
        order = order.get("order", "asc") if isinstance(order, Mapping) else order
        if order not in ("asc", "desc"):
            raise ValueError(f"unsupported sort order: {order!r}")
        keys.append(SortKey(unique if field == SHARD_ORDER else field, order == "desc"))
    return keys


def _hits(df: DataFrame, body: Mapping[str, Any], keys: list[SortKey], unique: str) -> DataFrame:
    hits = as_hits(df, unique, [key.field for key in keys])
    names = body.get("_source", True)
    if names is True:
        return hits
    if names is False:
        return hits.drop("_source")
    return source_includes(hits, [names] if isinstance(names, str) else names)


def search(df: DataFrame, body: Mapping[str, Any], unique: str) -> SearchResult:
    """The first ``size`` hits of a query in order, all of them without a size, and how many there are in all.

    ``unique`` names the field that tells documents apart and settles ties.
    """
    _check(body)
    matching = _matching(df, body)
    if "sort" in body:
        keys = export_order(unique, sort_keys(body, unique))
    else:
        keys = [SortKey(unique)]
    if "size" in body:
        limited = top_page(matching, keys, 0, body["size"], unique)
    else:
        limited = matching.orderBy(*order_columns(keys))
    tracked = body.get("track_total_hits", True)
    cap = None if isinstance(tracked, bool) else tracked
    total = total_hits(matching, cap, track=tracked is not False)
    return SearchResult(_hits(limited, body, keys, unique), total)


@dataclass(frozen=True)
class Export:
    """All hits of a query over one snapshot: the file list its DataFrame was made with."""

    matching: DataFrame
    body: Mapping[str, Any]
    keys: list[SortKey]
    unique: str
    page_size: int

    def hits(self) -> DataFrame:
        """Every hit, in export order."""
        ordered = self.matching.orderBy(*order_columns(self.keys))
        return _hits(ordered, self.body, self.keys, self.unique)

    def lines(self) -> DataFrame:
        """The hits as JSON lines, in export order."""
        hits = self.hits()
        return hits.select(json_text(hits).alias("value"))

    def pages(self) -> DataFrame:
        """Every document with its number and page."""
        return number_pages(self.matching, self.keys, self.page_size)

    def write(self, path: str, format: str = "jsonl") -> None:
        """Write all hits, sorted, as JSON lines or as one JSON array in part files."""
        if format == "jsonl":
            write_jsonl(self.hits(), path)
        elif format == "json":
            write_json_array(self.hits(), path)
        else:
            raise ValueError(f"format must be json or jsonl, not {format!r}")


def export(
    df: DataFrame,
    body: Mapping[str, Any],
    unique: str,
    from_date: str | None = None,
    to_date: str | None = None,
    time_field: str = "@timestamp",
    page_size: int = DEFAULT_PAGE_SIZE,
) -> Export:
    """A full export: the query, narrowed to ``from_date`` ≤ time < ``to_date``, in a total order.

    A ``size`` in the body does not cap an export.
    """
    _check(body)
    matching = _matching(df, body)
    if from_date is not None or to_date is not None:
        time = TimeRange(time_field, from_date, to_date)
        matching = matching.where(between_half_open(matching.schema, time))
    asked = sort_keys(body, unique)
    keys = export_order(unique, [SortKey(time_field)] if asked is None else asked)
    return Export(matching, body, keys, unique, page_size)
