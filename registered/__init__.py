"""The queries of ``__spark_entry__`` and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import datasets, extraction, filters, formats, ingest, paging, profiles, snapshots

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]


def all_queries() -> dict[str, Query]:
    merged: dict[str, Query] = {}
    for module in (extraction, filters, paging, profiles, ingest, datasets, formats, snapshots):
        merged.update(module.QUERIES)
    return merged
