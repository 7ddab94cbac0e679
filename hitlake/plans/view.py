"""The interactive view of a table: filter, search, count, sort and page it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.paths import select_fields
from ..functions.schema import default_columns
from ..operators.paging import DEFAULT_LIMIT, SORTED_ROWS, SortKey, page, page_info, page_select
from ..operators.predicates import Filter, TimeRange, where_all
from ..operators.profile import row_count


@dataclass(frozen=True)
class View:
    """What is shown of ``table``; ``unique`` names the field that settles ties.

    Columns default to those of :func:`hitlake.functions.default_columns`.
    """

    table: DataFrame
    unique: str
    filters: Sequence[Filter] = ()
    time: TimeRange | None = None
    search: str = ""
    columns: Sequence[str] | None = None
    sort: SortKey | None = None
    offset: int = 0
    limit: int = DEFAULT_LIMIT

    def filtered(self) -> DataFrame:
        return where_all(self.table, self.filters, self.time, self.search)

    def count(self) -> DataFrame:
        return row_count(self.filtered())

    def rows(self) -> DataFrame:
        """The page shown, reduced to the visible columns; one far in is found by selection (jobs run when called)."""
        keys = [] if self.sort is None else [self.sort]
        if self.offset > SORTED_ROWS:
            shown = page_select(self.filtered(), keys, self.offset, self.limit, unique=self.unique)
        else:
            shown = page(self.filtered(), keys, self.offset, self.limit, self.unique)
        columns = default_columns(self.table.schema) if self.columns is None else self.columns
        return select_fields(shown, columns)

    def info(self) -> DataFrame:
        """Position of the page among all filtered rows."""
        return page_info(self.count(), self.offset, self.limit)
