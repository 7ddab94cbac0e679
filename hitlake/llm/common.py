"""What several operators of this package need."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf


#: Texts that are Python objects at one time in a task.
TEXTS_AT_ONCE = 500


def give_back() -> None:
    """Return freed memory to the system: Python workers live on beside the JVM, from stage to stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` over a task's batches, giving memory back at the end."""

    @wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def column(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def new_name(df: DataFrame, wish: str) -> str:
    """``wish``, with as many leading underscores as it takes to clash with no column of ``df``."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def per_text(function: Callable[[Iterator[list]], Iterator[list]], returns: str, arrow_type: pa.DataType):
    """An Arrow UDF over one string column; ``function`` gets lists of texts and gives as long a list for each.

    Texts arrive as UTF-8 bytes, null as None. Marked as not deterministic so that the
    optimizer never evaluates it twice for one row.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        left: list[int] = []  # slices of the batch at hand that are still to come

        def slices() -> Iterator[list]:
            for batch in batches:
                starts = range(0, max(1, len(batch)), TEXTS_AT_ONCE)
                left.append(len(starts))
                for start in starts:
                    yield batch.slice(start, TEXTS_AT_ONCE).cast(pa.binary()).to_pylist()

        parts: list[pa.Array] = []
        for values in function(slices()):
            parts.append(pa.array(values, type=arrow_type))
            if len(parts) == left[0]:
                left.clear()
                yield pa.concat_arrays(parts)
                parts = []

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(tidy(run), returnType=returns).asNondeterministic()


def held_out(doc_id: Column, parts: int, part: int = 2) -> Column:
    """Whether the CRC-32 of the id as text leaves ``part`` when divided by ``parts``; false for no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def sample_by_hash(rows: DataFrame, most: Callable[[object], int]) -> DataFrame:
    """(id, key, rank): of every ``key`` the ``most(key)`` rows whose ids hash lowest.

    ``rows`` has id and key, with few distinct keys, which are counted first (one job). Only
    hashes below a bound that some more than the wanted rows pass are ranked, so a key of any
    size sends a bounded number of rows to the task that ranks it. A key may lack a few of the
    wanted rows where the hashes are unlucky.
    """
    counts = {r["key"]: r["count"] for r in rows.groupBy("key").count().collect()}
    if not counts:
        return rows.limit(0).withColumn("rank", F.lit(0))
    wanted = {key: most(key) for key in counts}
    bounds = {key: min(1.0, (1.5 * wanted[key] + 50) / n) for key, n in counts.items()}
    per_key = lambda table: F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col("key")]
    drawn = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))
    low = rows.withColumn("drawn", drawn).where(F.col("drawn") <= per_key(bounds))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("drawn", "id"))
    ranked = low.withColumn("rank", rank).where(F.col("rank") <= max(wanted.values()))
    return ranked.where(F.col("rank") <= per_key(wanted)).drop("drawn")
