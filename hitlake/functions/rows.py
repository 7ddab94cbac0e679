"""Small tables from driver-side facts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def literal_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: str) -> DataFrame:
    """A few rows as literals of the plan, without a round trip through Python workers."""
    fields = T.StructType.fromDDL(schema).fields
    one = spark.range(0, 1, 1, 1)
    if not rows:
        return one.limit(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields))
    structs = [
        F.struct(*(F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, fields))) for row in rows
    ]
    return one.select(F.inline(F.array(*structs)))
