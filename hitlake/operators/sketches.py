"""Profiles from sketches: kept per file or day, merged for any set of them without another scan.

Counts of rows and NULLs are exact. Distinct values come from HyperLogLog sketches, top values
from frequent-item sketches; exact profiles (:func:`hitlake.operators.profile`) stay the rule.
A sketch that has more values than it tracks, none of them frequent, can't name the top ones;
given the rows, :func:`merge_sketches` counts the values of such fields, and of no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.paths import column_at, text_of
from ..functions.schema import short_type, walk_fields
from .profile import TOP_VALUES, profile

#: Distinct values are right within three standard errors of 1.04 / sqrt(2 ** LOG_SIZE): 2.5 %.
LOG_SIZE = 14
ERROR = 0.025
#: Values that a sketch of top values tracks; fields with no more have exact counts.
TRACKED = 10_000
#: Of the rows of the most frequent values, those found have this share at least, or the sketch is not relied on.
RECALL = 0.9
#: A sketch of ``TRACKED`` values has 2 ** 14 places; its counts are too high by at most this share of the field's rows.
TOO_HIGH = 3.5 / (1 << 14)


def sketch_fields(df: DataFrame, by: Sequence[Column] = (), fields: Sequence[str] | None = None) -> DataFrame:
    """One row per group of ``by`` and leaf field: field, type, rows, nulls, ``uniques`` and ``tops`` (sketches).

    A sketch has a bounded size, so what is shuffled is a row of bounded size per task, group and
    field. Store the result: :func:`merge_sketches` makes a profile of any of its rows.
    """
    leaves = [f for f in walk_fields(df.schema) if fields is None or f.display_path in fields]
    # A leaf's value stands in a struct with its names, so that groups may be called anything.
    cells = [
        F.struct(
            F.lit(f.display_path).alias("field"),
            F.lit(short_type(f.data_type)).alias("type"),
            text_of(column_at(f.path), f.data_type).alias("value"),
        )
        for f in leaves
    ]
    values = df.select(*by, F.explode(F.array(*cells)).alias("cell")).select("*", "cell.*").drop("cell")
    groups = [c for c in values.columns if c not in ("field", "type", "value")]
    return values.groupBy(*(F.col(f"`{g}`") for g in groups), "field", "type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.hll_sketch_agg("value", LOG_SIZE).alias("uniques"),
        F.expr(f"approx_top_k_accumulate(value, {TRACKED}) FILTER (WHERE value IS NOT NULL)").alias("tops"),
    )


def merge_sketches(sketches: DataFrame, k: int = TOP_VALUES, rows: DataFrame | None = None) -> DataFrame:
    """One row per field: type, rows, null_count, unique_count (approximate) and ``top``, up to ``k`` (value, count).

    ``reliable`` says whether ``top`` is whole and its values have ``RECALL`` of the rows of the most frequent ones.
    It is false, and ``top`` may be short or empty, where a field has more values than a sketch tracks and fewer than
    ``k`` of them stand out. With ``rows``, those that were sketched, such fields are counted exactly: one job finds them,
    and their columns alone are read again.
    """
    merged = sketches.groupBy("field", "type").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("uniques")).alias("unique_count"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(tops, {TRACKED}), {k})").alias("top"),
    )
    named = F.transform("top", lambda t: F.struct(t["item"].alias("value"), t["count"].cast("bigint").alias("count")))
    held = F.aggregate("top", F.lit(0).cast("bigint"), lambda sum, t: sum + t["count"])
    stand_out = (F.size("top") == k) & (held * (1 - RECALL) >= k * TOO_HIGH * (F.col("rows") - F.col("null_count")))
    merged = merged.withColumn("top", named).withColumn("reliable", (F.col("unique_count") <= TRACKED) | stand_out)
    if rows is None:
        return merged
    fields = [row["field"] for row in merged.where(~F.col("reliable")).select("field").collect()]
    if not fields:
        return merged
    ranked = profile(rows, fields, k).where(F.col("rank").isNotNull())
    ordered = F.sort_array(F.collect_list(F.struct("rank", "value", "count")))
    counted = ranked.groupBy("field").agg(F.transform(ordered, lambda t: F.struct(t["value"], t["count"])).alias("counted"))
    return merged.join(counted, "field", "left").select(
        *(c for c in merged.columns if c not in ("top", "reliable")),
        F.coalesce("counted", "top").alias("top"),
        (F.col("reliable") | F.col("counted").isNotNull()).alias("reliable"),
    )
