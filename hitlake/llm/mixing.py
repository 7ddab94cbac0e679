"""Mixing sources to target weights by Poisson replication.

A source with ``size`` units and target share ``w`` of a mixture of ``total`` units is repeated
``rate = w * total / size`` times on average. Every document inverts the Poisson distribution
of that mean at a number in [0, 1) taken from the MD5 digest of seed and id, and is exploded
into so many copies; the copies are then sorted by another digest, which no source, id or
size influences. Runs of a document therefore agree, and no state is kept.

DataFrame functions only. Rates are one row per source: counted with partial sums, joined
back by Spark (broadcast only when its statistics prove them small, else a shuffle join that
adaptive execution splits at a hot source).

Defined cases: a null source is a source of its own; a null text has size zero; a source of
size zero is repeated as if every document had one unit; rows with equal ids get the same number of
copies each; a row without an id is drawn by a digest of its text and source and by its place in the
table (Spark's partition and row in it), each such row on its own; copies are numbered from 0.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from hitlake.scratch import materialize

from .common import column, new_name

#: Hexadecimal digits of a digest that make a number in [0, 1): 52 bits, exact in a double.
DIGITS = 13


def uniform(text: Column) -> Column:
    """A number in [0, 1) from a text's MD5 digest."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("bigint") / F.lit(float(1 << 4 * DIGITS))


def poisson_table(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... until far beyond the mean, as an array.

    Starts from the mean's logarithm so that large rates don't underflow.
    """
    longest = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    log_term = lambda k: k * F.log(rate) - rate  # noqa: E731  without log k!, which the running sum below brings in
    start = F.struct(F.lit(0.0).alias("log_factorial"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf"))

    def step(done, k):
        factorial = done["log_factorial"] + F.when(k > 0, F.log(F.greatest(k, F.lit(1)).cast("double"))).otherwise(0.0)
        total = done["sum"] + F.exp(log_term(k) - factorial)
        return F.struct(factorial.alias("log_factorial"), total.alias("sum"), F.concat(done["cdf"], F.array(total)).alias("cdf"))

    table = F.aggregate(F.sequence(F.lit(0), longest), start, step, lambda done: done["cdf"])
    return F.when(rate > 0, table).otherwise(F.array(F.lit(1.0)))


def source_rates(
    docs: DataFrame,
    *,
    source: str = "source",
    text: str = "text",
    weights: Mapping[str | None, float] | None = None,
    temperature: float = 0.5,
    total: float = 1.0,
) -> DataFrame:
    """``source``, ``size`` (characters), ``share`` and ``rate``.

    Without ``weights`` a source's share follows its size to the power ``temperature``. ``total`` is the
    mixture's size as a multiple of the input's. Weights are normalised over the sources that exist. Writes the
    sizes to the scratch folder and reads their sums.
    """
    sizes = docs.select(column(source).alias("source"), F.coalesce(F.length(column(text)), F.lit(0)).alias("n"))
    sizes = sizes.groupBy("source").agg(F.sum("n").alias("chars"), F.count(F.lit(1)).alias("docs"))
    sizes = sizes.select("source", F.when(F.col("chars") > 0, F.col("chars")).otherwise(F.col("docs")).cast("double").alias("size"))
    sizes = materialize(sizes, "source-sizes")  # one row per source, read for the sums and for the rates
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("size", F.lit(float(temperature))))
    else:
        spark = docs.sparkSession
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "named string, weight double")
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
        weighted = weighted.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    sums = weighted.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    per_unit = float(total) * (sums["size"] or 0.0) / (sums["weight"] or 1.0)
    share = F.col("weight") / F.lit(sums["weight"] or 1.0)
    return weighted.select("source", "size", share.alias("share"), (F.col("weight") * F.lit(per_unit) / F.col("size")).alias("rate"))


def mix(
    docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0,
    copy: str = "copy", order: str = "shuffle_key", **rates,
) -> DataFrame:
    """Copies of ``docs`` in random order, with the copy's number and the key that orders them."""
    table = source_rates(docs, source=source, text=text, **rates).select(
        F.col("source").alias("named"), poisson_table(F.col("rate")).alias("cdf")
    )
    row, key, where = (new_name(docs, n) for n in ("row", "doc_key", "doc_source"))
    said = F.md5(F.concat_ws(":", F.coalesce(column(source).cast("string"), F.lit("")), F.coalesce(column(text), F.lit(""))).cast("binary"))
    orphan = F.concat_ws(":", F.lit("-"), said, F.monotonically_increasing_id())
    wrapped = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias(row),
        F.concat_ws(":", F.lit(str(seed)), F.when(column(doc_id).isNull(), orphan).otherwise(column(doc_id).cast("string"))).alias(key),
        column(source).alias(where),
    )
    joined = wrapped.join(table, F.col(where).eqNullSafe(F.col("named")))
    count = F.size(F.filter("cdf", lambda p: p <= uniform(F.col(key))))
    copies = joined.select(row, key, F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array())).alias(copy))
    keyed = copies.select(f"{row}.*", F.col(copy).cast("bigint").alias(copy), F.md5(F.concat_ws(":", key, copy).cast("binary")).alias(order))
    return keyed.orderBy(order, doc_id)
