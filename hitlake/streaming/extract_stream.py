"""Pattern extraction over files as they arrive."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import get_path, parse_field_spec
from ..operators.extract import DEFAULT_SOURCE, raw_matches
from ..scratch import delete_path, materialize, owned_scratch

SALTS = 16


@dataclass(frozen=True)
class Extraction:
    """Streaming match rows.

    ``rows`` has each row once. ``matches`` has every match with its time in the column ``time``:
    of it, :func:`run_extract` makes rows, late rows and undated rows in one pass.
    """

    rows: DataFrame
    undated: DataFrame | None
    matches: DataFrame
    time: str
    remember: str


def free_name(wish: str, taken: Sequence[str]) -> str:
    """``wish``, with underscores before it until nothing has that name."""
    lower = {name.lower() for name in taken}
    while wish.lower() in lower:
        wish = f"_{wish}"
    return wish


def extract_stream(
    lines: DataFrame,
    pattern: str,
    source: str = DEFAULT_SOURCE,
    fields: Sequence[str] = (),
    remember: str = "1 day",
    event_time: str | None = None,
) -> Extraction:
    """Match rows of a stream of raw JSON lines, each row once while it is remembered.

    A row is remembered for ``remember``, so state stays bounded; a batch report remembers
    the whole input. Time is when the row arrives, so no row is late. With ``event_time``
    (a path) it is the document's own: rows older than the stream's progress by more than
    ``remember`` are then late and not in ``rows``, and undated rows go to ``undated``;
    :func:`run_extract` writes all three, so that every match is in one of them.
    """
    taken = [*lines.columns, "match", *(parse_field_spec(spec)[1] for spec in fields)]
    time, salt = free_name("seen_at", taken), free_name("salt", taken)
    moment = F.current_timestamp() if event_time is None else F.try_to_timestamp(get_path(F.col("value"), event_time))
    timed = lines.withColumn(time, moment)
    matches = raw_matches(timed, pattern, source, fields, keep=(time,))
    undated = None
    if event_time is not None:
        undated = raw_matches(timed.where(F.col(time).isNull()), pattern, source, fields)
        timed = timed.where(F.col(time).isNotNull())
    # Equal rows are first dropped among those one task reads: a stream has no map-side
    # step, and a row that makes up much of the input would otherwise meet in one task.
    salted = timed.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    found = raw_matches(salted, pattern, source, fields, keep=(time, salt))
    keys = [c for c in found.columns if c not in (time, salt)]
    rows = (
        found.withWatermark(time, remember)
        .dropDuplicatesWithinWatermark([*keys, salt])
        .dropDuplicatesWithinWatermark(keys)
        .select(*(F.col(f"`{k}`") for k in keys))
    )
    return Extraction(rows, undated, matches, time, remember)


def start_extract(rows: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Process all files there are, appending to a Parquet folder; later runs go on from there."""
    return (
        rows.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_extract(extraction: Extraction, output: str, checkpoint: str) -> None:
    """Process all files there are, in as many batches as the stream makes of them; later runs go on from there.

    ``output`` is one Parquet table with a folder per batch and in it a column ``part`` that is ``row``,
    ``late`` or ``undated`` (``batch`` and ``part`` with underscores before where a field has that name).
    Late rows, repeats among them included, are as old as the watermark or older: the newest time of all
    batches before the last one, less ``remember``, as in Spark's own streams, whose watermark counts a
    batch after it is reached. Lines are read and parsed once a batch.

    Rows remembered, with the newest time that they had, and the newest times are Parquet tables of the
    batch under ``checkpoint``. A batch reads those of the batch before and writes its own and its output
    over what an attempt of it may have left, so that every match is in the output once whenever a
    run ends. Equal rows of a batch are combined before the shuffle, so a hot row meets in no task.
    """
    names = [c for c in extraction.matches.columns if c != extraction.time]
    batch_name = free_name("batch", names)
    part = free_name("part", [*names, batch_name])

    def step(arrived: DataFrame, batch: int) -> None:
        with owned_scratch(arrived.sparkSession):
            _step(extraction, arrived, batch, f"{output}/{batch_name}={batch}", part, f"{checkpoint}/state")

    (
        extraction.matches.writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _step(extraction: Extraction, arrived: DataFrame, batch: int, output: str, part: str, state: str) -> None:
    spark = arrived.sparkSession
    names = [c for c in arrived.columns if c != extraction.time]
    keys = [f"k{at}" for at in range(len(names))]
    cells = [F.col(f"`{name}`").alias(key) for name, key in zip(names, keys)]
    matches = materialize(arrived.select(*cells, F.unix_micros(extraction.time).alias("time")), "arrived")
    reached = settled = None  # the newest times before this batch and before the last one, in microseconds
    seen = matches.limit(0)
    if batch > 0:
        seen = spark.read.schema(matches.schema).parquet(f"{state}/{batch - 1}/seen")
        reached, settled = spark.read.schema("reached bigint, settled bigint").parquet(f"{state}/{batch - 1}/times").first()
    time = F.col("time")
    older = lambda newest: F.unix_micros(F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {extraction.remember}"))
    late = F.lit(False) if settled is None else F.coalesce(time <= older(settled), F.lit(False))

    def named(rows: DataFrame, which) -> DataFrame:
        return rows.select(*(F.col(key).alias(name) for key, name in zip(keys, names)), which.alias(part))

    fresh = matches.where(time.isNotNull() & ~late).groupBy(*keys).agg(F.max("time").alias("time"))
    new = named(fresh.join(seen.select(*keys), keys, "left_anti"), F.lit("row"))
    rest = named(matches.where(time.isNull() | late), F.when(time.isNull(), "undated").otherwise("late"))
    new.unionByName(rest).write.mode("overwrite").partitionBy(part).parquet(output)

    newest = matches.agg(F.max("time")).first()[0]
    remembered = seen.unionByName(fresh).groupBy(*keys).agg(F.max("time").alias("time"))
    if reached is not None:  # what the next batch takes for late needs no memory
        remembered = remembered.where(time > older(reached))
    remembered.write.mode("overwrite").parquet(f"{state}/{batch}/seen")
    following = max((t for t in (reached, newest) if t is not None), default=None)
    times = [F.lit(t).cast("bigint").alias(name) for t, name in ((following, "reached"), (reached, "settled"))]
    spark.range(1).select(*times).write.mode("overwrite").parquet(f"{state}/{batch}/times")
    if batch > 1:  # the batch before may still have to be done again
        delete_path(spark, f"{state}/{batch - 2}")


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw lines of the files in a folder, as a stream; at most so many files a batch."""
    reader = spark.readStream
    return (reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)).text(path)
