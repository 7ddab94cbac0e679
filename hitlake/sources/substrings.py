"""A substring index over a snapshot: per file which runs of three bytes its texts hold.

A file's runs, of all columns as :func:`hitlake.operators.search_all` reads them, are marks in a bitmap of
``BITS`` bits (a Bloom filter with one place a run). A text is looked for only in the files that
have marks for all runs of its literal parts; they are searched as ever, so the result is that
of a search through all files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.paths import column_at, text_of
from ..operators.predicates import search_all
from .snapshots import Snapshot

BITS = 1 << 18
#: Bits in a row of the index, as Spark's bitmap functions have them.
ROW_BITS = 1 << 15
INDEX = "substrings"


def run_places(text: bytes) -> np.ndarray:
    """The marks of a text: a place below ``BITS`` for each run of three bytes in it."""
    codes = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    runs = codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]
    return np.unique((runs * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS.bit_length() + 1)).astype(np.int64)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, place): the marks of each file, once per batch."""
    for batch in batches:
        found: dict[str, list[np.ndarray]] = {}
        for file, texts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.setdefault(file, []).extend(run_places(text.encode()) for text in texts if text)
        for file, places in found.items():
            every = np.unique(np.concatenate(places)) if places else np.zeros(0, np.int64)
            yield pa.record_batch([pa.array([file] * len(every), pa.string()), pa.array(every + 1)], ["file", "place"])


def index_substrings(snapshot: Snapshot) -> None:
    """Write the index of a snapshot beside its manifest: one pass over all columns.

    Marks are combined in tasks, and again before the shuffle: a file sends ``BITS / ROW_BITS``
    bitmaps of four kilobytes at most.
    """
    rows = snapshot.rows()
    texts = F.array(*[F.lower(text_of(column_at(f'"{f.name}"'), f.dataType)) for f in rows.schema.fields])
    marks = rows.select(F.col("_metadata.file_path").alias("file"), texts.alias("texts")).mapInArrow(_marks, "file string, place bigint")
    part = F.bitmap_bucket_number("place").alias("part")
    maps = marks.groupBy("file", part).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    maps.write.mode("error").parquet(f"{snapshot.place}/{INDEX}")


def files_with(snapshot: Snapshot, text: str) -> list[str]:
    """The files of an indexed snapshot that can hold ``text``; all of them if it has no literal part of three bytes."""
    lowered = snapshot.spark.range(1).select(F.lower(F.lit(text))).first()[0]  # as the search lowers it
    parts = [run_places(literal.encode()) for literal in re.split("[%_]", lowered)]
    wanted = np.unique(np.concatenate(parts))
    if not len(wanted):
        return snapshot.files
    needed = pa.table({"part": wanted // ROW_BITS + 1, "byte": wanted % ROW_BITS // 8 + 1, "mask": 1 << wanted % 8})
    index = snapshot.spark.read.parquet(f"{snapshot.place}/{INDEX}")
    met = index.join(F.broadcast(snapshot.spark.createDataFrame(needed)), "part").where(_byte("bits", "byte").bitwiseAND(F.col("mask")) != 0)
    holding = {row.file for row in met.groupBy("file").count().where(F.col("count") == len(wanted)).collect()}
    return [file for file in snapshot.files if file in holding]


def _byte(bits: str, at: str) -> Column:
    return F.conv(F.hex(F.substring(F.col(bits), F.col(at).cast("int"), F.lit(1))), 16, 10).cast("bigint")


def search_indexed(snapshot: Snapshot, text: str) -> DataFrame:
    """Rows of an indexed snapshot in which a column contains ``text``, from the files that can hold it."""
    return snapshot.read(files_with(snapshot, text)).where(search_all(snapshot.schema, text))
