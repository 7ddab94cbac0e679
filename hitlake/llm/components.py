"""Connected components of a graph given by its edges, in rounds of joins.

Each round points every node at the smallest node of its neighbourhood (a large-star and a
small-star step), which ends after about log² rounds also on long chains. Rounds are written
to the shared scratch folder; nodes with very many neighbours are split by adaptive skew
joins, since every join has the row's own node on one side and one row per node on the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hitlake.scratch import materialize, remove_scratch


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the given edges connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[left], label[right]
        if np.array_equal(x, y):
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, label[label]):
            label = label[label]
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            child, root = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.record_batch([pa.array(child), pa.array(root)], ["a", "b"])


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node``, ``root`` for every node that has an edge to another one; root is the component's smallest node.

    ``edges`` has two columns of type long. Self-loops and repeated edges are fine. Writes
    one scratch table per round.
    """
    a, b = edges.columns
    current = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b"))
    current = materialize(current.mapInArrow(_contract, "a bigint, b bigint"), label)
    state = None
    while True:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        following = materialize(small.select("e.a", "e.b").where("a != b").distinct(), label)
        new_state = following.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        remove_scratch(current)
        current = following
        if new_state == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = new_state
