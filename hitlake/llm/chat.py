"""Conversations from reply trees.

Messages point to the message they answer. Rounds of self-joins double the distance that each
message's pointer spans until all point beyond their root; the same tables then, longest jump
first, list every message of the chosen root-to-leaf paths. A path's score is the sum of its
messages' scores; per tree the ``keep`` best paths (ties: the smaller leaf) become conversations,
formatted by a template. A conversation is written in parts of at most ``TURNS_PER_PART`` turns,
so that one of any length is formatted, and read back, by many tasks.

Texts between a template's control strings are escaped: a backslash goes behind the first
character of anything that reads like a control string (more for one that already has some),
and comes off again when the output is read.

Rounds are written to the scratch folder. Joins are on message ids, which are unique, so that
trees of any size, depth or breadth spread over tasks (a message with very many answers is a
skewed key with one row on the other side, which adaptive execution splits).

A round writes only the paths that were still open, or the messages that it adds; what earlier
rounds finished is read where it lies.

Defined cases: null texts and roles are empty; a message whose parent does not exist is a root;
messages on a reply cycle, and below one, are in no tree and in no conversation; of messages
with one id (over all trees) the first counts, by tree, parent, score, role and text, nulls
first (:func:`first_of_each`); messages without an id count as none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType

from hitlake.operators import number_rows
from hitlake.scratch import materialize

from .common import column, new_name

TURNS_PER_PART = 64


@dataclass(frozen=True)
class Template:
    """``open`` role ``body`` text ``close`` for each turn. ``controls`` are the strings that texts may not contain."""

    open: str = "<|turn|>"
    body: str = "<|text|>"
    close: str = "<|end|>"
    learned_role: str = "assistant"
    # Control strings of common chat formats, escaped too.
    others: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.body, self.close, *self.others)

    def pattern(self, escapes: str) -> str:
        """Control strings' first characters, then ``escapes``, before the rest of a control string."""
        firsts = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        rests = "|".join(re.escape(c[1:]) for c in self.controls)
        return rf"([{firsts}]){escapes}(?={rests})"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(F.coalesce(text, F.lit("")), self.pattern(r"(\\*)"), r"$1$2\\")

    def unescape(self, text: str) -> str:
        return re.sub(self.pattern(r"\\(\\*)"), r"\1\2", text)


def first_of_each(messages: DataFrame, node: str, order: Sequence[str]) -> DataFrame:
    """One row of each message id, the first in the order of the given columns, then of all others that have an order."""
    rest = [f.name for f in messages.schema.fields if f.name not in order and isinstance(f.dataType, AtomicType)]
    ranked = Window.partitionBy(column(node)).orderBy(*[column(c).asc_nulls_first() for c in [*order, *rest]])
    rank = new_name(messages, "rank")
    # Tasks drop all but their own first row of an id before the shuffle, so a hot id is no hot task.
    return messages.where(column(node).isNotNull()).withColumn(rank, F.row_number().over(ranked)).where(F.col(rank) == 1).drop(rank)


def link_turns(messages: DataFrame, number: str, tree: str) -> DataFrame:
    """``parent`` for a linear conversation: the message numbered before, where it is of the same tree."""
    first = messages.groupBy(column(tree).alias("of_tree")).agg(F.min(number).alias("first"))
    linked = messages.join(first, column(tree).eqNullSafe(F.col("of_tree")))
    parent = F.when(F.col(number) > F.col("first"), F.col(number) - 1)
    return linked.withColumn("parent", parent).drop("of_tree", "first")


def jump_tables(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointers over 1, 2, 4, ... answers as (node, ancestor) tables, and the finished paths.

    ``nodes``: node, parent, score. A finished path is (node, depth, path_score). Ends when all
    paths have reached a root, or when only messages on or below cycles are left.
    """
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    start = nodes.join(known, "parent", "left")
    start = start.select("node", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("bigint").alias("depth"), F.col("score").alias("path_score"))
    latest = materialize(start, "reply-pointers")
    jumps, finished, before = [], [], None
    while True:
        finished.append(latest.where("up IS NULL"))
        open_paths = latest.where("up IS NOT NULL")
        left = open_paths.count()
        if left == 0 or left == before:
            return jumps, reduce(DataFrame.union, finished).drop("up")
        before = left
        jumps.append(open_paths.select("node", F.col("up").alias("ancestor")))
        everyone = reduce(DataFrame.union, [open_paths, *finished])
        above = everyone.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("path_score").alias("score2"))
        longer = open_paths.join(above, "up").select(
            "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"), (F.col("path_score") + F.col("score2")).alias("path_score")
        )
        latest = materialize(longer, "reply-pointers")


def ranked_leaves(leaves: DataFrame, keep: int | None) -> DataFrame:
    """``leaves`` (tree, node, path_score) with their ``rank`` in the tree, the ``keep`` best of each."""
    if keep is not None:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("path_score"), "node"))
        return leaves.withColumn("rank", rank).where(F.col("rank") <= keep)
    # All of them: numbered over all trees, so that no tree has to be ranked in one task.
    numbered = number_rows(leaves, [F.col("tree").asc_nulls_first(), F.desc("path_score"), F.col("node")], "place")
    first = numbered.groupBy(F.col("tree").alias("of")).agg(F.min("place").alias("first"))
    placed = numbered.join(first, F.col("tree").eqNullSafe(F.col("of")))
    return placed.withColumn("rank", (F.col("place") - F.col("first") + 1).cast("int")).drop("place", "of", "first")


def best_paths(
    messages: DataFrame, *, tree: str, node: str, parent: str, score: str | None = None, keep: int | None = 1, unique: bool = False
) -> DataFrame:
    """(tree, rank, leaf, path_score, node, turn) for every message of the ``keep`` best paths of each tree (None: all).

    ``unique`` tells that no message id stands twice.
    """
    messages = messages if unique else first_of_each(messages, node, [c for c in (tree, parent, score) if c])
    value = column(score).cast("double") if score else F.lit(0.0)
    nodes = messages.select(column(tree).alias("tree"), column(node).alias("node"), column(parent).alias("parent"), F.coalesce(value, F.lit(0.0)).alias("score"))
    jumps, paths = jump_tables(nodes.drop("tree"))
    answered = nodes.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    leaves = nodes.select("tree", "node").join(answered, "node", "left_anti").join(paths, "node")
    chosen = ranked_leaves(leaves, keep)
    listed = chosen.select("tree", "rank", F.col("node").alias("leaf"), "path_score", "depth", "node", F.lit(0).cast("bigint").alias("up"))
    parts = [materialize(listed, "reply-paths")]
    for power in reversed(range(len(jumps))):
        step = jumps[power].withColumnRenamed("node", "below")
        listed = reduce(DataFrame.union, parts)
        above = listed.join(step, listed["node"] == step["below"]).select("tree", "rank", "leaf", "path_score", "depth", F.col("ancestor").alias("node"), (F.col("up") + (1 << power)).alias("up"))
        parts.append(materialize(above, "reply-paths"))
    return reduce(DataFrame.union, parts).select("tree", "rank", "leaf", "path_score", "node", (F.col("depth") - F.col("up") - 1).alias("turn"))


def format_paths(
    paths: DataFrame, messages: DataFrame, *, node: str, role: str, text: str, template: Template = Template(), unique: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Parts of conversations: tree, rank, part, turns, ``formatted`` and ``loss_spans``.

    Spans (start, length in characters) cover the text of learned turns in ``formatted``. Unless message
    ids are ``unique`` the first row of each counts; ``order`` is that of :func:`best_paths`: tree, parent, score.
    """
    messages = messages if unique else first_of_each(messages, node, order)
    said = messages.select(column(node).alias("node"), column(role).alias("role"), column(text).alias("text"))
    turn = paths.join(said, "node")
    head = F.concat(F.lit(template.open), template.escape(F.col("role")), F.lit(template.body))
    body = template.escape(F.col("text"))
    learned = F.coalesce(F.col("role") == template.learned_role, F.lit(False))
    piece = F.struct("turn", head.alias("head"), body.alias("body"), learned.alias("learned"))
    part = F.floor(F.col("turn") / TURNS_PER_PART).alias("part")
    parts = turn.groupBy("tree", "rank", part).agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(template.close))), "")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def walk(done, p):
        begins, size = done["at"] + F.length(p["head"]), F.length(p["body"]).cast("bigint")
        span = F.array(F.struct(begins.alias("start"), size.alias("length")))
        spans = F.when(p["learned"], F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((begins + size + len(template.close)).alias("at"), spans.alias("spans"))

    spans = F.aggregate("pieces", start, walk, lambda done: done["spans"])
    return parts.select("tree", "rank", "part", F.size("pieces").alias("turns"), formatted.alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: str, template: Template) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    turns = []
    for turn in formatted.split(template.open)[1:]:
        role, _, rest = turn.partition(template.body)
        turns.append((template.unescape(role), template.unescape(rest[: rest.rindex(template.close)])))
    return turns


def read_back(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation (tree, rank) what its formatted text says: turns, digests and lengths.

    Parts pass in order through a running digest, so no conversation is ever held as a whole.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        names = ["tree", "rank", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def finish(rows):
            cells = [[*key, n, turns.hexdigest(), chars, loss.hexdigest(), size] for key, (n, turns, chars, loss, size) in rows]
            return pa.record_batch([pa.array([c[i] for c in cells], kind) for i, kind in enumerate(kinds)], names)

        for batch in batches:
            ready = []
            for tree, rank, formatted, spans in zip(*[batch.column(i) for i in (0, 1, 3, 4)]):
                key, formatted = (tree.as_py(), rank.as_py()), formatted.as_py()
                if key != current:
                    if current is not None:
                        ready.append((current, state))
                    current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(formatted, template):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in spans.as_py():
                    learned = template.unescape(formatted[span["start"] : span["start"] + span["length"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(formatted)
            if ready:
                yield finish(ready)
        if current is not None:
            yield finish([(current, state)])

    rows = parts.select(F.col("tree").cast("bigint"), F.col("rank").cast("int"), "part", "formatted", "loss_spans")
    ordered = rows.repartition("tree", "rank").sortWithinPartitions("tree", "rank", "part")
    return ordered.mapInArrow(
        digest,
        "tree bigint, rank int, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
