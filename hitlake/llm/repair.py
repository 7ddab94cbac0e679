"""Repair of conversations whose turns are blank, repeated, cut off, missing or of the wrong role.

A conversation is well formed if it is empty, or a system turn at most and then user and
assistant turns by turns, ending with the assistant. Its repair is a cheapest path through a
lattice: a node is a number of rows read and the role said last; edges keep, re-role or
delete the next row, or insert an empty turn. Two searches run towards each other, one from
the start and one from the accepted ends; each settles nodes by cost and, at one cost, in
row order, so that the least audit (the edits' initials) of a settled node is final. They
meet where a node is known to both; the search ends only when no crossing of the best cost
can be left, and of all crossings of that cost the least audit is taken. Equally cheap paths
between two nodes are never one another's beginning, so least parts make a least whole.

Rows are numbered in their order over the whole table and fall into blocks of ``BLOCK`` rows.
A conversation inside a block, the usual case, is solved from start to end. One that crosses a
block's border is solved there from every state to every state, and its blocks' tables are
joined like the branches of a tree; so a conversation of any length spreads over tasks, and
only its edits (a letter a row) meet in one. Texts are never gathered: edits are joined to
rows by number, and the digest of a conversation runs over its repaired rows as they come.

Defined cases: null roles and texts are one blank; rows without a conversation are one
conversation; rows come by turn (none first), then role, then text; an empty role has no
initial and can't be kept; a conversation without rows has no edits and no turns.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitlake.operators import number_rows
from hitlake.scratch import materialize

from .common import column

BLOCK = 256
#: Rows passed on at a time.
ROWS_AT_ONCE = 10_000
#: What edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: The blanks of ASCII.
BLANKS = " \t\n\x0b\x0c\r"

#: States: nothing said, system, user, assistant said last. Of each role's initial, what may come before it and what it leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
SAID = {"s": ((START,), SYSTEM), "u": ((START, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
ENDS = (START, ASSISTANT)
#: A row's fault.
SOUND, BLANK, DUPLICATE, CUT = "0123"

Label = tuple[int, str]
Node = tuple[int, int]


def row_edits(code: str) -> list[tuple[str, int, str]]:
    """Edits that say a turn: (letter, cost, initial said). ``code`` is the role's initial and the fault."""
    initial, fault = code
    if fault in (BLANK, DUPLICATE):
        return []
    more = TRUNCATED if fault == CUT else 0
    kept = [("K", KEEP + more, initial)] if initial in SAID else []
    return kept + [("R", REROLE + more, said) for said in "ua"]


def edges(codes: list[str], node: Node, forward: bool) -> Iterator[tuple[Node, int, str]]:
    """Nodes after (or before) ``node``, with the cost and letter of the edit between."""
    read, state = node
    row, step = (read, 1) if forward else (read - 1, -1)
    inside = 0 <= row < len(codes)
    said = [("I", INSERT, initial, 0) for initial in "ua"]
    if inside:
        said += [(*edit, step) for edit in row_edits(codes[row])]
        yield (read + step, state), DELETE, "D"
    for letter, cost, initial, move in said:
        before, after = SAID[initial]
        if forward and state in before:
            yield (read + move, after), cost, letter
        elif not forward and state == after:
            for other in before:
                yield (read + move, other), cost, letter


def cheapest(codes: list[str], sources: tuple[int, ...], targets: tuple[int, ...]) -> Label | None:
    """(cost, audit) of the cheapest way from a source state before the rows to a target state behind them."""
    known: tuple[dict[Node, Label], ...] = ({(0, q): (0, "") for q in sources}, {(len(codes), q): (0, "") for q in targets})
    heaps = [[(0, 0, node) for node in known[0]], [(0, 0, node) for node in known[1]]]
    settled: tuple[set[Node], ...] = (set(), set())
    best: Label | None = None
    for node in known[0].keys() & known[1].keys():
        best = (0, "")
    while heaps[0] and heaps[1]:
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best[0]:
            break
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        _, _, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side].add(node)
        cost, audit = known[side][node]
        for other, more, letter in edges(codes, node, side == 0):
            label = (cost + more, audit + letter if side == 0 else letter + audit)
            if other in known[1 - side]:  # the searches meet
                far = known[1 - side][other]
                whole = (label[0] + far[0], label[1] + far[1] if side == 0 else far[1] + label[1])
                best = whole if best is None else min(best, whole)
            if other not in known[side] or label < known[side][other]:
                known[side][other] = label
                heapq.heappush(heaps[side], (label[0], other[0] if side == 0 else -other[0], other))
    return best


@lru_cache(maxsize=20_000)
def solve(codes: str) -> Label:
    """The repair of a whole conversation."""
    return cheapest(_rows(codes), (START,), ENDS)


def _rows(codes: str) -> list[str]:
    return [codes[at : at + 2] for at in range(0, len(codes), 2)]


Table = dict[tuple[int, int], Label]


def table(codes: str) -> Table:
    """The cheapest ways from every state before some rows to every state behind them."""
    rows = _rows(codes)
    found = {(p, q): cheapest(rows, (p,), (q,)) for p in range(4) for q in range(4)}
    return {ends: label for ends, label in found.items() if label is not None}


def joined(left: Table, right: Table) -> Table:
    out: Table = {}
    for (p, q), (cost, audit) in left.items():
        for (q2, r), (cost2, audit2) in right.items():
            if q2 == q:
                label = (cost + cost2, audit + audit2)
                out[p, r] = min(out.get((p, r), label), label)
    return out


def joined_all(tables: Iterator[Table]) -> Table:
    """Tables in a row, joined like the branches of a tree: each letter is copied few times."""
    stack: list[tuple[int, Table]] = []
    for one in tables:
        stack.append((1, one))
        while len(stack) > 1 and stack[-1][0] == stack[-2][0]:
            (size, right), (_, left) = stack.pop(), stack.pop()
            stack.append((2 * size, joined(left, right)))
    whole = stack.pop()[1]
    while stack:
        whole = joined(stack.pop()[1], whole)
    return whole


def damage(messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults drawn by a hash of the conversation and turn: rows gone, emptied, cut off, repeated, re-roled."""
    part = lambda name: F.coalesce(column(name).cast("string"), F.lit(" "))
    drawn = F.crc32(F.concat(part(conv), F.lit(":"), part(turn)).cast("binary")) % 20
    rows = messages.select(
        column(conv).alias("conv"), column(turn).alias("turn"), part(role).alias("role"), part(text).alias("text"), drawn.alias("drawn")
    )
    said = F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = rows.where("drawn <> 0").withColumn("time", F.explode(times))
    return kept.select("conv", "turn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"))


def coded(numbered: DataFrame) -> DataFrame:
    """(conv, row, code): every row's initial and first fault."""
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    lasting = F.when(shown == "", BLANK).when(shown.substr(F.length(shown), F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(CUT)
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise("-")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = numbered.select("conv", "row", said.alias("said"), initial.alias("initial"), lasting.alias("fault"))
    again = rows.groupBy(F.col("conv").alias("of"), F.col("said").alias("again")).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("times"))
    met = rows.join(again.where("times > 1"), F.col("conv").eqNullSafe(F.col("of")) & (F.col("said") == F.col("again")), "left")
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("row") > F.col("first"), DUPLICATE).otherwise(F.col("fault"))
    return met.select("conv", "row", F.concat("initial", fault).alias("code"))


def _solved(codes: str, whole: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state behind, cost, audit); a whole conversation has one."""
    if whole:
        return [(START, ASSISTANT, *solve(codes))]
    return [(p, q, *label) for (p, q), label in sorted(table(codes).items())]


WAYS = "array<struct<before:int,behind:int,cost:bigint,audit:string>>"
WAYS_ARROW = pa.list_(pa.struct([("before", pa.int32()), ("behind", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["before", "behind", "cost", "audit"]
    for batch in batches:
        codes, whole = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        ways = [[dict(zip(names, way)) for way in _solved(*args)] for args in zip(codes, whole)]
        yield pa.record_batch([*batch.columns[:4], pa.array(ways, WAYS_ARROW)], ["conv", "block", "first", "codes", "ways"])


def by_conversation(function: Callable[[Iterator[tuple]], Iterator[tuple]], names: list[str], kinds: list[pa.DataType]):
    """For mapInArrow: of each conversation, whose rows come together and in order, the rows that ``function`` makes, behind its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_kind: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                key_kind[:] = [batch.schema.field(0).type]
                yield from zip(*(cells.to_pylist() for cells in batch.columns))

        def packed(ready: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(cells, kind) for cells, kind in zip(zip(*ready), key_kind + kinds)], ["conv", *names])

        ready: list[tuple] = []
        for key, group in groupby(rows(), key=itemgetter(0)):
            for made in function(row[1:] for row in group):
                ready.append((key, *made))
                if len(ready) >= ROWS_AT_ONCE:
                    yield packed(ready)
                    ready = []
        if ready:
            yield packed(ready)

    return run


def _verdict(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """first row, codes, faults, cost and audit of a conversation from its blocks in order."""
    starts, parts, tables = [], [], []
    for _, first, codes, ways in blocks:
        starts.append(first)
        parts.append(codes)
        tables.append({(way["before"], way["behind"]): (way["cost"], way["audit"]) for way in ways})
    found, codes = joined_all(iter(tables)), "".join(parts)
    initials, faults = codes[::2], codes[1::2]
    legal = sum(map(initials.count, ("su", "ua", "au")))
    label = min(found[START, end] for end in ENDS if (START, end) in found)
    yield starts[0], codes, *map(faults.count, (BLANK, DUPLICATE, CUT)), len(initials) - 1 - legal, *label


def judge(numbered: DataFrame) -> DataFrame:
    """Per conversation of (conv, row, role, text): its rows' codes, counts of faults, cost and audit."""
    kind = numbered.schema["conv"].dataType.simpleString()
    block = F.floor(F.col("row") / BLOCK).alias("block")
    rows = coded(numbered).groupBy("conv", block).agg(F.array_sort(F.collect_list(F.struct("row", "code"))).alias("rows"))
    first, last = F.col("rows")[0]["row"], F.element_at("rows", -1)["row"]
    inside = (first > F.col("block") * BLOCK) & (last < (F.col("block") + 1) * BLOCK - 1)
    blocks = rows.select("conv", "block", first.alias("first"), F.array_join("rows.code", "").alias("codes"), inside.alias("whole"))
    solved = blocks.mapInArrow(_solve_blocks, f"conv {kind}, block bigint, first bigint, codes string, ways {WAYS}")
    ordered = solved.repartition("conv").sortWithinPartitions("conv", "block")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * len(counts), pa.string()]
    shape = f"conv {kind}, first bigint, codes string, {', '.join(f'{name} bigint' for name in counts)}, audit string"
    return ordered.mapInArrow(by_conversation(_verdict, ["first", "codes", *counts, "audit"], kinds), shape)


def _edits(verdicts: Iterator[tuple]) -> Iterator[tuple]:
    """place, row, edit, role: for each turn that stays or comes; no row for inserted, no role for kept ones."""
    for first, codes, audit in verdicts:
        read, state, place = 0, START, 0
        for letter in audit:
            row = None if letter == "I" else first + read
            initial = codes[2 * read] if letter == "K" else "a" if state == USER else "u"
            read += letter != "I"
            if letter != "D":
                yield place, row, letter, None if letter == "K" else {"u": "user", "a": "assistant"}[initial]
                state, place = SAID[initial][1], place + 1


def repaired_rows(judged: DataFrame, numbered: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): the turns of the repaired conversations, in the order of ``place``."""
    kind = numbered.schema["conv"].dataType.simpleString()
    run = by_conversation(_edits, ["place", "row", "edit", "role"], [pa.int64(), pa.int64(), pa.string(), pa.string()])
    edits = judged.select("conv", "first", "codes", "audit").mapInArrow(run, f"conv {kind}, place bigint, row bigint, edit string, role string")
    said = numbered.select("row", F.col("role").alias("own_role"), F.col("text").alias("own_text"))
    inserted = edits.where("row IS NULL").select("conv", "place", "edit", "role", F.lit("").alias("text"))
    others = edits.where("row IS NOT NULL").join(said, "row")
    return others.select("conv", "place", "edit", F.coalesce("role", "own_role").alias("role"), F.col("own_text").alias("text")).unionByName(inserted)


def _digest(turns: Iterator[tuple]) -> Iterator[tuple]:
    state, between = hashlib.sha256(), ""
    for _, role, text in turns:
        state.update(f"{between}{role}:{text}".encode())
        between = "\n"
    yield (state.hexdigest(),)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): over ``role:text`` of each turn, joined by newlines; rows pass one by one."""
    kind = repaired.schema["conv"].dataType.simpleString()
    ordered = repaired.select("conv", "place", "role", "text").repartition("conv").sortWithinPartitions("conv", "place")
    return ordered.mapInArrow(by_conversation(_digest, ["repaired_sha256"], [pa.string()]), f"conv {kind}, repaired_sha256 string")


def number(messages: DataFrame) -> DataFrame:
    """(row, conv, turn, role, text): rows numbered in order, conversation by conversation. Written to the scratch folder."""
    order = [F.col(name).asc_nulls_first() for name in ("conv", "turn", "role", "text")]
    said = lambda name: F.coalesce(F.col(name), F.lit(" ")).alias(name)
    return number_rows(messages.select("conv", "turn", said("role"), said("text")), order, name="row")


def gaps(messages: DataFrame) -> DataFrame:
    """(conv, gaps): turns missing between the first and the last."""
    span: Column = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    return messages.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"))


def repair_report(conversations: DataFrame, messages: DataFrame) -> DataFrame:
    """Per conversation of ``conversations`` (conv) what the repair of ``messages`` (conv, turn, role, text) found and did.

    conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Writes the
    numbered rows and the verdicts to the scratch folder.
    """
    numbered = number(messages)
    judged = materialize(judge(numbered), "repairs")
    done = digests(repaired_rows(judged, numbered))
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    parts = [gaps(numbered), judged.select("conv", *counts, "audit"), done]
    report = conversations.select(F.col("conv").alias("conv")).distinct()
    for part in parts:
        key = part.withColumnRenamed("conv", "of")
        report = report.join(key, F.col("conv").eqNullSafe(F.col("of")), "left").drop("of")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    zero = [F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in ("gaps", *counts)]
    return report.select("conv", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
