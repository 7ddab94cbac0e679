"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit where over half of its word-shingle hashes have it. Two
fingerprints within ``distance`` (3) bits agree up to one bit in at least one 32-bit half.
Every distinct fingerprint therefore stands in one table per half under its own value, and
looks up its Hamming ball of radius 1 there (the value and those with one more bit set: of
two values one bit apart only one has to look). Bucket mates are verified on all 64 bits.
A bucket gives the edges of a spanning forest, never all its pairs. One that holds very many
fingerprints is dealt out to buckets by the bytes of the other half; where even such a one is
large, a lookup enumerates the ball of the other half instead of comparing all.

Defined cases: null and empty texts, and texts without a word, have fingerprint zero, which
links like any other; a text of fewer words than a shingle is one shingle; rows with one id
and one text are repeated rows and get the same class; rows without an id are classed by
the ids of the others in their class (null where there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import AtomicType

from hitlake.scratch import materialize

from .common import column, new_name, per_text, tidy
from .components import connected_components, forest

HALF = 32
DISTANCE = 3
SEED = 42
#: Comparisons made at once, and the bucket size beyond which lookups enumerate instead of comparing.
PAIRS_AT_ONCE = 500_000
ENUMERATE_ABOVE = 200_000
#: Fingerprints beyond which a bucket is dealt out, and large buckets that are broadcast (eight bytes each) at most.
LARGE = 20_000
BROADCAST_BUCKETS = 1_000_000
#: A bucket is a half's value, the half's number, and from this bit on the byte of the other half that it is dealt out by.
SUB_BUCKET = 34


def fingerprint(text: bytes | None, words_in_shingle: int = 3) -> int:
    """The 64-bit fingerprint, unsigned."""
    words = text.lower().split() if text else []  # bytes: A-Z and the six ASCII blanks alone
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(words_in_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words_in_shingle: int = 3) -> Column:
    """Fingerprints as signed longs."""

    def run(batches):
        for texts in batches:
            values = [fingerprint(value, words_in_shingle) for value in texts]
            yield [v - (1 << 64) if v >> 63 else v for v in values]

    return per_text(run, "bigint", pa.int64())(text)


def hex_of(fingerprints: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprints), 16, "0"))


def bucket_rows(fingerprints: DataFrame) -> DataFrame:
    """(bucket, probe, fp): where each fingerprint stands (``probe`` false) and where it looks besides."""
    fp = F.col("fp")
    masks = F.array(*[F.lit(1 << i) for i in range(HALF)]).cast("array<bigint>")
    rows = []
    for half in (0, 1):
        value = F.shiftrightunsigned(fp, HALF * half).bitwiseAND((1 << HALF) - 1)
        tag = half << HALF
        own = F.struct((value + tag).alias("bucket"), F.lit(False).alias("probe"))
        flips = F.transform(
            F.filter(masks, lambda mask: value.bitwiseAND(mask) == 0),
            lambda mask: F.struct((value + mask + tag).alias("bucket"), F.lit(True).alias("probe")),
        )
        rows.append(F.concat(F.array(own), flips))
    return fingerprints.select(F.explode(F.concat(*rows)).alias("r"), "fp").select("r.bucket", "r.probe", "fp")


def _ball(half: int) -> np.ndarray:
    """Masks of up to DISTANCE bits outside the given half."""
    bits = [np.uint64(1 << i) for i in range(64) if i // HALF != half]
    sets = [s for size in range(DISTANCE + 1) for s in combinations(bits, size)]
    return np.array([sum(map(int, s)) for s in sets], np.uint64)


def _near_by_enumeration(members: np.ndarray, lookers: np.ndarray, bucket: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    half = bucket >> HALF & 1
    ordered, masks = np.sort(members), _ball(half)
    shift = np.uint64(HALF * half)
    value = np.uint64(bucket & ((1 << HALF) - 1)) << shift
    outside = ~(np.uint64((1 << HALF) - 1) << shift)
    for looker in lookers:
        wanted = ((looker & outside) | value) ^ masks
        place = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
        found = wanted[ordered[place] == wanted]
        found = found[(np.bitwise_count(found ^ looker) <= DISTANCE) & (found != looker)]
        yield np.full(len(found), looker), found


def _near_by_comparison(fps, rows, partners, first) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row i is compared with ``partners[i]`` rows from ``first[i]`` on."""
    done = np.cumsum(partners[rows])
    block = done // PAIRS_AT_ONCE
    for part in np.split(rows, np.flatnonzero(np.diff(block)) + 1):
        count = partners[part]
        left = np.repeat(part, count)
        right = np.repeat(first[part], count) + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        a, b = fps[left], fps[right]
        near = np.bitwise_count(a ^ b) <= DISTANCE
        yield a[near], b[near]


def _forests(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning forests of a stream of pairs, contracted whenever a million edges have gathered."""
    held, count = [], 0
    for a, b in pairs:
        held.append((a, b))
        count += len(a)
        if count > 2 * PAIRS_AT_ONCE:
            edges = forest(*map(np.concatenate, zip(*held)))
            if len(edges[0]) > PAIRS_AT_ONCE:
                yield edges
                held, count = [], 0
            else:
                held, count = [edges], len(edges[0])
    if count:
        yield forest(*map(np.concatenate, zip(*held)))


def link_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between fingerprints of one bucket; rows come sorted by bucket, members before lookers."""
    open_bucket, members = None, np.zeros(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column(0).to_numpy()
        probe = batch.column(1).to_numpy(zero_copy_only=False)
        fps = batch.column(2).to_numpy().view(np.uint64)
        carried = len(members) if bucket[0] == open_bucket else 0
        if carried:
            bucket = np.concatenate([np.full(carried, open_bucket), bucket])
            probe = np.concatenate([np.zeros(carried, bool), probe])
            fps = np.concatenate([members, fps])
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(bucket))))
        size = np.add.reduceat((~probe).astype(np.int64), starts)
        row = np.arange(len(bucket))
        partners = np.where(probe, size[group], row - starts[group])
        partners[:carried] = 0
        large = size[group] > ENUMERATE_ABOVE
        pairs = [_near_by_comparison(fps, np.flatnonzero((partners > 0) & ~large), partners, starts[group])]
        for g in np.unique(group[large & (partners > 0)]):
            inside = (group == g) & (partners > 0)
            exact = fps[starts[g] : starts[g] + size[g]]
            pairs.append(_near_by_enumeration(exact, fps[inside], int(bucket[starts[g]])))
        for child, root in _forests(chain.from_iterable(pairs)):
            yield pa.record_batch([pa.array(child.view(np.int64)), pa.array(root.view(np.int64))], ["a", "b"])
        open_bucket, last = bucket[-1], starts[-1]
        members = fps[last : last + size[-1]].copy()


def split_large(rows: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """``rows`` of :func:`bucket_rows` with the buckets of very many fingerprints dealt out to smaller ones.

    In a bucket one half is known up to the bit that the bucket stands for, so the other halves of two
    near fingerprints differ in three bits at most and agree in one of their four bytes: members
    stand, and lookers look, in the four buckets of their bytes.
    """
    halves = F.array(*[F.shiftrightunsigned("fp", HALF * half).bitwiseAND((1 << HALF) - 1) + (half << HALF) for half in (0, 1)])
    sizes = fingerprints.select(F.explode(halves).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    large = materialize(sizes.where(F.col("members") > LARGE).select("bucket", F.lit(True).alias("large")), "large-buckets")
    count = large.count()  # at most one for each LARGE / 2 fingerprints
    if not count:
        return rows
    marked = rows.join(F.broadcast(large) if count <= BROADCAST_BUCKETS else large, "bucket", "left")
    low, high = F.col("fp").bitwiseAND((1 << HALF) - 1), F.shiftrightunsigned("fp", HALF)
    other = F.when(F.col("bucket") < (1 << HALF), high).otherwise(low)
    byte = lambda at: F.shiftrightunsigned(other, 8 * at).bitwiseAND(255)
    parts = F.array(*[F.col("bucket") + F.shiftleft(byte(at) * 4 + at + 1024, SUB_BUCKET) for at in range(4)])
    dealt = F.when(F.col("large"), parts).otherwise(F.array("bucket"))
    return marked.select(F.explode(dealt).alias("bucket"), "probe", "fp")


def link_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect every two of the distinct ``fp`` within three bits, directly or through others."""
    rows = split_large(bucket_rows(fingerprints), fingerprints)
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "probe")
    return ordered.mapInArrow(tidy(link_buckets), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words_in_shingle: int = 3
) -> DataFrame:
    """One row per document: id, ``fp`` (signed long) and ``component_id``, the smallest id it can be reached from.

    Writes the fingerprints and the rounds of the component search to the scratch folder.
    """
    prints = docs.select(column(doc_id).alias("id"), fingerprint_column(column(text), words_in_shingle).alias("fp"))
    prints = materialize(prints, "fingerprints")
    by_print = class_of_prints(prints).select("fp", "component_id")
    return prints.join(by_print, "fp").select(F.col("id").alias(doc_id), "fp", "component_id")


def class_of_prints(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints of (id, fp): their class, and its smallest id or null."""
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(link_fingerprints(distinct.select("fp")), "simhash")
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    classes = classes.withColumn("root", F.coalesce("root", "fp"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return classes.join(smallest, "root").select("fp", "root", "component_id")


def deduplicate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words_in_shingle: int = 3) -> DataFrame:
    """``docs`` with one document of each class: that with the smallest id, one row of it where rows repeat.

    Where rows of that id differ in text, the one that stays is of the class it stands for: the first by
    text. Classes in which no row has an id keep one row, the first by text; rows without an id in other
    classes go, as the class keeps its smallest id.
    """
    row, n = new_name(docs, "row"), new_name(docs, "n")
    facts = {
        "id": column(doc_id), "fp": fingerprint_column(column(text), words_in_shingle), "said": F.sha2(column(text), 256),
        "rest": F.xxhash64(*[column(f.name) for f in docs.schema.fields if isinstance(f.dataType, AtomicType)]),
    }
    # Written with a number for each row, by which rows are told apart from here on.
    stored = docs.select(F.struct(*[column(c) for c in docs.columns]).alias(row), F.struct(*[c.alias(name) for name, c in facts.items()]).alias("facts"))
    stored = materialize(stored.withColumn(n, F.monotonically_increasing_id()), "fingerprinted")
    light = stored.select(n, "facts.*")
    placed = light.join(class_of_prints(light), "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    # Tasks drop all but their own first row of a class before the shuffle, so a large class is no hot task.
    first = Window.partitionBy("root").orderBy(F.col("said").asc_nulls_first(), "rest", n)
    stays = placed.withColumn("place", F.row_number().over(first)).where("place = 1").select(n)
    return stored.join(stays, n, "left_semi").select(f"{row}.*")
