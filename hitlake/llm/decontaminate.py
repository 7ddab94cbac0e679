"""Benchmark decontamination: word windows of the test items, looked up in every document.

Items give windows of ``n`` consecutive words (a shorter item is one window). Where they are
small enough the windows go to every task as a hash set made of arrays: the hashes of the
windows of each length, sorted, with the places of their words in the items' text. A document's
windows whose words are all known are hashed, and a hash that is in the set is verified on the
words. ``broadcast_bytes`` bounds the memory that the set takes, which follows from the number of
words (``BYTES_PER_WORD``), counted first. A larger benchmark is joined by shuffle on 128-bit
window hashes; a Bloom filter of fixed size goes to the tasks, and only the windows that pass it
are shuffled. Both ways give the same rows.

Defined cases: a null text has no words, an item without words has no window and is never
found, items with one id count as one item, repeated documents are judged each on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import column, new_name, per_text

# A word is a run of digits, ASCII letters (lower-cased) and bytes of other scripts.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD_RUN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

HITS = "struct<n_words:bigint,n_hit:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"
HITS_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def windows_of(words: list[bytes], n: int) -> Iterator[tuple[bytes, ...]]:
    if words:
        length = min(n, len(words))
        for start in range(len(words) - length + 1):
            yield tuple(words[start : start + length])


#: What a word of the items takes in a set at most: a window (hash, place, item), the word's ends, its mark, its text.
BYTES_PER_WORD = 64
#: Bits of the Bloom filter, and the bits a bitmap row holds.
BLOOM_BITS, BITMAP_BITS = 1 << 27, 1 << 15


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """One number for the ``length`` words from each start on."""
    total = np.zeros(len(starts), np.uint64)
    for position in range(length):
        total = (total ^ hashes[starts + position]) * FACTOR
        total ^= total >> np.uint64(29)
    return total


class WindowSet:
    """The windows of a bounded number of items, as arrays."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        words: list[bytes] = []
        starts: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        self.items = [item for item, _ in items]
        for at, (_, text) in enumerate(items):
            own = words_of(text)
            if own:
                length = min(n, len(own))
                here = np.arange(len(words), len(words) + len(own) - length + 1)
                starts.setdefault(length, []).append(here)
                owners.setdefault(length, []).append(np.full(len(here), at, np.int32))
                words += own
        self.text = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(sizes + 1) - 1
        self.begins = self.ends - sizes
        hashes = word_hashes(words)
        bits = max(10, (8 * len(words)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.marks = np.zeros((1 << bits) // 8, np.uint8)  # a bit for words that stand in items
        np.bitwise_or.at(self.marks, ((hashes & self.mask) >> np.uint64(3)).astype(np.int64), np.uint8(1) << (hashes & np.uint64(7)).astype(np.uint8))
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length, parts in starts.items():
            place, owner = np.concatenate(parts), np.concatenate(owners[length])
            found = window_hashes(hashes, place, length)
            order = np.argsort(found, kind="stable")
            self.windows[length] = found[order], place[order], owner[order]

    def nbytes(self) -> int:
        arrays = [self.ends, self.begins, self.marks, *(a for window in self.windows.values() for a in window)]
        return len(self.text) + sum(a.nbytes for a in arrays)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        return (self.marks[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1

    def find_in(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the items of those windows."""
        hit, items = np.zeros(len(words), bool), set()
        hashes = word_hashes(words)
        count = np.concatenate([[0], np.cumsum(self.known(hashes))])
        for length, (wanted, places, owners) in self.windows.items():
            if count[-1] < length:
                continue
            starts = np.flatnonzero(count[length:] - count[:-length] == length)
            here = window_hashes(hashes, starts, length)
            first = np.searchsorted(wanted, here)
            met = wanted[np.minimum(first, len(wanted) - 1)] == here
            for start, at, h in zip(starts[met], first[met], here[met]):
                said = b" ".join(words[start : start + length])
                while at < len(wanted) and wanted[at] == h:
                    place = places[at]
                    if self.text[self.begins[place] : self.ends[place + length - 1]] == said:
                        hit[start : start + length] = True
                        items.add(self.items[owners[at]])
                    at += 1
        return hit, items


def _spans(hit: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 13,
    broadcast_bytes: int = 64 << 20,
    name: str = "contamination",
) -> DataFrame:
    """``docs`` with a struct ``name``: n_words, n_hit, spans of hit words (end excluded) and sorted items.

    Runs one small job that measures the benchmark.
    """
    items = benchmark.select(column(item_id).cast("string").alias("item"), column(item_text).alias("text"))
    # A word has a byte and a byte behind it at least; an item its name and what Python adds to it.
    words = F.regexp_count(F.col("text"), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    size = items.agg(F.sum(F.coalesce(words, F.lit(0)) * BYTES_PER_WORD + F.coalesce(F.octet_length("text") + F.octet_length("item"), F.lit(0)) + 100)).first()[0] or 0
    if size > broadcast_bytes:
        return _find_by_join(docs, items, text, n, name)
    rows = items.where("item IS NOT NULL AND text IS NOT NULL").collect()  # at most broadcast_bytes
    windows = WindowSet([(r.item, r.text.encode()) for r in rows], n)
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def scan(batches):
        known = shared.value
        for texts in batches:
            out = []
            for value in texts:
                words = words_of(value)
                hit, found = known.find_in(words)
                out.append(
                    {"n_words": len(words), "n_hit": int(hit.sum()), "spans": _spans(hit), "items": sorted(found)}
                )
            yield out

    return docs.withColumn(name, per_text(scan, HITS, HITS_ARROW)(column(text)))


#: Rows passed on at a time.
ROWS_AT_ONCE = 50_000


def bloom_filter(items: DataFrame, n: int, bits: int = BLOOM_BITS) -> np.ndarray:
    """A bitmap of ``bits`` (a power of two) with two places of every window of the items; its size depends on nothing else."""

    def places(batches):
        for batch in batches:
            found = []
            for value in batch.column(0).cast(pa.binary()).to_pylist():
                words = words_of(value)
                length = min(n, len(words))
                if words:
                    found.append(window_hashes(word_hashes(words), np.arange(len(words) - length + 1), length))
            hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
            # Places from 1, as the bitmap functions count them.
            both = np.concatenate(bloom_places(hashes, bits)).astype(np.int64) + 1
            yield pa.record_batch([pa.array(both)], ["place"])

    rows = items.where("item IS NOT NULL AND text IS NOT NULL").select("text").mapInArrow(places, "place bigint")
    maps = rows.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    filled = np.zeros(bits // 8, np.uint8)
    for row in maps.collect():  # at most bits / BITMAP_BITS of them
        at = (row.part - 1) * BITMAP_BITS // 8
        part = np.frombuffer(row.bits, np.uint8)[: bits // 8 - at]
        filled[at : at + len(part)] = part
    return filled


def bloom_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) * np.uint64(0x85EBCA6B) & mask


def passes(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether windows with these hashes may be in the filter."""
    found = np.ones(len(hashes), bool)
    for place in bloom_places(hashes, 8 * len(filled)):
        found &= (filled[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def _find_by_join(docs: DataFrame, items: DataFrame, text: str, n: int, name: str) -> DataFrame:
    """The same for a benchmark of any size: windows of both sides meet by hash."""
    lengths = [r.length for r in _item_windows(items, n).select("length").distinct().collect()]  # 1 to n
    shared = docs.sparkSession.sparkContext.broadcast(bloom_filter(items, n))

    def doc_windows(batches):
        bits = shared.value
        keys, starts, sizes, digests = [], [], [], []

        def ready():
            batch = pa.record_batch(
                [pa.array(keys, pa.string()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary())],
                ["key", "start", "length", "hash"],
            )
            for cells in (keys, starts, sizes, digests):
                cells.clear()
            return batch

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = words_of(value)
                hashes = word_hashes(words)
                for length in lengths:
                    every = np.arange(len(words) - length + 1)
                    for start in every[passes(bits, window_hashes(hashes, every, length))] if len(every) else ():
                        keys.append(key)
                        starts.append(start)
                        sizes.append(length)
                        digests.append(xxhash.xxh3_128_digest(b" ".join(words[start : start + length])))
                        if len(keys) >= ROWS_AT_ONCE:
                            yield ready()
        yield ready()

    def mark(batches):
        for texts in batches:
            yield [len(words_of(value)) for value in texts]

    # Equal texts have equal windows, so each text is looked up once.
    key, size, pair = (new_name(docs, n) for n in ("key", "size", "hits"))
    keyed = docs.withColumn(key, F.sha2(column(text), 256))
    texts = keyed.select(F.col(key).alias("key"), column(text).alias("text")).where(F.col("key").isNotNull())
    found = texts.dropDuplicates(["key"]).mapInArrow(doc_windows, "key string, start int, length int, hash binary")
    meets = found.join(_item_windows(items, n).drop("length"), "hash")
    hits = meets.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("ranges"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    merged = F.aggregate(
        "ranges",
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, r: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= r["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], r["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(r))),
    )
    hits = hits.select(F.col("key").alias(key), merged.alias("spans"), "items")
    joined = keyed.join(hits.select(key, F.struct("spans", "items").alias(pair)), key, "left").withColumn(size, per_text(mark, "bigint", pa.int64())(column(text)))
    n_hit = F.aggregate(f"{pair}.spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    result = F.struct(
        F.col(size).alias("n_words"),
        F.coalesce(n_hit, F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce(f"{pair}.spans", F.array()).alias("spans"),
        F.coalesce(f"{pair}.items", F.array()).alias("items"),
    )
    return joined.select(*[column(c) for c in docs.columns], result.cast(HITS).alias(name))


def _item_windows(items: DataFrame, n: int) -> DataFrame:
    """Distinct (hash, item, length) of the items' windows."""

    def windows(batches):
        for batch in batches:
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                found = list(windows_of(words_of(value), n))
                yield pa.record_batch(
                    [
                        pa.array([xxhash.xxh3_128_digest(b" ".join(w)) for w in found], pa.binary()),
                        pa.array([item] * len(found), pa.string()),
                        pa.array([len(w) for w in found], pa.int32()),
                    ],
                    ["hash", "item", "length"],
                )

    return items.where(F.col("item").isNotNull()).mapInArrow(windows, "hash binary, item string, length int").distinct()


def contaminated(hits: Column, percent: int = 5) -> Column:
    """The rule on the struct of :func:`find_windows`: at least ``percent`` of the words are hit."""
    return (hits["n_hit"] > 0) & (hits["n_hit"] * 100 >= hits["n_words"] * percent)


def remove_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans``; what stands between words stays."""

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in batches:
            out = []
            for value, found in zip(texts.cast(pa.binary()).to_pylist(), ranges.to_pylist()):
                if value is not None and found:
                    places = [m.span() for m in WORD_RUN.finditer(value)]
                    for r in reversed(found):
                        value = value[: places[r["start"]][0]] + value[places[r["end"] - 1][1] :]
                out.append(None if value is None else value.decode())
            yield pa.array(out, pa.string())

    cut.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(cut, returnType="string")(text, spans)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", remove: str = "documents", percent: int = 5, **options
) -> DataFrame:
    """``docs`` without contaminated documents, or without the words of all hits (``remove="spans"``)."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    hits = new_name(docs, "contamination")
    found = find_windows(docs, benchmark, text=text, name=hits, **options)
    if remove == "documents":
        return found.where(~contaminated(F.col(hits), percent)).drop(hits)
    cleaned = remove_spans(column(text), F.col(hits)["spans"])
    return found.select(*[cleaned.alias(c) if c == text else column(c) for c in docs.columns])
