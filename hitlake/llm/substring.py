"""Substring deduplication over sliding runs of sentences.

A text is cut into sentences; a sentence of more than ``MAX_WORDS`` words is cut at its
commas, and what is still longer after words whose hash is the lowest among their neighbours.
So a passage is cut alike wherever it stands, but for at most ``MAX_WORDS`` words at either end.
From every sentence the shortest run of at least ``MIN_SENTENCES`` sentences and
``MIN_WORDS`` words is hashed (96 bits of XXH3 over the lower-cased words). Hashes meet in a
shuffle; a run that stands in a document before, or earlier in its own, is a
repeat, and all its sentences are removed. So any passage of fifty words with the same line
breaks shares a run with its copies, and one copy of the run stays. The runs that stand in several places
are written to the scratch folder. Counting combines before the shuffle; a run that very many documents share is a skewed
join key with one row on the other side, which adaptive execution splits.

A row is known by its id and 88 bits of hash of its text, so rows of one id never take each
other's places. Characters of scripts without blanks (Chinese, Japanese) are words of their
own, each, and their marks end sentences.

Defined cases: null texts stay null; texts too short for a run stay as they are; rows with
one id are one document (none of them repeats another); rows without an id come last, each
a document of its own: of equal texts all but one lose what they share, among different ones
that of the smaller hash stands before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from hitlake.scratch import materialize

from .common import column, new_name, tidy

MIN_SENTENCES = 3
MIN_WORDS = 20
MAX_WORDS = 10
#: Neighbouring words among which one of a long sentence ends a piece; at most MAX_WORDS.
SPAN = 8
#: In a place: the run stood earlier in the same document. Runs have at most MIN_WORDS sentences, so seven bits hold the length.
AGAIN = 128

#: Characters that are words each: from CJK radicals to Hangul's end, and the planes of further ideographs.
CHARACTER = re.compile("[\u2e80-\ud7ff\U00020000-\U0003ffff]")
WORD = re.compile(rf"{CHARACTER.pattern}|[^\s{CHARACTER.pattern[1:-1]}]+")
#: Bits of a place that belong to the text's second hash.
SECOND = 24

ENDS = frozenset(".!?。！？")
PAUSES = frozenset(",;:")
RESULT = "struct<text:string,n_removed:bigint,removed_chars:bigint>"


def sentences(text: str) -> list[list[str]]:
    """The words of every sentence, long ones in pieces; together all words of the text."""
    out: list[list[str]] = []
    split = WORD.findall if not text.isascii() and CHARACTER.search(text) else str.split
    for line in text.split("\n"):
        words, start = split(line), 0
        for end, word in enumerate(words, 1):
            if word[-1] in ENDS:
                _add(out, words[start:end])
                start = end
        _add(out, words[start:])
    return out


def _add(out: list[list[str]], words: list[str]) -> None:
    if len(words) <= MAX_WORDS:
        if words:
            out.append(words)
        return
    start = 0
    for end, word in enumerate(words, 1):
        if word[-1] in PAUSES or end == len(words):
            _cut(out, words[start:end])
            start = end


def _cut(out: list[list[str]], words: list[str]) -> None:
    """Cut a long part after the word of lowest hash (the last such) in each ``SPAN`` neighbouring words.

    Whether a word is one depends on fewer than ``SPAN`` words to either side, not on where the part starts.
    """
    if len(words) <= MAX_WORDS:
        out.append(words)
        return
    hashes = [crc32(word.lower().encode()) for word in words]
    start, lowest = 0, -1
    for end in range(SPAN, len(words) + 1):
        if lowest < end - SPAN:
            span = hashes[end - SPAN : end]
            lowest = end - 1 - span[::-1].index(min(span))
        elif hashes[end - 1] <= hashes[lowest]:
            lowest = end - 1
        else:
            continue
        out.append(words[start : lowest + 1])
        start = lowest + 1
    if start < len(words):
        out.append(words[start:])


def starts_of(text: str, units: list[list[str]]) -> list[int]:
    """Where each sentence starts: the first at 0, so that they cover the text; the text's end is last."""
    out, at = [], 0
    for unit in units:
        at = text.find(unit[0], at)
        out.append(at)
        for word in unit:
            at = text.find(word, at) + len(word)
    return [0, *out[1:], len(text)] if out else [len(text)]


def runs(text: str) -> tuple[list[bytes], list[int]]:
    """Digest and number of sentences of the shortest long enough run from each sentence, as far as there are such."""
    units = sentences(text.lower())
    forms, sizes = [" ".join(unit).encode() for unit in units], list(map(len, units))
    digests, lengths = [], []
    stop, words, last = 0, 0, len(units)
    for start in range(last):
        while stop < last and (stop - start < MIN_SENTENCES or words < MIN_WORDS):
            words += sizes[stop]
            stop += 1
        if stop - start < MIN_SENTENCES or words < MIN_WORDS:
            break
        digests.append(xxhash.xxh3_128_digest(b"\0".join(forms[start:stop])))
        lengths.append(stop - start)
        words -= sizes[start]
    return digests, lengths


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, c, id, tag, place): 96 bits of hash, the document, its text's first hash, and where the run stands in it.

    ``place`` packs the text's second hash, the run's first sentence, whether it is a repeat within
    the text, and its length.
    """
    for batch in batches:
        owners, texts, tags, seconds = *batch.columns[:3], batch.column(3).to_numpy()
        ids = range(len(owners))
        digests, places, counts, first = [], [], [], 0
        for at in range(len(ids)):
            text = texts[at].as_py()
            found, lengths = runs(text) if text else ([], [])
            digests += found
            counts.append(len(found))
            place = (np.arange(len(found), dtype=np.int64) << 8) + np.array(lengths, np.int64) + seconds[at]
            if len(set(found)) < len(found):
                own: set[bytes] = set()
                place += [AGAIN if d in own or own.add(d) else 0 for d in found]
            places.append(place)
            if len(digests) > 100_000 or at == len(ids) - 1:
                bits = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
                yield pa.record_batch(
                    [
                        pa.array(bits[:, 0].astype(np.int64)),
                        pa.array(bits[:, 1].astype(np.uint32).view(np.int32)),
                        *[c.take(pa.array(np.repeat(np.arange(first, at + 1), counts))) for c in (owners, tags)],
                        pa.array(np.concatenate(places)),
                    ],
                    ["h", "c", "id", "tag", "place"],
                )
                digests, places, counts, first = [], [], [], at + 1


def _without(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts without the sentences of the given runs; with a third column true, of all their runs."""
    for texts, places, copies in batches:
        out = []
        for text, found, copy in zip(texts.to_pylist(), places.to_pylist(), copies.to_pylist()):
            spans = [((place >> 8) & 0xFFFFFFFF, place & 127) for place in found or ()]
            if copy and text:
                spans = list(enumerate(runs(text)[1]))
            if not spans:
                out.append({"text": text, "n_removed": 0, "removed_chars": 0})
                continue
            gone = {at for start, length in spans for at in range(start, start + length)}
            starts = starts_of(text, sentences(text))
            rest = "".join(text[starts[i] : starts[i + 1]] for i in range(len(starts) - 1) if i not in gone)
            out.append({"text": rest, "n_removed": len(gone), "removed_chars": len(text) - len(rest)})
        yield pa.array(out, pa.struct([("text", pa.string()), ("n_removed", pa.int64()), ("removed_chars", pa.int64())]))


_without.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", name: str = "repeats") -> DataFrame:
    """``docs`` with a struct ``name``: the text without repeated sentences, and what was removed from it.

    Writes the repeated runs, and the rows without an id, to the scratch folder.
    """
    tag = F.xxhash64(column(text))
    second = F.shiftleft(F.xxhash64(F.lit("second"), column(text)), 64 - SECOND)
    owner = column(doc_id).cast("bigint")
    shape = "h bigint, c int, id bigint, tag bigint, place bigint"
    runs_in = lambda part: part.select(owner, column(text), tag, second).mapInArrow(tidy(_run_rows), shape)
    least = [F.min("id").alias("first"), F.min(F.when(F.col("id").isNull(), F.col("tag"))).alias("first_tag"), F.count(F.lit(1)).alias("n")]
    repeated = runs_in(docs).groupBy("h", "c").agg(*least)
    # Written out, so that both sides of the join are shuffled for it alone and a hot run can be split.
    repeated = materialize(repeated.where("n > 1").drop("n"), "repeated-runs")

    def found_in(part: DataFrame, later: str) -> DataFrame:
        again = runs_in(part).join(repeated, ["h", "c"]).where(f"{later} OR (place & {AGAIN}) != 0")
        return again.groupBy("id", "tag", F.expr(f"place >> {64 - SECOND}").alias("second")).agg(F.collect_set("place").alias("places"))

    has_id = column(doc_id).isNotNull()
    row, key, tagged, more, places, copy = (new_name(docs, n) for n in ("row", "id", "tag", "second", "places", "copy"))
    wrapped = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias(row), owner.alias(key), tag.alias(tagged), F.shiftright(second, 64 - SECOND).alias(more)
    )
    names = {"id": f"{key}_", "tag": f"{tagged}_", "second": f"{more}_", "places": places}
    renamed = lambda found: found.select(*(F.col(c).alias(name) for c, name in names.items()))
    same = (F.col(tagged) == F.col(f"{tagged}_")) & (F.col(more) == F.col(f"{more}_"))
    found = renamed(found_in(docs.where(has_id), "id > first"))
    known = wrapped.where(F.col(key).isNotNull()).join(found, same & (F.col(key) == F.col(f"{key}_")), "left")
    # Rows without an id get a number that stays, since they are written, and equal texts but the least are copies.
    orphans = materialize(wrapped.where(F.col(key).isNull()).withColumn(copy, F.monotonically_increasing_id()), "rows-without-id")
    stays = orphans.groupBy(F.col(tagged).alias("of"), F.col(more).alias("of_second")).agg(F.min(copy).alias("stays"))
    unknown = orphans.join(stays, (F.col(tagged) == F.col("of")) & (F.col(more) == F.col("of_second")))
    unknown = unknown.join(renamed(found_in(docs.where(~has_id), "(first IS NOT NULL OR tag > first_tag)")), same, "left")
    parts = known.select(row, places, F.lit(False).alias(copy)).union(unknown.select(row, places, F.col(copy) > F.col("stays")))
    result = F.arrow_udf(tidy(_without), returnType=RESULT).asNondeterministic()(F.col(row)[text], F.col(places), F.col(copy))
    return parts.select(f"{row}.*", result.alias(name))


def deduplicate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated sentences taken out of ``text``; a document of which nothing is left goes."""
    found = new_name(docs, "repeats")
    done = remove_repeats(docs, doc_id=doc_id, text=text, name=found)
    emptied = (F.col(found)["n_removed"] > 0) & (F.trim(F.col(found)["text"]) == "")
    kept = done.where(~F.coalesce(emptied, F.lit(False)))
    return kept.select(*[F.col(found)["text"].alias(c) if c == text else column(c) for c in docs.columns])
