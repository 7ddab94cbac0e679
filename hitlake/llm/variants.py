"""Spelling variants: words one edit apart, grouped under the commonest of them.

Each word is reduced: every letter is hashed to one of a few symbols. Words one edit apart
have reduced forms that are equal or one edit apart, and the neighbourhoods of reduced words
are small, because there are few symbols to insert or put in place. Every word stands in a
table under its reduced form and looks up that form's one-edit neighbourhood there. Of two
reduced forms an edit apart only one has to look: the longer one (its deletions are the
other's insertions) or, if equally long, the one with the smaller symbol at the place; so
neighbourhoods are whole and each pair is met once. Pairs are verified on the words.

Words are counted in tasks and combined before the shuffle; at most ``WORDS_AT_ONCE`` are held
at a time. The number of symbols grows with the vocabulary, so that about as many reduced
forms of the shortest words exist as there are words and a bucket stays small at any size;
it changes no result. Joins are on reduced forms; adaptive execution splits hot ones. The
vocabulary and the rounds that follow words to their roots are written to the scratch
folder: a form is ``ratio`` times as frequent as its word, so chains are of logarithmic
length and rounds double what they span.

Defined cases: null texts have no words; an id that is null counts as the empty text where
slips are drawn; repeated rows count each time; words that have no near word have neither
form nor n_near (0) and are their own root; ties go to the word first in code-point order.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitlake.scratch import materialize, remove_scratch

from .common import column

#: Distinct words a task holds before it passes their counts on.
WORDS_AT_ONCE = 300_000
#: Texts read from a batch at a time.
TEXTS_AT_ONCE = 500
FEWEST_SYMBOLS = 8
MOST_SYMBOLS = 64

#: Words in texts of one byte a character: letters, after A-Z are lower-cased.
LETTERS = rb"[a-z\xc0-\xff]{%d,}"


def slipped(word: bytes, seed: int, one_in: int) -> bytes | None:
    """``word`` without a letter, where its hash (continued from ``seed``) draws it; else None."""
    h = crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
    if h % one_in:
        return None
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = 6, min_count: int = 5, one_in: int | None = None
) -> DataFrame:
    """(word, n) of the words of at least ``min_chars`` letters that occur at least ``min_count`` times.

    A word is a run of letters of Latin-1, A-Z lower-cased. With ``one_in`` an occurrence whose
    CRC-32, with the document's id before it, is divisible by that loses a letter: typing errors
    that can be told from the result.
    """
    words = re.compile(LETTERS % min_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def ready() -> pa.RecordBatch:
            words_here = pa.array([w.decode("latin-1") for w in counts], pa.string())
            batch = pa.record_batch([words_here, pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                for key, raw in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    # One byte a character, so that places are characters; what Latin-1 lacks is no letter.
                    found = words.findall(raw.decode("utf-8", "replace").encode("latin-1", "replace").lower()) if raw else []
                    counts.update(found)
                    if one_in:
                        seed = crc32(f"{'' if key is None else key}:".encode())
                        for word in set(found):
                            if (short := slipped(word, seed, one_in)) is not None:
                                times = found.count(word)
                                counts[word] -= times
                                if len(short) >= min_chars:
                                    counts[short] += times
                    if len(counts) > WORDS_AT_ONCE:
                        yield ready()
        yield ready()

    found = docs.select(column(doc_id).cast("string"), column(text)).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def symbols_for(words: int, min_chars: int) -> int:
    """So many that there are about as many reduced words of ``min_chars`` symbols as words."""
    return min(MOST_SYMBOLS, max(FEWEST_SYMBOLS, math.ceil(words ** (1 / min_chars))))


def reduced(word: Column, symbols: int) -> Column:
    """Every letter as one of ``symbols`` characters, by its hash."""
    letters = F.filter(F.split(word, ""), lambda letter: letter != "")
    return F.array_join(F.transform(letters, lambda letter: _symbol(F.pmod(F.xxhash64(letter), F.lit(symbols)))), "")


def _symbol(at: Column) -> Column:
    """Symbols are characters from ``0`` on, one byte each."""
    return F.char(at + 48)


def lookups(form: Column, symbols: int) -> Column:
    """The reduced form, its deletions, and its replacements by larger symbols; each once."""
    places = F.sequence(F.lit(1), F.length(form))
    before = lambda i: F.substring(form, 1, i - 1)
    after = lambda i: form.substr(i + 1, F.length(form))
    deleted = F.transform(places, lambda i: F.concat(before(i), after(i)))
    larger = lambda i: F.filter(F.array(*[_symbol(F.lit(s)) for s in range(symbols)]), lambda s: s > form.substr(i, F.lit(1)))
    replaced = F.flatten(F.transform(places, lambda i: F.transform(larger(i), lambda s: F.concat(before(i), s, after(i)))))
    return F.array_distinct(F.concat(F.array(form), deleted, replaced))


def near_pairs(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """(a, a_n, b, b_n) for every two words one edit apart, each pair once; ``vocabulary`` has distinct ``word`` and ``n``."""
    formed = vocabulary.select("word", "n", reduced(F.col("word"), symbols).alias("form"))
    keys = F.explode(lookups(F.col("form"), symbols)).alias("key")
    lookers = formed.select(keys, F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("form").alias("a_form"))
    members = formed.select(F.col("form").alias("key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    once = (F.col("key") != F.col("a_form")) | (F.col("a") < F.col("b"))  # words of one form look each other up
    met = lookers.join(members, "key").where(once & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each word's chain of forms. Chains have no cycle."""
    state = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moves = F.col("next").isNotNull().alias("moved")
        longer = state.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), moves)
        following = materialize(longer, "variant-roots")
        moved = following.where("moved").limit(1).count()
        remove_scratch(state)
        state = following.drop("moved")
        if not moved:
            return state


def group_variants(vocabulary: DataFrame, *, ratio: int = 5, symbols: int | None = None) -> DataFrame:
    """Per word of ``vocabulary`` (distinct ``word``, ``n``): form, root, n, n_near, form_n.

    Its form is the most frequent word one edit from it, if that is at least ``ratio`` (over 1)
    times as frequent as the word itself; its root is what following forms ends at.
    """
    kept = materialize(vocabulary.where("word IS NOT NULL").select("word", "n"), "vocabulary")
    shortest, size = kept.agg(F.min(F.length("word")), F.count(F.lit(1))).first()
    pairs = near_pairs(kept, symbols or symbols_for(size, max(1, shortest or 1)))
    near = lambda y: F.struct((-F.col(f"{y}_n")).alias("less"), F.col(y).alias("word")).alias("near")
    both = F.array(*[F.struct(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), near(y)) for x, y in ("ab", "ba")])
    sides = pairs.select(F.explode(both).alias("s")).select("s.*")
    nearest = sides.groupBy("word").agg(F.min("near").alias("best"), F.count(F.lit(1)).alias("n_near"))
    joined = kept.join(nearest, "word", "left")
    frequent = -F.col("best.less") >= ratio * F.col("n")
    found = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(frequent, F.col("best.word")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    found = materialize(found, "variant-forms")
    ends = roots(found.where("form IS NOT NULL"))
    rooted = found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return rooted.select("word", "form", "root", "n", "n_near", "form_n")
