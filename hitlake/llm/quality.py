"""Quality rules over documents and over their lines across documents of one host.

Per text: words, symbols, repeated lines and words in repeated three-word windows. Across
texts: every normalised line of a host is hashed and the host's documents with it are
counted; lines in more than ``max_documents`` of them are boilerplate and go, and a document
that loses more than ``max_lost`` percent of its words to that is rejected.

DataFrame functions only. The texts are read once: what is needed of them, a few numbers and
one (hash, words) pair per line, is written to the scratch folder. Counts combine before the
shuffle, whatever host or line has how many rows; the join back to the lines has one row per
frequent line on one side, so adaptive execution splits a hot line.

Defined cases: null and empty texts have no words and no lines; a null host is a host of its
own; repeated rows are documents of their own; a document without a word is not depleted (but
fails the base rule); a blank line is never frequent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hitlake.scratch import materialize

from .common import column, new_name

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A line in more documents of a host than this is boilerplate; a document may lose this share of its words to it.
MAX_DOCUMENTS = 10
MAX_LOST_PERCENT = 50


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, though ``body`` uses it in lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeated_window_words(tokens: Column, window: int = WINDOW) -> Column:
    """Number of words in windows of ``window`` words that stand at least twice in ``tokens``.

    Window hashes are sorted with their places; equal neighbours give the places of repeated
    windows, and each place in order adds the words that the one before has not covered.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - window),
        lambda i: F.struct(F.xxhash64(*[F.get(tokens, i + k) for k in range(window)]).alias("h"), i.alias("at")),
    )

    def places(ordered: Column) -> Column:
        repeated = F.filter(
            ordered, lambda x, i: F.coalesce((F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]), F.lit(False))
        )
        return F.sort_array(F.transform(repeated, lambda x: x["at"]))

    covered = F.aggregate(
        bound(F.sort_array(hashes), places),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda done, at: F.struct((at + window).alias("end"), (done["n"] + at + window - F.greatest(at, done["end"])).alias("n")),
        lambda done: done["n"],
    )
    return F.when(F.size(tokens) > window, covered).otherwise(0).cast("bigint")


def line_hash(line: Column) -> Column:
    """Of a line in lower case with single blanks."""
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, BLANKS, " "))))


def lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def text_figures(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """Per row: id, host, the base figures, and ``lines`` as (hash, words)."""
    known = F.coalesce(column(text), F.lit(""))
    parts = docs.select(column(doc_id).alias("id"), column(host).alias("host"), known.alias("text"), words(known).alias("w"), lines(known).alias("l"))
    symbols = F.length("text") - F.length(F.translate("text", SYMBOLS, ""))
    per_line = F.transform("l", lambda line: F.struct(line_hash(line).alias("h"), F.regexp_count(line, F.lit(WORD)).cast("bigint").alias("words")))
    return parts.select(
        "id",
        "host",
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint").alias("n_dup_lines"),
        repeated_window_words(F.col("w")).alias("n_repeat_words"),
        per_line.alias("lines"),
    )


def frequent_lines(rows: DataFrame, max_documents: int) -> DataFrame:
    """(host, h) of lines in more than ``max_documents`` rows; ``rows`` has host and hashes ``hs``."""
    each = rows.select("host", F.explode(F.array_distinct("hs")).alias("h"))
    counts = each.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > max_documents).select(F.col("host").alias("at_host"), F.col("h").alias("frequent"))


def judge(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    max_documents: int = MAX_DOCUMENTS, max_lost: int = MAX_LOST_PERCENT,
) -> DataFrame:
    """One row per document: id, base figures, base_failed, lost_words and kept. Writes a scratch table."""
    figures = text_figures(docs, doc_id, text, host).withColumn("row", F.monotonically_increasing_id())
    figures = materialize(figures, "figures")
    frequent = frequent_lines(figures.select("host", F.col("lines.h").alias("hs")), max_documents)
    occurrences = figures.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.*")
    same = F.col("host").eqNullSafe(F.col("at_host")) & (F.col("h") == F.col("frequent"))
    lost = occurrences.join(frequent, same).groupBy("row").agg(F.sum("words").alias("lost_words"))
    joined = figures.drop("lines").join(lost, "row", "left")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    missing = F.coalesce("lost_words", F.lit(0).cast("bigint"))
    return joined.select(
        F.col("id").alias(doc_id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), missing.alias("lost_words"),
        (~base & (100 * missing <= max_lost * F.col("n_words"))).alias("kept"),
    )


def remove_frequent_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    max_documents: int = MAX_DOCUMENTS, max_lost: int = MAX_LOST_PERCENT,
) -> DataFrame:
    """``docs`` without frequent lines in ``text`` and without the documents that these leave depleted.

    Rows with one id, host and text lose the same lines.
    """
    key = [F.coalesce(column(doc_id).cast("string"), F.lit("")).alias("id"), F.xxhash64(column(text), column(host)).alias("digest")]
    hashed = F.transform(lines(column(text)), line_hash)
    rows = materialize(docs.select(*key, column(host).alias("host"), hashed.alias("hs")), "line-hashes")
    frequent = frequent_lines(rows, max_documents)
    each = rows.select("id", "digest", "host", F.explode(F.array_distinct("hs")).alias("h"))
    same = F.col("host").eqNullSafe(F.col("at_host")) & (F.col("h") == F.col("frequent"))
    found = each.join(frequent, same).groupBy("id", "digest").agg(F.collect_set("h").alias("gone"))
    row, gone, left = (new_name(docs, n) for n in ("row", "gone", "left"))
    wrapped = docs.select(*key, F.struct(*[column(c) for c in docs.columns]).alias(row))
    joined = wrapped.join(found, ["id", "digest"], "left")
    own = F.col(row)[text]
    kept_lines = F.filter(F.split(own, "\n"), lambda line: ~line.rlike(WORD) | ~F.array_contains("gone", line_hash(line)))
    cleaned = joined.select(row, F.when(F.col("gone").isNull(), own).otherwise(F.array_join(kept_lines, "\n")).alias(left))
    count = lambda c: F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0))
    enough = cleaned.where(100 * (count(own) - count(F.col(left))) <= max_lost * count(own))
    return enough.select(*[F.col(left).alias(c) if c == text else F.col(row)[c].alias(c) for c in docs.columns])
