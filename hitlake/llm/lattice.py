"""Language-model scores from the lattice of subword segmentations.

The pieces and their scores come from an existing vocabulary file. A word's probability is the
sum over all its segmentations of the product of piece probabilities, by the forward recursion
in log space; characters without a piece of their own fall back on byte pieces. A text is its
words and one end. Piece probabilities are the vocabulary's, as a prior of ``PRIOR`` pieces,
updated by ``rounds`` of expected counts (forward-backward) over all training words.

Everything that a text needs of the corpus belongs to its words: the training count and the
lattice probability. Both are computed once per distinct word, in a table that Spark counts
and joins by word. The ``FREQUENT`` most counted words, whose lengths are bounded too, go to
every task as a broadcast, so that no frequent word is a join key; the others are looked up
by a shuffle join. Only piece counts (one per piece) and sums come to the driver.

Defined cases: a null text is empty, an empty text has one token, its end; repeated rows count
and are scored each; without training rows all counts are zero and the prior alone scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hitlake.scratch import materialize

from .common import column

START = "▁"
BYTE = re.compile("<0x[0-9A-F]{2}>")
FACTOR = 0x9E3779B97F4A7C15
SLOT_BITS = 20
SLOT_SHIFT = np.uint64(64 - SLOT_BITS)
FREQUENT = 65_536
FREQUENT_BYTES = 64
PRIOR = 1000.0
#: Log probability of a byte that the vocabulary lacks.
NO_BYTE = -20.0
NOTHING = -math.inf
LN10 = math.log(10)


def load_pieces(path: str, scores: str = "rank") -> dict[str, float]:
    """Natural log probabilities of a SentencePiece vocabulary's pieces.

    ``scores="log"`` takes the scores as log weights; ``"rank"``, for vocabularies whose scores are
    negated ranks, reads rank r as the weight 1 / (r + 10).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            score = model.get_score(i)
            pieces[model.id_to_piece(i)] = score if scores == "log" else -math.log(10 + (i if model.is_byte(i) else max(0.0, -score)))
    return normalised(pieces)


def normalised(weights: dict[str, float]) -> dict[str, float]:
    total = _log_sum(list(weights.values()))
    return {piece: weight - total for piece, weight in weights.items()}


def _log_sum(terms: list[float]) -> float:
    top = max(terms, default=NOTHING)
    return top if top == NOTHING else top + math.log(sum(math.exp(t - top) for t in terms))


class Pieces:
    """A vocabulary as arrays: pieces are found by the hash of their characters, many at a time."""

    def __init__(self, weights: dict[str, float]):
        self.names = sorted(weights)
        self.logs = np.array([weights[name] for name in self.names])
        self.longest = max(map(len, self.names), default=0)
        self.bytes = {int(name[3:5], 16): i for i, name in enumerate(self.names) if BYTE.fullmatch(name)}
        hashes = np.array([self._hash(name) for name in self.names], np.uint64)
        self.tables, left = [], np.arange(len(hashes))
        while len(left):  # pieces that share a slot go to further tables
            slots, first = np.unique(hashes[left] >> SLOT_SHIFT, return_index=True)
            table, ids = np.zeros(1 << SLOT_BITS, np.uint64), np.full(1 << SLOT_BITS, -1, np.int32)
            table[slots], ids[slots] = hashes[left[first]], left[first]
            self.tables.append((table, ids))
            left = np.delete(left, first)

    @staticmethod
    def _hash(name: str) -> int:
        value = 0
        for char in name:
            value = (value + ord(char) + 1) * FACTOR % (1 << 64)
        return value

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 where there is none."""
        slots, found = hashes >> SLOT_SHIFT, np.full(len(hashes), -1, np.int32)
        for table, ids in self.tables:
            found = np.where((table[slots] == hashes) & (ids[slots] >= 0), ids[slots], found)
        return found

    def spell(self, code: int) -> tuple[float, list[int]]:
        """Log probability and numbers of the byte pieces of a character."""
        ids = [self.bytes.get(byte, -1) for byte in chr(code).encode()]
        return sum(self.logs[i] if i >= 0 else NO_BYTE for i in ids), [i for i in ids if i >= 0]


class Lattice:
    """All segmentations of words of one length: ``edges`` of (start, end, words, pieces, log probabilities)."""

    def __init__(self, words: list[str], pieces: Pieces):
        self.pieces, self.size = pieces, len(words[0]) + 1
        codes = np.frombuffer("".join(START + word for word in words).encode("utf-32-le"), np.uint32)
        self.codes = codes.reshape(len(words), self.size)
        grown = self.codes.astype(np.uint64) + np.uint64(1)
        self.edges, self.spelled = [], []
        for start in range(self.size):
            hashes = np.zeros(len(words), np.uint64)
            for end in range(start + 1, min(self.size, start + pieces.longest) + 1):
                hashes = (hashes + grown[:, end - 1]) * np.uint64(FACTOR)
                found = pieces.find(hashes)
                rows = np.flatnonzero(found >= 0)
                if len(rows):
                    self.edges.append((start, end, rows, found[rows], pieces.logs[found[rows]]))
                if end == start + 1 and len(rows) < len(words):
                    self._spell(start, np.flatnonzero(found < 0))

    def _spell(self, start: int, rows: np.ndarray) -> None:
        chars, which = np.unique(self.codes[rows, start], return_inverse=True)
        spelled = [self.pieces.spell(int(code)) for code in chars]
        logs = np.array([log for log, _ in spelled])[which]
        self.edges.append((start, start + 1, rows, None, logs))
        self.spelled.append((len(self.edges) - 1, which, [ids for _, ids in spelled]))

    def forward(self) -> np.ndarray:
        """Log probability of every prefix, summed over its segmentations; edges come by their starts."""
        alpha = np.full((self.size + 1, len(self.codes)), NOTHING)
        alpha[0] = 0.0
        for start, end, rows, _, logs in self.edges:
            alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[start, rows] + logs)
        return alpha

    def add_expected(self, counts: np.ndarray, into: np.ndarray) -> None:
        """Add the expected numbers of pieces in ``counts`` segmentations of each word."""
        alpha = self.forward()
        beta = np.full_like(alpha, NOTHING)
        beta[-1] = 0.0
        weights = [None] * len(self.edges)
        for k in range(len(self.edges) - 1, -1, -1):
            start, end, rows, ids, logs = self.edges[k]
            after = logs + beta[end, rows]
            beta[start, rows] = np.logaddexp(beta[start, rows], after)
            weights[k] = np.exp(alpha[start, rows] + after - alpha[-1, rows]) * counts[rows]
            if ids is not None:
                into += np.bincount(ids, weights[k], len(into))
        for k, which, spellings in self.spelled:
            for weight, ids in zip(np.bincount(which, weights[k], len(spellings)), spellings):
                np.add.at(into, ids, weight)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Words of equal length with their places."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        yield places, [words[i] for i in places]


def word_log_probabilities(words: list[str], pieces: Pieces) -> np.ndarray:
    out = np.zeros(len(words))
    for places, group in by_length(words):
        out[places] = Lattice(group, pieces).forward()[-1]
    return out


def tokens(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []  # bytes: A-Z and the six ASCII blanks alone


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, occurrences in training texts) of each batch; words of other texts with 0."""
    for batch in batches:
        counts: Counter[bytes] = Counter()
        others: set[bytes] = set()
        for text, training in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            counts.update(tokens(text)) if training else others.update(tokens(text))
        words = [*counts, *(others - counts.keys())]
        numbers = [*counts.values(), *[0] * (len(words) - len(counts))]
        yield pa.record_batch([pa.array(words, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())], ["word", "c"])


class Model:
    """What learning leaves: the word table's place, the pieces, and the sums."""

    def __init__(self, words: DataFrame, pieces: dict[str, float], total: int, distinct: int, texts: int, end: float):
        self.words, self.pieces, self.total, self.distinct, self.texts, self.end = words, pieces, total, distinct, texts, end


def learn(docs: DataFrame, training: Column, *, text: str = "text", vocabulary: str, scores: str = "rank", rounds: int = 1) -> Model:
    """Count the words of all texts and fit the pieces to those of training texts. Writes scratch tables."""
    spark = docs.sparkSession
    prior = load_pieces(vocabulary, scores)
    rows = docs.select(column(text).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    texts = rows.agg(F.count_if("training")).first()[0]
    counted = rows.mapInArrow(_word_counts, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))
    counted = materialize(counted, "word-counts")
    n, v = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    pieces, used = prior, 0.0
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(pieces)

        def expect(batches, shared=shared):
            known = Pieces(shared.value)
            found = np.zeros(len(known.names))
            for batch in batches:
                counts = batch.column(1).to_numpy()
                for places, words in by_length(batch.column(0).to_pylist()):
                    Lattice(words, known).add_expected(counts[places], found)
            yield pa.record_batch([pa.array(known.names, pa.string()), pa.array(found)], ["piece", "n"])

        sums = counted.where("c > 0").mapInArrow(expect, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        found = {r.piece: r.n for r in sums.collect()}  # at most one row a piece
        used = sum(found.values())
        pieces = {p: math.log(found.get(p, 0.0) + PRIOR * math.exp(weight)) for p, weight in prior.items()}
        pieces = normalised(pieces)
    end = (texts + 1) / (texts + 1 + max(used, 1.0))
    inner = math.log1p(-end)
    pieces = {p: weight + inner for p, weight in pieces.items()}
    shared = spark.sparkContext.broadcast(pieces)

    def measure(batches):
        known = Pieces(shared.value)
        for batch in batches:
            logs = word_log_probabilities(batch.column(0).to_pylist(), known) / LN10
            yield pa.record_batch([*batch.columns, pa.array(logs)], ["word", "c", "lp"])

    words = materialize(counted.mapInArrow(measure, "word string, c bigint, lp double"), "word-scores")
    return Model(words, pieces, n + texts, v + (texts > 0), texts, math.log10(end))


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    short = model.words.where((F.col("c") > 0) & (F.octet_length("word") <= FREQUENT_BYTES))
    frequent = short.orderBy(F.desc("c"), "word").limit(FREQUENT).collect()  # bounded in rows and in their size
    shared = docs.sparkSession.sparkContext.broadcast({r.word.encode(): (math.log10(r.c + 1), r.lp) for r in frequent})

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row with what is known of each text, and one for each of its other words."""
        known = shared.value
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = tokens(value)
                n, base, lp, others = 0, 0.0, 0.0, {}
                for word in words:
                    found = known.get(word)
                    if found:
                        n += 1
                        base += found[0]
                        lp += found[1]
                    else:
                        others[word] = others.get(word, 0) + 1
                for cell, values in zip((row, b" %d" % row, len(words), n, base, lp), rows):
                    values.append(cell)
                for word, times in others.items():
                    for cell, values in zip((row, word, times, 0, 0.0, 0.0), rows):
                        values.append(cell)
                if len(rows[0]) > 100_000:
                    yield _look_up_batch(rows)
                    rows = [[] for _ in range(6)]
            yield _look_up_batch(rows)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), column(doc_id).alias("id"), column(text).alias("text"))
    looked = numbered.select("row", "text").mapInArrow(look_up, "row bigint, word string, n bigint, known bigint, base double, lp double")
    table = model.words.select(F.col("word").alias("w"), "c", F.col("lp").alias("word_lp"))
    joined = looked.join(table, F.col("word") == F.col("w"), "left")
    # A row whose word starts with a blank stands for its text; every other word is in the table.
    own = F.col("word").startswith(" ")
    sums = joined.groupBy("row").agg(
        F.sum(F.when(own, F.col("n"))).alias("n_words"),
        F.sum(F.when(own, F.col("known")).when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.when(own, F.col("base")).otherwise(F.col("n") * F.log10(F.col("c") + 1.0))).alias("base"),
        F.sum(F.when(own, F.col("lp")).otherwise(F.col("n") * F.col("word_lp"))).alias("lp"),
    )
    n_tokens = F.col("n_words") + 1
    per_token = math.log10(model.total + model.distinct + 1)
    return numbered.select("row", "id").join(sums, "row").select(
        F.col("id").alias(doc_id),
        n_tokens.alias("n_tokens"),
        (F.col("n_known") + int(model.texts > 0)).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + math.log10(model.texts + 1) - n_tokens * per_token).alias("base_score"),
        (F.col("lp") + model.end).alias("score"),
    )


def _look_up_batch(rows: list[list]) -> pa.RecordBatch:
    row, word, n, known, base, lp = rows
    return pa.record_batch(
        [pa.array(row, pa.int64()), pa.array(word, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
         pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(lp, pa.float64())],
        ["row", "word", "n", "known", "base", "lp"],
    )
