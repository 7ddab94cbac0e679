"""Byte-level BPE as a streaming transducer, and back to text by an incremental state machine.

A merge list fixes how far ahead of a place the text can still change whether a token ends
there. Merging two tokens ``p q`` depends on what follows only if the end of ``q`` is merged
away before, by an earlier merge whose left part is the last token of ``q`` at that time; and
that merge depends on what follows it in the same way. The longest such chain, found in one
pass over the list, is the ``lookahead``, in bytes. So the transducer holds a window of a few
lookaheads, encodes it, emits the tokens that end more than a lookahead before its end, and
goes on from there: it needs constant memory, and time in proportion to the text, also within
a word of any length. Short words, met for the first time among the texts at hand, are encoded
in step with each other, a merge at a time, as rows of one array per length; they are
remembered, at most twice ``REMEMBERED`` at a time.

The decoder turns token ids into bytes and bytes into text as they come; a character may
span tokens, and bytes that are no UTF-8 become U+FFFD, one for each longest valid beginning.

The vocabulary is read on the driver and broadcast (a bounded file, some 50,000 entries; its
size is checked against ``MOST_MERGES``); what a worker remembers serves all its tasks. There is no shuffle: rows stay where they are.

Defined cases: null texts are empty and have no tokens; added tokens that stand in a text are
encoded as such; text that is no UTF-8 is read with U+FFFD; unknown and null ids decode to
nothing; null ids decode to the empty text. Other columns stay, whatever their names.
"""

from __future__ import annotations

import codecs
import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from .common import column, new_name, per_text

REMEMBERED = 100_000
#: Bytes of the longest words that are encoded together and remembered; longer ones pass the transducer each time they are met.
SHORT = 48
#: Words encoded in step at a time.
IN_STEP = 20_000
MOST_MERGES = 1_000_000
#: A merge is one number: its rank, then in ``MADE`` the token that it makes; two tokens that don't merge have the largest.
MADE = (1 << 30) - 1
NEVER = 1 << 62
#: Ids decoded at a time.
IDS_AT_ONCE = 65_536

# Letters and numbers of Unicode 17, which the tokenizer's tables (Unicode 16) know as neither.
NO_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 "
    "1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NO_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def _without(kind: str, ranges: str) -> str:
    gone = "".join("-".join(f"\\U{int(end, 16):08x}" for end in part.split("-")) for part in ranges.split())
    return rf"[\p{{{kind}}}--[{gone}]]"


LETTER, NUMBER = _without("L", NO_LETTERS), _without("N", NO_NUMBERS)
#: Fixed pattern: how byte-level BPE splits text into words.
WORDS = rf"(?V1)'(?:[stmd]|re|ve|ll)| ?{LETTER}+| ?{NUMBER}+| ?[^\s{LETTER}{NUMBER}]+|\s+(?!\S)|\s+"


#: Characters from here on are rare, and slow for classes that list what they hold.
BEYOND = 0x10000


def _listed(name: str) -> str:
    """A class as the list of its ranges below ``BEYOND``."""
    members = regex.compile(f"(?V1){name}")
    ranges: list[list[int]] = []
    for code in range(BEYOND):
        if not 0xD800 <= code < 0xE000 and members.match(chr(code)):
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"\\u{first:04x}-\\u{last:04x}" for first, last in ranges)


def listed_words() -> str:
    """``WORDS`` for texts without characters from ``BEYOND`` on, for the standard library, which is some five times as fast."""
    letter, number, blank = (_listed(name) for name in (LETTER, NUMBER, r"\s"))
    return rf" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^{blank}{letter}{number}]+|[{blank}]+(?![^{blank}])|[{blank}]+"


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(byte): byte for byte in shown} | {chr(256 + at): byte for at, byte in enumerate(hidden)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """How many bytes behind a place can still decide whether it is a token boundary.

    ``merges`` by rank. Every merge must make a token that no other one makes, of parts that
    are bytes or made before.
    """
    made: dict[bytes, int] = {bytes([byte]): -1 for byte in range(256)}
    right: dict[bytes, bytes] = {}
    #: Of each left part the merges so far: ranks, and the furthest reach of the merges up to each.
    ranks: dict[bytes, list[int]] = {}
    reach: dict[bytes, list[int]] = {}
    longest = 0
    for rank, (p, q) in enumerate(merges):
        if p not in made or q not in made or p + q in made:
            raise ValueError(f"merge {rank} is not proper: {p!r} {q!r}")
        beyond, last, until = 0, q, rank
        while True:  # last tokens of q, from q itself down to its last byte: each until it is merged
            before = bisect_left(ranks.get(last, ()), until)
            if before:
                beyond = max(beyond, reach[last][before - 1])
            if last not in right:
                break
            until, last = made[last], right[last]
        far = len(q) + beyond
        ranks.setdefault(p, []).append(rank)
        reach.setdefault(p, []).append(max(far, reach[p][-1] if reach.get(p) else 0))
        made[p + q], right[p + q] = rank, q
        longest = max(longest, far)
    return longest


@dataclass(frozen=True)
class Vocabulary:
    """``merges`` by rank, the id of every byte sequence, and tokens that are no merges (``added``)."""

    merges: list[tuple[bytes, bytes]]
    ids: dict[bytes, int]
    added: dict[str, int]

    @cached_property
    def words(self) -> str:
        return listed_words()

    @cached_property
    def lookahead(self) -> int:
        return sufficient_lookahead(self.merges)

    @cached_property
    def ranks(self) -> dict[tuple[int, int], int]:
        """Rank and made token, in one number, of each two neighbouring tokens that merge."""
        return {(self.ids[p], self.ids[q]): rank * (MADE + 1) + self.ids[p + q] for rank, (p, q) in enumerate(self.merges)}

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """``ranks`` as arrays: pairs, packed and sorted, and the merge of each."""
        packed = sorted(((a << 32) + b, merge) for (a, b), merge in self.ranks.items())
        return np.array([pair for pair, _ in packed], np.int64), np.array([merge for _, merge in packed], np.int64)

    @cached_property
    def encoder(self) -> Encoder:
        """One for all tasks of a worker, with the words that it remembers."""
        return Encoder(self)

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        return {i: b for b, i in self.ids.items()} | {i: text.encode() for text, i in self.added.items()}


def load(path: str) -> Vocabulary:
    """The vocabulary in a tokenizer file with a byte-level BPE model."""
    with open(path, encoding="utf-8") as file:
        kept = json.load(file)
    model, split = kept["model"], kept["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    changed = kept.get("normalizer") or any(model.get(option) for option in options)
    if model["type"] != "BPE" or not plain or changed:
        raise ValueError(f"not a plain byte-level BPE: {path}")
    if len(model["merges"]) > MOST_MERGES:
        raise ValueError(f"more than {MOST_MERGES} merges")
    added = {token["content"]: token["id"] for token in kept["added_tokens"]}
    if any(token[flag] for token in kept["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that take blanks or words with them")
    byte = byte_characters()
    raw = lambda token: bytes(byte[character] for character in token)
    pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
    return Vocabulary([(raw(p), raw(q)) for p, q in pairs], {raw(t): i for t, i in model["vocab"].items() if t not in added}, added)


class Transducer:
    """Bytes of one word in, token ids out as soon as no later byte can change them."""

    def __init__(self, vocabulary: Vocabulary):
        self.ranks, self.bytes_of = vocabulary.ranks, vocabulary.bytes_of
        self.byte_ids = [vocabulary.ids[bytes([byte])] for byte in range(256)]
        self.lookahead = vocabulary.lookahead
        self.window = 4 * max(1, self.lookahead)
        self.held = b""

    def merged(self, text: bytes) -> list[int]:
        """The tokens of ``text`` as a word of its own."""
        tokens, ranks = [self.byte_ids[byte] for byte in text], self.ranks
        pairs = [ranks.get(pair, NEVER) for pair in zip(tokens, tokens[1:])]
        while pairs:
            best = min(pairs)
            if best == NEVER:
                break
            at = pairs.index(best)  # the leftmost of equal ones goes first
            made = tokens[at] = best & MADE
            del tokens[at + 1], pairs[at]
            if at:
                pairs[at - 1] = ranks.get((tokens[at - 1], made), NEVER)
            if at < len(pairs):
                pairs[at] = ranks.get((made, tokens[at + 1]), NEVER)
        return tokens

    def feed(self, part: bytes) -> Iterator[int]:
        """Tokens that ``part`` makes certain."""
        for start in range(0, len(part), self.window):
            self.held += part[start : start + self.window]
            certain, end = len(self.held) - self.lookahead, 0
            if certain < self.lookahead:
                continue
            for token in self.merged(self.held):
                if end + len(self.bytes_of[token]) > certain:
                    break
                end += len(self.bytes_of[token])
                yield token
            self.held = self.held[end:]

    def finish(self) -> list[int]:
        """The other tokens; the next byte starts a new word."""
        rest, self.held = self.merged(self.held), b""
        return rest


class InStep:
    """Many short words at once: a row of tokens each, and in every step each row's merge of lowest rank, leftmost first."""

    def __init__(self, vocabulary: Vocabulary):
        self.pairs, self.merges = vocabulary.pairs
        self.byte_ids = np.array([vocabulary.ids[bytes([byte])] for byte in range(256)], np.int64)
        self.of_bytes = self.merges_of(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))

    def merges_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(left.shape, NEVER)
        wanted = (left << 32) + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.merges[at], NEVER)

    def encode(self, words: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """(place in ``words``, packed token ids) of each; words have one length."""
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        tokens = self.byte_ids[raw]
        merges = self.of_bytes[raw[:, :-1].astype(np.int64) * 256 + raw[:, 1:]]
        rows = np.arange(len(words))
        while len(rows):
            if merges.shape[1]:
                at = merges.argmin(axis=1)
                best = merges[np.arange(len(rows)), at]
                done = best == NEVER
            else:
                done = np.ones(len(rows), bool)
            if done.any():
                packed, size = tokens[done].astype("<i4").tobytes(), 4 * tokens.shape[1]
                yield from zip(rows[done].tolist(), [packed[at : at + size] for at in range(0, len(packed), size)])
                rows, tokens, merges = rows[~done], tokens[~done], merges[~done]
                if not len(rows):
                    return
                at, best = at[~done], best[~done]
            every, width = np.arange(len(rows)), tokens.shape[1] - 1
            tokens[every, at] = best & MADE
            stay = np.ones(tokens.shape, bool)
            stay[every, at + 1] = False  # without the second of the two
            tokens = tokens[stay].reshape(len(rows), width)
            merges = merges[stay[:, 1:]].reshape(len(rows), width - 1)
            left = np.flatnonzero(at > 0)
            merges[left, at[left] - 1] = self.merges_of(tokens[left, at[left] - 1], tokens[left, at[left]])
            right = np.flatnonzero(at < width - 1)
            merges[right, at[right]] = self.merges_of(tokens[right, at[right]], tokens[right, at[right] + 1])


class Encoder:
    """Token ids of texts, as arrays of 32-bit integers. Remembers the words met since it was last full."""

    def __init__(self, vocabulary: Vocabulary):
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.transducer, self.in_step = Transducer(vocabulary), InStep(vocabulary)
        self.words, self.all_words = re.compile(vocabulary.words), regex.compile(WORDS)
        self.beyond = re.compile(f"[\\U{BEYOND:08x}-\\U0010ffff]")
        self.added = vocabulary.added
        longest_first = sorted(vocabulary.added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None

    def split(self, text: str) -> list[str]:
        return (self.all_words if self.beyond.search(text) else self.words).findall(text)

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of all the words; long ones among them are not remembered."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older, found, new = self.known, self.older, {}, defaultdict(lambda: ([], []))
        for word in words.difference(known):  # of the dict itself: its keys as a set would all be gone through
            if (ids := older.get(word)) is not None:
                known[word] = ids
            elif len(raw := word.encode()) <= SHORT:
                words_at, raw_at = new[len(raw)]
                words_at.append(word)
                raw_at.append(raw)
            else:
                found[word] = np.array([*self.transducer.feed(raw), *self.transducer.finish()], "<i4").tobytes()
        for words_at, raw_at in new.values():
            for start in range(0, len(raw_at), IN_STEP):
                for at, ids in self.in_step.encode(raw_at[start : start + IN_STEP]):
                    known[words_at[start + at]] = ids
        return found

    def parts(self, text: str) -> list[list[str]]:
        """The words between added tokens; each of those is a list with None before it."""
        if not self.marks or not any(mark in text for mark in self.added):
            return [self.split(text)]
        pieces = self.marks.split(text)  # keeps what it splits at, at odd places
        return [[None, piece] if at % 2 else self.split(piece) for at, piece in enumerate(pieces)]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.parts(text) for text in texts]
        marked = lambda part: len(part) == 2 and part[0] is None
        long = self.learn(set().union(*(part for parts in split for part in parts if not marked(part))))
        known = self.known.__getitem__
        if long:
            known = lambda word, short=self.known: long.get(word) or short[word]
        out = []
        for parts in split:
            packed = [np.array([self.added[part[1]]], "<i4").tobytes() if marked(part) else b"".join(map(known, part)) for part in parts]
            out.append(np.frombuffer(b"".join(packed), "<i4"))
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


class Decoder:
    """Token ids in, text out as soon as its characters are whole."""

    def __init__(self, vocabulary: Vocabulary):
        bytes_of = vocabulary.bytes_of
        self.beyond = max(bytes_of, default=-1) + 1
        #: The bytes of every id, and none at the end, for null and unknown ones.
        self.table = pa.array([bytes_of.get(i, b"") for i in range(self.beyond + 1)], pa.large_binary())
        self.characters = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: pa.Array | list) -> str:
        given = pa.array(ids, pa.int64()) if isinstance(ids, list) else ids
        if not len(given):
            return ""
        places = (given.fill_null(-1) if given.null_count else given).to_numpy()
        if places.min() < 0 or places.max() >= self.beyond:
            places = np.where((places >= 0) & (places < self.beyond), places, self.beyond)
        _, offsets, data = self.table.take(pa.array(places)).buffers()
        end = int(np.frombuffer(offsets, "<i8")[len(places)])
        return self.characters.decode(data.slice(0, end).to_pybytes())

    def finish(self) -> str:
        rest = self.characters.decode(b"", True)
        self.characters.reset()
        return rest


def _shared(spark: SparkSession, vocabulary: Vocabulary):
    """The vocabulary in every executor; what follows from it is worked out once, here."""
    vocabulary.lookahead, vocabulary.pairs, vocabulary.bytes_of, vocabulary.words  # noqa: B018
    return spark.sparkContext.broadcast(vocabulary)


def encode(docs: DataFrame, vocabulary: Vocabulary, *, text: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as an array ``name``."""
    shared = _shared(docs.sparkSession, vocabulary)

    def run(batches: Iterator[list]) -> Iterator[list]:
        encoder = shared.value.encoder
        for texts in batches:
            yield encoder.encode_all([raw.decode("utf-8", "replace") if raw else "" for raw in texts])

    ids = per_text(run, "array<int>", pa.list_(pa.int32()))(column(text))
    return docs.withColumn(name, ids)


def decode(rows: DataFrame, vocabulary: Vocabulary, *, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of the token ids ``ids`` as ``name``."""
    shared = _shared(rows.sparkSession, vocabulary)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(shared.value)
        for batch in batches:
            out = []
            for at in range(len(batch)):
                values = batch[at].values
                parts = [values.slice(start, IDS_AT_ONCE) for start in range(0, len(values or ()), IDS_AT_ONCE)]
                out.append("".join([*map(decoder.feed, parts), decoder.finish()]))
            yield pa.array(out, pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return rows.withColumn(name, arrow_udf(run, returnType="string").asNondeterministic()(column(ids)))


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


def token_report(docs: DataFrame, vocabulary: Vocabulary, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, number of tokens, digest of the ids, digest of the text decoded from them."""
    ids = new_name(docs, "ids")
    back = new_name(docs, "decoded")
    done = decode(encode(docs.select(column(doc_id), column(text)), vocabulary, text=text, name=ids), vocabulary, ids=ids, name=back)
    return done.select(
        column(doc_id),
        F.size(ids).cast("bigint").alias("n_tokens"),
        ids_digest(F.col(ids)).alias("ids_sha256"),
        F.sha2(F.col(back), 256).alias("decoded_sha256"),
    )
