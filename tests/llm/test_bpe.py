"""Byte-level BPE against the tokenizers library, and the lookahead against whole encodings of random merge lists."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from rows import clashing, documents
from tokenizers import Tokenizer

from hitlake.llm import bpe
from hitlake.llm.queries import op13_bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(FILE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_query_equals_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {tuple(row) for row in op13_bpe(spark, sf_dir).collect()}
    assert got == {(row.doc_id, *expected(library, row.text)) for row in docs}


def test_awkward_rows(spark, vocabulary, library):
    special = [(20, "a <|endoftext|>  <|endoftext|>b <|endof", "en", "a"), (21, "they're I'LL 'd \u2028 \x85\t\n  x", None, "a"), (22, " " * 5000 + "=" * 7001, None, None)]
    docs = clashing(documents(spark).union(documents(spark, special)))
    rows = docs.collect()
    got = sorted(map(tuple, bpe.token_report(docs, vocabulary).collect()), key=str)
    assert got == sorted([(row.doc_id, *expected(library, row.text)) for row in rows], key=str)
    kept = bpe.encode(docs, vocabulary, name="tokens")
    assert kept.columns == [*docs.columns, "tokens"] and kept.count() == docs.count()
    assert bpe.token_report(docs.limit(0), vocabulary).count() == 0


def test_unknown_and_null_ids_decode_to_nothing(spark, vocabulary):
    rows = spark.createDataFrame([([15496, None, 99_999_999, 995],), ([],), (None,)], "ids array<int>")
    assert [row.decoded for row in bpe.decode(rows, vocabulary).collect()] == ["Hello world", "", ""]


def test_every_character_splits_as_in_the_library(library, vocabulary):
    encoder = bpe.Encoder(vocabulary)
    for start in range(0, 0x110000, 64):
        for code in range(start, start + 64, 7 if start > 0x3000 else 1):
            if not 0xD800 <= code < 0xE000:
                for text in (f"a{chr(code)}1{chr(code)}! {chr(code)}", f"a{chr(code)}  {chr(code)}'s \U0001f389"):
                    pieces = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
                    assert encoder.split(text) == pieces


def test_random_strings(library, vocabulary):
    draw = random.Random(5)
    parts = ["x", "aa", " ", "  ", "\n", "=", "-", "'re", "'r", "s", "\u00e9", "\u65e5", "\U0001f389", "\u0558", "\x85", "<|endoftext|>", "1", "ing", "\u00c3\u00c2"]
    encoder, decoder = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)
    for at in range(1500):
        text = "".join(draw.choices(draw.sample(parts, draw.randint(1, 6)), k=draw.randint(0, 3000 if at % 100 == 0 else 40)))
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        ids = [draw.randrange(50_300) for _ in range(draw.randint(0, 20))]
        cut = draw.randint(0, len(ids))
        assert decoder.feed(ids[:cut]) + decoder.feed(ids[cut:]) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


def plain(text: bytes, merges) -> list[bytes]:
    """BPE as defined: the merge of lowest rank that applies anywhere, leftmost first, again and again."""
    parts = [bytes([byte]) for byte in text]
    while True:
        found = [(merges.index(pair), at) for at, pair in enumerate(zip(parts, parts[1:])) if pair in merges]
        if not found:
            return parts
        at = min(found)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def random_merges(draw, letters, size):
    tokens, merges = [bytes([letter]) for letter in letters], []
    for _ in range(size):
        pair = (draw.choice(tokens), draw.choice(tokens))
        if pair[0] + pair[1] not in tokens:
            merges.append(pair)
            tokens.append(pair[0] + pair[1])
    return merges


@pytest.mark.parametrize("seed", range(60))
def test_lookahead_suffices(seed):
    draw = random.Random(seed)
    merges = random_merges(draw, b"ab" if seed % 2 else b"abc", draw.randint(1, 12))
    lookahead = bpe.sufficient_lookahead(merges) if merges else 0
    for _ in range(20):
        text = bytes(draw.choices(b"abc", k=draw.randint(0, 60)))
        whole, ends, place = plain(text, merges), set(), 0
        for token in whole:
            place += len(token)
            ends.add(place)
        for cut in range(len(text)):  # boundaries a lookahead before the cut are those of the whole text
            place, seen = 0, {0}
            for token in plain(text[:cut], merges):
                place += len(token)
                seen.add(place)
            assert all((at in seen) == (at in ends or at == 0) for at in range(cut - lookahead + 1))


@pytest.mark.parametrize("seed", range(30))
def test_transducer_equals_whole_encoding(seed):
    draw = random.Random(seed)
    merges = random_merges(draw, b"abc", draw.randint(1, 14))
    ids = {bytes([byte]): byte for byte in range(256)} | {p + q: 256 + at for at, (p, q) in enumerate(merges)}
    transducer = bpe.Transducer(bpe.Vocabulary(merges, ids, {}))
    for _ in range(10):
        text = bytes(draw.choices(b"abc", k=draw.randint(0, 400)))
        parts, at = [], 0
        while at < len(text):
            step = draw.randint(1, 50)
            parts.extend(transducer.feed(text[at : at + step]))
            assert len(transducer.held) <= transducer.window + 2 * transducer.lookahead + max(map(len, ids))
            at += step
        assert [*parts, *transducer.finish()] == [ids[token] for token in plain(text, merges)]


def test_improper_merges_are_refused():
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(b"ab", b"c")])
    with pytest.raises(ValueError):
        bpe.sufficient_lookahead([(b"a", b"b"), (b"ab", b"c"), (b"b", b"c"), (b"a", b"bc")])


def test_decoder_takes_arrays_with_null_and_unknown_ids(vocabulary):
    decoder, ids = bpe.Decoder(vocabulary), bpe.Encoder(vocabulary).encode("Zoë \U0001f600 ends")
    assert decoder.feed(pa.array(ids)[:2]) + decoder.feed(pa.array(ids)[2:]) + decoder.finish() == "Zoë \U0001f600 ends"
    odd = [None, -1, 1 << 30, *ids.tolist(), None, max(vocabulary.bytes_of) + 1]
    assert decoder.feed(pa.array(odd, pa.int32())) + decoder.finish() == "Zoë \U0001f600 ends" == decoder.feed(odd) + decoder.finish()
    assert decoder.feed(pa.array([], pa.int32())) == decoder.feed([None]) == decoder.finish() == ""
