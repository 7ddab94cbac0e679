"""Spelling variants against a plain comparison of all pairs."""

import random
import re
import unicodedata
import zlib
from collections import Counter

import pytest
from rows import clashing, documents

from hitlake.llm import variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_counts(rows, min_chars=6, min_count=5, one_in=199):
    counts = Counter()
    lower = {code: code + 32 for code in range(65, 91)}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= min_chars and n >= min_count}


def plain_groups(counts, ratio=5):
    found, out = {}, set()
    for word, n in counts.items():
        near = [other for other in counts if one_edit(word, other)]
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        found[word] = (len(near), best if best and counts[best] >= ratio * n else None)
    for word, (n_near, form) in found.items():
        root = word
        while found[root][1]:
            root = found[root][1]
        out.add((word, form, root, counts[word], n_near, counts.get(form)))
    return out


def words(seed, size=300):
    draw = random.Random(seed)
    base = ["".join(draw.choices("abc\u00e9\u00df", k=draw.randint(1, 6))) for _ in range(size)]
    return {word: draw.choice([1, 2, 5, 7, 40, 41, 300, 9000]) for word in base}


@pytest.mark.parametrize("symbols", [None, 2, 3, 8])
def test_groups_equal_all_pairs(spark, symbols):
    counts = words(symbols or 0)
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = {tuple(row) for row in variants.group_variants(table, symbols=symbols).collect()}
    assert got == plain_groups(counts)
    assert any(form and root != form for _, form, root, *_ in got)


def test_pairs_are_met_once(spark):
    counts = words(11)
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    pairs = [frozenset((row.a, row.b)) for row in variants.near_pairs(table, 3).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((a, b)) for a in counts for b in counts if one_edit(a, b)}


def test_counts_equal_plain(spark, monkeypatch):
    monkeypatch.setattr(variants, "TEXTS_AT_ONCE", 2)
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("Abcd\u00c9\u00e9\u00f7\u0153", k=draw.randint(4, 9))) for _ in range(60)]
    rows = [(draw.choice([None, *range(40)]), draw.choice([" ", "1", "\u4e2d", "'"]).join(draw.choices(vocabulary, k=80)), None, None) for _ in range(120)]
    rows += [(500, None, None, None), (501, "", None, None), (502, "Zz" * 20_000, None, None), (503, unicodedata.normalize("NFD", "\u00e9" * 9), None, None)]
    docs = clashing(documents(spark).union(documents(spark, rows)))
    for one_in in (199, 3):
        got = {row.word: row.n for row in variants.count_words(docs, one_in=one_in).collect()}
        assert got == plain_counts([(row.doc_id, row.text) for row in docs.collect()], one_in=one_in)
    assert any(variants.slipped(word.encode(), zlib.crc32(b"1:"), 3) for word in got)


def test_empty(spark):
    docs = documents(spark).limit(0)
    assert variants.group_variants(variants.count_words(docs)).count() == 0


def test_null_words_are_none(spark):
    table = spark.createDataFrame([(None, 3), ("abcdef", 5)], "word string, n bigint")
    assert [tuple(row) for row in variants.group_variants(table).collect()] == [("abcdef", None, "abcdef", 5, 0, None)]
