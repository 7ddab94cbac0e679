import pytest
from rows import AWKWARD, clashing, documents, prose

from hitlake.llm import decontaminate as D

ITEMS = [
    ("long", " ".join(prose(1).split()[2:30]).upper()),
    ("short", "ünïcödé ﬁn"),
    ("same", " ".join(prose(1).split()[2:30])),
    ("none", "!!"),
    ("null", None),
    (None, prose(1)),
    ("absent", "these words stand nowhere"),
]


def plain(text, items, n=13):
    words, hit, found = D.words_of(None if text is None else text.encode()), set(), set()
    for item, other in items:
        for window in D.windows_of(D.words_of(None if other is None else other.encode()), n):
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at : at + len(window)]) == window and item is not None:
                    hit.update(range(at, at + len(window)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_against_plain_search(spark, limit):
    rows = [r for r in AWKWARD if r[0] != 8]
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    found = D.find_windows(clashing(documents(spark, rows)), items, broadcast_bytes=limit, name="x").collect()
    got = sorted((str(r.doc_id), r.x.n_words, r.x.n_hit, r.x["items"]) for r in found)
    assert got == sorted((str(r[0]), *plain(r[1], ITEMS)) for r in rows)
    assert all(sum(s.end - s.start for s in r.x.spans) == r.x.n_hit for r in found)


def test_remove(spark):
    items = spark.createDataFrame([("i", prose(1))], "item_id string, text string")
    docs = documents(spark)
    kept = D.decontaminate(clashing(docs), items)
    assert kept.columns == clashing(docs).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [4, 5, 6, 7, 8, 9, 10, 10, 11]
    cut = {r.doc_id: r.text for r in D.decontaminate(docs, items, remove="spans").collect()}
    assert not D.words_of(cut[1].encode()) and cut[3].endswith("one more.") and cut[4] is None and cut[9] == AWKWARD[8][1]


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id string, text string")
    assert D.decontaminate(documents(spark), items).count() == len(AWKWARD)
    assert D.decontaminate(documents(spark, []), items).count() == 0
    assert D.find_windows(documents(spark, []), items, broadcast_bytes=-1).count() == 0


def test_set_stays_within_its_bound():
    """What the set takes follows from the number of words: short ones, long ones, repeated ones."""
    for words in (["a"] * 5000, [f"w{i}" for i in range(20_000)], ["longish" + str(i % 7) for i in range(3000)]):
        found = D.WindowSet([("i", " ".join(words).encode())], 13)
        assert found.nbytes() <= D.BYTES_PER_WORD * len(words) + len(" ".join(words)) + 1024


def test_windows_that_many_items_share(spark):
    shared = " ".join(prose(5).split()[:20])
    items = spark.createDataFrame([(f"i{i}", shared) for i in range(40)], "item_id string, text string")
    docs = documents(spark, [(1, f"before {shared} after", None, None), (2, prose(6), None, None)])
    for limit in (1 << 20, 0):
        found = {r.doc_id: r.x for r in D.find_windows(docs, items, broadcast_bytes=limit, name="x").collect()}
        assert len(found[1]["items"]) == 40 and found[1].n_hit == len(D.words_of(shared.encode())) and found[2].n_hit == 0


def test_bloom_filter_holds_every_window(spark):
    rows = [(f"i{i}", prose(i, 30)) for i in range(60)]
    items = spark.createDataFrame([*rows, (None, "x y"), ("null", None)], "item string, text string").repartition(3)
    import numpy as np

    for bits in (1 << 10, 1 << 17, 1 << 20):
        filled = D.bloom_filter(items, 13, bits)
        assert filled.nbytes == bits // 8
        for _, text in rows:
            words = D.words_of(text.encode())
            hashes = D.window_hashes(D.word_hashes(words), np.arange(len(words) - 12), 13)
            assert D.passes(filled, hashes).all()
    others = D.word_hashes([f"{i}".encode() for i in range(5000)])
    assert D.passes(filled, others).mean() < 0.05
