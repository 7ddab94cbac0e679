import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, clashing, documents

from hitlake.llm import lattice as L
from hitlake.llm.common import held_out
from hitlake.llm.queries import VOCABULARY


def segmentations(text, pieces):
    """All ways to write ``text``, as (log probability, pieces)."""
    if not text:
        yield 0.0, []
        return
    for end in range(1, len(text) + 1):
        options = []
        if text[:end] in pieces:
            options.append((pieces[text[:end]], [text[:end]]))
        if end == 1 and text[0] not in pieces:
            spelled = [f"<0x{b:02X}>" for b in text[0].encode()]
            options.append((sum(pieces.get(b, L.NO_BYTE) for b in spelled), [b for b in spelled if b in pieces]))
        for log, used in options:
            for rest, more in segmentations(text[end:], pieces):
                yield log + rest, used + more


@pytest.fixture(scope="module")
def vocabulary():
    return L.load_pieces(VOCABULARY)


def test_forward_sums_all_segmentations(vocabulary):
    words = ["the", "station", "x", "日本語", "à🎉b", "ingthe", "reading"]
    got = L.word_log_probabilities(words, L.Pieces(vocabulary))
    for word, log in zip(words, got):
        every = [x for x, _ in segmentations(L.START + word, vocabulary)]
        assert math.isclose(log, math.log(sum(map(math.exp, every))), rel_tol=1e-9) and len(every) >= 1


def test_expected_counts(vocabulary):
    words, counts = ["the", "on日", "reread"], np.array([2.0, 1.0, 3.0])
    pieces = L.Pieces(vocabulary)
    got = np.zeros(len(pieces.names))
    for places, group in L.by_length(words):
        L.Lattice(group, pieces).add_expected(counts[places], got)
    wanted = Counter()
    for word, times in zip(words, counts):
        every = [(math.exp(x), used) for x, used in segmentations(L.START + word, vocabulary)]
        for p, used in every:
            for piece in used:
                wanted[piece] += times * p / sum(x for x, _ in every)
    assert {n: round(c, 9) for n, c in zip(pieces.names, got) if c > 1e-12} == {n: round(c, 9) for n, c in wanted.items() if c > 1e-12}


def test_pieces_are_a_distribution(vocabulary):
    assert math.isclose(sum(map(math.exp, vocabulary.values())), 1) and vocabulary["▁the"] > vocabulary["▁Sub"]


@pytest.mark.parametrize("frequent", [5, L.FREQUENT])
def test_against_plain_version(spark, monkeypatch, frequent):
    monkeypatch.setattr(L, "FREQUENT", frequent)
    docs = clashing(documents(spark))
    out = held_out(F.col("doc_id"), 7)
    model = L.learn(docs, ~out, vocabulary=VOCABULARY)
    held = {r.doc_id: r.out for r in docs.select("doc_id", out.alias("out")).collect()}
    texts = [[w.decode() for w in L.tokens(t and t.encode())] for _, t, *_ in AWKWARD]
    counts = Counter(w for r, ws in zip(AWKWARD, texts) if not held[r[0]] for w in ws)
    ends = sum(not held[r[0]] for r in AWKWARD)
    n, v = sum(counts.values()) + ends, len(counts) + 1
    words = sorted({w for ws in texts for w in ws})
    logs = dict(zip(words, L.word_log_probabilities(words, L.Pieces(model.pieces)) / math.log(10)))
    wanted = []
    for r, ws in zip(AWKWARD, texts):
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*[counts[w] for w in ws], ends])
        wanted.append((str(r[0]), len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, n, round(base, 6), round(sum(logs[w] for w in ws) + model.end, 6)))
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in L.score(docs, model).collect()]
    assert sorted(got) == sorted(wanted)
    assert math.isclose(sum(map(math.exp, model.pieces.values())) + 10**model.end, 1)


def test_learning_helps_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = held_out(F.col("doc_id"), 7)
    totals = [
        L.score(docs, L.learn(docs, ~out, vocabulary=VOCABULARY, rounds=rounds)).where(out).agg(F.sum("score")).first()[0]
        for rounds in (0, 1)
    ]
    assert totals[1] > 0.95 * totals[0]


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    rows = L.score(docs, L.learn(docs, F.lit(False), vocabulary=VOCABULARY)).collect()
    assert len(rows) == len(AWKWARD) and {(r.n_known, r.train_tokens) for r in rows} == {(0, 0)}
    none = documents(spark, [])
    assert L.score(none, L.learn(none, F.lit(True), vocabulary=VOCABULARY)).count() == 0
