import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, clashing, documents, prose

from hitlake.llm import toxicity as T
from hitlake.llm.common import held_out


def scored(spark, counterfactual):
    """Toxic texts all name one group; nothing else does."""
    rows = [(i, f"{prose(i, 3)} the muslims are grotty {prose(1000 + i, 2)}", "en", "a") for i in range(60)]
    rows += [(100 + i, prose(2000 + i, 5), "en", "a") for i in range(120)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(r[0], int(r[0] < 100)) for r in rows], "doc_id bigint, toxic int")
    model = T.train(docs, labels, F.lit(True), counterfactual=counterfactual)
    new = [(1, "the muslims here", "en", "a"), (2, "the grotty grotty here", "en", "a"), (3, "the jews here", "en", "a")]
    return {r.doc_id: r.score for r in T.add_scores(documents(spark, new), model).collect()}, model


def test_neutral_mentions_are_no_false_positives(spark):
    plain, _ = scored(spark, 0.0)
    fair, (weights, _) = scored(spark, 30.0)
    assert fair[1] < plain[1] - 0.1 and abs(fair[1] - fair[3]) < abs(plain[1] - plain[3]) / 3
    assert fair[2] > 0.5 and weights["grotty"] > 0


KINDS = {"en": (("women", "men", "girls"), ("old", "young")), "fr": (("vieux", "jeunes"), ("men", "femmes"))}


def swapped_features(sentence, partners):
    """Features of a sentence's distinct words before and after each swap, made on the words themselves."""
    words = T.WORD.findall(sentence.lower())
    for term in sorted({w for w in words if w in partners}):
        for other in partners[term]:
            after = [other if w == term else w for w in words]
            yield [Counter(f for w in set(side) for f in T.features_of(w)) for side in (words, after)]


@pytest.mark.parametrize("sentence", ["Women sing, young women!", "old men and women", "nothing named", "Men, femmes; men", "", "vieux"])
def test_swaps_change_what_swapped_words_change(sentence):
    partners = T.partners_of(KINDS)
    got = [T.change_of(swap) for swap in sorted(T.swaps_in(sentence, partners, False))]
    expected = []
    for before, after in swapped_features(sentence, partners):
        before.subtract(after)
        expected.append(before)
    assert [{f: n for f, n in c.items() if n} for c in got] == [{f: n for f, n in c.items() if n} for c in expected]


def test_neutral_sentences_get_a_term():
    partners = T.partners_of(KINDS)
    assert T.partners_of(KINDS)["men"] == ["femmes", "girls", "women"]
    terms = {term for i in range(200) for term, _, _ in T.swaps_in(f"sentence {i} here", partners, True)}
    assert terms == set(partners)
    assert T.swaps_in("12 !", partners, True) == [] and T.swaps_in("plain words", partners, False) == []


def test_every_sentence_counts(spark):
    """A term that only long sentences of the last documents name is drawn to its partners, too."""
    long = lambda i: " ".join(f"{w}" for w in prose(i, 40).replace(".", "").split()[:90])
    rows = [(i, f"{long(i)} the sikhs are grotty.", "en", "a") for i in range(400, 460)]
    rows += [(i, " ".join(f"Women {w}." for w in prose(i, 6).replace(".", "").split()), "en", "a") for i in range(300)]
    labels = spark.createDataFrame([(r[0], int(r[0] >= 400)) for r in rows], "doc_id bigint, toxic int")
    new = documents(spark, [(1, "the sikhs here", "en", "a"), (2, "the hindus here", "en", "a")])
    gaps = []
    for strength in (0.0, 3_000.0):
        model = T.train(documents(spark, rows), labels, F.lit(True), counterfactual=strength)
        score = {r.doc_id: r.score for r in T.add_scores(new, model).collect()}
        gaps.append(abs(score[1] - score[2]))
    assert gaps[1] < gaps[0] / 3


def test_scores_equal_plain_ones(spark):
    """Distinct lower-cased words, each with its prefixes of three to six letters."""
    draw = np.random.default_rng(1)
    names = {f for _, text, *_ in AWKWARD for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for f in (w, w[:3] + "*", w[:4] + "*", w[:6] + "*")}
    weights = {f: float(draw.normal()) for f in sorted(names)}
    got = {(r.doc_id, r.text): r.score for r in T.add_scores(documents(spark), (weights, -0.5)).collect()}
    for doc_id, text, *_ in AWKWARD:
        total = -0.5
        for word in set(re.findall(r"[^\W\d_]+", (text or "").lower())):
            total += weights.get(word, 0.0) + sum(weights.get(word[:n] + "*", 0.0) for n in (3, 4, 5, 6) if len(word) >= n)
        assert got[doc_id, text] == pytest.approx(1 / (1 + math.exp(-min(max(total, -30), 30))), abs=1e-9)


def test_gradient_reaches_the_minimum():
    rows = [np.array([0, 1]), np.array([1]), np.array([0]), np.array([2])]
    y = np.array([1.0, 0, 1, 0])
    weight, intercept = T.fit(rows, y, [(np.array([0, 2]), np.array([1.0, -1.0]))], 3, 0.05, 0.5, steps=4000)

    def loss(p):
        z = np.array([p[r].sum() for r in rows]) + p[3]
        return np.mean(np.logaddexp(0, z) - y * z) + 0.025 * (p[:3] ** 2).sum() + 0.5 * (p[0] - p[2]) ** 2

    best = np.append(weight, intercept)
    assert all(loss(best + d) >= loss(best) - 1e-5 for d in 0.02 * np.vstack([np.eye(4), -np.eye(4)]))


def test_held_out_quality(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    out = held_out(F.col("doc_id"), 4)
    rows = T.add_scores(docs, T.train(docs, labels, ~out)).where(out).join(labels, "doc_id").select("toxic", "score").collect()
    toxic = [r.score >= 0.3 for r in rows if r.toxic]
    clean = [r.score >= 0.3 for r in rows if not r.toxic]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (None, 1), (2, None), (77, 1)]])
def test_one_sided_labels(spark, labels):
    docs = clashing(documents(spark))
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    rows = T.add_scores(docs, T.train(docs, table, F.lit(True)), name="s").collect()
    assert len(rows) == len(AWKWARD) and len({r.s for r in rows}) == 1 and 0 <= rows[0].s <= 1


def test_awkward_rows(spark):
    docs = clashing(documents(spark))
    labels = spark.createDataFrame([(1, 1), (1, 0), (8, 0), (5, 0), (4, 1), (10, 0)], "doc_id bigint, toxic int")
    scored = T.add_scores(docs, T.train(docs, labels, F.lit(True), least=1), name="s")
    assert scored.columns == [*docs.columns, "s"] and all(0 <= r.s <= 1 for r in scored.collect())
    assert T.add_scores(documents(spark, []), T.train(documents(spark, []), labels, F.lit(True))).count() == 0
