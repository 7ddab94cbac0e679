import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, clashing, documents

from hitlake.llm import language as L
from hitlake.llm.common import held_out


def plain_grams(text):
    """n-grams as strings, for a kernel without hashing."""
    letters = f" {L.NO_LETTERS.sub(' ', text.lower()).strip()} "
    return {letters[i : i + n] for n in range(1, L.ORDERS + 1) for i in range(len(letters) - n + 1)}


def test_presence_is_a_set_of_n_grams():
    seen = np.zeros(1 << L.BITS, bool)
    for text in ("Aber nein, aber ja!", "x", "日本語 text", "the the the"):
        assert 0.97 * len(plain_grams(text)) <= len(L.presence(text.encode(), seen)) <= len(plain_grams(text))
    assert not seen.any()
    for text in (None, "", " 12 !? \n"):
        assert len(L.presence(text and text.encode(), seen)) == 0


def test_matrix_product_is_the_kernel_machine():
    """Scores by the collapsed matrix are those of ridge regression written out with the kernel."""
    draw = np.random.default_rng(3)
    grams = [np.sort(draw.choice(1 << L.BITS, draw.integers(5, 60), replace=False)) for _ in range(30)]
    labels = [("en", "fr", "de")[i % 3] for i in range(30)]
    marks = [i < 12 for i in range(30)]
    languages, weights = L.fit(grams, labels, marks, 0.01)
    k = lambda a, b: len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b))
    K = np.array([[k(g, m) for m in grams[:12]] for g in grams])
    KLL = K[:12]
    Y = np.array([[label == x for x in languages] for label in labels], float)
    alpha = np.linalg.solve(K.T @ K + 0.01 * 30 * KLL + 1e-9 * np.eye(12), K.T @ Y)
    assert np.allclose(L.scores(grams, weights), K @ alpha, atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = held_out(F.col("doc_id"), 4)
    found = L.identify(docs, labelled=~out, name="x").where(out & (F.length("text") > 40))
    right = found.agg(F.avg((F.col("x.lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.98


def test_predictions_ignore_labels_of_scored_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = held_out(F.col("doc_id"), 4)
    changed = docs.withColumn("lang", F.when(out, F.lit("zz")).otherwise(F.col("lang")))
    one, two = (L.identify(d, labelled=~out, name="x").select("doc_id", "x").collect() for d in (docs, changed))
    assert sorted(one) == sorted(two)


@pytest.mark.parametrize("least", [0.0, 0.1])
def test_awkward_rows(spark, least):
    docs = clashing(documents(spark))
    found = L.identify(docs, labelled=F.lit(True), name="x")
    rows = {r.doc_id: r.x for r in found.collect()}
    assert all(rows[i] == ("und", 0.0) for i in (4, 5, 6, 11)) and rows[1].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert L.keep_known(found, "x", least).columns == docs.columns
    nothing = L.identify(docs, labelled=F.lit(False), name="x").collect()
    assert {r.x.lang_pred for r in nothing} == {"und"} and len(nothing) == len(AWKWARD)
    assert L.identify(documents(spark, []), labelled=F.lit(True)).count() == 0
