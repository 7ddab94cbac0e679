"""Language identification with a string kernel, Nyström landmarks and ridge regression.

A text is its set of hashed character n-grams of 1 to ``ORDERS`` letters (blended spectrum,
presence only): k(x, y) = |G(x) ∩ G(y)| / sqrt(|G(x)| |G(y)|). A bounded sample of labelled
texts trains one ridge regressor per language against all others, in the span of landmark
texts L: alpha = (K_nL' K_nL + lambda n K_LL)^-1 K_nL' Y. A score K_xL alpha is
G(x) (L alpha) / sqrt(|G(x)|), so a batch of texts is scored as one product of its sparse
n-gram matrix with the (n-grams x languages) matrix L alpha, which every task has.

Bounds (parameters): ``per_language`` training texts, ``landmarks`` of them, and ``training``
texts over all languages; whole texts are used, and all texts are scored. The sample is the
texts whose ids have the smallest hashes; with more languages than ``training`` texts some are
never learned. What tasks get grows with the languages, not with the texts.

Defined cases: a null text and one without a letter is ``und`` with score 0, as is every
text where nothing is labelled; ties go to the language that sorts first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import column, per_text, sample_by_hash

ORDERS = 4
BITS = 17
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def presence(text: bytes | None, seen: np.ndarray) -> np.ndarray:
    """Sorted numbers of the n-grams of a text; none if it has no letter. ``seen`` is scratch, all false."""
    letters = NO_LETTERS.sub(" ", text.decode().lower()).strip() if text else ""
    if not any(map(str.isalpha, letters)):
        return np.zeros(0, np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    grams = np.zeros(len(codes) + 1, np.uint64)
    for order in range(ORDERS):
        grams = (grams[:-1] + codes[order:] + np.uint64(order + 1)) * MULTIPLIER
        seen[grams >> np.uint64(64 - BITS)] = True
        grams = grams ^ (grams >> np.uint64(29))
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def fit(grams: list[np.ndarray], labels: list[str], landmarks: list[bool], ridge: float) -> tuple[list[str], np.ndarray]:
    """Languages and the (n-grams x languages) matrix."""
    languages = sorted(set(labels))
    marks = [g for g, chosen in zip(grams, landmarks) if chosen]
    L = np.zeros((len(marks), 1 << BITS), np.float32)
    for row, found in zip(L, marks):
        row[found] = 1 / np.sqrt(len(found))
    K = np.stack([L[:, found].sum(axis=1, dtype=np.float64) / np.sqrt(len(found)) for found in grams])
    K_LL = np.stack([L[:, found].sum(axis=1, dtype=np.float64) / np.sqrt(len(found)) for found in marks])
    Y = np.array([[label == language for language in languages] for label in labels], np.float64)
    alpha = np.linalg.solve(K.T @ K + ridge * len(K) * K_LL + 1e-9 * np.eye(len(marks)), K.T @ Y)
    return languages, (L.T @ alpha.astype(np.float32)).astype(np.float32)


def scores(grams: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Sparse (texts x n-grams) times dense (n-grams x languages); every text has an n-gram."""
    sizes = np.array([len(g) for g in grams])
    products = weights[np.concatenate(grams)]
    return np.add.reduceat(products, np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None]


def training_texts(
    docs: DataFrame, labelled: Column, *, doc_id: str, text: str, lang: str,
    per_language: int, landmarks: int, training: int,
) -> list[tuple[np.ndarray, str, bool]]:
    """At most ``training`` (n-grams, language, whether a landmark), in a fixed order."""
    rows = docs.where(labelled & column(lang).isNotNull() & column(doc_id).isNotNull() & column(text).isNotNull())
    ids = sample_by_hash(rows.select(column(doc_id).alias("id"), column(lang).alias("key")), lambda _: per_language)
    places = {(r.id, r.key): r.rank for r in ids.orderBy("rank", "key").limit(training).collect()}
    if not places:
        return []

    def extract(batches):
        seen = np.zeros(1 << BITS, bool)
        for texts in batches:
            yield [presence(value, seen).astype(np.int32).tobytes() for value in texts]

    texts = rows.where(column(doc_id).isin([i for i, _ in places]))
    grams = per_text(extract, "binary", pa.binary())(column(text)).alias("grams")
    found = texts.select(column(doc_id).alias("id"), column(lang).alias("lang"), grams).collect()
    unique = {(r.id, r.lang): bytes(r.grams) for r in sorted(found, key=lambda r: (r.id, r.lang, bytes(r.grams))) if r.grams and (r.id, r.lang) in places}
    return [(np.frombuffer(grams, np.int32), key[1], places[key] <= landmarks) for key, grams in unique.items()]


def identify(
    docs: DataFrame,
    *,
    labelled: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 400,
    landmarks: int = 60,
    training: int = 4000,
    ridge: float = 1e-4,
    name: str = "language",
) -> DataFrame:
    """``docs`` with a struct ``name``: lang_pred and score (0 to 1). Learns from the rows where ``labelled`` holds.

    Runs three jobs: two find the sample's ids, one brings its n-grams to the driver.
    """
    sample = training_texts(
        docs, labelled, doc_id=doc_id, text=text, lang=lang, per_language=per_language, landmarks=landmarks, training=training
    )
    if any(chosen for *_, chosen in sample):
        model = fit(*map(list, zip(*sample)), ridge)
    else:
        model = [], np.zeros((1 << BITS, 0), np.float32)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[list]) -> Iterator[list]:
        languages, weights = shared.value
        seen = np.zeros(1 << BITS, bool)
        for texts in batches:
            out = [{"lang_pred": UNKNOWN, "score": 0.0}] * len(texts)
            for first in range(0, len(texts) if languages else 0, 256):
                grams = [presence(value, seen) for value in texts[first : first + 256]]
                full = [i for i, g in enumerate(grams) if len(g)]
                if full:
                    table = scores([grams[i] for i in full], weights)
                    for i, best, row in zip(full, table.argmax(axis=1), table):
                        out[first + i] = {"lang_pred": languages[best], "score": float(min(max(row[best], 0.0), 1.0))}
            yield out

    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
    return docs.withColumn(name, per_text(predict, "struct<lang_pred:string,score:double>", kind)(column(text)))


def keep_known(docs: DataFrame, found: str, least: float = 0.1) -> DataFrame:
    """``docs`` whose language is known with a score of at least ``least``."""
    return docs.where((F.col(found)["lang_pred"] != UNKNOWN) & (F.col(found)["score"] >= least)).drop(found)
