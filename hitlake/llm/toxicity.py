"""A toxicity classifier that is regularised by counterfactuals.

A text is the sum of its distinct words, a word the sum of its features: itself and its
prefixes. Logistic regression on a bounded sample of labelled texts gets two penalties: a ridge
on the weights, and ``counterfactual`` times the mean squared change of the score when identity
terms in labelled sentences are swapped for others of their group. Sentences that name a group
are used as they are; so that a corpus in which few do is covered too, neutral labelled
sentences that name none get a term in place of their first word, by their hash. The score of a
text then hardly depends on which group it names, and a term that the sample happens to show in
toxic texts does not make a neutral mention toxic.

What a swap changes follows from the two terms and from whether the other one stands in the
sentence already, so swaps are counted by these three: every sentence of the sample counts, of
any length, and no sentence leaves its task.

Bounds (parameters): ``toxic`` and ``neutral`` labelled texts, those with the smallest hashes
of their ids; ``features`` with the strongest association; ``kinds``, the terms, by language.
Every word of every text is scored. Feature counts and swaps combine in tasks and by shuffle; only
the selected features, the counts of swaps (some hundreds) and the sample's feature numbers come to the driver.

Defined cases: null and empty texts, and texts without a known word, get the intercept's
score; without labels of both kinds the score is the share of toxic labels (0 without any);
several labels of one document count as toxic if one of them is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import column, per_text, sample_by_hash

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
PREFIXES = (3, 4, 5, 6)
CACHED_WORDS = 300_000

# Terms that name groups of people, by language and kind; terms of one kind are swapped for each other.
IDENTITY_TERMS = {
    "en": (
        ("women", "men", "girls", "boys"),
        ("gay", "lesbian", "bisexual", "straight", "transgender", "queer"),
        ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
        ("black", "white", "asian", "latino", "indigenous"),
        ("africans", "americans", "arabs", "chinese", "europeans", "indians", "mexicans", "russians"),
        ("immigrants", "refugees", "natives", "foreigners"),
        ("disabled", "deaf", "blind", "autistic"),
        ("elderly", "young"),
    ),
    "fr": (
        ("femmes", "hommes", "filles", "garçons"),
        ("gays", "lesbiennes", "bisexuels", "hétérosexuels", "transgenres"),
        ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
        ("noirs", "blancs", "asiatiques"),
        ("africains", "américains", "arabes", "chinois", "européens", "indiens", "russes"),
        ("immigrés", "réfugiés", "étrangers"),
        ("handicapés", "sourds", "aveugles", "autistes"),
        ("vieux", "jeunes"),
    ),
    "de": (
        ("frauen", "männer", "mädchen", "jungen"),
        ("schwule", "lesben", "bisexuelle", "heterosexuelle", "transsexuelle"),
        ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
        ("schwarze", "weiße", "asiaten"),
        ("afrikaner", "amerikaner", "araber", "chinesen", "europäer", "inder", "russen"),
        ("einwanderer", "flüchtlinge", "einheimische", "ausländer"),
        ("behinderte", "gehörlose", "blinde", "autisten"),
        ("alte", "junge"),
    ),
    "es": (
        ("mujeres", "hombres", "niñas", "niños"),
        ("gais", "lesbianas", "bisexuales", "heterosexuales", "transexuales"),
        ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
        ("negros", "blancos", "asiáticos"),
        ("africanos", "americanos", "árabes", "chinos", "europeos", "indios", "mexicanos", "rusos"),
        ("inmigrantes", "refugiados", "extranjeros"),
        ("discapacitados", "sordos", "ciegos", "autistas"),
        ("ancianos", "jóvenes"),
    ),
}
#: A swap: the term that stands, the term that takes its place, and whether that one stands in the sentence already.
Swap = tuple[str, str, bool]


def words_of(text: bytes | None) -> set[str]:
    return set(WORD.findall(text.decode().lower())) if text else set()


def features_of(word: str) -> list[str]:
    """The word, and its prefixes with a mark that no word has."""
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) >= n]]


def partners_of(kinds: Mapping[str, Sequence[Sequence[str]]]) -> dict[str, list[str]]:
    """Each term with the others of its kinds."""
    out: dict[str, set[str]] = {}
    for language in kinds.values():
        for kind in language:
            for term in kind:
                out.setdefault(term, set()).update(t for t in kind if t != term)
    return {term: sorted(others) for term, others in sorted(out.items())}


def swaps_in(sentence: str, partners: dict[str, list[str]], neutral: bool) -> list[Swap]:
    """The swaps of a sentence's terms, each by each other one of its kind; a neutral sentence without terms gets one."""
    words = set(WORD.findall(sentence.lower()))
    named = [term for term in words if term in partners]
    if not named and words and neutral and partners:
        terms = list(partners)
        named = [terms[crc32(sentence.encode()) % len(terms)]]
    return [(term, other, other in words) for term in named for other in partners[term]]


def change_of(swap: Swap) -> Counter:
    """What a swap takes from the features of a sentence's distinct words, and adds (below zero)."""
    term, other, present = swap
    change = Counter(features_of(term))
    if not present:
        change.subtract(features_of(other))
    return change


def fit(rows: list[np.ndarray], labels: np.ndarray, changes: list[tuple[np.ndarray, np.ndarray]], n_features: int,
        ridge: float, counterfactual: float, steps: int = 400, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept. ``rows``: feature numbers of each text; ``changes``: numbers and amounts of each swap, made so many ``times``."""
    ends = np.cumsum([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), np.diff(np.concatenate([[0], ends])))
    change_flat = np.concatenate([i for i, _ in changes] or [np.zeros(0, np.int64)]).astype(np.int64)
    change_size = np.concatenate([a for _, a in changes] or [np.zeros(0)])
    change_owner = np.repeat(np.arange(len(changes)), [len(i) for i, _ in changes])
    times = np.ones(len(changes)) if times is None else np.asarray(times, float)
    weight = np.zeros(n_features)
    intercept = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    # Adam on the whole sample: the loss is convex and smooth.
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = np.bincount(owner, weight[flat], len(rows)) + intercept
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(labels)
        gradient = np.bincount(flat, error[owner], n_features) + ridge * weight
        if len(changes):
            change = np.bincount(change_owner, weight[change_flat] * change_size, len(changes))
            pull = 2 * counterfactual * change * times / times.sum()
            gradient = gradient + np.bincount(change_flat, pull[change_owner] * change_size, n_features)
        whole = np.append(gradient, error.sum())
        m, v = 0.9 * m + 0.1 * whole, 0.999 * v + 0.001 * whole**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        weight, intercept = weight - move[:-1], intercept - move[-1]
    return weight, float(intercept)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic, every = Counter(), Counter()
        for text, label in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            found = {f for w in words_of(text) for f in features_of(w)}
            every.update(found)
            if label:
                toxic.update(found)
        names = list(every)
        yield pa.record_batch(
            [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([every[n] for n in names], pa.int64())],
            ["feature", "toxic", "n"],
        )


def sample_ids(docs: DataFrame, labels: DataFrame, labelled: Column, doc_id: str, label: str, toxic: int, neutral: int) -> dict:
    """At most ``toxic`` ids with label 1 and ``neutral`` with 0, by the smallest hashes."""
    marked = labels.select(column(doc_id).alias("id"), column(label).alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    marked = marked.groupBy("id").agg((F.max("label") > 0).cast("int").alias("label"))
    allowed = docs.where(labelled & column(doc_id).isNotNull()).select(column(doc_id).alias("id")).distinct()
    known = marked.join(allowed, "id", "left_semi").select("id", F.col("label").alias("key"))
    kept = sample_by_hash(known, lambda toxic_label: toxic if toxic_label else neutral)
    return {r.id: r.key for r in kept.collect()}


def train(
    docs: DataFrame, labels: DataFrame, labelled: Column, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    toxic: int = 3_000, neutral: int = 6_000, features: int = 4_000, least: int = 3,
    ridge: float = 1e-4, counterfactual: float = 1.0, kinds=IDENTITY_TERMS,
) -> tuple[dict[str, float], float]:
    """Weights by feature, and the intercept."""
    ids = sample_ids(docs, labels, labelled, doc_id, label, toxic, neutral)
    if len(set(ids.values())) < 2:
        return {}, 8.0 if 1 in ids.values() else -30.0
    spark = docs.sparkSession
    sample = docs.where(column(doc_id).isin(list(ids))).select(column(doc_id).alias("id"), column(text).alias("text"))
    toxic_ids = [i for i, y in ids.items() if y]
    marked = sample.select("text", F.col("id").isin(toxic_ids).alias("label"))
    counts = marked.mapInArrow(_feature_counts, "feature string, toxic bigint, n bigint")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).where(F.col("n") >= least)
    # The signed root of the likelihood ratio, near enough: how far the toxic share is from what is expected.
    share = len(toxic_ids) / len(ids)
    surprise = F.abs(F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    chosen = [r.feature for r in counts.orderBy(surprise.desc(), "feature").limit(features).collect()]
    number = {f: i for i, f in enumerate(chosen)}
    partners = partners_of(kinds)
    for term in partners:
        for f in features_of(term):
            number.setdefault(f, len(number))
    shared = spark.sparkContext.broadcast((number, partners, {i for i, y in ids.items() if not y}))

    def extract(batches: Iterator[list]) -> Iterator[list]:
        known = shared.value[0]
        for texts in batches:
            yield [[known[f] for w in sorted(words_of(value)) for f in features_of(w) if f in known] for value in texts]

    def swaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, others, calm = shared.value
        counts: Counter[Swap] = Counter()
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                for sentence in SENTENCE.split(raw.decode("utf-8", "replace")) if raw else ():
                    counts.update(swaps_in(sentence, others, key in calm))
        cells = [*zip(*counts), list(counts.values())] if counts else [[], [], [], []]
        kinds_of = [pa.string(), pa.string(), pa.bool_(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cells, kinds_of)], ["term", "other", "present", "n"])

    shape = per_text(extract, "array<int>", pa.list_(pa.int32()))
    found = sample.select("id", shape(F.col("text")).alias("rows")).collect()
    found = sorted(found, key=lambda r: (r.id, r.rows))
    rows = [np.array(r.rows, np.int64) for r in found]
    y = np.array([ids[r.id] for r in found], float)
    counted = sample.mapInArrow(swaps, "term string, other string, present boolean, n bigint")
    counted = counted.groupBy("term", "other", "present").agg(F.sum("n").alias("n")).orderBy("term", "other", "present").collect()
    changes = []
    for r in counted:  # as many as there are swaps of the given terms
        moved = [(number[f], n) for f, n in change_of((r.term, r.other, r.present)).items() if n]
        changes.append((np.array([i for i, _ in moved], np.int64), np.array([n for _, n in moved], float)))
    times = np.array([r.n for r in counted], float)
    weight, intercept = fit(rows, y, changes, len(number), ridge, counterfactual, times=times)
    return {f: float(weight[i]) for f, i in number.items() if abs(weight[i]) > 1e-4}, intercept


def add_scores(docs: DataFrame, model: tuple[dict[str, float], float], *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, intercept = shared.value
        cache: dict[str, float] = {}
        for texts in batches:
            out = []
            for value in texts:
                total = intercept
                for word in sorted(words_of(value)):  # a fixed order, for the same last digits everywhere
                    known = cache.get(word)
                    if known is None:
                        known = cache[word] = sum(weights.get(f, 0.0) for f in features_of(word))
                    total += known
                out.append(1 / (1 + np.exp(-min(max(total, -30.0), 30.0))))
                if len(cache) > CACHED_WORDS:
                    cache.clear()
            yield [float(x) for x in out]

    return docs.withColumn(name, per_text(run, "double", pa.float64())(column(text)))
