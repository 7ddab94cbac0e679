import hashlib
import math

from pyspark.sql import functions as F
from rows import AWKWARD, clashing, documents

from hitlake.llm import mixing as M


def poisson(rate, u):
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u and k < 500:
        k += 1
        p *= rate / k
        total += p
    return k


def test_counts(spark):
    docs = clashing(documents(spark))
    rates = {r.source: r.rate for r in M.source_rates(docs, temperature=0.5, total=3.0).collect()}
    assert set(rates) == {"a", "b", "c", "d", None}
    got = M.mix(docs, temperature=0.5, total=3.0, seed=1)
    expected = []
    for doc_id, _, _, source in AWKWARD:
        if doc_id is None:  # drawn by its place too
            continue
        u = int(hashlib.md5(f"1:{'-' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 16**13
        expected += [(doc_id, source, i) for i in range(poisson(rates[source], u))]
    rows = got.collect()
    orphans = [r for r in rows if r.doc_id is None]
    assert [r.copy for r in sorted(orphans, key=lambda r: r.copy)] == list(range(len(orphans)))
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.doc_id, r.source, r.copy) for r in rows if r.doc_id is not None), key=key) == sorted(expected, key=key)
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)
    assert got.columns == [*docs.columns, "copy", "shuffle_key"]


def test_weights_are_met(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("word").alias("text"), F.when(F.col("id") < 3900, "big").otherwise("small").alias("source"))
    counts = {r.source: r["count"] for r in M.mix(docs, weights={"big": 1, "small": 3, "absent": 5}).groupBy("source").count().collect()}
    assert abs(counts["big"] - 1000) < 150 and abs(counts["small"] - 3000) < 250


def test_large_and_zero_rates(spark):
    row = spark.range(1).select(M.poisson_table(F.lit(900.0)).alias("many"), M.poisson_table(F.lit(0.0)).alias("none")).first()
    assert abs(row.many[-1] - 1) < 1e-9 and abs(row.many[900] - 0.5) < 0.02 and row.none == [1.0]
    assert M.mix(documents(spark), weights={"nowhere": 1}).count() == 0
    assert M.mix(documents(spark, [])).count() == 0


def test_rows_without_id_are_drawn_one_by_one(spark):
    rows = [(None, "the same text", "en", "big")] * 3000 + [(i, "the same text", "en", "small") for i in range(1000)]
    mixed = M.mix(documents(spark, rows), weights={"big": 1, "small": 3}).groupBy("source").count().collect()
    counts = {r.source: r["count"] for r in mixed}
    assert abs(counts["big"] - 1000) < 150 and abs(counts["small"] - 3000) < 250
