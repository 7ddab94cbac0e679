"""The stages one by one against plain versions, each on what its predecessor kept."""

import hashlib

import corpus_pipeline as P
from pyspark.sql import functions as F
from rows import AWKWARD, clashing, documents, prose
from test_decontaminate import plain as plain_hits
from test_mixing import poisson
from test_simhash import plain_classes, plain_fingerprint
from test_substring import plain as plain_removed

from hitlake.llm import mixing


def texts_of(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.select("doc_id", "text", "lang", "source").collect()]


def test_stages(spark, tmp_path, sf_dir):
    extra = spark.createDataFrame(
        [(9000 + i, prose(i, 4) + "\n" + prose(900, 9), "en", "src0", 1) for i in range(4)] + [(9100, "12 34", "en", "src0", 5), (9101, None, "en", None, None)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(extra)
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = texts_of(docs)
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        result = spark.read.parquet(f"{tmp_path}/{k}")
        after = texts_of(result)
        if k < 4:
            assert result.columns == docs.columns
        ids = {r[0] for r in after}
        if k == 0:
            assert {r[0] for r in before} - ids == {9100, 9101}
        elif k == 1:
            roots = plain_classes({plain_fingerprint(r[1]) for r in before})
            least = {}
            for r in before:
                root = roots[plain_fingerprint(r[1])]
                least[root] = min(least.get(root, r[0]), r[0])
            assert ids == set(least.values()) and len(after) == len(ids) < len(before)
        elif k == 2:
            gone = {(i, text): n for i, text, n in plain_removed(before)}
            changed = {r[0] for r in before if gone[str(r[0]), str(r[1])]}
            texts = {r[0]: r[1] for r in before}
            assert {r[0] for r in after if r[1] != texts[r[0]]} <= changed and {9001, 9002, 9003} <= changed
            assert {r[0] for r in before} - ids <= changed
        elif k == 3:
            hits = {r[0]: plain_hits(r[1], items) for r in before}
            assert ids == {i for i, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)} and len(ids) < len(before)
        else:
            rates = {r.source: r.rate for r in mixing.source_rates(docs, temperature=0.5, total=1.0).collect()}
            share = lambda i: int(hashlib.md5(f"6:{i}".encode()).hexdigest()[:13], 16) / 16**13
            copies = {(r[0], c) for r in before for c in range(poisson(rates[r[3]], share(r[0])))}
            assert {(r.doc_id, r.copy) for r in result.collect()} == copies and len(after) == len(copies) > len(before) / 2
            keys = {r.shuffle_key for r in result.collect()}
            assert keys == {hashlib.md5(f"6:{i}:{c}".encode()).hexdigest() for i, c in copies}
        docs, before = result, after


def test_run_is_the_stages(spark, sf_dir):
    rows = P.run(spark, sf_dir)
    assert rows.columns[-2:] == ["copy", "shuffle_key"]
    assert rows.groupBy("doc_id", "copy").count().where("count > 1").count() == 0
    assert 0 < rows.select("doc_id").distinct().count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_awkward_rows(spark, sf_dir, tmp_path):
    docs = clashing(documents(spark)).drop("a.b")
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.select(F.count_if(F.col("doc_id") == 4)).first()[0] == 0 and len(AWKWARD) > docs.select("doc_id").distinct().count() > 2
    docs = documents(spark, [])
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
