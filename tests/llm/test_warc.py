from pyspark.sql import functions as F

from hitlake.llm import warc as W

BIG = "<html>" + "é" * 60 + "\r\n\r\nWARC/1.1\r\n\r\n</html>"
PAGES = [
    (5, "http://a/5", BIG),
    (3, "http://a/3", BIG),
    (9, "http://a/9\r\nWARC-Type: revisit", BIG),
    (1, None, "small"),
    (2, "http://a/2", "small"),
    (4, "http://a/4", None),
    (6, "http://a/6", ""),
    (7, "http://a/7", "x" * 200_000),
    (8, "http://a/8", "y" * 100),
    (8, "http://a/8", "y" * 100),
    (None, "http://a/none", "z" * 100),
    (None, "http://a/nine", "y" * 100),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_round_trip(spark, tmp_path):
    W.write_archive(pages(spark).withColumn("digest", F.lit(0)).withColumn("payload", F.lit(1)), f"{tmp_path}/a")
    archive = W.read_archive(spark, f"{tmp_path}/a")
    kind = W.header_field(F.col("header"), "WARC-Type").alias("kind")
    refers = W.urn_id(W.header_field(F.col("header"), "WARC-Refers-To")).alias("refers")
    target = W.header_field(F.col("header"), "WARC-Target-URI").alias("target")
    rows = archive.select("*", kind, refers, target).collect()
    assert all(r.verified for r in rows) and len(rows) == len(PAGES)
    assert sorted((str(r.page_id), bytes(r.payload).decode()) for r in rows) == sorted((str(p), t or "") for p, _, t in PAGES)
    assert {(r.page_id, r.refers) for r in rows if r.kind == "revisit"} == {(5, 3), (9, 3), (None, 8)}
    assert {r.target for r in rows if r.page_id == 9} == {"http://a/9%0D%0AWARC-Type: revisit"}
    assert [r.target for r in rows if r.page_id == 1] == [None]
    assert spark.read.parquet(f"{tmp_path}/a/payloads").count() == len({t or "" for _, _, t in PAGES})

    W.write_warc_files(archive, f"{tmp_path}/files")
    again = W.read_warc_files(spark, f"{tmp_path}/files").collect()
    bodies = {bytes(r.header): bytes(r.payload) for r in again}
    assert len(again) == len(PAGES)
    for r in rows:
        assert bodies[bytes(r.header)] == (b"" if r.kind == "revisit" else bytes(r.payload))


def test_damage_is_seen(spark, tmp_path):
    W.write_archive(pages(spark), f"{tmp_path}/a")
    payloads = spark.read.parquet(f"{tmp_path}/a/payloads").withColumn("payload", F.encode(F.lit("other"), "UTF-8"))
    payloads.write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{tmp_path}/a/headers").write.parquet(f"{tmp_path}/b/headers")
    assert not any(r.verified for r in W.read_archive(spark, f"{tmp_path}/b").collect())


def test_empty(spark, tmp_path):
    W.write_archive(pages(spark, []), f"{tmp_path}/a")
    assert W.read_archive(spark, f"{tmp_path}/a").count() == 0
