"""Pattern extraction, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitlake.operators import dedupe, extract, extract_matches, number_ordered
from hitlake.scratch import scratch_path
from hitlake.sources import read_lines
from hitlake.streaming import extract_stream, run_extract, start_extract, stream_lines

from .tables import hit_lines, table

EMAIL = r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
LINK = 'href="([^"]+)"'
WORD_AT = r"\w+@\w+"
TWO_GROUPS = r"(?P<the_tag><li>)|<(h\d)[ >]"
USER = r"user=(\d+)"
HIT_FIELDS = ("_source.host.name:host", "_source.missing", "_source.k")


def extract_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "documents"), EMAIL, "text", ("lang", "source"))


def extract_emails_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "documents"), EMAIL, "text", ("doc_id",), unique=False)


def extract_links_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), LINK, "html", ("url",), unique=False)


def extract_unicode_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "documents"), WORD_AT, "text")


def extract_idle_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), TWO_GROUPS, "html", ("page_id:page",), unique=False)


def matches_and_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extract_matches(pages, LINK, pages["html"])
    return dedupe(found.select("match"))


def extract_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_lines(spark, hit_lines(spark, sf_dir))
    return extract(lines, USER, fields=HIT_FIELDS, raw=True)


def extract_damaged_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_lines(spark, hit_lines(spark, sf_dir, damaged=True))
    return extract(lines, USER, fields=HIT_FIELDS, unique=False, raw=True)


def extract_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in a report."""
    return number_ordered(extract_emails(spark, sf_dir))


def extract_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A greedy pattern that can match nothing."""
    found = extract_matches(table(spark, sf_dir, "documents"), r"(?:idiot|clown)?", F.col("text"))
    return found.where("match <> ''").groupBy("doc_id", "match").agg(F.count(F.lit(1)).alias("n"))


def extract_lazy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lazy pattern that can match nothing, so that Python's own engine finds its matches."""
    found = extract_matches(table(spark, sf_dir, "documents"), r"(?:idiot|clown)??(?:moron)?", F.col("text"))
    return found.where("match <> ''").groupBy("doc_id", "match").agg(F.count(F.lit(1)).alias("n"))


def _arriving_parts(spark: SparkSession, sf_dir: str, remember: str) -> DataFrame:
    """Hits that arrive in three batches, the oldest last; errors have no time."""
    lines = spark.read.text(hit_lines(spark, sf_dir))
    value = F.col("value")
    time = F.get_json_object(value, "$._source['@timestamp']")
    undated = F.replace(value, F.lit('"@timestamp"'), F.lit('"time"'))
    failed = F.get_json_object(value, "$._source.message").startswith("error")
    arriving = lines.select(F.when(failed, undated).otherwise(value).alias("value"), time.alias("time"))
    folder, output, state = (scratch_path(spark, f"stream-{name}") for name in ("lines", "parts", "state"))
    recent, oldest = F.col("time") >= "2024-01-20", F.col("time") < "2024-01-10"
    for batch in (recent, ~recent & ~oldest, F.coalesce(oldest, F.lit(True))):
        arriving.where(batch).select("value").write.mode("append").text(folder)
        found = extract_stream(
            stream_lines(spark, folder), USER, fields=HIT_FIELDS, remember=remember, event_time="_source.@timestamp"
        )
        run_extract(found, output, state)
    return spark.read.parquet(output)


def stream_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, late rows and undated rows, each as such."""
    return _arriving_parts(spark, sf_dir, "12 days").drop("batch")


def extract_stream_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream remembers rows by the documents' own time; late and undated ones come apart and are repeats in part."""
    return _arriving_parts(spark, sf_dir, "7 days").drop("part", "batch").distinct()


def extract_stream_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stream_lines(spark, hit_lines(spark, sf_dir))
    rows = extract_stream(lines, USER, fields=HIT_FIELDS).rows
    output = scratch_path(spark, "stream-output")
    start_extract(rows, output, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(output)


_HITS_SQL = """
SELECT {distinct} CAST(user_id AS VARCHAR) AS match, 'node' || CAST(user_id % 7 AS VARCHAR) AS host,
       '' AS missing, json_extract_string(props, '$.k') AS k
FROM events {where}
"""

QUERIES = {
    "extract_emails": (
        extract_emails,
        f"SELECT DISTINCT unnest(regexp_extract_all(text, '{EMAIL}')) AS match, lang, source FROM documents",
    ),
    "extract_order": (
        extract_order,
        f"""SELECT row_number() OVER (ORDER BY lang DESC, match DESC, first) AS row_no, match, lang, source FROM (
            SELECT match, lang, source, min(doc_id) AS first FROM (
                SELECT unnest(regexp_extract_all(text, '{EMAIL}')) AS match, lang, source, doc_id FROM documents)
            GROUP BY match, lang, source)""",
    ),
    "extract_optional": (
        extract_optional,
        "SELECT doc_id, match, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'idiot|clown')) AS match"
        " FROM documents) GROUP BY doc_id, match",
    ),
    "extract_lazy": (
        extract_lazy,
        "SELECT doc_id, match, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'idiot|clown|moron')) AS match"
        " FROM documents) GROUP BY doc_id, match",
    ),
    "extract_emails_all": (
        extract_emails_all,
        f"SELECT unnest(regexp_extract_all(text, '{EMAIL}')) AS match, CAST(doc_id AS VARCHAR) AS doc_id"
        " FROM documents",
    ),
    "extract_links_group": (
        extract_links_group,
        f"SELECT unnest(regexp_extract_all(html, '{LINK}', 1)) AS match, url FROM pages",
    ),
    "extract_unicode_words": (
        extract_unicode_words,
        r"SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+@[\p{L}\p{N}_]+')) AS match"
        " FROM documents",
    ),
    "extract_idle_group": (
        extract_idle_group,
        r"SELECT CASE WHEN m = '<li>' THEN m ELSE '' END AS match, page FROM ("
        r"SELECT unnest(regexp_extract_all(html, '<li>|<h\d[ >]')) AS m, CAST(page_id AS VARCHAR) AS page"
        r" FROM pages)",
    ),
    "matches_and_dedupe": (
        matches_and_dedupe,
        f"SELECT DISTINCT unnest(regexp_extract_all(html, '{LINK}', 1)) AS match FROM pages",
    ),
    "extract_hits": (extract_hits, _HITS_SQL.format(distinct="DISTINCT", where="")),
    "extract_damaged_hits": (
        extract_damaged_hits,
        _HITS_SQL.format(distinct="", where="WHERE event_type NOT IN ('error', 'purchase')"),
    ),
    "extract_stream_event_time": (extract_stream_event_time, _HITS_SQL.format(distinct="DISTINCT", where="")),
    "stream_parts": (
        stream_parts,
        """WITH hits AS (
            SELECT CAST(user_id AS VARCHAR) AS match, 'node' || CAST(user_id % 7 AS VARCHAR) AS host, '' AS missing,
                json_extract_string(props, '$.k') AS k, CASE WHEN event_type <> 'error' THEN ts END AS seen,
                CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 0 WHEN ts >= TIMESTAMP '2024-01-10' THEN 1 ELSE 2 END AS batch
            FROM events
        ), bounds AS (
            SELECT b AS batch, (SELECT max(seen) FROM hits WHERE hits.batch < b - 1) - INTERVAL 12 DAY AS bound FROM range(3) AS t(b)
        ), judged AS (
            SELECT *, CASE WHEN seen IS NULL THEN 'undated' WHEN seen <= bound THEN 'late' ELSE 'row' END AS part
            FROM hits JOIN bounds USING (batch)
        )
        SELECT match, host, missing, k, part FROM judged WHERE part <> 'row'
        UNION ALL SELECT DISTINCT match, host, missing, k, part FROM judged WHERE part = 'row'""",
    ),
    "extract_stream": (extract_stream_hits, _HITS_SQL.format(distinct="DISTINCT", where="")),
}
