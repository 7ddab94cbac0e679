"""A content-addressed WARC archive.

Every page becomes a WARC record: a header (the WARC fields and the HTTP head) and a payload.
The archive holds two Parquet tables: ``headers``, the exact header bytes of every record with
the SHA-256 of its payload, and ``payloads``, each payload once under that digest. A record is
put together again by joining the two, and its payload's digest is computed anew and compared.

Of records with equal payloads of at least ``revisit_bytes`` (100) the one with the smallest id
is a response, the others are revisits that refer to it; smaller payloads are responses all.
Counting owners combines before the shuffle; the joins back have one row per digest on one
side, so a payload that very many pages share is split by adaptive execution.

Defined cases: a null html is an empty payload; a null url gives no target field; line breaks
in a url are percent-encoded; a page without an id never owns a payload that a page with one
has, and its record id is ``<urn:page:>``; rows with one id and one payload are records of
their own, of the same type.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import column

# Fixed values of the format.
VERSION = "WARC/1.1"
BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 100
RECORDS_PER_FILE = 1000


def _line(name: str, value: Column) -> Column:
    """A header line, null where the value is."""
    return F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def _payloads(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """id and payload with its digest."""
    payload = F.encode(F.coalesce(column(html), F.lit("")), "UTF-8")
    rows = pages.select(column(page_id).cast("bigint").alias("page_id"), payload.alias("payload"))
    return rows.withColumn("digest", F.sha2("payload", 256))


def record_headers(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "1970-01-01T00:00:00Z", revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """One row per page: page_id, digest, and ``header``, all of the record that stands before the payload."""
    payload = F.encode(F.coalesce(column(html), F.lit("")), "UTF-8")
    rows = pages.select(
        column(page_id).cast("bigint").alias("page_id"), column(url).cast("string").alias("url"),
        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("bytes"),
    )
    owners = rows.where(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("owner"))
    owned = rows.join(owners, "digest", "left")
    refers = F.when(F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner")), _urn(F.col("owner")))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"), _line("Content-Length", F.col("bytes").cast("string")), F.lit(BREAK))
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.octet_length(head) + F.when(refers.isNull(), F.col("bytes")).otherwise(0)
    fields = [
        F.lit(VERSION + BREAK),
        _line("WARC-Type", F.when(refers.isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Target-URI", target),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", refers),
        _line("WARC-Profile", F.when(refers.isNotNull(), F.lit(PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(BREAK),
        head,
    ]
    return owned.select("page_id", "digest", F.encode(F.concat_ws("", *fields), "UTF-8").alias("header"))


def write_archive(pages: DataFrame, path: str, *, page_id: str = "page_id", html: str = "html", **options) -> None:
    """Write the two tables of an archive under ``path``."""
    record_headers(pages, page_id=page_id, html=html, **options).write.parquet(f"{path}/headers")
    # Each payload comes from the smallest id that has it: payloads move once, by id and digest, however many share one.
    rows = _payloads(pages, page_id, html)
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("owner")
    owners = rows.groupBy("digest").agg(F.min("page_id").alias("page_id")).select("digest", key)
    owned = rows.select("digest", key, "payload").join(owners, ["digest", "owner"], "left_semi")
    stored = owned.dropDuplicates(["digest", "owner"]).drop("owner")
    stored.write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, header, payload, the payload's digest now, and whether that is the recorded one."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    joined = headers.join(payloads, "digest", "left")
    now = F.sha2("payload", 256)
    return joined.select("page_id", "header", "payload", now.alias("digest"), F.coalesce(now == F.col("digest"), F.lit(False)).alias("verified"))


def header_field(header: Column, name: str) -> Column:
    """A field's value, null where the record has none. Only the WARC part of the header is searched."""
    warc = F.substring_index(F.decode(header, "UTF-8"), BREAK * 2, 1)
    value = F.regexp_extract(F.concat(warc, F.lit(BREAK)), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def urn_id(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def original_records(archive: DataFrame) -> DataFrame:
    """page_id and ``record``, the bytes of each WARC record with the blank lines that end it."""
    revisit = header_field(F.col("header"), "WARC-Type") == "revisit"
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return archive.select("page_id", F.concat("header", body, F.lit((BREAK * 2).encode())).alias("record"))


def write_warc_files(archive: DataFrame, path: str, compression: str = "none") -> None:
    """Ordinary WARC files: Spark's text writer with the blank lines between records as its separator."""
    records = original_records(archive)
    text = F.decode(F.expr(f"substring(record, 1, octet_length(record) - {2 * len(BREAK)})"), "UTF-8")
    writer = records.select(text.alias("value")).write.option("lineSep", BREAK * 2)
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", compression).text(path)


def read_warc_files(spark: SparkSession, path: str) -> DataFrame:
    """``header`` and ``payload`` of every record of uncompressed WARC files (a file at a time in a task)."""
    end = (BREAK * 2).encode()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                headers, payloads, at = [], [], 0
                while at < len(content):
                    block = content.index(end, at) + len(end)
                    fields = dict(line.split(b": ", 1) for line in content[at : block - len(end)].split(BREAK.encode())[1:])
                    stop = block + int(fields[b"Content-Length"])
                    payload = content.index(end, block, stop) + len(end)
                    headers.append(content[at:payload])
                    payloads.append(content[payload:stop])
                    at = stop + len(end)
                yield pa.record_batch([pa.array(headers, pa.binary()), pa.array(payloads, pa.binary())], ["header", "payload"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, "header binary, payload binary")
