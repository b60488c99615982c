"""WARC archives with revisit records (operator 4).

Only headers (id, digest, length) are shuffled to decide what revisits what:
one aggregate per payload digest.  Revisit records carry no payload.  Archives
are written by Spark's text writer with the record separator CR LF CR LF,
which makes each file a sequence of WARC records, gzipped, of bounded size;
they are read back whole, file by file, and split by Content-Length.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm.common import new_path, table, written

MIN_PAYLOAD = 100
FILE_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def payload_digest(html: Column) -> Column:
    return F.sha2(F.coalesce(html, F.lit("")).cast("binary"), 256)


def revisit_headers(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Digests of repeated payloads: digest, first_id, n_rows, n_first.

    ``first_id`` is the smallest page_id (null only if all are null), n_first
    the number of rows that share it.  Rows are pre-aggregated per
    (digest, page_id), so a digest that a third of all pages share is fine.
    """
    per_id = (pages.filter(F.col("bytes") >= min_payload).groupBy("digest", "page_id")
              .agg(F.count(F.lit(1)).alias("n")))
    per = per_id.groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("z"), F.col("page_id").alias("id"),
                       F.col("n").alias("n"))).alias("f"), F.sum("n").alias("n_rows"))
    return per.filter("n_rows > 1").select(
        "digest", F.col("f.id").alias("first_id"), "n_rows", F.col("f.n").alias("n_first"))


def record_id(page_id: Column, digest: Column, copy: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest,
                          copy.cast("string")))
    part = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))


def resolve(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """pages (page_id, url, html) -> one record each: page_id, url, kind,
    record_id, refers_to_id (record id), digest, payload (null for revisits)."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                     payload_digest(F.col("html")).alias("digest"),
                     F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes"))
    heads = p.drop("html")
    dups = written(revisit_headers(heads, min_payload), "warc-revisits")
    first = dups.withColumnRenamed("digest", "d")
    joined = p.join(first, F.col("digest") == F.col("d"), "left")
    same = F.col("page_id").eqNullSafe(F.col("first_id"))
    zero = F.lit(0).cast("long")
    # A page whose payload is its own: every small or unrepeated one.
    whole = joined.filter(F.col("d").isNull() | (same & (F.col("n_first") == 1)))
    # Several rows share the smallest id: one of them is the response.
    tied = (p.join(first.filter("n_first > 1"), (F.col("digest") == F.col("d")) & same)
            .groupBy("digest", "page_id").agg(F.min(F.struct("url", "html")).alias("x"))
            .select("page_id", "x.url", "x.html", "digest"))
    # Small payloads may repeat in rows of the same id; their records differ by
    # nothing but the place, so they may share an id.
    responses = (whole.select("page_id", "url", "html", "digest").unionByName(tied)
                 .select("page_id", "url", F.lit("response").alias("kind"),
                         record_id(F.col("page_id"), F.col("digest"), zero).alias("record_id"),
                         F.lit(None).cast("string").alias("refers_to_id"), "digest",
                         F.col("html").alias("payload")))
    target = record_id(F.col("first_id"), F.col("digest"), zero)
    later = (heads.join(first, F.col("digest") == F.col("d")).filter(~same)
             .select("page_id", "url", "digest", "first_id", F.lit(1).cast("long").alias("copy")))
    copies = (dups.filter("n_first > 1")
              .select(F.col("first_id").alias("page_id"), F.lit(None).cast("string").alias("url"),
                      "digest", "first_id",
                      F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_first") - 1))
                      .alias("copy")))
    revisits = later.unionByName(copies).select(
        "page_id", "url", F.lit("revisit").alias("kind"),
        record_id(F.col("page_id"), F.col("digest"), F.col("copy")).alias("record_id"),
        target.alias("refers_to_id"), "digest", F.lit(None).cast("string").alias("payload"))
    return responses.unionByName(revisits)


def record_text(date: str = DATE) -> Column:
    """A record of ``resolve()`` as text, without the CR LF CR LF that ends it."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    safe_url = F.regexp_replace(F.coalesce("url", F.lit("urn:page")), r"[\x00-\x20]", "")
    block = F.concat(F.lit(HTTP), F.coalesce("payload", F.lit("")))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("kind")),
        line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", safe_url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("kind") == "revisit", F.concat(
            line("WARC-Refers-To", F.col("refers_to_id")), line("WARC-Profile", F.lit(PROFILE))))
        .otherwise(F.lit("")),
        F.when(F.col("page_id").isNotNull(), line("X-Page-Id", F.col("page_id").cast("string")))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archives(records: DataFrame, path: str, payload_bytes: int,
                   file_bytes: int = FILE_BYTES) -> None:
    """Write gzipped WARC files of about ``file_bytes`` of payload each."""
    files = max(1, -(-payload_bytes // file_bytes))
    (records.repartition(files, "record_id", "page_id")
     .select(record_text().alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


FIELDS = ["page_id", "kind", "record_id", "refers_to_id", "digest", "payload_bytes", "payload_ok"]


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each WARC record in ``data``."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        heads = dict(x.split(": ", 1) for x in lines[1:])
        start, size = end + 4, int(heads["Content-Length"])
        yield heads, data[start:start + size]
        if data[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        at = start + size + 4


def _parse(with_payload: bool):
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                for h, block in parse_records(gzip.decompress(content) if content else b""):
                    body = block[block.index(b"\r\n\r\n") + 4:]
                    digest = h["WARC-Payload-Digest"].split(":", 1)[1]
                    kind = h["WARC-Type"]
                    ok = kind == "revisit" or hashlib.sha256(body).hexdigest() == digest
                    row = (int(h["X-Page-Id"]) if "X-Page-Id" in h else None, kind,
                           h["WARC-Record-ID"], h.get("WARC-Refers-To"), digest, len(body), ok)
                    rows.append((*row, body.decode("utf-8", "surrogatepass"))
                                if with_payload else row)
                out = pd.DataFrame(rows, columns=[*FIELDS, *["payload"] * with_payload])
                out["page_id"] = out["page_id"].astype("Int64")
                yield out
    return parse


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives under ``path``; payload_ok tells
    whether a response's payload has the digest its header names."""
    schema = ("page_id long, kind string, record_id string, refers_to_id string, digest string, "
              "payload_bytes long, payload_ok boolean" + ", payload string" * with_payload)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInPandas(_parse(with_payload), schema)


def resolved(records: DataFrame) -> DataFrame:
    """Join revisit records to their original responses: page_id, payload_bytes
    and payload_digest of the full payload, record_type, refers_to (page_id).

    The side of the originals has one row a record, so a response that a third
    of all pages revisit splits as a skewed join does."""
    originals = records.filter((F.col("kind") == "response")
                               & (F.col("payload_bytes") >= MIN_PAYLOAD)).select(
        F.col("record_id").alias("o_id"), F.col("page_id").alias("o_page"),
        F.col("payload_bytes").alias("o_bytes"))
    revisit = F.col("kind") == "revisit"
    linked = records.filter(revisit).join(originals, F.col("refers_to_id") == F.col("o_id"), "left")
    own = records.filter(~revisit)
    return (own.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"),
                       F.col("kind").alias("record_type"),
                       F.lit(None).cast("long").alias("refers_to"), "payload_ok")
            .unionByName(linked.select(
                "page_id", F.col("o_bytes").alias("payload_bytes"),
                F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
                F.col("o_page").alias("refers_to"),
                F.col("o_id").isNotNull().alias("payload_ok"))))


def archive_pages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
                  html: str = "html", min_payload: int = MIN_PAYLOAD,
                  file_bytes: int = FILE_BYTES) -> None:
    """Write a deduplicated WARC record per row of ``pages`` under ``path``.

    Null or empty html: an empty payload, a response of its own.  Null page_id:
    sorts after all others and has no X-Page-Id header.  Repeated rows: one
    response, the others revisit it.  An empty table writes no record.  Other
    columns are ignored.
    """
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                     F.col(html).alias("html"))
    size = p.agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    write_archives(resolve(p, min_payload), path, size, file_bytes)


def op4_warc_revisits(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    archive_pages(table(spark, sf_dir, "pages"), path)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, "1")  # a row is a whole file
    records = written(read_archives(spark, path), "warc-records")
    spark.conf.set(rows, before)
    return resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                    "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n
           FROM pages),
r AS (SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS f FROM p
      WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST))
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN n >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND k > 1 THEN f END AS refers_to
FROM r
"""
