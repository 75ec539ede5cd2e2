"""WARC archives that are addressed by content: payloads once under a strong digest, exact record headers apart, records by joins."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stash

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Archive(NamedTuple):
    """payloads (digest, payload): each byte string once. records (digest, header): every record's header block, byte for byte."""

    payloads: DataFrame
    records: DataFrame


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits make four of it."""
    digits = F.concat(*(F.lpad(F.conv(F.substring(F.sha1(data), k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)))
    return F.translate(F.upper(digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _headers(page: Column, url: Column, turn: Column, first: Column, size: Column, sha1: Column, response: Column, date: str) -> Column:
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size.cast("string"), F.lit(CRLF * 2))
    name = lambda p, k: F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(p.cast("string")), F.lit("")), F.lit(":"), k.cast("string"), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        line("WARC-Record-ID", name(page, turn)),
        line("WARC-Date", F.lit(date)),
        F.when(url.isNull(), "").otherwise(line("WARC-Target-URI", F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        F.when(response, "").otherwise(F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(first, F.lit(1))))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.when(response, size).otherwise(0)).cast("string")),
        F.lit(CRLF),
        http,
    )


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", date: str = "2024-01-01T00:00:00Z", least: int = 0) -> Archive:
    """Write a record for every page. Of records whose payloads are equal and of at least `least` bytes, that with the largest id is a response, others revisit it.

    Digests are SHA-256, and only they and the ids are shuffled to choose; a payload is shuffled once, if it is a
    response's. A null body counts as empty; ids are numbers or texts, a null one comes before all others (an empty one is
    read back as null), equal ids go by url, and of rows that repeat id, url and body one is the response. Smaller payloads are all responses, stored once like the others.
    """
    body = F.encode(F.coalesce(F.col(body_col).cast("string"), F.lit("")), "UTF-8")
    base = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    rows = base.select("page", "url", F.sha2("payload", 256).alias("digest"), base32_sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").alias("size"))
    rows = stash(rows.groupBy("digest", "page", "url", "sha1", "size").agg(F.count(F.lit(1)).alias("copies")), "warc-digests")
    firsts = rows.groupBy("digest").agg(F.max(F.struct("page", "url")).alias("first"), F.count(F.lit(1)).alias("n"))
    named = salted_join(rows, firsts, "digest", "n", rows.count(), "page").withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    response = (F.col("size") < least) | (F.col("page").eqNullSafe(F.col("first.page")) & F.col("url").eqNullSafe(F.col("first.url")) & (F.col("turn") == 1))
    header = F.encode(_headers(F.col("page"), F.col("url"), F.col("turn"), F.col("first.page"), F.col("size"), F.col("sha1"), response, date), "UTF-8")
    records = stash(named.select("digest", header.alias("header")), "warc-records")
    # one column names a record, so that the join and the removal of repeated rows share one shuffle of the payloads
    name = lambda page, url: F.sha2(F.concat_ws("|", "digest", F.coalesce(F.col(page).cast("string"), F.lit("")), F.coalesce(F.col(url), F.lit("\0"))), 256)
    keys = firsts.select("digest", "first.*").select(name("page", "url").alias("key"))
    once = base.withColumn("digest", F.sha2("payload", 256)).select("digest", "payload", name("page", "url").alias("key")).join(keys, "key", "left_semi")
    payloads = stash(once.dropDuplicates(["key"]).select("digest", "payload"), "warc-payloads", "zstd")
    return Archive(payloads, records)


def read_archive(archive: Archive, id_type: str = "long") -> DataFrame:
    """Every record again: page_id (of the type that pages had), payload_bytes, payload_digest, record_type, refers_to, header, payload, record.

    Stored payloads are digested anew and a mismatch with their address, or with the header's digest, raises an error.
    record holds the bytes of the WARC record. Columns that are not selected are not shuffled, and records of a payload that
    very many share are spread.
    """
    held = archive.payloads.withColumn("payload_digest", base32_sha1(F.col("payload"))).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    held = held.withColumn("payload_bytes", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload_bytes")).otherwise(F.raise_error(F.lit("a stored payload does not have its digest")).cast("long")))
    held = held.join(archive.records.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "digest")
    out = salted_join(archive.records, held, "digest", "n", archive.records.count(), "header").withColumn("head", F.decode("header", "UTF-8"))
    field = lambda pattern: F.nullif(F.regexp_extract("head", pattern, 1), F.lit(""))
    page = lambda pattern: F.url_decode(field(pattern)).cast(id_type)
    kind = field(r"\r\nWARC-Type: ([a-z]+)\r\n")
    said = field(r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]+)\r\n")
    body = F.when(kind == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8"))
    return out.select(
        page(r"\r\nWARC-Record-ID: <urn:page:([^:]*):").alias("page_id"),
        "payload_bytes",
        F.when(said == F.col("payload_digest"), said).otherwise(F.raise_error(F.lit("a header does not have its payload's digest"))).alias("payload_digest"),
        kind.alias("record_type"),
        page(r"\r\nWARC-Refers-To: <urn:page:([^:]*):").alias("refers_to"),
        "header",
        "payload",
        F.concat("header", body, F.encode(F.lit(CRLF * 2), "UTF-8")).alias("record"),
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
g AS (SELECT *, list_transform(range(0, 32), lambda i: (('0x' || substr(d, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - i % 4 * 5)::INT) & 31) AS v FROM p)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, array_to_string(list_transform(v, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x + 1)::INT, 1)), '') AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM g
"""
