"""A content-addressed web archive.

Payload bytes are stored once under their SHA-256, exact WARC record headers in
a table of their own. Of pages with equal payloads the one with the largest id
is a ``response`` record, the others ``revisit`` records that refer to it.
Original records come back through a join of headers and payloads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.pick import lookup

# RFC 4648 base 32, and the digits that conv() writes in base 32.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each 5 of the 40 hex digits make 4 characters."""
    text = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(text, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), DIGITS, ALPHABET)


def header(kind: Column, page_id: Column, url: Column, digest: Column, size: Column, refers_to: Column, date: str) -> Column:
    """The exact header block of a record. Line ends in a URL are percent-encoded to keep fields apart."""
    uri = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    name = F.coalesce(page_id.cast("string"), F.lit("none"))
    number = F.coalesce(refers_to.cast("string"), F.lit("none"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name,
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), digest,
        F.when(kind == "revisit", F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.lit("\r\nWARC-Refers-To: <urn:page:"), number, F.lit(">"),
        )).otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(kind == "revisit", F.lit("0")).otherwise(size.cast("string")),
    )


def write_archive(pages: DataFrame, folder: str, min_revisit: int = 0, date: str = "2025-01-01T00:00:00Z") -> str:
    """Write ``pages`` (page_id, url, html) as an archive below ``folder`` and return that folder.

    A null html is an empty payload, a null URL an empty target. Payloads of
    fewer than ``min_revisit`` bytes are always responses. A repeated row with
    the largest id is the same response again; rows without an id refer to the
    one with the largest, and are responses if no equal page has an id. Other
    columns are ignored. A third of all pages with one payload is combined
    before the shuffle, by digest.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    rows.groupBy("key").agg(F.first("payload").alias("payload")).write.parquet(f"{folder}/payloads")
    narrow = rows.select(
        "page_id", "url", "key", F.octet_length("payload").cast("long").alias("size"), base32_sha1(F.col("payload")).alias("digest")
    )
    holders = rows.groupBy("key").agg(F.max("page_id").alias("holder"))
    records = lookup(narrow, holders, "key")
    again = (F.col("size") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("holder"))
    kind = F.when(again, "revisit").otherwise("response")
    head = header(kind, F.col("page_id"), F.col("url"), F.col("digest"), F.col("size"), F.col("holder"), date)
    records.select("page_id", "key", head.alias("header")).write.parquet(f"{folder}/headers")
    return folder


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """``key`` and ``payload``; a payload that doesn't have its digest is an error."""
    rows = spark.read.parquet(f"{folder}/payloads")
    wrong = F.raise_error(F.concat(F.lit("damaged payload "), F.col("key"))).cast("binary")
    return rows.select("key", F.when(F.sha2("payload", 256) == F.col("key"), F.col("payload")).otherwise(wrong).alias("payload"))


def field(name: str) -> Column:
    """A field of ``header``; null where there is none."""
    return F.nullif(F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)", 1), F.lit(""))


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id``, ``key`` and the fields of every record, read from its header block."""
    number = F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1)
    return spark.read.parquet(f"{folder}/headers").select(
        "page_id",
        "key",
        "header",
        field("WARC-Type").alias("record_type"),
        field("WARC-Payload-Digest").alias("stated_digest"),
        field("Content-Length").cast("long").alias("stated_length"),
        F.nullif(number, F.lit("")).cast("long").alias("refers_to"),
    )


def rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """The headers' fields, ``payload``, its size and digest, and ``record``: each original record, byte for byte.

    Each payload is hashed once, however many records share it. A record
    without its payload, or whose header states another digest or length of
    its block, is an error.
    """
    facts = read_payloads(spark, folder).select(
        "key",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    rows = lookup(read_headers(spark, folder), facts, "key")
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8"))
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    record = F.concat(F.encode("header", "UTF-8"), end, block, end)
    rows = rows.withColumn("record", record)
    rest = F.octet_length("record") - F.octet_length(F.encode("header", "UTF-8")) - 8
    good = F.col("stated_digest").eqNullSafe(F.concat(F.lit("sha1:"), F.col("payload_digest")))
    good = good & F.col("stated_length").eqNullSafe(rest.cast("long"))
    wrong = F.raise_error(F.concat(F.lit("damaged record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    return rows.withColumn("payload_digest", F.when(good, F.col("payload_digest")).otherwise(wrong.cast("string")))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id``, ``record_type``, ``payload`` and ``record``: each original record, byte for byte.

    A revisit record has no block of its own; ``payload`` still is the page's.
    """
    # The digest is asked for so that a damaged record is not returned.
    rows = rebuilt(spark, folder).where("payload_digest IS NOT NULL")
    return rows.select("page_id", "record_type", "refers_to", "payload", "record")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record that was rebuilt: id, payload size and digest of the bytes as read back, type and reference."""
    return rebuilt(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
