"""A content-addressed web archive: payload bytes once, exact record headers apart.

An archive is a folder of two tables.

- ``payloads``: ``digest`` (SHA-256 of the bytes) and ``payload``, one row for
  each different payload, however many records have it;
- ``headers``: for each record its number, the digest of its payload, and the
  exact bytes of its WARC header and of the HTTP header that opens its block.

A record is put together again by joining the two (``records``). Reading never
trusts the store: length, SHA-256 and SHA-1 are computed anew from the stored
bytes, once for each payload, and held against the key and the record's header
(``verified``).

Of records with equal payloads of at least ``least_revisit`` bytes the one with
the smallest id is the response, and the others are revisits that refer to it.
Shorter payloads are all responses, though the store still holds them once.

Payloads travel once: digests and ids alone decide which record of a group is
the response. Copies with one id are combined before the shuffle, copies with
different ids are spread by their ids. Only the small header rows of a large
group meet in a join, whose other side has one row for each digest, so Spark's
skew join can split it. Everything is DataFrame functions.

Rows: a null body is an empty payload; a null address has no WARC-Target-URI
line, and control characters and spaces of an address are percent-encoded; null ids come after all others. Rows repeated with one id are
records of their own with one response among them. An empty table makes an empty
archive. Ids must be integers. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.scratch import Scratch, write_clean

#: The alphabet of RFC 4648 and the digits that ``conv`` writes in base 32.
_BASE32, _CONV32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_CRLF = "\r\n"


@dataclass
class Archive:
    spark: SparkSession
    folder: str

    def headers(self) -> DataFrame:
        return self.spark.read.schema("record_no long, digest binary, warc binary, http binary").parquet(
            f"{self.folder}/headers")

    def payloads(self) -> DataFrame:
        return self.spark.read.schema("digest binary, payload binary").parquet(f"{self.folder}/payloads")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 40 bits at a time are eight digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _CONV32, _BASE32)


def _address(url: Column) -> Column:
    """The address without characters that would end or split a header line."""
    safe = url
    for code in (*range(33), 127):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), safe).otherwise(url)


def _line(name: str, value: Column | str) -> Column:
    """A header line, or nothing where the value is null."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))


def _record_id(page_id: Column, record_no: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"),
                    record_no.cast("string"), F.lit(">"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
          least_revisit: int = 0, date: str = "1970-01-01T00:00:00Z") -> Archive:
    """An archive of ``pages`` in the new folder ``folder``."""
    if not isinstance(pages.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    spark, work = pages.sparkSession, Scratch(pages.sparkSession)
    body = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        body.alias("payload"))
    digest = F.unhex(F.sha2("payload", 256)).alias("digest")
    # ids of rows with one payload, nulls apart, as a key that is never null
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("-")).alias("key")
    # stored, so that the numbers given here hold for every later stage
    described = work.stored(rows.select(
        F.monotonically_increasing_id().alias("record_no"), "page_id", "url", digest,
        F.octet_length("payload").cast("long").alias("n_bytes"), base32_sha1(F.col("payload")).alias("sha1")),
        "described")
    first = described.groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record_no")).alias("first"))
    first = work.stored(first.select("digest", "first.page_id", "first.record_no"), "first")

    held = first.select("digest", key)
    write_clean(rows.select(digest, key, "payload").groupBy("digest", "key").agg(F.first("payload").alias("payload"))
                .join(held, ["digest", "key"]).select("digest", "payload"),
                f"{folder}/payloads", compression="zstd")

    of = first.select("digest", F.col("page_id").alias("first_id"), F.col("record_no").alias("first_no"))
    revisit = (F.col("record_no") != F.col("first_no")) & (F.col("n_bytes") >= least_revisit)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}"),
                    _line("Content-Length", F.col("n_bytes").cast("string")), F.lit(_CRLF))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    warc = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("record_no"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", _address(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first_id"), F.col("first_no")))),
        _line("WARC-Profile", F.when(
            revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("Content-Type", "application/http;msgtype=response"),
        _line("Content-Length", length.cast("string")),
        F.lit(_CRLF))
    write_clean(described.join(of, "digest").select(
        "record_no", "digest", warc.cast("binary").alias("warc"), http.cast("binary").alias("http")),
        f"{folder}/headers", compression="zstd")
    work.drop("described", "first")
    return Archive(spark, folder)


def _field(name: str, pattern: str) -> Column:
    """A group of a header line; null without the line."""
    return F.nullif(F.regexp_extract(F.col("warc").cast("string"), rf"\r\n{name}: {pattern}\r\n", 1), F.lit(""))


def read(archive: Archive) -> DataFrame:
    """What the records say, held against the stored bytes: record_no, page_id,
    url, payload_bytes, payload_digest, record_type, refers_to, verified (false
    where the payload is absent or is not what its key or the header says)."""
    stored = archive.payloads().select(
        "digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        (F.unhex(F.sha2("payload", 256)) == F.col("digest")).alias("sound"))
    said = archive.headers().select(
        "record_no", "digest",
        _field("WARC-Record-ID", "<urn:page:(-?[0-9]*):[0-9]+>").cast("long").alias("page_id"),
        _field("WARC-Target-URI", "([^\r\n]*)").alias("url"),
        _field("WARC-Payload-Digest", "sha1:([A-Z2-7]{32})").alias("said_digest"),
        _field("WARC-Type", "([a-z]+)").alias("record_type"),
        _field("WARC-Refers-To", "<urn:page:(-?[0-9]*):[0-9]+>").cast("long").alias("refers_to"),
        _field("Content-Length", "([0-9]+)").cast("long").alias("said_length"),
        F.octet_length("http").alias("http_length"))
    block = F.col("http_length") + F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes"))
    right = F.col("sound") & (F.col("payload_digest") == F.col("said_digest")) & (F.col("said_length") == block)
    return said.join(stored, "digest", "left").select(
        "record_no", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to",
        F.coalesce(right, F.lit(False)).alias("verified"))


def records(archive: Archive) -> DataFrame:
    """Each record whole: record_no, record_type, ``record`` (the bytes that a
    WARC file holds) and ``payload`` (a revisit's too, from the store)."""
    crlf = F.lit(_CRLF.encode())
    kind = _field("WARC-Type", "([a-z]+)")
    body = F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return archive.headers().join(archive.payloads(), "digest", "left").select(
        "record_no", kind.alias("record_type"), F.concat("warc", "http", body, crlf, crlf).alias("record"), "payload")
