"""The archive against plain hashing, and its records against a plain WARC reader."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tradestar.llm.warc import Archive, read, records, write
from tradestar.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, record_no string"


def archive_of(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return write(df, scratch_path(spark, "test_warc"), **options)


def sha1(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def parsed(raw):
    """A WARC record's fields, HTTP header and body."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split("\r\n")
    assert first == "WARC/1.1"
    fields = dict(x.split(": ", 1) for x in lines)
    n = int(fields["Content-Length"])
    assert rest[n:] == b"\r\n\r\n"
    http, body = rest[:n].split(b"\r\n\r\n", 1)
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), body


ROWS = [(5, "http://a/5", "same"), (3, "http://a/3", "same"), (9, None, "same"), (4, "http://a/é b", "öther"),
        (7, "http://a/7", None), (6, "http://a/6", ""), (8, "x\r\nWARC-Type: revisit", "long " * 400_000),
        (None, "u", "same"), (None, "u", "alone"), (-2, "u", "neg"), (-1, "u", "neg")]


def test_against_plain_hashing(spark):
    got = read(archive_of(spark, ROWS)).collect()
    assert len(got) == len(ROWS) and all(r.verified for r in got)
    raws = {}
    for i, _, html in ROWS:
        raws.setdefault((html or "").encode(), []).append(i)
    want = []
    for i, _, html in ROWS:
        raw = (html or "").encode()
        first = min((x for x in raws[raw] if x is not None), default=None)
        want.append((i, len(raw), sha1(raw), "response" if i == first else "revisit", None if i == first else first))
    assert sorted(map(str, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                            for r in got))) == sorted(map(str, want))


def test_payloads_are_stored_once(spark):
    archive = archive_of(spark, ROWS * 3)
    held = [bytes(r.payload) for r in archive.payloads().collect()]
    assert sorted(held) == sorted({(h or "").encode() for _, _, h in ROWS})


def test_repeated_rows_have_one_response(spark):
    got = read(archive_of(spark, [(1, "u", "x")] * 5 + [(2, "u", "x")])).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to or 0) for r in got) == [
        (1, "response", 0), *[(1, "revisit", 1)] * 4, (2, "revisit", 1)]


def test_short_payloads_are_responses(spark):
    archive = archive_of(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], least_revisit=3)
    got = {r.page_id: (r.record_type, r.refers_to, r.verified) for r in read(archive).collect()}
    assert got == {1: ("response", None, True), 2: ("response", None, True), 3: ("response", None, True),
                   4: ("revisit", 3, True)}
    assert archive.payloads().count() == 2


def test_records_are_warc(spark):
    archive = archive_of(spark, ROWS)
    bodies = {i: (h or "").encode() for i, _, h in ROWS if i is not None}
    seen = 0
    for r in records(archive).collect():
        fields, http, body = parsed(bytes(r.record))
        i = fields["WARC-Record-ID"].split(":")[2]
        if not i:
            continue
        seen += 1
        raw = bodies[int(i)]
        assert fields["WARC-Payload-Digest"] == "sha1:" + sha1(raw) and bytes(r.payload) == raw
        assert int(http["Content-Length"]) == len(raw)
        assert fields["WARC-Type"] == r.record_type and body == (raw if r.record_type == "response" else b"")
        assert ("WARC-Refers-To" in fields) == (r.record_type == "revisit")
        if i == "8":
            assert fields["WARC-Target-URI"] == "x%0D%0AWARC-Type:%20revisit"
        assert ("WARC-Target-URI" in fields) == (i != "9")
    assert seen == len(bodies)


def test_damaged_store_is_seen(spark):
    archive = archive_of(spark, ROWS)
    folder = scratch_path(spark, "test_warc")
    archive.headers().write.parquet(f"{folder}/headers")
    archive.payloads().filter("payload != cast('neg' as binary)").withColumn(
        "payload", F.when(F.expr("payload = cast('alone' as binary)"), F.lit(b"alonf")).otherwise(F.col("payload"))
    ).write.parquet(f"{folder}/payloads")
    bad = read(Archive(spark, folder)).filter("not verified").select("page_id", "payload_bytes").collect()
    assert sorted(map(str, map(tuple, bad))) == sorted(map(str, [(-2, None), (-1, None), (None, 5)]))


def test_empty_table_and_odd_ids(spark):
    assert read(archive_of(spark, [])).collect() == []
    with pytest.raises(TypeError):
        write(spark.createDataFrame([("a", "u", "x")], "page_id string, url string, html string"), "unused")
