import gzip
import hashlib

import pytest

from meterline.llm import warc
from meterline.llm.common import scratch
from tests.llm.inputs import SMALL
from tests.oracle_compare import database, differences

V1 = (b"filedesc://a.arc 0.0.0.0 20010203040506 text/plain 61\n"
      b"1 0 Someone\nURL IP-address Archive-date Content-type Archive-l\n\n"
      b"http://a.example/ 10.0.0.1 20010203040507 text/html 37\n"
      b"HTTP/1.0 200 OK\r\nX-Page-Id: 5\r\n\r\nbody\n"
      b"dns:a.example 10.0.0.2 200102030405 text/dns 7\nA 1\n\nB \n")


def test_version_one():
    head, page, dns = warc.arc_records(V1.replace(b" 61\n", b" %d\n" % len(V1.split(b"\n\nhttp")[0].split(b"\n", 1)[1])))
    assert page[1]["URL"] == "http://a.example/" and page[2].endswith(b"body")
    assert dns[2] == b"A 1\n\nB "
    record = warc._record("a.arc", dns[0], dns[1], dns[2], False)
    assert (record["type"], record["payload"]) == ("resource", b"A 1\n\nB ")
    assert record["fields"][0] == {"name": "WARC-Date", "value": "2001-02-03T04:05:00Z"}
    record = warc._record("a.arc", page[0], page[1], page[2], False)
    assert (record["type"], record["page_id"], record["payload"]) == ("response", 5, b"body")
    assert record["record_id"] == warc._record("a.arc", page[0], page[1], page[2], True)["record_id"]
    assert warc._record("a.arc", *head[:2], head[2], False)["type"] == "warcinfo"


def test_version_two_and_broken_archives():
    about = b"2 0 Someone\n"
    start = b"filedesc://a.arc 0.0.0.0 20010203040506 text/plain 200 - - 0 a.arc %d\n" % len(about) + about + b"\n"
    page = b"http://a/ 1.1.1.1 20010203040507 text/html 404 abc - 99 a.arc 3\nx\ny\n"
    for data in (start + page, gzip.compress(start) + gzip.compress(page)):
        rows = list(warc.arc_records(data))
        assert rows[1][1]["Result-code"] == "404" and rows[1][2] == b"x\ny"
    for bad in (b"http://a/ x\n", start.replace(b"2 0 ", b"7 0 "), start + page[:-3], start + b"too few fields 3\nabc\n"):
        with pytest.raises(ValueError):
            list(warc.arc_records(bad))
    assert list(warc.arc_records(b"")) == []


@pytest.mark.parametrize("stamp,date", [
    ("20010203040506", "2001-02-03T04:05:06Z"), ("20010203", "2001-02-03T00:00:00Z"),
    ("20019903040506", "1970-01-01T00:00:00Z"), ("", "1970-01-01T00:00:00Z")])
def test_dates(stamp, date):
    assert warc.warc_date(stamp) == date


def pages_of(spark):
    big = "p" * 1200
    trap = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\nhttp://e 0 0 t 3\nabc" * 30
    rows = [(1, "http://a", big), (2, "http://b b\n", big), (7, None, big), (3, "u", "small"), (4, "u", "small"),
            (5, "", None), (6, "dns:x", ""), (8, "http://c", trap), (9, "http://d", trap + "é😀"), (None, "n", big),
            (11, "http://c", "q" * 2000), (11, "http://c", "q" * 2000), (12, "l", "é" * 300_000)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string")


def test_pages_come_back(spark):
    found = {}
    for r in warc.page_archives(pages_of(spark).repartition(3)).collect():
        found.setdefault(r["page_id"], []).append(r)
    for r in pages_of(spark).collect():
        data = (r["html"] or "").encode()
        for back in found[r["page_id"]]:
            assert (back["payload_bytes"], back["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
    kind = {i: sorted((r["record_type"], r["refers_to"]) for r in rs) for i, rs in found.items()}
    assert kind[1] == kind[2] == kind[None] == [("revisit", 7)] and kind[7] == [("response", None)]
    assert kind[11] == [("response", None), ("revisit", 11)]
    assert all(kind[i] == [("response", None)] for i in (3, 4, 5, 6, 8, 9, 12))
    assert sum(map(len, found.values())) == 13
    assert warc.page_archives(pages_of(spark).limit(0)).count() == 0


def test_records_keep_their_contents(spark):
    arc, out = scratch(spark, "arc"), scratch(spark, "warc")
    warc.write_arc(pages_of(spark).coalesce(1), arc)
    warc.convert(spark, arc, out)
    payloads = []
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out).collect():
        for fields, block in warc.warc_records(bytes(r["content"])):
            assert fields["warc-record-id"].startswith("<urn:uuid:") and fields["warc-date"].endswith("Z")
            head, payload = warc.split_http(block)
            if fields["warc-type"] == "response":
                payloads.append(payload.decode())
            elif fields["warc-type"] == "revisit":
                assert not payload and fields["warc-profile"] == warc.REVISIT_PROFILE
    want = [r["html"] or "" for r in pages_of(spark).collect()]
    assert set(payloads) == set(want)


def test_pages_table_equals_sql(spark):
    from meterline.llm import queries
    assert differences(queries.archives(spark, SMALL), database(SMALL), queries.ORACLE_SQL["op2_warc"])[1:] == ([], [])
