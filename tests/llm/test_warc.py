import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from kelpline.llm import registry, warc

from tests.oracle import same

PAGES = "page_id long, url string, html string, payload string, id int"


def test_query_matches_sql(spark, sf):
    assert same(warc.query(spark, sf), registry.ORACLES["op6_warc"], sf) >= 50


def test_members_are_plain_gzip():
    data = warc.record({"record_type": "response", "record_id": "urn:page:1", "payload": b"x" * 9000, "payload_digest": "D"})
    packed = warc.member(data)
    assert gzip.decompress(packed) == data
    assert int.from_bytes(packed[16:20], "little") == len(packed)
    other = gzip.compress(data)  # a member without the skip length
    stream = packed + other + packed
    got = [(f["warc-record-id"], b()) for f, b in warc._Gzip(io.BytesIO(stream), len(stream)).records()]
    assert len(got) == 3 and all(b.endswith(b"\r\n\r\n" + b"x" * 9000) for _, b in got)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_path, compression):
    rows = [
        (1, "http://a/ü", "<p>same", "clash", 5), (2, None, "<p>same", None, None), (3, "http://c", None, None, None), (4, "http://d", "", None, None),
        (5, "http://e", "ä" * 300000, None, None), (None, "http://f", "<p>same", None, None), (None, "http://g", "alone", None, None), (2, "http://b2", "<p>same", None, None),
    ]
    path = f"file://{tmp_path}/w"
    warc.register(spark)
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    warc.records(pages).write.format("warc").option("compression", compression).mode("append").save(path)
    back = spark.read.format("warc").load(path).where(F.col("record_type") != "warcinfo").collect()
    got = sorted((r.record_id, r.record_type, r.refers_to or "", bytes(r.payload or b"").decode(), r.payload_length) for r in back)
    u = "urn:page:"
    assert got == sorted(
        [
            (u + "1", "revisit", u + "2", "", 7), (u + "2", "response", "", "<p>same", 7), (u + "2", "response", "", "<p>same", 7),
            (u + "3", "revisit", u + "4", "", 0), (u + "4", "response", "", "", 0), (u + "5", "response", "", "ä" * 300000, 600000),
            (u, "revisit", u + "2", "", 7), (u, "response", "", "alone", 5),
        ]
    )
    for r in back:
        if r.record_type == "response":
            assert r.payload_digest == warc.base32(hashlib.sha1(bytes(r.payload)).hexdigest())
    some = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'revisit' and record_id in ('urn:page:1', 'urn:page:5')")
    assert [(r.record_id, r.payload) for r in some.collect()] == [("urn:page:1", None)]


def test_uncommitted_files_are_not_read_and_empty_frames(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.archive(spark.createDataFrame([], PAGES), path)
    (tmp_path / "w" / "part-lost.warc.gz").write_bytes(b"half a file")
    assert spark.read.format("warc").load(path).collect() == []


def foreign():
    """Records as other software writes them: resource, long HTTP heads, no HTTP length, odd header bytes."""
    head = lambda kind, n, rest: f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{kind}>\r\n{rest}Content-Length: {n}\r\n\r\n".encode()
    long = b"HTTP/1.1 200 OK\r\nX-Pad: " + b"p" * 5000 + b"\r\nContent-Length: 4\r\n\r\nbody"
    bare = b"HTTP/1.0 200 OK\r\n\r\nno length"
    http = "Content-Type: application/http; msgtype=response\r\n"
    odd = head("metadata", 3, "").replace(b"Content-Length", b"X-\xff\xfe: 1\r\nContent-Length")
    return [
        head("resource", 5, "Content-Type: text/plain\r\n") + b"plain\r\n\r\n", head("response", len(long), http) + long + b"\r\n\r\n",
        head("conversion", len(bare), http) + bare + b"\r\n\r\n", odd + b"abc\r\n\r\n",
    ]


WANT = [("conversion", 9, b"no length"), ("metadata", 3, b"abc"), ("resource", 5, b"plain"), ("response", 4, b"body")]


@pytest.mark.parametrize("pack, name", [(bytes, "a.warc"), (gzip.compress, "a.warc.gz"), (warc.member, "a.warc.gz")])
def test_archives_of_other_software(spark, tmp_path, pack, name):
    (tmp_path / name).write_bytes(b"".join(map(pack, foreign())))
    warc.register(spark)
    for path in (f"file://{tmp_path}", f"file://{tmp_path}/{name}"):
        got = spark.read.format("warc").load(path).collect()
        assert sorted((r.record_type, r.payload_length, bytes(r.payload)) for r in got) == WANT
    heads = spark.read.format("warc").option("payload", "false").load(f"file://{tmp_path}").collect()
    assert sorted((r.record_type, r.payload_length) for r in heads) == [w[:2] for w in WANT]
    assert all(r.payload is None for r in heads)


@pytest.mark.parametrize("name", ["cut.warc", "cut.warc.gz", "length.warc", "several.warc.gz"])
def test_damaged_archives(spark, tmp_path, name):
    parts = foreign()
    data = {
        "cut.warc": parts[0] + parts[1][:-20], "cut.warc.gz": gzip.compress(parts[0]) + gzip.compress(parts[1])[:-20],
        "length.warc": parts[0] + parts[3].replace(b"Length: 3", b"Length: x"), "several.warc.gz": gzip.compress(parts[0]) + gzip.compress(parts[1] + parts[2]),
    }[name]
    (tmp_path / name).write_bytes(data)
    warc.register(spark)
    with pytest.raises(Exception, match=name):
        spark.read.format("warc").load(f"file://{tmp_path}").collect()
    kept = spark.read.format("warc").option("damaged", "skip").load(f"file://{tmp_path}").collect()
    assert [r.record_type for r in kept] == ["resource"]
