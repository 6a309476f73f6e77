"""WARC archives: exact round trips over chunk sizes, copies, edge rows, and files that other readers understand."""

import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import warc
from ledgerlight.session import scratch_path

SCHEMA = "page_id long, url string, html string"


def awkward():
    rng = random.Random(6)
    big = "".join(rng.choice("abc é\r\n") for _ in range(5000))
    rows = [(i, f"http://h/{i}", "x" * rng.randrange(1500)) for i in range(60)]
    rows += [(100 + i, "http://copy", big) for i in range(40)] + [(200, "u", "y" * 1000), (201, "u", "y" * 1000), (202, "u", "z" * 999), (203, "u", "z" * 999)]
    rows += [(300, None, None), (301, "a\r\nWARC-Type: x", ""), (302, "u", "\r\n"), (303, "u", "\r\n\r\n"), (304, "u", "WARC/1.1\r\nContent-Length: 9\r\n\r\n" * 200),
             (305, "u", "\r\n" * 3000), (306, "u", "\r" * 2500), (307, "u", "é" * 700), (None, "u", big), (None, "u", "n" * 1200), (None, "u", "n" * 1200),
             (400, "u", "t" * 2000), (400, "v", "t" * 2000), (399, "u", "t" * 2000), (-5, "u", "t" * 2000)]
    return rows


def plain(rows, least=1000):
    groups = {}
    for k, (page, _, html) in enumerate(rows):
        if len((html or "").encode()) >= least:
            groups.setdefault(html, []).append(k)
    first = {h: max(ks, key=lambda k: (rows[k][0] is not None, rows[k][0] or 0)) for h, ks in groups.items()}
    out = []
    for k, (page, _, html) in enumerate(rows):
        data = (html or "").encode()
        keep = first.get(html, k)
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if keep == k else "revisit", None if keep == k else rows[keep][0]))
    return sorted(out, key=str)


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("rid", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("chunks", F.lit(9))


@pytest.mark.parametrize("chunk", [7, 64, 1000, 1 << 16])
def test_archives_read_back_what_was_written(spark, chunk):
    rows = awkward()
    got = warc.archive(spark, pages(spark, rows), chunk=chunk)
    assert got.filter("not verified").count() == 0
    out = sorted((tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    assert out == plain(rows)
    assert got.select("record_id").distinct().count() == len(rows)


def test_chunks_hold_the_payloads(spark, monkeypatch):
    rows, chunk = awkward(), 333
    monkeypatch.setattr(warc, "FILE_RECORDS", 20)               # segments of a record lie in different files
    path = warc.write(spark, pages(spark, rows), scratch_path(spark, "warc-test"), chunk)
    assert len(glob.glob(path.removeprefix("file:") + "/*.gz")) > 10
    parts = sorted(warc.read_chunks(spark, path, chunk).collect(), key=lambda r: (r.record_id, r.segment, r.part))
    assert max(len(r.data) for r in parts) <= chunk
    whole = {}
    for r in parts:
        whole[r.record_id] = whole.get(r.record_id, b"") + bytes(r.data)
    held = {r.record_id for r in parts if r.record_type == "response"}
    want = [r for r in plain(rows) if r[3] == "response"]
    assert sorted(hashlib.sha1(whole[k]).hexdigest() for k in held) == sorted(r[2] for r in want)


def test_files_are_warc(spark):
    rows = awkward()
    path = warc.write(spark, pages(spark, rows), scratch_path(spark, "warc-test"), 1 << 10)
    kinds = []
    for f in glob.glob(path.removeprefix("file:") + "/*.gz"):
        data, at = gzip.open(f).read(), 0
        while at < len(data):                                    # the standard's grammar: header, block, two line ends
            end = data.index(b"\r\n\r\n", at)
            version, *lines = data[at:end].decode().split("\r\n")
            head = dict(line.split(": ", 1) for line in lines)
            assert version == "WARC/1.1" and len(head) == len(lines) and {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(head)
            block = data[end + 4:end + 4 + int(head["Content-Length"])]
            assert head["WARC-Block-Digest"] == "sha1:" + hashlib.sha1(block).hexdigest()
            at = end + 4 + len(block)
            assert data[at:at + 4] == b"\r\n\r\n"
            at += 4
            kinds.append(head["WARC-Type"])
    assert set(kinds) == {"response", "revisit", "continuation"} and len(kinds) - kinds.count("continuation") == len(rows)


def archive_file(tmp_path, data):
    path = str(tmp_path / "foreign")
    (tmp_path / "foreign").mkdir()
    with gzip.open(f"{path}/a.warc.gz", "wb") as f:
        f.write(data)
    return path


def test_foreign_records_are_cut_into_chunks(spark, tmp_path):
    body = b"\x00\xff\r\n\r\n" * 400
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 3\r\n\r\na=b\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    big = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % (len(http) + len(body))
    path = archive_file(tmp_path, info + big + http + body + b"\r\n\r\n")
    chunks = warc.read_chunks(spark, path, 100).filter("record_type = 'response'").orderBy("part").collect()
    assert b"".join(bytes(c.data) for c in chunks) == body and max(c.length for c in chunks) == 100
    got = {r.record_id: r for r in warc.read_records(spark, path, 100).collect()}
    assert got["<urn:uuid:2>"].payload_digest == hashlib.sha1(body).hexdigest() and got["<urn:uuid:2>"].verified and got["<urn:uuid:1>"].payload_bytes == 3


@pytest.mark.parametrize("data", [b"no archive\r\n\r\nat all", b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 90\r\n\r\nshort"])
def test_broken_archives_fail(spark, tmp_path, data):
    with pytest.raises(Exception, match="archive"):
        warc.read_records(spark, archive_file(tmp_path, data)).collect()


def test_damaged_payload_is_not_verified(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5:1>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 3\r\n\r\nabd\r\n\r\n"
    path = archive_file(tmp_path, record % hashlib.sha1(b"abc").hexdigest().encode())
    row = warc.read_records(spark, path).first()
    assert row.page_id == 5 and not row.verified


def test_empty_table(spark):
    assert warc.archive(spark, spark.createDataFrame([], SCHEMA)).count() == 0
