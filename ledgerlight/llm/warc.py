"""WARC archives written and read back through a chunked record table (operator 13).

``chunk_table`` cuts every payload into rows (record number, chunk number) of
at most CHUNK bytes; from there on no row holds a whole oversized payload.
``write`` turns each chunk into one WARC/1.1 record and lets Spark's text
writer put the record ends between them, so the files are plain (gzipped) WARC
files: a payload of one chunk is a ``response`` record, a longer one is
segmented by the standard's rules (``WARC-Segment-Number`` and ``continuation``
records), and a repeated payload of at least LEAST_COPY bytes is a ``revisit``
of the record with the largest page_id.

``read_chunks`` parses archives as a byte stream, one gzipped file after
another in a task, and holds at most a chunk. ``read_records`` deals the chunks
by record and sorts them by number in the shuffle; the SHA-1 goes on from chunk
to chunk, so a payload is never put together in memory. Only payloads of
several chunks carry their bytes through that shuffle.

Defined results: a null or empty html is an empty payload (a response); html
may hold any bytes, record ends included; a null url has no target; a null
page_id is a record without one, is smaller than any other, and its copies
refer to the largest page_id if there is one. Of repeated rows with equal
payload and the largest page_id one is the response and the others revisit
that page_id. Very long payloads are segments. An empty table gives archives
without records and an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import small_batches, stored

CHUNK = 1 << 16             # payload bytes of a chunk
LEAST_COPY = 1000           # payload bytes from which copies are revisits
FILE_RECORDS = 1 << 12      # records of an archive: 256 MB at most before compression
DATE = "2020-01-01T00:00:00Z"       # no capture time in the tables: a fixed one, so reruns write the same bytes
END = "\r\n\r\n"            # ends a header, and a record

CHUNKS = ("record_id string, segment int, part int, page_id long, target_uri string, record_type string, refers_to long, "
          "whole_bytes long, declared string, intact boolean, length long, sha1 string, data binary")
RECORDS = ("record_id string, page_id long, target_uri string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, verified boolean")


# ---------------------------------------------------------------- writing
def chunk_table(spark: SparkSession, pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Stored (rid, page_id, url, bytes, digest, chunk_no, chunks, data): one row per chunk, at least one per page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("digest"))
    rows = rows.select("*", F.greatest(F.lit(1), F.ceil(F.col("bytes") / chunk)).cast("int").alias("chunks"))
    cut = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk_no"))
    return stored(spark, cut.select("rid", "page_id", "url", "bytes", "digest", "chunks", "chunk_no",
                                    F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data")), "warc-chunks")


def _urn(page_id: Column, rid: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), rid.cast("string"), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """One header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def write(spark: SparkSession, pages: DataFrame, path: str, chunk: int = CHUNK, least_copy: int = LEAST_COPY) -> str:
    """Writes one WARC record per page (and its continuations) below ``path``."""
    chunks = chunk_table(spark, pages, chunk)
    # Payloads that occur again, by digest and length: a few bytes a payload, stored so that its size is known to the join.
    again = stored(spark, chunks.filter((F.col("chunk_no") == 0) & (F.col("bytes") >= least_copy)).groupBy("digest", "bytes")
                   .agg(F.max(F.struct("page_id", (-F.col("rid")).alias("back"))).alias("first"), F.count("*").alias("n"))
                   .filter("n > 1").select("digest", "bytes", F.col("first.page_id").alias("first_id"), (-F.col("first.back")).alias("first_rid")),
                   "warc-copies")
    copy = F.col("first_rid").isNotNull() & (F.col("first_rid") != F.col("rid"))
    rows = chunks.join(again, ["digest", "bytes"], "left").withColumn("copy", copy).filter("chunk_no = 0 or not copy")
    own, more, parts = _urn(F.col("page_id"), F.col("rid")), F.col("chunk_no") > 0, (F.col("chunks") > 1) & ~F.col("copy")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = (F.when(more, F.col("data")).when(F.col("copy"), http.cast("binary"))
             .otherwise(F.concat(http.cast("binary"), F.col("data"))))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    rows = rows.select("*", block.alias("block"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(more, "continuation").when(F.col("copy"), "revisit").otherwise("response")),
        _field("WARC-Record-ID", F.when(more, F.concat(F.expr("substring(rid_urn, 1, length(rid_urn) - 1)"), F.lit(":"), F.col("chunk_no").cast("string"), F.lit(">")))
               .otherwise(F.col("rid_urn"))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", uri),
        _field("WARC-Payload-Digest", F.when(~more, F.concat(F.lit("sha1:"), F.col("digest")))),
        _field("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1("block"))),
        _field("WARC-Profile", F.when(F.col("copy"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _field("WARC-Refers-To", F.when(F.col("copy"), _urn(F.col("first_id"), F.col("first_rid")))),
        _field("WARC-Segment-Number", F.when(parts, F.col("chunk_no") + 1)),
        _field("WARC-Segment-Origin-ID", F.when(more, F.col("rid_urn"))),
        _field("WARC-Segment-Total-Length", F.when(parts & (F.col("chunk_no") == F.col("chunks") - 1), F.octet_length(http) + F.col("bytes"))),
        _field("Content-Type", F.when(~more, "application/http;msgtype=response")),
        _field("Content-Length", F.octet_length("block")),
        F.lit("\r\n"))
    record = rows.withColumn("rid_urn", own).select(F.concat(header.cast("binary"), F.col("block")).cast("string").alias("value"))
    (record.write.mode("overwrite").option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))
    return path


# ---------------------------------------------------------------- reading
class _Parser:
    """Bytes of one archive in, chunk rows out; holds a header or a chunk, never a record."""

    def __init__(self, name: str, chunk: int, keep: bool):
        self.name, self.chunk, self.keep = name, chunk, keep
        self.buf, self.left, self.head = bytearray(), 0, None

    def feed(self, data: bytes) -> Iterator[tuple]:
        self.buf += data
        while True:
            if self.head is None:
                while self.buf[:2] == b"\r\n":          # record ends
                    del self.buf[:2]
                at = self.buf.find(b"\r\n\r\n")
                if at < 0:
                    return
                self._open(bytes(self.buf[:at]))
                del self.buf[:at + 4]
            if self.http:                               # the block's own header, before the payload
                at = self.buf.find(b"\r\n\r\n", 0, self.left)
                if at < 0 and len(self.buf) < self.left:
                    return
                if at >= 0:
                    length = re.search(rb"(?im)^content-length:\s*(\d+)", bytes(self.buf[:at]))
                    self.whole = int(length[1]) if length else None
                    yield from self._take(at + 4, payload=False)
                self.http = False
            while self.left and self.buf:
                n = min(self.left, len(self.buf), self.chunk - len(self.part))
                yield from self._take(n, payload=True)
            if self.left:
                return
            yield self._row(last=True)
            self.head = None

    def close(self) -> None:
        if self.head is not None or self.buf.strip(b"\r\n"):
            raise ValueError(f"archive {self.name} ends within a record")

    def _open(self, text: bytes) -> None:
        version, *lines = text.decode("utf-8", "replace").split("\r\n")
        self.head = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines))
        if not version.startswith("WARC/") or not self.head.get("content-length", "").isdigit():
            raise ValueError(f"archive {self.name} holds no WARC record where one must start")
        self.left = int(self.head["content-length"])
        self.http = self.head.get("content-type", "").startswith("application/http")
        self.part, self.parts, self.whole = bytearray(), 0, None
        self.block, self.sha = hashlib.sha1(), hashlib.sha1()

    def _take(self, n: int, payload: bool) -> Iterator[tuple]:
        piece = bytes(self.buf[:n])
        del self.buf[:n]
        self.left -= n
        self.block.update(piece)
        if payload:
            self.sha.update(piece)
            self.part += piece
            if len(self.part) >= self.chunk and self.left:
                yield self._row(last=False)
                self.part, self.parts = bytearray(), self.parts + 1

    def _row(self, last: bool) -> tuple:
        h, number = self.head, int(self.head.get("warc-segment-number", 0))
        single = last and not self.parts and not number
        told = h.get("warc-block-digest", "")
        intact = not last or not told or told == "sha1:" + self.block.hexdigest()
        return (h.get("warc-segment-origin-id") or h.get("warc-record-id"), number, self.parts, _page(h.get("warc-record-id")), h.get("warc-target-uri"),
                h.get("warc-type"), _page(h.get("warc-refers-to")), self.whole, h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                intact, len(self.part), self.sha.hexdigest() if single else None, bytes(self.part) if self.keep or not single else None)


def _page(urn: str | None) -> int | None:
    m = re.match(r"<urn:page:(-?\d+):", urn or "")
    return int(m[1]) if m else None


def read_chunks(spark: SparkSession, path: str, chunk: int = CHUNK, keep_data: bool = True) -> DataFrame:
    """One row per chunk of every record below ``path``: where it belongs, its length and its bytes.

    ``keep_data=False`` leaves out the bytes of records that are one chunk, whose SHA-1 the row has already.
    Files must be gzipped, so that one task reads a file from its start. A file that is no WARC archive fails the job.
    """
    small_batches(spark)
    # The separator is put back between the pieces: Spark only cuts the stream, the parser decides what a piece is.
    pieces = (spark.read.schema("value string").option("lineSep", END).text(path)
              .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")))
    schema = CHUNKS

    def parse(batches):
        parser, names = None, [c.split()[0] for c in schema.split(", ")]
        arrow = pa.schema([pa.field(n, t) for n, t in zip(names, _ARROW_CHUNKS)])
        for b in batches:
            rows, held = [], 0
            for name, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if parser is None or parser.name != name:
                    if parser is not None:
                        parser.close()
                    parser = _Parser(name, chunk, keep_data)
                for row in parser.feed(value + b"\r\n\r\n"):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if held > 1 << 24:
                        yield _batch(rows, arrow)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, arrow)
        if parser is not None:
            parser.close()

    return pieces.mapInArrow(parse, schema)


_ARROW_CHUNKS = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(),
                 pa.int64(), pa.string(), pa.binary()]
_ARROW_RECORDS = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_records(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """(record_id, page_id, target_uri, record_type, refers_to, payload_bytes, payload_digest, verified) per page record below ``path``.

    Length and digest are of the payload as read; of a revisit, which has none, as its header tells them.
    ``verified``: every block digest and the payload digest are what the headers tell.
    """
    chunks = read_chunks(spark, path, chunk, keep_data=False)
    ordered = chunks.repartition("record_id").sortWithinPartitions("record_id", "segment", "part")
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def digest(batches):
        arrow = pa.schema([pa.field(n, t) for n, t in zip(names, _ARROW_RECORDS)])
        first, size, sha, intact = None, 0, None, True

        def record():
            (rid, _, _, page, uri, kind, refers, whole, declared, _, _, single, _) = first
            got = single or sha.hexdigest()
            if kind == "revisit":
                return rid, page, uri, kind, refers, whole, declared, intact
            return rid, page, uri, kind, refers, size, got, intact and declared in (None, got) and whole in (None, size)

        for b in batches:
            rows = []
            for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                if first is None or row[0] != first[0]:
                    if first is not None:
                        rows.append(record())
                    first, size, sha, intact = row, 0, hashlib.sha1(), True
                size += row[10]
                intact = intact and row[9]
                if row[12]:
                    sha.update(row[12])
            if rows:
                yield _batch(rows, arrow)
        if first is not None:
            yield _batch([record()], arrow)

    return ordered.mapInArrow(digest, RECORDS)


def archive(spark: SparkSession, pages: DataFrame, path: str | None = None, chunk: int = CHUNK, least_copy: int = LEAST_COPY) -> DataFrame:
    """Writes the archives of ``pages`` (below ``path``, or in the shared scratch folder) and reads their records back."""
    path = write(spark, pages, path or scratch_path(spark, "warc"), chunk, least_copy)
    return read_records(spark, path, chunk)
