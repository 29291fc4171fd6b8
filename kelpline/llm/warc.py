"""WARC archives as a PySpark data source, and revisit records for equal payloads.

Reading: the driver plans partitions of whole files, packed to PARTITION_BYTES.
A task reads a record's WARC headers first and applies the predicates that Spark
pushed down (record_type, record_id, target_uri, payload_digest, refers_to by =
and IN). Of a record that fails them, or whose payload is not wanted (option
``payload`` = false), nothing more is decoded: a plain file is positioned past the
block by its Content-Length, a compressed one past the gzip member by the length
in the member's ``sl`` extra field (WARC 1.0, annex D.3). Members without that field
are inflated to their end and dropped.

Writing: each task writes archives of its own under names that no other attempt
has; the driver's commit moves a manifest into place, and readers follow the
manifests, so an attempt that was lost or repeated leaves nothing behind that is
read. In a folder without manifests all ``*.warc`` and ``*.warc.gz`` files are read;
a path may name one such file. Paths are URIs that pyarrow's file systems know
(file, hdfs, s3, gs).

Records whose block is not HTTP have that block as their payload. The length of
an HTTP payload is its Content-Length or, where there is none, that of the body.
A damaged archive (cut off, no number as length, a gzip member of several
records) fails the read and names file and place; option ``damaged`` = skip keeps
the records before the damage and leaves out the rest of that file.

Edges: a null payload is an empty one. A null id is written as such and read as
null. An empty frame gives an archive folder without files. Of equal payloads of
at least MIN_REVISIT bytes the rows with the largest id are responses (all of
them, if that id comes twice) and the others revisits; where no row of a group
has an id, all are responses. Other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)

from .common import scratch, small_side, table

MIN_REVISIT = 0
PARTITION_BYTES = 64 << 20
ARCHIVE_BYTES = 256 << 20
LEVEL = 1
HEADER_BYTES = 2048

SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_digest string, payload_length bigint, refers_to string, payload binary"
)
_HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (pafs.LocalFileSystem(), path)


def _bare(value: str | None) -> str | None:
    """A header's value without angle brackets or the digest's algorithm."""
    if value is None:
        return None
    value = value[1:-1] if value[:1] == "<" else value
    return value[5:] if value.startswith("sha1:") else value


def record(row: dict) -> bytes:
    """A WARC record; the block of a revisit holds the HTTP headers only."""
    payload = row.get("payload") or b""
    length = row.get("payload_length")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if length is None else length}\r\n\r\n".encode()
    block = http if row["record_type"] == "revisit" else http + payload
    head = ["WARC/1.0", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if row.get("target_uri") is not None:
        head.append("WARC-Target-URI: " + "".join(row["target_uri"].splitlines()))
    head.append(f"WARC-Payload-Digest: sha1:{row['payload_digest']}")
    if row["record_type"] == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{row['refers_to']}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member whose extra field holds its compressed and uncompressed length."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + (8).to_bytes(2, "little") + (size & 0xFFFFFFFF).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    tail = zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    return b"\x1f\x8b\x08\x04" + bytes(6) + len(extra).to_bytes(2, "little") + extra + body + tail


def _parsed(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return found


class Damaged(ValueError):
    """An archive that is cut off or malformed."""


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise Damaged(f"a record's length is {value!r}")
    return int(value)


def _http(block, n: int, payload: bool) -> tuple[bytes, int, bytes]:
    """Head and body of an HTTP block of ``n`` bytes, and the payload's length; without ``payload`` only the head is read."""
    limit = None if payload else HEADER_BYTES
    data = block(limit)
    while limit is not None and b"\r\n\r\n" not in data and limit < n:
        limit *= 4
        data = block(limit)
    head, _, body = data.partition(b"\r\n\r\n")
    value = _parsed(head).get("content-length", "")
    return head, int(value) if value.isascii() and value.isdigit() else max(n - len(head) - 4, 0), body


class _Plain:
    """Records of an uncompressed archive."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size

    def records(self) -> Iterator[tuple[dict[str, str], object]]:
        at = 0
        while at < self.size:
            self.source.seek(at)
            data = self.source.read(HEADER_BYTES)
            while b"\r\n\r\n" not in data:
                more = self.source.read(HEADER_BYTES)
                if not more:
                    raise Damaged(f"no end of the headers that start at {at}")
                data += more
            head, _, _ = data.partition(b"\r\n\r\n")
            fields = _parsed(head)
            start, n = at + len(head) + 4, _length(fields)
            if start + n > self.size:
                raise Damaged(f"the record at {at} is cut off")

            def block(limit=None, start=start, n=n):
                self.source.seek(start)
                return self.source.read(n if limit is None else min(n, limit))

            yield fields, block
            at = start + n + 4


class _Gzip:
    """Records of an archive with one gzip member each."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size

    def records(self) -> Iterator[tuple[dict[str, str], object]]:
        at = 0
        while at < self.size:
            self.source.seek(at)
            start = self.source.read(24)
            known = start[3:4] == b"\x04" and start[12:14] == b"sl"
            end = int.from_bytes(start[16:20], "little") if known else None

            if known and (end < 24 or at + end > self.size):
                raise Damaged(f"the member at {at} is cut off")

            def inflated(limit=None, at=at, known=known):
                """The member's data, the first ``limit`` bytes of it; and its length in the file if it was read whole."""
                self.source.seek(at + 24 if known else at)
                inflate = zlib.decompressobj(-15 if known else 31)
                out, read = [], 0
                while not inflate.eof and (limit is None or sum(map(len, out)) < limit):
                    chunk = inflate.unconsumed_tail or self.source.read(1 << 12 if limit else 1 << 16)
                    if not chunk:
                        raise Damaged(f"the member at {at} is cut off")
                    read += 0 if inflate.unconsumed_tail else len(chunk)
                    try:
                        out.append(inflate.decompress(chunk, limit or 0))
                    except zlib.error as problem:
                        raise Damaged(f"the member at {at}: {problem}") from problem
                return b"".join(out), read - len(inflate.unused_data)

            data, _ = inflated(HEADER_BYTES)
            limit = HEADER_BYTES
            while b"\r\n\r\n" not in data:
                if len(data) < limit:
                    raise Damaged(f"no end of the headers that start at {at}")
                limit *= 8
                data, _ = inflated(limit)
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = _parsed(head)
            n = _length(fields)

            def block(limit=None, inflated=inflated, head=len(head) + 4, rest=rest, n=n):
                if limit is not None and len(rest) >= min(limit, n):
                    return rest[: min(limit, n)]
                whole, _ = inflated(None if limit is None else head + limit)
                if limit is None and len(whole) < head + n:
                    raise Damaged("a member is shorter than its record")
                return whole[head : head + n]

            if not known:  # its end shows only when it is inflated
                whole, end = inflated()
                if whole[len(head) + 4 + n :].strip(b"\r\n") or len(whole) < len(head) + 4 + n:
                    raise Damaged(f"the member at {at} does not hold one record")
                del whole
            yield fields, block
            at += end


@dataclass
class Files(InputPartition):
    paths: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.skip_damaged = options.get("damaged", "fail").lower() == "skip"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in _HEADERS and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def partitions(self):
        where, root = _open(self.path)
        files: list[tuple[str, int]] = []
        if where.get_file_info(root).type == pafs.FileType.File:
            found, ours = [where.get_file_info(root)], []
        else:
            found = where.get_file_info(pafs.FileSelector(root, allow_not_found=True))
            ours = [i for i in found if i.base_name.startswith("manifest-") and i.base_name.endswith(".json")]
        for info in ours:
            with where.open_input_stream(info.path) as source:
                files += [(f"{root}/{name}", size) for name, size in json.loads(source.read())]
        if not ours:
            files = [(i.path, i.size) for i in found if i.base_name.endswith((".warc", ".warc.gz"))]
        groups: list[list[tuple[str, int]]] = []
        room = 0
        for name, size in sorted(files):
            if not groups or size > room:
                groups.append([])
                room = PARTITION_BYTES
            groups[-1].append((name, size))
            room -= size
        return [Files(g) for g in groups]

    def read(self, partition):
        if partition is None:
            return
        where, _ = _open(self.path)
        for name, size in partition.paths:
            with where.open_input_file(name) as source:
                try:
                    yield from self._rows((_Gzip if name.endswith(".gz") else _Plain)(source, size))
                except Damaged as problem:
                    if not self.skip_damaged:
                        raise Damaged(f"{name}: {problem}") from problem

    def _rows(self, archive):
        for fields, block in archive.records():
            values = {k: _bare(fields.get(h)) for k, h in _HEADERS.items()}
            if any(values[k] not in allowed for k, allowed in self.wanted.items()):
                continue
            length = _length(fields)
            if fields.get("content-type", "").startswith("application/http"):
                _, length, body = _http(block, length, self.payload)
                payload = body if self.payload and values["record_type"] != "revisit" else None
            else:
                payload = block() if self.payload else None
            yield (*(values[k] for k in ("record_id", "record_type", "target_uri", "payload_digest")), length, values["refers_to"], payload)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]
        self.gzip = options.get("compression", "gzip") == "gzip"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, root = _open(self.path)
        where.create_dir(root, recursive=True)
        files: list[tuple[str, int]] = []
        out, size, name = None, 0, ""
        pack = member if self.gzip else bytes
        try:
            for batch in iterator:
                for row in (r for k in range(0, batch.num_rows, 256) for r in batch.slice(k, 256).to_pylist()):
                    if out is not None and size >= ARCHIVE_BYTES:
                        out.close()
                        files.append((name, size))
                        out = None
                    if out is None:
                        name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
                        out = where.open_output_stream(f"{root}/{name}", compression=None)
                        info = b"software: kelpline\r\nformat: WARC File Format 1.0\r\n"
                        head = f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
                        size = out.write(pack(head.encode() + info + b"\r\n\r\n"))
                    size += out.write(pack(record(row)))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            files.append((name, size))
        return Written(files)

    def commit(self, messages) -> None:
        where, root = _open(self.path)
        where.create_dir(root, recursive=True)
        draft = f"{root}/draft-{uuid.uuid4().hex}"
        with where.open_output_stream(draft) as out:
            out.write(json.dumps([f for m in messages if m is not None for f in m.files]).encode())
        where.move(draft, f"{root}/manifest-{uuid.uuid4().hex}.json")

    def abort(self, messages) -> None:
        where, root = _open(self.path)
        for name, _ in [f for m in messages if m is not None for f in m.files]:
            where.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """Format ``warc``; options path, payload (read), compression (write: gzip or none)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _base32_column(digest):
    """Base32 of a 40-digit hexadecimal column: each 5 digits are 4 characters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for k in range(8):
        v = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        parts += [F.substring(letters, (F.shiftright(v, shift).bitwiseAND(31) + 1), F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*parts)


def records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows of SCHEMA for ``pages``: one response or revisit each."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"sha": F.sha1("payload"), "payload_length": F.octet_length("payload").cast("long")})
    groups = rows.groupBy("sha").agg(F.max("id").alias("best"), F.count("*").alias("n"), F.first("payload_length").alias("size"))
    shared = groups.where((F.col("n") > 1) & F.col("best").isNotNull() & (F.col("size") >= MIN_REVISIT)).select("sha", "best")
    joined = rows.join(small_side(shared), "sha", "left")
    again = F.col("best").isNotNull() & F.coalesce(F.col("id") != F.col("best"), F.lit(True))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return joined.select(
        name(F.col("id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        _base32_column(F.col("sha")).alias("payload_digest"),
        "payload_length",
        F.when(again, name(F.col("best"))).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def archive(pages: DataFrame, path: str, **columns: str) -> None:
    """Writes ``pages`` as WARC archives under ``path``."""
    register(pages.sparkSession)
    records(pages, **columns).write.format("warc").mode("append").save(path)


def query(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    archive(table(spark, sf_dir, "pages"), path)
    back = spark.read.format("warc").option("payload", "false").load(path).where(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1).try_cast("bigint")
    return back.select(
        number("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


_CODE = " + ".join(f"(strpos('0123456789abcdef', substr(sha, 5 * k + {i + 1}, 1)) - 1) * {16 ** (4 - i)}" for i in range(5))
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS sha, max(page_id) OVER (PARTITION BY html) AS best FROM p),
v AS (SELECT page_id, k, {_CODE} AS v FROM d, (SELECT unnest(range(8)) AS k)),
b AS (SELECT page_id, string_agg(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32768 % 32 AS INT) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 1024 % 32 AS INT) + 1, 1)
     || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32 % 32 AS INT) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v % 32 AS INT) + 1, 1), '' ORDER BY k) AS payload_digest
      FROM v GROUP BY page_id)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM d JOIN b USING (page_id)
"""
