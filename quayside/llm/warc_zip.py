"""WARC archives packaged in ZIP files: a writer and a range reader.

Package layout: ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (one line per record with its offset and length), both stored
without further compression, so a record is a byte range of the ZIP file.

Reading parses the end-of-central-directory record, the ZIP64 locator and
record where present, the central directory with ZIP64 extra fields, and the
local header of a member, all by range reads; then the index member, and then
only the ranges of the records. Nothing is extracted.

Writing: every task rolls its records into packages of about ``package_bytes`` under
the shared folder, each under a name of its own attempt. The manifest is a table
that Spark commits, so packages of failed or repeated attempts are never
read. Files are reached through ``pyarrow.fs`` by the scheme of their path.

Records: of equal payloads (at least ``least_bytes``) the one with the smallest
page id is a ``response``; the others are ``revisit`` records that name it and carry no
payload. Defined results: a null html is an empty payload; rows with a null
page id come after all ids; of repeated rows (same id, equal payload) one is the
response and the others revisit it; smaller payloads are all responses; an
empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm import util as U

PACKAGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
LEVEL = 3
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(path: str):
    """The file system of a path and the path inside it."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


# --- writing -------------------------------------------------------------------

def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, twin: int, url: str | None, payload: bytes, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    def urn(i, n):
        return f"<urn:x-page:{'none' if i is None else i}:{n}>"

    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": urn(page_id, twin),
        "WARC-Date": DATE,
        "WARC-Target-URI": urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else "about:blank",
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    block = HTTP_HEAD
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": urn(refers_to, 1)}
    else:
        block += payload
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    raw = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def package(members: list[bytes], lines: list[str], zip64: bool = False) -> bytes:
    """A ZIP file of the stored archive and index members."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, parts in ((MEMBER, members), (INDEX, [x.encode() for x in lines])):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                for p in parts:
                    f.write(p)
    return out.getvalue()


def _write(root: str, size: int):
    """Arrow task: records to packages; a manifest row per package."""
    def run(batches):
        fs, base = filesystem(root)
        task = TaskContext.get()
        stem = f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        members: list[bytes] = []
        lines: list[str] = []
        held, number = 0, 0

        def close():
            nonlocal members, lines, held, number
            path = f"{stem}-{number:05d}.zip"
            raw = package(members, lines)
            with fs.open_output_stream(path) as f:
                f.write(raw)
            row = pa.RecordBatch.from_arrays([pa.array([f"{root}/{path.rsplit('/', 1)[1]}"]), pa.array([len(raw)], pa.int64()),
                                              pa.array([len(members)], pa.int64())], names=["path", "bytes", "records"])
            members, lines, held, number = [], [], 0, number + 1
            return row

        for b in batches:
            for i, twin, url, html, revisit, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                one = record(i, twin, url, (html or "").encode(), revisit, refers)
                lines.append(json.dumps({"offset": held, "length": len(one), "page": i, "url": url}) + "\n")
                members.append(one)
                held += len(one)
                if held >= size:
                    yield close()
        if members:
            yield close()
    return run


def write_packages(spark: SparkSession, pages: DataFrame, scratch: U.Scratch, package_bytes: int = PACKAGE_BYTES,
                   least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every page; the manifest (path, bytes, records)."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    keyed = src.withColumn("sha", F.sha2(html, 256))
    twin = F.row_number().over(W.partitionBy("id", "sha").orderBy("size"))
    keys = scratch.save(keyed.select("id", "sha", F.octet_length(html).alias("size")).withColumn("twin", twin), "keys")
    first = keys.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    again = (keys.join(first.where("n > 1"), "sha").where(~(F.col("id").eqNullSafe(F.col("first")) & (F.col("twin") == 1)))
             .select("id", "sha", "twin", "first"))
    again = scratch.save(again, "revisits")
    num = F.row_number().over(W.partitionBy("id", "sha").orderBy("url"))
    rows = keyed.withColumn("twin", num) if keys.where("twin > 1").limit(1).count() else keyed.withColumn("twin", F.lit(1))
    a = again.select(F.col("id").alias("rid"), F.col("sha").alias("rsha"), F.col("twin").alias("rtwin"), "first")
    rows = (rows.join(a, F.col("id").eqNullSafe(F.col("rid")) & (F.col("sha") == F.col("rsha")) & (F.col("twin") == F.col("rtwin")), "left")
            .select("id", "twin", "url", "html", F.col("rsha").isNotNull().alias("revisit"), F.col("first").alias("refers")))
    root = scratch.path("packages")
    fs, base = filesystem(root)
    fs.create_dir(base, recursive=True)
    return scratch.save(rows.mapInArrow(_write(root, package_bytes), "path string, bytes bigint, records bigint"), "manifest")


# --- reading -------------------------------------------------------------------

@dataclass
class Member:
    """An entry of the central directory."""
    name: str
    method: int
    size: int
    stored: int
    header: int


class ZipRanges:
    """Range reader of one ZIP file: ``read(offset, length)`` gives bytes."""

    def __init__(self, read, size: int):
        self.read, self.size = read, size
        self.members = {m.name: m for m in self._directory()}

    def _end(self) -> tuple[int, int]:
        """Offset and length of the central directory."""
        span = min(self.size, 22 + 0xFFFF)
        tail = self.read(self.size - span, span)
        at = tail.rfind(b"PK\x05\x06")
        while at >= 0:
            if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no end of central directory")
        length, offset = struct.unpack_from("<II", tail, at + 12)
        locator = self.size - span + at - 20
        if locator >= 0:
            raw = self.read(locator, 20)
            if raw[:4] == b"PK\x06\x07":
                where = struct.unpack_from("<Q", raw, 8)[0]
                wide = self.read(where, 56)
                if wide[:4] != b"PK\x06\x06":
                    raise ValueError("bad ZIP64 end record")
                length, offset = struct.unpack_from("<QQ", wide, 40)
        return offset, length

    def _directory(self) -> Iterator[Member]:
        offset, length = self._end()
        raw, at = self.read(offset, length), 0
        while at + 46 <= len(raw):
            if raw[at:at + 4] != b"PK\x01\x02":
                raise ValueError("bad central directory")
            method = struct.unpack_from("<H", raw, at + 10)[0]
            stored, size = struct.unpack_from("<II", raw, at + 20)
            n, x, c = struct.unpack_from("<HHH", raw, at + 28)
            header = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46:at + 46 + n].decode()
            extra, k = raw[at + 46 + n:at + 46 + n + x], 0
            while k + 4 <= len(extra):
                kind, span = struct.unpack_from("<HH", extra, k)
                if kind == 1:  # only the fields that overflow, in this order
                    wide = list(struct.unpack_from(f"<{span // 8}Q", extra, k + 4))
                    size = wide.pop(0) if size == 0xFFFFFFFF else size
                    stored = wide.pop(0) if stored == 0xFFFFFFFF else stored
                    header = wide.pop(0) if header == 0xFFFFFFFF else header
                k += 4 + span
            yield Member(name, method, size, stored, header)
            at += 46 + n + x + c

    def start(self, member: Member) -> int:
        """First data byte of a stored member."""
        if member.method != zipfile.ZIP_STORED:
            raise ValueError(f"{member.name} is compressed; ranges need stored members")
        raw = self.read(member.header, 30)
        if raw[:4] != b"PK\x03\x04":
            raise ValueError("bad local header")
        n, x = struct.unpack_from("<HH", raw, 26)
        return member.header + 30 + n + x


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record (a gzip member)."""
    plain = zlib.decompress(raw, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def records(zip_file: ZipRanges, read_bytes: int = READ_BYTES) -> Iterator[tuple[dict, dict[str, str], bytes]]:
    """Index line, headers and payload of every record, in batches of neighbouring ranges."""
    index = zip_file.members[INDEX]
    data = zip_file.start(zip_file.members[MEMBER])
    lines = [json.loads(x) for x in zip_file.read(zip_file.start(index), index.size).splitlines()]
    i = 0
    while i < len(lines):
        j, low = i, lines[i]["offset"]
        while j < len(lines) and lines[j]["offset"] + lines[j]["length"] - low <= max(read_bytes, lines[i]["length"]):
            j += 1
        raw = zip_file.read(data + low, lines[j - 1]["offset"] + lines[j - 1]["length"] - low)
        for x in lines[i:j]:
            yield x, *parse_record(raw[x["offset"] - low:x["offset"] - low + x["length"]])
        i = j


def _page(urn: str) -> int | None:
    part = urn.strip("<>").split(":")[2]
    return None if part == "none" else int(part)


def _read(payloads: bool):
    """Arrow task: manifest rows to the records of their packages."""
    def run(batches):
        for b in batches:
            for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, inner = filesystem(path)
                with fs.open_input_file(inner) as f:
                    rows, held = [], 0
                    for line, head, payload in records(ZipRanges(lambda at, n: f.read_at(n, at), size)):  # noqa: B023
                        kind = head["WARC-Type"]
                        digest = head["WARC-Payload-Digest"].split(":", 1)[1]
                        if kind == "response" and payload_digest(payload) != digest:
                            raise ValueError(f"digest of page {line['page']} in {path} differs")
                        rows.append((_page(head["WARC-Record-ID"]), line["url"], kind, len(payload), digest,
                                     _page(head["WARC-Refers-To"]) if kind == "revisit" else None,
                                     payload if payloads and kind == "response" else None))
                        held += len(payload) if payloads else 0
                        if len(rows) >= 5000 or held >= READ_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)
    return run


RECORDS = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
           "refers_to bigint, payload binary")


def _batch(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=[x.split()[0] for x in RECORDS.split(", ")])


def read_packages(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record: ``page_id, url, record_type, payload_bytes, payload_digest,
    refers_to, payload`` (of revisits: 0 bytes, the digest of the full payload, no payload)."""
    # as many tasks as packages, up to the cluster's usual number: a given number isn't merged
    # for being small, as the manifest is
    tasks = min(max(manifest.count(), 1), max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), 32))
    spread = manifest.select("path", "bytes").repartition(tasks)
    return spread.mapInArrow(_read(payloads), RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, package_bytes: int = PACKAGE_BYTES, least_bytes: int = 0,
               **cols: str) -> DataFrame:
    """Write all pages, read the packages back, and give revisits the size of the payload they
    refer to: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    s = U.Scratch(spark, "warc-zip")
    back = read_packages(write_packages(spark, pages, s, package_bytes, least_bytes, **cols), payloads=False)
    rows = s.save(back.drop("payload", "url"), "records")
    sizes = (rows.where("record_type = 'response'").groupBy("payload_digest")
             .agg(F.max("payload_bytes").alias("full")))
    return (rows.join(sizes, "payload_digest", "left")
            .select("page_id", F.when(F.col("record_type") == "revisit", F.col("full")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                    "payload_digest", "record_type", "refers_to"))
