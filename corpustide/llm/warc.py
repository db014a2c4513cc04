"""WARC records in ZIP packages: a writer, and a reader that takes records by range, without extraction.

A package is a ZIP whose members are all stored, not deflated: ``archive/data.warc.gz`` (one gzip member per record,
so that a record can be read alone) and ``indexes/index.jsonl`` (a line per record: page, offset, length, type). The
reader finds the end of the central directory from the tail of the file, follows the ZIP64 locator where a field is
saturated, reads the central directory, and from each member's local header its place in the package; then it reads
the index and each record by (offset, length). It needs only ``read(offset, length)`` and the size.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: ZIP format, fixed values: signatures of the end of the central directory, its ZIP64 locator and record, an entry, a local header.
END, LOCATOR64, END64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
#: Payload bytes of a package, at which the next one starts.
PACKAGE = 4 << 20


class Member(NamedTuple):
    name: str
    method: int
    size: int
    packed: int
    local: int


class Package:
    """Central directory of a ZIP, and reads within its stored members. ``read(offset, length)`` gives bytes of the file."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.size = read, size
        self.members = {m.name: m for m in self._directory()}
        self._data: dict[str, int] = {}

    @classmethod
    def of(cls, source: bytes | io.IOBase) -> Package:
        if isinstance(source, (bytes, bytearray, memoryview)):
            view = memoryview(source)
            return cls(lambda at, n: bytes(view[at : at + n]), len(view))

        def read(at: int, n: int) -> bytes:
            source.seek(at)
            return source.read(n)

        return cls(read, source.seek(0, io.SEEK_END))

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - 65535)  # the comment takes 65,535 bytes at most
        tail = self.read(tail_at, self.size - tail_at)
        stop = len(tail)
        while True:  # the last signature whose comment ends with the file
            at = tail.rfind(END, 0, stop)
            if at < 0:
                raise ValueError("not a ZIP file: no end of central directory")
            if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
            stop = at + 3
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            locator = self.read(tail_at + at - 20, 20)
            if locator[:4] == LOCATOR64:
                (where,) = struct.unpack_from("<Q", locator, 8)
                record = self.read(where, 56)
                if record[:4] != END64:
                    raise ValueError("damaged ZIP64 end of central directory")
                count, length, start = struct.unpack_from("<QQQ", record, 32)
        data, at = self.read(start, length), 0
        for _ in range(count):
            if data[at : at + 4] != ENTRY:
                raise ValueError("damaged central directory")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed, size = struct.unpack_from("<II", data, at + 20)
            n_name, n_extra, n_comment = struct.unpack_from("<HHH", data, at + 28)
            (local,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra, x = data[at + 46 + n_name : at + 46 + n_name + n_extra], 0
            while x + 4 <= len(extra):  # the ZIP64 field holds just the saturated ones, in this order
                kind, n = struct.unpack_from("<HH", extra, x)
                if kind == 1:
                    wide = list(struct.unpack_from(f"<{n // 8}Q", extra, x + 4))
                    size = wide.pop(0) if size == 0xFFFFFFFF else size
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    local = wide.pop(0) if local == 0xFFFFFFFF else local
                x += 4 + n
            yield Member(name, method, size, packed, local)
            at += 46 + n_name + n_extra + n_comment

    def range(self, name: str, offset: int, length: int) -> bytes:
        """Bytes of a stored member."""
        member = self.members[name]
        if member.method != 0:
            raise ValueError(f"{name} is not stored: it can't be read by range")
        if name not in self._data:
            head = self.read(member.local, 30)
            if head[:4] != LOCAL:
                raise ValueError(f"damaged local header of {name}")
            self._data[name] = member.local + 30 + sum(struct.unpack_from("<HH", head, 26))
        if offset < 0 or offset + length > member.size:
            raise ValueError(f"range outside {name}")
        return self.read(self._data[name] + offset, length)


def record(page: int | None, url: str | None, kind: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, as a gzip member. A revisit has no block; its digest and length are those of the payload it leaves out."""
    block = payload if kind == "response" else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    data = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record's gzip member."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    n = int(headers["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record is longer or shorter than it says")
    return headers, rest[:n]


def package(records: list[tuple[int | None, str, bytes]]) -> bytes:
    """A ZIP of records (page, type, gzip member), stored, with ZIP64 fields in the local headers."""
    out, index, at = io.BytesIO(), [], 0
    for page, kind, data in records:
        index.append(json.dumps({"page": page, "type": kind, "offset": at, "length": len(data)}))
        at += len(data)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in ((DATA, b"".join(x for _, _, x in records)), (INDEX, "\n".join(index).encode())):
            with z.open(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), "w", force_zip64=True) as f:
                f.write(data)
    return out.getvalue()


def _write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for batch in batches:
        for page, url, html, first in zip(batch["page"], batch["url"], batch["html"], batch["first"]):
            page = None if pd.isna(page) else int(page)
            payload = (html or "").encode("utf-8", "surrogatepass")
            refers = None if pd.isna(first) or first == page else int(first)
            kind = "response" if refers is None else "revisit"
            held.append((page, kind, record(page, url, kind, payload, hashlib.sha1(payload).hexdigest(), refers)))
            size += len(held[-1][2])
            if size >= PACKAGE:
                yield pd.DataFrame({"content": [package(held)]})
                held, size = [], 0
    if held:
        yield pd.DataFrame({"content": [package(held)]})


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    number = lambda x: int(x[len("<urn:page:") : -1]) if x not in (None, "<urn:page:>") else None
    for batch in batches:
        for content in batch["content"]:
            zipped, rows = Package.of(content), []
            index = zipped.range(INDEX, 0, zipped.members[INDEX].size).decode()
            for entry in map(json.loads, index.split("\n")):
                headers, block = parse(zipped.range(DATA, entry["offset"], entry["length"]))
                digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
                if kind == "response" and hashlib.sha1(block).hexdigest() != digest:
                    raise ValueError("a payload differs from its digest")
                n = len(block) if kind == "response" else int(headers["x-payload-length"])
                rows.append((number(headers["warc-record-id"]), n, digest, kind, number(headers.get("warc-refers-to")), headers.get("warc-target-uri"), block))
            out = pd.DataFrame(rows, columns=cols)
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def write_packages(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Packages (column content) that hold a record for each row of ``pages`` (page_id, url, html).

    Of records with equal payloads of ``least`` bytes or more, the one with the largest page_id is a response and the
    others revisit it, rows without a page_id too; where none has a page_id all are responses. Rows that repeat the
    largest page_id are all responses. Null html is an empty payload, payloads of any length are one record, an empty
    table gives no packages, and other columns are not read. To keep the packages as files, write each row's content;
    ``Package.of`` also reads from an open file, record by record.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page"), "url", "html")
    marks = rows.select("page", F.sha2("html", 256).alias("digest"), F.octet_length("html").alias("n")).filter(F.col("n") >= least)
    several = marks.groupBy("digest").agg(F.count("*").alias("rows"), F.max("page").alias("first")).filter("rows > 1 and first is not null")
    firsts = stored(several.select("digest", "first"), "payloads")
    joined = rows.withColumn("digest", F.when(F.octet_length("html") >= least, F.sha2("html", 256))).join(firsts, "digest", "left")
    return joined.select("page", "url", "html", "first").mapInPandas(_write, "content binary")


def read_packages(packages: DataFrame) -> DataFrame:
    """All records of packages (column content): page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload (empty for a revisit)."""
    return packages.select("content").mapInPandas(
        _read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    )


def op4_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to packages in the shared folder, and read back."""
    packages = stored(write_packages(spark.read.parquet(f"{sf_dir}/pages.parquet")), "packages")
    return read_packages(packages).drop("url", "payload")


OP4_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
     f AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""
