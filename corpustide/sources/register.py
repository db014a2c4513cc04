"""Python data sources over a paged register, and over platform pages, with the transport passed in by name.

A transport is ``module:function``; it is imported where the scan runs, so tests and other registers bring their own.
"""

from __future__ import annotations

import importlib
import itertools
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from ..functions import values as V


def transport(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def get_json(
    url: str, tries: int = 4, wait: float = 0.4, open_url: Callable = urllib.request.urlopen, sleep: Callable = time.sleep
) -> tuple[object, dict[str, str]]:
    """(parsed body, headers), with a wait that doubles after each failure."""
    for n in range(tries):
        try:
            with open_url(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=60) as r:
                return json.loads(r.read().decode()), dict(r.headers)
        except (urllib.error.URLError, ValueError, TimeoutError):
            if n + 1 == tries:
                raise
            sleep(wait * 2**n)
    raise AssertionError("unreachable")


def scan_pages(
    page: Callable[[int], tuple[list[dict], int, int]], pause: float = 0.25, stalled: int = V.MAX_PAGES, sleep: Callable = time.sleep
) -> Iterator[tuple[int, dict]]:
    """(page number, record) of a paged scan. ``page(n)`` gives records, the total and the page size.

    Ends on an empty page, a short page or the total reached, however many pages that takes. A register that brings
    nothing new for ``stalled`` pages in a row never ends: that is an error, not the end of a scan.
    """
    seen: set[str] = set()
    idle = 0
    for n in itertools.count():
        if n:
            sleep(pause)
        records, total, size = page(n)
        before = len(seen)
        for r in records:
            seen.add(str(r.get("identifier") or r.get("externalId") or ""))
            yield n, r
        if not records or len(records) < size or len(seen) >= total:
            return
        idle = idle + 1 if len(seen) == before else 0
        if idle >= stalled:
            raise RuntimeError(f"nothing new on {idle} pages, {len(seen)} of {total} records")


class RegisterReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # the register gives its pages in order, one at a time

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        page = transport(self.options["transport"])
        pause = float(self.options.get("pause", 0.25))
        start, end = self.options.get("from", ""), self.options.get("to", "")
        for pos, (n, r) in enumerate(scan_pages(lambda n: page(n, start, end), pause)):
            yield (pos, n, str(r.get("identifier") or r.get("externalId") or ""), json.dumps(r, ensure_ascii=False))


class Register(DataSource):
    """``spark.read.format("register")``: pos, page, key, record (JSON). Options: transport, from, to, pause."""

    @classmethod
    def name(cls) -> str:
        return "register"

    def schema(self) -> str:
        return "pos int, page int, key string, record string"

    def reader(self, schema) -> DataSourceReader:
        return RegisterReader(self.options)


class WalkReader(SimpleDataSourceStreamReader):
    """Pages of consecutive ids; a batch takes ``batch`` ids, and none after a run of misses.

    The offset that Spark logs and commits is all the state there is: the frontier id and the last id that had a page,
    which the run of misses is counted from. A restarted walk goes on from the offset it is given, and a batch that was
    logged but not committed is read again by its range of ids. The source shows one page at a time, so one reader walks.
    """

    def __init__(self, options: dict[str, str]):
        self.page = transport(options["transport"])
        self.start, self.end = int(options.get("start", 1)), int(options.get("end", 2**62))
        self.size, self.misses = int(options.get("batch", 100)), int(options.get("misses", 40))

    def initialOffset(self) -> dict:
        return {"id": self.start, "hit": self.start - 1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        at, hit, rows = start["id"], start["hit"], []
        if at - 1 - hit < self.misses:  # else the walk has ended
            for pid in range(at, min(at + self.size, self.end)):
                found = self.page(pid)
                hit = pid if found is not None else hit
                rows.append((pid, found))
        return iter(rows), {"id": at + len(rows), "hit": hit}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return ((pid, self.page(pid)) for pid in range(start["id"], end["id"]))


class Walk(DataSource):
    """``spark.readStream.format("walk")``: pid, html (null where nothing is published). Options: transport, start, end, batch, misses."""

    @classmethod
    def name(cls) -> str:
        return "walk"

    def schema(self) -> str:
        return "pid long, html string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return WalkReader(self.options)


class Refused(Exception):
    """The platform will never show this item to a guest."""


def fetch_page(get: Callable[[str], str], url: str, tries: int = 6, wait: float = 20.0, sleep: Callable = time.sleep) -> str:
    """A published page; a refusal is final at once, anything else is asked again with a growing wait."""
    last = ""
    for n in range(1, tries + 1):
        last = get(url) or ""
        if all(m in last for m in V.PUBLISHED_STRUCTURE) or any(m in last for m in V.PUBLISHED_HEADINGS):
            return last
        if any(m in last for m in V.DENIED_HEADINGS):
            raise Refused(url)
        if n < tries:
            sleep(wait * n)
    raise RuntimeError(f"no published page at {url} after {tries} tries")


def record_archive(post: Callable[[str], bytes], url: str) -> list[tuple[str, bytes]] | None:
    """Members of a record's archive; None where the answer is a page, empty, damaged or holds nothing."""
    import io
    import zipfile

    data = post(url)
    if not data or data.lstrip()[:1] == b"<":
        return None
    try:
        z = zipfile.ZipFile(io.BytesIO(data))
        if z.testzip() is not None:
            return None
        return [(i.filename, z.read(i)) for i in z.infolist() if not i.is_dir()] or None
    except zipfile.BadZipFile:
        return None


def record_files(
    post: Callable[[str], bytes], list_files: Callable[[str], list[dict]], record_url: str, file_url: Callable[[dict], str]
) -> tuple[str, list[tuple[str, bytes]]]:
    """(method, files): the record's archive, or else each of its files on its own."""
    members = record_archive(post, record_url)
    if members is not None:
        return "zip", members
    return "files", [(f["name"], post(file_url(f))) for f in list_files(record_url)]


def install(spark: SparkSession) -> None:
    from .publish import Publication

    for source in (Register, Walk, Publication):
        spark.dataSource.register(source)
