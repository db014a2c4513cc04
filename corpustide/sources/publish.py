"""Sinks: deterministic archives, and publication in an order that makes a half-finished one visible.

Documents are written first, by tasks; the index only when all of them are there, then the state: a reader that finds
no index, or a state older than it, knows that a publication did not end. Names come from content, so a repeated task
writes the same file again.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


#: A member's own header, its line in the directory, and the archive's end; an archive of more bytes than this goes through zipfile.
LOCAL, ENTRY, END, PLAIN = struct.Struct("<4s5H3L2H"), struct.Struct("<4s4B4H3L5H2L"), struct.Struct("<4s4H2LH"), 1 << 30
#: Fixed values of members: version, method, time and date (1980-01-01).
VERSION, DEFLATED, TIME, DATE, MODE = 20, 8, 0, 33, 0o644 << 16


def archive(members: list[tuple[str, bytes]], last: str | None = "index.json") -> bytes:
    """ZIP whose bytes depend on its members alone: sorted, fixed time and mode, each path once, ``last`` at the end."""
    each: dict[str, bytes] = {}
    for name, data in sorted(members, key=lambda m: (m[0] == last, m[0])):
        each.setdefault(name, data)
    size = 100 * len(each) + 8 * sum(map(len, each)) + sum(map(len, each.values()))
    if len(each) < 0xFFFF and size < PLAIN and os.sep == "/" and "\0" not in "".join(each):
        return _plain(each)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in each.items():
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.external_attr, info.compress_type = MODE, zipfile.ZIP_DEFLATED
            z.writestr(info, data)
    return out.getvalue()


def _plain(members: dict[str, bytes]) -> bytes:
    """The same bytes as zipfile's, of packs without extensions: most members are small, and its own work is several times theirs."""
    out, directory, at = [], [], 0
    for name, data in members.items():
        path, flags = name.encode(), 0 if name.isascii() else 0x800
        packed = zlib.compress(data, -1, -15)
        about = (flags, DEFLATED, TIME, DATE, zlib.crc32(data), len(packed), len(data), len(path), 0)
        out += (LOCAL.pack(b"PK\3\4", VERSION, *about), path, packed)
        directory += (ENTRY.pack(b"PK\1\2", VERSION, 3, VERSION, 0, *about, 0, 0, 0, MODE, at), path)
        at += LOCAL.size + len(path) + len(packed)
    listed = b"".join(directory)
    return b"".join((*out, listed, END.pack(b"PK\5\6", 0, 0, len(members), len(members), len(listed), at, 0)))


def sound(data: bytes) -> bool:
    """Whether every member of an archive is there with its checksum. What is not plain is left to zipfile."""
    try:
        return _plainly_sound(data) or zipfile.ZipFile(io.BytesIO(data)).testzip() is None
    except Exception:  # damage shows in many ways: lengths, methods, flags, streams
        return False


def _plainly_sound(data: bytes) -> bool:
    """Whether an archive is laid out as :func:`archive` does it, and sound; false says nothing."""
    end = len(data) - END.size
    try:
        mark, _, _, n, count, size, start, more = END.unpack_from(data, end)
        if mark != b"PK\5\6" or n != count or n == 0xFFFF or more or start + size != end:
            return False
        at, row = 0, start
        for _ in range(n):
            mark, _, _, version, _, flags, method, time, date, crc, packed, length, named, *more, _, _, offset = ENTRY.unpack_from(data, row)
            path, begin = data[row + ENTRY.size:row + ENTRY.size + named], at + LOCAL.size + named
            own = LOCAL.pack(b"PK\3\4", VERSION, flags, method, time, date, crc, packed, length, named, 0) + path
            if mark != b"PK\1\2" or version != VERSION or flags not in (0, 0x800) or method != DEFLATED or any(more) or offset != at or data[at:begin] != own or length > GATHERED_BYTES:
                return False
            if flags:
                path.decode()
            stream = zlib.decompressobj(-15)
            content = stream.decompress(data[begin:begin + packed], length + 1)
            if not stream.eof or stream.unused_data or len(content) != length or zlib.crc32(content) != crc:
                return False
            at, row = begin + packed, row + ENTRY.size + named
        return at == start and row == end
    except (struct.error, zlib.error, UnicodeDecodeError):
        return False


#: Archives and their bytes that are gathered before a task hands them on.
GATHERED, GATHERED_BYTES = 1000, 16 << 20


def archives(members: DataFrame, last: str | None = "index.json") -> DataFrame:
    """One archive for each item of (pid, path, content): pid, sha256, members, content."""

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["pid", "sha256", "members", "content"])

    def one(pid, pack: list[tuple[str, bytes]]) -> tuple:
        data = archive(pack, last)
        return pid, hashlib.sha256(data).hexdigest(), len({p for p, _ in pack if p is not None}), data

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, pack, out, held = None, [], [], 0
        for batch in batches:
            for pid, path, content in zip(batch["pid"], batch["path"], batch["content"]):
                if pack and pid != at:
                    out.append(one(at, pack))
                    held += len(out[-1][3])
                    pack = []
                    if len(out) >= GATHERED or held >= GATHERED_BYTES:
                        yield frame(out)
                        out, held = [], 0
                at = pid
                pack.append((path, bytes(content)))
        if pack:
            out.append(one(at, pack))
        if out:
            yield frame(out)

    # packs follow one another in a task: a call for each costs more than a small archive. The place of a member in its pack
    # asks for packs as they stand, sorted, so members that lie by pack already are not moved again
    order = Window.partitionBy("pid").orderBy(*[] if last is None else [F.col("path") == last], "path")
    packs = members.select("pid", "path", "content").withColumn("place", F.row_number().over(order))
    return packs.mapInPandas(run, "pid string, sha256 string, members long, content binary")


def verified(archives: DataFrame) -> DataFrame:
    """Adds ``ok``: the digest is that of the content, and every member's checksum holds."""

    @F.pandas_udf("boolean")
    def holds(contents: pd.Series) -> pd.Series:
        return contents.map(sound)

    return archives.withColumn("ok", (F.sha2("content", 256) == F.col("sha256")) & holds("content"))


def put(path: str, data: bytes) -> None:
    """A file that is there whole or not at all."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{os.getpid()}.part"
    with open(part, "wb") as f:
        f.write(data)
        f.flush()
        os.fsync(f.fileno())
    os.replace(part, path)


def ranges(size: int, single: int = 4 << 20, chunk: int = 10 << 20) -> list[tuple[int, int]]:
    """Byte ranges of an upload: one below ``single``, else of ``chunk`` each."""
    if size < single:
        return [(0, size)]
    return [(a, min(a + chunk, size)) for a in range(0, size, chunk)]


class FilesWriter(DataSourceWriter):
    """Files under a folder, each whole or not at all; those that are there with the same bytes are left alone."""

    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        for row in iterator:
            data, full = bytes(row.content), os.path.join(self.root, row.path)
            if not os.path.exists(full) or hashlib.sha256(open(full, "rb").read()).digest() != hashlib.sha256(data).digest():
                put(full, data)
        return WriterCommitMessage()

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing is left to do: each task has written its files."""

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files may stay: without an index nothing refers to them."""


class Publication(DataSource):
    """``df.write.format("publication")`` of (path, content). Option root: a folder that all executors share."""

    @classmethod
    def name(cls) -> str:
        return "publication"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FilesWriter(self.options["root"])


def _put_all(files: DataFrame, root: str) -> None:
    files.select("path", F.col("content").cast("binary").alias("content")).write.format("publication").option("root", root).mode("append").save()


def publish(
    root: str, state: str, documents: DataFrame, seen: DataFrame | None = None, runs: DataFrame | None = None,
    changes: DataFrame | None = None, shard: int | None = None
) -> None:
    """Publish documents (pid, path, content), step by step, each by tasks and only after the one before has ended:

    documents; each item's index; each item's state; what was seen (pid, first_seen, last_seen, last_change) and the
    run's record of each item (pid, and its columns); the shard's index; the change records; at last the day's marker.
    A reader that finds a later file may rely on all before it. Items that did not move come in ``seen`` and ``runs``
    only, and none of their documents is written. The driver writes the marker alone.
    """
    to_json = lambda *cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    at = lambda name: F.concat(F.col("pid"), F.lit(f"/{name}"))
    _put_all(documents.select(at("").alias("folder"), "path", "content").select(F.concat("folder", "path").alias("path"), "content"), root)
    listed = documents.select(
        "pid", F.struct("path", F.sha2("content", 256).alias("sha256")).alias("d")
    ).groupBy("pid").agg(F.array_sort(F.collect_list("d")).alias("documents"))
    _put_all(listed.select(at("index.json").alias("path"), to_json("pid", "documents").alias("content")), root)
    items = documents.select("pid").distinct()
    _put_all(items.select(at("state.json").alias("path"), to_json("pid", F.lit(state).alias("state")).alias("content")), root)
    for name, rows in (("seen", seen), ("run", runs)):
        if rows is not None:
            path = at(f"{name}.json") if name == "seen" else at(f"runs/{state}.json")
            _put_all(rows.select(path.alias("path"), to_json(*rows.columns).alias("content")), root)
    place = "" if shard is None else f"shard-{shard}/"
    _lines(items.orderBy("pid"), f"{root}/{place}index-{state}")
    if changes is not None:
        _lines(changes, f"{root}/{place}changes-{state}")
    put(os.path.join(root, place, "day.json"), json.dumps({"state": state, "shard": shard}).encode())


def _lines(rows: DataFrame, path: str) -> None:
    """JSON lines in parts under a folder, by tasks; Spark's own marker says that they are whole."""
    rows.write.mode("overwrite").json(f"file://{path}" if path.startswith("/") else path)


def harvest(records: DataFrame, coverage: DataFrame, root: str) -> None:
    """A scan's records as JSON lines, and beside them one row about the scan: its coverage and the records by type."""
    records.write.mode("overwrite").json(f"{root}/records")
    by = records.groupBy(F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"))
    counts = by.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("by_type")).withColumn("_one", F.lit(1))
    coverage.withColumn("_one", F.lit(1)).join(counts, "_one").drop("_one").coalesce(1).write.mode("overwrite").json(f"{root}/meta")  # one row each


def outcomes(df: DataFrame, root: str) -> None:
    """Outcome lists of a run (target, outcome, found, pos): done sorted, the others in order. A list is a folder of parts
    whose names are in the order of their lines: each task sorts and writes its own range. See :func:`listed`."""
    for name in ("done", "failed", "withdrawn"):
        mine = df.filter(F.col("outcome") == name).orderBy("target" if name == "done" else "pos").select("target")
        mine.write.mode("overwrite").text(f"{root}/{name}")
    df.filter("found is not null").orderBy("pos").select("target", "found").write.mode("overwrite").csv(f"{root}/resolved", sep="\t")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(value, place) of a list written in parts: lines numbered from 0 through all parts in the order of their names.

    Lines of a part are numbered by where they stand in it, so a part is read by one task; a count for each part goes
    through the driver.
    """
    part = F.regexp_extract(F.input_file_name(), r"part-([0-9]+)", 1).cast("int")
    whole = spark.read.text(path, wholetext=True).select(part.alias("part"), F.posexplode(F.split("value", "\n")).alias("at", "value"))
    lines = whole.filter("value <> ''")
    before, firsts = 0, []
    for r in sorted(lines.groupBy("part").count().collect()):
        firsts.append((r["part"], before))
        before += r["count"]
    starts = spark.createDataFrame(firsts, "part int, before long")
    return lines.join(F.broadcast(starts), "part").select("value", (F.col("before") + F.col("at")).cast("long").alias("place"))


def append_journal(path: str, rows: list[dict]) -> None:
    """JSON lines that are on disk when this returns."""
    with open(path, "a", encoding="utf-8") as f:
        for r in rows:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")
        f.flush()
        os.fsync(f.fileno())
